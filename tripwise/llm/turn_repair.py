"""Repair of conversation structure by the cheapest edits.

A conversation is repaired to role initials ``(s?(ua)+)?``: each row is kept,
given another role or deleted, and empty rows may be inserted.  The cheapest
edits come from a Viterbi search over the states of that pattern.  Its
survivors are leaves of a tree of back pointers whose nodes count their
references: branches that no survivor needs are freed, and as soon as all
survivors share an ancestor, the edits up to it are emitted and leave memory.
What stays is the part that is still open, and survivors of equal cost are
compared on all of it.

Rows are dealt by range of (conversation, turn) and searched within each
range, so a conversation of any length is spread over tasks.  The first
conversation of a range may have begun before: it is searched from every state,
and the pieces of one conversation are joined afterwards, a step as cheap as
their number.  Only the digest of a conversation that spans ranges is taken in
a single stream, because SHA-256 has no parts.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.operators.joins import bounded_broadcast

from . import common

RELABEL, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: States: 0 nothing yet, 1 after the system's row, 2 after the user's, 3 after
#: the assistant's; the pattern may end in 0 and 3.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The role that may come next, other than a system's first row.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
LEGAL = {"su", "ua", "au"}


# ---- search -----------------------------------------------------------------

class Node:
    """An edit, the one before it, and how many nodes and survivors hold it."""

    __slots__ = ("up", "letter", "held")

    def __init__(self, up, letter):
        self.up, self.letter, self.held = up, letter, 0
        if up is not None:
            up.held += 1


class Search:
    """Survivors of one conversation from a starting state.  ``emit`` takes
    the letters of edits that are decided, in order."""

    def __init__(self, start: int = START, emit=None):
        self.root = Node(None, "")
        self.audit: list[str] = []
        self.emit = emit
        self.live: dict[int, tuple[int, Node]] = {}
        self._settle(self._inserted({start: (0, None, self.root)}))

    def open_letters(self, node: Node) -> str:
        """All undecided letters of the way to a node."""
        out = []
        while node is not self.root:
            out.append(node.letter)
            node = node.up
        return "".join(reversed(out))

    def _better(self, new, old) -> bool:
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        return self._spelt(new) < self._spelt(old)

    def _spelt(self, candidate) -> str:
        """Letters of a candidate (cost, letters, node it goes on from)."""
        return self.open_letters(candidate[2]) + (candidate[1] or "")

    def _inserted(self, found):
        """Candidates after any number of insertions; more than three never
        help, as the states repeat.

        From ASSISTANT on everything goes as from SYSTEM at no more cost, and
        as from START at DELETE more at most (for a system's row that START
        keeps).  Survivors that cost more than that can't win and are let go;
        they would keep the others from ever sharing an ancestor."""
        for _ in range(3):
            for state, (cost, letters, node) in list(found.items()):
                new = (cost + INSERT, (letters or "") + "I", node)
                after = NEXT[state][1]
                if self._better(new, found.get(after)):
                    found[after] = new
        for state, slack in ((START, DELETE), (SYSTEM, 0)):
            if state in found and found[state][0] > found[ASSISTANT][0] + slack:
                del found[state]
        return found

    def _settle(self, found):
        """Make the candidates the survivors, free what no one holds, and
        emit what all of them share."""
        before = [node for _, node in self.live.values()]
        self.live = {}
        for state, (cost, letters, node) in found.items():
            for letter in letters or "":
                node = Node(node, letter)
            node.held += 1
            self.live[state] = (cost, node)
        for node in before:
            node.held -= 1
            while not node.held and node is not self.root:
                node.up.held -= 1
                node = node.up
        if self.root.held == 1 and all(node is not self.root for _, node in self.live.values()):
            path, node = [], next(iter(self.live.values()))[1]
            while node is not self.root:
                path.append(node)
                node = node.up
            survivors = {id(node) for _, node in self.live.values()}
            while path:
                self.root = path.pop()
                self.root.up = None
                self._decided(self.root.letter)
                if self.root.held != 1 or id(self.root) in survivors:
                    break

    def _decided(self, letters: str):
        self.audit.append(letters)
        if self.emit:
            for letter in letters:
                self.emit(letter)

    def row(self, initial: str, must_go: bool, cut_off: bool):
        found = {}

        def offer(state, cost, letter, node):
            new = (cost, letter, node)
            if self._better(new, found.get(state)):
                found[state] = new

        extra = CUT_OFF if cut_off else 0
        for state, (cost, node) in self.live.items():
            offer(state, cost + DELETE, "D", node)
            if must_go:
                continue
            role, after = NEXT[state]
            offer(after, cost + RELABEL + extra, "R", node)
            if initial == role[0]:
                offer(after, cost + extra, "K", node)
            elif initial == "s" and state == START:
                offer(SYSTEM, cost + extra, "K", node)
        self._settle(self._inserted(found))

    def results(self):
        """(end state, cost, audit) of the survivors."""
        done = "".join(self.audit)
        return [(state, cost, done + self.open_letters(node)) for state, (cost, node) in sorted(self.live.items())]

    def finish(self):
        """(cost, audit) of the cheapest end the pattern allows; its letters
        are emitted."""
        cost, rest = min((cost, self.open_letters(node)) for state, (cost, node) in self.live.items() if state in ENDS)
        if self.emit:
            for letter in rest:
                self.emit(letter)
        return cost, "".join(self.audit) + rest


class Editor:
    """Applies letters to rows (role, text) as both come in, in any rhythm;
    ``take`` gets the repaired rows."""

    def __init__(self, take):
        self.rows, self.state, self.take = deque(), START, take

    def letter(self, letter: str):
        if letter == "I":
            role, self.state = NEXT[self.state]
            self.take(role, "")
            return
        role, text = self.rows.popleft()
        if letter == "D":
            return
        system = letter == "K" and role[:1] == "s"
        wanted, after = ("system", SYSTEM) if system else NEXT[self.state]
        self.take(role if letter == "K" else wanted, text)
        self.state = after


class Digest:
    """SHA-256 of ``role:text`` lines joined by newlines."""

    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def take(self, role, text):
        self.sha.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode())
        self.any = True


class Piece:
    """One conversation's rows within a range: counts, and a search from each
    state it may begin in."""

    def __init__(self, conv_id, part: int, starts):
        self.conv_id, self.part = conv_id, part
        self.digest = Digest()
        self.editor = Editor(self.digest.take)
        self.searches = {s: Search(s, self.editor.letter if s == START else None) for s in starts}
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = self.before = None

    def add(self, turn, role, text, again):
        """``again``: the same role and text stood in an earlier turn."""
        row = (turn, role, text)
        shown = text.strip(common.BLANKS)
        blank = not shown
        duplicate = not blank and (again or row == self.before)
        cut_off = not blank and not duplicate and shown[-1] not in ".!?"
        if turn is not None and (self.high is None or turn != self.high):
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.n:
            self.illegal += self.last + role[:1] not in LEGAL
        else:
            self.first = role[:1]
        self.last, self.before = role[:1], row
        self.n += 1
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + cut_off
        self.editor.rows.append((role, text))
        for search in self.searches.values():
            search.row(role[:1], blank or duplicate, cut_off)

    def record(self):
        paths = [{"start": s, "stop": e, "cost": c, "audit": a} for s, search in self.searches.items() for e, c, a in search.results()]
        cost, audit = self.searches[START].finish()
        return (self.conv_id, self.part, self.n, self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated, self.illegal,
                self.first, self.last, paths, cost, audit, self.digest.sha.hexdigest())


# ---- stages -----------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by crc32(conv_id:turn) mod 20, nulls spelt as one
    space; a dropped row stays as a mark of its conversation (``dropped``)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                space("role").alias("role"), space("text").alias("text"), code.alias("code"))
    text = (F.when(F.col("code").isin(0, 1), F.lit("")).when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    copies = F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1))
    role = F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("code") == 0).alias("dropped"), F.explode(copies).alias("c")).drop("c")


def flagged(rows: DataFrame) -> DataFrame:
    """``rows`` with ``again``: an earlier turn of the conversation has the
    same role and text (equal turns are told apart later, side by side)."""
    spelt = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    rows = rows.withColumn("spelt", spelt)
    firsts = (rows.filter("NOT dropped").groupBy("conv_id", "spelt")
              .agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.bool_or(F.col("turn").isNull()).alias("unplaced"))
              .filter("low < high OR (unplaced AND low IS NOT NULL)")
              .select(F.col("conv_id").alias("c"), F.col("spelt").alias("s"), "low", "unplaced"))
    firsts = common.written(firsts, "turns-again")
    again = F.coalesce(F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("low"))), F.lit(False))
    met = rows.join(bounded_broadcast(firsts), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("spelt") == F.col("s")), "left")
    return met.select("conv_id", "turn", "role", "text", "dropped", again.alias("again"))


ORDER = ["conv_id", "turn", "role", "text"]
PIECE = ("conv_id long, part int, n long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, "
         "last string, paths array<struct<start:int,stop:int,cost:long,audit:string>>, cost long, audit string, sha string")
PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), *[(c, pa.int64()) for c in (
    "n", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")], ("first", pa.string()), ("last", pa.string()),
    ("paths", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
    ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string())])


def table_of(rows, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pieces(rows: DataFrame, ranges: int) -> DataFrame:
    """One row per conversation and range."""
    def run(batches):
        part, piece, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for conv_id, turn, role, text, dropped, again in zip(*(batch.column(c).to_pylist() for c in (*ORDER, "dropped", "again"))):
                if piece is None or conv_id != piece.conv_id:
                    # The range's first conversation may have begun before.
                    starts = range(4) if piece is None else (START,)
                    if piece is not None:
                        done.append(piece.record())
                    piece = Piece(conv_id, part, starts)
                if not dropped:
                    piece.add(turn, role, text, again)
                if len(done) >= 500:
                    yield table_of(done, PIECE_SCHEMA)
                    done = []
        if piece is not None:
            done.append(piece.record())
        if done:
            yield table_of(done, PIECE_SCHEMA)

    dealt = rows.repartitionByRange(ranges, "conv_id", "turn").sortWithinPartitions(*ORDER)
    return common.written(dealt.mapInArrow(run, PIECE), "turns-pieces")


def joined(group: pa.Table) -> pa.Table:
    """The pieces of one conversation, in order, as one: costs add up and
    audits go on, state by state."""
    parts = sorted(group.to_pylist(), key=lambda p: p["part"])
    out, ways, last, turns = None, {START: (0, "")}, None, []
    for p in parts:
        new = {}
        for way in p["paths"]:
            if way["start"] in ways:
                cost, audit = ways[way["start"]]
                found = (cost + way["cost"], audit + way["audit"])
                new[way["stop"]] = min(found, new.get(way["stop"], found))
        ways = new
        if out is None:
            out = dict(p)
        else:
            for name in ("n", "turns", "blank", "duplicate", "truncated", "illegal"):
                out[name] += p[name]
            if p["n"] and last is not None:
                out["illegal"] += last + p["first"] not in LEGAL
        last = p["last"] if p["n"] else last
        turns += [t for t in (p["low"], p["high"]) if t is not None]
    out["low"], out["high"] = (min(turns), max(turns)) if turns else (None, None)
    out["cost"], out["audit"] = min(ways[s] for s in ENDS if s in ways)
    whole = tuple(None if f.name in ("paths", "sha") else out[f.name] for f in PIECE_SCHEMA)
    return pa.Table.from_batches([table_of([whole], PIECE_SCHEMA)])


def streamed(rows: DataFrame, audits: DataFrame, schema: str, make) -> DataFrame:
    """Rows of each conversation in order with its audit before them, edited
    in one stream; ``make(conv_id)`` gives (take, results at the end)."""
    none = F.lit(None)
    edits = audits.select("conv_id", F.lit(0).alias("seq"), none.cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = edits.unionByName(rows.filter("NOT dropped").select("conv_id", F.lit(1).alias("seq"), "turn", "role", "text"))

    def run(batches):
        letters, at, editor, end = None, 0, None, None

        def inserted(at):
            while at < len(letters) and letters[at] == "I":
                editor.letter("I")
                at += 1
            return at

        for batch in batches:
            for c, seq, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "seq", "role", "text"))):
                if seq == 0:
                    if letters is not None:
                        inserted(at)
                        yield from end()
                    letters, at = text, 0
                    take, end = make(c)
                    editor = Editor(take)
                else:
                    at = inserted(at)
                    editor.rows.append((role, text))
                    editor.letter(letters[at])
                    at += 1
                    yield from end(False)
        if letters is not None:
            inserted(at)
            yield from end()

    return both.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "turn", "role", "text").mapInArrow(run, schema)


def digest_of(conv_id):
    held = Digest()
    schema = pa.schema([("c", pa.int64()), ("whole", pa.string())])

    def end(last=True):
        if last:
            yield table_of([(conv_id, held.sha.hexdigest())], schema)
    return held.take, end


def rows_of(conv_id):
    out, place = [], [0]
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def take(role, text):
        out.append((conv_id, place[0], role, text))
        place[0] += 1

    def end(last=True):
        if out and (last or len(out) >= 500):
            yield table_of(out, schema)
            out.clear()
    return take, end


def repair(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of every conversation of ``rows`` (conv_id, turn, role, text,
    and dropped for a mark without a row).

    Rows stand by turn, nulls first, equal turns by role and text.  A null
    conv_id is a conversation.  Texts are taken whole.  Conversations without
    rows have zeros and an empty audit; an empty table gives no rows."""
    spark = rows.sparkSession
    ranges = ranges or common.shuffle_partitions(spark)
    with common.batches_of(spark, rows=2000):
        found = pieces(flagged(rows), ranges)
        counted = found.groupBy("conv_id").agg(F.count("*").alias("k")).filter("k > 1").select(F.col("conv_id").alias("c"))
        # Two ranges side by side share one conversation at most, so this has
        # fewer rows than there are ranges.
        split = common.written(counted, "turns-split")
        same = F.col("conv_id").eqNullSafe(F.col("c"))
        alone = found.join(bounded_broadcast(split), same, "left_anti")
        several = common.written(found.join(bounded_broadcast(split), same, "left_semi").groupBy("conv_id").applyInArrow(joined, PIECE), "turns-joined")
        theirs = rows.join(bounded_broadcast(split), same, "left_semi")
        whole = common.written(streamed(theirs, several, "c long, whole string", digest_of), "turns-digests")
    several = several.join(bounded_broadcast(whole), same, "left").withColumn("sha", F.col("whole")).drop("c", "whole")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return alone.unionByName(several).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, place, role, text of the repaired conversations, from the rows
    and what ``repair`` says of them."""
    return streamed(rows, audits, "conv_id long, place long, role string, text string", rows_of)


def digest(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations))
