"""Repairs against plain searches; survivors; pieces; edge rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tripwise.llm import turn_repair
from tripwise.llm.common import BLANKS

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        if code:
            out[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(BLANKS)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """(cost, audit, repaired rows) by a table of whole solutions."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, done) in list(table.items()):
                new = (cost + 5, audit + "I", done + [(names[follow[state]], "")])
                table[follow[state]] = min(table.get(follow[state], new), new)
        return table

    table = inserted({"": (0, "", [])})
    for (_, role, text), kind in zip(rows, kinds):
        new = {}
        for state, (cost, audit, done) in table.items():
            ways = [(state, cost + 2, "D", done)]
            if kind not in ("blank", "duplicate"):
                extra = 5 * (kind == "truncated")
                ways.append((follow[state], cost + 1 + extra, "R", done + [(names[follow[state]], text)]))
                if role[:1] == follow[state] or (role[:1] == "s" and state == ""):
                    ways.append((role[:1], cost + extra, "K", done + [(role, text)]))
            for after, c, letter, d in ways:
                found = (c, audit + letter, d)
                new[after] = min(new.get(after, found), found)
        table = inserted(new)
    return min(table[s] for s in ("", "a") if s in table)


def expected(rows):
    out = []
    for conv, own in damage(rows).items():
        kinds = faults(own)
        cost, audit, done = cheapest(own, kinds)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in done))
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def conversations(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 14)):
            if rng.random() < 0.1:
                continue
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3]), role, rng.choice(["Yes.", "No!", "Why?", "cut", " \n", "x y. ", "é.\x0b"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_against_whole_solutions(spark, ranges):
    rows = conversations(ranges) + [(1000, k, ["user", "assistant"][k % 2], f"Line {k // 3}.") for k in range(150)]
    got = turn_repair.repair(turn_repair.damaged(frame(spark, rows)), ranges)
    assert result(got) == expected(rows)


def test_cheapest_is_cheapest():
    """The search against all edit strings of short conversations."""
    rng = random.Random(4)
    for _ in range(60):
        rows = [(k, rng.choice(["user", "assistant", "system"]), f"{k}" + rng.choice([".", ""])) for k in range(rng.randrange(0, 5))]
        kinds = faults(rows)
        best = None
        for letters in itertools.product(*[["K", "R", "D"]] * len(rows)):
            for gaps in itertools.product(range(3), repeat=len(rows) + 1):
                audit = "".join("I" * g + x for g, x in zip(gaps, (*letters, "")))
                state, cost, k = "", 5 * sum(gaps), 0
                for x in audit:
                    follow = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                    if x in "KRD":
                        cost += {"K": 0, "R": 1, "D": 2}[x] + 5 * (x != "D" and kinds[k] == "truncated")
                        role, k = rows[k][1][:1], k + 1
                        if x == "K" and role != follow and not (role == "s" and state == ""):
                            break
                        state = state if x == "D" else "s" if x == "K" and role == "s" else follow
                    else:
                        state = follow
                else:
                    if state in ("", "a"):
                        best = min(best or (cost, audit), (cost, audit))
        search = turn_repair.Search()
        for (_, role, _), kind in zip(rows, kinds):
            search.row(role[:1], kind in ("blank", "duplicate"), kind == "truncated")
        assert search.finish() == best


def test_memory_is_bounded_by_what_is_open():
    """Decided edits leave the tree: a long conversation keeps a few nodes."""
    search, widest = turn_repair.Search(emit=lambda letter: None), 0
    rng = random.Random(9)
    for k in range(20_000):
        search.row(rng.choice("uaus"), rng.random() < 0.1, rng.random() < 0.2)
        nodes = set()
        for _, node in search.live.values():
            while node is not search.root:
                nodes.add(id(node))
                node = node.up
        widest = max(widest, len(nodes))
    assert widest < 200 and len("".join(search.audit)) >= 19_000


def test_ties_are_compared_whole():
    """Two ways of equal cost that part early and stay open for long."""
    rows = [(0, "user", "a.")] + [(k, "assistant", f"b{k}.") for k in range(1, 60)]
    cost, audit, _ = cheapest(rows, faults(rows))
    search = turn_repair.Search()
    for _, role, _ in rows:
        search.row(role[:1], False, False)
    assert search.finish() == (cost, audit)


def test_edge_rows(spark):
    long = "word and more. " * 30_000
    rows = [(None, None, None, None), (None, 2, "user", "A."), (1, None, None, "x."), (1, None, "user", long), (1, 4, "user", long), (1, 4, "user", long), (2, 0, "", ""),
            (3, 5, "user", "same."), (3, 5, "user", "same."), (3, 5, "assistant", "same."), (4, 1, "usher", "Hm?"), (4, 2, "aid", "Ok!")]
    rows += [(c, t, "user", "Only.") for c in range(50, 250) for t in (0,)]
    wide = spark.createDataFrame([(*r, 7, "z", True) for r in rows], "conv_id long, turn long, role string, text string, n int, sha string, dropped boolean")
    assert result(turn_repair.digest(wide)) == expected(rows)
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in expected(rows))
    assert turn_repair.digest(wide.limit(0)).collect() == []


def test_repaired_rows(spark):
    rows = conversations(77, 30)
    damaged = turn_repair.damaged(frame(spark, rows))
    found = turn_repair.repaired_rows(damaged, turn_repair.repair(damaged, 9)).collect()
    want = [(c, k, r, t) for c, own in damage(rows).items() for k, (r, t) in enumerate(cheapest(own, faults(own))[2])]
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_given_conversations(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert result(turn_repair.digest(given)) == expected([(r.conv_id, r.turn, r.role, r.text) for r in given.collect()])
