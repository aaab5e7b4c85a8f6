"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements
and one failure bit per rule.  Versioned policies are masks over these bits,
so a policy is applied, compared or ablated by bit operations on the ledger,
without the texts.  All of it is built-in DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, let, written

WORD_BREAK = r"[\x20\x09-\x0D]+"

#: Measurements of a text, all long.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_chars", "n_lines", "n_upper", "n_lower", "n_digits", "n_exclaim")

#: (name, SQL condition on the measurements under which a document fails); a
#: rule's bit is its place here.  Rules are only ever added at the end.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_upper > 50 * (n_upper + n_lower) AND n_upper >= 40"),
    ("exclamations", "100 * n_exclaim > 50 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 16 * n_words"),
    ("digits", "100 * n_digits > 30 * n_chars"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}
#: The rules that reject whatever the policy.
BASE = BIT["few_words"] | BIT["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails any rule of ``hard``, or at least
    ``most_soft`` rules of ``soft``."""

    version: int
    hard: int
    soft: int = 0
    most_soft: int = 1

    def without(self, rule: str) -> Policy:
        return Policy(self.version, self.hard & ~BIT[rule], self.soft & ~BIT[rule], self.most_soft)

    def rejects(self, failed: Column) -> Column:
        soft = F.bit_count(failed.bitwiseAND(F.lit(self.soft))) >= self.most_soft if self.soft else F.lit(False)
        return (failed.bitwiseAND(F.lit(self.hard)) != 0) | soft


POLICIES = {
    1: Policy(1, BASE),
    2: Policy(2, BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["shouting"] | BIT["exclamations"],
              BIT["word_length"] | BIT["digits"], 2),
}
CURRENT = 2


def _count_of(text: Column, kept: str) -> Column:
    """Characters of ``text`` that are in the character class ``kept``."""
    return F.char_length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text (no words: empty array)."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more.  The
    windows' 64-bit hashes are sorted with their places; equal neighbours are
    repeats, and their windows' extent is summed over the sorted places."""
    def windows(hashes):
        return F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))), lambda h, i: F.struct(
            F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)).alias("h"), i.alias("i")))

    def repeated(ordered):
        same = lambda x, j: F.coalesce(F.get(ordered, j)["h"] == x["h"], F.lit(False))
        return F.filter(F.transform(ordered, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"])),
                        lambda i: i.isNotNull())

    def extent(starts):
        return F.aggregate(F.transform(starts, lambda s, j: F.coalesce(F.least(F.get(starts, j + 1) - s, F.lit(3)), F.lit(3))),
                           F.lit(0).cast("long"), lambda total, x: total + x)

    ordered = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.sort_array(windows(h)))
    return let(let(ordered, lambda o: F.sort_array(repeated(o))), extent)


def measured(text: Column) -> Column:
    """A struct of MEASURES; null text has no words."""
    text = F.coalesce(text, F.lit(""))
    words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    lines = let(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return let(F.struct(words.alias("w"), lines.alias("l")), lambda m: F.struct(
        m["w"]["n_words"].alias("n_words"), F.char_length(F.regexp_replace(text, WORD_BREAK, "")).cast("long").alias("word_chars"),
        _count_of(text, r"#*$%&|<>").alias("n_symbols"), m["l"]["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"), F.char_length(text).cast("long").alias("n_chars"),
        m["l"]["n_lines"].alias("n_lines"), _count_of(text, "A-Z").alias("n_upper"), _count_of(text, "a-z").alias("n_lower"),
        _count_of(text, "0-9").alias("n_digits"), _count_of(text, "!").alias("n_exclaim")))


def failure_bits(measures: str) -> Column:
    """The failed rules of a struct column of measurements, as a long."""
    bits = []
    for name, condition in RULES:
        for m in MEASURES:
            condition = condition.replace(m, f"{measures}.{m}")
        bits.append(f"IF({condition}, {BIT[name]}L, 0L)")
    return F.expr(" | ".join(bits))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed`` (bits) of every row.  Extra
    columns are ignored; repeated rows and null ids are kept."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), measured(F.col("text")).alias("m"))
            .select("doc_id", "m.*", failure_bits("m").alias("failed")))


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with base_failed, kept and the policy's version."""
    failed = F.col("failed")
    base = failed.bitwiseAND(F.lit(BASE)) != 0
    return (entries.withColumn("base_failed", base).withColumn("kept", ~base & ~policy.rejects(failed))
            .withColumn("policy", F.lit(policy.version)))


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """rule, failed, rejected_alone, kept_without: for every rule how many
    documents fail it, how many only it rejects, and how many the policy
    would keep without it.  Documents are first counted by failure mask, of
    which there are at most 2 ** len(RULES)."""
    masks = entries.groupBy("failed").agg(F.count("*").alias("n"))
    failed = F.col("failed")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    rows = [F.struct(F.lit(name).alias("rule"), total(failed.bitwiseAND(F.lit(BIT[name])) != 0).alias("failed"),
                     total(policy.rejects(failed) & ~policy.without(name).rejects(failed)).alias("rejected_alone"),
                     total(~policy.without(name).rejects(failed)).alias("kept_without")) for name, _ in RULES]
    return masks.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def overlaps(entries: DataFrame) -> DataFrame:
    """rule, never_without, ever_with: bits that every failing document of a
    rule shares, and bits any of them has."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in BIT.items()]))
    rows = entries.select("failed", each.alias("r")).filter(F.col("failed").bitwiseAND(F.col("r.bit")) != 0)
    return rows.groupBy("r.rule").agg(F.bit_and("failed").alias("never_without"), F.bit_or("failed").alias("ever_with"))


def judge(docs: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """The policy's verdict on every row, from a written ledger.  A null or
    empty text has no words and fails; texts are measured whole; null ids and
    repeated rows are judged each on their own; other columns are not looked
    at; an empty table gives no rows."""
    return apply_policy(written(ledger(docs), "quality-ledger"), policy)


def keep(docs: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, all columns unchanged;
    rows are judged as in ``judge``, repeated ones stay repeated."""
    bits = "__quality_failed"
    marked = docs.withColumn("__quality_m", measured(F.col("text"))).withColumn(bits, failure_bits("__quality_m"))
    return marked.filter((F.col(bits).bitwiseAND(F.lit(BASE)) == 0) & ~policy.rejects(F.col(bits))).select(*docs.columns)


def oracle(policy: Policy = POLICIES[CURRENT]) -> str:
    """DuckDB SQL for ``judge`` on the table ``documents``."""
    blank, count = r"[\x20\x09-\x0D]", lambda c: f"length(regexp_replace(t, '[^{c}]+', '', 'g'))"
    bits = " | ".join(f"CASE WHEN {condition} THEN {BIT[name]} ELSE 0 END" for name, condition in RULES)
    soft = f"bit_count(failed & {policy.soft}) >= {policy.most_soft}" if policy.soft else "false"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
places AS (
  SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS found FROM places),
covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE found > 1) GROUP BY rid),
measures AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '{blank}+', '', 'g')) AS word_chars,
         {count("#*$%&|<>")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, length(t) AS n_chars, len(lines) AS n_lines,
         {count("A-Z")} AS n_upper, {count("a-z")} AS n_lower, {count("0-9")} AS n_digits, {count("!")} AS n_exclaim
  FROM texts JOIN split USING (rid) LEFT JOIN covered USING (rid)),
bits AS (SELECT *, CAST({bits} AS BIGINT) AS failed FROM measures)
SELECT doc_id, {", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in MEASURES)}, failed,
       failed & {BASE} <> 0 AS base_failed,
       NOT (failed & {BASE} <> 0 OR failed & {policy.hard} <> 0 OR {soft}) AS kept,
       {policy.version} AS policy
FROM bits"""
