"""Toxic spans and document scores with a linear-chain conditional random field.

Documents carry labels, tokens do not, so token labels are derived: a word
feature (the word, or its first 3 to 8 characters) is telling if it occurs
in more toxic than clean training documents by a likelihood ratio that so many
tested features would not reach by chance.  These counts cover every labelled
training row; a group of (near) copies counts about once, as the words of a
copied document are no more telling than those of a single one.  In toxic documents the tokens with a telling feature are
labelled toxic, all others are not.  On a bounded sample of labelled documents
a two-state chain is fitted; its forward-backward marginals give each token's
probability, spans with their offsets, and, through a logistic model on the
marginals, the document's score.

Labels are only learnt from rows whose crc32(doc_id) mod 3 is not 1.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .shingles import mixed, odd_numbers, shingle_hashes, smallest, word_hashes

PREFIXES = (3, 4, 5, 6, 7, 8)
#: Tokens of a chain: chains end at the end of a sentence or at this length.
CHAIN = 64
#: The sample the chain and the logistic model are fitted on, per label.
SAMPLE_DOCS = 800
#: The most telling features that the model keeps.
LEXICON = 50_000
#: A telling feature is at least so many times likelier in toxic documents (log).
LEAST_ODDS = 2.0
#: Copies share so many of so many least shingle hashes.
ALIKE, LEAST = 6, 8
#: Weight of a document that has no copies.
UNIT = 1_000_000
THRESHOLD = 0.7
EDGES = ".,;:!?\"'()[]{}*#$%&<>|-_"


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def normal(word: str) -> str:
    return word.strip(EDGES).lower()


def features_of(word: str) -> list[str]:
    """The features of a normalised word: itself and its beginnings."""
    return [f"w:{word}", *(f"{n}:{word[:n]}" for n in PREFIXES if len(word) >= n)] if word else []


def split_words(texts: pa.Array):
    """(distinct words, word number of each token, first token of each text)."""
    # The splitter's edges give empty words, which are dropped here.
    listed = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat = listed.flatten()
    owner = pc.list_parent_indices(listed).to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(full).dictionary_encode()
    counts = np.bincount(owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


# ---- telling features ------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the rows that may be learnt from."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return texts.filter(~held_out(F.col("doc_id"))).join(known, "doc_id")


def weighted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``weight``: UNIT over the size of a document's group of
    copies.  That size is the largest number of documents that share the same
    ALIKE of its LEAST least shingle hashes, so near copies are found too,
    and documents with a common passage are no copies."""
    numbered = common.written(rows.withColumn("uid", F.monotonically_increasing_id()), "toxic-rows")

    chosen = list(combinations(range(LEAST), ALIKE))

    def sketch(batches):
        schema = pa.schema([("uid", pa.int64()), ("key", pa.int64())])
        for batch in common.lean(batches):
            least = smallest(*shingle_hashes(*word_hashes(batch.column("text")), 3), odd_numbers(LEAST, 5))
            least = mixed(least + np.arange(LEAST, dtype=np.uint64))
            keys = np.stack([mixed(least[:, c].sum(axis=1, dtype=np.uint64) + np.uint64(k)) for k, c in enumerate(chosen)], axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("uid").to_numpy(), len(chosen)), pa.int64()),
                                              pa.array(keys.ravel(), pa.int64())], schema=schema)

    keys = numbered.select("uid", "text").mapInArrow(sketch, "uid long, key long")
    sizes = keys.join(keys.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("uid").agg(F.max("n").alias("n"))
    return numbered.join(sizes, "uid").withColumn("weight", F.greatest(F.expr(f"{UNIT} div n"), F.lit(1))).drop("uid", "n")


def feature_counts(rows: DataFrame) -> DataFrame:
    """feature, toxic, clean: documents of each label that have the feature,
    in UNITs, by weight."""
    def count(batches):
        schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
        for batch in common.lean(batches):
            words, which, offsets = split_words(batch.column("text"))
            if not len(which):
                continue
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            weight = batch.column("weight").to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(toxic)), np.diff(offsets))
            plain = [normal(w) for w in words]
            for n in (0, *PREFIXES):
                names = [(f"{n}:{w[:n]}" if len(w) >= n else "") if n else f"w:{w}" if w else "" for w in plain]
                coded = pa.array(names, pa.string()).dictionary_encode()
                feature = coded.indices.to_numpy().astype(np.int64)[which]
                pair = np.unique(doc * len(coded.dictionary) + feature)
                doc_of, feature = pair // len(coded.dictionary), pair % len(coded.dictionary)
                sums = [np.bincount(feature[own], weight[doc_of[own]], len(coded.dictionary)).astype(np.int64)
                        for own in (toxic[doc_of], ~toxic[doc_of])]
                out = pa.RecordBatch.from_arrays([coded.dictionary, pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64())], schema=schema)
                yield out.filter(pc.greater(pc.binary_length(coded.dictionary), 0))

    return (rows.select("text", "toxic", "weight").mapInArrow(count, "feature string, toxic long, clean long")
            .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def telling(counts: DataFrame, n_toxic: float, n_clean: float, lexicon: int = LEXICON) -> dict[str, float]:
    """The features that toxic documents have more often, with their smoothed
    log odds.  At most ``lexicon`` of them, the most telling ones."""
    t, c = F.col("toxic") / float(UNIT), F.col("clean") / float(UNIT)
    n = n_toxic + n_clean
    p = (t + c) / F.lit(float(n))

    def part(k, total):
        share = k / F.lit(float(max(total, 1e-9)))
        xlog = lambda x, r: F.when((x > 1e-9) & (r > 0), x * F.log(r)).otherwise(0.0)
        return xlog(k, share / p) + xlog(total - k, (1 - share) / (1 - p))

    tested = counts.filter(t >= 2.5)
    odds = F.log((t + 0.1) / (n_toxic + 0.2)) - F.log((c + 0.1) / (n_clean + 0.2))
    ratio = (2 * (part(t, n_toxic) + part(c, n_clean))).alias("ratio")
    tests = max(tested.count(), 1)
    found = (tested.select("feature", ratio, odds.alias("odds"))
             .filter((F.col("ratio") >= 2 * float(np.log(tests)) + 2) & (F.col("odds") >= LEAST_ODDS))
             .orderBy(F.desc("ratio"), "feature").limit(lexicon).collect())  # at most ``lexicon`` rows
    return {r.feature: r.odds for r in found}


# ---- the chain ---------------------------------------------------------------

def forward_backward(scores: np.ndarray, lengths: np.ndarray, chain: np.ndarray, start: np.ndarray):
    """Marginals of a two-state chain, for many chains side by side.

    ``scores`` [chains, positions] is state 1's score against state 0's;
    ``chain`` [2, 2] scores moves, ``start`` [2] beginnings.  Returns the
    probability of state 1, of each move [chains, positions - 1, 2, 2], and
    each chain's log partition sum.  Positions beyond a chain's end are 0.
    """
    n, width = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    ahead, back = np.zeros((n, width, 2)), np.zeros((n, width, 2))
    ahead[:, 0] = start + emit[:, 0]
    for t in range(1, width):
        ahead[:, t] = np.logaddexp(ahead[:, t - 1, 0, None] + chain[0], ahead[:, t - 1, 1, None] + chain[1]) + emit[:, t]
    rows, last = np.arange(n), lengths - 1
    total = np.logaddexp(*ahead[rows, last].T)
    for t in range(width - 2, -1, -1):
        after = back[:, t + 1] + emit[:, t + 1]
        step = np.logaddexp(chain[:, 0] + after[:, 0, None], chain[:, 1] + after[:, 1, None])
        back[:, t] = np.where((t < last)[:, None], step, 0.0)
    inside = np.arange(width) < lengths[:, None]
    p = np.where(inside, np.exp(np.minimum(ahead[:, :, 1] + back[:, :, 1] - total[:, None], 0)), 0.0)
    moves = np.exp(np.minimum(ahead[:, :-1, :, None] + chain + (emit + back)[:, 1:, None, :] - total[:, None, None, None], 0))
    return p, moves * inside[:, 1:, None, None], total


@dataclass
class Model:
    """The lexicon's log odds, the chain's weights and the score's weights."""

    lexicon: dict
    weights: np.ndarray  # of: 1, odds, telling, odds before, odds after
    chain: np.ndarray
    start: np.ndarray
    score: np.ndarray  # of: what score_inputs gives

    def odds(self, word: str) -> float:
        """The strongest log odds of a word's features; 0 if none is telling."""
        return max((self.lexicon[f] for f in features_of(normal(word)) if f in self.lexicon), default=0.0)


def token_inputs(odds: np.ndarray, chain_of: np.ndarray) -> np.ndarray:
    """Inputs of every token from its odds and its neighbours' in its chain."""
    same = chain_of[1:] == chain_of[:-1]
    before, after = np.zeros_like(odds), np.zeros_like(odds)
    before[1:] = np.where(same, odds[:-1], 0)
    after[:-1] = np.where(same, odds[1:], 0)
    return np.stack([np.ones_like(odds), odds / 5, (odds > 0).astype(float), before / 5, after / 5], axis=1)


def chains_of(ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Chain number of every token: a new one after a sentence's end, at the
    start of a text, and every CHAIN tokens."""
    n = len(ends)
    new = np.zeros(n, bool)
    new[1:] = ends[:-1]
    new[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    return np.cumsum(new | (place % CHAIN == 0)) - 1


def padded(values: np.ndarray, chain_of: np.ndarray):
    """(matrix of the chains, lengths, row and column of each token)."""
    first = np.searchsorted(chain_of, np.arange(chain_of[-1] + 1))
    column = np.arange(len(chain_of)) - first[chain_of]
    lengths = np.bincount(chain_of)
    out = np.zeros((len(lengths), int(lengths.max()), *values.shape[1:]))
    out[chain_of, column] = values
    return out, lengths, column


def fit_chain(inputs: np.ndarray, labels: np.ndarray, lengths: np.ndarray, counts: np.ndarray, steps: int = 250):
    """Weights, moves and start that maximise the labels' penalised conditional
    likelihood (Adam).  ``counts`` says how often each chain occurs."""
    inside = np.arange(labels.shape[1]) < lengths[:, None]
    width = inputs.shape[2]
    theta = np.concatenate([np.array([-4.0, 2.0, 2.0, 0.0, 0.0])[:width], [0, 0, 0, 0, 0, 0]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    y = labels.astype(int)
    pairs = np.stack([[(y[:, :-1] == a) & (y[:, 1:] == b) & inside[:, 1:] for b in (0, 1)] for a in (0, 1)])  # [2, 2, n, w]
    seen = np.einsum("abnw,n->ab", pairs.astype(float), counts)
    total = counts.sum()
    for step in range(1, steps + 1):
        w, chain, start = theta[:width], theta[width:width + 4].reshape(2, 2), theta[width + 4:]
        p, moves, _ = forward_backward(inputs @ w, lengths, chain, start)
        gap = np.where(inside, labels - p, 0) * counts[:, None]
        first = np.array([1 - p[:, 0], p[:, 0]]) - np.array([1 - labels[:, 0], labels[:, 0]])
        grad = np.concatenate([np.einsum("nw,nwk->k", gap, inputs),
                               (seen - np.einsum("nwab,n->ab", moves, counts)).ravel(), -(first * counts).sum(1)]) / total
        grad -= 1e-5 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:width], theta[width:width + 4].reshape(2, 2), theta[width + 4:]


def fit_score(inputs: np.ndarray, labels: np.ndarray, counts: np.ndarray, penalty: float = 0.02) -> np.ndarray:
    """Logistic regression by Newton steps; ``counts`` weighs the rows."""
    w = np.zeros(inputs.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(inputs @ w, -30, 30)))
        curve = (inputs * (counts * p * (1 - p))[:, None]).T @ inputs + penalty * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(curve, inputs.T @ (counts * (labels - p)) - penalty * w), -5, 5)
    return w


def linear(inputs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``inputs @ weights``, to the last bit the same for a row in any batch."""
    return (inputs * weights).sum(axis=1)


def marginals(model: Model, texts: pa.Array, odds_of=None):
    """(offsets of the texts' tokens, toxic probability of every token)."""
    words, which, offsets = split_words(texts)
    if not len(which):
        return offsets, np.zeros(0)
    odds_of = odds_of or model.odds
    odds = np.fromiter(map(odds_of, words), float, len(words))[which]
    ends = np.fromiter((w[-1] in ".!?" for w in words), bool, len(words))[which]
    chain_of = chains_of(ends, offsets)
    lengths = np.bincount(chain_of)
    # Chains without evidence only differ in length: one of each is solved.
    bare = np.ones(len(lengths), bool)
    bare[chain_of[odds > 0]] = False
    p = np.zeros(len(odds))
    column = np.arange(len(odds)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    plain = np.zeros((CHAIN, CHAIN, len(model.weights)))
    plain[:, :, 0] = 1
    by_length, _, _ = forward_backward(plain @ model.weights, np.arange(1, CHAIN + 1), model.chain, model.start)
    of_bare = bare[chain_of]
    p[of_bare] = by_length[lengths[chain_of[of_bare]] - 1, column[of_bare]]
    if not of_bare.all():
        told = ~of_bare
        inputs = token_inputs(odds, chain_of)[told]
        number = np.cumsum(~bare) - 1
        scores, own, place = padded(linear(inputs, model.weights), number[chain_of[told]])
        p[told] = forward_backward(scores, own, model.chain, model.start)[0][number[chain_of[told]], place]
    return offsets, p


def score_inputs(offsets: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Per text: 1, its largest marginal, and logs of their sum and density."""
    n = len(offsets) - 1
    out = np.zeros((n, 4))
    out[:, 0] = 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    np.maximum.at(out[:, 1], doc, p)
    total = np.bincount(doc, p, minlength=n)
    out[:, 2] = np.log1p(total)
    out[:, 3] = np.log1p(100 * total / np.maximum(np.diff(offsets), 20))
    return out


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on ``documents`` and ``labels``.  Without rows of both labels the
    model knows nothing and scores every text alike.

    Null texts are empty; rows without an id or a label are not learnt from; a
    document labelled more than once is toxic if one label says so; repeated
    rows and near copies count once, by weight; other columns are not looked at.
    The word list takes features of t >= 2.5, at most LEXICON of them, and the
    chain about ``sample_docs`` documents of each label."""
    common.bounded_batches(docs.sparkSession, size=4 << 20)
    rows = common.written(weighted(training_rows(docs, labels)), "toxic-training")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg((F.sum("weight") / float(UNIT)).alias("n")).collect()}  # two labels
    nothing = Model({}, np.array([-8.0, 0, 0, 0, 0]), np.zeros((2, 2)), np.zeros(2), np.array([-2.0, 0, 0, 0]))
    if not sizes.get(1) or not sizes.get(0):
        return nothing
    lexicon = telling(common.written(feature_counts(rows), "toxic-features"), sizes[1], sizes[0])
    # About ``sample_docs`` of each label, by a hash; copies count by weight.
    # Should the bound bite, both labels lose the rows last in hash order.
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(UNIT))
    bound = F.when(F.col("toxic") == 1, F.lit(sample_docs / sizes[1])).otherwise(F.lit(sample_docs / sizes[0])) * F.col("weight")
    sample = (rows.filter(draw < bound).orderBy(draw / bound, "doc_id", "text").select("text", "toxic")
              .limit(4 * sample_docs).collect())
    texts, toxic = pa.array([r.text for r in sample], pa.string()), np.array([r.toxic for r in sample], float)
    model = Model(lexicon, nothing.weights, nothing.chain, nothing.start, nothing.score)
    words, which, offsets = split_words(texts)
    if not lexicon or not len(which):
        return nothing
    odds = np.fromiter(map(model.odds, words), float, len(words))[which]
    ends = np.fromiter((w[-1] in ".!?" for w in words), bool, len(words))[which]
    chain_of = chains_of(ends, offsets)
    label = (odds > 0) & (np.repeat(toxic, np.diff(offsets)) == 1)
    lengths = np.bincount(chain_of)
    bare = np.ones(len(lengths), bool)
    bare[chain_of[odds > 0]] = False
    told = ~bare[chain_of]
    number = (np.cumsum(~bare) - 1)[chain_of[told]]
    plain_counts = np.bincount(lengths[bare], minlength=CHAIN + 1)[1:]
    plain = np.zeros((CHAIN, CHAIN, 5))
    plain[:, :, 0] = 1
    inputs, own = plain, np.arange(1, CHAIN + 1)
    y, counts = np.zeros((CHAIN, CHAIN)), plain_counts.astype(float)
    if told.any():
        with_inputs, own_told, _ = padded(token_inputs(odds, chain_of)[told], number)
        with_labels, _, _ = padded(label[told].astype(float), number)
        grow = CHAIN - with_labels.shape[1]
        inputs = np.concatenate([plain, np.pad(with_inputs, ((0, 0), (0, grow), (0, 0)))])
        y = np.concatenate([y, np.pad(with_labels, ((0, 0), (0, grow)))])
        own, counts = np.concatenate([own, own_told]), np.concatenate([counts, np.ones(len(own_told))])
    model.weights, model.chain, model.start = fit_chain(inputs, y, own, counts)
    # The sample's labels count as often as in all training rows.
    drawn = max(toxic.sum(), 1), max(len(toxic) - toxic.sum(), 1)
    share = np.where(toxic == 1, sizes[1] / drawn[0], sizes[0] / drawn[1])
    model.score = fit_score(score_inputs(*marginals(model, texts)), toxic, share * len(toxic) / share.sum())
    return model


# ---- scoring -----------------------------------------------------------------

def spans(text: str, p: np.ndarray, at_least: float = 0.5) -> list[tuple[int, int]]:
    """[start, end) character offsets of runs of probably toxic tokens."""
    out: list[tuple[int, int]] = []
    run = False
    for word, probable in zip(re.finditer(r"[^\x20\x09-\x0D]+", text), (p >= at_least).tolist()):
        if probable and run:
            out[-1] = (out[-1][0], word.end())
        elif probable:
            out.append(word.span())
        run = probable
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with toxic_score (0 to 1) and toxic_spans (character offsets)
    appended to its columns; only the text is looked at.  Null, empty and
    blank texts get the score of a text without evidence."""
    common.bounded_batches(docs.sparkSession, size=4 << 20)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    wanted = T.StructType([*docs.schema.fields, T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_spans", T.ArrayType(span))])
    text_at = docs.columns.index("text")
    # Plain values, which need no class to unpickle; the lexicon's size is bounded.
    shared = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.weights, model.chain, model.start, model.score))

    def run(batches):
        model = Model(*shared.value)
        known: dict[str, float] = {}

        def odds_of(word):
            found = known.get(word)
            if found is None:
                if len(known) >= 300_000:
                    known.clear()
                found = known[word] = model.odds(word)
            return found

        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in common.lean(batches):
            texts = batch.column(text_at)
            offsets, p = marginals(model, texts, odds_of)
            inputs = score_inputs(offsets, p)
            scores = 1 / (1 + np.exp(-np.clip(linear(inputs, model.score), -30, 30)))
            found = [[] for _ in range(len(texts))]
            for k in np.flatnonzero(inputs[:, 1] >= 0.5).tolist():
                found[k] = [{"start": a, "end": b} for a, b in spans(texts[k].as_py(), p[offsets[k]:offsets[k + 1]])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array(found, kind)],
                                             names=[*batch.schema.names, "toxic_score", "toxic_spans"])

    return docs.mapInArrow(run, wanted)


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every row.  A null or
    empty text has a score too; texts are read whole; null ids are not held
    out; repeated rows are scored each; an empty table gives no rows."""
    found = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("toxic_score").alias("score"),
                        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"), F.col("toxic_spans").alias("spans"))


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, columns unchanged."""
    own = [F.col(c).alias(f"_{k}") for k, c in enumerate(docs.columns)]
    rows = score(docs.select(F.col("text"), F.struct(*own).alias("row")), model).filter(F.col("toxic_score") < THRESHOLD)
    return rows.select(*[F.col(f"row._{k}").alias(c) for k, c in enumerate(docs.columns)])
