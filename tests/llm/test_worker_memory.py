"""What Python workers hold on to from one stage of the pipeline to the next."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tripwise.llm import common, neardup, packing
from tripwise.llm.queries import vocabulary
from tripwise.llm.tokens import WordEncoder


def distinct_words(n, seed=3):
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    return ["".join(w) for w in letters[np.random.default_rng(seed).integers(0, 26, (n, 9))]]


def test_remembered_words_take_few_bytes_each():
    words = distinct_words(30_000)
    encoder = WordEncoder(vocabulary("word_bpe_49k.json"))
    tracemalloc.start()
    for at in range(0, len(words), 3000):
        encoder.encode(pa.array([" ".join(words[at:at + 3000])]))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held / len(words) < 380  # lists of numbers: 474


def test_pieces_stay_within_the_bound_and_ids_are_the_librarys():
    words = [w.title() + "," for w in distinct_words(3000)]
    encoder = WordEncoder(vocabulary("word_bpe_49k.json"), cache_words=500)
    for at in (0, 1500, 0):
        text = " ".join(words[at:at + 1500])
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == encoder.library.encode(text, add_special_tokens=False).ids
        assert len(encoder.pieces) + len(encoder.older) <= 501


def test_a_stage_drops_what_workers_hold_from_another(spark):
    """Every task of near-duplicates frees the encoder that packing has left
    in its worker."""
    docs = spark.createDataFrame([(k, " ".join(distinct_words(20, k))) for k in range(8)], "doc_id long, text string").coalesce(1)
    packing.token_pieces(docs, vocabulary("word_bpe_49k.json")).collect()
    neardup.sketched(docs).collect()

    def held(batches):
        import sys
        module = sys.modules.get("_llm_worker_cache")
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(module.store) if module else 0], pa.int64())})

    # The idle worker that was last in use is taken first, as it was before.
    assert docs.mapInArrow(held, "n long").first().n == 0


def test_lean_passes_batches_on_and_keeps_on_request():
    common.worker_cache("mine", lambda: 1)
    assert list(common.lean([1, 2], keep=True)) == [1, 2]
    assert common.worker_cache("mine", lambda: 2) == 1
    assert list(common.lean([])) == []
    assert common.worker_cache("mine", lambda: 3) == 3
