"""What Python workers hold of texts, while a task runs and after it: they outlive tasks and run those of later steps."""

import gc

import numpy as np
import pyarrow as pa

from marquee.llm import bpe, toxicity
from marquee.llm.common import portions


def test_tasks_leave_no_words_behind_in_workers(spark):
    docs = spark.createDataFrame([(i, f"some words {i} of {i * 7} texts") for i in range(400)], "doc_id long, text string")
    docs = docs.repartition(4)
    model, pattern = bpe.vocabulary()

    def held(arrow):
        for batch in arrow:
            codecs = [x for x in gc.get_objects() if isinstance(x, bpe.Codec)]
            words = sum(len(x.known) + len(x.seen) for x in codecs)
            yield pa.RecordBatch.from_arrays([pa.array([len(codecs)]), pa.array([words])], names=["codecs", "words"])

    for coded in (bpe.encode, bpe.digests):
        assert coded(docs, model, pattern).select("doc_id").count() == 400
        assert len(coded(docs, model, pattern).collect()) == 400
        left = docs.select("doc_id").mapInArrow(held, "codecs long, words long").collect()
        assert sum(r["codecs"] for r in left) > 0
        assert sum(r["words"] for r in left) == 0


def test_scores_of_words_are_remembered_within_a_bound():
    model = toxicity.Model({"bad": 2.0}, 1.0, 1.0, -1.0, 1.0)
    words = [f"w{i}" for i in range(250_000)]
    n, places, values, _ = model.known(" ".join([*words, "bad"]))
    assert (n, places.tolist(), values.tolist()) == (250_001, [250_000], [2.0])
    assert len(model.memo) <= toxicity.KNOWN_WORDS <= 100_000
    model.forget()
    assert len(model.memo) == 0 and model.known("a bad word")[2].tolist() == [2.0]


def test_portions_give_each_row_once_within_the_bound():
    rng = np.random.default_rng(5)
    for sizes in ([], [0], [0, 0, 0], [50], [50, 0, 50], rng.integers(0, 30, 500).tolist()):
        texts = ["é" * (n // 2) for n in sizes]
        whole = pa.RecordBatch.from_arrays(
            [pa.array(range(-3, len(texts)), pa.int64()), pa.array(["x" * 99] * 3 + texts, pa.string())], names=["doc_id", "text"]
        ).slice(3)
        parts = list(portions(whole, 1, 40))
        assert [t for p in parts for t in p.column(1).to_pylist()] == texts
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
        taken = [sum(len(t.encode()) for t in p.column(1).to_pylist()) for p in parts]
        assert all(total <= 40 or len(p) == 1 for total, p in zip(taken, parts))
        # No part could have taken the first row of the next.
        assert all(a + len(q.column(1)[0].as_py().encode()) > 40 for a, q in zip(taken, parts[1:]))
