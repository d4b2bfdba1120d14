"""The whole pipeline on a small table with awkward rows, against plain versions of its stages."""

import random
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from marquee.llm import bpe
from marquee.llm.mixing import OP10_SQL
from tests.llm.test_llm import LOREM, WORD

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, __key string, c0 int"


@pytest.fixture(scope="module")
def scratch(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))


@pytest.fixture(scope="module")
def corpus():
    """Texts in the order of their identifiers, and the toxic ones."""
    rng, texts, toxic = random.Random(11), [], set()
    for i in range(600):
        words = rng.choices(LOREM, k=60)
        if i % 8 == 0:
            words[rng.randrange(60)] = rng.choice(["idiot", "scum"])
            toxic.add(i)
        texts.append(" ".join(words))
    clean = [t for i, t in enumerate(texts) if i not in toxic]
    near = [" ".join([*t.split(" ")[:-2], "end", "here"]) for t in clean[:40]]
    texts += [*clean[100:130], *near, near[0], None, "", "", " \n", "one", "one two", "日本 😀 e\u0301"]
    return texts, toxic


def first_of_groups(texts):
    """The places of the texts that come first in their groups: runs of 5 words, similarity 0.8."""
    sets = []
    for text in texts:
        w = WORD.findall((text or "").lower())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(sets)))
    for a, one in enumerate(sets):
        for b in range(a):
            shared = len(one & sets[b])
            if shared and 100 * shared >= 80 * (len(one) + len(sets[b]) - shared):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return [n for n, x in enumerate(label) if x == n]


def written(spark, folder, texts, toxic):
    rows = [(i, t, None, ("a", "b", None, "a")[i % 4], None, "k", 1) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(min(600, len(texts)))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_agrees_with_plain_stages(spark, scratch, corpus, tmp_path):
    texts, toxic = corpus
    got = corpus_pipeline.run(spark, written(spark, tmp_path, texts, toxic)).collect()

    rest = [i for i in range(len(texts)) if i not in toxic]
    last = {}
    for i in rest:
        last[texts[i] or ""] = i
    rest = sorted(last.values())
    rest = [rest[n] for n in first_of_groups([texts[i] for i in rest])]

    documents = pa.table(  # noqa: F841, the SQL reads it
        {
            "doc_id": pa.array(rest, pa.int64()),
            "source": [("a", "b", None, "a")[i % 4] for i in rest],
            "text": pa.array([texts[i] for i in rest], pa.string()),
        }
    )
    mix = duckdb.sql(OP10_SQL).fetchall()
    times = {i: taken // size for i, size, _, _, taken in mix if size and taken}
    assert Counter(r["doc_id"] for r in got) == times
    model, _ = bpe.vocabulary()
    codec = bpe.Codec(*bpe.vocabulary())
    for r in got:
        assert r["source"] == ("a", "b", None, "a")[r["doc_id"] % 4]
        assert r["n_tokens"] == len(r["ids"]) == len(r["starts"])
        assert "".join(codec.decode_each(r["ids"])) == texts[r["doc_id"]]


def test_pipeline_without_documents(spark, scratch, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], set())).count() == 0
