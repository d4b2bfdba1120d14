"""Packing against the library's own ids and a plain reading of the rules."""

import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from marquee.llm.common import Work
from marquee.llm.fast_encode import Encoder
from marquee.llm.packing import pack, patterns_of, vocabulary

ODD = ["'s", "'re", "'ll", "  ", " ", "\n", "\t", "é", "中", "😀", "　", "<|endoftext|>", "a", "b", "1", "!", "'", "_"]


def library():
    own = Tokenizer.from_str(vocabulary())
    own.encode_special_tokens = True
    return own


def test_ids_equal_the_library():
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(25))) for _ in range(5000)]
    got = [ids.tolist() for ids in Encoder(vocabulary()).texts(pa.array(texts))]
    assert got == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(25))
def test_patterns_hold_every_token_once(seed):
    rnd = random.Random(seed)
    histogram = {k: rnd.choice([1, 2, 40]) for k in rnd.sample(range(1, 65), rnd.randrange(1, 60))}
    seen, padding, total = set(), 0, sum(k * n for k, n in histogram.items())
    for p in patterns_of(histogram, 64):
        assert 0 < p.used <= 64
        padding += p.count * (64 - p.used) * bool(p.used & (p.used - 1))
        for s in p.slots:
            new = {(s.length, s.first + i, t) for i in range(p.count) for t in range(s.start, s.stop)}
            assert not new & seen
            seen |= new
    assert len(seen) == total and padding * 64 <= total + padding
    assert all(rank < histogram[length] for length, rank, _ in seen)


def test_pieces_tile_documents_and_sequences(spark):
    rnd = random.Random(1)
    words = ["alpha", "beta's", "été", "1234", "\n", "x", "😀"]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([0, 1, 5, 60, 61, 3000]))) for _ in range(300)] + [None, ""]
    rows = [(i // 2, t, "x", 1) for i, t in enumerate(texts)] + [(None, "same text", "y", 2)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, length int").repartition(5)
    got = pack(docs, vocabulary(), Work(spark, "packing")).collect()
    want = defaultdict(int)
    own = library()
    for key, text, *_ in rows:
        want[key, len(own.encode(text or "", add_special_tokens=False).ids) + 1] += 1
    tokens = defaultdict(int)
    sequences = defaultdict(list)
    for r in got:
        tokens[r.doc_id, r.doc_tokens] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: n * k[1] for k, n in want.items()} == dict(tokens)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 1024
        padding += (1024 - at) * bool(at & (at - 1))
    assert padding <= sum(tokens.values()) / 60
    # Whole pieces of documents that are alone with their identifier and number of tokens.
    crc = {}
    for key, text, *_ in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        crc.setdefault((key, len(ids)), set()).add(tuple(ids))
    for r in got:
        same = crc[r.doc_id, r.doc_tokens]
        cuts = {zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[r.start : r.start + r.length])) for ids in same}
        assert r.ids_crc32 in cuts


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack(docs, vocabulary(), Work(spark, "packing")).count() == 0
