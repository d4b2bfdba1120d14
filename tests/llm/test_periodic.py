"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from marquee.llm.periodic import collapsed, find_runs, looped, periodic_runs, run_digests, runs_of_texts


def plain_runs(words):
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


@pytest.mark.parametrize("seed", range(300))
def test_runs_equal_a_plain_search(seed):
    rnd = random.Random(seed)
    words = [rnd.randrange(rnd.choice([1, 2, 3, 9])) for _ in range(rnd.randrange(90))]
    for _ in range(rnd.randrange(3)):
        at, cycle = rnd.randrange(len(words) + 1), [rnd.randrange(3) for _ in range(rnd.randrange(1, 13))]
        words[at:at] = (cycle * 9)[: rnd.randrange(4, 9 * len(cycle) + 1)]
    assert find_runs(np.array(words, np.int64)) == plain_runs(words)


def test_batches_keep_texts_apart():
    texts = [[b"a"] * 5, [b"a"] * 5, [], [b"a"] * 6, [b"a", b"b"] * 4, [b"x"]]
    assert runs_of_texts(texts) == [[], [], [], [(0, 6, 1)], [(0, 8, 2)], []]


def test_long_text_of_one_word_is_fast():
    n = 1_000_000
    assert find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]


def plain_loop(key, words):
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_rows(spark):
    rnd = random.Random(5)
    rows = [(i, " \n".join(rnd.choices(["a", "b", "é", "dd"], k=rnd.choice([0, 1, 7, 40, 300]))), "x") for i in range(200)]
    rows += [(None, "a " * 30, "y"), (3, None, "z"), (3, "\xa0 \x85", "z"), (-7, "q\tq q\x0bq q\rq", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    want = []
    for key, text, _ in rows:
        words = (text or "").encode().split()
        words = words if key is None else plain_loop(key, words)
        runs = plain_runs(words)
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want.append(
            (
                key,
                len(runs),
                *(best or (None,) * 3),
                1000 * best[1] // best[2] if best else None,
                hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
                hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest(),
            )
        )
    assert sorted(map(tuple, run_digests(docs).collect()), key=str) == sorted(want, key=str)
    plain = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert [tuple(r) for r in plain[None].runs] == [(0, 30, 1)] and plain[None].collapsed == "a"
    assert run_digests(docs.limit(0)).count() == 0


def test_looped_and_collapsed():
    words = [str(i).encode() for i in range(50)]
    for key in range(400):
        assert looped(key, words) == plain_loop(key, words)
    assert collapsed([b"a"] * 6 + [b"b"], [(0, 6, 1)]) == [b"a", b"b"]
