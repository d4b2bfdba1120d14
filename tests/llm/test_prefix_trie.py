"""The prefix trie against plain sets of prefixes, and the radix tree against a dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

from marquee.llm.common import Work
from marquee.llm.prefix_trie import prefix_trie
from marquee.llm.radix import Node, insert


def strings(node, before=b""):
    here = before + node.prefix
    if node.value is not None:
        yield here, node.value
    for byte, below in node.pairs():
        yield from strings(below, here + bytes([byte]))


def test_radix_tree_lists_its_strings_in_order():
    rnd = random.Random(2)
    for most, layout in ((2, 4), (10, 16), (40, 48), (256, 256)):
        want = {bytes(rnd.randrange(most) for _ in range(rnd.randrange(5))): i for i in range(3000)}
        root = Node(b"")
        for key, value in want.items():
            insert(root, key, value)
        assert list(strings(root)) == sorted(want.items())
        assert root.layout == layout


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    final = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        final[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
        for d in range(len(final[c]) + 1):
            members[final[c][:d]].append(c)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(r[:-1] == q for r in below if r)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode().split()) for q in below if q)
        ended = ",".join(str(c) for c in sorted(who) if len(final[c]) == len(p))
        out.append(
            (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children), len(leaves), saved,
             hashlib.sha256(ended.encode()).hexdigest())
        )
    return sorted(out, key=str)


def found(spark, rows):
    schema = "conv_id long, turn long, role string, text string, node string, words int"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(4)
    return sorted(map(tuple, prefix_trie(df, Work(spark, "trie")).collect()), key=str)


def test_trie_equals_plain_prefixes(spark):
    rnd = random.Random(4)
    rows = []
    for c in range(130):
        if c == 40:
            continue  # a block without its first conversation
        for t in range(rnd.randrange(1, 6)):
            rows.append((c, t if t else None, rnd.choice(["u", "a", None]), rnd.choice(["x y", "x", None, "é \n z"])))
    rows += [(None, 0, "u", "lost")] * 50
    rnd.shuffle(rows)
    assert found(spark, rows) == plain_trie(rows)


def test_hot_first_turn_and_copies(spark):
    rows = [(c, t, "u", "same words here" if t < 2 or c % 3 else f"own {c}") for c in range(300) for t in range(3)]
    assert found(spark, rows) == plain_trie(rows)


def test_few_rows(spark):
    assert found(spark, []) == []
    one = [(20, 5, "u", "a b")]
    assert found(spark, one) == plain_trie(one)
