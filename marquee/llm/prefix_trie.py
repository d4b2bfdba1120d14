"""Prefix trie of conversations: a node for every distinct sequence of first turns.

A turn's id is the first 128 bits of the SHA-256 of its role and text, as 16 big-endian bytes; a conversation is the string of its
ids. Equal conversations are merged first. The strings are range-partitioned in byte order, so that a first turn that many
conversations share is spread over tasks, and each task puts its strings into an adaptive radix tree. Depths in bytes that
are multiples of 16 are nodes of the trie, all others are none.

A node whose prefix neither the first nor the last string of a task has lies in that task alone, and its figures are
final. The other nodes (no more than twice the turns of a conversation per task) are open: their parts are summed over
the tasks, and what hangs on open children is summed along their paths. Members that end in a node are sorted by range,
joined to stretches of text, and these are hashed in order, so no list of members is ever held.

Defined results: rows without ``conv_id`` belong to no conversation and are left out. NULL roles and texts are empty. Turns with the
same number are in the order of their ids. A conversation without turns is a member of the root. An empty table gives no
nodes, not even a root. Only the four named columns are read, so others cannot clash. The ids of one conversation's turns
must fit into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import WORD, Work, table
from marquee.llm.radix import Node, insert

WIDTH = 16
# Conversations in a block share the first turns of the block's first one.
BLOCK, SHARED = 20, 4
# Identifiers in one stretch of text.
STRETCH = 4096
# A node with many children is copied so often for the join that tells them its identifier.
COPIES = 16
ROOT = hashlib.sha256(b"").hexdigest()[: 2 * WIDTH]


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``: id (hexadecimal) and number of words of each turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # With the length in front no two pairs of role and text look alike.
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.left(F.sha2(whole.cast("binary"), 256), F.lit(2 * WIDTH)).alias("id"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("bigint").alias("words"),
    )
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """The conversations with their first turns replaced by those of the first conversation of their block."""
    first = lists.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    head = F.coalesce("head", F.slice("turns", 1, 0))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return (
        lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
        .join(first, "base", "left")
        .select("conv_id", F.concat(F.slice(head, F.lit(1), h), own).alias("turns"))
    )


def walk(keys: list[tuple[bytes, int, int, list[int]]]) -> Iterator[tuple]:
    """The nodes of sorted strings with their numbers of conversations, least conversation and words of each turn.
    Per node: id, parent's id, depth, n, least conversation, words of the last turn, then children, leaves and saved
    tokens, and the ids of the path if the node is open. Figures of an open node are those of its final children."""
    root = Node(b"")
    for key, n, least, words in keys:
        insert(root, key, (n, least, words))
    boundary = {ROOT}
    for key, *_ in (keys[0], keys[-1]):
        state = hashlib.sha256()
        for at in range(0, len(key), WIDTH):
            state.update(key[at : at + WIDTH])
            boundary.add(state.hexdigest()[: 2 * WIDTH])
    names, state, tail = [ROOT], hashlib.sha256(), b""
    # A frame: node, its children still to come, what to go back to, and the sums of the children so far:
    # n, least, words, topmost nodes, leaves, saved.
    frames: list[list] = []

    def enter(node: Node, edge: bytes) -> None:
        nonlocal state, tail
        back = (len(names), state, tail)
        tail += edge
        if len(tail) >= WIDTH:
            state = state.copy()
        while len(tail) >= WIDTH:
            state.update(tail[:WIDTH])
            names.append(state.hexdigest()[: 2 * WIDTH])
            tail = tail[WIDTH:]
        n, least, words = node.value or (0, None, None)
        frames.append([node, node.pairs(), back, n, least, words, 0, 0, 0])

    enter(root, b"")
    while frames:
        frame = frames[-1]
        step = next(frame[1], None)
        if step is not None:
            enter(step[1], bytes([step[0]]) + step[1].prefix)
            continue
        frames.pop()
        (known, state, tail), n, least, words, tops, leaves, saved = frame[2], *frame[3:]
        bottom = 0 if not frames else known
        for depth in range(len(names) - 1, bottom - 1, -1):
            name = names[depth]
            parent = names[depth - 1] if depth else None
            size = words[depth - 1] if depth else 0
            if name in boundary:
                yield name, parent, depth, n, least, size, tops, leaves, saved, names[: depth + 1]
                tops = leaves = saved = 0
            else:
                leaves = leaves or 1
                saved += (n - 1) * size
                yield name, parent, depth, n, least, size, tops, leaves, saved, None
                tops = 1
        del names[known:]
        if frames:
            up = frames[-1]
            up[3] += n
            up[4] = least if up[4] is None else min(up[4], least)
            up[5] = up[5] or words
            up[6] += tops
            up[7] += leaves
            up[8] += saved


_COLUMNS = {
    "node": "string", "parent": "string", "depth": "long", "n_convs": "long", "conv_id": "long", "words": "long",
    "n_children": "long", "n_leaves": "long", "saved_tokens": "long", "path": "array<string>", "parent_conv_id": "long",
}
NODES = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())
_ARROW = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}


def _trees(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = [tuple(row.values()) for batch in arrow for row in batch.to_pylist()]
    if not keys:
        return
    keys.sort(key=lambda k: k[0])
    rows = list(walk(keys))
    # Of a final node below an open one the parent's identifier is found later.
    least = {r[0]: r[4] for r in rows if r[9] is None}
    for at in range(0, len(rows), 10_000):
        columns = list(zip(*((*r, least.get(r[1])) for r in rows[at : at + 10_000])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, _ARROW[k]) for c, k in zip(columns, _COLUMNS.values())], names=list(_COLUMNS)
        )


def _stretches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted members to stretches of text: node, least identifier, identifiers joined by commas."""
    node, ids = None, []

    def row() -> pa.RecordBatch:
        listed = ",".join(map(str, ids))
        return pa.RecordBatch.from_pydict({"node": [node], "least": pa.array([ids[0]], pa.int64()), "listed": [listed]})

    for batch in arrow:
        for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (name != node or len(ids) == STRETCH):
                yield row()
                ids = []
            node = name
            ids.append(conv)
    if ids:
        yield row()


def _hashes(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted stretches to a digest per node."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})

    for batch in arrow:
        for name, listed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node:
                if state:
                    yield row()
                node, state = name, hashlib.sha256(listed.encode())
            else:
                state.update(b"," + listed.encode())
    if state:
        yield row()


def ends(members: DataFrame) -> DataFrame:
    """Per node the digest of its members' identifiers in numerical order, from rows ``node``, ``conv_id``."""
    ranges = members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    stretches = ranges.mapInArrow(_stretches, "node string, least long, listed string")
    return stretches.repartition("node").sortWithinPartitions("node", "least").mapInArrow(
        _hashes, "node string, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame, work: Work) -> DataFrame:
    """A row per node of the trie of the rebuilt conversations."""
    lists = work.stored(turn_lists(conversations), "lists")
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    members = work.stored(
        rebuilt(lists).select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
        .withColumn("node", F.left(F.sha2("key", 256), F.lit(2 * WIDTH))),
        "members",
    )
    distinct = members.groupBy("key").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("words").alias("words")
    )
    nodes = work.stored(distinct.repartitionByRange("key").mapInArrow(_trees, NODES), "nodes")

    parts = nodes.where("path IS NOT NULL")
    open_nodes = work.stored(
        parts.groupBy("node", "parent", "depth").agg(
            F.min("conv_id").alias("conv_id"), F.first("words").alias("words"), F.first("path").alias("path"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        ),
        "open",
    )
    more = open_nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    met = open_nodes.join(more, "node", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    )
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    below = (
        met.select(
            F.explode("path").alias("node"),
            (F.col("n_leaves") + leaf).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        )
        .groupBy("node")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    named = open_nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    copies = named.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    solved = met.drop("n_leaves", "saved_tokens").join(below, "node").withColumn("parent_conv_id", F.lit(None).cast("bigint"))

    figures = ["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole = nodes.where("path IS NULL").select(figures).unionByName(solved.select(figures))
    whole = whole.withColumn("copy", F.pmod(F.xxhash64("node"), F.lit(COPIES)).cast("int"))
    missing = F.col("parent_conv_id").isNull()
    told = (
        whole.where(missing).join(copies, ["parent", "copy"], "left")
        .withColumn("parent_conv_id", F.col("above")).drop("above")
        .unionByName(whole.where(~missing))
    )
    none = hashlib.sha256(b"").hexdigest()
    return told.join(ends(members.select("node", "conv_id")), "node", "left").select(
        *figures[2:], F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"), Work(spark, "trie"))
