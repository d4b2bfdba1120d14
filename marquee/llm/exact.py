"""Exact deduplication as a stream with keyed state that never expires.

The stream reads a folder of documents. Its state, kept by RocksDB on the disks of the executors and
in the checkpoint folder, has one entry per digest: how many rows arrived, the largest identifier, and where the
content of that row lies (file and row). A row whose digest others share is a hit, and its full bytes are
compared with the kept content, which is fetched by that locator.

Defined results: NULL text counts as empty. Of equal texts the row with the largest identifier stays, a
NULL identifier only where there is no other. Rows with one identifier and one text are one group whose rows all
give a line; the one that stays is still named by its identifier, so each of them counts as kept.
Only the identifier and the text are read, so other columns cannot clash. No rows give no groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Work, digest, whole_text

# State on disk, of which each step stores what it changed; no space is set aside per partition.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
GROUP = "digest string, n long, keep struct<id: long, file: string, row: long>"


def arrivals(frame: DataFrame, key: str, text: str, content: Callable[[Column], Column]) -> DataFrame:
    """Identifier, digest and locator of the rows of a scan, and the text for those who need it."""
    whole = whole_text(text)
    return frame.select(
        content(whole).alias("digest"),
        F.col(key).cast("bigint").alias("id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        whole.alias("text"),
    )


def update_state(
    spark: SparkSession,
    folder: str,
    work: Work,
    key: str = "doc_id",
    text: str = "text",
    content: Callable[[Column], Column] = digest,
) -> DataFrame:
    """Take the files of ``folder`` that the state has not seen, and give its entries that they
    changed, ``GROUP``. ``work`` holds the state; a later call with it goes on where this one ended."""
    schema = spark.read.parquet(folder).select(key, text).schema
    # As a pattern, which the name itself matches, the path may be that of a single file.
    pattern = f"{folder.rstrip('/')[:-1]}[{folder.rstrip('/')[-1]}]"
    stream = arrivals(spark.readStream.schema(schema).parquet(pattern), key, text, content)
    state = stream.groupBy("digest").agg(
        F.count("*").alias("n"), F.max(F.struct("id", "file", "row")).alias("keep")
    )
    changed = work.path("changed")

    def put(batch: DataFrame, number: int) -> None:
        # One folder for each batch, so that a batch that runs again replaces what it wrote.
        batch.write.mode("overwrite").parquet(f"{changed}/batch={number}")

    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        run = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", work.path("state"))
            .trigger(availableNow=True)
            .foreachBatch(put)
            .start()
        )
        run.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if run.lastProgress is None and not run.recentProgress:
        return spark.createDataFrame([], GROUP)
    # An entry only grows, so its last state is its largest.
    return (
        spark.read.schema(f"{GROUP}, batch int").parquet(changed)
        .groupBy("digest").agg(F.max(F.struct("n", "keep")).alias("last"))
        .select("digest", "last.n", "last.keep")
    )


def groups(
    spark: SparkSession,
    folder: str,
    work: Work,
    key: str = "doc_id",
    text: str = "text",
    content: Callable[[Column], Column] = digest,
) -> DataFrame:
    """One row per row of the Parquet table ``folder``: its locator ``file`` and ``row``, ``id``,
    ``digest``, ``keep_id``, ``group_size``, ``kept``."""
    state = work.stored(update_state(spark, folder, work, key, text, content), "groups")
    rows = arrivals(spark.read.parquet(folder), key, text, content)
    # The bytes of every hit against those that the state points to; digests that do not tell
    # texts apart come out, of which a cryptographic digest has none.
    hits = state.where(F.col("n") > 1).select("digest", "keep")
    met = work.stored(
        rows.join(hits, "digest").select(
            "digest", "text", (F.struct("file", "row") == F.struct("keep.file", "keep.row")).alias("held")
        ),
        "hits",
    )
    held = met.where("held").select("digest", F.col("text").alias("content"))
    unlike = work.stored(
        met.where("not held").join(held, "digest").where(F.col("text") != F.col("content")).select("digest"),
        "unlike",
    )
    narrow = rows.drop("text")
    if unlike.isEmpty():
        out = narrow.join(state, "digest", "left")
    else:
        # The texts themselves tell these groups apart.
        exact = rows.join(unlike, "digest", "left_semi")
        apart = exact.groupBy("digest", "text").agg(
            F.count("*").alias("n"), F.max(F.struct("id", "file", "row")).alias("keep")
        )
        # Reading them back lets the join split digests with many rows.
        apart = work.stored(apart, "apart")
        out = (
            narrow.join(unlike, "digest", "left_anti").join(state, "digest", "left")
            .unionByName(exact.join(apart, ["digest", "text"]).drop("text"))
        )
    return out.select(
        "file",
        "row",
        "id",
        "digest",
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep.id")).alias("kept"),
        (F.struct("file", "row") == F.struct("keep.file", "keep.row")).alias("first"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the one that stays of its group of equal texts."""
    found = groups(spark, f"{sf_dir}/documents.parquet", Work(spark, "exact"))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("digest").alias("text_sha256"),
    )


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay of each group of equal texts, with all their columns. The input is
    written first, since the state points into files."""
    work = Work(spark, "exact-stage")
    work.stored(docs.withColumnRenamed("_metadata", "metadata"), "input")
    folder = work.path("input")
    kept = groups(spark, folder, work).where("first").select(
        F.col("file").alias("__file"), F.col("row").alias("__row")
    )
    rows = spark.read.schema(docs.schema).parquet(folder)
    located = rows.select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"), "*"
    )
    return located.join(kept, ["__file", "__row"], "left_semi").select(*docs.columns)
