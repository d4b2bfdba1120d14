"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import whole_text


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the identifier as text falls into the part that is kept from training."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == part, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int) -> DataFrame:
    """``label`` (0 or 1), ``text`` and ``fold`` (0 to 1, the place in a fixed shuffle) of at most ``rows``
    labelled rows that ``train`` admits, taken in the order of the MD5 of the identifier. The labels are cut
    to ``rows`` before they are broadcast, so the broadcast has a fixed bound. Where identifiers repeat, so that
    their labels meet more rows than that, the first ``rows`` in that order and the order of reading remain."""
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    picked = (
        labels.where(train & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .select("doc_id", F.col(label).cast("int").alias("label"), order.alias("__order"))
        .orderBy("__order", "label")
        .limit(rows)
    )
    met = docs.select("doc_id", whole_text().alias("text"), F.monotonically_increasing_id().alias("__at")).join(
        F.broadcast(picked), "doc_id"
    )
    if met.count() > rows:
        place = ("__order", "label", "__at")
        first = met.select(*place).orderBy(*place).limit(rows)
        last = first.agg(F.max(F.struct(*place)).alias("last")).first()["last"]
        met = met.where(F.struct(*place) <= F.struct(*(F.lit(last[c]).alias(c) for c in place)))
    return met.select(
        "label",
        "text",
        (F.conv(F.substring("__order", 9, 8), 16, 10).cast("double") / 2.0**32).alias("fold"),
    )
