"""Grouping and sorting in tasks small enough to need no disk."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.operators import skew
from marquee.plans import curation
from marquee.session import small_tasks
from marquee.suite.views import LANDING_VIEWS
from marquee.zones import CURATED, RAW, Zones

READ = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def tables(spark, tmp_path):
    """Keys with a few rows each, all over the tables, one of them NULL and one row twice."""
    n = 2000
    key = F.when(F.col("id") == 7, None).otherwise(F.col("id") * 7 % 500)
    lineitem = spark.range(n).select(
        key.alias("l_orderkey"), (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 50).cast("double").alias("l_quantity")
    )
    orders = spark.range(600).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 30).alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    made = {
        "lineitem": lineitem.union(lineitem.limit(1)),
        "orders": orders,
        "part": spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("B"), F.col("id")).alias("p_brand")),
        "customer": spark.range(35).select(
            F.col("id").alias("c_custkey"), F.lit("name").alias("c_name"), F.lit("MACHINERY").alias("c_mktsegment")
        ),
    }
    for name, df in made.items():
        df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def kept(df):
    return sorted(map(str, df.collect()))


def test_groups_are_formed_after_the_shuffle(spark, tables):
    lines = plan(LANDING_VIEWS["title_ratings"](spark, tables)).splitlines()
    shuffle = [i for i, line in enumerate(lines) if "Exchange" in line]
    groups = [i for i, line in enumerate(lines) if "Aggregate" in line]
    # Lower lines run first.
    assert len(shuffle) == 1 and groups and max(groups) < shuffle[0]
    for name in ("title_basics", "name_basics"):
        assert "REPARTITION_BY_COL" in plan(LANDING_VIEWS[name](spark, tables))


@pytest.mark.parametrize("name", sorted(LANDING_VIEWS))
def test_a_heavy_key_is_grouped_where_it_is_read(spark, tables, monkeypatch, name):
    usual = kept(LANDING_VIEWS[name](spark, tables))
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 1)
    df = LANDING_VIEWS[name](spark, tables)
    assert "REPARTITION_BY_COL" not in plan(df)
    assert kept(df) == usual


def test_small_tasks_keep_the_settings_of_the_session(spark):
    before = spark.conf.get(READ)
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        small = small_tasks(spark)
        assert small.conf.get(READ) == "16m" and spark.conf.get(READ) == before
        assert small.conf.get("spark.sql.shuffle.partitions") == "3"
        assert small.conf.get("spark.sql.session.timeZone") == "UTC"
        spark.conf.set(READ, "1m")
        assert small_tasks(spark).conf.get(READ) == "1m"
    finally:
        spark.conf.unset(READ)
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_sorts_of_a_run_read_little(spark, tables, tmp_path, monkeypatch):
    zones = Zones(str(tmp_path / "zones"))
    for name, view in LANDING_VIEWS.items():
        df = curation.typed(view(spark, tables), name)
        df.repartition(6).write.parquet(zones.path(RAW, name))
    sizes = {READ: "64k", "spark.sql.files.openCostInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    monkeypatch.setattr(session, "SMALL_READS", sizes)
    curation.raw_to_curated(spark, zones)
    stored = spark.read.parquet(zones.path(CURATED, "title_with_ratings_nopartition"))
    decades = spark.read.parquet(zones.path(CURATED, "title_by_decade"))
    # A reading task writes a file; 4 shuffle partitions, 4 files of the join, none read together.
    assert len(decades.inputFiles()) >= len(stored.inputFiles()) >= 4
    assert decades.count() == stored.count() == 600
