"""Landing files, raw datasets and small companions derived from the order tables with Spark.

One title per order (genres are the brands of its parts), a rating for every order that
has line items, a person per customer and block of order keys. NULLs, malformed years, empty genres and unrated titles come in by rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.skew import SplitPlan, heavy_parts, split_join
from marquee.plans.curation import curate, rating_splits, typed
from marquee.session import scratch_folder, small_tasks
from marquee.sources.datasets import read_dataset, write_dataset
from marquee.sources.text import write_tsv
from marquee.zones import LANDING, LANDING_FILES, RAW, Zones


# Order keys from which the known titles of one person come.
KEYS_PER_PERSON = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, key: str):
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 12, "0"))


def _attach(left: DataFrame, key: str, facts: DataFrame) -> DataFrame:
    """Left join with an aggregate that has one row per key; heavy left keys are split, which
    adaptive execution does not do next to an aggregate."""
    return split_join(left, facts, key, "left", SplitPlan.of(heavy_parts({"left": left}, key)))


def _gathered(df: DataFrame, key: str, counted: DataFrame | None = None) -> DataFrame:
    """The rows of each key in one task, for grouping. Keys have a few rows each, all over the table, so groups formed
    in the reading tasks would hold nearly all of its rows and spill. Where a key has too many rows for one task, they
    stay where they are and are grouped there first. ``counted`` is a cheaper frame with the same keys."""
    heavy = heavy_parts({"rows": df if counted is None else counted}, key)
    return df.repartition(key) if heavy is None else df


def title_basics_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = small_tasks(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    # Copies of a part would only multiply the line items before the set drops them again.
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand").distinct()
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    brands = (
        _gathered(lines.join(part, "p_partkey").drop("p_partkey"), "l_orderkey", lines)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.array_join(F.sort_array(F.collect_set("p_brand")), ",").alias("brands"))
    )
    key = F.col("o_orderkey")
    return _attach(orders, "o_orderkey", brands).select(
        _id("tt", "o_orderkey").alias("tconst"),
        F.when(F.col("o_orderstatus") == "F", "movie")
        .when(F.col("o_orderstatus") == "O", "short")
        .otherwise("tvSeries")
        .alias("titleType"),
        F.concat(
            "o_orderpriority",
            F.lit(" order "),
            key.cast("string"),
            F.when(key % 5 == 0, " with a deliberately long title that needs truncation").otherwise(""),
        ).alias("primaryTitle"),
        F.when(key % 17 == 0, None)
        .when(key % 97 == 0, "n/a")
        .otherwise((1880 + key % 151).cast("string"))
        .alias("startYear"),
        F.when(key % 9 == 0, (1890 + key % 151).cast("string")).alias("endYear"),
        F.when(key % 19 != 0, (40 + key % 160).cast("string")).alias("runtimeMinutes"),
        F.when(key % 29 == 0, F.concat("brands", F.lit(","))).otherwise(F.col("brands")).alias("genres"),
    )


def title_ratings_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = small_tasks(spark)
    quantity = F.sum("l_quantity").cast("bigint")
    return (
        _gathered(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), "l_orderkey")
        .groupBy("l_orderkey")
        .agg(quantity.alias("quantity"))
        .select(
            _id("tt", "l_orderkey").alias("tconst"),
            ((1 + F.col("quantity") * 7 % 90).cast("double") / 10).cast("string").alias("averageRating"),
            (F.col("quantity") * (1 + F.col("l_orderkey") % 50)).cast("string").alias("numVotes"),
        )
    )


def name_basics_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = small_tasks(spark)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    # A person per customer and block of order keys, so a customer's orders are all known titles,
    # and arithmetic bounds the set of one person.
    block = F.floor(F.col("o_orderkey") / KEYS_PER_PERSON).cast("bigint")
    known = (
        _gathered(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey")
        .groupBy(F.col("o_custkey").alias("c_custkey"), block.alias("block"))
        .agg(F.array_join(F.sort_array(F.collect_set(_id("tt", "o_orderkey"))), ",").alias("known"))
    )
    key = F.col("c_custkey")
    return _attach(customer, "c_custkey", known).select(
        F.concat(_id("nm", "c_custkey"), F.lit("-"), F.coalesce("block", F.lit(0)).cast("string")).alias("nconst"),
        F.col("c_name").alias("primaryName"),
        F.when(key % 23 == 0, None)
        .when(F.col("c_mktsegment") == "MACHINERY", "actor,producer")
        .when(F.col("c_mktsegment") == "BUILDING", "actress")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "casting_director")
        .when(F.col("c_mktsegment") == "FURNITURE", "writer,director")
        .otherwise("producer")
        .alias("primaryProfession"),
        F.col("known").alias("knownForTitles"),
    )


LANDING_VIEWS = {
    "title_basics": title_basics_txt,
    "title_ratings": title_ratings_txt,
    "name_basics": name_basics_txt,
}


CATALOGUE_TABLES = ("customer", "lineitem", "orders", "part")


def fingerprint(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """The number of files of the tables behind the catalogue and the sum of the hashes of their paths, lengths and
    times, from the file listing alone."""
    paths = [f"{sf_dir}/{name}.parquet" for name in CATALOGUE_TABLES]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    seen = F.xxhash64("path", "length", "modificationTime").cast("decimal(38, 0)")
    found = files.agg(F.count("*").alias("n"), F.coalesce(F.sum(seen), F.lit(0)).alias("sum")).first()
    return found["n"], int(found["sum"])


_looked: ContextVar[dict | None] = ContextVar("stages that the running query has looked at", default=None)


class Stage:
    """The catalogue of one set of tables. Each landing file and raw dataset is written once per
    Spark application and state of the tables, when a query first asks for it, and read from there by every query."""

    _known: dict[tuple[str, str], tuple[tuple[int, int], Stage]] = {}
    # Two threads must not write one folder.
    _lock = RLock()

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.zones = Zones(scratch_folder(spark, "catalogue", lasting=True))
        self._written: set[tuple[str, str]] = set()
        self._splits: SplitPlan | None = None
        self._run: Zones | None = None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Stage:
        """The stage of the tables as they are now; tables that have changed since get a new one. Within
        :meth:`one_look` the tables are looked at once, so all parts of a query see one state."""
        key, looked = (spark.sparkContext.applicationId, sf_dir), _looked.get()
        if looked is not None and key in looked:
            return looked[key]
        now = fingerprint(spark, sf_dir)
        with cls._lock:
            if key not in cls._known or cls._known[key][0] != now:
                cls._known[key] = now, cls(spark, sf_dir)
            stage = cls._known[key][1]
        if looked is not None:
            looked[key] = stage
        return stage

    @staticmethod
    @contextmanager
    def one_look() -> Iterator[None]:
        outer = _looked.get()
        token = _looked.set({} if outer is None else outer)
        try:
            yield
        finally:
            _looked.reset(token)

    def land(self, *names: str) -> Zones:
        """The zones with these landing files in place (all of them by default)."""
        with self._lock:
            for name in names or LANDING_FILES:
                if (LANDING, name) not in self._written:
                    self._land(self.zones, name)
                    self._written.add((LANDING, name))
        return self.zones

    def _land(self, zones: Zones, name: str) -> None:
        path = zones.path(LANDING, LANDING_FILES[name].file)
        # Small tasks write the parts, so one task can read each.
        write_tsv(LANDING_VIEWS[name](self.spark, self.sf_dir), path, "overwrite", "gzip")

    def raw(self, name: str) -> DataFrame:
        with self._lock:
            if (RAW, name) not in self._written:
                view = LANDING_VIEWS[name](self.spark, self.sf_dir)
                write_dataset(typed(view, name), self.zones, RAW, name)
                self._written.add((RAW, name))
        return read_dataset(self.spark, self.zones, RAW, name)

    def raw_zone(self) -> Zones:
        """The zones with every raw dataset in place."""
        for name in LANDING_FILES:
            self.raw(name)
        return self.zones

    def curated_run(self) -> Zones:
        """The zones that a whole run from landing files has filled, apart from the others."""
        with self._lock:
            if self._run is None:
                run = Zones(scratch_folder(self.spark, "run", lasting=True))
                for name in LANDING_FILES:
                    self._land(run, name)
                self._run = curate(self.spark, run)
        return self._run

    def splits(self) -> SplitPlan:
        """How to split the joins with the ratings."""
        if self._splits is None:
            self._splits = rating_splits(self.raw("title_ratings"))
        return self._splits


def breweries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A brewery list with its header line as the first data row, one brewery per supplier."""
    header = spark.range(1).select(
        *(F.lit(v).alias(c) for c, v in zip(BREWERY_COLUMNS, ("", "name", "city", "state", "id")))
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = (
        table(spark, sf_dir, "supplier")
        # Nations and regions are fixed dimension tables; Spark checks their size itself.
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("num"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("s_suppkey").cast("string").alias("id"),
        )
    )
    return header.unionByName(rows)


BREWERY_COLUMNS = ("num", "name", "city", "state", "id")
BREWERY_DDL = "num INT, name CHAR(100), city CHAR(100), state CHAR(100), id INT"
