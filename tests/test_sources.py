"""Landing files, text, Parquet and catalog tables."""

import uuid

import pytest
from pyspark.errors import AnalysisException

from marquee.session import build_session, scratch_folder
from marquee.sources import tables, text
from marquee.sources.datasets import collect_report, read_dataset, write_dataset
from marquee.zones import CURATED, LANDING, Zones

AWKWARD = [
    "tconst\ttitleType\tprimaryTitle\tstartYear\tgenres",
    "tt1\tmovie\tPlain\t1999\tDrama,Comedy",
    'tt2\tmovie\t"Giliap"\t1975\t\\N',
    'tt3\tmovie\t"Half\t2001\tDrama',
    'tt4\tmovie\t"Rome" and more\t2003\tAction',
    "tt5\tmovie\t\tabc\t",
    'tt6\tshort\tA\\"B\t-5\tDrama,,X',
    "tt7\tmovie\tshort",
]


@pytest.fixture
def awkward(tmp_path):
    path = tmp_path / "awkward.tsv"
    path.write_text("\n".join(AWKWARD) + "\n")
    return str(path)


def test_tsv_without_quoting(spark, awkward):
    rows = {r["tconst"]: tuple(r)[2:] for r in text.read_tsv(spark, awkward).collect()}
    assert rows == {
        "tt1": ("Plain", "1999", "Drama,Comedy"),
        "tt2": ('"Giliap"', "1975", None),
        "tt3": ('"Half', "2001", "Drama"),
        "tt4": ('"Rome" and more', "2003", "Action"),
        "tt5": (None, "abc", None),
        "tt6": ('A\\"B', "-5", "Drama,,X"),
        "tt7": ("short", None, None),
    }


def test_tsv_with_quoting(spark, awkward):
    rows = {r["tconst"]: r for r in text.read_tsv(spark, awkward, quote='"').collect()}
    assert rows["tt2"]["primaryTitle"] == "Giliap"
    assert rows["tt3"]["startYear"] is None


def test_tsv_requires_columns(spark, awkward):
    with pytest.raises(ValueError, match="runtimeMinutes"):
        text.read_tsv(spark, awkward, ("tconst", "runtimeMinutes"))


def test_tsv_refuses_files_with_other_headers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "d" / "2.tsv").write_text("b\ta\n2\t1\n")
    with pytest.raises(Exception, match="header"):
        text.read_tsv(spark, str(tmp_path / "d")).collect()


def test_tsv_round_trip(spark, awkward, tmp_path):
    df = text.read_tsv(spark, awkward)
    text.write_tsv(df, str(tmp_path / "copy"))
    again = text.read_tsv(spark, str(tmp_path / "copy"))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_positional_csv_keeps_the_header_as_data(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text(",name,city,state,id\n0,NorthGate,Minneapolis,MN,0\n")
    df = text.read_csv_positional(spark, str(path))
    assert df.columns == ["_c0", "_c1", "_c2", "_c3", "_c4"]
    assert [tuple(r) for r in df.collect()] == [
        (None, "name", "city", "state", "id"),
        ("0", "NorthGate", "Minneapolis", "MN", "0"),
    ]


def test_external_table(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "b.csv").write_text(",name,id\n7,Big Lake,7\n")
    database = f"t_{uuid.uuid4().hex}"
    tables.ensure_database(spark, database, str(tmp_path / "db"))
    try:
        assert spark.catalog.currentDatabase() == database
        tables.ensure_database(spark, database)
        ddl = "num INT, name CHAR(10), id INT"
        df = tables.create_external_csv_table(spark, f"{database}.b", ddl, str(tmp_path / "data"))
        assert [tuple(r) for r in df.collect()] == [
            (None, "name      ", None),
            (7, "Big Lake  ", 7),
        ]
        tables.create_external_csv_table(spark, f"{database}.b", ddl, str(tmp_path / "data"))
        assert database in [r["namespace"] for r in tables.list_databases(spark).collect()]
        spark.sql(f"DROP TABLE {database}.b")
        assert (tmp_path / "data" / "b.csv").exists()
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_external_table_with_another_separator(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x").write_text("1|it's\n2|\"half\n3|\"a|b\"\n")
    name = f"t_{uuid.uuid4().hex}"
    ddl = "n INT, s STRING"
    df = tables.create_external_csv_table(spark, name, ddl, str(tmp_path / "p"), "|")
    assert [tuple(r) for r in df.collect()] == [(1, "it's"), (2, '"half'), (3, '"a')]
    spark.sql(f"DROP TABLE {name}")
    df = tables.create_external_csv_table(spark, name, ddl, str(tmp_path / "p"), "|", "'")
    assert df.count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", None)], "word string, n bigint")
    path = str(tmp_path / "out")
    text.write_lines(df, path)
    assert sorted(r["value"] for r in text.read_lines(spark, path).collect()) == ["a\t", "b\t2"]
    with pytest.raises(AnalysisException):
        text.write_lines(df, path)
    text.write_lines(df.limit(1), path, mode="overwrite")
    assert text.read_lines(spark, path).count() == 1


def test_dataset_overwrite(spark, tmp_path):
    zones = Zones(str(tmp_path))
    for n in (5, 3):
        write_dataset(spark.range(n), zones, CURATED, "numbers")
    assert read_dataset(spark, zones, CURATED, "numbers").count() == 3


def test_collect_report_refuses_to_cut(spark):
    assert len(collect_report(spark.range(3), 3)) == 3
    with pytest.raises(ValueError):
        collect_report(spark.range(4), 3)


def test_preview(spark):
    assert text.preview(spark.range(100)).count() == 20


def test_zone_paths():
    zones = Zones("hdfs://host:9000/", "catalogue")
    assert zones.path(LANDING, "x.tsv") == "hdfs://host:9000/landing/catalogue/x.tsv"
    assert zones.path(CURATED) == "hdfs://host:9000/curated/catalogue"
    with pytest.raises(ValueError):
        zones.path("bronze")


class Session:
    """Stands for a session with the given settings."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)


def test_scratch_folder_follows_the_session(spark):
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
    shared = Session(spark_master="yarn", spark_checkpoint_dir="hdfs://host/shared/")
    one, two = scratch_folder(shared, "x"), scratch_folder(shared, "x")
    assert one.startswith("hdfs://host/shared/marquee-x-") and one != two
    with pytest.raises(RuntimeError):
        scratch_folder(Session(spark_master="yarn"), "x")


def test_session_settings(spark):
    again = build_session("other", spark__sql__shuffle__partitions=4)
    assert again.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_tsv_keeps_blanks_and_refuses_what_it_cannot_hold(spark, tmp_path):
    from marquee.sources.text import read_tsv, write_tsv

    rows = spark.createDataFrame([(" a ", "x"), ("", "y"), (None, "z")], "v string, k string")
    write_tsv(rows, str(tmp_path / "ok"))
    got = {r["k"]: r["v"] for r in read_tsv(spark, str(tmp_path / "ok")).collect()}
    assert got == {"x": " a ", "y": None, "z": None}
    for n, bad in enumerate(("a\tb", "a\nb", "a\rb", "\\N")):
        with pytest.raises(Exception, match="v holds a tab"):
            write_tsv(spark.createDataFrame([(bad,)], "v string"), str(tmp_path / f"bad{n}"))
