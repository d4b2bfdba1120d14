"""The stage of the registered queries: what it keeps, and when it starts anew."""

import shutil
import subprocess
import sys
import tempfile
from pathlib import Path

import pytest

from marquee.session import Lease, lease_database, scratch_folder
from marquee.suite.queries import QUERIES
from marquee.suite.views import CATALOGUE_TABLES, Stage, fingerprint

SF_DIR = "/root/testdata/sf0.001"
USE_SCRATCH = (
    "scan_csv_positional scan_text sink_parquet_roundtrip sink_text_roundtrip external_table limit_rows "
    "catalog_databases check_landing curated_run join_title_ratings"
).split()


def test_changed_tables_give_new_rows(spark, tmp_path):
    for name in CATALOGUE_TABLES:
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path)
    sf = str(tmp_path)
    before = {r["tconst"] for r in QUERIES["project_subset"](spark, sf).collect()}
    stage = Stage.of(spark, sf)
    assert Stage.of(spark, sf) is stage
    fewer = spark.read.parquet(f"{SF_DIR}/orders.parquet").where("o_orderkey % 2 = 0")
    shutil.move(f"{sf}/orders.parquet", f"{sf}/old")
    # A folder of several files in place of one file.
    fewer.repartition(3).write.parquet(f"{sf}/orders.parquet")
    after = {r["tconst"] for r in QUERIES["project_subset"](spark, sf).collect()}
    assert Stage.of(spark, sf) is not stage
    assert after and after < before and len(after) == fewer.count()


def test_fingerprint_reads_no_contents(spark, tmp_path):
    for name in CATALOGUE_TABLES:
        (tmp_path / f"{name}.parquet").write_bytes(b"no Parquet file")
    one = fingerprint(spark, str(tmp_path))
    assert one[0] == len(CATALOGUE_TABLES) and fingerprint(spark, str(tmp_path)) == one
    (tmp_path / "part.parquet").write_bytes(b"")
    assert fingerprint(spark, str(tmp_path)) != one


def test_leases_leave_only_the_stage(spark, tmp_path, monkeypatch):
    given = spark.conf.get("spark.checkpoint.dir", None)
    root = Path(given or tmp_path)
    # Without the setting a local session has its scratch folders here.
    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    before = set(root.glob("marquee-*"))
    databases = spark.sql("SHOW DATABASES").count()
    monkeypatch.setattr(Stage, "_known", {})
    for name in USE_SCRATCH:
        with Lease() as lease:
            QUERIES[name](spark, SF_DIR).limit(1).collect()
        assert not lease.folders and not lease.databases
    left = {f.name.split("-")[1] for f in set(root.glob("marquee-*")) - before}
    assert left == {"catalogue", "run"}
    assert spark.sql("SHOW DATABASES").count() == databases


def test_lease_ends_after_an_error(spark, tmp_path):
    with Lease() as outer:
        with pytest.raises(ZeroDivisionError), Lease():
            lost = scratch_folder(spark, "lost")
            spark.range(3).write.mode("overwrite").parquet(lost)
            spark.sql("CREATE DATABASE leased_and_lost")
            lease_database(spark, "leased_and_lost")
            1 / 0
        assert not Path(lost).exists() and not spark.catalog.databaseExists("leased_and_lost")
        kept, lasting = scratch_folder(spark, "kept"), scratch_folder(spark, "lasting", lasting=True)
        for folder in (kept, lasting):
            spark.range(3).write.mode("overwrite").parquet(folder)
        assert outer.folders == [kept] and spark.read.parquet(kept).count() == 3
    assert not Path(kept).exists() and spark.read.parquet(lasting).count() == 3


def test_scratch_goes_with_the_application(tmp_path):
    code = (
        "from marquee.session import build_session, scratch_folder\n"
        f"s = build_session('x', 'local[1]', spark__ui__enabled=False, spark__checkpoint__dir={str(tmp_path)!r})\n"
        "f = scratch_folder(s, 'x')\ns.range(2).write.parquet(f + '/rows')\n"
        "assert s.read.parquet(f + '/rows').count() == 2\ns.stop()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, capture_output=True)
    assert not list(tmp_path.glob("marquee-*"))
