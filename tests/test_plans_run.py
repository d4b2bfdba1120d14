"""The whole run on awkward landing files, the reports on it, and the zone checks."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from marquee import Zones, jobs
from marquee.operators import skew
from marquee.plans import checks, curation, reports
from marquee.sources.datasets import read_dataset
from marquee.zones import CURATED, LANDING_FILES, RAW

BASICS = """tconst\ttitleType\tprimaryTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres
tt1\tmovie\tPlain\t0\t1999\t\\N\t100\tDrama,Comedy
tt2\tmovie\t"Giliap"\t0\t1975\t\\N\t\\N\t\\N
tt3\tmovie\t"Half\t0\t2001\t\\N\t90\tDrama
tt4\ttvSeries\t"Rome" and more\t0\t2003\t2007\t50\tAction
tt5\tmovie\t\t0\tabc\t\\N\t12.5\t
tt6\tshort\tA\\"B\t0\t-5\t\\N\t5\tDrama,,X
tt7\tmovie\tshort
"""
RATINGS = """tconst\taverageRating\tnumVotes
tt1\t8.0\t1000
tt3\t6.0\t3000
tt3\t7.0\t10
tt4\t9.5\tmany
tt6\t\\N\t7
"""
NAMES = """nconst\tprimaryName\tbirthYear\tprimaryProfession\tknownForTitles
nm1\tAnna\t1950\tactress,producer\ttt1,tt3,tt9
nm2\tBert\t\\N\t\\N\ttt1,tt3,tt4
nm3\tCleo\t\\N\tactor\t\\N
nm4\tDora With A Name That Is Far Too Long\t\\N\tcasting_director\ttt6,tt4,tt7
nm5\tEmil\t\\N\twriter\ttt1
"""


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landing = root / "landing" / "films"
    landing.mkdir(parents=True)
    for name, content in zip(LANDING_FILES, (BASICS, RATINGS, NAMES)):
        (landing / LANDING_FILES[name].file).write_text(content)
    return curation.curate(spark, Zones(str(root)))


def rows(spark, zones, zone, name, *columns):
    df = read_dataset(spark, zones, zone, name)
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def test_raw_types_and_extra_columns(spark, zones):
    basics = read_dataset(spark, zones, RAW, "title_basics")
    assert basics.columns == BASICS.split("\n")[0].split("\t") + ["genres_array"]
    types = dict(basics.dtypes)
    assert types["startYear"] == types["endYear"] == types["runtimeMinutes"] == "int"
    assert types["isAdult"] == "string" and types["genres_array"] == "array<string>"
    assert dict(read_dataset(spark, zones, RAW, "title_ratings").dtypes) == {
        "tconst": "string",
        "averageRating": "double",
        "numVotes": "bigint",
    }
    assert "knownForArray" in read_dataset(spark, zones, RAW, "name_basics").columns
    years = rows(spark, zones, RAW, "title_basics", "tconst", "startYear", "runtimeMinutes")
    assert ("tt5", None, None) in years and ("tt6", -5, 5) in years and ("tt7", None, None) in years


def test_join_keeps_unrated_titles_and_repeats_rated_ones(spark, zones):
    got = rows(
        spark, zones, CURATED, "title_with_ratings_nopartition", "tconst", "averageRating", "numVotes"
    )
    assert got == sorted(
        [
            ("tt1", 8.0, 1000),
            ("tt2", None, None),
            ("tt3", 6.0, 3000),
            ("tt3", 7.0, 10),
            ("tt4", 9.5, None),
            ("tt5", None, None),
            ("tt6", None, 7),
            ("tt7", None, None),
        ],
        key=str,
    )


def test_genres(spark, zones):
    got = rows(spark, zones, CURATED, "title_by_genre", "tconst", "genre")
    assert got == sorted(
        [("tt1", "Comedy"), ("tt1", "Drama"), ("tt3", "Drama"), ("tt3", "Drama"), ("tt4", "Action")]
        + [("tt6", ""), ("tt6", "Drama"), ("tt6", "X")],
        key=str,
    )
    stats = {r[0]: r[1:] for r in rows(spark, zones, CURATED, "genre_stats")}
    assert stats["Drama"] == (4, 7.0, 71.25, (1000 + 3000 + 10 + 7) / 4)
    assert stats["Action"] == (1, 9.5, 50.0, None)
    assert stats[""] == (1, None, 5.0, 7.0)


def test_popularity_and_decades(spark, zones):
    popular = rows(spark, zones, CURATED, "title_popularity", "tconst", "popularity_score")
    assert ("tt1", 8000.0) in popular and ("tt4", None) in popular and ("tt6", None) in popular
    decades = set(rows(spark, zones, CURATED, "title_by_decade", "tconst", "decade"))
    assert decades == {
        ("tt1", 1990),
        ("tt2", 1970),
        ("tt3", 2000),
        ("tt4", 2000),
        ("tt5", None),
        ("tt6", -10),
        ("tt7", None),
    }


def test_people(spark, zones):
    got = {r[0]: r[1:] for r in rows(spark, zones, CURATED, "person_rating_summary")}
    assert got["nm1"] == ("Anna", "actress,producer", 7.0, 4)
    assert got["nm2"] == ("Bert", None, (8.0 + 6.0 + 7.0 + 9.5) / 4, 4)
    assert "nm3" not in got
    assert got["nm4"] == ("Dora With A Name That Is Far Too Long", "casting_director", 9.5, 3)
    assert got["nm5"] == ("Emil", "writer", 8.0, 1)


def test_row_count_laws(spark, zones):
    rated = read_dataset(spark, zones, CURATED, "title_with_ratings_nopartition")
    exploded = read_dataset(spark, zones, CURATED, "title_by_genre").count()
    sizes = rated.agg(F.sum(F.when(F.col("genres_array").isNotNull(), F.size("genres_array")))).first()[0]
    counted = read_dataset(spark, zones, CURATED, "genre_stats").agg(F.sum("title_count")).first()[0]
    assert exploded == sizes == counted
    for name in ("title_popularity", "title_by_decade"):
        assert read_dataset(spark, zones, CURATED, name).count() == rated.count()


def test_reports(spark, zones):
    frames = {n: [r.asDict() for r in df.collect()] for n, df in reports.build_reports(spark, zones).items()}
    assert [r["genre"] for r in sorted(frames["genre_volume"], key=lambda r: r["pos"])] == [
        "Drama",
        "Action",
        "Comedy",
        "X",
    ]
    assert frames["genre_volume"][0] == {
        "pos": 0,
        "genre": "Drama",
        "title_count": 4,
        "label": "4",
        "label_x": 104,
    }
    quality = sorted(frames["genre_quality"], key=lambda r: r["pos"])
    assert [(r["genre"], r["label"]) for r in quality] == [
        ("Action", "9.50"),
        ("Comedy", "8.00"),
        ("Drama", "7.00"),
        ("X", None),
    ]
    assert {r["genre"]: r["label"] for r in frames["genre_runtime"]}["Drama"] == "71 min"
    bubbles = {r["genre"]: r for r in frames["genre_bubbles"]}
    assert bubbles["Comedy"] == {"genre": "Comedy", "x": 1, "y": 8.0, "size": 10.0, "colour": 100.0}

    movies = sorted(frames["top_movies"], key=lambda r: r["pos"])
    assert [r["title"] for r in movies] == ['"Half', "Plain", '"Half', '"Giliap"', None, "short"]
    assert movies[0]["label"] == "0.0M" and movies[0]["label_x"] == 18000.0 + 180.0
    assert len(frames["movie_scatter"]) == 6

    decades = sorted(frames["decades"], key=lambda r: r["pos"])
    assert [(r["decade"], r["movie_count"], r["tick"]) for r in decades] == [
        (1970, 1, True),
        (1990, 1, False),
        (2000, 2, True),
    ]

    talent = {(r["profession"], r["pos"]): r for r in frames["talent"]}
    assert talent["director", 0]["name"] == "Dora With A Name That Is Far T" + "..."
    assert talent["director", 0]["label"] == "9.50 (3)"
    assert talent["actress", 0]["title"] == "Top Actresss por Rating"
    assert talent["actor", None]["label"] == "No hay datos\npara actor"
    assert talent["actor", None]["title"] == "Actors" and talent["actor", None]["name"] is None
    assert ("writer", None) in talent, "one known title is too few"
    assert [r["nconst"] for r in frames["talent_scatter"]] == ["nm4", "nm1"]


def test_checks(spark, zones, tmp_path):
    landing = checks.check_landing(spark, zones).collect()
    assert {(r["dataset"], r["present"], r["n_tsv"], r["ok"]) for r in landing} == {
        (name, True, 3, True) for name in LANDING_FILES
    }
    counted = {r["dataset"]: r["n_lines"] for r in checks.check_landing(spark, zones, lines=True).collect()}
    assert counted == {"title_basics": 7, "title_ratings": 5, "name_basics": 5}
    checks.require_landing(spark, zones)
    checks.require_curated(spark, zones)
    inventory = checks.zone_inventory(spark, zones).collect()
    assert len(inventory) == 9 and all(r["ok"] and r["n_files"] > 0 for r in inventory)
    assert {r["dataset"]: r["n_rows"] for r in inventory}["title_by_genre"] == 8


def test_checks_of_incomplete_zones(spark, tmp_path):
    zones = Zones(str(tmp_path))
    assert all(not r["ok"] and not r["present"] for r in checks.check_landing(spark, zones).collect())
    assert all(not r["ok"] and r["n_files"] == 0 for r in checks.zone_inventory(spark, zones).collect())

    landing = tmp_path / "landing" / "films"
    landing.mkdir(parents=True)
    (landing / "title.basics.tsv").write_text(BASICS)
    (landing / "other.tsv").write_text("a\n1\n")
    (landing / "third.tsv").write_text("a\n1\n")
    got = {r["dataset"]: r for r in checks.check_landing(spark, zones).collect()}
    assert got["title_basics"]["present"] and got["title_basics"]["n_tsv"] == 3
    assert not any(r["ok"] for r in got.values())
    with pytest.raises(FileNotFoundError, match="title_ratings"):
        checks.require_landing(spark, zones)

    spark.range(1).write.parquet(zones.path(RAW, "title_basics"))
    found = {r["dataset"]: r for r in checks.zone_inventory(spark, zones).collect()}
    assert found["title_basics"]["n_rows"] == 1 and not found["title_basics"]["ok"]
    assert found["title_ratings"]["n_rows"] is None
    with pytest.raises(FileNotFoundError, match="genre_stats"):
        reports.write_reports(spark, zones, str(tmp_path / "reports"))
    assert not (tmp_path / "reports").exists()
    (tmp_path / "raw" / "films" / "name_basics").mkdir()
    with pytest.raises(AnalysisException):
        checks.zone_inventory(spark, zones)


def test_a_panel_that_fails_is_named_and_the_others_are_written(spark, zones, tmp_path, monkeypatch):
    def broken(stats):
        return stats.select(F.raise_error(F.lit("broken")).alias("x"))

    monkeypatch.setitem(reports.PANELS, "genre_volume", ("genre_stats", broken))
    with pytest.raises(RuntimeError, match="genre_volume"):
        reports.write_reports(spark, zones, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "talent")).count() == 5


def test_types_are_apart_in_the_files_of_the_reports(spark, zones):
    for name in ("title_by_decade", "title_popularity"):
        df = read_dataset(spark, zones, CURATED, name)
        at = df.select("_metadata.file_path", "_metadata.row_index", "titleType").collect()
        for file in {r["file_path"] for r in at}:
            own = [r["titleType"] for r in sorted(at, key=lambda r: r["row_index"]) if r["file_path"] == file]
            assert own == sorted(own)


def test_applications(spark, zones, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(jobs, "build_session", lambda app: spark)
    jobs.main(["check", "--root", zones.root])
    jobs.main(["curate", "--root", zones.root])
    assert capsys.readouterr().out.rstrip().endswith("\ncomplete")
    jobs.main(["report", "--root", zones.root, "--output", str(tmp_path / "reports")])
    assert len(capsys.readouterr().out.split()) == 9
    assert spark.read.parquet(str(tmp_path / "reports" / "talent")).count() == 5
    with pytest.raises(SystemExit):
        jobs.main(["report", "--root", zones.root])


def test_many_ratings_of_one_title_are_split(spark, tmp_path, monkeypatch):
    """A third of the ratings fall to one title, which two people are known for."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 50)
    landing = tmp_path / "landing" / "films"
    landing.mkdir(parents=True)
    titles = [f"tt{i}\tmovie\tT{i}\t{1950 + i % 60}\t\\N\t90\tDrama" for i in range(300)]
    ratings = [f"tt{i}\t5.0\t10" for i in range(0, 300, 2)] + ["tt4\t8.0\t1"] * 600
    names = [f"nm{i}\tP{i}\tactor\ttt{i},tt4" for i in range(4)]
    heads = ("\t".join(spec.required) for spec in LANDING_FILES.values())
    for (_, spec), head, body in zip(LANDING_FILES.items(), heads, (titles, ratings, names)):
        (landing / spec.file).write_text("\n".join([head, *body]) + "\n")
    zones = Zones(str(tmp_path))
    curation.land_to_raw(spark, zones)
    plan = curation.rating_splits(read_dataset(spark, zones, RAW, "title_ratings"))
    assert plan.right and not plan.left
    assert [tuple(r) for r in plan.keys.collect()] == [("tt4", 1, 13)]
    zones = curation.curate(spark, zones)
    rated = read_dataset(spark, zones, CURATED, "title_with_ratings_nopartition")
    assert rated.count() == 300 + 600
    assert rated.where("tconst = 'tt4'").count() == 601
    assert rated.where("averageRating is null").count() == 150
    people = {r["nconst"]: r for r in read_dataset(spark, zones, CURATED, "person_rating_summary").collect()}
    assert people["nm1"]["title_count"] == 602 and people["nm0"]["title_count"] == 602
    assert people["nm1"]["avg_rating"] == pytest.approx((5 + 600 * 8) / 601)
    assert people["nm0"]["avg_rating"] == pytest.approx((10 + 600 * 8) / 602)


def test_an_error_in_one_write_is_raised_after_the_others(spark, tmp_path):
    def fail():
        raise RuntimeError("no space")

    path = str(tmp_path / "kept")
    with pytest.raises(RuntimeError, match="no space"):
        curation.together(spark, fail, lambda: spark.range(3).write.parquet(path))
    assert spark.read.parquet(path).count() == 3
