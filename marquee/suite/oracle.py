"""The registered queries as SQL over the same tables, for DuckDB."""

from __future__ import annotations

CATALOGUE = r"""
WITH title_brands AS (
  SELECT l_orderkey, string_agg(p_brand, ',' ORDER BY p_brand) AS brands
  FROM (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) d
  GROUP BY l_orderkey
),
title_basics_txt AS (
  SELECT concat('tt', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS tconst,
    CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'O' THEN 'short' ELSE 'tvSeries' END AS titleType,
    concat(o_orderpriority, ' order ', CAST(o_orderkey AS VARCHAR),
      CASE WHEN o_orderkey % 5 = 0 THEN ' with a deliberately long title that needs truncation' ELSE '' END)
      AS primaryTitle,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'n/a'
      ELSE CAST(1880 + o_orderkey % 151 AS VARCHAR) END AS startYear,
    CASE WHEN o_orderkey % 9 = 0 THEN CAST(1890 + o_orderkey % 151 AS VARCHAR) END AS endYear,
    CASE WHEN o_orderkey % 19 <> 0 THEN CAST(40 + o_orderkey % 160 AS VARCHAR) END AS runtimeMinutes,
    CASE WHEN brands IS NOT NULL AND o_orderkey % 29 = 0 THEN brands || ',' ELSE brands END AS genres
  FROM orders LEFT JOIN title_brands ON l_orderkey = o_orderkey
),
title_ratings_txt AS (
  SELECT concat('tt', lpad(CAST(l_orderkey AS VARCHAR), 12, '0')) AS tconst,
    CAST(CAST(1 + (CAST(sum(l_quantity) AS BIGINT) * 7) % 90 AS DOUBLE) / 10 AS VARCHAR) AS averageRating,
    CAST(CAST(sum(l_quantity) AS BIGINT) * (1 + l_orderkey % 50) AS VARCHAR) AS numVotes
  FROM lineitem GROUP BY l_orderkey
),
known AS (
  SELECT o_custkey, o_orderkey // 65536 AS block,
    string_agg(DISTINCT concat('tt', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')), ','
      ORDER BY concat('tt', lpad(CAST(o_orderkey AS VARCHAR), 12, '0'))) AS titles
  FROM orders GROUP BY o_custkey, block
),
name_basics_txt AS (
  SELECT concat('nm', lpad(CAST(c_custkey AS VARCHAR), 12, '0'), '-',
      CAST(coalesce(block, 0) AS VARCHAR)) AS nconst, c_name AS primaryName,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE
      CASE c_mktsegment WHEN 'MACHINERY' THEN 'actor,producer' WHEN 'BUILDING' THEN 'actress'
        WHEN 'AUTOMOBILE' THEN 'casting_director' WHEN 'FURNITURE' THEN 'writer,director'
        ELSE 'producer' END
    END AS primaryProfession,
    titles AS knownForTitles
  FROM customer LEFT JOIN known ON o_custkey = c_custkey
),
titles AS (
  SELECT tconst, titleType, primaryTitle, TRY_CAST(startYear AS INTEGER) AS startYear,
    TRY_CAST(endYear AS INTEGER) AS endYear, TRY_CAST(runtimeMinutes AS INTEGER) AS runtimeMinutes,
    genres, string_split(genres, ',') AS genres_list
  FROM title_basics_txt
),
ratings AS (
  SELECT tconst, TRY_CAST(averageRating AS DOUBLE) AS averageRating, TRY_CAST(numVotes AS BIGINT) AS numVotes
  FROM title_ratings_txt
),
names AS (
  SELECT *, string_split(knownForTitles, ',') AS known_list FROM name_basics_txt
),
rated AS (
  SELECT t.*, r.averageRating, r.numVotes, r.averageRating * r.numVotes AS popularity_score,
    CAST(floor(startYear / 10.0) * 10 AS BIGINT) AS decade
  FROM titles t LEFT JOIN ratings r ON t.tconst = r.tconst
),
by_genre AS (SELECT *, unnest(genres_list) AS genre FROM rated),
stats AS (
  SELECT genre, count(*) AS title_count, round(avg(averageRating), 6) AS avg_rating,
    round(avg(runtimeMinutes), 6) AS avg_runtime, round(avg(numVotes), 6) AS avg_votes
  FROM by_genre GROUP BY genre
),
known_for AS (SELECT nconst, primaryName, primaryProfession, unnest(known_list) AS tconst FROM names),
people AS (
  SELECT k.nconst, k.primaryName, k.primaryProfession, round(avg(r.averageRating), 6) AS avg_rating,
    count(k.tconst) AS title_count
  FROM known_for k LEFT JOIN ratings r ON k.tconst = r.tconst
  GROUP BY k.nconst, k.primaryName, k.primaryProfession
),
seasoned AS (
  SELECT * FROM people
  WHERE title_count >= 3 AND avg_rating IS NOT NULL AND primaryProfession IS NOT NULL
),
decades AS (
  SELECT decade, count(*) AS movie_count, round(avg(averageRating), 6) AS avg_rating,
    round(avg(numVotes), 6) AS avg_votes, round(avg(runtimeMinutes), 6) AS avg_runtime
  FROM rated WHERE titleType = 'movie' AND decade BETWEEN 1900 AND 2020 GROUP BY decade
),
ranked_movies AS (
  SELECT tconst, primaryTitle, titleType, averageRating, numVotes, popularity_score,
    CAST(row_number() OVER (ORDER BY popularity_score DESC NULLS LAST, tconst) - 1 AS BIGINT) AS pos
  FROM rated WHERE titleType = 'movie'
),
breweries AS (
  SELECT '' AS num, 'name' AS name, 'city' AS city, 'state' AS state, 'id' AS id
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), s_name, n_name, r_name, CAST(s_suppkey AS VARCHAR)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
words AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \t\n\r\f]+')) AS word FROM documents)
"""

TITLE_COLUMNS = "tconst, titleType, primaryTitle, startYear, endYear, runtimeMinutes, genres"
GENRES_ARRAY = "array_to_string(genres_list, '|') AS genres_array"
RATED_COLUMNS = f"{TITLE_COLUMNS}, {GENRES_ARRAY}, averageRating, numVotes"
POPULARITY = "tconst, primaryTitle, titleType, averageRating, numVotes, popularity_score"
CAPITAL = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"


def ranked_genres(order: str, columns: str) -> str:
    return f"""
SELECT {columns} FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS pos
  FROM stats WHERE genre IS NOT NULL AND genre <> '') g
WHERE pos < 15"""


def talent(professions: tuple[str, ...], k: int) -> str:
    values = ", ".join(f"('{p}')" for p in professions)
    return f"""
SELECT c.profession, b.pos,
  CASE WHEN length(primaryName) > 30 THEN substr(primaryName, 1, 30) || '...' ELSE primaryName END AS name,
  avg_rating, title_count,
  CASE WHEN nconst IS NULL THEN 'No hay datos' || chr(10) || 'para ' || c.profession
    ELSE printf('%.2f (%d)', avg_rating, title_count) END AS label,
  round(avg_rating + 0.1, 6) AS label_x,
  CASE WHEN nconst IS NULL THEN {CAPITAL.format('c.profession')} || 's'
    ELSE 'Top ' || {CAPITAL.format('c.profession')} || 's por Rating' END AS title
FROM (VALUES {values}) c(profession) LEFT JOIN (
  SELECT *, CAST(row_number() OVER (PARTITION BY profession ORDER BY avg_rating DESC, nconst) - 1 AS BIGINT) AS pos
  FROM seasoned JOIN (VALUES {values}) p(profession) ON contains(primaryProfession, profession)
) b ON b.profession = c.profession AND b.pos < {k}"""


RAW_ROWS = """SELECT 'title_basics' AS dataset, count(*) AS n_rows FROM titles
  UNION ALL SELECT 'title_ratings', count(*) FROM ratings
  UNION ALL SELECT 'name_basics', count(*) FROM names"""
CURATED_ROWS = """SELECT 'title_with_ratings_nopartition' AS dataset, count(*) AS n_rows,
    CAST(sum(numVotes) AS BIGINT) AS total FROM rated
  UNION ALL SELECT 'title_by_genre', count(*), CAST(sum(numVotes) AS BIGINT) FROM by_genre
  UNION ALL SELECT 'genre_stats', count(*), CAST(sum(title_count) AS BIGINT) FROM stats
  UNION ALL SELECT 'title_popularity', count(*),
    CAST(sum(CAST(round(popularity_score * 10) AS BIGINT)) AS BIGINT) FROM rated
  UNION ALL SELECT 'person_rating_summary', count(*), CAST(sum(title_count) AS BIGINT) FROM people
  UNION ALL SELECT 'title_by_decade', count(*), CAST(sum(decade) AS BIGINT) FROM rated"""
PROFESSIONS = ("actor", "actress", "director", "writer", "producer")
BY_VOLUME = "title_count DESC NULLS LAST, genre"

BODIES = {
    "scan_tsv": "SELECT * FROM title_basics_txt",
    "scan_tsv_quoted": """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name || chr(9) || CAST(s_nationkey AS VARCHAR) AS label FROM supplier""",
    "scan_csv_positional": """
SELECT nullif(num, '') AS _c0, name AS _c1, city AS _c2, state AS _c3, id AS _c4 FROM breweries""",
    "scan_parquet": "SELECT * FROM ratings",
    "scan_text": r"""
SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS value FROM documents""",
    "sink_parquet_roundtrip": f"SELECT {POPULARITY} FROM rated",
    "sink_text_roundtrip": """
SELECT word || chr(9) || CAST(count(*) AS VARCHAR) AS value FROM words GROUP BY word""",
    "external_table": """
SELECT TRY_CAST(num AS INTEGER) AS num, rpad(name, 100, ' ') AS name, rpad(city, 100, ' ') AS city,
  rpad(state, 100, ' ') AS state, TRY_CAST(id AS INTEGER) AS id FROM breweries""",
    "limit_rows": "SELECT count(*) AS n_rows FROM (SELECT name FROM breweries LIMIT 10) b",
    "preview_rows": "SELECT count(*) AS n_rows FROM (SELECT * FROM titles LIMIT 20) t",
    "catalog_databases": """
SELECT 'title_basics' AS dataset, count(*) AS n_rows FROM titles
UNION ALL SELECT 'title_ratings', count(*) FROM ratings
UNION ALL SELECT 'name_basics', count(*) FROM names""",
    "check_landing": f"""
SELECT dataset, true AS present, CAST(3 AS BIGINT) AS n_tsv, true AS ok, n_rows AS n_lines FROM ({RAW_ROWS}) d""",
    "check_landing_incomplete": f"""
SELECT dataset, true AS present, CAST(3 AS BIGINT) AS n_tsv, false AS ok, n_rows AS n_lines FROM ({RAW_ROWS}) d
UNION ALL SELECT 'title_crew', false, 3, false, NULL""",
    "curated_run": CURATED_ROWS,
    "check_zone_inventory": f"""
SELECT 'raw' AS zone, dataset, true AS has_files, n_rows, true AS ok FROM ({RAW_ROWS}) d
UNION ALL SELECT 'curated', dataset, true, n_rows, true FROM ({CURATED_ROWS}) d""",
    "cast_int": "SELECT tconst, startYear, endYear, runtimeMinutes FROM titles",
    "cast_double": "SELECT tconst, averageRating FROM ratings",
    "cast_long": "SELECT tconst, numVotes FROM ratings",
    "split_array": f"""
SELECT tconst, {GENRES_ARRAY}, CAST(len(genres_list) AS INTEGER) AS n_genres FROM titles""",
    "project_subset": "SELECT tconst, primaryTitle, titleType FROM titles",
    "popularity_score_only": "SELECT tconst, numVotes * averageRating AS popularity_score FROM ratings",
    "popularity_score": f"SELECT {POPULARITY} FROM rated",
    "decade_bucket_only": "SELECT tconst, startYear, decade FROM rated",
    "label_truncate": """
SELECT tconst, CASE WHEN length(primaryTitle) > 50 THEN substr(primaryTitle, 1, 50) || '...'
  ELSE primaryTitle END AS label FROM titles""",
    "label_thousands": "SELECT genre, format('{:,}', title_count) AS label FROM stats",
    "label_fixed2": "SELECT genre, printf('%.2f', avg_rating) AS label FROM stats",
    "label_minutes": "SELECT tconst, CAST(runtimeMinutes AS VARCHAR) || ' min' AS label FROM titles",
    "label_millions": "SELECT tconst, printf('%.1f', popularity_score / 1e6) || 'M' AS label FROM rated",
    "label_rating_count": """
SELECT nconst, printf('%.2f', avg_rating) || ' (' || CAST(title_count AS VARCHAR) || ')' AS label FROM people""",
    "label_capitalize": f"""
SELECT nconst, {CAPITAL.format('primaryProfession')} AS capital,
  'Top ' || {CAPITAL.format('primaryProfession')} || 's por Rating' AS title FROM names""",
    "scale_measure": "SELECT genre, round(avg_votes / 100, 6) AS size FROM stats",
    "label_offset_const": """
SELECT genre, CAST(title_count + 100 AS BIGINT) AS count_x, round(avg_rating + 0.05, 6) AS rating_x,
  round(avg_runtime + 2, 6) AS runtime_x FROM stats""",
    "label_offset_rel": """
SELECT tconst, round(popularity_score, 6) AS popularity_score,
  round(popularity_score + max(popularity_score) OVER () * 0.01, 6) AS label_x
FROM ranked_movies WHERE pos < 20""",
    "rank_position": "SELECT tconst, popularity_score, pos FROM ranked_movies WHERE pos < 1000",
    "every_second": """
SELECT * FROM (SELECT decade, movie_count,
  CAST(row_number() OVER (ORDER BY decade) - 1 AS BIGINT) AS pos FROM decades) d WHERE pos % 2 = 0""",
    "filter_equals": "SELECT tconst, titleType FROM titles WHERE titleType = 'movie'",
    "filter_not_null": """
SELECT tconst, startYear, runtimeMinutes FROM titles
WHERE startYear IS NOT NULL AND runtimeMinutes IS NOT NULL""",
    "filter_range": "SELECT tconst, decade FROM rated WHERE decade >= 1900 AND decade <= 2020",
    "filter_having": """
SELECT nconst, count(tconst) AS title_count FROM known_for
GROUP BY nconst, primaryName, primaryProfession HAVING count(tconst) >= 3""",
    "filter_contains": """
SELECT nconst, primaryProfession FROM names WHERE primaryProfession LIKE '%director%'""",
    "filter_contains_any_case": """
SELECT nconst, primaryName FROM names WHERE primaryName ILIKE '%customer#00000000%'""",
    "filter_contains_element": """
SELECT nconst, primaryProfession FROM names
WHERE list_contains(string_split(primaryProfession, ','), 'director')""",
    "filter_nonempty": "SELECT genre, title_count FROM stats WHERE genre IS NOT NULL AND genre <> ''",
    "category_placeholder": talent(("actress", "composer"), 3),
    "join_title_ratings": f"SELECT {RATED_COLUMNS} FROM rated",
    "join_known_ratings": """
SELECT k.nconst, k.tconst, r.averageRating, r.numVotes
FROM known_for k LEFT JOIN ratings r ON k.tconst = r.tconst""",
    "explode_genre": f"SELECT {RATED_COLUMNS}, genre FROM by_genre",
    "explode_known_for": "SELECT nconst, tconst FROM known_for",
    "tokenize_words": "SELECT doc_id, word FROM words",
    "agg_count_star": "SELECT titleType, count(*) AS title_count FROM titles GROUP BY titleType",
    "agg_count_col": """
SELECT titleType, count(startYear) AS n_years, count(endYear) AS n_ends FROM titles GROUP BY titleType""",
    "agg_avg": """
SELECT titleType, round(avg(averageRating), 6) AS avg_rating, round(avg(numVotes), 6) AS avg_votes,
  round(avg(runtimeMinutes), 6) AS avg_runtime FROM rated GROUP BY titleType""",
    "agg_global_max": """
SELECT max(popularity_score) AS max_popularity_score FROM rated WHERE titleType = 'movie'""",
    "agg_global_count": "SELECT count(*) AS n_rows FROM people WHERE avg_rating IS NOT NULL",
    "word_count": "SELECT word, count(*) AS n FROM words GROUP BY word",
    "genre_stats": "SELECT * FROM stats",
    "person_rating_summary": "SELECT * FROM people",
    "decade_stats": "SELECT * FROM decades ORDER BY decade",
    "sort_desc": f"""
SELECT {POPULARITY} FROM rated ORDER BY popularity_score DESC NULLS LAST, tconst""",
    "sort_asc": "SELECT decade, tconst FROM rated ORDER BY decade NULLS FIRST, tconst",
    "top_k_movies": f"SELECT {POPULARITY} FROM ranked_movies WHERE pos < 20 ORDER BY pos",
    "top_genres_by_volume": ranked_genres(
        BY_VOLUME, "genre, title_count, avg_rating, avg_runtime, avg_votes"
    ),
    "top_genres_by_rating": ranked_genres(
        f"avg_rating DESC NULLS LAST, {BY_VOLUME}",
        "genre, title_count, avg_rating, avg_runtime, avg_votes",
    ),
    "top_genres_by_runtime": ranked_genres(
        f"avg_runtime DESC NULLS LAST, {BY_VOLUME}",
        "genre, title_count, avg_rating, avg_runtime, avg_votes",
    ),
    "top_talent_by_profession": f"""
SELECT * FROM (
  SELECT s.*, p.profession, CAST(row_number() OVER (
      PARTITION BY p.profession ORDER BY avg_rating DESC, nconst) - 1 AS BIGINT) AS pos
  FROM seasoned s JOIN (VALUES {", ".join(f"('{p}')" for p in PROFESSIONS)}) p(profession)
    ON contains(primaryProfession, profession)) t
WHERE pos < 15""",
    "raw_title_basics": f"SELECT {TITLE_COLUMNS}, {GENRES_ARRAY} FROM titles",
    "raw_title_ratings": "SELECT * FROM ratings",
    "raw_name_basics": """
SELECT nconst, primaryName, primaryProfession, knownForTitles,
  array_to_string(known_list, '|') AS knownForArray FROM names""",
    "decade_bucket": f"SELECT {RATED_COLUMNS}, decade FROM rated",
    "report_genre_volume": ranked_genres(
        BY_VOLUME,
        "pos, genre, title_count, format('{:,}', title_count) AS label,"
        " CAST(title_count + 100 AS BIGINT) AS label_x",
    ),
    "report_genre_quality": ranked_genres(
        f"avg_rating DESC NULLS LAST, {BY_VOLUME}",
        "pos, genre, avg_rating, printf('%.2f', avg_rating) AS label, round(avg_rating + 0.05, 6) AS label_x",
    ),
    "report_genre_runtime": ranked_genres(
        f"avg_runtime DESC NULLS LAST, {BY_VOLUME}",
        "pos, genre, avg_runtime, CAST(CAST(trunc(avg_runtime) AS BIGINT) AS VARCHAR) || ' min' AS label,"
        " round(avg_runtime + 2, 6) AS label_x",
    ),
    "report_genre_bubbles": """
SELECT genre, title_count AS x, avg_rating AS y, round(avg_votes / 100, 6) AS size, avg_runtime AS colour
FROM stats WHERE genre IS NOT NULL AND genre <> ''""",
    "report_top_movies": """
SELECT pos, CASE WHEN length(primaryTitle) > 50 THEN substr(primaryTitle, 1, 50) || '...'
    ELSE primaryTitle END AS title,
  round(popularity_score, 6) AS popularity_score, printf('%.1f', popularity_score / 1e6) || 'M' AS label,
  round(popularity_score + max(popularity_score) OVER () * 0.01, 6) AS label_x
FROM (SELECT * FROM ranked_movies WHERE pos < 20) m""",
    "report_movie_scatter": """
SELECT tconst, averageRating, numVotes, popularity_score FROM ranked_movies WHERE pos < 1000""",
    "report_decades": """
SELECT *, pos % 2 = 0 AS tick FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY decade) - 1 AS BIGINT) AS pos FROM decades) d""",
    "report_talent": talent(PROFESSIONS, 15),
    "report_talent_scatter": """
SELECT nconst, title_count, avg_rating FROM seasoned ORDER BY avg_rating DESC, nconst LIMIT 100""",
}

ORACLE_SQL = {name: CATALOGUE + body.strip() for name, body in BODIES.items()}
