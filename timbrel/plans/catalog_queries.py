"""Key matching and catalogue building."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrel.operators import catalog, matching
from timbrel.plans.registry import query, table

# Spellings of part labels, as a user would type genres.
_SPELLING = """CASE p_partkey % 6 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) WHEN 2 THEN p_name
    WHEN 3 THEN upper(replace(p_name, ' ', '-')) WHEN 4 THEN 'big ' || lower(p_type) ELSE 'zzzz' || p_size END"""
_ALIASES = {f"big {t}": t.upper() for t in ("standard", "medium", "promo", "large", "small", "economy")}
_AVAILABLE_SQL = """
    available AS (
        SELECT p_type AS name, min(p_partkey) AS pos FROM part GROUP BY p_type
        UNION ALL SELECT replace(p_name, ' ', '-'), min(p_partkey) + 1000000000 FROM part GROUP BY ALL)"""


def _available(part):
    types = part.groupBy(F.col("p_type").alias("name")).agg(F.min("p_partkey").alias("pos"))
    hyphened = (
        part.groupBy(F.replace("p_name", F.lit(" "), F.lit("-")).alias("name"))
        .agg((F.min("p_partkey") + 1000000000).alias("pos"))
    )
    return types.unionByName(hyphened)


@query(
    "genre_match",
    f"""
    WITH {_AVAILABLE_SQL},
    targets AS (SELECT DISTINCT {_SPELLING} AS target FROM part),
    lowered AS (SELECT lower(name) AS low, arg_min(name, pos) AS name FROM available GROUP BY lower(name)),
    tiers AS (
        SELECT t.target, e.name AS exact, l.name AS norm, a.name AS alias
        FROM targets t
        LEFT JOIN available e ON e.name = t.target
        LEFT JOIN lowered l ON l.low = replace(replace(lower(t.target), ' ', '-'), '&', 'n')
        LEFT JOIN available a ON lower(t.target) LIKE 'big %' AND a.name = upper(substr(t.target, 5)))
    SELECT target, coalesce(exact, norm, alias) AS match,
           CASE WHEN exact IS NOT NULL THEN 1 WHEN norm IS NOT NULL THEN 2 WHEN alias IS NOT NULL THEN 3 END AS tier
    FROM tiers""",
)
def genre_match(spark, folder):
    part = table(spark, folder, "part")
    targets = part.select(F.expr(_SPELLING).alias("spelling"))
    return matching.match_tiers(targets, "spelling", _available(part), "name", "pos", _ALIASES)


@query(
    "genre_tag",
    f"""
    WITH {_AVAILABLE_SQL},
    lowered AS (SELECT lower(name) AS low, arg_min(name, pos) AS name FROM available GROUP BY lower(name)),
    rows AS (SELECT p_partkey, {_SPELLING} AS spelling FROM part)
    SELECT p_partkey, spelling, coalesce(e.name, l.name, a.name) AS match,
           CASE WHEN e.name IS NOT NULL THEN 1 WHEN l.name IS NOT NULL THEN 2 WHEN a.name IS NOT NULL THEN 3 END AS tier
    FROM rows t
    LEFT JOIN (SELECT DISTINCT name FROM available) e ON e.name = t.spelling
    LEFT JOIN lowered l ON l.low = replace(replace(lower(t.spelling), ' ', '-'), '&', 'n')
    LEFT JOIN available a ON lower(t.spelling) LIKE 'big %' AND a.name = upper(substr(t.spelling, 5))""",
)
def genre_tag(spark, folder):
    part = table(spark, folder, "part")
    rows = part.select("p_partkey", F.expr(_SPELLING).alias("spelling"))
    matches = matching.match_tiers(rows, "spelling", _available(part), "name", "pos", _ALIASES)
    return matching.tag_matches(rows, "spelling", matches)


# The similarity measure said in SQL: the longest common block of two words,
# then the same on both sides of it, until nothing is left in common.
_SIMILAR_SQL = f"""
    WITH RECURSIVE {_AVAILABLE_SQL},
    targets AS (SELECT DISTINCT lower({_SPELLING}) || 's' AS target FROM part),
    lowered AS (SELECT lower(name) AS low, arg_min(name, pos) AS name FROM available GROUP BY lower(name)),
    tiers AS (
        SELECT t.target, replace(replace(t.target, ' ', '-'), '&', 'n') AS b, e.name AS exact, l.name AS norm, x.name AS alias
        FROM targets t
        LEFT JOIN (SELECT DISTINCT name FROM available) e ON e.name = t.target
        LEFT JOIN lowered l ON l.low = replace(replace(t.target, ' ', '-'), '&', 'n')
        LEFT JOIN available x ON t.target LIKE 'big %' AND x.name = upper(substr(t.target, 5))),
    words AS (SELECT DISTINCT name AS a FROM available),
    pairs AS (SELECT DISTINCT b, a FROM tiers, words WHERE coalesce(exact, norm, alias) IS NULL),
    ca AS (SELECT a, i, substr(a, i, 1) AS c FROM (SELECT a, unnest(range(1, length(a) + 1)) AS i FROM words)),
    cb AS (SELECT b, j, substr(b, j, 1) AS c FROM (SELECT b, unnest(range(1, length(b) + 1)) AS j FROM (SELECT DISTINCT b FROM pairs))),
    cells AS (SELECT a, b, i, j, j - i AS diag FROM ca JOIN cb USING (c)),
    runs AS (SELECT *, i - row_number() OVER (PARTITION BY a, b, diag ORDER BY i) AS grp FROM cells),
    ext AS (SELECT a, b, i, j, count(*) OVER (PARTITION BY a, b, diag, grp ORDER BY i DESC) AS k FROM runs),
    blocks AS (
        SELECT a, b, 1 AS alo, length(a) + 1 AS ahi, 1 AS blo, length(b) + 1 AS bhi, 0 AS m FROM pairs
        UNION ALL
        SELECT a, b, s.alo, s.ahi, s.blo, s.bhi, s.m FROM (
            SELECT a, b, unnest([
                {{'alo': alo, 'ahi': best.i, 'blo': blo, 'bhi': best.j, 'm': best.k}},
                {{'alo': best.i + best.k, 'ahi': ahi, 'blo': best.j + best.k, 'bhi': bhi, 'm': 0}}]) AS s
            FROM (
                SELECT q.a, q.b, q.alo, q.ahi, q.blo, q.bhi,
                       arg_max({{'i': e.i, 'j': e.j, 'k': least(e.k, q.ahi - e.i, q.bhi - e.j)}},
                               least(e.k, q.ahi - e.i, q.bhi - e.j) * 1000000 - e.i * 1000 - e.j) AS best
                FROM blocks q JOIN ext e
                  ON e.a = q.a AND e.b = q.b AND e.i >= q.alo AND e.i < q.ahi AND e.j >= q.blo AND e.j < q.bhi
                GROUP BY ALL))),
    scores AS (SELECT a, b, 2.0 * sum(m) / (length(a) + length(b)) AS score FROM blocks GROUP BY a, b),
    closest AS (SELECT b, arg_max(a, {{'score': score, 'a': a}}) AS name FROM scores WHERE score >= 0.6 GROUP BY b)
    SELECT target, coalesce(exact, norm, alias, c.name) AS match,
           CASE WHEN exact IS NOT NULL THEN 1 WHEN norm IS NOT NULL THEN 2 WHEN alias IS NOT NULL THEN 3
                WHEN c.name IS NOT NULL THEN 4 END AS tier
    FROM tiers t LEFT JOIN closest c ON c.b = t.b"""


def _misspelt(part):
    return part.select(F.concat(F.lower(F.expr(_SPELLING)), F.lit("s")).alias("spelling"))


@query("genre_match_similar", _SIMILAR_SQL)
def genre_match_similar(spark, folder):
    part = table(spark, folder, "part")
    return matching.match_keys(_misspelt(part), "spelling", _available(part), "name", "pos", _ALIASES)


@query("genre_match_similar_join", _SIMILAR_SQL)
def genre_match_similar_join(spark, folder):
    # frequent characters split in many shares, as with very many words
    part = table(spark, folder, "part")
    return matching.match_keys(_misspelt(part), "spelling", _available(part), "name", "pos", _ALIASES, words_per_share=2)


@query(
    "unmatched_keys",
    f"""
    WITH {_AVAILABLE_SQL}
    SELECT DISTINCT {_SPELLING} AS target FROM part WHERE p_partkey % 6 = 5
    UNION SELECT target FROM (SELECT DISTINCT {_SPELLING} AS target FROM part WHERE p_partkey % 6 IN (2, 3)) t
        WHERE NOT EXISTS (SELECT 1 FROM available a WHERE a.name = t.target OR lower(a.name) = replace(lower(t.target), ' ', '-'))""",
)
def unmatched_keys(spark, folder):
    return matching.unmatched(genre_match(spark, folder))


_PAYLOAD = """to_json(named_struct('tracks', named_struct('items', transform(sequence(0, p_size % 4), i -> named_struct(
    'id', 'p' || p_partkey || '_' || i, 'name', p_name,
    'artists', array(named_struct('name', p_brand), named_struct('name', 'Feat ' || i)),
    'album', named_struct('name', p_type), 'popularity', p_size + i, 'duration_ms', p_partkey * 1000 + i,
    'preview_url', CASE WHEN i = 1 THEN 'http://x/' || p_partkey END)))))"""
_FLAT_SQL = """
    SELECT p_partkey, i AS position, 'p' || p_partkey || '_' || i AS track_id, p_name AS track_name,
           p_brand || ', Feat ' || i AS artists, p_type AS album, p_size + i AS popularity,
           p_partkey * 1000 + i AS duration_ms, CASE WHEN i = 1 THEN 'http://x/' || p_partkey END AS preview_url
    FROM (SELECT *, CAST(unnest(range(p_size % 4 + 1)) AS INTEGER) AS i FROM part)"""


@query("catalog_flatten", _FLAT_SQL)
def catalog_flatten(spark, folder):
    answers = table(spark, folder, "part").select("p_partkey", F.expr(_PAYLOAD).alias("payload"))
    return catalog.flatten_search(answers, "payload", "p_partkey")


@query("catalog_flatten_recommended", _FLAT_SQL)
def catalog_flatten_recommended(spark, folder):
    # recommendations hold the list one level higher
    payload = F.concat(F.lit('{"tracks":'), F.get_json_object(F.expr(_PAYLOAD), "$.tracks.items"), F.lit("}"))
    answers = table(spark, folder, "part").select("p_partkey", payload.alias("payload"))
    return catalog.flatten_recommendations(answers, "payload", "p_partkey")


N = 50


@query(
    "supplement_union",
    f"""
    WITH pool AS (
        SELECT o_orderpriority, o_orderkey, 0 AS src FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 480000
        UNION ALL SELECT o_orderpriority, o_orderkey, 1 FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 480000))
    SELECT o_orderpriority, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY src, o_orderkey) AS rn FROM pool) WHERE rn <= {N}""",
)
def supplement_union(spark, folder):
    orders = table(spark, folder, "orders")
    first = "o_orderstatus = 'F' AND o_totalprice > 480000"
    primary = orders.filter(first).select("o_orderpriority", "o_orderkey")
    fallback = orders.filter(f"NOT ({first})").select("o_orderpriority", "o_orderkey")
    filled = catalog.supplement(primary, fallback, N, "o_orderpriority", "o_orderkey")
    return filled.select("o_orderpriority", "o_orderkey")


_POSITION = "(l_orderkey * 8 + l_linenumber) * 1000000 + l_suppkey"


def _catalog(spark, folder):
    """Line items as search hits (kept ones) and recommendations; ship modes as genres."""
    hits = table(spark, folder, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("genre"),
        F.col("l_partkey").alias("track_id"),
        F.expr(_POSITION).alias("position"),
        F.col("l_quantity").cast("int").alias("popularity"),
        (F.col("l_extendedprice").cast("bigint")).alias("duration_ms"),
    )
    genres = (
        hits.select("genre")
        .distinct()
        .select(
            "genre",
            F.concat(F.lit("target-"), F.lower("genre")).alias("target_genre"),
            (F.ascii("genre") * 256 + F.ascii(F.substr("genre", F.lit(2)))).alias("genre_pos"),
        )
    )
    return catalog.build_catalog(
        hits.filter("popularity >= 48"), hits.filter("popularity < 48"), genres, N, position=("position", "popularity", "duration_ms")
    )


_CATALOG_SQL = f"""
    hits AS (SELECT l_returnflag || l_linestatus AS genre, l_partkey AS track_id, {_POSITION} AS position,
                    CAST(l_quantity AS INTEGER) AS popularity, CAST(trunc(l_extendedprice) AS BIGINT) AS duration_ms,
                    ascii(l_returnflag) * 256 + ascii(l_linestatus) AS genre_pos,
                    CASE WHEN CAST(l_quantity AS INTEGER) >= 48 THEN 0 ELSE 1 END AS src FROM lineitem),
    drawn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY genre ORDER BY src, position, popularity, duration_ms) AS rn FROM hits) WHERE rn <= {N}),
    uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY genre_pos, src, position, popularity, duration_ms) AS first FROM drawn) WHERE first = 1),
    catalog AS (SELECT 'target-' || lower(genre) AS target_genre, genre, track_id, position, popularity, duration_ms FROM uniq)"""


@query(
    "catalog_build",
    f"WITH {_CATALOG_SQL} SELECT target_genre, genre, track_id, position, popularity, duration_ms FROM catalog",
)
def catalog_build(spark, folder):
    return _catalog(spark, folder).select("target_genre", "genre", "track_id", "position", "popularity", "duration_ms")


@query(
    "genre_summary",
    """
    SELECT p_type AS genre, count(*) AS track_count, round_even(avg(p_size) * 100, 0) / 100 AS avg_popularity,
           round_even(avg(p_partkey * 100) / 60000 * 100, 0) / 100 AS avg_duration_min FROM part GROUP BY p_type""",
)
def genre_summary(spark, folder):
    tracks = table(spark, folder, "part").select(
        F.col("p_type").alias("genre"),
        F.col("p_partkey").alias("track_id"),
        F.col("p_size").alias("popularity"),
        (F.col("p_partkey") * 100).alias("duration_ms"),
    )
    return catalog.genre_summary(tracks)


@query(
    "genre_totals",
    "SELECT count(*) AS total_tracks, count(DISTINCT p_type) AS unique_genres FROM part",
)
def genre_totals(spark, folder):
    return catalog.catalog_totals(table(spark, folder, "part"), "p_type").select(
        "total_tracks", "unique_genres"
    )
