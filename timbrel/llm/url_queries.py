"""The URL filter over the whole of ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timbrel.llm.redirects import Rule, url_filter
from timbrel.llm.registry import query

# The rules of the query.
RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]
_RULES_SQL = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)


def _attribute(name: str) -> str:
    pattern = rf"""(?i)[\s"'']{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))"""
    return "replace(" + " || ".join(f"regexp_extract(tag, '{pattern}', {k})" for k in (1, 2, 3)) + ", '&amp;', '&')"


def _judged(source: str) -> str:
    """The longest fitting rule for each ``id, host, path``."""
    return f"""
        SELECT s.*, r.host || r.path AS rule, r.verdict AS ruled FROM {source} s LEFT JOIN rules r
        ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
        QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY length(r.host || r.path) DESC NULLS LAST,
                                   r.verdict, r.host || r.path DESC) = 1"""


_HOST = r"coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = r"coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '')"
_NODE = rf"regexp_replace({_HOST}, ':(80|443)$', '') || CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END"
_PARTS = rf"""
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
    regexp_extract(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END, '^[^/?#]*([^#]*)', 1) AS tail"""


@query(
    "op13_redirect_url_filter",
    rf"""
    WITH RECURSIVE rules(verdict, host, path) AS (VALUES {_RULES_SQL}),
    p AS (SELECT row_number() OVER () AS id, page_id, url, coalesce(html, '') AS html, {_PARTS} FROM pages),
    seen AS (SELECT *, {_HOST} AS host, {_PATH} AS path, CASE WHEN contains(url, '://') THEN {_NODE} END AS node FROM p),
    judged AS ({_judged("seen")}),
    tags AS (SELECT url, rest, unnest(regexp_extract_all(
                 regexp_replace(regexp_replace(html, '(?is)<body\b.*$', ''), '(?s)<!--.*?-->', '', 'g'),
                 '(?i)<(?:link|meta)\b[^>]*>')) AS tag
             FROM p WHERE contains(url, '://')),
    raw AS (SELECT url, rest, CASE
                WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches({_attribute("rel")}, '(?i)(^|\s)canonical(\s|$)')
                THEN {_attribute("href")}
                WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches({_attribute("http-equiv")}, '(?i)^\s*refresh\s*$')
                THEN regexp_extract({_attribute("content")}, '(?i)^[\s\d.]*[;,]\s*url\s*=\s*["'']?([^"'']*)', 1) END AS link
            FROM tags),
    links AS (SELECT url AS source, regexp_extract(url, '^[^:]*://[^/?#]*') AS site, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS own,
                     regexp_replace(link, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS link FROM raw WHERE link IS NOT NULL),
    pairs AS (SELECT row_number() OVER () AS pair, source, CASE
                WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
                WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
                WHEN starts_with(link, '//') THEN 'http:' || link
                WHEN starts_with(link, '/') THEN site || link
                WHEN starts_with(link, '?') THEN site || own || link
                ELSE site || CASE WHEN own = '' THEN '/' ELSE regexp_extract(own, '^.*/') END || link END AS target
              FROM links WHERE link <> '' AND NOT starts_with(link, '#')),
    both_ends AS (SELECT 2 * pair AS id, source AS url FROM pairs WHERE target IS NOT NULL
                  UNION ALL SELECT 2 * pair + 1, target FROM pairs WHERE target IS NOT NULL),
    end_parts AS (SELECT id, url, {_PARTS} FROM both_ends),
    end_nodes AS (SELECT id, {_HOST} AS host, {_PATH} AS path, {_NODE} AS node FROM end_parts),
    end_judged AS ({_judged("end_nodes")}),
    edges AS (SELECT a.node AS a, b.node AS b FROM end_nodes a JOIN end_nodes b ON a.id // 2 = b.id // 2 AND a.id <> b.id),
    blocked(node) AS (SELECT node FROM end_judged WHERE ruled = 'block'
                      UNION SELECT edges.b FROM blocked JOIN edges ON edges.a = blocked.node)
    SELECT page_id, host, path, rule,
           coalesce(ruled, CASE WHEN node IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged
    """,
)
def op13_redirect_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    found = url_filter(spark.read.parquet(f"{folder}/pages.parquet"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")
