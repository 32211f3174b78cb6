"""URL rules, and blocks that reach the aliases of a page over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.llm.chosen_path import components
from timbrel.llm.rows import SHARES, field, keyed, sieve, sifted, with_groups, written

#: Rules are part of the plan, so their number has a bound.
MOST_RULES = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``verdict`` (allow or block) for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def page_key(url: Column) -> Column:
    """What names a page in the graph: host, path and query; null where the url has no ``://``.

    Scheme, default port and fragment do not tell pages apart; an empty path is ``/``.
    """
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    tail = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    key = F.concat(host, F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail)))
    return F.when(F.instr(url, "://") > 0, F.unhex(F.md5(key)))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, of equal ones an allowing one; null if none fits.

    Rules are looked up by the ends of the host, so a url is compared with the
    rules of its own domains only.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are more than {MOST_RULES}")
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    entry = "struct<size:int,allow:int,path:string,rule:string,verdict:string>"
    pairs: list[Column] = []
    for name, own in by_host.items():
        entries = [
            F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(int(r.verdict == "allow")).alias("allow"),
                     F.lit(r.path).alias("path"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
            for r in own
        ]
        pairs += [F.lit(name), F.array(*entries)]
    table = F.create_map(*pairs) if pairs else F.lit(None).cast(f"map<string,array<{entry}>>")
    labels = F.size(F.split(host, r"\."))
    ends = F.transform(F.sequence(F.lit(1), labels), lambda k: F.call_function("substring_index", host, F.lit("."), -k))
    near = F.flatten(F.filter(F.transform(ends, lambda e: F.try_element_at(table, e)), lambda x: x.isNotNull()))
    best = F.array_max(F.filter(near, lambda r: path.startswith(r["path"])))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, with double, single or no quotes."""
    pattern = rf"""(?i)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])
    return F.replace(value, F.lit("&amp;"), F.lit("&"))


def _without_dots(url: Column) -> Column:
    """``.`` and ``..`` of a path resolved."""
    start = F.regexp_extract(url, r"^[^:]*://[^/?#]*", 0)
    path = F.regexp_extract(url, r"^[^:]*://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^:]*://[^/?#]*[^?#]*(.*)$", 1)
    steps = F.filter(F.split(path, "/"), lambda s: s != ".")
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.array_append(done, s)),
    )
    ends_open = path.rlike(r"/\.\.?$")
    joined = F.concat(start, F.array_join(kept, "/"), F.when(ends_open, "/").otherwise(""), tail)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(url)


def resolved(base: Column, link: Column) -> Column:
    """The link as seen from the page ``base``; null if it names no other page (empty, a fragment, mailto)."""
    link = F.regexp_replace(link, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    site = F.regexp_extract(base, r"^[^:]*://[^/?#]*", 0)
    path = path_of(base)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^.*/", 0))
    full = (
        F.when((link == "") | link.startswith("#"), None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, path, link))
        .otherwise(F.concat(site, folder, link))
    )
    return F.when(F.instr(base, "://") > 0, _without_dots(full))


def declared_links(url: Column, html: Column) -> Column:
    """Pages that the head of a page names as its canonical address or redirects to, as full urls."""
    head = F.regexp_replace(F.split(html, r"(?i)<body\b", 2)[0], r"(?s)<!--.*?-->", "")
    tags = F.regexp_extract_all(head, F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))

    def target(tag: Column) -> Column:
        canonical = tag.rlike("(?i)^<link") & _attribute(tag, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
        refresh = tag.rlike("(?i)^<meta") & _attribute(tag, "http-equiv").rlike(r"(?i)^\s*refresh\s*$")
        later = F.regexp_extract(_attribute(tag, "content"), r"""(?i)^[\s\d.]*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)
        return F.when(canonical, resolved(url, _attribute(tag, "href"))).when(refresh, resolved(url, later))

    found = F.filter(F.transform(tags, target), lambda t: t.isNotNull())
    return F.coalesce(found, F.array().cast("array<string>"))


def url_filter(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: row, page_id, host, path, rule, verdict, alias_blocked.

    The longest rule that fits decides a page. Pages without a rule are blocked
    if a page that a rule blocks is an alias of theirs, and allowed otherwise;
    a page that a rule allows stays allowed whatever its aliases are, and an
    alias need not be in the table. Aliases are the connected components over
    the canonical links and refreshes in the head of each page and over
    ``redirects`` (``from_url``, ``to_url``, such as a crawler's log). Scheme,
    default port and fragment do not make another page.

    A null url, or one without ``://``, has an empty host and path, no aliases,
    and is allowed unless a rule names the empty host. A null html has no
    links. Very long pages are read up to their body by expressions of Spark;
    repeated rows count one by one; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = keyed(pages)
    url, html = field("url", rows, "string"), F.coalesce(field("html", rows, "string"), F.lit(""))
    shown = rows.select("row", field("page_id", rows, "bigint").alias("page_id"), url.alias("url"), html.alias("html"))
    seen = shown.select(
        "row", "page_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"), page_key(F.col("url")).alias("node"), "url",
        F.when(F.instr("url", "://") > 0, declared_links(F.col("url"), F.col("html"))).alias("links"),
    )
    judged = seen.withColumn("judged", rule_of(F.col("host"), F.col("path"), rules))
    judged = written(judged.select("row", "page_id", "host", "path", "node", "url", "links", "judged.rule", "judged.verdict"), "url-rules")

    edges = judged.filter(F.size("links") > 0).select(F.col("url").alias("a"), F.explode("links").alias("b"))
    if redirects is not None:
        edges = edges.union(redirects.select("from_url", "to_url"))
    ends = written(_ends(edges, rules), "url-edges")
    tainted = written(_tainted(ends), "url-blocked")

    open_rows = judged.filter("verdict IS NULL AND node IS NOT NULL").select("row", "node")
    marked = sifted(open_rows, "node", sieve(tainted, "node")).filter("maybe")
    shared = marked.select("row", "node", F.pmod(F.xxhash64("row"), F.lit(SHARES)).alias("share"))
    hit = shared.select("node", "share").distinct().join(tainted, "node", "left_semi")
    blocked = shared.join(hit, ["node", "share"]).select("row")
    done = judged.select("row", "page_id", "host", "path", "rule", "verdict")
    doubt = sifted(done, "row", sieve(blocked, "row"))
    aliases = doubt.filter("maybe").join(blocked.withColumn("alias_blocked", F.lit(True)), "row", "left")
    every = doubt.filter("not maybe").withColumn("alias_blocked", F.lit(False)).unionByName(aliases)
    by_alias = F.coalesce("alias_blocked", F.lit(False))
    verdict = F.coalesce("verdict", F.when(by_alias, "block").otherwise("allow"))
    return every.select(
        "row", "page_id", "host", "path", "rule", verdict.alias("verdict"), by_alias.alias("alias_blocked"))


def _ends(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """u, v (page keys) and whether rules block them."""

    def blocks(url: str) -> Column:
        of = rule_of(host_of(F.col(url)), path_of(F.col(url)), rules)
        return F.coalesce(of["verdict"] == "block", F.lit(False))

    keyed_ends = edges.select(
        page_key(F.col("a")).alias("u"), page_key(F.col("b")).alias("v"), blocks("a").alias("u_blocked"), blocks("b").alias("v_blocked")
    )
    return keyed_ends.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()


def _tainted(ends: DataFrame) -> DataFrame:
    """Keys of all pages with a blocked page in their component."""
    nodes = ends.select(F.col("u").alias("node"), F.col("u_blocked").alias("blocked")).union(ends.select("v", "v_blocked"))
    nodes = nodes.groupBy("node").agg(F.bool_or("blocked").alias("blocked"))
    roots = components(ends.select("u", "v")).withColumnRenamed("u", "node")
    placed = nodes.join(roots, "node", "left").select("node", "blocked", F.coalesce("root", "node").alias("root"))
    return with_groups(placed, ["root"], ~F.col("blocked"), by="node").filter("NOT best").select("node")
