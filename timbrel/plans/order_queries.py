"""Positions, samples and limits in an explicit order."""

from __future__ import annotations

from timbrel.operators import positions
from timbrel.plans.registry import query, table


@query(
    "every_nth",
    """
    SELECT o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i FROM orders) WHERE i % 100 = 0""",
)
def every_nth(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return positions.every_nth(orders, 100, "o_totalprice", "o_orderkey")


@query(
    "batch_ids",
    """
    SELECT page_id, url, CAST(floor(i / 16) AS BIGINT) AS batch_id, CAST(i % 16 AS INTEGER) AS batch_pos FROM (
        SELECT *, row_number() OVER (ORDER BY url, page_id) - 1 AS i FROM pages)""",
)
def batch_ids(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return positions.with_batch_id(pages, 16, "url", "page_id")


@query(
    "line_positions",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS position
    FROM lineitem""",
)
def line_positions(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return positions.with_position(lines, *lines.columns).drop("l_shipdate")


@query(
    "find_first",
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 1",
)
def find_first(spark, folder):
    return positions.find_first(table(spark, folder, "customer"), "c_mktsegment", "BUILDING", "c_custkey").select(
        "c_custkey", "c_name"
    )


@query(
    "sample_per_status",
    """
    SELECT o_orderstatus, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn <= 5""",
)
def sample_per_status(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderkey", "o_orderdate")
    return positions.top_per_group(orders, 5, ["o_orderstatus"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@query("bounded_read", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20")
def bounded_read(spark, folder):
    return positions.first_rows(table(spark, folder, "orders"), 20, "o_orderdate", "o_orderkey").select(
        "o_orderkey", "o_custkey"
    )


@query("sorted_paths", "SELECT url FROM pages ORDER BY url")
def sorted_paths(spark, folder):
    return table(spark, folder, "pages").select("url").orderBy("url")
