"""End-to-end jobs and the registered queries."""

from timbrel.plans import (  # noqa: F401
    catalog_queries,
    job_queries,
    whole_job_queries,
    media_queries,
    metric_queries,
    order_queries,
    parse_queries,
    sink_queries,
    stage_queries,
    stream_queries,
)
from timbrel.plans.registry import QUERIES, SQL  # noqa: F401
