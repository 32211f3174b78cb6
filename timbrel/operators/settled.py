"""Frames that several steps of an operator read, evaluated once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from timbrel.session import run_dir

#: Nodes of a plan that reads a table again as cheaply as a written copy of it.
_READS = {"Project", "Filter", "LogicalRelation"}


def _is_scan(df: DataFrame) -> bool:
    """A deterministic selection from one table, without user code."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if not plan.deterministic():
        return False
    while plan.nodeName() in _READS:
        if plan.children().size() == 0:
            return True
        plan = plan.children().apply(0)
    return False


def settled(df: DataFrame, label: str = "settled") -> DataFrame:
    """The frame, to be read more than once with the same rows each time.

    A plain selection from a table stays as it is: each reader takes the columns
    it needs. Everything else, such as a model's answers, is written once below
    the shared folder, so that it is neither paid for again nor different the
    next time, also when executors are lost. A stream stays as it is.
    """
    if df.isStreaming or _is_scan(df):
        return df
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
