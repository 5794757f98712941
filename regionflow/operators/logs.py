"""Validation of stages by their logs, one row per line (task_index, line)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def any_of(terms: list[str]):
    out = F.lit(False)
    for t in terms:
        out = out | F.lower("line").contains(t.lower())
    return out


def check_terms(logs: DataFrame, success: list[str], error: list[str]) -> DataFrame:
    """task_index, ok: every success term somewhere, no error term anywhere; case does not count."""
    good = F.lit(True)
    for t in success:
        good = good & F.bool_or(F.lower("line").contains(t.lower()))
    return logs.groupBy("task_index").agg((good & ~F.bool_or(any_of(error))).alias("ok"))


def failed(logs: DataFrame, success: list[str], error: list[str]) -> DataFrame:
    return check_terms(logs, success, error).where("not ok").select("task_index")
