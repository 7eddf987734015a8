"""Joining a fact stream to a dimension table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on: Column | str | list, how: str = "inner") -> DataFrame:
    """Join ``fact`` to ``dim`` without a blind broadcast hint.

    The size check is left to Spark: the planner broadcasts only below
    ``spark.sql.autoBroadcastJoinThreshold`` (estimated from file statistics),
    and AQE re-plans a shuffle join as a broadcast only when the *measured*
    shuffle output is below the adaptive threshold. Otherwise it stays a
    sort-merge join, with AQE splitting skewed fact partitions.
    """
    return fact.join(dim, on=on, how=how)
