"""Grouped and global aggregation building blocks.

All of them are single ``groupBy().agg()`` calls, so Spark plans a partial
(map-side) aggregate before the shuffle and a final one after it: a hot
key that holds a large share of the rows is combined inside each task and
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.columns import money_sum


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sum_by(df: DataFrame, keys, value: str, alias: str, exact_money: bool = True) -> DataFrame:
    agg = money_sum(value) if exact_money else F.sum(value)
    return df.groupBy(*_keys(keys)).agg(agg.alias(alias))


def count_by(df: DataFrame, keys, col: str, alias: str) -> DataFrame:
    """Non-NULL count of ``col`` per group (``"*"`` counts rows)."""
    return df.groupBy(*_keys(keys)).agg(F.count(col).alias(alias))


def rollup_sum(df: DataFrame, keys, money: Sequence[str] = (), counts: Sequence[str] = ()) -> DataFrame:
    """Re-aggregate already aggregated measures to coarser keys."""
    aggs = [money_sum(m).alias(m) for m in money]
    aggs += [F.sum(c).cast("bigint").alias(c) for c in counts]
    return df.groupBy(*_keys(keys)).agg(*aggs)


def order_desc(*cols: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in cols]


def top_k(df: DataFrame, order: Sequence[Column], k: int, tie: Sequence[str] = ()) -> DataFrame:
    """ORDER BY ... LIMIT k with a unique tie-breaker.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top k,
    so no full sort and no single task sees more than k rows per input task.
    """
    return df.orderBy(*order, *[F.asc_nulls_last(t) for t in tie]).limit(k)


def top_sum(df: DataFrame, measure: str, k: int, tie: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """One-row sum of ``measure`` over the top k rows by ``measure``."""
    top = top_k(df.select(measure, *tie), [F.desc_nulls_last(measure)], k, tie)
    return top.agg(money_sum(measure).alias(alias or f"{measure}_top{k}"))
