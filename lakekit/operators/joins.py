"""Join helpers.

The strategy is Catalyst's: it broadcasts a side only by its size in bytes,
and adaptive execution re-plans from what the shuffles really hold and splits
the partitions of a skewed key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "inner", merge: bool = False) -> DataFrame:
    """Fact x dimension join; ``merge`` asks for a sort-merge join, whose skewed partitions can be split."""
    return fact.join(dim.hint("merge") if merge else dim, on=on, how=how)


def join_literal(fact: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join to a small (usually inline literal) relation, whose size Catalyst knows."""
    return fact.join(small, on=on, how=how)


def unmatched(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a partner in ``right`` (left anti join)."""
    return left.join(right, on=on, how="left_anti")
