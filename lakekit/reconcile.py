"""Refined data against raw data: order-free digests per key range, narrowed down to the ranges that differ.

Two tables hold the same rows exactly if every key range has the same number
of rows and the same sums of row hashes.  Each pass digests both sides by
ranges of the key, which is a partial aggregate over one scan, and goes on only
with ranges that differ, each cut into as many smaller ones.  Rows are never
sorted, joined with each other or brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.session import work_path

_DIGEST = ("rows", "high", "low", "other")


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell multisets of rows apart: their number and sums of two independent hashes, which don't overflow below 2^31 rows."""
    shape = [c for name in columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]  # a null leaves a hash as it is
    wide, other = F.xxhash64(*shape), F.hash(*shape).cast("bigint")
    return [
        F.count("*").alias("rows"),
        F.sum(F.shiftright(wide, 32)).alias("high"),
        F.sum(wide.bitwiseAND(F.lit((1 << 32) - 1))).alias("low"),
        F.sum(other).alias("other"),
    ]


def _keyed(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.select(F.col(f"`{key}`").cast("bigint").alias("__key"), *[F.col(f"`{c}`") for c in columns if c != key])


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None, fan: int = 1000, leaf: int = 1) -> DataFrame:
    """``(lo, hi, left_rows, right_rows)``: the key ranges, of at most ``leaf`` values, whose rows differ.

    ``key`` is a whole number; rows without a key are one range (``lo`` and
    ``hi`` null).  ``columns`` (default: the left side's) are compared as they
    are stored, also between nulls.  Repeated rows count as often as they are
    there.  Every pass cuts a range into ``fan``: the number of passes is that
    of the digits of the keys' span to this base.  Two numbers, the least and
    the greatest key, go to the driver.
    """
    columns = list(columns or left.columns)
    spark = left.sparkSession
    sides = [_keyed(df, key, columns) for df in (left, right)]
    names = [c for c in sides[0].columns]
    ends = [df.agg(F.min("__key"), F.max("__key")).first() for df in sides]
    lows, highs = [e[0] for e in ends if e[0] is not None], [e[1] for e in ends if e[1] is not None]
    low, span = (min(lows), max(highs) - min(lows) + 1) if lows else (0, 1)
    widths = [leaf]
    while widths[-1] * fan < span:
        widths.append(widths[-1] * fan)
    bad, parent_width = None, None
    for width in reversed(widths):
        digests = []
        for df, side in zip(sides, ("l", "r")):
            place = F.call_function("div", F.col("__key") - F.lit(low).cast("bigint"), F.lit(width).cast("bigint"))
            df = df.withColumn("__range", place)
            if bad is not None:
                above = F.call_function("div", F.col("__range"), F.lit(parent_width // width).cast("bigint"))
                df = df.withColumn("__above", above).join(bad, F.col("__above").eqNullSafe(F.col("__bad")), "left_semi")
            digest = df.groupBy("__range").agg(*row_digest(names))
            digests.append(digest.select(F.col("__range").alias(f"{side}_range"), *[F.col(c).alias(f"{side}_{c}") for c in _DIGEST]))
        both = digests[0].join(digests[1], F.col("l_range").eqNullSafe(F.col("r_range")), "full_outer")
        equal = [F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in _DIGEST]
        differ = both.where(~(equal[0] & equal[1] & equal[2] & equal[3]))
        place = F.coalesce("l_range", "r_range")
        found = differ.select(place.alias("__bad"), *[F.coalesce(f"{s}_rows", F.lit(0)).alias(n) for s, n in (("l", "left_rows"), ("r", "right_rows"))])
        path = work_path(spark, "reconcile")
        found.write.parquet(path)
        found = spark.read.schema(found.schema).parquet(path)
        bad, parent_width = found.select("__bad"), width
    lo = F.col("__bad") * leaf + low
    return found.select(lo.alias("lo"), (lo + (leaf - 1)).alias("hi"), "left_rows", "right_rows")


def expect_equal(left: DataFrame, right: DataFrame, check: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One check row: both sides hold the same rows, as often, in any order (one scan of each)."""
    columns = list(columns or left.columns)
    a, b = (df.agg(F.struct(*row_digest(columns)).alias("d")) for df in (left, right))
    both = a.select(F.col("d").alias("l"), b.select("d").scalar().alias("r"))
    detail = F.concat(F.lit("rows="), F.col("l.rows"), F.lit(" / "), F.col("r.rows"))
    return both.select(F.lit(check).alias("check"), F.when(F.col("l") == F.col("r"), "OK").otherwise("FAIL").alias("status"), detail.alias("detail"))
