"""Distinct counts that merge: bitmaps over dense ids, stored with each delivery.

A count of distinct ids can't be added up, a bitmap can: each delivery adds the
numbers of its new ids to a dictionary and stores one bitmap per (keys, bucket
of 32,768 numbers).  Counts over any deliveries are the bits of their united
bitmaps, so no earlier delivery is read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakekit.commits import CommitLog


class DistinctLedger:
    """Stored bitmaps of the ids of ``id_col`` by ``keys`` at ``location``.

    New ids are numbered in the order of the keys, so a group's ids lie in few
    buckets and the bitmaps take about a bit for each id and group.  Null ids
    are not counted, a null key is a group.  Deliveries are committed by
    number: a failed one leaves no trace, of two at once one gets
    ``ConcurrentPublish``.
    """

    def __init__(self, spark: SparkSession, location: str, keys: Sequence[str], id_col: str):
        self.spark, self.location, self.keys, self.id_col = spark, location.rstrip("/"), list(keys), id_col
        self.log = CommitLog(spark, location)

    def _stored(self, kind: str, schema: str, upto: int) -> DataFrame | None:
        if not upto:
            return None
        paths = [f"{self.location}/{kind}/delivery={n}/{self.log.read(n).entry['folder']}" for n in self.log.numbers() if n <= upto]
        return self.spark.read.schema(schema).parquet(*paths)

    def _key_schema(self, df: DataFrame) -> str:
        return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in self.keys)

    def add(self, delivery: DataFrame) -> int:
        """Store the delivery's bitmaps; returns its number."""
        base = self.log.last_number()
        number, folder = base + 1, f"attempt={uuid.uuid4().hex}"
        rows = delivery.where(F.col(self.id_col).isNotNull()).select(*self.keys, F.col(self.id_col).cast("string").alias("id")).distinct()
        known = self._stored("dictionary", "id string, number bigint", base)
        fresh = rows.groupBy("id").agg(*[F.min(k).alias(f"k{i}") for i, k in enumerate(self.keys)])
        fresh = fresh if known is None else fresh.join(known.select("id"), "id", "left_anti")
        # numbered by ranges of the keys: the place in a range, which files keep, after the counts of the ranges before
        order = [f"k{i}" for i in range(len(self.keys))] + ["id"]
        path = f"{self.location}/dictionary/delivery={number}/{folder}"
        drafts = f"{self.location}/drafts/delivery={number}/{folder}"
        ranged = fresh.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.select("id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")).write.parquet(drafts)
        placed = self.spark.read.schema("id string, part int, place bigint").parquet(drafts)
        parts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
        first = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each task
        before = parts.select("part", (first - F.col("first")).alias("shift"))
        start = self.log.read(base).entry["ids"] if base else 0
        numbered = placed.join(before, "part").select("id", (F.col("place") + F.col("shift") + start).alias("number"))
        numbered.write.parquet(path)
        added = self.spark.read.schema("id string, number bigint").parquet(path)
        dictionary = added if known is None else known.unionByName(added)
        bitmaps = rows.join(dictionary, "id").groupBy(*self.keys, F.expr("bitmap_bucket_number(number)").alias("bucket"))
        bitmaps = bitmaps.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("bits"))
        bitmaps.write.parquet(f"{self.location}/bitmaps/delivery={number}/{folder}")
        return self.log.commit(base, {"folder": folder, "ids": start + added.count(), "keys": self._key_schema(delivery)})

    def bitmaps(self) -> DataFrame:
        """``(keys..., bucket, bits)``: the united bitmaps of all deliveries."""
        last = self.log.latest()
        if last is None:
            raise FileNotFoundError(f"no delivery at {self.location}")
        stored = self._stored("bitmaps", f"{last.entry['keys']}, bucket bigint, bits binary", last.number)
        return stored.groupBy(*self.keys, "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))

    def counts(self, *by: str, alias: str = "distinct_ids") -> DataFrame:
        """Distinct ids by some of the keys (default: all of them; merges over the others)."""
        by = by or tuple(self.keys)
        merged = self.bitmaps().groupBy(*by, "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        return merged.groupBy(*by).agg(F.sum(F.expr("bitmap_count(bits)")).alias(alias))

    def total(self, alias: str = "distinct_ids") -> DataFrame:
        """Distinct ids over all groups (one row)."""
        merged = self.bitmaps().groupBy("bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        return merged.agg(F.coalesce(F.sum(F.expr("bitmap_count(bits)")), F.lit(0)).alias(alias))

