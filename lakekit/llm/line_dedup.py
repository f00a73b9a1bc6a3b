"""Line dedup with levelled sorted runs of line hashes, in DataFrame operations only.

The keys of all lines seen so far live in *runs*: Parquet files bucketed by key
hash, one sorted file to a bucket.  All runs have the same buckets, so a batch of
keys, dealt and sorted once, is merge-joined with one run after the other, which
are neither exchanged nor sorted again.  Lines whose key is in a run are dropped,
and the keys that are new form a run of level 0.  Once a level holds ``fanout``
runs they are merged, bucket by bucket, into one run of the next level, so each
key is rewritten only a logarithmic number of times.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm.common import BLANKS, lower_ascii, materialize, release
from lakekit.session import work_path


#: While runs are read: the sorted file of a bucket counts as sorted, and a scan keeps to the buckets also where nothing is joined.
BUCKETED = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


@contextmanager
def bucketed(spark: SparkSession):
    """The settings under which runs are read; those of the session come back afterwards."""
    before = {key: spark.conf.get(key) for key in BUCKETED}
    try:
        for key, value in BUCKETED.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class LineRuns:
    """The sorted runs, by level.  Folders only: nothing is kept in memory but their paths.

    ``buckets`` (default: the session's shuffle partitions) is fixed for the
    life of the runs.  A run is opened by declaring a bucketed table over its
    folder, which is dropped from the catalog once the plan holds it.  Plans over
    runs are to be executed within ``bucketed``.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def _open(self, path: str) -> DataFrame:
        """The bucketed files of a folder, or of the folders in it."""
        name = f"lk_run_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} (key binary) USING parquet OPTIONS (recursiveFileLookup 'true') "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        table = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
        return table

    def _write(self, keys: DataFrame, path: str) -> None:
        """Keys, already dealt by key to the buckets, as one sorted file each."""
        name = f"lk_run_{uuid.uuid4().hex}"
        keys.write.bucketBy(self.buckets, "key").sortBy("key").format("parquet").option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def _group(self, level: int) -> str:
        """The folder of a level's present runs."""
        held = self.levels[level]
        return held[0].rsplit("/", 1)[0] if held else work_path(self.spark, "line-runs")

    def new_of(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` whose key is in no run (merge anti joins)."""
        return reduce(lambda left, path: left.join(self._open(path).hint("merge"), "key", "left_anti"), self.paths(), keys)

    def seen(self) -> DataFrame | None:
        """All keys."""
        paths = self.paths()
        return reduce(DataFrame.unionByName, map(self._open, paths)) if paths else None

    def add(self, keys: DataFrame) -> None:
        """Add new keys (distinct, in no run yet) as a run and compact full levels."""
        level, keys = 0, keys.select("key").repartition(self.buckets, "key")
        while True:
            if level == len(self.levels):
                self.levels.append([])
            path = f"{self._group(level)}/run-{len(self.levels[level])}"
            with bucketed(self.spark):
                self._write(keys, path)
            self.levels[level].append(path)
            if len(self.levels[level]) < self.fanout:
                return
            # the level's runs read as one table: a bucket's files together in one task, which merges them
            keys, self.levels[level] = self._open(self._group(level)), []
            level += 1


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``(id, tid, key, pos)``: one row per line whose key is long enough.

    The key is the 128-bit hash of the line without ASCII white space at both
    ends and with A-Z lower-cased; ``tid`` tells rows of one id with different
    texts apart.  Rows without an id have no keys.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = (
        docs.where(F.col(f"`{id_col}`").isNotNull())
        .select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("tid"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
        .withColumn("line", lower_ascii(F.btrim("line", F.lit(BLANKS))))
        .where(F.char_length("line") >= min_chars)
    )
    return lines.select("id", "tid", F.unhex(F.md5("line")).alias("key"), "pos")


def batch_drops(keys: DataFrame, runs: LineRuns) -> DataFrame:
    """Lines of one batch to drop, as ``(id, tid, pos)``; the batch's new keys join the runs.

    Within a batch the smallest id keeps the line; ids of later batches are
    expected to be larger.
    """
    owners = keys.groupBy("key").agg(F.min("id").alias("owner"))
    with bucketed(runs.spark):
        fresh = materialize(runs.new_of(owners), "line-owners")
    drops = keys.join(fresh, "key", "left").where("owner is null or id <> owner").select("id", "tid", "pos")
    drops = materialize(drops, "line-drops")
    runs.add(fresh)
    return drops


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    batches: int = 4,
    fanout: int = 3,
    runs: LineRuns | None = None,
) -> DataFrame:
    """Drop every line whose key an earlier document holds.

    Returns the input's columns with the remaining text, plus ``lk_n_lines``
    (lines before) and ``lk_n_dropped``.  Documents go through in ``batches``
    ranges of ids; pass ``runs`` to go on from earlier calls.  A key's lines
    all stay in the smallest id holding it, also where it repeats them.

    Null and empty texts are one empty line (a null stays null); lines whose
    key has fewer than ``min_chars`` code points always stay.  Rows without an
    id pass unchanged and own nothing.  Repeated rows are one document and
    get the same result; rows of one id with different texts are parts of one
    document.  An empty table gives an empty result.  Other columns may have any
    names; input columns named like the two added ones give way to them.
    """
    spark = docs.sparkSession
    runs = runs or LineRuns(spark, fanout)
    keys = line_keys(docs, id_col, text_col, min_chars)
    cuts = docs.select(F.col(f"`{id_col}`").alias("id")).approxQuantile("id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    cuts = sorted({int(c) for c in cuts})
    batch = reduce(lambda x, c: x + (F.col("id") > c).cast("int"), cuts, F.lit(0))
    path = work_path(spark, "line-keys")
    keys.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(keys.withColumn("batch", F.lit(0)).schema).parquet(path)
    parts = [batch_drops(stored.where(F.col("batch") == i).drop("batch"), runs) for i in range(len(cuts) + 1)]
    drops = reduce(DataFrame.unionByName, parts)
    drops = drops.groupBy(F.col("id").alias("drop_id"), F.col("tid").alias("drop_tid")).agg(F.collect_set("pos").alias("drops"))
    release(spark)

    # by place, as names may clash
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    joined = rows.join(drops, (own_id == F.col("drop_id")) & (F.xxhash64(F.coalesce(own_text, F.lit(""))) == F.col("drop_tid")), "left")
    joined = joined.withColumn("lines", F.split(F.coalesce(own_text, F.lit("")), "\n", -1))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col("lines"), i)), "\n")
    joined = joined.withColumn("kept", F.when(F.col("drops").isNull(), own_text).otherwise(kept))
    added = {"lk_n_lines": F.size("lines").cast("bigint"), "lk_n_dropped": F.coalesce(F.size("drops"), F.lit(0)).cast("bigint")}
    return joined.select(
        *[F.col("kept" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added],
        *[column.alias(name) for name, column in added.items()],
    )
