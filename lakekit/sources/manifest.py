"""Raw-file manifests by content, and change detection.

A manifest is one row per file: path, length, modification time and the
digest of its content.  Files are read in fixed byte ranges, many tasks to a
large file.  A range's leaf is the digest of the lines that begin in it; a
file's digest is the root of the hash tree over its leaves in order.
Comparing two manifests tells which raw inputs must be re-landed, comparing
their ranges tells where they differ.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that one leaf covers.  Part of the digest: manifests compare only if made with the same size.
RANGE_BYTES = 32 << 20
#: Leaves (or nodes) below one node of a file's hash tree; three levels hold 2^30 leaves.
TREE_FAN = 1024
TREE_LEVELS = 3


def _listing(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", F.col("length").cast("bigint").alias("length"), F.col("modificationTime").alias("modified"))


def file_ranges(spark: SparkSession, path: str, glob: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, start, bytes, md5)`` for every byte range of the files under ``path`` in which a line begins.

    ``bytes`` and ``md5`` are those of the lines that begin at ``start`` or
    later, before the next range, each with a line feed.  Ranges don't depend
    on the cluster: the scan gets a session of its own, whose splits are
    ``range_bytes`` long, one to a task.  Any bytes will do, but a line is held
    as one value, so this suits text deliveries and other files with line
    feeds.  Files that the reader decompresses by their name (``.gz``) are one
    range of their decompressed content.
    """
    session = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(key, str(range_bytes))
    reader = session.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )

    def leaves(batches):
        import pyarrow as pa

        def row():
            return pa.RecordBatch.from_pydict({"path": [at[0]], "start": [at[1]], "bytes": [size], "md5": [digest.hexdigest()]})

        at, digest, size = None, None, 0
        for batch in batches:
            for path, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, start) != at:
                    if at is not None:
                        yield row()
                    at, digest, size = (path, start), hashlib.md5(usedforsecurity=False), 0
                digest.update(line)
                digest.update(b"\n")
                size += len(line) + 1
        if at is not None:
            yield row()

    return lines.mapInArrow(leaves, "path string, start bigint, bytes bigint, md5 string")


def tree_digests(leaves: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = TREE_FAN) -> DataFrame:
    """``(path, md5)``: the root of each file's hash tree over ``(path, start, md5)``; no group holds more than ``fan`` nodes."""
    nodes = leaves.select("path", F.expr(f"start div {range_bytes}").alias("place"), "md5")
    for _ in range(TREE_LEVELS):
        below = F.array_sort(F.collect_list(F.struct("place", "md5")))
        joined = F.array_join(F.transform(below, lambda n: F.concat_ws(":", n["place"].cast("string"), n["md5"])), ",")
        nodes = nodes.groupBy("path", F.expr(f"place div {fan}").alias("up")).agg(F.md5(joined.cast("binary")).alias("md5"))
        nodes = nodes.withColumnRenamed("up", "place")
    return nodes.select("path", "md5")


def raw_file_manifest(spark: SparkSession, path: str, glob: str | None = None, with_md5: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, length, modified[, md5])`` for every file under ``path``.

    ``md5`` is the digest of the root of the file's hash tree (see
    ``file_ranges``) and its length.  Without digests only file metadata is
    listed and no file is opened.  Empty files are not listed, as Spark's
    readers pass over them.
    """
    files = _listing(spark, path, glob)
    if not with_md5:
        return files
    roots = tree_digests(file_ranges(spark, path, glob, range_bytes), range_bytes)
    # the listing writes a local path as file:/x, the reader as file:///x
    plain = files.withColumn("__at", _plain_path(F.col("path")))
    roots = roots.select(_plain_path(F.col("path")).alias("__at"), F.col("md5").alias("__root"))
    digest = F.md5(F.concat_ws("@", F.coalesce("__root", F.lit("")), F.col("length").cast("string")).cast("binary"))
    return plain.join(roots, "__at", "left").select("path", "length", "modified", digest.alias("md5"))


def _plain_path(path: Column) -> Column:
    """One spelling of a file's URI: decoded, without the empty authority."""
    return F.regexp_replace(F.try_url_decode(F.regexp_replace(path, r"\+", "%2B")), "^(\\w+):///", "$1:/")


def changed_ranges(new: DataFrame, old: DataFrame, key: str = "path") -> DataFrame:
    """Ranges of two ``file_ranges`` results that differ: ``(path, start, status)``, status ADDED, REMOVED or CHANGED."""
    n = new.select(F.col(key), "start", F.col("md5").alias("__new"))
    o = old.select(F.col(key), "start", F.col("md5").alias("__old"))
    status = F.when(F.col("__old").isNull(), "ADDED").when(F.col("__new").isNull(), "REMOVED").otherwise("CHANGED")
    both = n.join(o, [key, "start"], "full_outer").where(~F.col("__new").eqNullSafe(F.col("__old")))
    return both.select(key, "start", status.alias("status"))


def changed_files(new: DataFrame, old: DataFrame, key: str = "path") -> DataFrame:
    """Full outer join of two manifests -> (path, status, old_md5, new_md5).

    status: ADDED, REMOVED, CHANGED or UNCHANGED, by content digests where both
    manifests have them (an identical re-upload is UNCHANGED, other bytes of
    equal length and time are CHANGED), else by length and modification time.
    """
    digests = "md5" in new.columns and "md5" in old.columns
    sig = "md5" if digests else "signature"

    def signature(df):
        # without digests: length and modification time
        return F.col("md5") if digests else F.concat_ws("@", *[F.col(c).cast("string") for c in ("length", "modified") if c in new.columns and c in old.columns])

    n = new.select(F.col(key).alias("_k"), signature(new).alias("new_sig"), F.lit(True).alias("_n"))
    o = old.select(F.col(key).alias("_k"), signature(old).alias("old_sig"), F.lit(True).alias("_o"))
    joined = n.join(o, on="_k", how="full_outer")
    status = (
        F.when(F.col("_o").isNull(), "ADDED")
        .when(F.col("_n").isNull(), "REMOVED")
        .when(~F.col("old_sig").eqNullSafe(F.col("new_sig")), "CHANGED")
        .otherwise("UNCHANGED")
    )
    return joined.select(
        F.col("_k").alias(key),
        status.alias("status"),
        F.col("old_sig").alias(f"old_{sig}"),
        F.col("new_sig").alias(f"new_{sig}"),
    )
