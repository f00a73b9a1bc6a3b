"""Helpers shared by the operators: materialised steps, word shingles, connected components."""

from __future__ import annotations

import gc
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.session import work_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space, ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"


def materialize(df: DataFrame, purpose: str, parts: int | None = None, **options) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared working folder and read it back.

    Cuts the lineage with files that every executor sees, and lets Spark drop
    the shuffle files of the steps before.  ``parts`` limits the files of a
    table that is known to be small.
    """
    spark = df.sparkSession
    path = work_path(spark, purpose)
    (df if parts is None else df.coalesce(parts)).write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.lk_path = path
    del df
    release(spark)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of materialised tables that no later step reads."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.lk_path)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def bounded_batches(table: DataFrame) -> SparkSession:
    """Keep the Arrow batches that go to Python small, as rows can be long texts; returns the session.

    Lowers two settings of the session; the operators call it before they plan.
    """
    spark = table.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def release(spark: SparkSession) -> None:
    """Collect garbage, so that Spark's cleaner deletes shuffle files nobody can read any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker (tokenizers, tables)."""
    module = sys.modules.setdefault("_lakekit_worker", types.ModuleType("_lakekit_worker"))
    return module.__dict__.setdefault("cache", {})


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def small(batches, rows: int = 1000, size: int = 4 << 20):
    """The batches cut into slices of at most ``rows`` rows and about ``size`` bytes, so that Python objects stay few."""
    for batch in batches:
        step = max(1, min(rows, batch.num_rows * size // max(1, batch.nbytes)))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.large_binary()).to_pylist()]


def runs_of(sizes, limit: int):
    """Consecutive index ranges whose sizes add up to at most ``limit`` (a larger item stands alone)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


# --- word shingles ------------------------------------------------------------

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _tables(alnum: bool):
    key = ("word tables", alnum)
    cache = worker_cache()
    if key not in cache:
        b = np.arange(256, dtype=np.uint64)
        low = np.where((b >= 65) & (b <= 90), b + np.uint64(32), b)
        value = mix64((low + np.uint64(1)) * _M3)
        if alnum:
            gap = ~(((low >= 97) & (low <= 122)) | ((b >= 48) & (b <= 57)) | (b >= 128))
        else:
            gap = (b == 32) | ((b >= 9) & (b <= 13))
        cache[key] = value, gap
    return cache[key]


def _powers(n: int) -> np.ndarray:
    cache = worker_cache()
    if len(cache.get("powers", ())) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        factors = np.full(size, 0xD6E8FEB86659FD93, np.uint64)
        factors[0] = 1
        cache["powers"] = np.multiply.accumulate(factors)
    return cache["powers"]


def _words_in(buf: np.ndarray, alnum: bool):
    value, gap = _tables(alnum)
    inside = ~gap[buf]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1] + 1
    first = np.flatnonzero(new)
    starts = at[first]
    sizes = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    hashes = np.add.reduceat(value[buf[at]] * _powers(int(sizes.max()))[place], first)
    return mix64(hashes + sizes.astype(np.uint64) * _M3), starts, starts + sizes


def words_of(text: bytes, alnum: bool = False, piece: int = 1 << 20):
    """Hashes, start and end offsets of a text's words, A-Z lower-cased.

    Words are runs without ASCII white space (``alnum``: runs of ASCII letters,
    digits and non-ASCII bytes).  Long texts are cut between words, so memory
    stays bounded by the piece, the longest word and eight bytes a word.
    """
    buf = np.frombuffer(text, np.uint8)
    _, gap = _tables(alnum)
    out, lo = [], 0
    while lo < len(buf):
        hi = min(len(buf), lo + piece)
        while hi < len(buf):
            gaps = np.flatnonzero(gap[buf[hi : hi + piece]])
            hi = hi + int(gaps[0]) if len(gaps) else min(len(buf), hi + piece)
            if len(gaps):
                break
        h, s, e = _words_in(buf[lo:hi], alnum)
        out.append((h, s + lo, e + lo))
        lo = hi
    if not out:
        return _words_in(buf, alnum)
    return tuple(np.concatenate(x) for x in zip(*out))


def grams_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words in order; with fewer words, of the whole sequence; none of none."""
    m = min(n, len(words))
    if not m:
        return np.empty(0, np.uint64)
    factor = mix64(np.arange(1, m + 1, dtype=np.uint64) * _M3) | np.uint64(1)
    total = np.full(len(words) - m + 1, m, np.uint64)
    for j in range(m):
        total = total + words[j : len(words) - m + 1 + j] * factor[j]
    return mix64(total)


def shingle_sets(texts: list[bytes], n: int, limit: int = 1 << 20):
    """The sorted distinct ``n``-word shingle hashes of each text (uint64 arrays)."""
    for lo, hi in runs_of([len(t) + 1 for t in texts], limit):
        if hi - lo == 1:
            yield np.unique(grams_of(words_of(texts[lo])[0], n))
            continue
        joined = b" ".join(texts[lo:hi])
        hashes, starts, _ = _words_in(np.frombuffer(joined, np.uint8), False)
        ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
        cuts = np.searchsorted(starts, ends)
        first = 0
        for cut in cuts:
            yield np.unique(grams_of(hashes[first:cut], n))
            first = cut


# --- connected components -----------------------------------------------------


def _forest(batches, most: int = 1_000_000):
    """Spanning forests of the edges of one partition: union-find with the smallest id as root.

    A forest goes out once it has ``most`` nodes, so memory doesn't follow the partition.
    """
    parent: dict[int, int] = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    def forest():
        nodes = list(parent)
        for lo in range(0, len(nodes), 100_000):
            part = nodes[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= most:
            yield from forest()
            parent.clear()
    yield from forest()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of an undirected graph; component = smallest id that links reach.

    Edges are first thinned to a spanning forest in each partition, then
    alternating large-star and small-star steps (joins on the smallest
    neighbour) run until nothing changes.  Each step is written to the shared
    working folder.  Nodes without a link and each component's smallest id are not
    returned; nulls and loops are ignored.
    """
    e = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where("a <> b")
    e = materialize(e.mapInArrow(_forest, "a bigint, b bigint").where("a <> b"), "components")
    parts = 1 + e.count() // 250_000  # later steps never have more edges
    if e.isEmpty():
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    mark = None
    while True:
        last = e
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # each vertex hangs below its smallest neighbour; roots keep nothing
        e = materialize(large.where("a <> b").distinct(), "components", parts)
        discard(last)
        last = e
        least = e.groupBy("a").agg(F.min("b").alias("low"))
        hung = e.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))
        e = materialize(hung.where("a <> b").distinct(), "components", parts)
        discard(last)
        now = e.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first()
        if now == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = now
