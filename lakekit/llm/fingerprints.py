"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed share of the hash range, and
at least the ``FLOOR`` least ones (all, where there are fewer).  So its size
follows the document, sketches merge by union, and the share of one sketch
found in another estimates containment also between documents of very unequal
length; sets of up to ``FLOOR`` shingles are compared whole.

A sketch is an ascending array: the hashes, then its limit.  It holds every
hash of its document up to the limit, which is the greatest number where it
holds the whole set.  Only empty texts have an empty sketch, without a limit.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, shingle_sets, small

#: One shingle hash in so many is kept, and so many at least.
SCALE, FLOOR = 5, 256
#: Bits of a hash that a sketch holds, and the limit of sketches that hold the whole set.
BITS = 32
WHOLE = np.uint64((1 << BITS) - 1)


def _cut(hashes: np.ndarray, whole: bool, scale: int) -> np.ndarray:
    if not len(hashes):
        return hashes
    limit = np.uint64((1 << BITS) // scale - 1)
    keep = int(np.searchsorted(hashes, limit, "right"))
    if keep < FLOOR:
        keep = min(FLOOR, len(hashes))
        limit = hashes[keep - 1]
    if whole and keep == len(hashes):
        limit = WHOLE
    return np.append(hashes[:keep], limit)


def scaled(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of a set of 64-bit shingle hashes."""
    return _cut(np.unique(hashes >> np.uint64(64 - BITS)), True, scale)


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """The hashes of two sketches up to the smaller of both limits, and that limit."""
    limit = min(a[-1], b[-1])
    return *(x[:-1][: np.searchsorted(x[:-1], limit, "right")] for x in (a, b)), limit


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both documents' shingles together."""
    if not len(a) or not len(b):
        return a if len(a) else b
    a, b, limit = _common(a, b)
    return _cut(np.union1d(a, b), limit == WHOLE, scale)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller set's shingles that the other one has (0 to 1).

    Judged on the hashes up to the smaller of both limits; exact where both
    sketches hold their whole sets.  Two empty sketches are alike (1), an empty
    and another one are not (0).  Where the smaller set has no hash up to that
    limit, the estimate is 0, as for most pairs: its n shingles leave none
    against a long document with a probability of about (1 - 1 / SCALE) ** n.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    a, b, _ = _common(a, b)
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return float((b[at] == a).mean())


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u4").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u4").astype(np.uint64)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: int | None = None) -> DataFrame:
    """Rows ``(id, text, spare)`` dealt to groups of neighbouring ids, sorted, each group followed by the next one's first row.

    ``spare`` rows are those first rows: the successors of their group's last
    row.  The last group is followed by the first row of all.  The driver sees
    one row of ids per group.
    """
    spark = bounded_batches(docs)
    groups = groups or max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"))
    cuts = sorted(set(rows.approxQuantile("id", [i / groups for i in range(1, groups)], 0.25 / groups))) if groups > 1 else []
    # rows without an id come first, in group 0
    rows = rows.withColumn("at", F.coalesce(F.col("id").cast("double"), F.lit(float("-inf")))).withColumn("digest", F.xxhash64("text"))
    if cuts:
        ranges = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="at", outputCol="range")
        rows = ranges.transform(rows).withColumn("group", F.col("range").cast("int"))
    else:
        rows = rows.withColumn("group", F.lit(0))
    firsts = rows.groupBy("group").agg(F.min(F.struct(F.col("id").isNotNull().alias("some"), "id", "digest")).alias("first")).orderBy("group").collect()
    # the first group's first row follows the last group
    heads = [(r["group"], r["first"]["id"], r["first"]["digest"], firsts[i - 1]["group"]) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "group int, head_id bigint, head bigint, before int")
    rows = rows.join(F.broadcast(heads), "group", "left")  # one row a group
    target = F.when(F.col("id").eqNullSafe(F.col("head_id")) & (F.col("digest") == F.col("head")), F.col("before"))
    copies = F.array(
        F.struct(F.col("group").alias("group"), F.lit(False).alias("spare")),
        F.struct(target.alias("group"), F.lit(True).alias("spare")),
    )
    dealt = rows.select("id", "text", "digest", F.explode(copies).alias("to")).where("to.group is not null")
    dealt = dealt.select("to.group", "to.spare", "id", "digest", "text")
    dealt = dealt.repartition(max(1, len(firsts)), "group")
    return dealt.sortWithinPartitions("group", "spare", F.col("id").asc_nulls_first(), "digest").select("group", "spare", "id", "text")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, scale: int = SCALE) -> DataFrame:
    """``(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``, one row per input row.

    Shingles are runs of ``words`` words (A-Z lower-cased).  The edited text
    has its last quarter of code points replaced by as many first ones (or
    all) of the next document in ascending id order; after the last comes the
    first.  ``near_*`` are containment estimates from 0 to 1 (see ``containment``).
    The sketch of a text of over 1,000 words takes less than a quarter of it.

    Null texts are empty: their sketch is the empty string, alike only to
    another empty one.  Rows without an id come first; rows of one id are in
    the order of their texts' hashes, repeated rows follow each other; a
    single document is its own successor.  An empty table gives no rows.
    """
    schema = f"`{id_col}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def judged(pairs):
        """Rows for consecutive ``(id, text, next text)``."""
        texts, edits = [p[1] for p in pairs] + [pairs[-1][2]], []
        for _, text, following in pairs:
            n = len(text) // 4
            edits.append(text[: len(text) - n] + following[:n])
        data = [t.encode() for t in texts + edits]
        sketches = [scaled(s, scale) for s in shingle_sets(data, words)]
        out = []
        for i, (doc, text, following) in enumerate(pairs):
            own, edited = sketches[i], sketches[len(texts) + i]
            after = sketches[i + 1]
            out.append((doc, len(text), hashlib.sha256(data[len(texts) + i]).hexdigest(), to_text(own), to_text(edited), containment(own, edited), containment(own, after)))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names)

    def run(batches):
        held = None  # group, id and text of the last row, whose successor comes next
        pairs, size = [], 0
        for batch in small(batches):
            for group, spare, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held is not None and held[0] == group:
                    pairs.append((held[1], held[2], text))
                    size += len(text)
                    held = None
                if not spare:
                    held = (group, doc, text)
                if pairs and (held is None or size > 1 << 20):
                    yield judged(pairs)
                    pairs, size = [], 0
        if pairs:
            yield judged(pairs)

    return with_next(docs, id_col, text_col).mapInArrow(run, schema)
