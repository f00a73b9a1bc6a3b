"""Best-fit packing by large-item matching on the histogram of piece lengths.

Documents are tokenised in parallel and cut into pieces of at most one
sequence.  Only the number of pieces of each length - at most ``capacity``
numbers, whatever the input - decides how sequences are filled: lengths above
one third of the capacity go at most two to a sequence and are matched
greedily (the longest with the longest that still fits), smaller lengths then
go, longest first, into the smallest gap that holds them.  Pieces find their
place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, materialize, small, worker_cache

#: The string that the vocabulary holds as a special token (fixed value).
END_TEXT = "<|endoftext|>"


def encoder(json_path: str, ranks_path: str | None, pattern: str | None):
    """``text -> ids`` of the byte-level vocabulary, kept for the worker's life.

    The same vocabulary as plain ranks is several times faster; texts that hold
    the special token's string go to the full tokenizer, which gives it one id.
    """
    cache, key = worker_cache(), ("encoder", json_path, ranks_path)
    if key not in cache:

        def full(text: str) -> list[int]:
            if ("tokenizer", json_path) not in cache:
                from tokenizers import Tokenizer

                cache["tokenizer", json_path] = Tokenizer.from_file(json_path)
            return cache["tokenizer", json_path].encode(text, add_special_tokens=False).ids

        if ranks_path is None:
            cache[key] = full
        else:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            cache[key] = lambda text: full(text) if END_TEXT in text else fast.encode_ordinary(text)
    return cache[key]


def token_pieces(
    docs: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: each document's ids and ``end_id``, cut where too long.

    All pieces but the first hold ``capacity`` ids.  A null text is empty.
    """
    bounded_batches(docs)
    schema = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def pieces(batches):
        encode = encoder(json_path, ranks_path, pattern)
        for batch in small(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[lo:hi]
                    rows.append((doc, i, lo, hi - lo, zlib.crc32(part.tobytes())) + ((part.astype(np.int32).tolist(),) if with_ids else ()))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + ([pa.list_(pa.int32())] if with_ids else [])
            names = ["id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(pieces, schema)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``[(lengths in a sequence, number of such sequences), ...]`` for the given number of pieces by length."""
    left = Counter({n: c for n, c in histogram.items() if c > 0})
    bins: dict[int, list[list]] = defaultdict(list)  # gap -> [lengths, count]
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        count, room = left[n], capacity - n
        i = bisect_left(large, room + 1) - 1  # the longest that fits beside it
        if i < 0:
            bins[room].append([(n,), count])
            large.pop()
        elif large[i] == n:
            if count > 1:
                bins[room - n].append([(n, n), count // 2])
            left[n] = count % 2
            if not left[n]:
                large.pop()
            else:
                i -= 1
                if i < 0:
                    bins[room].append([(n,), 1])
                    large.pop()
                else:
                    bins[room - large[i]].append([(n, large[i]), 1])
                    left[large[i]] -= 1
                    if not left[large[i]]:
                        large.pop(i)
                    large.remove(n)
        else:
            other, m = large[i], min(count, left[large[i]])
            bins[room - other].append([(n, other), m])
            left[n] -= m
            left[other] -= m
            if not left[other]:
                large.remove(other)
            if not left[n]:
                large.remove(n)
    gaps = sorted(bins)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        while count:
            i = bisect_left(gaps, n)
            if i == len(gaps):  # nothing holds it: new sequences filled with this length
                fit = min(capacity // n, count)
                made, gap = count // fit, capacity - fit * n
                group, count = [(n,) * fit, made], count - fit * made
            else:
                gap, group = gaps[i], bins[gaps[i]].pop()
                if not bins[gap]:
                    gaps.pop(i)
                fit = min(gap // n, count)
                made = min(group[1], count // fit)
                if made < group[1]:
                    if not bins[gap]:
                        gaps.insert(bisect_left(gaps, gap), gap)
                    bins[gap].append([group[0], group[1] - made])
                group, count, gap = [group[0] + (n,) * fit, made], count - fit * made, gap - fit * n
            if not bins[gap]:
                gaps.insert(bisect_left(gaps, gap), gap)
            bins[gap].append(group)
    return [(tuple(lengths), count) for gap in gaps for lengths, count in bins[gap]]


def slot_table(bins: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``(length, first rank, first sequence, offset)``, sorted: where the pieces of a length go by rank."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for lengths, count in bins:
        offset = 0
        for n in lengths:
            rows.append((n, used[n], sequence, offset))
            used[n] += count
            offset += n
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = 1024, rows_per_group: int = 500_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to materialised pieces (columns ``id, piece, length, ids_crc32``).

    Ranks come from row numbers within (length, salt), so no group holds more
    than about ``rows_per_group`` rows however common a length is; the driver
    sees one count per length and per salt only.  Repeated rows take places of
    their own.  An empty table stays empty.
    """
    total = pieces.count()
    salts = max(1, -(-total // rows_per_group))
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("id", "piece", "start"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    starts = counts.select(
        F.col("length").alias("__length"),
        F.col("__salt").alias("__s"),
        (F.sum("__n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("__n")).alias("__base"),
    )
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    slots = slot_table(plan_bins(histogram, capacity))
    rank = F.row_number().over(Window.partitionBy("length", "__salt").orderBy("id", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("__rank", rank)
    ranked = ranked.join(starts, (F.col("length") == F.col("__length")) & (F.col("__salt") == F.col("__s")))
    ranked = ranked.withColumn("__rank", F.col("__rank") + F.col("__base")).drop("__salt", "__length", "__s", "__base")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id bigint, offset bigint"
    shift = max(1, total).bit_length()
    marks = (slots[:, 0] << shift) + slots[:, 1] if len(slots) else np.empty(0, np.int64)

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            order = batch.column("__rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(marks, (length << shift) + order, "right") - 1
            found = slots[at] if len(order) else np.empty((0, 4), np.int64)
            arrays = [c for c, name in zip(batch.columns, batch.schema.names) if name != "__rank"]
            arrays += [pa.array(found[:, 2] + order - found[:, 1], pa.int64()), pa.array(found[:, 3], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [n for n in batch.schema.names if n != "__rank"] + ["sequence_id", "offset"])

    return ranked.select(*[f"`{c}`" for c in pieces.columns], "__rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, json_path: str, capacity: int = 1024, id_col: str = "doc_id", **options) -> DataFrame:
    """Tokenise ``docs`` and pack the pieces: ``(id_col, piece, start, length, ids_crc32, sequence_id, offset[, ids])``.

    Null and empty texts are one piece that holds the end id alone; null ids
    are kept.  Extra columns are not read.
    """
    pieces = materialize(token_pieces(docs, json_path, capacity=capacity, id_col=id_col, **options), "token-pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)
