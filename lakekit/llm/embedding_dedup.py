"""Embedding near-dedup by counting collisions of one-dimensional projections.

Vectors are scaled to length one, where a cosine of ``c`` is a distance of
``sqrt(2 - 2c)``; their difference on a random direction is normal with that
deviation.  A pair collides on a projection when the second vector lies in the
window centred at the first.  Windows are two deviations wide to each side,
and a pair is verified when it collides on as many projections as a pair just
at the threshold does with the wanted recall; what is lost because its blocks
don't meet counts towards that.

Equal vectors form a class with a multiplicity.  There are one or more sorted
tables of all classes.  A table deals them to cells by the signs of some
projections and sorts each cell by another one; its blocks meet the blocks of
the cell that their (wider) window reaches.  Collisions on the counted
projections are counted for the vectors of blocks that meet.  With more vectors
there are more signs to a cell and more tables, so that a vector meets about as
many others; few vectors have one table with one cell.  A pair belongs to the
first table in which it meets.  Pairs are counted and verified inside a task,
which returns the number of links of each vector and a spanning forest of its
links, never the pairs themselves.
"""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, components, discard, materialize


def near_distance(cosine: float) -> float:
    return math.sqrt(max(0.0, 2 - 2 * cosine))


def calibrated_count(projections: int, deviations: float, recall: float, reach: float = math.inf) -> int:
    """The largest count that pairs just at the threshold reach with probability ``recall``.

    Pairs more than ``reach`` deviations apart on the first projection are lost, whatever their count.
    """
    p, met = math.erf(deviations / math.sqrt(2)), math.erf(reach / math.sqrt(2))
    others = projections - 1
    # the other projections' count, for pairs that collide on the first one, and for pairs that only meet there
    tail = [math.fsum(math.comb(others, i) * p**i * (1 - p) ** (others - i) for i in range(max(0, c), others + 1)) for c in range(projections + 1)]
    for c in range(projections, 0, -1):
        if p * tail[c - 1] + (met - p) * tail[c] >= recall:
            return c
    return 0


def met_within(deviations: float, recall: float) -> float:
    """Deviations within which pairs meet on the first projection; of the loss ``recall`` allows, at most half is lost here."""
    return max(min(4.0, deviations + 1.5), deviations, NormalDist().inv_cdf(1 - (1 - recall) / 4)) if recall < 1 else math.inf


def table_plan(vectors: int, cosine: float, recall: float, reach: float = math.inf, fixed: int = 3000) -> tuple[int, int]:
    """``(signs, tables)`` with the least comparisons a vector, each table costing ``fixed`` besides.

    A pair at the threshold agrees in a sign with probability ``1 - angle / pi``;
    with so many tables half the loss that ``recall`` allows is lost.  Half of
    a cell lies within the window.
    """
    agree, met = 1 - math.acos(min(1.0, cosine)) / math.pi, math.erf(reach / math.sqrt(2))
    plans = [(0.6 * vectors + fixed, 0, 1)]
    for signs in range(1, 41 if recall < 1 else 1):
        share = agree**signs * met
        tables = 1 if share >= 1 else math.ceil(math.log((1 - recall) / 2) / math.log(1 - share))
        plans.append((tables * (0.6 * vectors / 2**signs + fixed), signs, tables))
    return min(plans)[1:]


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def _forest(a: np.ndarray, b: np.ndarray, n: int):
    """Edges ``(node, smaller node)`` that connect what the links ``a-b`` connect."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def _links(p: np.ndarray, q: np.ndarray, x: np.ndarray, y: np.ndarray, window: float, need: int, cosine: float, step: int = 256):
    """Verified pairs ``(row of x, row of y)``: by projections ``p, q`` of the unit vectors ``x, y``."""
    m = p.shape[1]
    dense = min(m, max(1, m // 2))
    found_a, found_b = [], []
    for lo in range(0, len(p), step):
        part = p[lo : lo + step]
        count = np.zeros((len(part), len(q)), np.uint8)
        for j in range(dense):
            count += np.abs(part[:, j, None] - q[None, :, j]) <= window
        a, b = np.nonzero(count >= max(0, need - (m - dense)))
        hits = count[a, b].astype(np.int64)
        for j in range(dense, m):
            hits += np.abs(part[a, j] - q[b, j]) <= window
        a, b = a[hits >= need] + lo, b[hits >= need]
        for s in range(0, len(a), 200_000):
            u, v = a[s : s + 200_000], b[s : s + 200_000]
            ok = np.einsum("ij,ij->i", x[u], y[v]) >= cosine
            found_a.append(u[ok])
            found_b.append(v[ok])
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array(vectors)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _places(x: np.ndarray, signs: int, tables: int, upto: int, projections: int, seed: int):
    """``(cells, ats)``: for each unit vector and each of the first ``upto`` of the tables its cell and its place in it."""
    dim = x.shape[1]
    if not signs:
        return np.zeros((len(x), upto), np.int64), (x @ directions(dim, projections, seed))[:, :upto]
    bits = (x @ directions(dim, signs * tables, seed + 1)[:, : signs * upto] > 0).reshape(len(x), upto, signs)
    return (bits << np.arange(signs, dtype=np.int64)).sum(axis=2), x @ directions(dim, tables, seed + 2)[:, :upto]


def _table(classes: DataFrame, t: int, signs: int, many: int, first: float, window: float, need: int, cosine: float, projections: int, block_rows: int, seed: int) -> DataFrame:
    """Links ``(a, b, n, edge)`` of the pairs that meet first in table ``t`` of ``many``: degrees of vectors, and edges of forests."""
    spark = classes.sparkSession

    def project(batches):
        for batch in batches:
            rep, n, v = (batch.column(i) for i in range(3))
            data = v.to_pylist()
            dims = np.array([len(x) for x in data])
            cell, out = np.zeros(len(dims), np.int64), np.empty(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                cells, ats = _places(unit_rows([data[i] for i in at.tolist()]), signs, many, t + 1, projections, seed)
                cell[at], out[at] = cells[:, t], ats[:, t]
            yield pa.RecordBatch.from_arrays([rep, n, pa.array(dims, pa.int32()), pa.array(cell), pa.array(out), v], ["rep", "n", "dim", "cell", "at", "v"])

    sorted_rows = classes.select("rep", "n", "v").mapInArrow(project, "rep bigint, n bigint, dim int, cell bigint, at double, v array<double>")
    sorted_rows = sorted_rows.repartitionByRange("dim", "cell", "at", "rep").sortWithinPartitions("dim", "cell", "at", "rep")

    def blocks(batches):
        held: dict[str, list] = {c: [] for c in ("rep", "n", "at", "v")}
        where, number = None, TaskContext.get().partitionId() << 24
        shape = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("cell", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()), ("reps", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64())), ("vectors", pa.binary())])

        def block():
            data = np.array(held["v"], "<f8").tobytes()
            row = {"block": number, "dim": where[0], "cell": where[1], "lo": held["at"][0], "hi": held["at"][-1], "reps": held["rep"], "ns": held["n"], "vectors": data}
            return pa.RecordBatch.from_pylist([row], schema=shape)

        for batch in batches:
            for rep, n, dim, cell, at, v in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held["rep"] and ((dim, cell) != where or len(held["rep"]) >= block_rows):
                    yield block()
                    number, held = number + 1, {c: [] for c in held}
                where = dim, cell
                for c, value in (("rep", rep), ("n", n), ("at", at), ("v", v)):
                    held[c].append(value)
        if held["rep"]:
            yield block()

    made = materialize(sorted_rows.mapInArrow(blocks, "block bigint, dim int, cell bigint, lo double, hi double, reps array<bigint>, ns array<bigint>, vectors binary"), "vector-blocks")
    a = made.select(F.col("dim").alias("d"), F.col("cell").alias("c"), F.col("block").alias("target"), F.col("hi").alias("reach"))
    # each block meets itself and the later ones that its window reaches
    pairs = made.select("block", "dim", "cell", "lo").join(a, (F.col("dim") == F.col("d")) & (F.col("cell") == F.col("c")) & (F.col("block") >= F.col("target")) & (F.col("lo") <= F.col("reach") + first))
    pairs = pairs.select("target", F.col("block").alias("source"))
    meets = made.join(pairs, F.col("block") == F.col("source")).select("target", "block", "dim", "reps", "ns", "vectors")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    meets = meets.repartition(parts, "target").sortWithinPartitions("target", "block")

    def unpack(row):
        dim, reps = row["dim"], np.array(row["reps"], np.int64)
        x = unit_rows(np.frombuffer(row["vectors"], "<f8").reshape(len(reps), dim))
        return row["target"], reps, np.array(row["ns"], np.int64), x, (x @ directions(dim, projections, seed)).astype(np.float32), _places(x, signs, many, t + 1, projections, seed)

    def met_first(u, v, own, other):
        """The pairs that meet here and in no earlier table."""
        (cells, ats), (cells2, ats2) = own, other
        here = np.abs(ats[u, t] - ats2[v, t]) <= first
        for s in range(t):
            here &= (cells[u, s] != cells2[v, s]) | (np.abs(ats[u, s] - ats2[v, s]) > first)
        return u[here], v[here]

    def compare(batches):
        own = None
        for batch in batches:
            for i in range(batch.num_rows):
                other = unpack(batch.slice(i, 1).to_pylist()[0])
                itself = own is None or own[0] != other[0]
                if itself:
                    own = other
                _, reps, ns, x, p, places = own
                _, reps2, ns2, y, q, places2 = other
                u, v = _links(p, q, x, y, window + 1e-5, need, cosine)
                if many > 1:
                    u, v = met_first(u, v, places, places2)
                if itself:
                    u, v = u[u < v], v[u < v]
                if not len(u):
                    continue
                nodes, counts = np.concatenate([reps, reps2]), np.zeros(len(reps) + len(reps2), np.int64)
                np.add.at(counts, u, ns2[v])
                np.add.at(counts, v + (0 if itself else len(reps)), ns[u])
                node, root = _forest(u, v + (0 if itself else len(reps)), len(nodes))
                least, to = np.minimum(nodes[node], nodes[root]), np.maximum(nodes[node], nodes[root])
                linked = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([nodes[linked], least])), pa.array(np.concatenate([np.full(len(linked), -1), to])), pa.array(np.concatenate([counts[linked], np.zeros(len(least), np.int64)])), pa.array(np.concatenate([np.zeros(len(linked), bool), np.ones(len(least), bool)]))], ["a", "b", "n", "edge"])

    found = materialize(meets.mapInArrow(compare, "a bigint, b bigint, n bigint, edge boolean"), "vector-links")
    discard(made)
    return found


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    projections: int = 24,
    deviations: float = 2.0,
    recall: float = 0.999,
    block_rows: int = 2048,
    seed: int = 7,
    tables: tuple[int, int] | None = None,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row per input row.

    ``n_links`` counts the other vectors (ids) linked directly;
    ``component_id`` is the smallest id that links reach, the own included.
    Every link is verified in double precision; of pairs at the threshold at
    least the share ``recall`` is found, of nearer pairs more.  ``tables``
    (signs, tables) defaults to ``table_plan``; tables are made one after the
    other, so that one copy of the vectors is on disk at a time.

    Vectors that are null, empty, all zero or hold null or non-finite numbers
    link with nothing, as do rows with a null id (component and ``kept`` are
    null there).  Vectors of different lengths don't link.  Repeated rows
    count once and get equal results; an id with several vectors is one node
    whose links add up.  Extra columns are not read.
    """
    bounded_batches(vectors)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = "v is null or size(v) = 0 or exists(v, x -> x is null or isnan(x) or abs(x) = double('inf')) or forall(v, x -> x = 0)"
    good = rows.where(f"id is not null and not coalesce({bad}, true)").distinct()
    classes = good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    classes = materialize(classes, "vector-classes-of")
    sigma = near_distance(cosine)
    # a random direction, and so a projection, for each vector length
    reach = met_within(deviations, recall)
    first = reach * sigma
    signs, many = tables or table_plan(classes.count(), cosine, recall, reach)
    share = recall if many == 1 else (1 + recall) / 2
    need = calibrated_count(projections, deviations, share, reach if many == 1 else math.inf)
    found = [_table(classes, t, signs, many, first, deviations * sigma, need, cosine, projections, block_rows, seed) for t in range(many)]
    found = reduce(DataFrame.unionByName, found)
    degree = found.where("not edge").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n_links"))
    # members of a class link with each other; a class and its links hang together
    known = good.join(classes.withColumnRenamed("v", "w"), F.col("v") == F.col("w")).select("id", "rep", "n")
    known = materialize(known, "vector-classes")
    member = known.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    reach = components(found.where("edge").select("a", "b").unionByName(member))
    degree = known.join(degree, "rep", "left").select("id", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("k")).groupBy("id").agg(F.sum("k").alias("n_links"))
    out = rows.select("id").join(degree.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left").join(reach, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
