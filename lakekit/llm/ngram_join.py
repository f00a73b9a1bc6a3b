"""N-gram Jaccard join: size-aware, heavy and light sets treated apart.

Documents are sets of word shingles (64-bit hashes).  Equal sets form a class
with one representative, and only representatives go on:

* Light sets (at most ``x`` shingles): two sets link if they share enough
  shingles, so each set lists all its subsets of just that size, for each size
  a partner may have.  Sets that list the same subset link; no pair is made.
* Heavy sets: inverted lists from shingle to set are scanned.  Only the
  shingles that come first in hash order are posted: of two linked sets with
  ``a`` and ``b`` shingles, the first ``a - ceil(t a) + l`` and
  ``b - ceil(t b) + l`` share at least ``l``.

The boundary ``x`` is chosen by cost from the numbers of sets of each size.

Groups of near copies would fill the lists with pairs, so sets that share a
list are first linked to a few leaders of their minimum-hash group (every such
link is verified).  After that only links between different components are
missing; for these the sets left are posted under their rarest shingles, and
every pair that meets there is verified on the whole sets.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, bytes_of, components, discard, materialize, mix64, shingle_sets, small

#: Light sets have at most so many shingles, whatever the cost says (subsets per set stay few).
MOST_LIGHT = 24


class Threshold:
    """``den * |A and B| >= num * |A or B|`` in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, a: int, b: int) -> int:
        """Fewest common elements of linked sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def smallest(self, n: int) -> int:
        """Size of the smallest partner, and fewest common elements with any."""
        return -(-self.num * n // self.den)

    def largest(self, n: int) -> int:
        return n * self.den // self.num

    def subsets(self, n: int, most: int) -> int:
        """Subsets that a light set of size ``n`` lists when light sets have up to ``most`` elements."""
        return sum(comb(n, self.overlap(n, t)) for t in range(self.smallest(n), min(self.largest(n), most) + 1))


def shared_least(n: int) -> int:
    """``l``: how many posted shingles linked sets share at least (of two sets, the smaller number holds)."""
    return 4 + n // 16


def posted(n: int, rule: Threshold) -> int:
    """How many shingles of a set are posted; small sets post all, for listing subsets."""
    return n if n <= MOST_LIGHT else min(n, n - rule.smallest(n) + shared_least(n))


def light_boundary(sizes: dict[int, int], rule: Threshold, scan_cost: float = 4.0) -> int:
    """The largest light size, by least cost: subsets listed, or postings times what a posting costs to scan."""

    def cost(x: int) -> float:
        listed = sum(c * rule.subsets(n, x) for n, c in sizes.items() if n <= x)
        scanned = sum(c * (n - rule.smallest(n) + shared_least(n)) for n, c in sizes.items() if rule.smallest(x + 1) <= n <= MOST_LIGHT)
        return listed + scan_cost * scanned

    # below 8, ``l`` common shingles can't be asked for: those sets are always light
    return min(range(8, MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int, rule: Threshold) -> DataFrame:
    """``(id, n, digest, first)`` of each row: size and digest of its set, its first shingles in hash order."""

    def sets(batches):
        for batch in small(batches):
            n, digest, first = [], [], []
            for s in shingle_sets(bytes_of(batch.column(1)), words):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                first.append(s[: posted(len(s), rule)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(first, pa.binary())], ["id", "n", "digest", "first"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sets, "id bigint, n bigint, digest binary, first binary")


def _light_links(reps: DataFrame, x: int, rule: Threshold) -> DataFrame:
    def listed(batches):
        for batch in batches:
            ids, signs, side = [], [], []
            for rep, n, first in zip(*(batch.column(i).to_pylist() for i in range(3))):
                values = mix64(np.frombuffer(first, np.uint64))
                for t in range(rule.smallest(n), min(rule.largest(n), x) + 1):
                    size = rule.overlap(n, t)
                    if size > n:
                        continue
                    tag = np.uint64(min(n, t) << 32 | max(n, t))
                    sums = np.array([values[list(c)].sum() for c in combinations(range(n), size)], np.uint64)
                    signs.append(mix64(mix64(sums) + tag))
                    ids += [rep] * len(sums)
                    side += [(n > t) - (n < t)] * len(sums)
            signs = np.concatenate(signs) if signs else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(signs.view(np.int64)), pa.array(side, pa.int32())], ["rep", "sign", "side"])

    rows = reps.where(F.col("n").between(1, x)).select("rep", "n", "first").mapInArrow(listed, "rep bigint, sign bigint, side int")
    rows = materialize(rows, "light-subsets")
    # a subset listed for two sizes links only sets of the one size with sets of the other
    least = rows.groupBy("sign").agg(F.min("rep").alias("a"), F.max("rep").alias("last"), F.min("side").alias("lo"), F.max("side").alias("hi"))
    least = least.where("a < last and (lo < hi or lo = 0)").select("sign", "a")
    return rows.join(least, "sign").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def _postings(reps: DataFrame, low: int, rule: Threshold) -> DataFrame:
    def post(batches):
        for batch in batches:
            for part in small([batch], 500):
                ids, sizes = part.column(0).to_numpy(), part.column(1).to_pylist()
                tokens = [np.frombuffer(f, np.int64)[: n - rule.smallest(n) + shared_least(n)] for n, f in zip(sizes, part.column(2).to_pylist())]
                count = [len(t) for t in tokens]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.repeat(ids, count)), pa.array(np.repeat(sizes, count))], ["token", "rep", "n"])

    return reps.where(F.col("n") >= low).select("rep", "n", "first").mapInArrow(post, "token bigint, rep bigint, n bigint")


def _least_sql(n: str, rule: Threshold) -> str:
    """``shared_least`` of the smallest partner of a set of ``n``."""
    return f"(4 + ceil({rule.num} * {n} / {rule.den}) div 16)"


def _whole_sets(docs: DataFrame, active: DataFrame, id_col: str, text_col: str, words: int, homes: int = 2) -> DataFrame:
    """``(rep, n, set, homes)`` of the active representatives, from their texts."""

    def sets(batches):
        for batch in small(batches):
            ids, n, data, home = batch.column(0), [], [], []
            for s in shingle_sets(bytes_of(batch.column(1)), words):
                n.append(len(s))
                data.append(s.tobytes())
                home.append([int(mix64(s ^ np.uint64(0x9E3779B97F4A7C15 * (j + 1) & 0xFFFFFFFFFFFFFFFF)).min().view(np.int64)) for j in range(homes)] if len(s) else [])
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(data, pa.binary()), pa.array(home, pa.list_(pa.int64()))], ["rep", "n", "set", "homes"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("rep"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(active.select("rep"), "rep", "left_semi").select("rep", "text")
    return rows.mapInArrow(sets, "rep bigint, n bigint, set binary, homes array<bigint>")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _leaders(rows: DataFrame, rule: Threshold, most: int = 16) -> DataFrame:
    """Link each set to a leader of its group, in one pass over rows ``(part, home, rep, set, hits)`` sorted by part.

    The ``most`` leaders of a part with most links are at hand; a set that links
    with none of them becomes a leader.  Rows out with ``leader`` null are the
    leaders of a task, with their links as ``hits``.
    """

    def link(batches):
        at, home, leaders = None, None, []  # [rep, shingles, hits], most hits first
        for batch in small(batches):
            out = []
            for p, h, rep, data, hits in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if p != at:
                    out += gone(home, leaders)
                    at, home, leaders = p, h, []
                s = np.frombuffer(data, np.uint64)
                for i, (r, other, _) in enumerate(leaders):
                    if rule.smallest(max(len(s), len(other))) <= min(len(s), len(other)) and _common(s, other) >= rule.overlap(len(s), len(other)):
                        if r != rep:
                            out.append((h, rep, r, None, 0))
                        leaders[i][2] += hits + 1
                        leaders.sort(key=lambda x: -x[2])
                        break
                else:
                    out += gone(home, leaders[most - 1 :])
                    leaders = [*leaders[: most - 1], [rep, s, hits]]
                    leaders.sort(key=lambda x: -x[2])
            yield table(out)
        yield table(gone(home, leaders))

    def gone(home, leaders):
        return [(home, r, None, s.tobytes(), hits) for r, s, hits in leaders]

    def table(out):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, types)], ["home", "rep", "leader", "set", "hits"])

    return rows.select("part", "home", "rep", "set", "hits").mapInArrow(link, "home bigint, rep bigint, leader bigint, set binary, hits bigint")


def _leader_links(sets: DataFrame, rule: Threshold, most_rows: int = 2000) -> DataFrame:
    """Verified links ``(a, b)`` within minimum-hash groups.

    Groups over several tasks meet through their leaders, round by round: a
    group's leaders are dealt by hash to parts of about ``most_rows``, so no
    task gets more, and those that a part leaves meet in fewer parts in the next
    round.  The rounds end once each group was one part, or is no longer getting
    much smaller; what is left to find there is found by the exact candidate step.
    """
    rows = sets.select(F.explode("homes").alias("home"), "rep", "set", F.lit(0).cast("bigint").alias("hits")).withColumn("part", F.col("home"))
    found = materialize(_leaders(rows.repartitionByRange("home", "rep").sortWithinPartitions("home", "rep"), rule), "leaders")
    links, last = [found.where("leader is not null").select("rep", "leader")], None
    while True:
        left = found.where("leader is null").select("home", "rep", "set", "hits")
        groups = left.groupBy("home").agg(F.count("*").alias("k")).where("k > 1")
        total = groups.agg(F.sum("k")).first()[0] or 0
        if not total or last is not None and total > 0.8 * last:
            break
        last = total
        dealt = left.join(groups.withColumnRenamed("home", "of"), F.col("home") == F.col("of"))
        parts = F.ceil(F.col("k") / most_rows)
        dealt = dealt.withColumn("part", F.xxhash64("home", F.pmod(F.xxhash64("rep", F.lit(last)), parts)))
        dealt = dealt.select("part", "home", "rep", "set", "hits")
        # those with most links in any task come first, so that they stay at hand
        dealt = dealt.repartition("part").sortWithinPartitions("part", F.desc("hits"), "rep")
        again = groups.where(F.col("k") > most_rows).select(F.col("home").alias("large"))
        found = materialize(_leaders(dealt, rule), "leaders")
        links.append(found.where("leader is not null").select("rep", "leader"))
        # groups that were one part have met
        found = found.join(again, F.col("home") == F.col("large"), "left_semi")
    return reduce(DataFrame.unionByName, links).select(F.col("rep").alias("a"), F.col("leader").alias("b"))


def _with_component(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Add each ``rep``'s component: its own id where it has no link yet."""
    joined = rows.join(known.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return joined.withColumn("component", F.coalesce("component", "rep"))


def _rarest(sets: DataFrame, known: DataFrame, rule: Threshold) -> DataFrame:
    """``(rep, n, m, token)``: the shingles under which a set can still meet one of another component.

    Shingles that only one component holds can't be common to such a pair.  A
    set of ``n`` with ``m`` others can meet the threshold only if ``m`` reaches
    its smallest overlap ``o``, and then shares one of the ``m - o + 1`` rarest;
    a pair only if both sets' ``m`` reach the overlap that their sizes ask for.
    """

    def explode(batches):
        for batch in batches:
            for part in small([batch], 500):
                tokens = [np.frombuffer(x, np.int64) for x in part.column(3).to_pylist()]
                count = [len(t) for t in tokens]
                columns = [pa.array(np.repeat(part.column(i).to_numpy(), count)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), *columns], ["token", "rep", "n", "component"])

    rows = _with_component(sets, known).select("rep", "n", "component", "set").mapInArrow(explode, "token bigint, rep bigint, n bigint, component bigint")
    lists = rows.groupBy("token").agg(F.count("*").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = rows.join(lists.where("lo < hi").select("token", "df"), "token")
    least = f"cast(ceil({rule.num} * n / {rule.den}) as int)"
    by_set = mixed.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("rest"))
    by_set = by_set.where(f"size(rest) >= {least}").select("rep", "n", F.size("rest").alias("m"), F.expr(f"slice(rest, 1, size(rest) - {least} + 1)").alias("rest"))
    return materialize(by_set.select("rep", "n", "m", F.explode("rest.token").alias("token")), "rarest-shingles")


def _candidates(rare: DataFrame, known: DataFrame, rule: Threshold) -> DataFrame:
    """Pairs of sets of different components that share a rarest shingle and could reach their overlap."""
    rows = _with_component(rare, known)
    lists = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
    rows = rows.join(lists, "token").groupBy("rep", "n", "m", "component").agg(F.collect_list("token").alias("rest"))
    rows = rows.select("*", F.explode("rest").alias("token"))
    a, b = (rows.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", "component", "m", "rest")]) for side in "ab")
    # neither has more shingles to share than ``m``; a pair is made at its first common shingle only
    size = f"{rule.num} * greatest(n_a, n_b) <= {rule.den} * least(n_a, n_b) and {rule.num + rule.den} * least(m_a, m_b) >= {rule.num} * (n_a + n_b)"
    pairs = a.join(b, "token").where(f"rep_a < rep_b and component_a <> component_b and {size} and array_min(array_intersect(rest_a, rest_b)) = token")
    return pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, rule: Threshold) -> DataFrame:
    def verify(batches):
        for batch in small(batches):
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            ok = []
            for p, q in zip(x, y):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                ok.append(_common(p, q) >= rule.overlap(len(p), len(q)))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    s = sets.select("rep", "set")
    rows = pairs.join(s.select(F.col("rep").alias("a"), F.col("set").alias("x")), "a").join(s.select(F.col("rep").alias("b"), F.col("set").alias("y")), "b")
    return rows.select("a", "b", "x", "y").mapInArrow(verify, "a bigint, b bigint")


def ngram_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    num: int = 4,
    den: int = 5,
) -> DataFrame:
    """``(id_col, n_shingles, component_id)``, one row per input row.

    Documents are sets of distinct ``words``-word shingles (A-Z lower-cased,
    split at ASCII white space; with fewer words, the whole sequence).  Two
    link when ``den * common >= num * all``; ``component_id`` is the smallest
    id that links reach, the row's own included.

    Null and empty texts have an empty set and link with nothing.  Rows with
    a null id link with nothing and have a null component.  Rows of one id are
    one node.  Extra columns are not read; an empty table gives no rows.
    """
    bounded_batches(docs)
    rule = Threshold(num, den)
    every = materialize(_sets(docs, id_col, text_col, words, rule), "shingle-sets")
    named = every.where("id is not null and n > 0")
    reps = named.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("first").alias("first"))
    reps = materialize(reps, "set-classes")
    members = materialize(every.select("id", "n", "digest"), "set-members")
    discard(every)
    same = members.join(reps.select("rep", "digest"), "digest").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    same = materialize(same, "links")
    sizes = {r["n"]: r["count"] for r in reps.where(F.col("n") <= MOST_LIGHT).groupBy("n").count().collect()}
    x = light_boundary(sizes, rule)
    links = materialize(_light_links(reps, x, rule), "links")

    posted_rows = _postings(reps, rule.smallest(x + 1), rule)
    again = posted_rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token")
    shared = posted_rows.join(again, "token").groupBy("rep").agg(F.count("*").alias("k"), F.first("n").alias("n"))
    active = materialize(shared.where(f"k >= {_least_sql('n', rule)}").select("rep"), "active-sets")
    discard(reps)
    # rows of one id with other texts: each of the sets is checked
    sets = materialize(_whole_sets(docs, active, id_col, text_col, words).dropDuplicates(["rep", "set"]), "whole-sets")
    links = materialize(links.unionByName(_leader_links(sets, rule)), "links")
    known = components(links)
    found = materialize(_verified(_candidates(_rarest(sets, known, rule), known, rule), sets, rule), "links")
    known = components(links.unionByName(found).unionByName(same))

    out = members.select("id", "n").join(known, F.col("id") == F.col("node"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))

