"""Line dedup, suffix-array dedup, n-gram join and embedding near-dedup."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import order, roots, shingles, substrings
from oracle_check import compare

from lakekit.llm import common, embedding_dedup, line_dedup, ngram_join, queries, suffix_dedup

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    found = duck.execute(queries.oracle_sql()[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, found.fetchall(), [c[0] for c in found.description]) is None


def test_every_operator_has_one_query():
    names = [k for k in queries.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))


def test_components_of_forests_that_go_out_in_parts(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])
    parts = [b for b in common._forest((edges.slice(i, 10) for i in range(0, 250, 10)), most=7)]
    forest = [(a, b) for p in parts for a, b in zip(*(c.to_pylist() for c in p.columns))]
    assert len(parts) > 5 and roots(range(400), forest) == roots(range(400), links)
    top = roots(range(400), links)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: c for x, c in top.items() if x != c}


# --- lines


def test_lines_awkward(awkward, empty):
    got = {(r.doc_id, r.text): (r.lk_n_lines, r.lk_n_dropped) for r in line_dedup.dedup_lines(awkward, batches=3).collect()}
    assert got[1, "the same line of text here\nand one more line of it"] == (2, 0)
    assert got[2, ""] == (2, 2)
    assert got[3, None] == got[4, ""] == (1, 0)
    assert got[7, "short\nshort\nother words follow é ü 漢字 after that one line"] == (4, 1)
    assert got[None, "the same line of text here\nand one more line of it"] == (2, 0)
    assert line_dedup.dedup_lines(awkward).columns == awkward.columns + ["lk_n_lines", "lk_n_dropped"]
    assert line_dedup.dedup_lines(empty).count() == 0


def test_runs_are_levelled_and_go_on(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for i in range(5):
        docs = spark.createDataFrame([(i, f"a line common to all\na line of number {i}")], "doc_id bigint, text string")
        (row,) = line_dedup.dedup_lines(docs, batches=1, runs=runs).collect()
        assert row.lk_n_dropped == (i > 0)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert runs.seen().count() == runs.seen().distinct().count() == 6


def test_runs_are_neither_exchanged_nor_sorted(spark):
    runs = line_dedup.LineRuns(spark, fanout=4, buckets=4)
    for i in range(3):
        runs.add(spark.range(i * 100, i * 100 + 100).selectExpr("unhex(md5(string(id))) AS key"))
    keys = spark.range(250, 400).selectExpr("unhex(md5(string(id))) AS key", "id").groupBy("key").agg({"id": "min"})
    with line_dedup.bucketed(spark):
        fresh = runs.new_of(keys)
        assert fresh.count() == 100
        plan = fresh._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
    lines = plan.splitlines()
    assert sum("SortMergeJoin" in x for x in lines) == 3 and sum("Exchange" in x for x in lines) == 1 and sum(" Sort " in x for x in lines) == 1
    assert sum("Bucketed: true" in x for x in lines) == 3
    # the fourth run makes the level one run, without an exchange, a sorted file to a bucket
    runs.add(spark.range(300, 301).selectExpr("unhex(md5(string(id))) AS key"))
    assert [len(x) for x in runs.levels] == [0, 1] and len(runs.seen().inputFiles()) == 4
    assert runs.seen().count() == 301 and "lk_run" not in str(spark.catalog.listTables())


def test_lines_with_clashing_names(spark):
    names = "doc_id bigint, lk_n_lines int, __lk_id string, text string, drops string, lk_n_dropped string, `a.b` int, c0 int, kept int"
    rows = [(i, 77, "id", "a line that is in both documents\nx", "d", "n", 5, 6, 7) for i in (1, 2)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, names), batches=2)
    assert got.columns == ["doc_id", "__lk_id", "text", "drops", "a.b", "c0", "kept", "lk_n_lines", "lk_n_dropped"]
    assert sorted(map(tuple, got.collect())) == [(1, "id", rows[0][3], "d", 5, 6, 7, 2, 0), (2, "id", "x", "d", 5, 6, 7, 2, 1)]


# --- substrings


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(100):
        text = bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(200)))
        x = np.frombuffer(text, np.uint8)
        sa = suffix_dedup.suffix_array(x).tolist()
        assert sa == sorted(range(len(text)), key=lambda i: text[i:])
        lcp = suffix_dedup.common_prefixes(x, np.array(sa, np.int64), 1000, lane=rng.choice([1, 7, 256]))
        for a, b in zip(sa, sa[1:]):
            same = 0
            while max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            assert lcp[b] == same


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 1000])
def test_packed_numbers_come_back(n):
    keys = np.sort(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64, endpoint=False))
    for some in (keys, keys >> np.uint64(40), np.full(n, 2**64 - 1, np.uint64), np.zeros(n, np.uint64)):
        assert (suffix_dedup._unpacked_sorted(suffix_dedup._pack_sorted(some), n) == some).all()
    for bits in (0, 1, 8, 11, 16, 51, 63):
        some = keys & np.uint64((1 << bits) - 1)
        assert (suffix_dedup._unpacked(suffix_dedup._pack(some, bits), n, bits) == some).all()
    # fewer bytes than by whole bytes: 11 bits each, and a key's own bits less those that its place tells
    assert len(suffix_dedup._pack(keys, 11)) <= n * 11 / 8 + 3
    assert n < 100 or len(suffix_dedup._pack_sorted(keys)) < n * 7.25


def test_shuffles_of_earlier_steps_go_before_blocks_are_written(spark, sample, monkeypatch):
    calls = []
    for name in ("release", "_blocks"):
        monkeypatch.setattr(suffix_dedup, name, lambda *a, name=name, was=getattr(suffix_dedup, name): (calls.append(name), was(*a))[1])
    docs = spark.createDataFrame(sample, "doc_id bigint, text string")
    assert suffix_dedup.dedup_substrings(docs).count() == len(sample)
    assert calls[:2] == ["release", "_blocks"]


@pytest.mark.parametrize("weak", [False, True])
def test_shard_finds_its_groups_again(monkeypatch, weak):
    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(12)) for _ in range(6)]
    texts = ["".join(rng.choice(words) for _ in range(20)).encode() for _ in range(40)]
    windows = np.concatenate([np.arange(len(t) + 1) <= len(t) - 50 for t in texts])
    row = {"text": b"".join(t + b"\xff" for t in texts), "windows": np.packbits(windows).tobytes(), "lengths": [len(t) for t in texts], "doc_ids": [7 * i % 40 for i in range(40)]}
    if weak:  # keys of 9 bits: groups that share one are told apart all the same
        hashes = suffix_dedup._gram_hashes
        monkeypatch.setattr(suffix_dedup, "_gram_hashes", lambda text, k: hashes(text, k) & np.uint64(511))
    sorted_, arrays = suffix_dedup._shard(row, 50, 3), []
    count = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda *a: arrays.append(1) or count(*a))
    bucket = sorted_[6]
    again = suffix_dedup._shard_again(row | {"found": [{"bucket": b, "n": int((bucket == b).sum())} for b in range(3)]}, 50, 3)
    assert bool(arrays) == weak
    for a, b in zip((sorted_[1], sorted_[2], sorted_[4], bucket, sorted_[8]), (again[0], again[1], again[3], again[4], again[5])):
        assert (a == b).all()


@pytest.mark.parametrize("kind", ["<u2", "<u4", "<u8"])
def test_planes_give_back_the_numbers(kind):
    x = np.random.default_rng(4).integers(0, np.iinfo(kind).max, 1000, dtype=kind, endpoint=True)
    for part in (x, x[:1], x[:0]):
        assert (suffix_dedup._from_planes(suffix_dedup._planes(part), kind) == part).all()
    keys = np.sort(x.astype("<u8"))
    assert (np.cumsum(suffix_dedup._from_planes(suffix_dedup._planes(np.diff(keys, prepend=np.uint64(0))), "<u8")) == keys).all()


@pytest.mark.parametrize("block_bytes", [4 << 20, 20_000])
def test_substrings_match_brute_force(spark, sample, block_bytes):
    docs = spark.createDataFrame(sample, "doc_id bigint, text string").repartition(3)
    got = suffix_dedup.dedup_substrings(docs, block_bytes=block_bytes)
    assert order(tuple(r) for r in got.collect()) == order(substrings(sample))


def test_substrings_awkward(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id != 8]
    rows += [(20, "é" * 60), (21, "x" + "é" * 40), (22, "aaaa" * 40), (23, "a" * 55), (24, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert order(tuple(r) for r in suffix_dedup.dedup_substrings(docs).collect()) == order(substrings(rows))
    kept = {r.doc_id: r.text for r in suffix_dedup.dedup_substrings(docs, with_text=True).collect()}
    assert kept[21] == "x" and kept[23] == ""
    assert suffix_dedup.dedup_substrings(empty).count() == 0
    assert suffix_dedup.dedup_substrings(awkward).count() == awkward.count()


# --- n-grams


def _groups(rows, n, num, den):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingles(text, n))
    links = [
        (a, b) for a in sets for b in sets if a < b
        for x in sets[a] for y in sets[b] if x and y and den * len(x & y) >= num * len(x | y)
    ]
    return roots(sets, links)


def test_ngrams_match_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 6, 10, 14, 20, 27, 40, 90]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    passage = [rng.choice(words) for _ in range(50)]
    rows += [(len(rows) + k, " ".join([f"u{k}", *[rng.choice(words) for _ in range(rng.randint(3, 50))], *passage])) for k in range(60)]
    hub = [rng.choice(words) for _ in range(120)]
    for k in range(60):
        copy = list(hub)
        copy[rng.randrange(120)], copy[rng.randrange(120)] = f"x{k}", f"y{k}"
        rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for n, num, den in ((4, 85, 100), (5, 4, 5)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_groups(docs, words=n, num=num, den=den).collect()}
        top = _groups(rows, n, num, den)
        assert got == {doc: (len(shingles(text, n)), top[doc]) for doc, text in rows}


def test_ngrams_awkward(awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = ngram_join.ngram_groups(awkward, words=4, num=85, den=100).collect()
    top = _groups(rows, 4, 85, 100)
    assert order((r.doc_id, r.component_id) for r in got) == order((d, top.get(d)) for d, _ in rows)
    assert {r.doc_id: r.n_shingles for r in got}[3] == 0
    assert ngram_join.ngram_groups(empty).count() == 0


def test_light_sets_and_threshold():
    rule = ngram_join.Threshold(85, 100)
    for a in range(1, 60):
        for b in range(a, 60):
            least = min(c for c in range(b + 1) if 100 * c >= 85 * (a + b - c)) if 100 * b >= 85 * a else None
            assert rule.overlap(a, b) == least or least is None
            assert (100 * a >= 85 * b) == (a >= rule.smallest(b)) == (b <= rule.largest(a))


# --- embeddings


def _near(rows, cosine=0.95):
    ok = {i: np.array(v, float) / max(map(abs, v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [
        (a, b) for a in ok for b in ok
        if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= cosine * np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])
    ]
    top = roots([i for i, _ in rows if i is not None], links)
    return {i: (sum(i in x for x in links), top[i], top[i] == i) for i in top}


def test_vectors_match_brute_force_and_awkward(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(60):
        base = rng.standard_normal(32)
        for _ in range(rng.integers(1, 6)):
            rows.append((len(rows), [float(x) for x in base + rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.5])]))
    rows += [(1000, None), (1001, []), (1002, [0.0] * 32), (1003, [None] + [1.0] * 31), (1004, [float("nan")] * 32), (1005, [float("inf")] * 32)]
    rows += [(1006, [1.0, 0.0]), (1007, [2.0, 0.0]), (1008, [1.0, 0.0]), (1009, [1e-200, 0.0]), (None, [1.0, 0.0])]
    docs = spark.createDataFrame(rows + rows[-2:-1], "vec_id bigint, embedding array<double>")
    got = embedding_dedup.near_vectors(docs, block_rows=16).collect()
    assert len(got) == len(rows) + 1
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == _near(rows)
    assert [(r.n_links, r.component_id) for r in got if r.vec_id is None] == [(0, None)]
    assert embedding_dedup.near_vectors(docs.where("false")).count() == 0


def test_calibrated_count_keeps_the_recall():
    import math

    need = embedding_dedup.calibrated_count(24, 2.0, 0.999)
    p = math.erf(2 / math.sqrt(2))
    assert sum(math.comb(24, c) * p**c * (1 - p) ** (24 - c) for c in range(need, 25)) >= 0.999
    assert sum(math.comb(24, c) * p**c * (1 - p) ** (24 - c) for c in range(need + 1, 25)) < 0.999


def test_count_allows_for_pairs_that_do_not_meet():
    rng = np.random.default_rng(11)
    for projections, deviations, recall in ((24, 2.0, 0.999), (24, 2.0, 0.9999), (8, 2.0, 0.99), (24, 1.0, 0.995), (4, 3.0, 0.99)):
        reach = embedding_dedup.met_within(deviations, recall)
        need = embedding_dedup.calibrated_count(projections, deviations, recall, reach)
        z = np.abs(rng.standard_normal((400_000, projections)))
        met = z[:, 0] <= reach
        found, more = (np.mean(met & ((z <= deviations).sum(axis=1) >= n)) for n in (need, need + 1))
        off = 4 * (recall * (1 - recall) / len(z)) ** 0.5
        assert need > 0 and found >= recall - off and more < recall + off
        assert embedding_dedup.calibrated_count(projections, deviations, recall) >= need
    # a gate that alone takes about all the loss allowed leaves the count less
    assert embedding_dedup.calibrated_count(24, 2.0, 0.999, 3.3) < embedding_dedup.calibrated_count(24, 2.0, 0.999)


def test_tables_of_cells_find_each_link_once(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((150, 48))
    x = np.concatenate([centres[rng.integers(0, 150, 900)] + 0.15 * rng.standard_normal((900, 48)) * rng.random((900, 1)), rng.standard_normal((300, 48))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    rows = [(i, v.tolist(), 1, "c", 0.5) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n int, cell string, at double")
    for tables in ((3, 6), (6, 13)):
        got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, tables=tables, block_rows=64).collect()}
        found = np.array([got[i].n_links for i in range(len(x))])
        assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.999 * near.sum() > 2000
        top = roots(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near))])
        assert np.mean([got[i].component_id == top[i] for i in range(len(x))]) >= 0.999


def test_tables_follow_the_number_of_vectors():
    assert embedding_dedup.table_plan(50_000, 0.95, 0.999, 3.5) == (0, 1)
    work = []
    for n in (50_000, 500_000, 5_000_000, 10**9):
        signs, tables = embedding_dedup.table_plan(n, 0.95, 0.999, 3.5)
        work.append(tables * (0.6 * n / 2**signs + 3000))
        if signs:
            agree = (1 - np.arccos(0.95) / np.pi) ** signs * 0.999
            assert (1 - agree) ** tables <= 0.0005
    assert work[1] < 2.2 * work[0] and work[3] < 10 * work[0]
