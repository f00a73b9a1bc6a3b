"""Commit log, concurrent publishing, merging distinct counts."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from lakekit import sinks as K
from lakekit.commits import CommitLog, ConcurrentPublish, put_if_absent
from lakekit.contracts import SALES_CONTRACT
from lakekit.operators.distinct import DistinctLedger
from lakekit.sources.files import read_current


def _sales(spark, name, rows=1):
    return spark.createDataFrame([(f"{name}{i}", 1.0, i) for i in range(rows)], SALES_CONTRACT.schema)


def _together(jobs):
    out = [None] * len(jobs)

    def run(i):
        try:
            out[i] = jobs[i]()
        except ConcurrentPublish as exc:
            out[i] = exc

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(jobs))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


def test_one_of_many_writers_gets_a_name(spark, tmp_dir):
    for name in ("a", "b", "c"):
        got = _together([lambda i=i, n=name: put_if_absent(spark, f"{tmp_dir}/log/{n}", f"writer {i}") for i in range(8)])
        assert sorted(got) == [False] * 7 + [True]
        with open(f"{tmp_dir}/log/{name}") as f:
            assert f.read() == f"writer {got.index(True)}"


def test_the_second_of_two_writers_gets_a_conflict(spark, tmp_dir):
    loc = f"{tmp_dir}/sales"
    K.write_refined(_sales(spark, "old"), SALES_CONTRACT, loc)
    base = K.published(spark, loc)
    first = K.write_refined(_sales(spark, "first", 3), SALES_CONTRACT, loc, base=base)
    with pytest.raises(ConcurrentPublish, match=first.rsplit("/", 1)[-1]):
        K.write_refined(_sales(spark, "second", 5), SALES_CONTRACT, loc, base=base)
    assert K.current_version(spark, loc) == first and read_current(spark, SALES_CONTRACT, loc).count() == 3
    assert K.write_refined(_sales(spark, "second", 5), SALES_CONTRACT, loc) == K.current_version(spark, loc)
    assert CommitLog(spark, loc).numbers() == [1, 2, 3]


def test_writers_at_once_lose_no_update_unseen(spark, tmp_dir):
    loc = f"{tmp_dir}/sales"
    base = K.published(spark, loc)
    got = _together([lambda i=i: K.write_refined(_sales(spark, f"w{i}", i + 1), SALES_CONTRACT, loc, base=base) for i in range(4)])
    won = [i for i, x in enumerate(got) if not isinstance(x, ConcurrentPublish)]
    assert len(won) == 1 and K.current_version(spark, loc) == got[won[0]]
    assert read_current(spark, SALES_CONTRACT, loc).count() == won[0] + 1
    # those that start from the last commit get through one after the other
    for i in range(3):
        K.write_refined(_sales(spark, "x", i + 1), SALES_CONTRACT, loc)
    assert K.expire_versions(spark, loc, keep=2)[0] == got[won[0]] and CommitLog(spark, loc).numbers() == [3, 4]
    assert read_current(spark, SALES_CONTRACT, loc).count() == 3 and K.published(spark, loc) == 4


def test_distinct_counts_merge_without_a_second_read(spark, tmp_dir):
    rng = random.Random(2)
    schema = "id string, dep string, role string"
    deliveries = []
    for _ in range(3):
        rows = [(str(rng.randrange(3000)), rng.choice(["a", "a", "b", None]), rng.choice("xyz")) for _ in range(2000)]
        deliveries.append(spark.createDataFrame(rows + [(None, "a", "x"), ("z", "only null ids", "x"), (None, "no ids", "x")], schema))
    ledger = DistinctLedger(spark, f"{tmp_dir}/ledger", ["dep", "role"], "id")
    seen = None
    for i, delivery in enumerate(deliveries):
        assert ledger.add(delivery) == i + 1
        seen = delivery if seen is None else seen.unionByName(delivery)
        got = {(r.dep, r.role): r.distinct_ids for r in ledger.counts().collect()}
        assert got == {(r.dep, r.role): r.n for r in seen.groupBy("dep", "role").agg(F.countDistinct("id").alias("n")).where("n > 0").collect()}
    by_dep = ledger.counts("dep")
    assert {r.dep: r.distinct_ids for r in by_dep.collect()} == {r.dep: r.n for r in seen.groupBy("dep").agg(F.countDistinct("id").alias("n")).where("n > 0").collect()}
    assert ledger.total().first()[0] == seen.select("id").dropna().distinct().count()
    assert all("/bitmaps/delivery=" in f for f in by_dep.inputFiles())
    numbers = spark.read.parquet(f"{tmp_dir}/ledger/dictionary/*/*").agg(F.min("number"), F.max("number"), F.count("*"), F.countDistinct("number")).first()
    assert (numbers[0], numbers[1] + 1) == (0, numbers[2]) and numbers[2] == numbers[3]
    # an earlier ledger opened anew goes on; a stale writer gets a conflict
    again = DistinctLedger(spark, f"{tmp_dir}/ledger", ["dep", "role"], "id")
    again.log.last_number = lambda: 2
    with pytest.raises(ConcurrentPublish):
        again.add(deliveries[0])
    assert ledger.total().first()[0] == seen.select("id").dropna().distinct().count()
