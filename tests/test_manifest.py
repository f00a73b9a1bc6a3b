import os

from pyspark.sql import functions as F

from lakekit.sources.manifest import changed_files, changed_ranges, file_ranges, raw_file_manifest


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, body in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(body)
    return folder


def _named(df):
    return df.withColumn("path", F.regexp_replace("path", "^.*/", ""))


def _statuses(spark, new, old, **options):
    got = changed_files(_named(raw_file_manifest(spark, new, **options)), _named(raw_file_manifest(spark, old, **options)))
    return {r.path: r.status for r in got.collect()}


def test_content_decides_not_time_or_length(spark, tmp_dir):
    old = _write(f"{tmp_dir}/old", {"same.csv": b"a,b\n1,2\n", "edited.csv": b"a,b\n1,2\n", "cut.csv": b"a\n", "crlf.csv": b"a\r\nb\n", "bytes.csv": b"\xff\xfe\n\0x", "none.csv": b"", "a b+%41 c.csv": b"1"})
    new = _write(f"{tmp_dir}/new", {"same.csv": b"a,b\n1,2\n", "edited.csv": b"a,b\n1,3\n", "cut.csv": b"a", "crlf.csv": b"a\nb\r\n", "bytes.csv": b"\xff\xfd\n\0x", "none.csv": b"", "a b+%41 c.csv": b"1"})
    for name in os.listdir(old):
        os.utime(f"{old}/{name}", (1, 1))
        os.utime(f"{new}/{name}", (1, 1) if name == "edited.csv" else (2, 2))
    want = {"same.csv": "UNCHANGED", "edited.csv": "CHANGED", "cut.csv": "CHANGED", "crlf.csv": "CHANGED", "bytes.csv": "CHANGED", "a b+%41 c.csv": "UNCHANGED"}
    assert _statuses(spark, new, old) == want
    assert _statuses(spark, new, old, with_md5=False)["edited.csv"] == "UNCHANGED"


def test_large_file_is_many_tasks_and_ranges(spark, tmp_dir):
    lines = [b"%07d,some text of a row" % i for i in range(40_000)]
    edited = list(lines)
    edited[30_000] = edited[30_000].replace(b"some", b"same")
    old = _write(f"{tmp_dir}/old", {"big.csv": b"\n".join(lines)})
    new = _write(f"{tmp_dir}/new", {"big.csv": b"\n".join(edited)})
    size = 100_000
    ranges = file_ranges(spark, old, range_bytes=size)
    assert ranges.rdd.getNumPartitions() == -(-os.path.getsize(f"{old}/big.csv") // size) == ranges.count()
    assert ranges.agg(F.sum("bytes")).first()[0] == os.path.getsize(f"{old}/big.csv") + 1
    diff = changed_ranges(_named(file_ranges(spark, new, range_bytes=size)), _named(ranges)).collect()
    assert [(r.path, r.start, r.status) for r in diff] == [("big.csv", 30_000 * len(lines[0] + b"\n") // size * size, "CHANGED")]
    assert _statuses(spark, new, old, range_bytes=size) == {"big.csv": "CHANGED"}


def test_digest_does_not_depend_on_the_session(spark, tmp_dir):
    folder = _write(f"{tmp_dir}/d", {f"{i}.csv": b"row\n" * 5000 * (i + 1) for i in range(3)})
    first = sorted(raw_file_manifest(spark, folder, range_bytes=10_000).select("path", "md5").collect())
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "3333")
    assert sorted(raw_file_manifest(other, folder, range_bytes=10_000).select("path", "md5").collect()) == first
    assert first == sorted(raw_file_manifest(spark, folder, range_bytes=10_000).select("path", "md5").collect())
