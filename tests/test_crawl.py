"""Crawling a lake root, partitions against the catalog, nested drift carried into tables."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from lakekit import catalog as C
from lakekit import crawl as W
from lakekit import policy as G
from lakekit import sinks as K
from lakekit.contracts import ANALYTICS


def _put(path, columns, rows=1):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({n: pa.array([None] * rows, t) for n, t in columns.items()}), path)


ITEM = {"id": pa.int32(), "name": pa.string(), "price": pa.float64(), "qty": pa.int32()}


def test_files_are_grouped_into_tables(spark, tmp_dir):
    root = f"{tmp_dir}/lake"
    # partitions and a widened column: one table
    _put(f"{root}/sales/day=1/a.parquet", ITEM, 2)
    _put(f"{root}/sales/day=2/b.parquet", ITEM | {"id": pa.int64()}, 3)
    # sibling folders with compatible schemas are one table, by way of a middle one
    _put(f"{root}/logs/north/a.parquet", {k: pa.string() for k in "abcdefghij"})
    _put(f"{root}/logs/south/a.parquet", {k: pa.string() for k in "bcdefghijkl"})
    _put(f"{root}/logs/west/a.parquet", {k: pa.string() for k in "defghijklmn"})
    # the same names with other types are not
    _put(f"{root}/logs/odd/a.parquet", {k: pa.binary() for k in "abcdefghij"})
    # tables side by side in one folder
    _put(f"{root}/flat/people.parquet", {"who": pa.string(), "age": pa.int32()})
    _put(f"{root}/flat/places.parquet", {"where": pa.string(), "lat": pa.float64()})
    got = {r.location.split("/lake/")[1] + ":" + r.table: r for r in W.crawl(spark, root).collect()}
    assert set(got) == {"sales:sales", "logs:logs", "logs/odd:odd", "flat:people", "flat:places"}
    sales = got["sales:sales"]
    assert (sales.partition_keys, sales.files, sales.rows, sales.columns, sales.status) == (["day"], 2, 5, 4, "WIDEN")
    assert sales.schema == "id bigint, name string, price double, qty int"
    assert (got["logs:logs"].folders, got["logs:logs"].columns) == (3, 14)
    assert got["flat:people"].schema == "who string, age int"
    # one column of ten in common is another table
    assert {r.table for r in W.crawl(spark, f"{root}/logs", similarity=0.95).collect()} == {"north", "south", "west", "odd"}


def test_partitions_are_reported_and_repaired(spark, tmp_dir):
    root = f"{tmp_dir}/events"
    spark.sql("DROP TABLE IF EXISTS parts_t")
    spark.sql(f"CREATE TABLE parts_t (x int, day string, kind string) USING parquet PARTITIONED BY (day, kind) LOCATION '{root}'")
    df = spark.createDataFrame([(1, "2024-01-01", "a b/c"), (2, "2024-01-02", "it's 50%+"), (3, "2024-01-03", None)], "x int, day string, kind string")
    df.write.partitionBy("day", "kind").parquet(root, mode="append")
    spark.sql("ALTER TABLE parts_t ADD PARTITION (day = '1999-01-01', kind = 'gone')")
    _put(f"{root}/kind=z/day=2/f.parquet", {"x": pa.int32()})
    _put(f"{root}/f.parquet", {"x": pa.int32()})
    def report():
        return sorted((r.status, r.files) for r in W.partition_report(spark, "parts_t", root).collect())

    assert report() == [("FLAT", 1), ("MISSING", 1), ("MISSING", 1), ("MISSING", 1), ("STALE", 0), ("WRONG_KEY", 1)]
    assert spark.table("parts_t").count() == 0
    policy = G.Policy(G.reference_grants(tmp_dir))
    with pytest.raises(PermissionError):
        W.repair_partitions(spark, "parts_t", root, allowed=policy.ddl_guard(ANALYTICS))
    assert W.repair_partitions(spark, "parts_t", root, batch=2) == {"MISSING": 3, "STALE": 1}
    assert report() == [("FLAT", 1), ("OK", 1), ("OK", 1), ("OK", 1), ("WRONG_KEY", 1)]
    assert sorted(map(tuple, spark.table("parts_t").collect())) == sorted(map(tuple, df.collect()))
    assert W.repair_partitions(spark, "parts_t", root) == {"MISSING": 0, "STALE": 0}
    spark.sql("DROP TABLE parts_t")


def test_declared_keys_over_flat_files_are_reported(spark, tmp_dir):
    _put(f"{tmp_dir}/flat/f.parquet", {"x": pa.int32()})
    spark.sql("DROP TABLE IF EXISTS flat_t")
    spark.sql(f"CREATE TABLE flat_t (x int, day string) USING parquet PARTITIONED BY (day) LOCATION '{tmp_dir}/flat'")
    (row,) = W.partition_report(spark, "flat_t", f"{tmp_dir}/flat").collect()
    assert (row.spec, row.status, row.files) == ("", "FLAT", 1) and row.bytes > 0
    spark.sql("DROP TABLE flat_t")


NESTED = "id int, s struct<a:int,`b c`:string>, xs array<int>, m map<string,struct<v:float>>, t string"


def test_type_paths_round_trip():
    schema = T._parse_datatype_string(NESTED + ", deep array<array<struct<x:map<int,date>>>>")
    rows = C.type_paths(schema)
    assert ("s.`b c`", "string") in rows and ("m{value}.v", "float") in rows and ("deep[][].x{key}", "int") in rows
    rebuilt = C.evolved(T.StructType([]), dict(rows))
    assert rebuilt.simpleString() == schema.simpleString()


def test_nested_drift_is_found_and_carried_out(spark, tmp_dir):
    location = f"{tmp_dir}/nested"
    data = [(1, (5, "x"), [1, None], {"k": (1.5,)}, "t"), (2, None, None, None, None), (3, (None, "y"), [], {}, "")]
    old = spark.createDataFrame(data, NESTED)
    path = K.new_version_path(location)
    K.write_parquet(old, path)
    K.publish_version(spark, location, path)
    spark.sql("DROP TABLE IF EXISTS nested_t")
    spark.sql(f"CREATE TABLE nested_t ({NESTED.replace('`b c`', '`b c`')}) USING parquet LOCATION '{path}'")
    delivered = "id bigint, s struct<a:int,`b c`:string,d:struct<e:date>>, xs array<bigint>, m map<string,struct<v:double>>, more array<struct<z:int>>"
    spark.createDataFrame([], delivered).coalesce(1).write.parquet(f"{tmp_dir}/new")
    observed = C.discover_schema(spark, f"{tmp_dir}/new", nested=True)
    drift = C.schema_drift(C.schema_frame(spark, spark.table("nested_t").schema, nested=True), observed.select("column", "type"))
    got = {r.column: r.action for r in drift.where("action <> 'SAME'").collect()}
    assert got == {"id": "WIDEN", "s.d": "ADD", "s.d.e": "ADD", "xs[]": "WIDEN", "m{value}.v": "WIDEN", "more": "ADD", "more[]": "ADD", "more[].z": "ADD", "t": "LOG"}
    target = C.evolve_table(spark, "nested_t", location, drift)
    want = "id bigint, s struct<a:int,`b c`:string,d:struct<e:date>>, xs array<bigint>, m map<string,struct<v:double>>, t string, more array<struct<z:int>>"
    assert target.simpleString() == T._parse_datatype_string(want).simpleString()
    table = spark.table("nested_t")
    assert table.schema.simpleString() == target.simpleString()
    rows = {r.id: r for r in table.collect()}
    assert (rows[1].s.a, rows[1].s["b c"], rows[1].s.d, rows[1].xs, rows[1].m["k"].v, rows[1].more) == (5, "x", None, [1, None], 1.5, None)
    assert (rows[2].s, rows[2].xs, rows[2].m) == (None, None, None) and rows[3].xs == [] and rows[3].m == {}
    assert K.published(spark, location) == 2 and K.current_version(spark, location) != path
    clash = C.schema_drift(C.schema_frame(spark, table.schema, nested=True), C.schema_frame(spark, [("id", "string")]))
    with pytest.raises(ValueError, match="id"):
        C.evolve_table(spark, "nested_t", location, clash)
    spark.sql("DROP TABLE nested_t")
