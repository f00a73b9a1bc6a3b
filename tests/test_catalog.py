import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lakekit import catalog as C
from lakekit import policy as G
from lakekit import sinks as K
from lakekit.contracts import ANALYTICS, SALES, SALES_CONTRACT


def test_drift_actions(spark):
    declared = C.schema_frame(spark, [("a", "int"), ("b", "string"), ("c", "bigint"), ("d", "string")])
    observed = C.schema_frame(spark, [("a", "bigint"), ("c", "int"), ("d", "int"), ("e", "double")])
    got = {r.column: r.action for r in C.schema_drift(declared, observed).collect()}
    assert got == {"a": "WIDEN", "b": "LOG", "c": "SAME", "d": "CONFLICT", "e": "ADD"}


def test_discover_schema_widens_across_files(spark, tmp_dir):
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "x": pa.array(["a"])}), f"{tmp_dir}/f1.parquet")
    pq.write_table(pa.table({"id": pa.array([2], pa.int64()), "y": pa.array([1.5])}), f"{tmp_dir}/f2.parquet")
    pq.write_table(pa.table({"id": pa.array([3], pa.int64()), "x": pa.array([7], pa.int32())}), f"{tmp_dir}/f3.parquet")
    got = {r.column: (r.type, r.files, r.status) for r in C.discover_schema(spark, tmp_dir).collect()}
    assert got["id"] == ("bigint", 3, "WIDEN")
    assert got["y"] == ("double", 1, "SAME")
    assert got["x"][2] == "CONFLICT" and got["x"][0] is None
    assert C.discover_schema(spark, tmp_dir, allow_string=True).filter("column = 'x'").first().type == "string"
    struct = C.to_struct(C.discover_schema(spark, tmp_dir))
    assert [f.name for f in struct.fields] == ["id", "y"]


def test_register_write_repoint_and_drift(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.0, 1)], SALES_CONTRACT.schema)
    C.register_domain(spark, SALES_CONTRACT.domain, tmp_dir)
    loc = SALES_CONTRACT.location(tmp_dir)
    v1 = K.write_refined(df, SALES_CONTRACT, loc)
    C.register_table(spark, SALES_CONTRACT, v1, replace=True)
    assert C.check_partitions(spark, SALES_CONTRACT) == []
    v2 = K.write_refined(spark.createDataFrame([("b", 2.0, 2)], SALES_CONTRACT.schema), SALES_CONTRACT, loc)
    assert v1 != v2
    assert [r[0] for r in spark.table(SALES_CONTRACT.qualified_name).collect()] == ["b"]
    with pytest.raises(K.ContractViolation):
        K.write_refined(df.withColumnRenamed("qtd_itens", "n"), SALES_CONTRACT, loc)
    drift = C.schema_drift(
        C.schema_frame(spark, SALES_CONTRACT.schema),
        C.schema_frame(spark, [(f.name, f.dataType.simpleString()) for f in SALES_CONTRACT.schema.fields] + [("canal", "string")]),
    )
    policy = G.Policy(G.reference_grants(tmp_dir))
    with pytest.raises(PermissionError):
        C.apply_drift(spark, SALES_CONTRACT.qualified_name, drift, allowed=policy.ddl_guard(ANALYTICS))
    stmts = C.apply_drift(spark, SALES_CONTRACT.qualified_name, drift, allowed=policy.ddl_guard(SALES.producer))
    assert len(stmts) == 1 and "canal" in spark.table(SALES_CONTRACT.qualified_name).columns
    assert spark.table(SALES_CONTRACT.qualified_name).filter("canal IS NOT NULL").count() == 0
    files = [f for f in os.listdir(v2) if f.endswith(".parquet")]
    assert files and all(".snappy." in f for f in files)
    guard = policy.write_guard(SALES.producer)
    with pytest.raises(G.AccessDenied):
        K.write_refined(df, SALES_CONTRACT, tmp_dir + "/elsewhere", guard=guard)
    assert K.write_refined(df, SALES_CONTRACT, loc, guard=guard).startswith(loc)


def test_read_current_version_without_catalog(spark, tmp_dir):
    from lakekit.sources.files import read_current, read_refined

    loc = tmp_dir + "/sales"
    for i in range(3):
        K.write_refined(spark.createDataFrame([(f"c{i}", float(i), i)], SALES_CONTRACT.schema), SALES_CONTRACT, loc)
    cur = read_current(spark, SALES_CONTRACT, loc)
    assert cur.columns == SALES_CONTRACT.columns and [r[0] for r in cur.collect()] == ["c2"]
    assert len(SALES_CONTRACT.schema.fields) == 3
    assert [r[0] for r in read_refined(spark, SALES_CONTRACT, loc).collect()] == ["c2"]  # never several versions together
    K.write_refined(spark.createDataFrame([], SALES_CONTRACT.schema), SALES_CONTRACT, loc)
    assert read_current(spark, SALES_CONTRACT, loc).count() == 0  # an empty refresh counts
    assert len(K.expire_versions(spark, loc, keep=1)) == 3
    assert read_current(spark, SALES_CONTRACT, loc).count() == 0


def test_numeric_bound_loses_nothing(spark):
    from pyspark.sql import functions as F

    cases = [
        ("decimal(10,2)", "decimal(12,0)", "decimal(14,2)"),
        ("bigint", "decimal(5,2)", "decimal(21,2)"),
        ("bigint", "float", "double"),
        ("smallint", "float", "float"),
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("decimal(5,2)", "double", "double"),
        ("decimal(38,0)", "decimal(5,4)", None),
    ]
    df = spark.createDataFrame(cases, "a string, b string, want string")
    for x, y in (("a", "b"), ("b", "a")):
        assert all(r.got == r.want for r in df.select("want", C.bound_of(F.col(x), F.col(y)).alias("got")).collect())
    declared = C.schema_frame(spark, [("x", "float"), ("y", "decimal(10,2)"), ("z", "bigint")])
    observed = C.schema_frame(spark, [("x", "bigint"), ("y", "bigint"), ("z", "int")])
    assert {r.column: r.action for r in C.schema_drift(declared, observed).collect()} == {"x": "WIDEN", "y": "WIDEN", "z": "SAME"}
