import hashlib

import pytest

from pyspark.sql import functions as F

from lakekit.functions import amount, money_sum, money_total

from lakekit.functions import band, flag, legacy_int, pct, pick, safe_ratio, surrogate_id
from lakekit.plans.jobs import conform_employees


def _one_col(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_legacy_int_edges(spark):
    values = ["12.5", "abc", " 7 ", "1e3", "99999999999", "", "+4", "-3.9", "5.", None, ".5", "-.5", ".", "+", "1.2.3", "\t8\t"]
    df = _one_col(spark, values).withColumn("i", legacy_int("x"))
    got = [r["i"] for r in df.collect()]
    assert got == [12, None, 7, None, None, None, 4, -3, 5, None, 0, 0, None, None, None, 8]


def test_salary_band_null_is_top_band(spark):
    df = _one_col(spark, ["4999", "5000", "9999", "10000", None, "abc"])
    out = df.select(band(legacy_int("x"), [(5000, "baixa"), (10000, "media")], "alta").alias("b"))
    assert [r["b"] for r in out.collect()] == ["baixa", "media", "media", "alta", "alta", "alta"]


def test_salary_band_opt_in_null_band(spark):
    df = _one_col(spark, ["4999", None])
    out = df.select(band(legacy_int("x"), [(5000, "baixa")], "alta", null_band="desconhecida").alias("b"))
    assert [r["b"] for r in out.collect()] == ["baixa", "desconhecida"]


def test_exit_flag(spark):
    df = _one_col(spark, ["Yes", "No", None, "yes"])
    assert [r[0] for r in df.select(flag(F.col("x") == "Yes")).collect()] == [1, 0, 0, 0]


def test_pick_by_presence_not_value(spark):
    df = spark.createDataFrame([(None, "Life Sciences")], "JobRole string, EducationField string")
    assert df.select(pick(df, "JobRole", "EducationField", default="N/D")).first()[0] is None
    only_edu = df.drop("JobRole")
    assert only_edu.select(pick(only_edu, "JobRole", "EducationField", default="N/D")).first()[0] == "Life Sciences"
    none = df.drop("JobRole", "EducationField").withColumn("z", F.lit(1))
    assert none.select(pick(none, "JobRole", "EducationField", default="N/D")).first()[0] == "N/D"
    assert none.select(pick(none, "Age")).first()[0] is None


def test_all_absent_sheet(spark):
    raw = spark.createDataFrame([("x",)], "Unrelated string")
    out = conform_employees(raw, load_date_value="2024-01-01").first().asDict()
    assert out["employee_id"] == hashlib.sha256(b"||||").hexdigest()
    expected = {
        "departamento": "N/D",
        "cargo": "N/D",
        "idade": None,
        "genero": "N/D",
        "anos_empresa": None,
        "satisfacao": None,
        "rotatividade": "No",
        "faixa_salarial": "alta",
        "total_funcionarios": 1,
        "total_saidas": 0,
        "media_satisfacao": None,
        "media_anos_empresa": None,
    }
    for k, v in expected.items():
        assert out[k] == v, k
    assert str(out["data_carga"]) == "2024-01-01"


def test_hash_id_null_skipping_collides(spark):
    cols = "Age string, Department string, MonthlyIncome string, YearsAtCompany string, Attrition string"
    df = spark.createDataFrame(
        [("a", None, "c", "d", "e"), ("a", "c", None, "d", "e"), ("a", "b", "c", "d", "e"), ("a", "b", "c", "d", "e")],
        cols,
    )
    parts = ["Age", "Department", "MonthlyIncome", "YearsAtCompany", "Attrition"]
    ids = [r[0] for r in df.select(surrogate_id(df, "EmployeeNumber", parts)).collect()]
    assert ids[0] == ids[1] == hashlib.sha256(b"a|c|d|e").hexdigest()
    assert ids[2] == ids[3]
    strict = [r[0] for r in df.select(surrogate_id(df, "EmployeeNumber", parts, strict=True)).collect()]
    assert strict[0] != strict[1] and strict[2] == strict[3]


def test_natural_id_wins(spark):
    df = spark.createDataFrame([(42, "30")], "EmployeeNumber int, Age string")
    assert df.select(surrogate_id(df, "EmployeeNumber", ["Age"])).first()[0] == "42"


def test_safe_ratio_and_pct(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, 4), (1.0, 3)], "n double, d int")
    out = df.select(safe_ratio(F.col("n"), F.col("d")).alias("r"), pct(F.col("n"), F.col("d"), 1).alias("p")).collect()
    assert out[0]["r"] is None and out[0]["p"] is None
    assert out[1]["r"] == 2.5 and out[1]["p"] == 250.0
    assert out[2]["p"] == 33.3


def test_money_is_lenient_and_exact(spark):
    df = spark.createDataFrame([("58.90",), ("abc",), ("0.1",), ("0.2",), (None,)], "p string")
    assert [r[0] for r in df.select(amount("p").cast("double")).collect()] == [58.9, None, 0.1, 0.2, None]
    r = df.agg(money_sum("p").alias("s"), money_total("p").alias("t")).first()
    assert r.s == 59.2 and str(r.t) == "59.20"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_sum_drops_and_wraps_nothing(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for values, total in (([0.004, 0.004, 1e17, 10.0], 1e17), ([9e16, 9e16], 1.8e17), ([0.0004] * 5, 0.002), ([1e40, 1.0], 1e40), ([9e31] * 3, 2.7e32)):
            df = spark.createDataFrame([(v,) for v in values], "p double")
            assert df.agg(F.round(money_sum("p"), 6)).first()[0] == pytest.approx(total, rel=1e-12)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_sum_is_exact_or_the_double_sum(spark, ansi):
    import decimal
    import random

    rng = random.Random(5)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        # a million times 1e-7: more than six places, so the double sum holds
        tiny = spark.range(1_000_000).select(F.lit(1e-7).alias("p"))
        assert tiny.agg(money_sum("p")).first()[0] == pytest.approx(0.1, rel=1e-9)
        for scale, top in ((2, 10**6), (6, 10**9), (6, 10**15), (0, 10**18), (4, 10**13)):
            values = [decimal.Decimal(rng.randrange(-top, top)).scaleb(-scale) for _ in range(500)]
            df = spark.createDataFrame([(float(v),) for v in values], "p double")
            got = df.agg(money_sum("p")).first()[0]
            if top <= 2**53:  # each value is one double, so the sum of the decimals is known
                assert got == float(sum(values))
                assert abs(df.agg(money_total("p")).first()[0] - sum(values)) <= decimal.Decimal("0.005")
            assert got == df.orderBy(F.rand(3)).repartition(7).agg(money_sum("p")).first()[0]
        odd = spark.createDataFrame([(1.0,), (0.12345678,), (None,), (2.5,)], "p double")
        assert odd.agg(money_sum("p")).first()[0] == pytest.approx(3.62345678, rel=1e-15)
        special = spark.createDataFrame([(float("nan"),), (1.0,)], "p double")
        assert str(special.agg(money_sum("p")).first()[0]) == "nan"
        assert special.where("p > 5 and p < 6").agg(money_sum("p")).first()[0] is None
        assert spark.createDataFrame([(float("inf"),), (1.0,)], "p double").agg(money_sum("p")).first()[0] == float("inf")
        huge = spark.range(1000).select(F.lit(1e18).alias("p"))
        assert huge.agg(money_sum("p")).first()[0] == 1e21
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_hash_id_on_typed_sheet(spark):
    typed = spark.createDataFrame([(41, "Sales", 5000, 3, "No")], "Age int, Department string, MonthlyIncome int, YearsAtCompany int, Attrition string")
    parts = ["Age", "Department", "MonthlyIncome", "YearsAtCompany", "Attrition"]
    got = typed.select(surrogate_id(typed, "EmployeeNumber", parts)).first()[0]
    assert got == hashlib.sha256(b"41|Sales|5000|3|No").hexdigest()


def test_scale_conf_sizes_partitions():
    from lakekit.session import scale_conf

    big = scale_conf(100 * 1024**4)  # 409,600 splits of 256 MiB, clamped
    assert big["spark.sql.shuffle.partitions"] == "200000"
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"
    assert scale_conf(10 * 1024**2)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(1024**4)["spark.sql.shuffle.partitions"] == "4096"
