"""Property tests for the lenient parsers (one Spark job per example batch)."""

import decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from lakekit.functions import amount, legacy_int

INT32 = (-(2**31), 2**31 - 1)


def _expected_int(text):
    t = text.strip()
    sign = ""
    if t[:1] in "+-":
        sign, t = t[:1], t[1:]
    whole, dot, frac = t.partition(".")
    if (whole and not whole.isdigit()) or (frac and not frac.isdigit()) or not (whole or frac):
        return None
    v = int(sign + whole) if whole else 0
    return v if INT32[0] <= v <= INT32[1] else None


numeric_text = st.builds(
    lambda sign, whole, frac, pad: f"{pad}{sign}{whole}{frac}{pad}",
    st.sampled_from(["", "+", "-"]),
    st.integers(min_value=0, max_value=10**11).map(str),
    st.one_of(st.just(""), st.just("."), st.integers(min_value=0, max_value=999).map(lambda f: f".{f}")),
    st.sampled_from(["", " ", "  "]),
)
junk_text = st.sampled_from(["abc", "1e3", "--1", "1.2.3", "", " ", "0x10", "1,000", "12a", ".5", "-.25", ".", "+-1"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(numeric_text, junk_text), min_size=1, max_size=60))
def test_legacy_int_matches_truncating_reference(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(legacy_int("x")).collect()]
    assert got == [_expected_int(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=80))
def test_cents_are_exact_for_two_decimal_amounts(spark, cents):
    texts = [str(decimal.Decimal(c).scaleb(-2)) for c in cents]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r[0] for r in df.select(amount("p")).collect()]
    assert got == [decimal.Decimal(c).scaleb(-2) for c in cents]
    total = df.agg({"p": "count"}).first()[0]
    assert total == len(cents)
