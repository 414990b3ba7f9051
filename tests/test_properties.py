"""Property tests: column expressions against plain-Python statements of the same rules."""

from decimal import ROUND_FLOOR, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kickwx.functions.casts import to_decimal_5_2_trunc, to_int_via_double
from kickwx.functions.masks import attendance_band, goal_range
from kickwx.operators.enrich import geocode_query_text

FEW = settings(max_examples=6, deadline=None)


def column(spark, values, ddl, expr):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


@FEW
@given(st.lists(st.decimals(min_value=0, max_value=Decimal("999.9999"), places=4), min_size=1, max_size=300))
def test_decimal_text_is_truncated(spark, values):
    texts = [f"{v:f}" for v in values]
    want = [Decimal(t).quantize(Decimal("0.01"), rounding=ROUND_FLOOR) for t in texts]
    assert column(spark, texts, "x string", to_decimal_5_2_trunc) == want


@FEW
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=300))
def test_count_text_goes_through_double(spark, values):
    texts = [repr(v) for v in values]
    assert column(spark, texts, "x string", to_int_via_double) == [int(float(t)) for t in texts]


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-30, max_value=200)), min_size=1, max_size=300))
def test_goal_ranges(spark, goals):
    def py(g):
        if g is None:
            return None
        lo = int(g / 2) * 2  # intDiv truncates toward zero
        return f"{lo}-{lo + 1}"
    assert column(spark, goals, "x int", goal_range) == [py(g) for g in goals]


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=10**7)), min_size=1, max_size=300))
def test_attendance_bands(spark, values):
    def py(a):
        if a is None:
            return None
        for bound, label in [(10, "0-10"), (100, "10-100"), (1000, "100-1000"), (10000, "1000-10 000"),
                             (100000, "10 000-100 000")]:
            if a < bound:
                return label
        return "100 000+"
    assert column(spark, values, "x int", attendance_band) == [py(a) for a in values]


_PLACE = st.one_of(st.none(), st.text(alphabet=" \tNnoeONE,x", max_size=7))


@FEW
@given(st.lists(st.tuples(_PLACE, _PLACE), min_size=1, max_size=200))
def test_geocode_text(spark, pairs):
    def part(x):
        return x.strip() if x and x.lower() != "none" else None
    df = spark.createDataFrame(pairs, "city string, country string")
    got = [r[0] for r in df.select(geocode_query_text(F.col("city"), F.col("country"))).collect()]
    assert got == [", ".join(filter(None, [part(c), part(k)])) for c, k in pairs]
