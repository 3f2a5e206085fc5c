"""Property tests: the Column rules against plain-Python statements of the
same rules on random inputs (one Spark job per batch of examples)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions import exprs as X

WORDS = ["bão", "lũ", "sạt lở", "rét", "giông", "lốc", "khẩn cấp", "mạnh", "rất mạnh", "cảnh báo", "mưa", "Nắng Nóng",
         "x", " "]


def py_keyword(fields, rules_list, default):
    for rule in rules_list:
        words, names, label = rule if len(rule) == 3 else (rule[0], tuple(fields), rule[1])
        for n in names:
            text = fields[n]
            if text is not None and any(w in text.lower() for w in words):
                return label
    return default


texts = st.one_of(st.none(), st.lists(st.sampled_from(WORDS), max_size=6).map(" ".join))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=20, max_size=60))
def test_keyword_rules_match_python(spark, data):
    df = spark.createDataFrame(data, "title string, summary string")
    got = [tuple(r) for r in df.select(X.disaster_type("title", "summary"), X.severity_level("title")).collect()]
    want = [(py_keyword({"title": t, "summary": s}, rules.DISASTER_TYPE_RULES, "other"),
             py_keyword({"title": t}, rules.SEVERITY_RULES, "normal")) for t, s in data]
    assert got == want


def py_aqi(code, v):
    if v is None:
        return None
    segs = rules.AQI_BREAKPOINTS.get(code)
    if not segs:
        return min(int(v.quantize(Decimal(1), ROUND_HALF_UP)), rules.AQI_CAP)
    for upper, c_lo, c_hi, i_lo, span in segs:
        if v <= Decimal(str(upper)):
            lo, hi = Decimal(str(c_lo)), Decimal(str(c_hi))
            raw = Decimal(i_lo) + (v - lo) / (hi - lo) * span
            return int(raw.quantize(Decimal(1), ROUND_HALF_UP))
    return rules.AQI_ABOVE_LAST


values = st.one_of(st.none(), st.decimals(min_value=0, max_value=700, places=1, allow_nan=False))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["pm25", "pm10", "o3", "no2"]), values), min_size=30, max_size=80))
def test_aqi_subindex_matches_python(spark, data):
    df = spark.createDataFrame([(c, v) for c, v in data], "c string, v decimal(12,4)")
    got = [r[0] for r in df.select(X.aqi_subindex(F.col("c"), F.col("v"))).collect()]
    assert got == [py_aqi(c, v) for c, v in data]


def py_cut(v, cuts, default):
    ops = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "=": lambda a, b: a == b}
    if v is None:
        return default
    for op, bound, label in cuts:
        if ops[op](v, Decimal(str(bound))):
            return label
    return default


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.decimals(min_value=-20, max_value=400, places=2, allow_nan=False)),
                min_size=30, max_size=80))
def test_cut_lists_match_python(spark, data):
    df = spark.createDataFrame([(v,) for v in data], "v decimal(8,2)")
    cols = [(rules.DAY_LABEL_CUTS, rules.DAY_LABEL_DEFAULT), (rules.COMFORT_CUTS, rules.COMFORT_DEFAULT),
            (rules.RAIN_CUTS, rules.RAIN_DEFAULT), (rules.RISK_LEVEL_CUTS, rules.RISK_LEVEL_DEFAULT)]
    got = [tuple(r) for r in df.select(*[X.bucketize("v", c, d) for c, d in cols]).collect()]
    assert got == [tuple(py_cut(v, c, d) for c, d in cols) for v in data]
