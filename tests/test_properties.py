"""Property tests: formatted values parse back to what was formatted."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchflow.functions import parsing

SETTINGS = dict(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2060, 12, 31)), min_size=1, max_size=60))
def test_every_landing_date_format_parses_back(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    season = F.year("d")
    formats = {
        "numeric": F.date_format("d", "dd-MM-yyyy"),
        "with_weekday": F.date_format("d", "EEEE, MMMM d, yyyy"),
        "no_year": F.date_format("d", "EEEE, MMMM d"),
    }
    parsed = df.select("d", *[parsing.parse_match_date(expr, season).alias(name) for name, expr in formats.items()])
    for row in parsed.collect():
        assert row.numeric == row.with_weekday == row.d
        # without a year the season supplies it (here the date's own year, so Feb 29 is valid)
        assert row.no_year == row.d


@settings(**SETTINGS)
@given(
    st.lists(
        st.tuples(st.integers(0, 10**6), st.integers(0, 100), st.booleans(), st.booleans()),
        min_size=1,
        max_size=60,
    )
)
def test_value_pct_round_trip(spark, items):
    rows = []
    for value, pct, half, plain in items:
        pct_text = f"{pct}.5" if half else str(pct)
        rows.append((str(value) if plain else f"{value} ({pct_text}%)", value, None if plain else float(pct_text)))
    df = spark.createDataFrame(rows, "s string, v int, p double")
    out = df.select(
        "v", "p", parsing.value_part(F.col("s")).alias("gv"), parsing.pct_part(F.col("s")).alias("gp")
    ).collect()
    assert all(r.v == r.gv and r.p == r.gp for r in out)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 100), st.booleans()), min_size=1, max_size=60))
def test_percent_only_truncates(spark, items):
    rows = [(f"{p}.5%" if half else f"{p}%", p) for p, half in items]
    out = spark.createDataFrame(rows, "s string, p int").select(
        "p", parsing.percent_only(F.col("s")).alias("g")
    ).collect()
    assert all(r.p == r.g for r in out)
