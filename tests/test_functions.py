import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aislecast.functions import dates, ids, money
from aislecast.functions.numeric import interval_bounds, round_even
from aislecast.functions.text import is_blank, lexicon_score, tokens, truncate


def column(spark, values, ddl, col):
    df = spark.createDataFrame([(v,) for v in values], f"v {ddl}")
    return [r[0] for r in df.select(col(F.col("v"))).collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=50))
def test_round_even_equals_array_rounding(spark, values):
    for digits in (1, 2, 4):
        got = column(spark, values, "double", lambda c, d=digits: round_even(c, d))
        assert np.array_equal(got, np.round(np.array(values), digits))


def test_scores_count_distinct_list_words_with_punctuation_kept(spark):
    texts = {
        "This product is amazing! Highly recommended and works perfectly.": 0.0,
        "Decent value for the price. Not the best, but gets the job done.": 0.0,
        "Absolutely love this SKU! Excellent build quality and design.": 1.0,
        "good good bad": 0.0,
        "GOOD bad\tterrible x": -1 / 3,
        "Great deal! Works perfectly and shipping was super fast.": 1.0,
    }
    got = column(spark, list(texts), "string", lexicon_score)
    assert got == pytest.approx(list(texts.values()))


def test_scores_use_the_whole_text(spark):
    text = "word " * 20_000 + "awful"
    assert column(spark, [text], "string", lexicon_score) == [-1.0]


def test_overlapping_lists_still_score(spark):
    got = column(spark, ["a b"], "string", lambda c: lexicon_score(c, ["a", "b"], ["b"]))
    assert got == pytest.approx([1 / 3])


def test_blank_and_tokens_follow_unicode_white_space(spark):
    values = ["", " \t  \x1c", "x"]
    assert column(spark, values, "string", is_blank) == [True, True, False]
    text = "a B\x1dc\u0085d"
    assert column(spark, [text], "string", tokens) == [text.lower().split()]
    assert column(spark, ["x" * 600], "string", truncate) == ["x" * 512]


def test_ids(spark):
    got = column(spark, ["SKU_007", "SKU_x", "plain", "a_b_12"], "string", ids.suffix_number)
    assert got == [7, None, None, 12]
    names = ["n0", "n1", "n2"]
    got = column(spark, ["S_4", "S", "S_x"], "string", lambda c: ids.name_by_suffix(c, names, "none"))
    assert got == ["n1", "none", "none"]
    assert column(spark, [0, 9998, 9999], "long", ids.anomaly_id) == ["ANOM_0001", "ANOM_9999", "ANOM_10000"]


def test_rupees(spark):
    got = column(spark, [25_000_000.0, 250_000.0, 99_999.4, 12.0], "double", money.format_inr)
    assert got == ["₹2.50 Cr", "₹2.50 Lakhs", "₹99,999", "₹12"]


def test_calendar_monday_is_zero(spark):
    days = [dt.date(2025, 1, 6), dt.date(2025, 1, 11), dt.date(2025, 1, 12)]
    assert column(spark, days, "date", dates.weekday) == [0, 5, 6]
    assert column(spark, days, "date", dates.is_weekend) == [0, 1, 1]


def test_lenient_parsing(spark):
    assert column(spark, ["1.5", " 2 ", "x", None], "string", dates.lenient_number) == [1.5, 2.0, None, None]
    got = column(spark, ["2025-01-02 03:04:05", "soon"], "string", dates.lenient_timestamp)
    assert got == [dt.datetime(2025, 1, 2, 3, 4, 5), None]


def test_other_date_layouts(spark):
    texts = ["2025-01-31", "1/31/2025", "31/1/2025", "1/31/2025 5:06", "2025/01/31", "31-Jan-2025", "20250131", "x"]
    got = column(spark, texts, "string", lambda c: dates.lenient_timestamp(c, dates.DATE_FORMATS))
    day = dt.datetime(2025, 1, 31)
    assert got == [day, day, day, day.replace(hour=5, minute=6), day, day, day, None]


def test_event_day_of_missing_time_is_today(spark):
    now = F.lit("2025-05-05 01:02:03").cast("timestamp")
    got = column(spark, ["2025-06-01 12:00:00", None], "string", lambda c: dates.event_day(c, now))
    assert got == ["2025-06-01", "2025-05-05"]


def test_interval_is_floored(spark):
    got = spark.range(1).select(*interval_bounds(F.lit(2.0), F.lit(5.0))).first()
    assert got[0] == 0.0 and math.isclose(got[1], 8.4)
