"""The format of a column of time texts (P9, D10), held against pandas."""

import datetime as dt
import warnings

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pandas.tseries.api import guess_datetime_format

from tessera.functions.timeformat import NOT_SET, guess, infer_format, parsed, zone_text
from tessera.operators import tickets_per_day
from tessera.plans.analyse import analyse
from tessera.schemas import ENRICHED_SCHEMA
from tessera.sinks import read_csv, write_parquet

FORMS = [
    "%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y/%m/%d %H:%M", "%Y.%m.%d", "%m/%d/%Y", "%m/%d/%Y %H:%M", "%m-%d-%Y %H:%M:%S",
    "%m.%d.%Y", "%Y%m%d", "%Y%m%d %H:%M", "%Y%m%dT%H:%M:%S", "%b %d %Y", "%B %d, %Y", "%b %d, %Y %H:%M", "%d %b %Y", "%d %B %Y %H:%M:%S", "%d-%b-%Y",
    "%m/%d/%Y %I:%M %p", "%Y-%m-%d %I:%M:%S %p", "%Y-%m-%dT%H:%M:%S+02:00", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S -0330",
]
LATE = [f.replace("%m/%d", "%d/%m").replace("%m.%d", "%d.%m").replace("%m-%d-", "%d-%m-") for f in FORMS if f.startswith("%m")]


@pytest.mark.parametrize("form", FORMS + LATE)
def test_guess_names_the_form(form):
    """As pandas does for the same text, where pandas knows it."""
    text = dt.datetime(2024, 3, 25, 14, 7, 9, 120000).strftime(form)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        theirs = guess_datetime_format(text)
    assert guess(text).text == (theirs or form)


@pytest.mark.parametrize("text", ["bad-date", "10:00", "2024-13-05", "13/13/2024", "2024", "Foo 5 2024", "2024-01-05x", "2024-01-05 25:00", ""])
def test_guess_knows_no_other_text(text):
    assert guess(text) is None


def pandas_days(texts):
    """Rows per day as the original conversion gives them; None where it fails."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            days = pd.to_datetime(pd.Series(texts, dtype=object)).dt.date.value_counts()
        except Exception:
            return None
    return {k: int(n) for k, n in days.items()}


def spark_days(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "created_at string").coalesce(1)
    series = tickets_per_day(df, mode="skip")
    return None if series is None else {r.day: r.n for r in series.collect()}


TIMES = st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1)).map(lambda t: t.replace(microsecond=t.microsecond // 1000 * 1000))
ODD = st.sampled_from([None, *NOT_SET[:4], "bad", "2024-02-30", "31/12/2024", "2024-01-05", "1/5/2024", "Jan 5 2024", "2024-1-6 1:2:3", "01/05/2024 9:05"])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sampled_from(FORMS + LATE), st.lists(TIMES, min_size=1, max_size=8), st.lists(ODD, max_size=2), st.booleans())
def test_days_equal_pandas(spark, form, times, odd, odd_first):
    texts = [f"{t.year:04d}".join(t.strftime(form.replace("%Y", "\0")).split("\0")) for t in times]
    texts = odd + texts if odd_first and odd and odd[0] in (None, *NOT_SET) else texts + odd
    first = next((t for t in texts if t is not None and t not in NOT_SET), None)
    if first is not None and guess(first) is None:
        return
    assert spark_days(spark, texts) == pandas_days(texts)


@pytest.mark.parametrize("texts", [
    ["01/05/2024", "1/6/2024"], ["01/05/2024", "13/06/2024"], ["13/05/2024", "01/06/2024"], ["2024-01-05", "2024-1-6"], ["20240105", "2024106"],
    ["2024-01-05 10:00:00", "2024-01-05T01:02:03"], ["2024-01-05T10:00:00Z", "2024-01-05T10:00:00+00:00"], ["2024-01-05T10:00:00Z", "2024-01-05T10:00:00+02:00"],
    ["Jan 05 2024", "jan 6 2024"], ["Jan 05 2024", "January 6 2024"], ["01/05/2024 12:30 AM", "01/05/2024 12:30 pm"], ["", None, "01/05/2024"],
    [None, None], ["2024-01-05\n", "2024-01-05"], ["2024-01-05", "2024-01-05\n"], ["2024-01-05 10:00:00.5", "2024-01-05 10:00:00.123456789"],
])
def test_single_cases_equal_pandas(spark, texts):
    assert (spark_days(spark, texts) or {}) == (pandas_days(texts) or {})


def test_times_are_read_to_the_fraction(spark):
    for text, want in (("01/05/2024 12:30 AM", "2024-01-05 00:30:00"), ("5 Mar 2024 7:08:09", "2024-03-05 07:08:09"), ("2024/03/05 07:08:09.25", "2024-03-05 07:08:09.25"), ("December 31, 1999", "1999-12-31 00:00:00")):
        df = spark.createDataFrame([(text,)], "created_at string")
        assert df.select(parsed(infer_format(df)).cast("string")).first()[0] == want


def test_zone_is_kept_apart(spark):
    df = spark.createDataFrame([("2024-01-05T23:00:00-03:30",)], "created_at string")
    fmt = infer_format(df)
    assert tuple(df.select(parsed(fmt).cast("string"), zone_text(fmt)).first()) == ("2024-01-05 23:00:00", "-0330")


def test_inferred_mode_leaves_out_what_does_not_fit(spark):
    df = spark.createDataFrame([("01/05/2024",), ("2024-01-05",), ("01/06/2024",)], "created_at string").coalesce(1)
    assert tickets_per_day(df, mode="skip") is None
    assert [(str(r.day), r.n) for r in tickets_per_day(df, mode="inferred").collect()] == [("2024-01-05", 1), ("2024-01-06", 1)]
    with pytest.raises(ValueError):
        tickets_per_day(df, mode="other")


@pytest.mark.parametrize("mode", ["skip", "inferred"])
def test_the_analysis_reads_and_rewrites_the_form(spark, scratch, mode):
    """The CSV has the times in one form."""
    rows = [(f"t{i}", "C1", f"{i:02d} Mar 2024 10:{i:02d}:00", "r", "support", "low", "Equipe Support") for i in range(1, 6)]
    write_parquet(spark.createDataFrame(rows, ENRICHED_SCHEMA), f"{scratch}/p")
    result = analyse(spark, f"{scratch}/p", f"{scratch}/j", f"{scratch}/out", date_mode=mode)
    assert not result.daily_skipped
    assert sorted((str(r.day), r.n) for r in spark.read.parquet(result.paths["by_day"]).collect()) == [(f"2024-03-0{i}", 1) for i in range(1, 6)]
    assert sorted(r.created_at for r in read_csv(spark, result.paths["csv"], ENRICHED_SCHEMA).collect()) == [f"2024-03-0{i} 10:0{i}:00" for i in range(1, 6)]
