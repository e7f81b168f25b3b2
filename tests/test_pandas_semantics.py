"""Property tests: the Spark operators give what the pandas calls of the
original analysis give, on generated tables with nulls, empty text and many
exact copies (a hot group of copies included)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import (
    clean_for_warehouse,
    cleaning_audit,
    crosstab,
    distinct_rows,
    null_counts,
    value_counts,
)

TEAMS = st.sampled_from(["Equipe Support", "Equipe Technique", "Equipe Générique", None])
PRIOS = st.sampled_from(["low", "medium", "high", "urgent", "critical", "", None])
TEXT = st.sampled_from(["a", "b", "", None])
ROW = st.tuples(TEXT, PRIOS, TEAMS)
COLS = ["request", "priority", "assigned_team"]
SCHEMA = "request string, priority string, assigned_team string"

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def tables(min_size=1):
    # a hot row repeated many times, plus random rows
    return st.tuples(st.lists(ROW, min_size=min_size, max_size=40), ROW, st.integers(0, 30)).map(
        lambda t: t[0] + [t[1]] * t[2]
    )


def frames(spark, rows):
    return spark.createDataFrame(rows, SCHEMA), pd.DataFrame(rows, columns=COLS, dtype=object)


@SETTINGS
@given(rows=tables())
def test_value_counts(spark, rows):
    df, pdf = frames(spark, rows)
    got = {r.priority: r.n for r in value_counts(df, "priority").collect()}
    assert got == pdf["priority"].value_counts().to_dict()


@SETTINGS
@given(rows=tables())
def test_drop_duplicates_dropna_and_nulls(spark, rows):
    df, pdf = frames(spark, rows)
    deduped = pdf.drop_duplicates()
    assert distinct_rows(df).count() == len(deduped)
    assert {r.column_name: r.nulls for r in null_counts(distinct_rows(df)).collect()} == deduped.isna().sum().to_dict()
    clean = deduped.dropna()
    got = sorted(map(tuple, clean_for_warehouse(df).collect()), key=str)
    assert got == sorted(map(tuple, clean.itertuples(index=False)), key=str)
    audit = {r.step: r.rows for r in cleaning_audit(df).collect()}
    assert audit == {"loaded": len(pdf), "deduplicated": len(deduped), "complete": len(clean)}


@SETTINGS
@given(rows=tables())
def test_crosstab_matches_pivot_table(spark, rows):
    df, pdf = frames(spark, rows)
    expected = pdf.pivot_table(index="assigned_team", columns="priority", aggfunc="size", fill_value=0)
    got = crosstab(df).toPandas()
    if expected.empty:
        assert got.empty
        return
    got = got.set_index("assigned_team").sort_index()
    assert list(got.columns) == [str(c) for c in expected.columns]
    assert got.to_dict() == {c: {k: int(v) for k, v in expected[c].items()} for c in expected.columns}


@SETTINGS
@given(
    stamps=st.lists(
        st.datetimes(min_value=pd.Timestamp("2020-01-01").to_pydatetime(), max_value=pd.Timestamp("2030-01-01").to_pydatetime()),
        min_size=1,
        max_size=30,
    )
)
def test_daily_counts_match_pandas(spark, stamps):
    from tessera.operators import tickets_per_day

    text = [s.strftime("%Y-%m-%dT%H:%M:%S") for s in stamps]
    df = spark.createDataFrame([(t,) for t in text], "created_at string")
    expected = pd.to_datetime(pd.Series(text)).dt.date.value_counts().sort_index()
    got = tickets_per_day(df, mode="skip").collect()
    assert [(r.day, r.n) for r in got] == list(expected.items())
