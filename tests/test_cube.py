"""Dashboard counts that grow with the exports."""

import pytest

from tessera.plans import cube
from tessera.plans import fixtures as fx
from tessera.plans.dashboard import DASHBOARD_SQL, dashboard_query
from tessera.sinks import write_parquet
from tessera.sources import read_message_log, read_parquet_dir
from tessera.streaming import run_export
from tessera.streaming.publish import publish_tickets


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def export(df, scratch, lot):
    write_parquet(df, f"{scratch}/export/lot={lot}")


@pytest.fixture
def routed(spark, sf001):
    return fx.tickets_with_bad_dates(spark, sf001)


def test_equals_the_dashboard_over_all_rows(spark, sf001, scratch, routed):
    dirty = fx.dirty_tickets(spark, sf001)
    for lot, df in enumerate((routed, dirty, routed.limit(10))):
        export(df, scratch, lot)
        cube.update_cube(spark, f"{scratch}/export", f"{scratch}/cube")
        everything = read_parquet_dir(spark, f"{scratch}/export")
        for name in DASHBOARD_SQL:
            assert rows(cube.dashboard_from_cube(spark, f"{scratch}/cube", name)) == rows(dashboard_query(spark, everything, name))
    assert cube.updates(spark, f"{scratch}/cube") == [0, 1, 2]


def test_only_new_files_are_read(spark, scratch, routed, event_log):
    export(routed, scratch, 0)
    first = cube.update_cube(spark, f"{scratch}/export", f"{scratch}/cube")
    assert first and all("lot=0" in f for f in first)
    for path in first:  # from here on nobody can read the first lot
        with open(path.replace("file:", ""), "r+b") as fh:
            fh.truncate(4)
    export(routed, scratch, 1)
    second = cube.update_cube(spark, f"{scratch}/export", f"{scratch}/cube")
    assert second and all("lot=1" in f for f in second)
    assert cube.update_cube(spark, f"{scratch}/export", f"{scratch}/cube") == []
    assert sum(r.n for r in cube.dashboard_from_cube(spark, f"{scratch}/cube", "tickets_by_team").collect()) == 2000


def test_an_update_that_died_counts_once(spark, scratch, routed, monkeypatch):
    export(routed, scratch, 0)
    real, calls = spark.range, []

    def dies(*args, **kwargs):
        calls.append(args)
        if len(calls) == 2:  # the counts and the file names are written, the log entry is not
            raise RuntimeError("driver died")
        return real(*args, **kwargs)

    monkeypatch.setattr(type(spark), "range", lambda self, *a, **k: dies(*a, **k))
    with pytest.raises(RuntimeError):
        cube.update_cube(spark, f"{scratch}/export", f"{scratch}/cube")
    monkeypatch.undo()
    assert cube.updates(spark, f"{scratch}/cube") == [] and cube.read_cube(spark, f"{scratch}/cube").count() == 0
    export(routed, scratch, 1)
    cube.update_cube(spark, f"{scratch}/export", f"{scratch}/cube")
    assert sum(r.n for r in cube.dashboard_from_cube(spark, f"{scratch}/cube", "tickets_by_priority").collect()) == 2000


def test_dual_mode_exports(spark, sf001, scratch):
    """Files that a stream adds to one folder, committed in its log."""
    for _ in range(2):
        publish_tickets(fx.tickets(spark, sf001), log_path=f"{scratch}/log")
        run_export(read_message_log(spark, f"{scratch}/log"), f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck", available_now=True)
        cube.update_cube(spark, f"{scratch}/p", f"{scratch}/cube")
    assert sum(r.n for r in cube.dashboard_from_cube(spark, f"{scratch}/cube", "tickets_by_team").collect()) == 2000


def test_nothing_exported_yet(spark, scratch, routed):
    write_parquet(routed.where("false"), f"{scratch}/export")
    cube.update_cube(spark, f"{scratch}/export", f"{scratch}/cube")
    assert cube.dashboard_from_cube(spark, f"{scratch}/cube", "team_day").collect() == []
