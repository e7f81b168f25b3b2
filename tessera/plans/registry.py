"""Driver queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the driver tables (the ticket tables are derived from the whole
``events`` table), so its work grows with them. Queries that exercise a sink
or a stream write to a fresh folder under the shared folder
(``spark.checkpoint.dir``) and return the read-back rows, lazily.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import layout, metrics, quality
from tessera.operators.incremental import DistinctStore
from tessera.operators.transform import enrich_messages, parse_messages
from tessera.plans import fixtures as fx
from tessera.plans.analyse import analyse, csv_ready
from tessera.plans.cube import dashboard_from_cube, update_cube
from tessera.plans.dashboard import DASHBOARD_SQL, dashboard_over_table, dashboard_query
from tessera.plans.loads import load_columnar, load_relational
from tessera.schemas import ENRICHED_FIELDS, ENRICHED_SCHEMA, MESSAGE_FIELDS, PRIORITIES
from tessera.session import scratch_path
from tessera.sinks import files as file_sinks
from tessera.sinks.tables import append_columnar, replace_table
from tessera.sources.files import footer_row_count, json_rejects, list_data_files, load_exports, read_json_dir, read_parquet_dir
from tessera.sources.jdbc import read_table as read_loaded_table
from tessera.sources.kafka import read_message_log, read_message_text_log
from tessera.streaming.control import stop_all
from tessera.streaming.export import enriched_stream, run_export, start_export
from tessera.streaming.progress import read_progress, recorded_progress, rows_by_query
from tessera.streaming.publish import publish_tickets
from tessera.streaming.replay import run_replay


# --- parsing and routing -------------------------------------------------------------


def q_parse_messages(spark: SparkSession, sf: str) -> DataFrame:
    """P12 -> P1, P2, P4: tickets encoded as JSON bytes and parsed back."""
    return parse_messages(fx.messages(spark, sf))


def q_route_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """P5-P7 on parsed messages."""
    return enrich_messages(fx.messages(spark, sf))


# --- distributions -------------------------------------------------------------------


def q_tickets_by_priority(spark, sf):
    return metrics.tickets_by_priority(fx.routed_tickets(spark, sf))


def q_tickets_by_request_type(spark, sf):
    return metrics.tickets_by_request_type(fx.routed_tickets(spark, sf))


def q_tickets_by_team(spark, sf):
    """The minimum slice end to end: encode, parse, route, count per team."""
    return metrics.tickets_by_team(enrich_messages(fx.messages(spark, sf)))


def q_team_priority_crosstab(spark, sf):
    return metrics.crosstab(fx.routed_tickets(spark, sf))


def q_team_priority_long(spark, sf):
    return metrics.crosstab_long(fx.routed_tickets(spark, sf))


def q_tickets_by_day(spark, sf):
    return metrics.tickets_per_day(fx.routed_tickets(spark, sf), mode="lenient")


def q_tickets_by_day_skip(spark, sf):
    """A5 in the all-or-nothing mode; every time parses, so the series is there."""
    return metrics.tickets_per_day(fx.routed_tickets(spark, sf), mode="skip")


def q_tickets_by_day_formats(spark, sf):
    """P9, A5 as the original converts: the series of tables that write the
    time in one other form each, read by the form of their first value."""
    days = [metrics.tickets_per_day(fx.tickets_in_form(spark, sf, form), mode="skip").select(F.lit(form).alias("form"), "day", "n") for form in fx.TIME_FORMS]
    return layout.union_by_name(days)


def q_tickets_by_day_bad_dates(spark, sf):
    """A5, lenient: unparseable time text is left out of the series."""
    return metrics.tickets_per_day(fx.tickets_with_bad_dates(spark, sf), mode="lenient")


def q_rejected_dates(spark, sf):
    """The count of time texts the lenient mode leaves out."""
    return metrics.date_rejects(fx.tickets_with_bad_dates(spark, sf))


def q_team_priority_fixed(spark, sf):
    """A4 with the fixed priority domain: a stable output schema, one pass."""
    return metrics.crosstab(fx.routed_tickets(spark, sf), values=PRIORITIES)


def q_distribution_summary(spark, sf):
    return metrics.distribution_summary(fx.routed_tickets(spark, sf))


def q_row_and_file_counts(spark, sf):
    """A6 + A7 over a folder with one file per event type (no type and the
    empty one share theirs) and one without rows; the rows are counted from
    the files' footers."""
    path = scratch_path(spark, "row_and_file_counts")
    events = fx.read_table(spark, sf, "events")
    # a digest names a type's folder, as a type may be longer than a file name
    typed = events.withColumn("type_digest", F.sha2(F.coalesce("event_type", F.lit("")), 256))
    typed.repartition("type_digest").write.option("maxRecordsPerFile", 0).partitionBy("type_digest").parquet(path)
    events.where("false").coalesce(1).write.mode("append").parquet(path)
    return metrics.row_and_file_counts(footer_row_count(spark, path, events.schema), list_data_files(spark, path, "*.parquet"))


def q_preview_first(spark, sf):
    return metrics.preview(fx.routed_tickets(spark, sf), 5, order_by="ticket_id")


# --- cleaning (dirty fixture) ------------------------------------------------------


def q_distinct_rows(spark, sf):
    return quality.distinct_rows(fx.dirty_tickets(spark, sf))


def q_null_profile(spark, sf):
    return quality.null_profile(fx.dirty_tickets(spark, sf))


def q_null_columns_affected(spark, sf):
    return quality.affected_columns(quality.null_profile(fx.dirty_tickets(spark, sf)))


def q_clean_tickets(spark, sf):
    return quality.clean_for_analysis(fx.dirty_tickets(spark, sf))


def q_clean_for_warehouse(spark, sf):
    return layout.sort_for_storage(quality.clean_for_warehouse(fx.dirty_tickets(spark, sf)))


def q_cleaning_audit(spark, sf):
    return quality.cleaning_audit(fx.dirty_tickets(spark, sf))


def q_contract_violations(spark, sf):
    return quality.contract_violations(fx.dirty_tickets(spark, sf))


# --- union, files ----------------------------------------------------------------------


def q_union_part_files(spark, sf):
    """An enriched export and a raw-message export (fewer columns, other
    order) combined by name; the raw part has no team."""
    routed = fx.routed_tickets(spark, sf)
    raw = fx.tickets(spark, sf).select(*reversed(MESSAGE_FIELDS))
    return layout.union_by_name([routed, raw])


def q_union_mixed_types(spark, sf):
    """One export folder in which the client is text in some files and
    a number in others, and the creation time text, a time or not there."""
    path = scratch_path(spark, "union_mixed_types")
    routed = fx.routed_tickets(spark, sf)
    number = F.substring("client_id", 2, 20)
    file_sinks.write_parquet(routed, f"{path}/text")
    file_sinks.write_parquet(routed.withColumn("client_id", number.cast("bigint")).withColumn("created_at", F.col("created_at").cast("timestamp_ntz")), f"{path}/typed")
    file_sinks.write_parquet(routed.withColumn("client_id", number.cast("int")).drop("created_at"), f"{path}/narrow")
    return read_parquet_dir(spark, path).select(*ENRICHED_FIELDS)


def q_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet_roundtrip")
    file_sinks.write_parquet(fx.routed_tickets(spark, sf), path)
    return read_parquet_dir(spark, path).select(*ENRICHED_FIELDS)


def q_json_roundtrip(spark, sf):
    path = scratch_path(spark, "json_roundtrip")
    file_sinks.write_json(fx.routed_tickets(spark, sf), path)
    return read_json_dir(spark, path)


def q_csv_roundtrip(spark, sf):
    """K4: cleaned rows, times rewritten as the export does, through CSV and back."""
    path = scratch_path(spark, "csv_roundtrip")
    clean = quality.clean_for_analysis(fx.dirty_tickets(spark, sf))
    file_sinks.write_csv(csv_ready(clean, "lenient"), path)
    return file_sinks.read_csv(spark, path, ENRICHED_SCHEMA)


def q_csv_subsecond(spark, sf):
    """K4: times with their fractions, through CSV and back."""
    path = scratch_path(spark, "csv_subsecond")
    file_sinks.write_csv(csv_ready(fx.subsecond_tickets(spark, sf), "lenient"), path)
    return file_sinks.read_csv(spark, path, ENRICHED_SCHEMA)


def q_rejected_json_lines(spark, sf):
    """JSON Lines with every 41st line cut off; how many are no object."""
    path = scratch_path(spark, "rejected_json_lines")
    events = fx.read_table(spark, sf, "events")
    rows = fx.tickets_from_events(events, keep=["event_id"])
    line = F.to_json(F.struct(*MESSAGE_FIELDS))
    cut = F.when(F.col("event_id") % 41 == 0, F.expr("substring(line, 1, 20)")).otherwise(F.col("line"))
    rows.withColumn("line", line).select(cut.alias("value")).write.text(path)
    return json_rejects(spark, path)


def q_format_fallback(spark, sf):
    """No Parquet export present, so the JSON export is read."""
    root = scratch_path(spark, "format_fallback")
    file_sinks.write_json(fx.routed_tickets(spark, sf), f"{root}/json")
    return load_exports(spark, f"{root}/parquet", f"{root}/json")


# --- streaming ---------------------------------------------------------------------------


def _published_log(spark, sf, root):
    log = f"{root}/log"
    publish_tickets(fx.tickets(spark, sf), log_path=log)  # J6 on files
    return log


def _stream_dual(spark, sf, name):
    root = scratch_path(spark, name)
    log = _published_log(spark, sf, root)
    run_export(read_message_log(spark, log), f"{root}/parquet", f"{root}/json", f"{root}/ckpt", mode="dual", available_now=True)
    return root


def q_stream_parquet(spark, sf):
    root = _stream_dual(spark, sf, "stream_parquet")
    return read_parquet_dir(spark, f"{root}/parquet").select(*ENRICHED_FIELDS)


def q_stream_json(spark, sf):
    root = _stream_dual(spark, sf, "stream_json")
    return read_json_dir(spark, f"{root}/json")


def q_stream_fanout(spark, sf):
    """K3: one read per micro-batch, both formats, idempotent per batch."""
    root = scratch_path(spark, "stream_fanout")
    log = _published_log(spark, sf, root)
    run_export(read_message_log(spark, log), f"{root}/parquet", f"{root}/json", f"{root}/ckpt", mode="foreach_batch", available_now=True)
    parquet = read_parquet_dir(spark, f"{root}/parquet").select(F.lit("parquet").alias("format"), *ENRICHED_FIELDS)
    json = read_json_dir(spark, f"{root}/json").select(F.lit("json").alias("format"), *ENRICHED_FIELDS)
    return parquet.unionByName(json)


def q_stream_restart(spark, sf):
    """Run, restart with nothing new (adds nothing), then the producer
    publishes every ticket again and a third run picks up only those."""
    root = scratch_path(spark, "stream_restart")
    log = _published_log(spark, sf, root)
    args = (f"{root}/parquet", f"{root}/json", f"{root}/ckpt")
    run_export(read_message_log(spark, log), *args, mode="dual", available_now=True)
    run_export(read_message_log(spark, log), *args, mode="dual", available_now=True)
    publish_tickets(fx.tickets(spark, sf), log_path=log)
    run_export(read_message_log(spark, log), *args, mode="dual", available_now=True)
    return read_parquet_dir(spark, f"{root}/parquet").select(*ENRICHED_FIELDS)


def q_stream_from_now(spark, sf):
    """What is on the log at the first start stays unread, what comes later
    is exported by the restart, in both formats."""
    root = scratch_path(spark, "stream_from_now")
    log = _published_log(spark, sf, root)
    args = (f"{root}/parquet", f"{root}/json", f"{root}/ckpt")
    run_export(read_message_log(spark, log), *args, mode="dual", available_now=True, starting="latest")
    publish_tickets(fx.tickets(spark, sf), log_path=log)
    run_export(read_message_log(spark, log), *args, mode="dual", available_now=True, starting="latest")
    parquet = read_parquet_dir(spark, f"{root}/parquet").select(F.lit("parquet").alias("format"), *ENRICHED_FIELDS)
    return parquet.unionByName(read_json_dir(spark, f"{root}/json").select(F.lit("json").alias("format"), *ENRICHED_FIELDS))


def q_stream_progress(spark, sf):
    """A long-running export (processing-time trigger) and the input
    rows that its progress table has for each of its two queries."""
    root = scratch_path(spark, "stream_progress")
    log = _published_log(spark, sf, root)
    with recorded_progress(spark, f"{root}/progress") as progress:
        enriched = enriched_stream(read_message_log(spark, log))
        queries = start_export(enriched, f"{root}/parquet", f"{root}/json", f"{root}/ckpt", trigger="1 second", name=f"progress_{root[-12:]}")
        progress.watch(queries)
        try:
            for query in queries:
                query.processAllAvailable()
        finally:
            stop_all(queries)
    by_query = rows_by_query(read_progress(spark, f"{root}/progress"))
    return by_query.select(F.regexp_extract("name", "_([a-z]+)$", 1).alias("format"), "input_rows", F.col("error").isNotNull().alias("failed"))


def _fanned_out(spark, sf, root, exports):
    """Every ticket exported ``exports`` times, each time by a new export job
    with a checkpoint of its own into the same folders."""
    log = _published_log(spark, sf, root)
    for i in range(exports):
        run_export(read_message_log(spark, log), f"{root}/parquet", f"{root}/json", f"{root}/ckpt{i}", mode="foreach_batch", available_now=True)


def q_fanout_new_checkpoint(spark, sf):
    """K3: an export with a new checkpoint adds to the older output."""
    root = scratch_path(spark, "fanout_new_checkpoint")
    _fanned_out(spark, sf, root, 2)
    return read_parquet_dir(spark, f"{root}/parquet").withColumn("format", F.lit("parquet")).unionByName(read_json_dir(spark, f"{root}/json").withColumn("format", F.lit("json")))


def q_load_after_fanout(spark, sf):
    """J4 over an export that holds every ticket twice: each is loaded once,
    with the export's columns and no other."""
    root = scratch_path(spark, "load_after_fanout")
    _fanned_out(spark, sf, root, 2)
    load_columnar(spark, f"{root}/parquet", path=f"{root}/table")
    return spark.read.parquet(f"{root}/table")


def q_relational_after_fanout(spark, sf):
    """J3 over a fan-out export: its rows and columns as they are."""
    root = scratch_path(spark, "relational_after_fanout")
    _fanned_out(spark, sf, root, 1)
    load_relational(spark, f"{root}/parquet", path=f"{root}/table")
    return spark.read.parquet(f"{root}/table")


def q_analyse_after_fanout(spark, sf):
    """J2 over the JSON files of an export that holds every ticket twice."""
    root = scratch_path(spark, "analyse_after_fanout")
    _fanned_out(spark, sf, root, 2)
    result = analyse(spark, f"{root}/no-parquet", f"{root}/json", f"{root}/out")
    return spark.read.parquet(result.paths["clean_rows"])


def q_stream_text_log(spark, sf):
    """J1 from a folder of JSON-lines message files instead of a byte log."""
    root = scratch_path(spark, "stream_text_log")
    messages = fx.tickets(spark, sf).select(F.to_json(F.struct(*MESSAGE_FIELDS)).alias("value"))
    messages.write.text(f"{root}/text")
    run_export(read_message_text_log(spark, f"{root}/text"), f"{root}/parquet", f"{root}/json", f"{root}/ckpt", available_now=True)
    return read_parquet_dir(spark, f"{root}/parquet").select(*ENRICHED_FIELDS)


def q_replay_strict(spark, sf):
    """The whole log from the start, strict parsing, kept as Parquet."""
    root = scratch_path(spark, "replay_strict")
    log = _published_log(spark, sf, root)
    run_replay(read_message_log(spark, log), f"{root}/ckpt", sink="parquet", path=f"{root}/out", strict=True)
    return read_parquet_dir(spark, f"{root}/out").select(*MESSAGE_FIELDS)


# --- loads -------------------------------------------------------------------------------


def _exported_dirty(spark, sf, root):
    export = f"{root}/export"
    file_sinks.write_parquet(fx.dirty_tickets(spark, sf), export)
    return export


def q_relational_replace(spark, sf):
    """Uncleaned rows; the second run replaces the first."""
    root = scratch_path(spark, "relational_replace")
    export = _exported_dirty(spark, sf, root)
    load_relational(spark, export, path=f"{root}/table")
    load_relational(spark, export, path=f"{root}/table")
    return read_parquet_dir(spark, f"{root}/table").select(*ENRICHED_FIELDS)


def q_relational_replace_failed(spark, sf):
    """K6: a replacement that fails while it writes leaves the old rows, in a
    folder and in a catalog table."""
    root = scratch_path(spark, "relational_replace_failed")
    export = _exported_dirty(spark, sf, root)
    table = f"replace_failed_{root[-12:]}"
    load_relational(spark, export, path=f"{root}/table")
    load_relational(spark, export, path=f"{root}/catalog", table=table, catalog=True)
    broken = fx.routed_tickets(spark, sf).withColumn("request", F.when(F.col("ticket_id").endswith("7"), F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("request")))
    for target in ({"path": f"{root}/table"}, {"path": f"{root}/catalog", "table": table, "catalog": True}):
        try:
            replace_table(broken, **target)
        except Exception as exc:
            if "broken row" not in str(exc):
                raise
        else:
            raise AssertionError("the load was to fail")
    folder = read_loaded_table(spark, path=f"{root}/table").withColumn("target", F.lit("folder"))
    return folder.unionByName(read_loaded_table(spark, table=table, catalog=True).withColumn("target", F.lit("catalog")))


def q_columnar_catalog_append(spark, sf):
    """A catalog table made by the first load and kept by the others.
    Another load id adds rows, the same one takes the place of its first try."""
    root = scratch_path(spark, "columnar_catalog_append")
    export = _exported_dirty(spark, sf, root)
    table = f"columnar_{root[-12:]}"
    for load_id in ("monday", "tuesday", "tuesday"):
        load_columnar(spark, export, path=f"{root}/table", table=table, catalog=True, load_id=load_id)
    return spark.table(table)


def q_columnar_rerun(spark, sf):
    """J4 on a folder: a load that died half-way and ran again equals one load."""
    root = scratch_path(spark, "columnar_rerun")
    export = _exported_dirty(spark, sf, root)
    broken = fx.routed_tickets(spark, sf).withColumn("request", F.when(F.col("ticket_id").endswith("7"), F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("request")))
    try:
        append_columnar(broken, path=f"{root}/table", load_id="monday")
    except Exception as exc:
        if "broken row" not in str(exc):
            raise
    for load_id in ("monday", "monday", "tuesday"):
        load_columnar(spark, export, path=f"{root}/table", load_id=load_id)
    return read_loaded_table(spark, path=f"{root}/table")


def q_distinct_incremental(spark, sf):
    """C2 on a growing export: three batches, each compared with the stored
    keys of the others; the second is run twice."""
    root = scratch_path(spark, "distinct_incremental")
    store = DistinctStore(spark, root, f"distinct_{root[-12:]}", buckets=8)
    dirty = fx.dirty_tickets(spark, sf)
    for batch_id, batch in (("a", dirty), ("b", dirty.unionByName(fx.routed_tickets(spark, sf))), ("b", dirty.unionByName(fx.routed_tickets(spark, sf))), ("c", dirty)):
        store.add(batch, batch_id)
    return store.rows(ENRICHED_FIELDS)


def q_columnar_append(spark, sf):
    """Cleaned rows; the second run appends them again."""
    root = scratch_path(spark, "columnar_append")
    export = _exported_dirty(spark, sf, root)
    load_columnar(spark, export, path=f"{root}/table")
    load_columnar(spark, export, path=f"{root}/table")
    return read_parquet_dir(spark, f"{root}/table").select(*ENRICHED_FIELDS)


def q_sorted_table_range(spark, sf):
    """O5 then a range filter on the sort column, pushed to the Parquet scan."""
    root = scratch_path(spark, "sorted_table_range")
    export = _exported_dirty(spark, sf, root)
    load_columnar(spark, export, path=f"{root}/table")
    table = read_parquet_dir(spark, f"{root}/table")
    return table.where((F.col("created_at") >= "2024-01-10") & (F.col("created_at") < "2024-01-12")).select(*ENRICHED_FIELDS)


# --- the analysis job (J2) ------------------------------------------------------------


def _analysed(spark, sf, name):
    root = scratch_path(spark, name)
    export = _exported_dirty(spark, sf, root)
    return analyse(spark, export, f"{root}/json", f"{root}/out", date_mode="lenient", priorities=["critical", *sorted(PRIORITIES)])


def q_analyse_csv(spark, sf):
    """J2 end to end; the cleaned CSV export read back."""
    result = _analysed(spark, sf, "analyse_csv")
    return file_sinks.read_csv(spark, result.paths["csv"], ENRICHED_SCHEMA)


def q_analyse_columns(spark, sf):
    """The columns that J2 reports, in their order."""
    columns = _analysed(spark, sf, "analyse_columns").columns
    return spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("position", "column_name"))


def q_analyse_by_day(spark, sf):
    """J2 end to end; the daily chart table read back."""
    return spark.read.parquet(_analysed(spark, sf, "analyse_by_day").paths["by_day"])


def q_analyse_team_priority(spark, sf):
    """J2 end to end; the team x priority chart table of the given priorities
    (the unknown ``critical`` included) read back."""
    return spark.read.parquet(_analysed(spark, sf, "analyse_team_priority").paths["team_priority"])


def q_analyse_team_priority_long(spark, sf):
    """J2 end to end; the team and priority counts in long form read back."""
    return spark.read.parquet(_analysed(spark, sf, "analyse_team_priority_long").paths["team_priority_long"])


def q_analyse_by_priority(spark, sf):
    """J2 end to end; the priority chart table read back."""
    return spark.read.parquet(_analysed(spark, sf, "analyse_by_priority").paths["by_priority"])


def q_any_nulls(spark, sf):
    """C4 on the dirty and on the cleaned rows, in one small table."""
    dirty = fx.dirty_tickets(spark, sf)
    some = lambda df: quality.affected_columns(quality.null_profile(df)).agg((F.count(F.lit(1)) > 0).alias("any_nulls"))
    return some(dirty).withColumn("rows", F.lit("loaded")).unionByName(some(quality.clean_for_analysis(dirty)).withColumn("rows", F.lit("clean")))


def q_load_guards(spark, sf):
    """What J3 wrote for a full export, one without rows and one
    without the key column (rows, or null where a guard stopped the load)."""
    root = scratch_path(spark, "load_guards")
    tickets = fx.routed_tickets(spark, sf)
    cases = {"full": tickets, "no_rows": tickets.where("false"), "no_key": tickets.drop("ticket_id")}
    for name, df in cases.items():
        file_sinks.write_parquet(df, f"{root}/{name}")
    rows = {name: load_relational(spark, f"{root}/{name}", path=f"{root}/table_{name}").rows for name in cases}
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("load"), F.lit(v).cast("long").alias("rows")) for k, v in rows.items()])))


# --- SQL and reports -----------------------------------------------------------------


def q_dashboard_sql(spark, sf):
    return dashboard_query(spark, fx.routed_tickets(spark, sf), "team_day")


def _dashboard(name):
    def run(spark, sf):
        root = scratch_path(spark, f"dashboard_{name}")
        file_sinks.write_parquet(fx.routed_tickets(spark, sf), f"{root}/export")
        load_relational(spark, f"{root}/export", path=f"{root}/table")
        return dashboard_over_table(spark, read_loaded_table(spark, path=f"{root}/table"), name)  # S8

    run.__name__, run.__doc__ = f"q_dashboard_{name}", f"J7: the {name} statement over the table that J3 loaded."
    return run


def q_dashboard_incremental(spark, sf):
    """J7 from counts that grow with the exports: three exports into the same
    folders, each counted once when it has come."""
    root = scratch_path(spark, "dashboard_incremental")
    log = _published_log(spark, sf, root)
    for i in range(3):
        run_export(read_message_log(spark, log), f"{root}/parquet", f"{root}/json", f"{root}/ckpt{i}", mode="foreach_batch", available_now=True)
        update_cube(spark, f"{root}/parquet", f"{root}/cube")
    return dashboard_from_cube(spark, f"{root}/cube", "team_day")


def q_summary_text(spark, sf):
    """K5: the text summary written and read back (lines; order is checked in tests)."""
    path = scratch_path(spark, "summary_text")
    file_sinks.write_summary_text(metrics.distribution_summary(fx.routed_tickets(spark, sf)), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


QUERIES = {
    "parse_messages": q_parse_messages,
    "route_tickets": q_route_tickets,
    "tickets_by_priority": q_tickets_by_priority,
    "tickets_by_request_type": q_tickets_by_request_type,
    "tickets_by_team": q_tickets_by_team,
    "team_priority_crosstab": q_team_priority_crosstab,
    "team_priority_long": q_team_priority_long,
    "tickets_by_day": q_tickets_by_day,
    "tickets_by_day_skip": q_tickets_by_day_skip,
    "tickets_by_day_bad_dates": q_tickets_by_day_bad_dates,
    "rejected_dates": q_rejected_dates,
    "team_priority_fixed": q_team_priority_fixed,
    "distribution_summary": q_distribution_summary,
    "row_and_file_counts": q_row_and_file_counts,
    "preview_first": q_preview_first,
    "distinct_rows": q_distinct_rows,
    "null_profile": q_null_profile,
    "null_columns_affected": q_null_columns_affected,
    "clean_tickets": q_clean_tickets,
    "clean_for_warehouse": q_clean_for_warehouse,
    "cleaning_audit": q_cleaning_audit,
    "contract_violations": q_contract_violations,
    "union_part_files": q_union_part_files,
    "parquet_roundtrip": q_parquet_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "format_fallback": q_format_fallback,
    "stream_parquet": q_stream_parquet,
    "stream_json": q_stream_json,
    "stream_fanout": q_stream_fanout,
    "stream_restart": q_stream_restart,
    "stream_text_log": q_stream_text_log,
    "replay_strict": q_replay_strict,
    "relational_replace": q_relational_replace,
    "columnar_append": q_columnar_append,
    "sorted_table_range": q_sorted_table_range,
    "analyse_csv": q_analyse_csv,
    "analyse_by_day": q_analyse_by_day,
    "analyse_team_priority": q_analyse_team_priority,
    "dashboard_sql": q_dashboard_sql,
    "summary_text": q_summary_text,
    "csv_subsecond": q_csv_subsecond,
    "rejected_json_lines": q_rejected_json_lines,
    "fanout_new_checkpoint": q_fanout_new_checkpoint,
    "load_after_fanout": q_load_after_fanout,
    "relational_after_fanout": q_relational_after_fanout,
    "analyse_after_fanout": q_analyse_after_fanout,
    "analyse_team_priority_long": q_analyse_team_priority_long,
    "analyse_by_priority": q_analyse_by_priority,
    "any_nulls": q_any_nulls,
    "load_guards": q_load_guards,
    "tickets_by_day_formats": q_tickets_by_day_formats,
    "union_mixed_types": q_union_mixed_types,
    "stream_from_now": q_stream_from_now,
    "stream_progress": q_stream_progress,
    "relational_replace_failed": q_relational_replace_failed,
    "columnar_catalog_append": q_columnar_catalog_append,
    "columnar_rerun": q_columnar_rerun,
    "distinct_incremental": q_distinct_incremental,
    "dashboard_incremental": q_dashboard_incremental,
    "analyse_columns": q_analyse_columns,
    **{f"dashboard_{name}": _dashboard(name) for name in DASHBOARD_SQL},
}
