"""DuckDB SQL computing, from the raw driver tables, what each registered
query must return. Shared table expressions build the same derived tickets as
``plans.fixtures`` does in Spark; every column is aliased to the Spark name.
"""

from __future__ import annotations

_T0 = """t0 AS (
    SELECT event_id AS _eid,
           printf('T%010d', event_id) AS ticket_id,
           printf('C%05d', user_id) AS client_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_at,
           props AS request,
           CASE event_type WHEN 'click' THEN 'support' WHEN 'view' THEN 'facturation'
                           WHEN 'purchase' THEN 'technique' WHEN 'error' THEN 'commercial'
                           ELSE event_type END AS request_type,
           CASE WHEN value < 5 THEN 'low' WHEN value < 20 THEN 'medium'
                WHEN value < 60 THEN 'high' ELSE 'urgent' END AS priority
    FROM events)"""

_TEAM = """CASE request_type WHEN 'support' THEN 'Equipe Support'
                         WHEN 'facturation' THEN 'Equipe Facturation'
                         WHEN 'technique' THEN 'Equipe Technique'
                         WHEN 'commercial' THEN 'Equipe Commerciale'
                         ELSE 'Equipe Générique' END"""

_MSG = "ticket_id, client_id, created_at, request, request_type, priority"
_ALL = _MSG + ", assigned_team"

_TICKETS = f"""{_T0},
tickets AS (SELECT {_MSG} FROM t0),
routed AS (SELECT {_MSG}, {_TEAM} AS assigned_team FROM tickets)"""

_DIRTY = f"""{_T0},
d1 AS (
    SELECT _eid,
           CASE WHEN _eid % 101 = 0 THEN NULL ELSE ticket_id END AS ticket_id,
           CASE WHEN _eid % 101 = 0 THEN NULL ELSE client_id END AS client_id,
           CASE WHEN _eid % 101 = 0 THEN NULL ELSE created_at END AS created_at,
           CASE WHEN _eid % 101 = 0 OR _eid % 23 = 0 THEN NULL
                WHEN _eid % 29 = 0 AND request IS NOT NULL THEN '' ELSE request END AS request,
           CASE WHEN _eid % 101 = 0 THEN NULL ELSE request_type END AS request_type,
           CASE WHEN _eid % 101 = 0 OR _eid % 17 = 0 THEN NULL
                WHEN _eid % 31 = 0 AND priority IS NOT NULL THEN 'critical' ELSE priority END AS priority
    FROM t0),
d2 AS (SELECT _eid, {_MSG}, {_TEAM} AS assigned_team FROM d1),
d3 AS (SELECT {_ALL}, UNNEST(CASE WHEN _eid % 10 = 0 THEN [1, 2] ELSE [1] END) AS _copy FROM d2),
dirty AS (SELECT {_ALL} FROM d3),
distinct_dirty AS (SELECT DISTINCT {_ALL} FROM dirty),
clean AS (
    SELECT {_ALL} FROM distinct_dirty
    WHERE ticket_id IS NOT NULL AND client_id IS NOT NULL AND created_at IS NOT NULL
      AND request IS NOT NULL AND request_type IS NOT NULL AND priority IS NOT NULL
      AND assigned_team IS NOT NULL)"""


_BAD_DATES = f"""{_T0},
bad_dates AS (
    SELECT ticket_id, client_id,
           CASE WHEN _eid % 37 = 0 THEN 'bad-date' ELSE created_at END AS created_at,
           request, request_type, priority, {_TEAM} AS assigned_team
    FROM t0)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _null_rows(source: str) -> str:
    cols = _ALL.split(", ")
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM {source}" for c in cols
    )


_RULES = [(f"{c}_present", f"{c} IS NULL") for c in _MSG.split(", ")] + [
    ("request_type_in_domain", "NOT coalesce(request_type IN ('support', 'facturation', 'technique', 'commercial'), false)"),
    ("priority_in_domain", "NOT coalesce(priority IN ('low', 'medium', 'high', 'urgent'), false)"),
]

_DAY = "CAST(TRY_CAST(created_at AS TIMESTAMP) AS DATE)"

_SUMMARY_LINES = f"""summary AS (
    SELECT 0 AS section, priority AS value, count(*) AS n FROM routed WHERE priority IS NOT NULL GROUP BY priority
    UNION ALL
    SELECT 1, request_type, count(*) FROM routed WHERE request_type IS NOT NULL GROUP BY request_type
    UNION ALL
    SELECT 2, assigned_team, count(*) FROM routed WHERE assigned_team IS NOT NULL GROUP BY assigned_team)"""

_SUBSECOND = f"""SELECT printf('T%010d', event_id) AS ticket_id, printf('C%05d', user_id) AS client_id,
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS created_at,
       request, request_type, priority, {_TEAM} AS assigned_team
FROM t0 JOIN events ON event_id = _eid"""

_DASHBOARD = {
    "tickets_by_priority": "SELECT priority, count(*) AS n FROM routed WHERE priority IS NOT NULL GROUP BY 1",
    "tickets_by_request_type": "SELECT request_type, count(*) AS n FROM routed WHERE request_type IS NOT NULL GROUP BY 1",
    "tickets_by_team": "SELECT assigned_team, count(*) AS n FROM routed WHERE assigned_team IS NOT NULL GROUP BY 1",
    "team_priority": "SELECT assigned_team, priority, count(*) AS n FROM routed WHERE assigned_team IS NOT NULL AND priority IS NOT NULL GROUP BY 1, 2",
    "team_day": f"SELECT assigned_team, {_DAY} AS day, count(*) AS n FROM routed WHERE assigned_team IS NOT NULL AND {_DAY} IS NOT NULL GROUP BY 1, 2",
}

_FORMS = ("slashes", "compact", "month name", "day and month name", "twelve hours", "year first", "zone")

ORACLE_SQL = {
    "tickets_by_day_formats": _with(
        _TICKETS, f"SELECT f.form, {_DAY} AS day, count(*) AS n FROM routed, (VALUES {', '.join(f'({f!r})' for f in _FORMS)}) f(form) WHERE {_DAY} IS NOT NULL GROUP BY 1, 2"
    ),
    "union_mixed_types": _with(
        _TICKETS,
        """SELECT * FROM routed
UNION ALL SELECT ticket_id, CAST(CAST(client_id[2:] AS BIGINT) AS VARCHAR), replace(created_at, 'T', ' '), request, request_type, priority, assigned_team FROM routed
UNION ALL SELECT ticket_id, CAST(CAST(client_id[2:] AS BIGINT) AS VARCHAR), NULL, request, request_type, priority, assigned_team FROM routed""",
    ),
    "stream_from_now": _with(_TICKETS, "SELECT 'parquet' AS format, * FROM routed UNION ALL SELECT 'json' AS format, * FROM routed"),
    "stream_progress": "SELECT f.format, count(*) AS input_rows, false AS failed FROM events, (VALUES ('parquet'), ('json')) f(format) GROUP BY 1",
    "relational_replace_failed": _with(_DIRTY, "SELECT dirty.*, t.target FROM dirty, (VALUES ('folder'), ('catalog')) t(target)"),
    "columnar_catalog_append": _with(_DIRTY, "SELECT clean.*, l.load_id FROM clean, (VALUES ('monday'), ('tuesday')) l(load_id)"),
    "columnar_rerun": _with(_DIRTY, "SELECT * FROM clean UNION ALL SELECT * FROM clean"),
    "distinct_incremental": _with(_DIRTY + f",\nrouted AS (SELECT {_MSG}, {_TEAM} AS assigned_team FROM t0)", f"SELECT {_ALL} FROM dirty UNION SELECT {_ALL} FROM routed"),
    "dashboard_incremental": _with(_TICKETS, f"SELECT assigned_team, {_DAY} AS day, 3 * count(*) AS n FROM routed WHERE assigned_team IS NOT NULL AND {_DAY} IS NOT NULL GROUP BY 1, 2"),
    "analyse_columns": f"SELECT unnest(range(7))::INTEGER AS position, unnest({_ALL.split(', ')!r}) AS column_name",
    "csv_subsecond": _with(_T0, _SUBSECOND),
    "rejected_json_lines": "SELECT count(*) AS lines, count(*) FILTER (WHERE event_id % 41 = 0) AS rejected FROM events",
    "fanout_new_checkpoint": _with(
        _TICKETS,
        """SELECT f.format, routed.* FROM routed, (VALUES ('parquet'), ('parquet'), ('json'), ('json')) f(format)""",
    ),
    "load_after_fanout": _with(_TICKETS, f"SELECT DISTINCT * FROM routed WHERE {' AND '.join(c + ' IS NOT NULL' for c in _ALL.split(', '))}"),
    "relational_after_fanout": _with(_TICKETS, "SELECT * FROM routed"),
    "analyse_after_fanout": _with(_TICKETS, f"SELECT DISTINCT * FROM routed WHERE {' AND '.join(c + ' IS NOT NULL' for c in _ALL.split(', '))}"),
    "analyse_team_priority_long": _with(_DIRTY, "SELECT assigned_team, priority, count(*) AS n FROM clean GROUP BY 1, 2"),
    "analyse_by_priority": _with(_DIRTY, "SELECT priority, count(*) AS n FROM clean GROUP BY 1"),
    "any_nulls": _with(
        _DIRTY + f",\nprofile AS ({_null_rows('distinct_dirty')}),\ncleaned AS ({_null_rows('clean')})",
        "SELECT 'loaded' AS rows, count(*) > 0 AS any_nulls FROM profile WHERE nulls > 0 UNION ALL SELECT 'clean', count(*) > 0 FROM cleaned WHERE nulls > 0",
    ),
    "load_guards": "SELECT 'full' AS load, CASE WHEN count(*) > 0 THEN count(*) END AS rows FROM events UNION ALL SELECT 'no_rows', NULL UNION ALL SELECT 'no_key', NULL",
    **{f"dashboard_{name}": _with(_TICKETS, sql) for name, sql in _DASHBOARD.items()},
    "parse_messages": _with(_TICKETS, "SELECT * FROM tickets"),
    "route_tickets": _with(_TICKETS, "SELECT * FROM routed"),
    "tickets_by_priority": _with(
        _TICKETS, "SELECT priority, count(*) AS n FROM routed WHERE priority IS NOT NULL GROUP BY priority"
    ),
    "tickets_by_request_type": _with(
        _TICKETS, "SELECT request_type, count(*) AS n FROM routed WHERE request_type IS NOT NULL GROUP BY request_type"
    ),
    "tickets_by_team": _with(
        _TICKETS, "SELECT assigned_team, count(*) AS n FROM routed WHERE assigned_team IS NOT NULL GROUP BY assigned_team"
    ),
    "team_priority_crosstab": _with(
        _TICKETS,
        """SELECT assigned_team,
       count(*) FILTER (WHERE priority = 'high') AS high,
       count(*) FILTER (WHERE priority = 'low') AS low,
       count(*) FILTER (WHERE priority = 'medium') AS medium,
       count(*) FILTER (WHERE priority = 'urgent') AS urgent
FROM routed WHERE assigned_team IS NOT NULL AND priority IS NOT NULL
GROUP BY assigned_team""",
    ),
    "team_priority_long": _with(
        _TICKETS,
        """SELECT assigned_team, priority, count(*) AS n FROM routed
WHERE assigned_team IS NOT NULL AND priority IS NOT NULL GROUP BY assigned_team, priority""",
    ),
    "tickets_by_day": _with(
        _TICKETS, f"SELECT {_DAY} AS day, count(*) AS n FROM routed WHERE {_DAY} IS NOT NULL GROUP BY 1"
    ),
    "tickets_by_day_skip": _with(
        _TICKETS, f"SELECT {_DAY} AS day, count(*) AS n FROM routed WHERE {_DAY} IS NOT NULL GROUP BY 1"
    ),
    "tickets_by_day_bad_dates": _with(
        _BAD_DATES, f"SELECT {_DAY} AS day, count(*) AS n FROM bad_dates WHERE {_DAY} IS NOT NULL GROUP BY 1"
    ),
    "rejected_dates": _with(
        _BAD_DATES,
        f"SELECT count(*) FILTER (WHERE created_at IS NOT NULL AND TRY_CAST(created_at AS TIMESTAMP) IS NULL) AS rejected FROM bad_dates",
    ),
    "team_priority_fixed": _with(
        _TICKETS,
        """SELECT assigned_team,
       count(*) FILTER (WHERE priority = 'low') AS low,
       count(*) FILTER (WHERE priority = 'medium') AS medium,
       count(*) FILTER (WHERE priority = 'high') AS high,
       count(*) FILTER (WHERE priority = 'urgent') AS urgent
FROM routed WHERE assigned_team IS NOT NULL AND priority IS NOT NULL
GROUP BY assigned_team""",
    ),
    "distribution_summary": _with(
        _TICKETS,
        """SELECT 'priority' AS dimension, priority AS value, count(*) AS n FROM routed WHERE priority IS NOT NULL GROUP BY priority
UNION ALL
SELECT 'request_type', request_type, count(*) FROM routed WHERE request_type IS NOT NULL GROUP BY request_type
UNION ALL
SELECT 'assigned_team', assigned_team, count(*) FROM routed WHERE assigned_team IS NOT NULL GROUP BY assigned_team""",
    ),
    "row_and_file_counts": "SELECT count(*) AS n_rows, count(DISTINCT coalesce(event_type, '')) + 1 AS n_files FROM events",
    "preview_first": _with(_TICKETS, "SELECT * FROM routed ORDER BY ticket_id LIMIT 5"),
    "distinct_rows": _with(_DIRTY, "SELECT * FROM distinct_dirty"),
    "null_profile": _with(_DIRTY, _null_rows("distinct_dirty")),
    "null_columns_affected": _with(_DIRTY + f",\nprofile AS ({_null_rows('distinct_dirty')})", "SELECT * FROM profile WHERE nulls > 0"),
    "clean_tickets": _with(_DIRTY, "SELECT * FROM clean"),
    "clean_for_warehouse": _with(_DIRTY, "SELECT * FROM clean"),
    "cleaning_audit": _with(
        _DIRTY,
        """SELECT 'loaded' AS step, count(*) AS rows FROM dirty
UNION ALL SELECT 'deduplicated', count(*) FROM distinct_dirty
UNION ALL SELECT 'complete', count(*) FROM clean""",
    ),
    "contract_violations": _with(
        _DIRTY,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS rule, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM dirty" for name, cond in _RULES
        ),
    ),
    "union_part_files": _with(
        _TICKETS,
        """SELECT * FROM routed
UNION ALL BY NAME
SELECT priority, request_type, request, created_at, client_id, ticket_id FROM tickets""",
    ),
    "parquet_roundtrip": _with(_TICKETS, "SELECT * FROM routed"),
    "json_roundtrip": _with(_TICKETS, "SELECT * FROM routed"),
    "csv_roundtrip": _with(
        _DIRTY,
        f"""SELECT ticket_id, client_id,
       coalesce(strftime(TRY_CAST(created_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), created_at) AS created_at,
       request, request_type, priority, assigned_team
FROM clean""",
    ),
    "format_fallback": _with(_TICKETS, "SELECT * FROM routed"),
    "stream_parquet": _with(_TICKETS, "SELECT * FROM routed"),
    "stream_json": _with(_TICKETS, "SELECT * FROM routed"),
    "stream_fanout": _with(
        _TICKETS, "SELECT 'parquet' AS format, * FROM routed UNION ALL SELECT 'json' AS format, * FROM routed"
    ),
    "stream_restart": _with(_TICKETS, "SELECT * FROM routed UNION ALL SELECT * FROM routed"),
    "stream_text_log": _with(_TICKETS, "SELECT * FROM routed"),
    "replay_strict": _with(_TICKETS, "SELECT * FROM tickets"),
    "relational_replace": _with(_DIRTY, "SELECT * FROM dirty"),
    "columnar_append": _with(_DIRTY, "SELECT * FROM clean UNION ALL SELECT * FROM clean"),
    "sorted_table_range": _with(
        _DIRTY, "SELECT * FROM clean WHERE created_at >= '2024-01-10' AND created_at < '2024-01-12'"
    ),
    "analyse_csv": _with(
        _DIRTY,
        """SELECT ticket_id, client_id,
       coalesce(strftime(TRY_CAST(created_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), created_at) AS created_at,
       request, request_type, priority, assigned_team
FROM clean""",
    ),
    "analyse_by_day": _with(_DIRTY, f"SELECT {_DAY} AS day, count(*) AS n FROM clean WHERE {_DAY} IS NOT NULL GROUP BY 1"),
    "analyse_team_priority": _with(
        _DIRTY,
        """SELECT assigned_team,
       count(*) FILTER (WHERE priority = 'critical') AS critical,
       count(*) FILTER (WHERE priority = 'high') AS high,
       count(*) FILTER (WHERE priority = 'low') AS low,
       count(*) FILTER (WHERE priority = 'medium') AS medium,
       count(*) FILTER (WHERE priority = 'urgent') AS urgent
FROM clean GROUP BY assigned_team""",
    ),
    "dashboard_sql": _with(
        _TICKETS,
        f"""SELECT assigned_team, {_DAY} AS day, count(*) AS n FROM routed
WHERE assigned_team IS NOT NULL AND {_DAY} IS NOT NULL GROUP BY 1, 2""",
    ),
    "summary_text": _with(
        _TICKETS + ",\n" + _SUMMARY_LINES,
        """SELECT value || ': ' || CAST(n AS VARCHAR) AS line FROM summary
UNION ALL SELECT 'Répartition priorités :' UNION ALL SELECT ''
UNION ALL SELECT 'Types de requêtes :' UNION ALL SELECT ''
UNION ALL SELECT 'Équipes assignées :' UNION ALL SELECT ''""",
    ),
}
