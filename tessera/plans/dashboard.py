"""Dashboard queries over the loaded table.

Plain SQL over the table, the way a BI tool queries it. Each statement is a grouped count with a map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DASHBOARD_SQL = {
    "tickets_by_priority": """
        SELECT priority, count(*) AS n
        FROM {table} WHERE priority IS NOT NULL
        GROUP BY priority""",
    "tickets_by_request_type": """
        SELECT request_type, count(*) AS n
        FROM {table} WHERE request_type IS NOT NULL
        GROUP BY request_type""",
    "tickets_by_team": """
        SELECT assigned_team, count(*) AS n
        FROM {table} WHERE assigned_team IS NOT NULL
        GROUP BY assigned_team""",
    "team_priority": """
        SELECT assigned_team, priority, count(*) AS n
        FROM {table} WHERE assigned_team IS NOT NULL AND priority IS NOT NULL
        GROUP BY assigned_team, priority""",
    "team_day": """
        SELECT assigned_team, to_date(try_cast(created_at AS TIMESTAMP_NTZ)) AS day, count(*) AS n
        FROM {table}
        WHERE assigned_team IS NOT NULL AND try_cast(created_at AS TIMESTAMP_NTZ) IS NOT NULL
        GROUP BY 1, 2""",
}


def dashboard_over_table(spark: SparkSession, table: DataFrame, name: str) -> DataFrame:
    """One dashboard statement over a loaded table, which is given to SQL by
    itself: no view is registered, so none of that name is hidden."""
    return spark.sql(DASHBOARD_SQL[name].format(table="{loaded}"), loaded=table)


def dashboard_query(spark: SparkSession, tickets: DataFrame, name: str) -> DataFrame:
    """One dashboard statement over any table of tickets."""
    return dashboard_over_table(spark, tickets, name)
