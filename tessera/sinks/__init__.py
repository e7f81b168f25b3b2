from tessera.sinks.files import (
    CSV_READ_OPTIONS,
    CSV_WRITE_OPTIONS,
    read_csv,
    summary_lines,
    write_chart_tables,
    write_csv,
    write_json,
    write_parquet,
    write_summary_text,
)
from tessera.sinks.tables import append_columnar, replace_table
from tessera.sinks.topic import kafka_write_options, publish_to_log, publish_to_topic

__all__ = [name for name in dir() if not name.startswith("_")]
