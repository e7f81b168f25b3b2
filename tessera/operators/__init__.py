from tessera.operators.layout import sort_for_storage, union_by_name
from tessera.operators.metrics import (
    crosstab,
    crosstab_long,
    date_rejects,
    distribution_summary,
    preview,
    rejected_dates,
    row_and_file_counts,
    row_count,
    tickets_by_priority,
    tickets_by_request_type,
    tickets_by_team,
    tickets_per_day,
    value_counts,
)
from tessera.operators.quality import (
    MissingColumnsError,
    affected_columns,
    any_nulls,
    clean_for_analysis,
    clean_for_warehouse,
    cleaning_audit,
    contract_violations,
    distinct_rows,
    drop_incomplete,
    has_key_column,
    is_empty,
    null_counts,
    null_profile,
    require_columns,
    row_copies,
)
from tessera.operators.transform import assign_team, encode_messages, enrich_messages, parse_messages

__all__ = [name for name in dir() if not name.startswith("_")]
