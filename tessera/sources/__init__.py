from tessera.sources.files import (
    NoDataError,
    data_file_names,
    footer_row_count,
    has_data_files,
    list_data_files,
    load_exports,
    load_parquet_exports,
    read_json_dir,
    read_parquet_dir,
)
from tessera.sources.jdbc import read_table
from tessera.sources.kafka import kafka_options, read_message_log, read_message_log_batch, read_message_text_log, read_topic
from tessera.sources.objectstore import configured_endpoint, require_endpoint, s3a_settings

__all__ = [name for name in dir() if not name.startswith("_")]
