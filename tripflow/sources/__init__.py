from tripflow.sources.files import (
    bronze_sample,
    discover_files,
    read_csv,
    read_json_lines,
    read_parquet,
    read_text_lines,
)
from tripflow.sources.sinks import ingest, publish_table, save
from tripflow.sources.streams import read_kafka, read_stream_folder
from tripflow.sources.tables import ensure_layer, read_table, register_view, table_exists

__all__ = [
    "bronze_sample", "discover_files", "ensure_layer", "ingest", "publish_table", "read_csv",
    "read_json_lines", "read_kafka", "read_parquet", "read_stream_folder", "read_table",
    "read_text_lines", "register_view", "save", "table_exists",
]
