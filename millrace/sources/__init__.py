"""Where data comes from and where tables live."""

from millrace.sources.files import CsvRows, read_csv, read_parquet, split_csv
from millrace.sources.messages import read_file_stream, read_kafka, read_stream, renew_passed_files
from millrace.sources.session import (
    build_session,
    object_store_conf,
    rest_catalog_conf,
    scale_conf,
)
from millrace.sources.tables import (
    current_namespace,
    drop_table,
    ensure_namespace,
    ensure_table,
    list_namespaces,
    list_tables,
    replace_partitions,
    replace_table,
)

__all__ = [
    "CsvRows",
    "build_session",
    "current_namespace",
    "drop_table",
    "ensure_namespace",
    "ensure_table",
    "list_namespaces",
    "list_tables",
    "object_store_conf",
    "read_csv",
    "read_file_stream",
    "read_kafka",
    "read_parquet",
    "read_stream",
    "renew_passed_files",
    "replace_partitions",
    "replace_table",
    "rest_catalog_conf",
    "scale_conf",
    "split_csv",
]
