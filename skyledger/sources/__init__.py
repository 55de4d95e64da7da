"""Scans: files, images, JDBC tables."""

from .files import (
    exact_path, file_columns, file_headers, read_csv, read_csv_by_name, read_day, read_files, read_images, read_json_array, read_json_lines, read_latest,
    read_or_empty, union_files, with_base_name, with_file_name,
)
from .inference import file_types, read_csv_folded
from .tables import read_jdbc, table_exists

__all__ = [
    "exact_path", "file_columns", "file_headers", "file_types", "read_csv", "read_csv_by_name", "read_csv_folded", "read_day", "read_files", "read_images", "read_jdbc", "read_json_array",
    "read_json_lines", "read_latest", "read_or_empty", "table_exists", "union_files",
    "with_base_name", "with_file_name",
]
