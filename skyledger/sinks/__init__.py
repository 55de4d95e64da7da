"""Writes: catalog tables, landed files, exports, JDBC."""

from .export import export_csv, export_json, land
from .jdbc import load_jdbc
from .publish import ensure_namespace, publish, recover

__all__ = ["ensure_namespace", "export_csv", "export_json", "land", "load_jdbc", "publish", "recover"]
