"""DataFrame operators."""

from .cleaning import CleanSpec, clean, clean_rows, standardize_all_strings
from .enriching import attach_facts, enrich
from .history import (
    Buckets, as_of, commits, compact, files, read_history, rows_until, snapshots, table_as_of, write_base, write_commit,
)
from .images import extract_text, extract_text_in_batches, image_metadata
from .members import assign_ids, available_codes, code_pool, new_members
from .merging import (
    FOLD_ORDER, apply_updates, changed_rows, dedupe_latest, fold_latest, folded_changes, merge_upsert,
)
from .quality import Expectation, QualityError, failures, passed, validate, validate_files
from .texttable import flight_table_json, parse_flight_table

__all__ = [
    "FOLD_ORDER", "Buckets", "CleanSpec", "Expectation", "QualityError", "apply_updates", "as_of", "assign_ids",
    "attach_facts", "available_codes", "changed_rows", "clean", "clean_rows", "code_pool",
    "commits", "compact", "dedupe_latest", "enrich", "extract_text", "extract_text_in_batches", "failures", "files", "fold_latest", "folded_changes",
    "flight_table_json", "image_metadata", "merge_upsert", "new_members", "parse_flight_table",
    "passed", "read_history", "rows_until", "snapshots", "standardize_all_strings", "table_as_of", "validate", "validate_files", "write_base", "write_commit",
]
