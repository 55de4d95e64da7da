"""Cleaning by declaration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import coded, titled


@dataclass(frozen=True)
class CleanSpec:
    """What cleaning does to a dataset: defaults for nulls, then case, then distinct rows.

    Defaults go in before trimming: a blank text stays blank, and a default in
    an ``initcap`` column is cased like any other value.
    """

    fill: Mapping[str, str] = field(default_factory=dict)
    initcap: Sequence[str] = ()
    upper: Sequence[str] = ()
    trim: Sequence[str] = ()
    dedupe: bool = True


def clean_rows(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """The row-by-row part of :func:`clean`; works on streams too."""
    cased = {
        **{c: titled(F.col(c)) for c in spec.initcap},
        **{c: coded(F.col(c)) for c in spec.upper},
        **{c: F.trim(F.col(c)) for c in spec.trim},
    }
    filled = df.na.fill(dict(spec.fill)) if spec.fill else df
    return filled.withColumns(cased) if cased else filled


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Fill, trim and case, then keep one of each set of equal rows (nulls are equal).

    Equal rows meet first inside each task, so many copies of one row do not
    make a heavy shuffle partition.
    """
    rows = clean_rows(df, spec)
    return rows.dropDuplicates() if spec.dedupe else rows


def standardize_all_strings(df: DataFrame, fill: str = "UNKNOWN", dedupe: bool = True) -> DataFrame:
    """Distinct rows, with every text column filled, trimmed and capitalised."""
    rows = df.dropDuplicates() if dedupe else df
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return rows.withColumns({c: titled(F.coalesce(F.col(c), F.lit(fill))) for c in text})
