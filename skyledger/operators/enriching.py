"""Left joins between facts and dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merging import failing_on_repeats


def _side(df: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """The join keys under private names plus the taken columns under their new names."""
    return df.select(
        *[F.col(right).alias(f"__on_{left}") for left, right in on.items()],
        *[F.col(c).alias(out) for c, out in take.items()],
    )


def _match(on: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(left) == F.col(f"__on_{left}") for left in on])


def enrich(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
    unique_dim: bool = False,
) -> DataFrame:
    """Every fact row with the columns of its dimension row, null where there is none.

    ``on`` maps fact columns to dimension columns, ``take`` dimension columns
    to output names. ``unique_dim`` makes the query fail on a dimension key
    that occurs twice, which would repeat fact rows.

    No broadcast is forced: Spark broadcasts the dimension when its size is
    under the limit, else it shuffles and adaptive execution splits a hot fact
    key (a placeholder code, a big airline) over several tasks.
    """
    right = _side(dim, on, take)
    keys = [f"__on_{left}" for left in on]
    joined = fact.join(right, _match(on), "left").drop(*keys)
    return failing_on_repeats(joined, right, keys, "dimension") if unique_dim else joined


def attach_facts(
    dim: DataFrame, fact: DataFrame, on: Mapping[str, str], take: Mapping[str, str]
) -> DataFrame:
    """The rows of ``dim`` left-joined to a big ``fact``: one per match, one if there is none.

    ``on`` maps dimension columns to fact columns, ``take`` fact columns to
    output names. A plain left join could neither broadcast the small left side
    nor split a hot key of the right side. Here the facts drive an inner join,
    and dimension rows that no fact names are added.
    """
    right = _side(fact, on, take)
    keys = [f"__on_{left}" for left in on]
    matched = right.join(dim, _match(on), "inner").select(*dim.columns, *take.values())
    named = right.select(*keys).distinct()
    lone = dim.join(named, _match(on), "left_anti")
    return matched.unionByName(lone, allowMissingColumns=True)
