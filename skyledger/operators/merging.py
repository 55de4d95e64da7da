"""Keyed merges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType

from ..session import looks_small

OrderBy = str | Column | Sequence[str | Column]


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_col(k).isNull() for k in keys])


def _of(side: str, column: str) -> Column:
    return F.col(f"{side}.`" + column.replace("`", "``") + "`")


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [_of("s", k) == _of("t", k) for k in keys])


def _keyed_like(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target rows a source can match.

    When the source is small its keys travel to the target, and the big side is
    filtered where it lies; otherwise the join that follows shuffles both.
    """
    if not looks_small(source):
        return target
    return target.join(source.select(*map(_col, keys)).distinct(), list(keys), "left_semi")


def _fits(rows: DataFrame, column: str, fill: Mapping[str, str]) -> bool:
    return column in fill and isinstance(rows.schema[column].dataType, StringType)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str],
    columns: Sequence[str] | None = None, fill_after_merge: Mapping[str, str] | None = None,
    latest_by: OrderBy | None = None,
) -> DataFrame:
    """``target`` brought up to date by ``source``: per column the source value unless null.

    The rows are those of a full outer join on ``keys``. A null key matches
    nothing, and several source rows with one key all stay, unless ``latest_by``
    tells which of them counts; the target holds one row per key. ``columns``
    defaults to the columns of both sides; ``fill_after_merge`` gives defaults
    for what is null on both sides, for sources that were not filled before.

    Two small sides are joined just so. Otherwise that join would shuffle the
    whole target for any batch, and no hot key of it could be split:

    - a small source is broadcast to the target, which is read where it lies,
      once in full and once for its key column, to tell which source rows are
      new;
    - a big source cut to one row per key has no hot key, and one outer join,
      which finds the source partitioned already, is cheapest;
    - else source rows look up their target row and target rows without a
      source row pass. Both joins share one shuffle of the target, and adaptive
      execution cuts a hot key of the left side into several tasks.

    With a big source, rows without a key skip the joins.
    """
    keys = _names(keys)
    columns = list(columns or dict.fromkeys([*target.columns, *source.columns]))

    def picked(df: DataFrame) -> DataFrame:
        return df.select(*[_col(c) for c in df.columns if c in columns or c in keys])

    once = source if latest_by is None else dedupe_latest(source, keys, latest_by)
    old_all, new_all = picked(target), picked(once)

    def merged(c: str) -> Column:
        if c not in new_all.columns:
            return _of("t", c).alias(c)
        if c not in old_all.columns:
            return _of("s", c).alias(c)
        return F.coalesce(_of("s", c), _of("t", c)).alias(c)

    def joined(new: DataFrame, old: DataFrame, how: str) -> DataFrame:
        # Aliases, not new names: with equal columns two joins can share the target's shuffle.
        pairs = new.alias("s").join(old.alias("t"), _same(keys), how)
        return pairs.select(*[merged(c) for c in dict.fromkeys([*keys, *columns])])

    if looks_small(new_all) and looks_small(old_all):
        parts = [joined(new_all, old_all, "full")]
    elif looks_small(new_all):
        asked = new_all.select(*map(_col, keys)).distinct()
        known = old_all.select(*map(_col, keys)).join(asked, keys, "left_semi").distinct()
        parts = [joined(new_all, old_all, "right"), new_all.join(known, keys, "left_anti")]
    else:
        keyless = _any_null(keys)
        old, keyed = old_all.where(~keyless), source.where(~keyless)
        if latest_by is not None:
            parts = [joined(picked(_latest(keyed, keys, latest_by)), old, "full")]
        else:
            new = picked(keyed)
            untouched = old.join(new.select(*map(_col, keys)).distinct(), keys, "left_anti")
            parts = [joined(new, old, "left"), untouched]
        parts += [old_all.where(keyless), picked(source.where(keyless))]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*map(_col, columns))
    return rows.select(*[
        F.coalesce(_col(c), F.lit(fill_after_merge[c])).alias(c) if _fits(rows, c, fill_after_merge) else _col(c) for c in columns
    ]) if fill_after_merge else rows


def changed_rows(current: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Only the rows of the merge that are new or differ from ``current``.

    For append-only history: the untouched part of a big dimension is neither
    moved nor written again. ``source`` has one row per key, nulls aside.
    """
    keys = _names(keys)
    unknown = [c for c in source.columns if c not in current.columns]
    if unknown:
        raise ValueError(f"the current table has no columns {unknown}")
    values = [c for c in current.columns if c not in keys and c in source.columns]
    found = _keyed_like(current, source, keys).withColumn("__known", F.lit(True))
    pairs = source.alias("s").join(found.alias("t"), _same(keys), "left")
    merged = {c: F.coalesce(_of("s", c), _of("t", c)) for c in values}
    differs = reduce(
        lambda a, b: a | b,
        [~merged[c].eqNullSafe(_of("t", c)) for c in values],
        F.col("__known").isNull(),
    )
    out = [merged.get(c, _of("s" if c in keys else "t", c)).alias(c) for c in current.columns]
    return pairs.where(differs).select(*out)


def _order(order_by: OrderBy) -> Column:
    """The order of a row as one value."""
    parts = [order_by] if isinstance(order_by, str | Column) else list(order_by)
    columns = [_col(o) if isinstance(o, str) else o for o in parts]
    return F.struct(*[c.alias(f"o{k}") for k, c in enumerate(columns)])


#: Holds, for each folded column, the order of the value that counts.
FOLD_ORDER = "fold_order"


def _ranked(value: Column, kind: DataType, order: Column) -> Column:
    """A value with its order and what breaks ties: itself, or its JSON text if it has no order. Null for null."""
    rank = value if _orderable(kind) else F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), F.struct(F.struct(order.alias("o"), rank.alias("k")).alias("at"), value.alias("v")))


def _greatest(column: str) -> Column:
    return F.max_by(_col(column), _col(column)["at"]).alias(column)


def fold_latest(df: DataFrame, keys: str | Sequence[str], order_by: OrderBy) -> DataFrame:
    """One row per key: per column the last value by ``order_by`` that is not null.

    Of values of equal order the greatest counts, of maps and the like the one
    of greatest JSON text. ``fold_order`` tells the order of each value, so folds
    of parts can be folded again and give the fold of the whole. Rows with a
    null key stand for no key and all stay.
    """
    keys = _names(keys)
    values = [c for c in df.columns if c not in keys]
    ordered = df.withColumn("__order", _order(order_by))
    rows = ordered.select(
        *map(_col, keys), *[_ranked(_col(c), df.schema[c].dataType, F.col("__order")).alias(f"__{c}") for c in values]
    )
    keyless = _any_null(keys)
    once = rows.where(~keyless).groupBy(*map(_col, keys)).agg(*[_greatest(f"__{c}") for c in values])
    return _unfolded(once.unionByName(rows.where(keyless)), keys, values, df.columns)


def _unfolded(pairs: DataFrame, keys: Sequence[str], values: Sequence[str], columns: Sequence[str]) -> DataFrame:
    order = F.struct(*[_col(f"__{c}")["at"]["o"].alias(c) for c in values]).alias(FOLD_ORDER)
    shown = {c: _col(f"__{c}")["v"].alias(c) for c in values}
    return pairs.select(*[shown.get(c, _col(c)) for c in columns], order)


def folded_changes(earlier: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of a fold that are new or differ once ``source`` is folded into ``earlier``.

    ``earlier`` may hold several folds of a key, one per commit: each column's
    greatest order counts. Only keys of ``source`` are looked up; rows without a
    key are new and skip the join.
    """
    keys = _names(keys)
    columns = [c for c in source.columns if c != FOLD_ORDER]
    values = [c for c in columns if c not in keys]

    def paired(df: DataFrame) -> DataFrame:
        kinds = source.schema
        pairs = [_ranked(_col(c), kinds[c].dataType, F.col(FOLD_ORDER)[c]).alias(f"__{c}") for c in values]
        return df.select(*map(_col, keys), *pairs)

    if FOLD_ORDER not in earlier.columns:
        return source
    keyless, source = source.where(_any_null(keys)), source.where(~_any_null(keys))
    new = paired(source)
    old = _keyed_like(paired(earlier).where(~_any_null(keys)), source, keys)
    old = old.groupBy(*map(_col, keys)).agg(*[_greatest(f"__{c}") for c in values], F.lit(True).alias("__known"))
    both = new.alias("s").join(old.alias("t"), _same(keys), "left")

    def merged(c: str) -> Column:
        mine, other = _of("s", f"__{c}"), _of("t", f"__{c}")
        return F.when(other.isNull() | (mine["at"] >= other["at"]), mine).otherwise(other)

    differs = reduce(
        lambda a, b: a | b, [~merged(c)["at"].eqNullSafe(_of("t", f"__{c}")["at"]) for c in values],
        F.col("__known").isNull(),
    )
    changed = both.where(differs).select(*[_of("s", k).alias(k) for k in keys], *[merged(c).alias(f"__{c}") for c in values])
    return _unfolded(changed, keys, values, columns).unionByName(keyless)


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, MapType | VariantType)


def _latest(df: DataFrame, keys: Sequence[str], order_by: OrderBy) -> DataFrame:
    order = [order_by] if isinstance(order_by, str | Column) else list(order_by)
    order = [_col(o) if isinstance(o, str) else o for o in order]
    # What has no order, such as a map, breaks ties by its JSON text.
    rest = [
        _col(f.name) if _orderable(f.dataType) else F.to_json(F.struct(_col(f.name)))
        for f in df.schema.fields
        if f.name not in keys
    ]
    by_rank = W.partitionBy(*map(_col, keys)).orderBy(*[c.desc_nulls_last() for c in [*order, *rest]])
    ranked = df.withColumn("__rank", F.row_number().over(by_rank))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def dedupe_latest(df: DataFrame, keys: str | Sequence[str], order_by: OrderBy) -> DataFrame:
    """One row per key: the greatest by ``order_by``; ties fall to the greatest other columns.

    Rows with a null key stand for no key and all stay. Each task keeps one row
    per key before the shuffle, so a hot key does not fill one task.
    """
    keys = _names(keys)
    keyless = _any_null(keys)
    return _latest(df.where(~keyless), keys, order_by).unionByName(df.where(keyless))


def failing_on_repeats(
    result: DataFrame, side: DataFrame, keys: Sequence[str], what: str
) -> DataFrame:
    """``result``, failing when the query runs if a key occurs twice in ``side``.

    The check counts keys in a branch of its own, which adds no rows, and so
    leaves the join's plan alone. Null keys match nothing and may repeat.
    """
    counted = side.where(~_any_null(keys)).groupBy(*map(_col, keys)).agg(F.count("*").alias("__n"))
    message = F.concat_ws(" ", F.lit(f"{what}: more than one row for key"), *map(_col, keys))
    repeats = F.when(F.col("__n") > 1, F.raise_error(message)).isNotNull()
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema.fields]
    return result.unionByName(counted.where(repeats).select(*nulls))


def apply_updates(
    df: DataFrame, updates: DataFrame, key: str, stamp_col: str | None = None,
    stamp: str | Column | None = None, derive: Mapping[str, Column] | None = None,
    order_by: OrderBy | None = None,
) -> DataFrame:
    """Change some columns of some rows.

    ``updates`` holds ``key`` and the columns to set; a null there leaves the
    old value. ``derive`` sets columns from the matched row's old values.
    Matched rows get ``stamp`` in ``stamp_col``. Keys compare as text.
    Several updates for one key need ``order_by`` (the latest counts);
    otherwise they make the query fail.
    """
    derive = dict(derive or {})
    ordered = {o for o in ([order_by] if isinstance(order_by, str) else order_by or ()) if isinstance(o, str)} if not isinstance(order_by, Column) else set()
    unknown = [c for c in updates.columns if c not in df.columns and c not in ordered]
    if unknown:
        raise ValueError(f"no columns {unknown} to update")
    sets = [c for c in updates.columns if c != key and c in df.columns]
    asked = updates.where(_col(key).isNotNull())
    if order_by is not None:
        asked = _latest(asked, [key], order_by)
    news = asked.select(
        _col(key).cast("string").alias("__key"),
        F.lit(True).alias("__hit"),
        *[_col(c).alias(f"__new_{c}") for c in sets],
    )
    joined = df.alias("t").join(news, _of("t", key).cast("string") == F.col("__key"), "left")
    hit = F.col("__hit").isNotNull()

    def value(c: str) -> Column:
        kept = _col(c)
        if c in derive:
            kept = F.when(hit, derive[c]).otherwise(kept)
        if c in sets:
            kept = F.coalesce(_col(f"__new_{c}").cast(df.schema[c].dataType), kept)
        if c == stamp_col:
            now = stamp if isinstance(stamp, Column) else F.lit(stamp)
            kept = F.when(hit, now).otherwise(kept)
        return kept.alias(c)

    changed = joined.select(*[value(c) for c in df.columns])
    return changed if order_by is not None else failing_on_repeats(changed, news, ["__key"], "updates")
