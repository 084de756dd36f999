"""Loading rows into keyed and plain tables: insert-if-absent, insert-or-replace, append.

Keys compare null-safe: rows whose key has gaps load once, like any other. Each key column becomes a value that is
never NULL plus a flag, so that ranking the batch and joining it to the table hash on the very same columns and the
batch is shuffled once. Ranking for "first row of a key" prunes map-side, before the shuffle, which keeps a key that
holds a large share of the rows from piling up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.registry import Registry

_RANK = "_rank"


def _stand_in(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    return F.lit(0).cast(dtype)


def _key_names(keys: Sequence[str]) -> list[str]:
    return [n for k in keys for n in (f"_key_{k}", f"_gap_{k}")]


def _keyed(df: DataFrame, keys: Sequence[str], types: T.StructType) -> DataFrame:
    added = {}
    for k in keys:
        dtype = types[k].dataType
        added[f"_key_{k}"] = F.coalesce(F.col(k).cast(dtype), _stand_in(dtype))
        added[f"_gap_{k}"] = F.col(k).isNull()
    return df.withColumns(added)


def _best_per_key(keyed: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    window = Window.partitionBy(*_key_names(keys)).orderBy(*order)
    return keyed.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in ``order``, which has to be total for a repeatable result."""
    return _best_per_key(_keyed(df, keys, df.schema), keys, order).drop(*_key_names(keys))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc() for c in order])


def existing_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``batch`` that ``target`` holds, as the key columns of the load.

    With a small batch Spark broadcasts its keys and the table is only scanned, never shuffled.
    """
    mine = _keyed(target.select(*keys), keys, target.schema).select(*_key_names(keys))
    return mine.join(_distinct_keys(batch, keys, target.schema), _key_names(keys), "left_semi")


def _distinct_keys(df: DataFrame, keys: Sequence[str], types: T.StructType) -> DataFrame:
    # Repeats of a key are merged before the shuffle, so a key of many rows weighs no more than any other.
    return _keyed(df.select(*keys), keys, types).select(*_key_names(keys)).distinct()


def rows_to_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """What an insert-if-absent adds: the first row of every key that ``target`` does not hold."""
    names = _key_names(keys)
    firsts = _best_per_key(_keyed(batch, keys, target.schema), keys, order)
    return firsts.join(existing_keys(target, batch, keys), names, "left_anti").select(*batch.columns)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The table after the load. Existing rows win; within the batch the first row of a key wins."""
    return append(target, rows_to_insert(target, batch, keys, order))


def insert_or_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table after the load. The batch wins, its last row of a key first of all."""
    names = _key_names(keys)
    mine = _keyed(target, keys, target.schema)
    kept = mine.join(_distinct_keys(batch, keys, target.schema), names, "left_anti").select(*target.columns)
    return append(kept, last_per_key(batch, keys, order))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name and in the order of ``target``; what the batch lacks is NULL."""
    return target.unionByName(batch.select(*[c for c in target.columns if c in batch.columns]), allowMissingColumns=True)


def load_statistics(batch: DataFrame, inserted: DataFrame, *by: str) -> DataFrame:
    """Rows offered, inserted and skipped for an existing key, in total or per ``by``."""
    flags = lambda df, offered, new: df.select(*by, F.lit(offered).alias("offered"), F.lit(new).alias("new"))
    counted = flags(batch, 1, 0).unionByName(flags(inserted, 0, 1)).groupBy(*by).agg(
        F.coalesce(F.sum("offered"), F.lit(0)).alias("rows_in_source"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("rows_inserted"),
    )
    return counted.withColumn("rows_skipped", F.col("rows_in_source") - F.col("rows_inserted"))


def is_allowed(registry: Registry, table_column: str) -> Column:
    """Whether a row's table is named in the configuration."""
    return F.coalesce(F.col(table_column).isin(*registry.table_names), F.lit(False))


def split_by_allowed(routed: DataFrame, registry: Registry, table_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows for a configured table, refused rows)."""
    allowed = is_allowed(registry, table_column)
    return routed.filter(allowed), routed.filter(~allowed)
