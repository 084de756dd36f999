"""Row rules: configuration compiled into one reason expression, and the split it drives.

All rules of a schema become a single projection, so one scan decides every row whatever the number of rules.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.functions import coerce_numeric

log = logging.getLogger(__name__)

REASON = "quarantine_reason"
SOURCE_FILE = "source_file"
_FLOATS = (T.FloatType, T.DoubleType)


def _is_null(name: str, dtype: T.DataType) -> Column:
    """NaN is no value either; Spark alone would rank it above every number."""
    col = F.col(name)
    return (col.isNull() | F.isnan(col)) if isinstance(dtype, _FLOATS) else col.isNull()


def _as_number(name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return coerce_numeric(name)
    number = F.col(name).try_cast("double")
    return F.when(~F.isnan(number), number)


def rule_reasons(
    schema: T.StructType, rules: Mapping[str, Mapping], numbers: Mapping[str, Column] | None = None
) -> list[Column]:
    """One nullable reason per check, in the order of the configuration.

    Rules on columns the data does not have are reported and left out. ``numbers`` may name columns that hold the
    numeric value of a text column already.
    """
    reasons = []
    for name, rule in (rules or {}).items():
        if name not in schema.names:
            log.warning("rule on column %r ignored: the data has no such column", name)
            continue
        dtype = schema[name].dataType
        # The texts of the reasons.
        prefix = f"Column '{name}': "
        is_null = _is_null(name, dtype)

        def failed(condition: Column, text: str, prefix: str = prefix) -> None:
            reasons.append(F.when(condition, F.lit(prefix + text)))

        if rule.get("non_null"):
            failed(is_null, "is null")
        if "min_value" in rule or "max_value" in rule:
            number = (numbers or {}).get(name)
            number = _as_number(name, dtype) if number is None else number
            if "min_value" in rule:
                failed(number < F.lit(rule["min_value"]), f"is less than {rule['min_value']}")
            failed(number.isNull() & ~is_null, "failed numeric conversion for range check")
            if "max_value" in rule:
                failed(number > F.lit(rule["max_value"]), f"is greater than {rule['max_value']}")
        text = F.col(name).cast("string")
        if "pattern_match" in rule:
            failed(~text.rlike(rule["pattern_match"]), f"does not match pattern {rule['pattern_match']}")
        if "allowed_values" in rule:
            allowed = [str(v) for v in rule["allowed_values"]]
            failed(~text.isin(*allowed), f"is not one of {', '.join(allowed)}")
    return reasons


def none_if_empty(text: Column) -> Column:
    # The array names the text for the lambda, so it is worked out once; nullif and a CASE would repeat it.
    return F.get(F.filter(F.array(text), lambda t: t != ""), F.lit(0))


def reason_column(schema: T.StructType, rules: Mapping[str, Mapping]) -> Column:
    """All failures of a row joined with ``"; "``, NULL for a valid row."""
    reasons = rule_reasons(schema, rules)
    if not reasons:
        return F.lit(None).cast("string")
    return none_if_empty(F.concat_ws("; ", *reasons))


def with_reasons(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    return df.withColumn(REASON, reason_column(df.schema, rules))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def quarantined_rows(checked: DataFrame, source_file: Column | str) -> DataFrame:
    """Rows with a reason, their columns as they came, plus the reason and the file they came from."""
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return checked.filter(F.col(REASON).isNotNull()).withColumn(SOURCE_FILE, source)


def split_rows(df: DataFrame, rules: Mapping[str, Mapping], source_file: Column | str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows); together they are exactly the rows of ``df``."""
    checked = with_reasons(df, rules)
    return valid_rows(checked), quarantined_rows(checked, source_file)


def counts_by(checked: DataFrame, *by: str) -> DataFrame:
    """Valid, quarantined and total rows per group."""
    return checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col(REASON).isNull()).alias("rows_valid"),
        F.count_if(F.col(REASON).isNotNull()).alias("rows_quarantined"),
    )


def in_quarantine_layout(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Columns of the quarantine table by name, as text; absent ones are NULL."""
    return df.select(
        *[
            (F.col(f.name).cast("string") if f.name in df.columns else F.lit(None).cast("string")).alias(f.name)
            for f in layout.fields
        ]
    )
