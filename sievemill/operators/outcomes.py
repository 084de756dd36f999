"""What became of every file, and of the run as a whole."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.operators.ledger import ERROR, SKIPPED, SUCCESS
from sievemill.registry import Registry

PROCESSED, QUARANTINE = "processed", "quarantine"


def filled_counts(columns: Iterable[str], counted: Column | None = None) -> list[Column]:
    """Rows with a value per column, as ``filled_<column>``; the sums combine map-side."""
    keep = F.lit(True) if counted is None else counted
    return [F.count(F.when(keep, F.col(c))).alias(f"filled_{c}") for c in columns]


def missing_required(registry: Registry, schema_name: Column | str) -> Column:
    """Required columns that hold nothing at all, from ``filled_<column>`` counts; NULL when none is missing."""
    name = F.col(schema_name) if isinstance(schema_name, str) else schema_name
    missing = F.lit(None).cast("string")
    for spec in registry.data_schemas:
        if spec.required:
            declared = set(spec.column_names)
            gaps = [
                F.when(F.col(f"filled_{c}") == 0, F.lit(c)) if c in declared else F.lit(f"{c} (not declared)")
                for c in spec.required
            ]
            missing = F.when(name == spec.name, F.nullif(F.concat_ws(", ", *gaps), F.lit(""))).otherwise(missing)
    return missing


def no_match(attempted: Iterable[str]) -> str:
    """Why a file that no schema's keywords are found in is skipped; ``attempted``: names of the schemas in their order."""
    return f"no schema matches the content; tried: {', '.join(attempted) or 'none'}"


# Checks of one file or archive member in the order they count: condition, state, reason.
def _checks(attempted: Iterable[str]) -> list[tuple[Column, str, Column]]:
    c = F.col
    return [
        (c("error").isNotNull(), ERROR, c("error")),
        (c("n_bytes") == 0, SKIPPED, F.lit("file is empty")),
        (c("schema_name").isNull(), SKIPPED, F.lit(no_match(attempted))),
        (c("decode_error").isNotNull(), ERROR, c("decode_error")),
        (c("rows_source") == 0, ERROR, F.lit("no data rows")),
        (~c("has_columns"), ERROR, F.concat(F.lit("no columns declared for schema "), c("schema_name"))),
        (~c("has_target"), ERROR, F.concat(F.lit("no header name belongs to schema "), c("schema_name"))),
        (c("missing_required").isNotNull(), ERROR, F.concat(F.lit("required columns are empty: "), c("missing_required"))),
    ]


def parse_status() -> Column:
    status = F.lit(SUCCESS)
    for condition, state, _ in reversed(_checks(())):
        status = F.when(condition, F.lit(state)).otherwise(status)
    return status


def parse_reason(attempted: Iterable[str] = ()) -> Column:
    reason = F.lit(None).cast("string")
    for condition, _, text in reversed(_checks(attempted)):
        reason = F.when(condition, text).otherwise(reason)
    return reason


def member_outcomes(members: DataFrame, attempted: Iterable[str] = ()) -> DataFrame:
    """State of every plain file and archive member, from its facts; ``attempted``: the schemas that their contents were compared with.

    Needs ``error, n_bytes, schema_name, decode_error, rows_source, has_columns, has_target, missing_required`` and
    the counts ``rows_valid`` and ``rows_quarantined``, which only stay for members that were parsed.
    """
    parsed = F.col("parse_status") == SUCCESS
    return (
        members.withColumns({"parse_status": parse_status(), "parse_reason": parse_reason(attempted)})
        .withColumns(
            {c: F.when(parsed, F.col(c)).otherwise(F.lit(0)) for c in ("rows_source", "rows_valid", "rows_quarantined")}
        )
        .withColumns(
            {
                "status": F.when(parsed & (F.col("rows_valid") == 0), F.lit(ERROR)).otherwise(F.col("parse_status")),
                "reason": F.when(parsed & (F.col("rows_valid") == 0), F.lit("all rows quarantined")).otherwise(
                    F.col("parse_reason")
                ),
            }
        )
    )


def roll_up(members: DataFrame, by: Iterable[str] = ("file_name",)) -> DataFrame:
    """State of every file. An archive succeeds when any member loads and fails otherwise."""
    loaded = F.count_if(F.col("status") == SUCCESS)
    return (
        members.groupBy(*by)
        .agg(
            F.bool_or("is_archive").alias("is_archive"),
            F.count(F.lit(1)).alias("members"),
            loaded.alias("members_loaded"),
            F.max("status").alias("_only_status"),
            F.max("reason").alias("_only_reason"),
            F.sum("rows_source").alias("rows_source"),
            F.sum("rows_valid").alias("rows_valid"),
            F.sum("rows_quarantined").alias("rows_quarantined"),
        )
        .withColumns(
            {
                "status": F.when(F.col("members_loaded") > 0, F.lit(SUCCESS))
                .when(F.col("is_archive"), F.lit(ERROR))
                .otherwise(F.col("_only_status")),
                "message": F.when(
                    F.col("members_loaded") > 0,
                    F.format_string(
                        "%d rows valid, %d rows quarantined", F.col("rows_valid"), F.col("rows_quarantined")
                    ),
                )
                .when(
                    F.col("is_archive") & (F.col("members") > 1),
                    F.format_string(
                        "no member could be loaded, %d rows quarantined", F.col("rows_quarantined")
                    ),
                )
                .otherwise(F.col("_only_reason")),
            }
        )
        .drop("_only_status", "_only_reason")
    )


def disposition(status: Column | str) -> Column:
    """Where a file belongs after the run. Skipped files stay apart from refused ones."""
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status == SUCCESS, F.lit(PROCESSED)).when(status == SKIPPED, F.lit(SKIPPED)).otherwise(F.lit(QUARANTINE))


# Names of the report counters and run states.
def run_counters(files: DataFrame, *by: str) -> DataFrame:
    """Counters over file outcomes (``status``, ``rows_source``, ``rows_inserted``, ``rows_quarantined``, ``rows_skipped``)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files_processed_total"),
        F.count_if(F.col("status") == SUCCESS).alias("files_successfully_parsed_and_validated_loaded"),
        F.count_if(F.col("rows_quarantined") > 0).alias("files_with_quarantined_rows"),
        F.count_if(F.col("status") == SKIPPED).alias("files_skipped_manifest"),
        F.count_if(F.col("status") == ERROR).alias("files_failed_parsing_or_other_error"),
        total("rows_source").alias("rows_source_total_from_parsed_files"),
        total("rows_inserted").alias("rows_added_to_main_tables"),
        total("rows_quarantined").alias("rows_added_to_quarantine_table"),
        total("rows_skipped").alias("rows_skipped_on_load_due_to_conflict"),
    )


def run_status() -> Column:
    c = F.col
    troubled = (c("files_failed_parsing_or_other_error") > 0) | (c("files_with_quarantined_rows") > 0)
    some = c("files_successfully_parsed_and_validated_loaded") > 0
    return (
        F.when(troubled & some, F.lit("PARTIAL_SUCCESS"))
        .when(troubled, F.lit("FAILURE"))
        .when(some, F.lit("SUCCESS"))
        .when(c("files_processed_total") == 0, F.lit("SUCCESS"))
        .otherwise(F.lit("UNKNOWN"))
    )


def with_clock(report: DataFrame, execution_id: str, started: Column, ended: Column, seconds: float) -> DataFrame:
    return report.select(
        F.lit(execution_id).alias("execution_id"),
        "status",
        started.alias("start_time"),
        ended.alias("end_time"),
        F.round(F.lit(float(seconds)), 2).alias("total_duration_seconds"),
        *[c for c in report.columns if c != "status"],
    )


def as_json(df: DataFrame, alias: str = "report") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(alias))
