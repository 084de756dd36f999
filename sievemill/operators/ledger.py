"""The ingest ledger: which files were handled when, and with what result.

The ledger is only ever appended to. A successful file is known by the hash of its content, any other by its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.operators.load import last_per_key

# File states and run modes.
SUCCESS, ERROR, SKIPPED = "success", "error", "skipped"
NORMAL, BACKFILL = "NORMAL", "BACKFILL"

LEDGER_SCHEMA = (
    "ledger_key string, status string, message string, original_filename string, content_hash string, "
    "recorded_at timestamp"
)


def ledger_key(status: Column | str, content_hash: Column | str, file_name: Column | str) -> Column:
    status, content_hash, file_name = (F.col(c) if isinstance(c, str) else c for c in (status, content_hash, file_name))
    return F.coalesce(F.when(status == SUCCESS, content_hash), file_name)


def ledger_entries(outcomes: DataFrame, recorded_at: Column) -> DataFrame:
    """Ledger rows for file outcomes. Files skipped because they are known already add nothing new."""
    return outcomes.select(
        ledger_key("status", "content_hash", "file_name").alias("ledger_key"),
        "status",
        F.col("message"),
        F.col("file_name").alias("original_filename"),
        "content_hash",
        recorded_at.cast("timestamp").alias("recorded_at"),
    )


def latest_entries(ledger: DataFrame, *order: str) -> DataFrame:
    """The newest entry per key; later entries overwrite earlier ones."""
    return last_per_key(ledger, ["ledger_key"], list(order) or ["recorded_at"])


def known_hashes(ledger: DataFrame) -> DataFrame:
    """Contents that were ingested successfully; errors and skips do not keep a file from another try."""
    return ledger.filter(F.col("status") == SUCCESS).select(F.col("ledger_key").alias("content_hash")).distinct()


def files_to_ingest(files: DataFrame, ledger: DataFrame, mode: str = NORMAL) -> DataFrame:
    """Files whose content is new. A backfill takes all of them; the load still guards the keys."""
    if mode == BACKFILL:
        return files
    if mode != NORMAL:
        raise ValueError(f"unknown run mode {mode!r}")
    return files.join(known_hashes(ledger), "content_hash", "left_anti").select(*files.columns)


def mark_known(files: DataFrame, ledger: DataFrame, mode: str = NORMAL) -> DataFrame:
    """Adds ``known``: whether the content of a file was ingested before and stays out of this run."""
    if mode == BACKFILL:
        return files.withColumn("known", F.lit(False))
    if mode != NORMAL:
        raise ValueError(f"unknown run mode {mode!r}")
    known = known_hashes(ledger).withColumn("known", F.lit(True))
    return files.join(known, "content_hash", "left").select(*files.columns, F.coalesce("known", F.lit(False)).alias("known"))
