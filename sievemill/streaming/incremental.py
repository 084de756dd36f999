"""Incremental ingestion: each run of the stream takes the files that came since the last one.

Spark's file source remembers in its checkpoint which files it has handed out, so a growing folder is not hashed anew
every time; the ledger still turns away new files with known content. A micro-batch that is tried again has the same
run id and therefore adds no row twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievemill.functions import base_name
from sievemill.operators.tables import LEDGER_TABLE, Warehouse
from sievemill.plans.ingest import ingest_files
from sievemill.registry import Registry, build_registry
from sievemill.sources.files import lies_in, list_files, only_targets, with_empty_files, with_hidden_files

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    warehouse_root: str,
    checkpoint: str,
    registry: Registry | None = None,
    *,
    targets: str = "",
    files_per_batch: int = 10_000,
    name: str = "ingest",
    **options,
) -> StreamingQuery:
    """Starts a query that ingests all new files directly in ``folder``, or those named in ``targets``, in batches and then stops.

    Hidden and empty files, which the stream does not hand out, join a batch once, until the ledger has their names.
    """
    registry = registry or build_registry()

    def ingest_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = batch.filter(lies_in(F.col("path"), folder)).select("path", base_name("path").alias("file_name"), "modificationTime", "length", "content")
        warehouse = Warehouse(session, warehouse_root, registry)
        listed = list_files(session, folder).select("path", "file_name", "length").withColumn("content", F.lit(b""))
        passed_over = with_hidden_files(with_empty_files(listed, folder).filter("length = 0"), folder)
        handled = warehouse.read(LEDGER_TABLE).select(F.col("original_filename").alias("file_name")).distinct()
        files = files.unionByName(passed_over.join(handled, "file_name", "left_anti"), allowMissingColumns=True)
        ingest_files(session, only_targets(files, targets), warehouse, run_id=f"{name}-{batch_id:08d}", **options)

    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        # Without this, subfolders named like partitions would decide which files there are; what lies in them is left out above.
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .writeStream.foreachBatch(ingest_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
