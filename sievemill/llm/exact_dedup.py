"""Exact dedup as a stream: keyed state on disk, never expiring, tells every text that was seen before.

1. Rows become entries of digest, id and locator (file and row in it). Entries are narrow; the text is read once here.
2. A stream over the entries keeps, for each digest, its number of rows and the row that stays (largest id) in RocksDB state. There is
   no watermark, so nothing expires; Spark combines entries of a digest within each task before state sees them, so a digest that a
   third of all rows share is one row from each task. Called again with the same ``state`` folder, only new entries are read.
3. On hits, that is for digests with more than one row, the full texts are compared with the text of the row that stays, which is
   found by its locator. The staying text goes to one slice of its group for every ``SLICE_ROWS`` rows, so no group is in one task.
   A digest whose texts differ (a collision) is split by text.
Only DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.llm.common import ascii_lower, scratch_path, written

SLICE_ROWS = 500
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of the state while a stream starts. Without fallocate a store takes the disk of its entries, not some MB ahead of them.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Order among rows of one digest: null ids first, so they stay only if there is no other; then the later locator.
RANK = "struct(doc_id, file, row_no)"


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def entries(docs: DataFrame, id_col: str, text_col: str, digest=sha256) -> DataFrame:
    """(digest, doc_id, file, row_no) of every row of a Parquet table."""
    return docs.select(
        digest(normalised(F.col(text_col))).alias("digest"),
        F.col(id_col).alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row_no"),
    )


def seen(spark: SparkSession, entry_folder: str, schema, state: str) -> DataFrame:
    """(digest, n, stay) of every digest in the stream's state after all entries of the folder are read."""
    stream = spark.readStream.schema(schema).parquet(entry_folder)
    keyed = stream.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.expr(RANK)).alias("stay"))
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        query = (
            keyed.writeStream.outputMode("update")
            .option("checkpointLocation", f"{state}/checkpoint")
            .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{state}/updates/batch={number}"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    updates = spark.read.schema(keyed.schema).parquet(f"{state}/updates")
    # A later batch's update of a digest counts all rows of the earlier ones, so the largest count is the latest.
    latest = updates.groupBy("digest").agg(F.max(F.struct("n", "stay")).alias("last"))
    # Written, so that a join with it has nothing but exchanges below and Spark can split the rows of a common digest.
    return written(latest.select("digest", "last.n", "last.stay"))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256, state: str | None = None
) -> DataFrame:
    """(doc_id, file, row_no, digest, keep_id, group_size, kept) of every row of ``docs``, a Parquet table as read.

    Texts are equal when identical after A-Z are lower-cased; a null text is empty. The row of the largest id stays; of rows with one
    id the one with the greatest locator does, a null id only if there is no other. An empty table gives no rows. ``state`` is the
    folder of the stream's state, by default a new one in the shared folder: called again with it on the table with more files, only those
    are read into the stream.
    """
    spark = docs.sparkSession
    found = entries(docs, id_col, text_col, digest)
    if state:
        found.limit(0).write.mode("append").parquet(f"{state}/entries")  # the folder is there, if only now
        files = spark.read.schema(found.schema).parquet(f"{state}/entries").select("file").distinct()
        found = found.join(files, "file", "left_anti").select(*found.columns)
    else:
        state = scratch_path(spark)
    found.write.mode("append").parquet(f"{state}/entries")
    rows = spark.read.schema(found.schema).parquet(f"{state}/entries")
    groups = seen(spark, f"{state}/entries", found.schema, state)

    row = F.struct("doc_id", "file", "row_no")
    placed = written(rows.join(groups, "digest").withColumn("kept", row.eqNullSafe(F.col("stay"))))
    hits = placed.where("n > 1").select("file", "row_no", "digest", "doc_id", "n", "kept")
    texts = docs.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_no"), normalised(F.col(text_col)).alias("body")
    )
    hits = written(hits.join(texts, ["file", "row_no"]))

    slices = F.floor((F.col("n") - 1) / SLICE_ROWS).cast("int")
    staying = hits.where("kept").select("digest", F.explode(F.sequence(F.lit(0), slices)).alias("slice"), F.col("body").alias("stay_body"))
    dealt = hits.withColumn("slice", F.pmod(F.xxhash64("file", "row_no"), slices + 1).cast("int"))
    collided = dealt.join(staying, ["digest", "slice"]).where(F.col("body") != F.col("stay_body")).select("digest").distinct()
    collided = written(collided)

    plain = placed.join(collided, "digest", "left_anti").select(
        "doc_id", "file", "row_no", "digest", F.col("stay.doc_id").alias("keep_id"), F.col("n").alias("group_size"), "kept"
    )
    # Collisions: the digest alone does not tell these texts apart, so the text does.
    rest = hits.drop("n", "kept").join(collided, "digest", "left_semi")
    by_text = rest.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.expr(RANK)).alias("stay"))
    split = rest.join(by_text, ["digest", "body"]).select(
        "doc_id", "file", "row_no", "digest", F.col("stay.doc_id").alias("keep_id"), "group_size", row.eqNullSafe(F.col("stay")).alias("kept")
    )
    return plain.union(split)
