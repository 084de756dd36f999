"""Parquet tables of the warehouse folder: created from the declared schema, appended to, replaced by period.

Keyed tables are partitioned by the month of the first date in their key, so a load reads only the months it brings.
The other tables are partitioned by load, and a load that is run again replaces its own rows.

Every write goes to a folder of its own and counts from the moment a version of the table names it (``versions``). So a table is never
seen half written or half replaced, a reader stays with the version it began with, and of two writers the later one takes
account of what the earlier one wrote: by key, and in tables without a key by the contents of the files that a load brought, which each
write keeps beside its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.operators import load
from sievemill.operators.ledger import LEDGER_SCHEMA
from sievemill.operators.versions import Version, VersionLog
from sievemill.registry import Registry

LEDGER_TABLE = "ingest_ledger"
PERIOD = "load_period"
LOAD = "load_id"
WRITE = "write_id"
#: The column that says which file content a row is from, and the folder beside the tables that lists the contents of their writes.
CONTENT, CONTENTS = "_content", "_contents"
NO_DATE = "none"
#: Writers that come between before a write gives up.
TRIES = 20


class Warehouse:
    """Tables under ``root``; ``unique_key_tables`` names tables to key by their ``unique_key`` when they have no other."""

    def __init__(
        self, spark: SparkSession, root: str, registry: Registry, unique_key_tables: tuple[str, ...] = ()
    ) -> None:
        self.spark, self.root, self.registry = spark, root.rstrip("/"), registry
        self.schemas: dict[str, T.StructType] = {}
        self.keys: dict[str, list[str]] = {}
        for spec in registry.schemas.values():
            self.schemas[spec.table] = spec.struct
            key = spec.primary_key or (spec.unique_key if spec.table in unique_key_tables else ())
            self.keys[spec.table] = list(key)
        # The ledger is the library's own table and always allowed.
        self.schemas[LEDGER_TABLE] = spark.createDataFrame([], LEDGER_SCHEMA).schema
        self.keys[LEDGER_TABLE] = []
        #: Writes of each keyed table that the last batch was compared with.
        self._compared: dict[str, int] = {}

    def path(self, table: str) -> str:
        self._check(table)
        return f"{self.root}/{table}"

    def _check(self, table: str) -> None:
        if table not in self.schemas:
            raise ValueError(f"table {table!r} is not in the schema configuration, allowed: {sorted(self.schemas)}")

    def _layout(self, table: str) -> T.StructType:
        self._check(table)
        partitions = [T.StructField(c, T.StringType()) for c in (WRITE, self._partition(table))]
        return T.StructType([*self.schemas[table].fields, *partitions])

    def _partition(self, table: str) -> str:
        return PERIOD if self.keys[table] else LOAD

    def _period(self, table: str) -> Column:
        dates = [k for k in self.keys[table] if isinstance(self.schemas[table][k].dataType, T.DateType)]
        return F.coalesce(F.date_format(dates[0], "yyyy-MM"), F.lit(NO_DATE)) if dates else F.lit("all")

    def _log(self, table: str) -> VersionLog:
        return VersionLog(self.spark, self.path(table))

    def exists(self, table: str) -> bool:
        return self._log(table).latest().number >= 0

    def create(self, table: str) -> None:
        """Empty table of the declared columns, unless it is there."""
        log = self._log(table)
        if log.latest().number < 0:
            log.commit(Version(0))  # whoever else was first made the same

    def _rows(self, table: str, version: Version, since: int = 0) -> DataFrame:
        """Rows of a version, or those of its writes from ``since`` on; a condition on partitions alone."""
        stored = self.spark.read.schema(self._layout(table)).parquet(self.path(table))
        return stored.filter(version.counts(F.col(WRITE), F.col(self._partition(table)), since)).drop(WRITE)

    def _contents(self, table: str) -> str:
        return f"{self.root}/{CONTENTS}/{table}"

    def _held(self, table: str, version: Version) -> DataFrame | None:
        """(content, load) of the writes that count, None if no write of the table has named any."""
        if not self._log(table).holds(self._contents(table)):
            return None
        layout = T.StructType([T.StructField(c, T.StringType()) for c in (CONTENT, WRITE, LOAD)])
        stored = self.spark.read.schema(layout).parquet(self._contents(table))
        return stored.filter(version.counts(F.col(WRITE), F.col(LOAD))).drop(WRITE)

    def contents_of(self, load_id: str) -> DataFrame | None:
        """Contents whose rows a load has put into tables without a key; None if there are none."""
        out = None
        for table in (t for t, keys in self.keys.items() if not keys):
            if (held := self._held(table, self._log(table).latest())) is not None:
                mine = held.filter(F.col(LOAD) == load_id).select(CONTENT)
                out = mine if out is None else out.unionByName(mine)
        return None if out is None or out.isEmpty() else out.distinct()

    def finished_loads(self) -> frozenset[str]:
        """Loads that the ledger tells of. There are as many as writes of a table, which its versions list too."""
        self.create(LEDGER_TABLE)
        rows = self._rows(LEDGER_TABLE, self._log(LEDGER_TABLE).latest())
        return frozenset(r[0] for r in rows.select(LOAD).distinct().collect())

    def _stored(self, table: str) -> DataFrame:
        self.create(table)
        return self._rows(table, self._log(table).latest())

    def read(self, table: str) -> DataFrame:
        return self._stored(table).select(*self.schemas[table].names)

    def _write(self, table: str, make: Callable[[Version], tuple[DataFrame, list[str]]]) -> None:
        """Writes and publishes what ``make`` says of a version: rows, and the partitions in which they take the place of all before.

        Where another writer was faster, all is made anew from the version that it left."""
        self.create(table)
        log, partition = self._log(table), self._partition(table)
        for _ in range(TRIES):
            version, write = log.latest(), uuid.uuid4().hex
            rows, gone = make(version)
            if CONTENT in rows.columns:
                brought = rows.select(CONTENT, partition).filter(F.col(CONTENT).isNotNull()).distinct()
                brought.write.mode("errorifexists").partitionBy(partition).parquet(f"{self._contents(table)}/{WRITE}={write}")
            # Rebalancing keeps files of one partition few, and splits a partition that holds most of the rows.
            (
                rows.select(*self.schemas[table].names, partition)
                .hint("rebalance", partition)
                .write.mode("errorifexists")
                .partitionBy(partition)
                .parquet(f"{self.path(table)}/{WRITE}={write}")
            )
            if log.commit(version.after(write, gone)):
                return
        raise RuntimeError(f"table {table!r} is changed by others faster than this write can be made")

    def load_slice(self, table: str, batch: DataFrame) -> DataFrame:
        """The part of a keyed table whose periods the batch brings, as a partition filter."""
        # A month is one value, so there are few; a stray date adds its own month and not all between.
        periods = self._periods(batch)
        self.create(table)
        version = self._log(table).latest()
        self._compared[table] = len(version.writes)
        stored = self._rows(table, version)
        return stored.filter(F.col(PERIOD).isNotNull() & F.col(PERIOD).isin(*periods)) if periods else stored.limit(0)

    def _periods(self, batch: DataFrame) -> list[str]:
        return sorted(r[0] for r in batch.select(PERIOD).distinct().collect())

    def with_period(self, batch: DataFrame, table: str) -> DataFrame:
        return batch.withColumn(PERIOD, self._period(table))

    def rows_to_insert(self, table: str, batch: DataFrame, order: list[str]) -> DataFrame:
        """New rows of ``batch``, which may carry further columns; all of it for a table without a key."""
        self._check(table)
        keys = self.keys[table]
        if not keys:
            return batch
        dated = self.with_period(batch, table)
        return load.rows_to_insert(self.load_slice(table, dated), dated, [PERIOD, *keys], order).drop(PERIOD)

    def append(
        self, table: str, rows: DataFrame, load_id: str, content: str | None = None, finished: frozenset[str] = frozenset()
    ) -> DataFrame | None:
        """Add ``rows``; columns are matched by name, what the table does not declare is left out.

        Run again with the same ``load_id`` it does not add the rows of an unkeyed table twice. ``content`` names a column that says which file
        content a row of an unkeyed table is from: rows of a content that another load has brought by then are left out, unless that load
        is one of ``finished``, which the caller knew of. The contents left out are returned, None if there are none.
        """
        keys, layout = self.keys[table], self.schemas[table]
        if not keys and content is not None:
            rows, layout = rows.withColumnRenamed(content, CONTENT), T.StructType([*layout.fields, T.StructField(CONTENT, T.StringType())])
        declared = load.append(self.spark.createDataFrame([], layout), rows)
        if not keys and content is None:
            self._write(table, lambda version: (declared.withColumn(LOAD, F.lit(load_id)), [load_id]))
            return None
        if not keys:
            taken: list[DataFrame | None] = []

            def not_brought(version: Version) -> tuple[DataFrame, list[str]]:
                held = self._held(table, version)
                loads = set() if held is None else {r[0] for r in held.select(LOAD).distinct().collect()}
                others = loads - finished - {load_id}
                taken.append(held.filter(F.col(LOAD).isin(*others)).select(CONTENT).distinct() if others else None)
                left = declared.join(taken[-1], CONTENT, "left_anti") if others else declared
                return left.withColumn(LOAD, F.lit(load_id)), [load_id]

            self._write(table, not_brought)
            return taken[-1]
        dated, compared = self.with_period(declared, table), self._compared.pop(table, None)

        def still_new(version: Version) -> tuple[DataFrame, list[str]]:
            if compared is None or compared == len(version.writes):
                return dated, []
            # What others wrote since the batch was compared with the table holds some of its keys, maybe.
            later = self._rows(table, version, compared)
            return load.rows_to_insert(later, dated, [PERIOD, *keys], keys), []

        self._write(table, still_new)
        return None

    def replace(self, table: str, batch: DataFrame, order: list[str]) -> None:
        """Insert or replace by key. Only the periods that the batch brings are written anew; readers see all of it or nothing."""
        keys = self.keys[table]
        if not keys:
            raise ValueError(f"table {table!r} has no key to replace by")
        dated = self.with_period(batch, table)
        periods = self._periods(dated)

        def renewed(version: Version) -> tuple[DataFrame, list[str]]:
            stored = self._rows(table, version)
            touched = stored.filter(F.col(PERIOD).isin(*periods)) if periods else stored.limit(0)
            return load.insert_or_replace(touched, dated, [PERIOD, *keys], order), periods

        self._write(table, renewed)
