"""The whole run: files in, fact tables, quarantine table, ledger and report out.

    files -> hash -> ledger -> unzip, decode, cut into records               (task-side, one pass; large plain files in splits)
          -> schema by keyword, header to positions                          (once per chunk)
          -> fields, canonical columns, rules                                (once per row, one projection)
          -> staged table -> verdict per file -> facts and quarantine -> outcomes -> ledger, report

Parsed rows are written once to the shared folder: the verdict, each fact table and the quarantine table then read
only the columns and the schema partition they need, and a lost executor costs a re-read, not a re-parse.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.functions import base_name, clean_value, coerce_numeric, csv_fields, local_iso
from sievemill.operators import ledger as led
from sievemill.operators import load, normalize, outcomes, quality
from sievemill.operators.tables import CONTENT, LEDGER_TABLE, Warehouse
from sievemill.registry import Registry, SchemaSpec, build_registry
from sievemill.session import shared_folder, write_and_reread
from sievemill.sources import split_scan
from sievemill.sources.files import hash_files, is_hidden, list_files, only_targets, with_empty_files, with_hidden_files
from sievemill.sources.members import read_members

IGNORE, REPLACE = "IGNORE", "REPLACE"
ORDER = ["file_name", "member_no", "row_no"]
MEMBER = ["file_name", "member_no"]
FILE_FACTS = [
    "file_name", "content_hash", "is_archive", "member_no", "display_name", "n_bytes", "encoding", "error",
    "decode_error", "schema_name", "has_columns", "has_target",
]
NO_SCHEMA = "_none"


def _per_schema(registry: Registry, name: str, make) -> Column:
    """``make(spec)`` of the schema a row belongs to, NULL for none."""
    result = None
    for spec in registry.data_schemas:
        branch = make(spec)
        result = F.when(F.col(name) == spec.name, branch) if result is None else result.when(F.col(name) == spec.name, branch)
    return result if result is not None else F.lit(None)


def recognise(chunks: DataFrame, registry: Registry) -> DataFrame:
    """Schema and header facts of each chunk, all derived from the head of its file."""
    header = normalize.normalized_header(csv_fields("header"))
    named = chunks.withColumns({"schema_name": normalize.match_schema("head", registry), "names": header})
    return named.withColumns(
        {
            "has_columns": F.coalesce(_per_schema(registry, "schema_name", lambda s: F.lit(bool(s.columns))), F.lit(False)),
            "has_target": F.coalesce(
                _per_schema(registry, "schema_name", lambda s: normalize.has_any_column("names", s)), F.lit(False)
            ),
            "positions": _per_schema(
                registry, "schema_name", lambda s: normalize.header_positions("names", s, registry.text_columns)
            ),
            "width": F.size("names"),
        }
    )


def fields_of_records(recognised: DataFrame) -> DataFrame:
    """One row per record with its fields, and one without for files that have no record."""
    exploded = recognised.select(
        *FILE_FACTS, "positions", "width", "first_row", F.posexplode_outer("records").alias("_at", "record")
    )
    fielded = exploded.select(
        *FILE_FACTS,
        "positions",
        "width",
        (F.col("first_row") + F.col("_at")).alias("row_no"),
        csv_fields("record").alias("_fields"),
    )
    return fielded.withColumn("too_long", F.coalesce(F.size("_fields") > F.col("width"), F.lit(False)))


def parse_rows(fielded: DataFrame, registry: Registry) -> DataFrame:
    """Rows with the text columns of all schemas.

    Records longer than the header are kept as a mark only; shorter ones are filled up with NULL.
    """
    fielded = fielded.withColumn("_fields", F.when(~F.col("too_long"), F.col("_fields")))
    # Picking and cleaning are two projections: the value of a field is then worked out once, not at every use.
    picked = fielded.select(
        *FILE_FACTS,
        "row_no",
        "too_long",
        *[
            normalize.pick_value("_fields", "positions", index).alias(name)
            for index, name in enumerate(registry.text_columns)
        ],
    )
    cleaned = {}
    for spec in registry.data_schemas:
        for c in spec.columns:
            if c.clean:
                before = cleaned.get(c.name, F.col(c.name))
                mine = F.col("schema_name") == spec.name
                cleaned[c.name] = F.when(mine, clean_value(c.name, c.clean)).otherwise(before)
    cleaned["source"] = normalize.source_tag("schema_name", registry)
    return picked.withColumns(cleaned)


def check_rows(parsed: DataFrame, registry: Registry, check_types: bool = True) -> DataFrame:
    """Adds the quarantine reason under the rules of each row's schema."""

    numeric = dict.fromkeys(
        c.name for s in registry.data_schemas for c in s.columns if c.db_type in ("DOUBLE", "BIGINT")
    )
    ranged = dict.fromkeys(
        name
        for rules in registry.rules.values()
        for name, rule in rules.items()
        if name in parsed.columns and ("min_value" in rule or "max_value" in rule)
    )
    numbers = {name: F.col(f"_number_{name}") for name in {**ranged, **(numeric if check_types else {})}}
    # Each number is parsed once, ahead of the checks that look at it.
    counted = parsed.withColumns({f"_number_{name}": coerce_numeric(name) for name in numbers})

    def reason(spec: SchemaSpec) -> Column:
        rules = registry.rules.get(spec.name, {})
        mine = {k: v for k, v in rules.items() if k in spec.column_names}
        for k in rules.keys() - mine.keys():
            quality.log.warning("rule on column %r of schema %r ignored: no such column", k, spec.name)
        reasons = quality.rule_reasons(parsed.schema, mine, numbers)
        if check_types:
            reasons += normalize.cast_failures(spec, rules, numbers)
        return quality.none_if_empty(F.concat_ws("; ", *reasons)) if reasons else F.lit(None).cast("string")

    reasons = _per_schema(registry, "schema_name", reason).cast("string")
    return counted.withColumn(quality.REASON, reasons).select(*parsed.columns, quality.REASON)


def member_facts(checked: DataFrame, registry: Registry) -> DataFrame:
    """What the outcome of each file or archive member hangs on.

    The counts run over all rows with hash aggregation and combine map-side, so a file that holds most of the rows
    does no harm. The texts, which would force a sort, come from the first row and error marks of each member alone.
    """
    is_row = F.col("row_no").isNotNull() & ~F.col("too_long")
    required = list(dict.fromkeys(c for s in registry.data_schemas for c in s.required if c in s.column_names))
    counts = checked.groupBy(*MEMBER).agg(
        F.count_if(is_row).alias("rows_source"),
        F.count_if(F.col("too_long")).alias("rows_too_long"),
        F.count_if(is_row & F.col(quality.REASON).isNull()).alias("rows_valid"),
        F.count_if(is_row & F.col(quality.REASON).isNotNull()).alias("rows_quarantined"),
        *outcomes.filled_counts(required, is_row),
    )
    facts = (
        checked.filter(
            (F.coalesce(F.col("row_no"), F.lit(0)) == 0) | F.col("error").isNotNull() | F.col("decode_error").isNotNull()
        )
        .groupBy(*MEMBER)
        .agg(*[F.max(c).alias(c) for c in FILE_FACTS if c not in MEMBER])
    )
    return (
        facts.join(counts, MEMBER)
        .withColumn("missing_required", outcomes.missing_required(registry, "schema_name"))
        .drop(*[f"filled_{c}" for c in required])
    )


def _contents(files: DataFrame, hashed: DataFrame) -> DataFrame:
    """Contents of the files to ingest. The shorter list decides, so that as a rule its paths can be broadcast and
    the contents stay where they are read."""
    known, new = hashed.agg(F.count_if("known"), F.count_if(~F.col("known"))).first()
    if known < new:
        return files.join(hashed.filter("known").select("path"), "path", "left_anti")
    return files.join(hashed.filter("NOT known").select("path"), "path", "left_semi")


def read_large(large: DataFrame, scratch: str) -> DataFrame:
    """Chunks of records of surveyed files: plain ones in splits, archives and files of endless lines each by one task."""
    large = large.withColumn("in_splits", F.col("in_splits") & ~is_hidden(F.col("file_name")))
    opened = split_scan.read_opened(large.filter("error IS NULL AND NOT in_splits")).repartition("path", "member_no", "chunk_no")
    failed = large.filter("error IS NOT NULL").select("path", "content_hash", F.lit(False).alias("is_archive"), F.lit(0).alias("member_no"), F.col("length").alias("n_bytes"), "error")
    chunks = opened.unionByName(failed, allowMissingColumns=True)
    in_splits = large.filter("error IS NULL AND in_splits")
    if in_splits.isEmpty():
        return chunks
    return chunks.unionByName(split_scan.read_splits(in_splits, scratch), allowMissingColumns=True)


def mark_copies(hashed: DataFrame) -> DataFrame:
    """Adds ``same_as``: the first file of the run with the same content, for all others of it; a content is loaded once.

    Empty files are no copies of each other. What is marked stays out like what was ingested before."""
    open_ = hashed.filter(~F.col("known") & (F.col("length") > 0))
    first = open_.groupBy("content_hash").agg(F.min("file_name").alias("first_name"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").drop("n")
    copy = ~F.col("known") & (F.col("length") > 0) & (F.col("file_name") != F.col("first_name"))
    marked = hashed.join(first, "content_hash", "left").withColumn("same_as", F.when(copy, F.col("first_name")))
    return marked.withColumn("known", F.col("known") | F.col("same_as").isNotNull()).drop("first_name")


@dataclass
class IngestRun:
    """Tables describing a finished run."""

    run_id: str
    members: DataFrame
    files: DataFrame
    report: DataFrame


def ingest_files(
    spark: SparkSession,
    files: DataFrame,
    warehouse: Warehouse,
    *,
    mode: str = led.NORMAL,
    conflict: str = IGNORE,
    run_id: str | None = None,
    check_types: bool = True,
    spread_above: int = 16 << 20,
    split_above: int = 256 << 20,
    time_zone: str = "Asia/Taipei",
) -> IngestRun:
    """Ingest ``files`` (``path, file_name, length, content``) into the tables of ``warehouse``.

    Rows, encodings, errors and identity of a file do not depend on its size. Files up to ``split_above`` bytes are read whole in one task, as a
    stream; the records of those larger than ``spread_above`` are shuffled to more tasks once they are cut. Larger files are opened by path,
    and plain ones among them read in splits by many tasks, quoted line breaks and all encodings included. Of files
    with the same content the first by name is loaded. To resume a run that broke off, call it again with the same ``run_id``. Of runs at the
    same time that bring the same content, one loads its rows, also where the table has no key: the others skip them.
    """
    if conflict not in (IGNORE, REPLACE):
        raise ValueError(f"unknown conflict strategy {conflict!r}")
    registry = warehouse.registry
    started, clock = dt.datetime.now(dt.timezone.utc), time.perf_counter()
    may_resume = run_id is not None
    run_id = run_id or f"exec_{started.astimezone(ZoneInfo(time_zone)):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    scratch = f"{shared_folder(spark, warehouse.root + '/_scratch')}/{run_id}"

    # Loads that end after this are not known from here on; what they bring is found when rows are added.
    finished = warehouse.finished_loads()
    ledger = warehouse.read(LEDGER_TABLE)
    if may_resume and (mine := warehouse.contents_of(run_id)) is not None:
        # A resumed run puts its rows in the place of those it added before, so it reads their files again whatever others say of them;
        # what others have of these files in another table stays theirs.
        ledger = ledger.join(mine.withColumnRenamed(CONTENT, "ledger_key"), "ledger_key", "left_anti")
        finished = frozenset()

    # Hashes first, without the contents, so that the join with the ledger moves narrow rows only. Large files are opened by tasks.
    # Hidden files, which Spark's readers would not hand out, are opened by path whatever their size.
    beyond = (F.col("length") > split_above) | (is_hidden(F.col("file_name")) & (F.col("length") > 0))
    hashes = hash_files(files.filter(~beyond))
    large = None
    if not files.filter(beyond).select("path").isEmpty():
        large = write_and_reread(split_scan.survey(files.filter(beyond)), scratch)
        hashes = hashes.unionByName(large.select(*hashes.columns))
    hashed = write_and_reread(mark_copies(led.mark_known(hashes, ledger, mode)), scratch)

    fresh = _contents(files.filter(~beyond), hashed.filter(~beyond))
    # What a large archive holds is spread over the cluster chunk by chunk; all else is parsed where it is unpacked.
    is_large = F.col("length") > spread_above
    large_chunks = read_members(fresh.filter(is_large)).repartition("path", "member_no", "chunk_no")
    chunks = read_members(fresh.filter(~is_large)).unionByName(large_chunks)
    if large is not None:
        chunks = chunks.unionByName(read_large(large.join(hashed.filter("NOT known").select("path"), "path", "left_semi"), scratch), allowMissingColumns=True)
    spread = chunks.withColumn("file_name", base_name("path")).withColumn(
        "display_name", F.concat_ws("/", "file_name", "member")
    )
    fielded = fields_of_records(recognise(spread, registry))
    checked = check_rows(parse_rows(fielded, registry), registry, check_types)
    staged = write_and_reread(
        checked.withColumn("_schema", F.coalesce("schema_name", F.lit(NO_SCHEMA))), scratch, ["_schema"]
    )

    members = write_and_reread(outcomes.member_outcomes(member_facts(staged, registry), registry.schemas), scratch)
    # Refused members are few; their rows are taken out by a small anti-join.
    refused = members.filter(F.col("parse_status") != led.SUCCESS).select(*MEMBER)
    rows = staged.filter(F.col("row_no").isNotNull() & ~F.col("too_long")).join(refused, MEMBER, "left_anti")

    # A backfill takes all files again, whoever has brought them.
    by_content = {"content": CONTENT, "finished": finished} if mode == led.NORMAL else {}
    inserted = []
    by_table: dict[str, list[SchemaSpec]] = {}
    for spec in registry.data_schemas:
        if spec.columns:
            by_table.setdefault(spec.table, []).append(spec)
    for table, specs in by_table.items():
        batch = None
        for spec in specs:
            mine = rows.filter((F.col("_schema") == spec.name) & F.col(quality.REASON).isNull())
            typed = mine.select(*ORDER, F.col("content_hash").alias(CONTENT), *normalize.typed_columns(spec))
            batch = typed if batch is None else batch.unionByName(typed, allowMissingColumns=True)
        if conflict == REPLACE and warehouse.keys[table]:
            new = load.last_per_key(batch, warehouse.keys[table], ORDER)
            new = write_and_reread(new, scratch)
            warehouse.replace(table, new, ORDER)
        else:
            new = write_and_reread(warehouse.rows_to_insert(table, batch, ORDER), scratch)
            taken = warehouse.append(table, new, run_id, **by_content)
            if taken is not None:
                new = new.join(taken, CONTENT, "left_anti")
        inserted.append(new.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows_inserted")))

    quarantine = registry.schemas.get(registry.quarantine)
    if quarantine:
        bad = quality.quarantined_rows(rows, F.col("display_name"))
        layout = T.StructType([*quarantine.struct.fields, T.StructField(CONTENT, T.StringType())])
        laid_out = quality.in_quarantine_layout(bad.withColumn(CONTENT, F.col("content_hash")), layout)
        warehouse.append(quarantine.table, laid_out, run_id, **by_content)

    files_out = outcomes.roll_up(members, ["file_name", "content_hash"])
    per_file = None
    for counts in inserted:
        per_file = counts if per_file is None else per_file.unionByName(counts)
    if per_file is None:
        files_out = files_out.withColumn("rows_inserted", F.lit(0).cast("bigint"))
    else:
        totals = per_file.groupBy("file_name").agg(F.sum("rows_inserted").alias("rows_inserted"))
        files_out = files_out.join(totals, "file_name", "left").fillna(0, ["rows_inserted"])
    message = F.coalesce(F.concat(F.lit("same content as "), "same_as"), F.lit("already ingested"))
    already = hashed.filter("known").select("file_name", "content_hash", F.lit(led.SKIPPED).alias("status"), message.alias("message"))
    files_out = files_out.unionByName(already, allowMissingColumns=True).fillna(
        0, ["members", "members_loaded", "rows_source", "rows_valid", "rows_quarantined", "rows_inserted"]
    )
    files_out = files_out.withColumns(
        {"rows_skipped": F.col("rows_valid") - F.col("rows_inserted"), "disposition": outcomes.disposition("status")}
    )
    files_out = write_and_reread(files_out, scratch)

    ended = dt.datetime.now(dt.timezone.utc)
    report = outcomes.run_counters(files_out).withColumn("status", outcomes.run_status())
    at = lambda t: local_iso(F.lit(t.replace(tzinfo=None).isoformat(" ")), time_zone)
    report = outcomes.with_clock(report, run_id, at(started), at(ended), time.perf_counter() - clock)
    # The ledger comes last: a run that breaks off before is simply run again.
    news = files_out.filter(F.coalesce(F.col("message"), F.lit("")) != "already ingested")
    entries = led.ledger_entries(news, F.lit(ended))
    warehouse.append(LEDGER_TABLE, entries, run_id)
    return IngestRun(run_id, members, files_out, report)


def ingest_folder(
    spark: SparkSession, folder: str, warehouse_root: str, registry: Registry | None = None, *, targets: str = "",
    find_empty: bool = True, **options
) -> IngestRun:
    """Ingest the files of one folder, or those of them named in ``targets``.

    Reporting files of zero bytes takes the names of all files to the driver; leave it out for millions of files.
    """
    warehouse = Warehouse(spark, warehouse_root, registry or build_registry())
    files = list_files(spark, folder)
    if find_empty:
        files = with_empty_files(files, folder)
    files = with_hidden_files(files, folder)
    return ingest_files(spark, only_targets(files, targets), warehouse, **options)
