"""Registered queries on loads, ledger and outcomes: name -> (Spark query, the same as SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.functions import content_hash
from sievemill.operators import ledger, load, outcomes, quality
from sievemill.plans.catalog_quality import DAILY_REASON, DAILY_ROWS, daily_rows, table
from sievemill.plans.ingest import check_rows, member_facts
from sievemill.registry import build_registry
from sievemill.session import fill_cores, shared_folder, write_and_reread

# --- loads: the history up to 1998 is in the table, the whole of it is delivered again --------------------------------

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
LOADED_UNTIL = "1998-01-01"
COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def staged(df: DataFrame) -> DataFrame:
    """The rows as a written table, for queries that go over them several times, as a run does."""
    spark = df.sparkSession
    return write_and_reread(df, shared_folder(spark, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"))


def delivery(spark, sf):
    return table(spark, sf, "lineitem")


def loaded(spark, sf):
    history = delivery(spark, sf).filter(F.col("l_shipdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    return load.first_per_key(history, KEYS, ORDER)


def _ranked(condition: str, direction: str = "") -> str:
    order = ", ".join(f"{c} {direction}" for c in ORDER)
    return f"""SELECT {COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order})
        AS rn FROM lineitem WHERE {condition}) WHERE rn = 1"""


LOADED = f"({_ranked(f'''l_shipdate < TIMESTAMP '{LOADED_UNTIL}' ''')})"
FIRSTS = f"({_ranked('true')})"
LASTS = f"({_ranked('true', 'DESC')})"
INSERTED = f"(SELECT * FROM {FIRSTS} f WHERE NOT EXISTS (SELECT 1 FROM {LOADED} t WHERE t.l_orderkey = f.l_orderkey AND t.l_linenumber = f.l_linenumber))"
AFTER_LOAD = f"SELECT * FROM {LOADED} UNION ALL SELECT * FROM {INSERTED}"


def ignore_conflict(spark, sf):
    return load.insert_if_absent(loaded(spark, sf), delivery(spark, sf), KEYS, ORDER)


def batch_dedupe(spark, sf):
    return load.first_per_key(delivery(spark, sf), KEYS, ORDER)


def idempotent_rerun(spark, sf):
    once = staged(load.insert_if_absent(staged(loaded(spark, sf)), delivery(spark, sf), KEYS, ORDER))
    return load.insert_if_absent(once, delivery(spark, sf), KEYS, ORDER)


def replace_conflict(spark, sf):
    return load.insert_or_replace(loaded(spark, sf), delivery(spark, sf), KEYS, ORDER)


def plain_append(spark, sf):
    """A delivery with its columns in another order and one of them missing."""
    batch = delivery(spark, sf).drop("l_tax")
    return load.append(loaded(spark, sf), batch.select(*reversed(batch.columns)))


def statistics(spark, sf):
    batch = delivery(spark, sf)
    return load.load_statistics(batch, load.rows_to_insert(loaded(spark, sf), batch, KEYS, ORDER), "l_returnflag")


STATISTICS = f"""SELECT b.l_returnflag, b.n AS rows_in_source, coalesce(i.n, 0) AS rows_inserted,
      b.n - coalesce(i.n, 0) AS rows_skipped
    FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag) b
    LEFT JOIN (SELECT l_returnflag, count(*) AS n FROM {INSERTED} GROUP BY l_returnflag) i USING (l_returnflag)"""


def allowed_tables(spark, sf):
    """Orders routed to tables by status; rows for a table that is not configured are refused."""
    status = F.col("o_orderstatus")
    routed = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "O", F.lit("fact_daily_ohlc"))
        .when(status == "F", F.lit("fact_weekly_report"))
        .otherwise(F.concat(F.lit("scratch_"), status))
        .alias("table_name"),
    )
    return routed.withColumn("accepted", load.is_allowed(build_registry(), "table_name"))


ALLOWED_TABLES = """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'fact_daily_ohlc' WHEN 'F' THEN 'fact_weekly_report'
      ELSE 'scratch_' || o_orderstatus END AS table_name, o_orderstatus IN ('O', 'F') AS accepted FROM orders"""


def weekly_rows(spark, sf):
    """Orders as weekly position rows; those in progress lack the investor type."""
    return table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("trading_date"),
        F.col("o_orderpriority").alias("product_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("investor_type"),
        (F.floor("o_totalprice") - 200000).cast("bigint").cast("string").alias("long_pos_volume"),
        F.col("o_custkey").cast("string").alias("short_pos_volume"),
    )


def quarantine_union(spark, sf):
    registry = build_registry()
    layout = registry.schemas[registry.quarantine].struct
    _, daily = quality.split_rows(daily_rows(table(spark, sf, "lineitem")), registry.rules["default_daily"], "daily.csv")
    _, weekly = quality.split_rows(weekly_rows(spark, sf), registry.rules["weekly_report"], "weekly.csv")
    in_layout = lambda df: quality.in_quarantine_layout(df, layout)
    return in_layout(daily).unionByName(in_layout(weekly))


def _quarantine_sql() -> str:
    registry = build_registry()
    names = registry.schemas[registry.quarantine].column_names
    daily = {c: c for c in ("trading_date", "product_id", "expiry_month", "close", "volume", "quarantine_reason")}
    weekly = {
        c: c
        for c in ("trading_date", "product_name", "investor_type", "long_pos_volume", "short_pos_volume", "quarantine_reason")
    }
    pick = lambda have, file: ", ".join(
        f"'{file}' AS source_file" if c == "source_file" else have.get(c, f"CAST(NULL AS VARCHAR) AS {c}") for c in names
    )
    return f"""SELECT {pick(daily, 'daily.csv')} FROM (SELECT *, {DAILY_REASON} AS quarantine_reason FROM {DAILY_ROWS})
        WHERE quarantine_reason IS NOT NULL
      UNION ALL
      SELECT {pick(weekly, 'weekly.csv')} FROM (SELECT *, nullif(concat_ws('; ',
          CASE WHEN TRY_CAST(long_pos_volume AS DOUBLE) < 0 THEN 'Column ''long_pos_volume'': is less than 0' END,
          CASE WHEN investor_type IS NULL THEN 'Column ''investor_type'': is null' END), '') AS quarantine_reason
        FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS trading_date, o_orderpriority AS product_name,
            CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS investor_type,
            CAST(CAST(floor(o_totalprice) AS BIGINT) - 200000 AS VARCHAR) AS long_pos_volume,
            CAST(o_custkey AS VARCHAR) AS short_pos_volume FROM orders))
        WHERE quarantine_reason IS NOT NULL"""


# --- ledger ---------------------------------------------------------------------------------------------------------


def event_ledger(spark, sf) -> DataFrame:
    """Events as a ledger: users are files, purchases successes, errors failures, all else skips."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "purchase", F.lit(ledger.SUCCESS)).when(kind == "error", F.lit(ledger.ERROR)).otherwise(F.lit(ledger.SKIPPED))
    )
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("ledger_key"),
        status.alias("status"),
        F.col("props").alias("message"),
        F.col("ts").alias("recorded_at"),
        "event_id",
    )


def ledger_latest(spark, sf):
    return ledger.latest_entries(event_ledger(spark, sf), "recorded_at", "event_id")


LEDGER_LATEST = """SELECT ledger_key, status, message, recorded_at, event_id FROM (
      SELECT CAST(user_id AS VARCHAR) AS ledger_key, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'error'
        ELSE 'skipped' END AS status, props AS message, ts AS recorded_at, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def document_files(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("file_name"), content_hash("text").alias("content_hash"), "doc_id"
    )


def label_ledger(spark, sf) -> DataFrame:
    """Labelled documents were handled before: good ones with success, the others in error."""
    labels = table(spark, sf, "labels")
    status = F.when(F.col("quality") == 1, F.lit(ledger.SUCCESS)).otherwise(F.lit(ledger.ERROR))
    return document_files(spark, sf).join(labels, "doc_id").select(
        ledger.ledger_key(status, "content_hash", "file_name").alias("ledger_key"), status.alias("status")
    )


def skip_processed(spark, sf):
    return ledger.files_to_ingest(document_files(spark, sf), label_ledger(spark, sf))


SKIP_PROCESSED = """SELECT source || '/' || doc_id AS file_name, sha256(text) AS content_hash, doc_id FROM documents
    WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id) WHERE quality = 1)"""


def backfill(spark, sf):
    """A backfill takes known contents again; the load still adds only keys that the table lacks."""
    files = ledger.files_to_ingest(document_files(spark, sf), label_ledger(spark, sf), ledger.BACKFILL)
    there = files.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    target = load.first_per_key(there.select(*files.columns), ["content_hash"], ["doc_id"])
    return load.rows_to_insert(target, files, ["content_hash"], ["doc_id"])


BACKFILL = """WITH f AS (SELECT source || '/' || doc_id AS file_name, sha256(text) AS content_hash, doc_id FROM documents)
    SELECT file_name, content_hash, doc_id FROM (
      SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) AS rn FROM f
      WHERE content_hash NOT IN (SELECT content_hash FROM f JOIN labels USING (doc_id))) WHERE rn = 1"""


# --- outcomes: orders as rows of files; priorities are archives and order statuses their members --------------------


def order_rows(spark, sf) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    archived = priority != "5-LOW"
    is_member = lambda p, s: (priority == p) & (status == s)
    price = F.col("o_totalprice")
    file_name = F.when(archived, priority).otherwise(F.concat_ws("-", priority, status))
    columns = {
        "file_name": file_name,
        "content_hash": content_hash(file_name),
        "is_archive": archived,
        "member_no": F.when(archived & (status == "F"), 1).when(archived & (status == "P"), 2).otherwise(0),
        "display_name": F.concat_ws("/", file_name, F.when(archived, status)),
        "n_bytes": F.when(is_member("3-MEDIUM", "O"), 0).otherwise(100).cast("bigint"),
        "encoding": F.lit("utf-8"),
        "error": F.when(is_member("1-URGENT", "P"), F.lit("damaged member")),
        "decode_error": F.when(is_member("2-HIGH", "P"), F.lit("no supported encoding fits")),
        "schema_name": F.when(is_member("4-NOT SPECIFIED", "F"), F.lit("weekly_report")).when(
            priority != "4-NOT SPECIFIED", F.lit("default_daily")
        ),
        "has_columns": ~is_member("1-URGENT", "F"),
        "has_target": ~is_member("5-LOW", "F"),
        "row_no": F.lit(0).cast("bigint"),
        "too_long": price > 480000,
        "trading_date": F.date_format("o_orderdate", "yyyy/M/d"),
        "product_id": F.col("o_custkey").cast("string"),
        "close": F.when(~is_member("3-MEDIUM", "P"), price.cast("decimal(18,2)").cast("string")),
        "volume": F.when(is_member("2-HIGH", "F"), F.lit("-1")).when(price < 50000, F.lit("-5")).otherwise(F.lit("10")),
    }
    registry = build_registry()
    absent = [c for c in registry.text_columns if c not in columns]
    return fill_cores(table(spark, sf, "orders"), "o_orderkey").select(
        "o_orderkey",
        *[v.alias(n) for n, v in columns.items()],
        *[F.lit(None).cast("string").alias(c) for c in absent],
    )


ORDER_ROWS = """(SELECT *, CASE WHEN schema_name = 'weekly_report'
        THEN 'Column ''product_name'': is null; Column ''investor_type'': is null'
      WHEN schema_name IS NULL THEN NULL
      ELSE nullif(concat_ws('; ', CASE WHEN volume < 0 THEN 'Column ''volume'': is less than 0' END,
        CASE WHEN close IS NULL THEN 'Column ''close'': is null' END), '') END AS reason
    FROM (SELECT o_orderkey, o_orderpriority AS p, o_orderstatus AS s, o_custkey AS product_id,
      CASE WHEN p = '5-LOW' THEN p || '-' || s ELSE p END AS file_name, p <> '5-LOW' AS is_archive,
      CASE WHEN p = '5-LOW' OR s = 'O' THEN 0 WHEN s = 'F' THEN 1 ELSE 2 END AS member_no,
      CASE WHEN p = '5-LOW' THEN p || '-' || s ELSE p || '/' || s END AS display_name,
      CASE WHEN p = '3-MEDIUM' AND s = 'O' THEN 0 ELSE 100 END AS n_bytes,
      CASE WHEN p = '1-URGENT' AND s = 'P' THEN 'damaged member' END AS error,
      CASE WHEN p = '2-HIGH' AND s = 'P' THEN 'no supported encoding fits' END AS decode_error,
      CASE WHEN p = '4-NOT SPECIFIED' AND s = 'F' THEN 'weekly_report' WHEN p <> '4-NOT SPECIFIED' THEN 'default_daily' END
        AS schema_name,
      NOT (p = '5-LOW' AND s = 'F') AS has_target, NOT (p = '1-URGENT' AND s = 'F') AS has_columns, o_totalprice > 480000 AS too_long,
      strftime(o_orderdate, '%Y-%m-%d') AS trading_date,
      CASE WHEN NOT (p = '3-MEDIUM' AND s = 'P') THEN o_totalprice END AS close,
      CASE WHEN p = '2-HIGH' AND s = 'F' THEN -1 WHEN o_totalprice < 50000 THEN -5 ELSE 10 END AS volume
      FROM orders))"""

MEMBER_FACTS = f"""(SELECT *, CASE
        WHEN schema_name = 'weekly_report' THEN 'product_name, investor_type, long_pos_volume, short_pos_volume'
        WHEN schema_name = 'default_daily' AND filled_close = 0 THEN 'close' END AS missing_required
    FROM (SELECT file_name, is_archive, member_no, display_name, n_bytes, error, decode_error, schema_name, has_columns, has_target,
        count(close) FILTER (NOT too_long) AS filled_close,
        count(*) FILTER (NOT too_long) AS rows_found, count(*) FILTER (NOT too_long AND reason IS NULL) AS valid,
        count(*) FILTER (NOT too_long AND reason IS NOT NULL) AS bad
      FROM {ORDER_ROWS}
      GROUP BY file_name, is_archive, member_no, display_name, n_bytes, error, decode_error, schema_name, has_columns, has_target))"""

NO_MATCH = outcomes.no_match(build_registry().schemas)

PARSED_MEMBERS = f"""(SELECT *, CASE WHEN parse_reason IS NULL THEN 'success'
        WHEN parse_reason IN ('file is empty', '{NO_MATCH}') THEN 'skipped' ELSE 'error' END AS parse_status
    FROM (SELECT *, CASE WHEN error IS NOT NULL THEN error WHEN n_bytes = 0 THEN 'file is empty'
        WHEN schema_name IS NULL THEN '{NO_MATCH}' WHEN decode_error IS NOT NULL THEN decode_error
        WHEN rows_found = 0 THEN 'no data rows' WHEN NOT has_columns THEN 'no columns declared for schema ' || schema_name
        WHEN NOT has_target THEN 'no header name belongs to schema ' || schema_name
        WHEN missing_required IS NOT NULL THEN 'required columns are empty: ' || missing_required END AS parse_reason
      FROM {MEMBER_FACTS}))"""

MEMBERS = f"""(SELECT file_name, is_archive, member_no, display_name, n_bytes, parse_status,
      CASE WHEN parse_status = 'success' AND valid = 0 THEN 'error' ELSE parse_status END AS status,
      CASE WHEN parse_status = 'success' AND valid = 0 THEN 'all rows quarantined' ELSE parse_reason END AS reason,
      CASE WHEN parse_status = 'success' THEN rows_found ELSE 0 END AS rows_source,
      CASE WHEN parse_status = 'success' THEN valid ELSE 0 END AS rows_valid,
      CASE WHEN parse_status = 'success' THEN bad ELSE 0 END AS rows_quarantined FROM {PARSED_MEMBERS})"""

FILES = f"""(SELECT file_name, is_archive, members, members_loaded, rows_source, rows_valid, rows_quarantined,
      CASE WHEN members_loaded > 0 THEN 'success' WHEN is_archive THEN 'error' ELSE only_status END AS status,
      CASE WHEN members_loaded > 0 THEN rows_valid || ' rows valid, ' || rows_quarantined || ' rows quarantined'
        WHEN is_archive AND members > 1 THEN 'no member could be loaded, ' || rows_quarantined || ' rows quarantined'
        ELSE only_reason END AS message
    FROM (SELECT file_name, bool_or(is_archive) AS is_archive, count(*) AS members,
      count(*) FILTER (status = 'success') AS members_loaded, CAST(sum(rows_source) AS BIGINT) AS rows_source,
      CAST(sum(rows_valid) AS BIGINT) AS rows_valid, CAST(sum(rows_quarantined) AS BIGINT) AS rows_quarantined,
      max(status) AS only_status, max(reason) AS only_reason FROM {MEMBERS} GROUP BY file_name))"""


def checked_orders(spark, sf):
    """The rules are worked out once; outcomes then go over the written rows, as in a run."""
    return staged(check_rows(order_rows(spark, sf), build_registry()))


def members_of(checked: DataFrame) -> DataFrame:
    registry = build_registry()
    return outcomes.member_outcomes(member_facts(checked, registry), registry.schemas)


def members(spark, sf):
    return members_of(checked_orders(spark, sf))


def files(spark, sf):
    return outcomes.roll_up(members(spark, sf))


def required_columns(spark, sf):
    facts = member_facts(checked_orders(spark, sf), build_registry())
    return facts.select("file_name", "member_no", "schema_name", "missing_required")


def empty_status(spark, sf):
    return members(spark, sf).select("display_name", "n_bytes", "rows_source", "parse_status")


def file_outcome(spark, sf):
    return members(spark, sf).select(
        "file_name", "member_no", "display_name", "parse_status", "status", "reason", "rows_source", "rows_valid", "rows_quarantined"
    )


def archive_rollup(spark, sf):
    return files(spark, sf)


def file_disposition(spark, sf):
    return files(spark, sf).select("file_name", "status", outcomes.disposition("status").alias("disposition"))


LOAD_KEY = ["trading_date", "product_id"]


def loaded_files(spark, sf):
    """File outcomes with the rows that an insert by date and product adds, the earliest order first."""
    checked = checked_orders(spark, sf)
    outcome = staged(members_of(checked))
    good = outcome.filter(F.col("status") == ledger.SUCCESS).select("file_name", "member_no")
    valid = checked.filter(F.col(quality.REASON).isNull() & ~F.col("too_long")).join(good, ["file_name", "member_no"], "left_semi")
    new = load.first_per_key(valid.select("o_orderkey", "file_name", *LOAD_KEY), LOAD_KEY, ["o_orderkey"])
    counts = new.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows_inserted"))
    joined = outcomes.roll_up(outcome).join(counts, "file_name", "left").fillna(0, ["rows_inserted"])
    return joined.withColumn("rows_skipped", F.col("rows_valid") - F.col("rows_inserted"))


LOADED_FILES = f"""(SELECT f.*, coalesce(i.n, 0) AS rows_inserted, f.rows_valid - coalesce(i.n, 0) AS rows_skipped FROM {FILES} f
    LEFT JOIN (SELECT file_name, count(*) AS n FROM (
        SELECT r.file_name, row_number() OVER (PARTITION BY r.trading_date, r.product_id ORDER BY r.o_orderkey) AS rn
        FROM {ORDER_ROWS} r JOIN {MEMBERS} m ON r.file_name = m.file_name AND r.member_no = m.member_no
        WHERE m.status = 'success' AND r.reason IS NULL AND NOT r.too_long)
      WHERE rn = 1 GROUP BY file_name) i ON f.file_name = i.file_name)"""


def _counters(group: str = "") -> str:
    return f"""SELECT {group} count(*) AS files_processed_total,
      count(*) FILTER (status = 'success') AS files_successfully_parsed_and_validated_loaded,
      count(*) FILTER (rows_quarantined > 0) AS files_with_quarantined_rows,
      count(*) FILTER (status = 'skipped') AS files_skipped_manifest,
      count(*) FILTER (status = 'error') AS files_failed_parsing_or_other_error,
      CAST(sum(rows_source) AS BIGINT) AS rows_source_total_from_parsed_files,
      CAST(sum(rows_inserted) AS BIGINT) AS rows_added_to_main_tables,
      CAST(sum(rows_quarantined) AS BIGINT) AS rows_added_to_quarantine_table,
      CAST(sum(rows_skipped) AS BIGINT) AS rows_skipped_on_load_due_to_conflict FROM {LOADED_FILES}"""


RUN_STATUS = """CASE
      WHEN files_failed_parsing_or_other_error > 0 OR files_with_quarantined_rows > 0
        THEN CASE WHEN files_successfully_parsed_and_validated_loaded > 0 THEN 'PARTIAL_SUCCESS' ELSE 'FAILURE' END
      WHEN files_successfully_parsed_and_validated_loaded > 0 OR files_processed_total = 0 THEN 'SUCCESS'
      ELSE 'UNKNOWN' END"""


def run_report(spark, sf):
    return outcomes.run_counters(loaded_files(spark, sf)).withColumn("status", outcomes.run_status())


RUN_REPORT = f"SELECT *, {RUN_STATUS} AS status FROM ({_counters()})"


def run_status(spark, sf):
    """One run per file: all states occur."""
    runs = outcomes.run_counters(loaded_files(spark, sf), "file_name").withColumn("status", outcomes.run_status())
    return runs.select("file_name", "status")


def report_to_json(spark, sf):
    return outcomes.as_json(run_report(spark, sf).select("status", "files_processed_total", "rows_added_to_main_tables"))


QUERIES = {
    "load_ignore_conflict": (ignore_conflict, AFTER_LOAD),
    "load_batch_dedupe": (batch_dedupe, f"SELECT * FROM {FIRSTS}"),
    "load_idempotent_rerun": (idempotent_rerun, AFTER_LOAD),
    "load_replace_conflict": (replace_conflict, f"SELECT * FROM {LASTS}"),
    "load_append": (
        plain_append,
        f"SELECT * FROM {LOADED} UNION ALL SELECT {COLUMNS.replace('l_tax', 'CAST(NULL AS DOUBLE) AS l_tax')} FROM lineitem",
    ),
    "load_stats": (statistics, STATISTICS),
    "load_allowed_tables": (allowed_tables, ALLOWED_TABLES),
    "quarantine_union_schema": (quarantine_union, _quarantine_sql()),
    "ledger_latest": (ledger_latest, LEDGER_LATEST),
    "ledger_skip_processed": (skip_processed, SKIP_PROCESSED),
    "ledger_backfill": (backfill, BACKFILL),
    "file_required_columns": (
        required_columns,
        f"SELECT file_name, member_no, schema_name, missing_required FROM {MEMBER_FACTS}",
    ),
    "file_empty_status": (
        empty_status,
        f"SELECT display_name, CAST(n_bytes AS BIGINT) AS n_bytes, rows_source, parse_status FROM {MEMBERS}",
    ),
    "file_outcome": (
        file_outcome,
        f"""SELECT file_name, member_no, display_name, parse_status, status, reason, rows_source, rows_valid, rows_quarantined
            FROM {MEMBERS}""",
    ),
    "archive_rollup": (archive_rollup, f"SELECT * FROM {FILES}"),
    "file_disposition": (
        file_disposition,
        f"""SELECT file_name, status, CASE status WHEN 'success' THEN 'processed' WHEN 'skipped' THEN 'skipped'
            ELSE 'quarantine' END AS disposition FROM {FILES}""",
    ),
    "run_report": (run_report, RUN_REPORT),
    "run_status": (
        run_status,
        f"SELECT file_name, {RUN_STATUS} AS status FROM ({_counters('file_name,')} GROUP BY file_name)",
    ),
    "report_to_json": (
        report_to_json,
        f"""SELECT '{{"status":"' || status || '","files_processed_total":' || files_processed_total
            || ',"rows_added_to_main_tables":' || rows_added_to_main_tables || '}}' AS report FROM ({RUN_REPORT})""",
    ),
}
