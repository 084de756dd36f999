"""Registered queries on files, records, headers and schemas: name -> (Spark query, the same as SQL or None)."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.functions import base_name, cast_declared, content_hash, csv_fields, csv_line
from sievemill.operators import normalize
from sievemill.operators.tables import Warehouse
from sievemill.plans.catalog_quality import table
from sievemill.registry import ColumnSpec, Registry, SchemaSpec, build_registry
from sievemill.operators import load
from sievemill.session import fill_cores, shared_folder, write_and_reread
from sievemill.sources import split_scan
from sievemill.sources.files import list_files, only_targets
from sievemill.sources.members import read_members

BOM = "\ufeff"


# --- documents as files ---------------------------------------------------------------------------------------------


def documents(spark, sf) -> DataFrame:
    return fill_cores(table(spark, sf, "documents"), "doc_id")


def document_files(spark, sf, text) -> DataFrame:
    """Every document as the content of one file named by its id."""
    return documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("path"), F.encode(text, "UTF-8").alias("content")
    )


def records_of(members: DataFrame) -> DataFrame:
    """One row per record of each file, with its fields."""
    rows = members.select(
        F.col("path").cast("bigint").alias("doc_id"), "header", "first_row", F.posexplode("records").alias("_at", "record")
    )
    return rows.select(
        "doc_id", "header", (F.col("first_row") + F.col("_at")).alias("row_no"), csv_fields("record").alias("_fields")
    )


DOCUMENT = SchemaSpec(
    "document",
    "documents",
    (
        ColumnSpec("language", aliases=("lang",)),
        ColumnSpec("text"),
        ColumnSpec("n_chars", "BIGINT", aliases=("characters",)),
    ),
)


def csv_parse(spark, sf):
    """Documents written as CSV files, line breaks and quotes included, and read again by their header."""
    content = F.concat(
        F.lit("Characters, TEXT ,Lang\r\n"), csv_line(F.col("n_chars").cast("string"), "text", "lang"), F.lit("\r\n")
    )
    rows = records_of(read_members(document_files(spark, sf, content)))
    placed = rows.withColumn("names", normalize.normalized_header(csv_fields("header"))).select(
        "doc_id", "_fields", normalize.header_positions("names", DOCUMENT).alias("positions")
    )
    named = normalize.canonical_columns(placed, "_fields", "positions", DOCUMENT)
    return named.select("doc_id", *normalize.typed_columns(DOCUMENT))


LINES = SchemaSpec("lines", "lines", (ColumnSpec("a"), ColumnSpec("b"), ColumnSpec("c")))


def csv_bad_rows(spark, sf):
    """The raw lines of each document as CSV rows under a header of three: longer rows go, shorter ones are filled up."""
    content = F.concat(F.lit("a,b,c\n"), F.translate("text", '"', "'"))
    rows = records_of(read_members(document_files(spark, sf, content)))
    kept = rows.withColumn("names", normalize.normalized_header(csv_fields("header"))).filter(
        F.size("_fields") <= F.size("names")
    )
    placed = kept.select("doc_id", "row_no", "_fields", normalize.header_positions("names", LINES).alias("positions"))
    return normalize.canonical_columns(placed, "_fields", "positions", LINES)


CSV_BAD_ROWS = """WITH lines AS (
      SELECT doc_id, list_filter(string_split(translate(text, '"', ''''), chr(10)), lambda x: regexp_matches(x, '[^ \\t]'))
        AS ls FROM documents),
    fields AS (
      SELECT doc_id, CAST(row_no AS BIGINT) AS row_no, string_split(line, ',') AS f
      FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS row_no FROM lines))
    SELECT doc_id, row_no, nullif(f[1], '') AS a, nullif(f[2], '') AS b, nullif(f[3], '') AS c FROM fields WHERE len(f) <= 3"""


def bom_strip(spark, sf):
    content = F.concat(F.lit(BOM), F.lit("text\n"), csv_line("text"))
    rows = records_of(read_members(document_files(spark, sf, content)))
    return rows.select("doc_id", "header", F.get("_fields", F.lit(0)).alias("text"))


def decode_charset(spark, sf):
    """Documents with full-width vowels, in Big5 where that can hold them and in UTF-8 otherwise."""

    @F.pandas_udf("binary")
    def legacy_bytes(texts: pd.Series) -> pd.Series:
        def encode(text):
            try:
                return text.encode("big5")
            except UnicodeEncodeError:
                return text.encode("utf-8")

        return texts.map(encode)

    wide = F.translate("text", "aeiou", "ａｅｉｏｕ")
    files = documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("path"), legacy_bytes(F.concat(F.lit("text\n"), csv_line(wide))).alias("content")
    )
    rows = records_of(read_members(files))
    return rows.select("doc_id", F.get("_fields", F.lit(0)).alias("text"))


def zip_expand(spark, sf):
    """Documents packed into archives, those in German damaged, with members that are none of our business."""

    @F.pandas_udf("binary")
    def archive(texts: pd.Series, damaged: pd.Series) -> pd.Series:
        def pack(text, broken):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("note.txt", "text\nignored\n")
                z.writestr("__MACOSX/doc.csv", "text\nignored\n")
                z.writestr("data/doc.CSV", text)
            data = out.getvalue()
            # The directory of an archive starts with this mark; the end record stays, so it is still taken for one.
            return data.replace(b"PK\x01\x02", b"PK\x00\x00") if broken else data

        return pd.Series([pack(t, d) for t, d in zip(texts, damaged)])

    files = documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("path"),
        archive(F.concat(F.lit("text\n"), csv_line("text")), F.col("lang") == "de").alias("content"),
    )
    return read_members(files).select(
        F.col("path").cast("bigint").alias("doc_id"),
        "member",
        F.col("error").isNotNull().alias("damaged"),
        F.get(csv_fields(F.get("records", F.lit(0))), F.lit(0)).alias("text"),
    )


ZIP_EXPAND = """SELECT doc_id, CASE WHEN lang <> 'de' THEN 'data/doc.CSV' END AS member, lang = 'de' AS damaged,
      CASE WHEN lang <> 'de' THEN text END AS text FROM documents"""


def hashes(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        content_hash("text").alias("content_hash"),
        content_hash(F.concat_ws("/", "source", F.col("doc_id").cast("string"))).alias("name_hash"),
    )


def scratch_folder(spark) -> str:
    home = shared_folder(spark, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
    return f"{home}/{uuid.uuid4().hex}"


def large_csv(spark, sf):
    """Documents written as CSV files with quoted line breaks, listed, and read in splits as files beyond any size are."""
    folder = scratch_folder(spark)
    columns = F.col("doc_id").cast("string").alias("doc_id"), "text", "lang"
    documents(spark, sf).select(*columns).write.options(header=True, quoteAll=True, escape='"').csv(f"{folder}/files")
    surveyed = write_and_reread(split_scan.survey(list_files(spark, f"{folder}/files")), folder)
    chunks = split_scan.read_splits(surveyed.filter("in_splits"), folder)
    fields = chunks.select(F.explode("records").alias("record")).select(csv_fields("record").alias("f"))
    return fields.select(F.get("f", F.lit(0)).cast("bigint").alias("doc_id"), F.get("f", F.lit(1)).alias("text"), F.get("f", F.lit(2)).alias("lang"))


# --- listings -------------------------------------------------------------------------------------------------------


def file_listing(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", base_name("url").alias("file_name"), F.octet_length("html").cast("bigint").alias("length")
    )


def folder_listing(spark, sf):
    """The files of the data folder itself, with their hashes, whatever their size."""
    return split_scan.hash_all(list_files(spark, sf), scratch_folder(spark)).select("file_name", "length", "content_hash")


TARGETS = " src1, src7 ,,src19,"


def target_filter(spark, sf):
    files = table(spark, sf, "documents").select("doc_id", F.col("source").alias("file_name"), "n_chars")
    return only_targets(files, TARGETS)


def parquet_scan(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .filter((F.col("l_quantity") < 10) & (F.col("l_returnflag") == "A"))
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


# --- schemas and headers --------------------------------------------------------------------------------------------


def word_registry(fallback: str | None) -> Registry:
    return Registry(
        {
            "german": SchemaSpec("german", "german", keywords=("Schung", "ÜBER", "lichen")),
            "french": SchemaSpec("french", "french", keywords=("Queaux", "tionÉ")),
            "unsearched": SchemaSpec("unsearched", "unsearched"),
            "english": SchemaSpec("english", "english", keywords=("tHeR", "ingand")),
            "other": SchemaSpec("other", "other"),
        },
        fallback=fallback,
    )


MATCHED = """CASE WHEN contains(lower(text), 'schung') OR contains(lower(text), 'über') OR contains(lower(text), 'lichen')
        THEN 'german'
      WHEN contains(lower(text), 'queaux') OR contains(lower(text), 'tioné') THEN 'french'
      WHEN contains(lower(text), 'ther') OR contains(lower(text), 'ingand') THEN 'english' END"""


def match_keywords(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", normalize.match_schema("text", word_registry(None)).alias("schema_name")
    )


def match_fallback(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", normalize.match_schema("text", word_registry("other")).alias("schema_name")
    )


def header_names(spark, sf):
    """Every comma-separated piece of every document as a header name."""
    docs = documents(spark, sf).select("doc_id", normalize.normalized_header(F.split("text", ",")).alias("names"))
    return docs.select("doc_id", F.posexplode("names").alias("position", "name"))


HEADER_NAMES = """SELECT doc_id, CAST(unnest(range(len(names))) AS INTEGER) AS position,
      lower(regexp_replace(unnest(names), '^[\\s\\pZ\\x0B\\x1C-\\x1F\\x85]+|[\\s\\pZ\\x0B\\x1C-\\x1F\\x85]+$', '', 'g')) AS name
    FROM (SELECT doc_id, string_split(text, ',') AS names FROM documents)"""


def daily_spec() -> SchemaSpec:
    return build_registry().schemas["default_daily"]


def rename_aliases(spark, sf):
    """Line items as files, one per return flag, whose headers differ in language and spelling.

    As in a run, the positions of the columns are worked out once per file and not per row.
    """
    spec, flag = daily_spec(), F.col("l_returnflag")
    header = lambda *names: F.array(*[F.lit(n) for n in names])
    files = table(spark, sf, "lineitem").select("l_returnflag").distinct().select(
        "l_returnflag",
        normalize.normalized_header(
            F.when(flag == "A", header("交易日期", "契約代號", " 收盤價", "成交量", "備註"))
            .when(flag == "N", header("日期", "契約", " CLOSE ", "成交口數", "x"))
            .otherwise(header("trading_date", "Product_ID", "close", "　volume", "delta2"))
        ).alias("names"),
    )
    placed = files.select("l_returnflag", normalize.header_positions("names", spec).alias("positions"))
    # Written, so that Spark knows how small the table of files is and broadcasts it; the rows of a file are then not dealt to one task.
    placed = write_and_reread(placed, scratch_folder(spark))
    rows = fill_cores(table(spark, sf, "lineitem"), "l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.array(
            F.date_format("l_shipdate", "yyyy/MM/dd"),
            F.col("l_partkey").cast("string"),
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
            F.format_number(F.col("l_quantity") * 1000, 0),
            F.col("l_linestatus"),
        ).alias("_fields"),
    )
    named = normalize.canonical_columns(rows.join(placed, "l_returnflag"), "_fields", "positions", spec)
    return named.select("l_orderkey", "l_linenumber", "trading_date", "product_id", "close", "volume")


RENAME_ALIASES = """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y/%m/%d') AS trading_date,
      CAST(l_partkey AS VARCHAR) AS product_id, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS close,
      CAST(CAST(l_quantity * 1000 AS BIGINT) AS VARCHAR) AS volume FROM lineitem"""


def reindex_columns(spark, sf):
    """Parts under header names of their own: known ones are renamed, extra ones dropped, missing ones NULL."""
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias(" 契約代號"),
        F.col("p_brand").alias("買賣權 "),
        F.col("p_name").alias("Remark"),
        F.col("p_size").cast("string").alias("VOLUME"),
    )
    spec = daily_spec()
    return normalize.reindex(normalize.rename_by_alias(parts, spec), spec.column_names)


REINDEX_COLUMNS = "SELECT {} FROM part".format(
    ", ".join(
        {
            "product_id": "CAST(p_partkey AS VARCHAR) AS product_id",
            "option_type": "p_brand AS option_type",
            "volume": "CAST(p_size AS VARCHAR) AS volume",
        }.get(c, f"CAST(NULL AS VARCHAR) AS {c}")
        for c in daily_spec().column_names
    )
)


def tagged_sources(spark, sf):
    status = F.col("o_orderstatus")
    schema = F.when(status == "O", F.lit("default_daily")).when(status == "F", F.lit("weekly_report")).otherwise(status)
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("source"), schema.alias("schema"))
    return orders.withColumn("source", normalize.source_tag("schema", build_registry())).drop("schema")


def has_target_columns(spark, sf):
    """Part names as header lines: do they name a column of a schema of sizes?"""
    sizes = SchemaSpec("sizes", "sizes", (ColumnSpec("small", aliases=("Tiny",)), ColumnSpec("extent", aliases=("LARGE", "big"))))
    header = normalize.normalized_header(F.split("p_name", " "))
    return table(spark, sf, "part").select("p_partkey", normalize.has_any_column(header, sizes).alias("has_target"))


CREATED = {"trading_date": "o_orderdate", "product_id": "o_orderkey", "option_type": "o_orderstatus", "close": "o_totalprice"}


def created_from_schema(spark, sf):
    """A fact table made from its declaration, with orders written to it, as it is read back."""
    house = Warehouse(spark, scratch_folder(spark), build_registry())
    spec = daily_spec()
    house.create(spec.table)
    types = {f.name: f.dataType for f in spec.struct.fields}
    rows = table(spark, sf, "orders").select(*[F.col(source).cast(types[name]).alias(name) for name, source in CREATED.items()])
    house.append(spec.table, rows, "orders")
    return house.read(spec.table)


CREATED_FROM_SCHEMA = "SELECT {} FROM orders".format(
    ", ".join(f"CAST({CREATED.get(c.name, 'NULL')} AS {c.db_type}) AS {c.name}" for c in daily_spec().columns)
)


PRICED = ["trading_date", "product_id", "close"]


def versioned_replace(spark, sf):
    """Orders inserted by date and customer, then those still open replaced by key at half their price: two versions of a table."""
    house, spec = Warehouse(spark, scratch_folder(spark), build_registry()), daily_spec()
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("trading_date"), F.col("o_custkey").cast("string").alias("product_id"),
        F.lit("").alias("expiry_month"), F.lit(0.0).alias("strike_price"), F.lit("").alias("option_type"),
        F.col("o_totalprice").alias("close"), "o_orderkey", "o_orderstatus",
    )
    house.append(spec.table, load.first_per_key(orders, house.keys[spec.table], ["o_orderkey"]), "all")
    still_open = orders.filter("o_orderstatus = 'O'").withColumn("close", F.col("close") / 2)
    house.replace(spec.table, still_open, ["o_orderkey"])
    return house.read(spec.table).select(*PRICED)


VERSIONED_REPLACE = """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS trading_date, CAST(o_custkey AS VARCHAR) AS product_id, * FROM orders),
    firsts AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY trading_date, product_id ORDER BY o_orderkey) = 1),
    lasts AS (SELECT * FROM o WHERE o_orderstatus = 'O' QUALIFY row_number() OVER (PARTITION BY trading_date, product_id ORDER BY o_orderkey DESC) = 1)
    SELECT trading_date, product_id, o_totalprice / 2 AS close FROM lasts
    UNION ALL SELECT trading_date, product_id, o_totalprice FROM firsts ANTI JOIN lasts USING (trading_date, product_id)"""


QUERIES = {
    "src_large_csv": (large_csv, "SELECT doc_id, text, lang FROM documents"),
    "load_replace_versions": (versioned_replace, VERSIONED_REPLACE),
    "src_file_listing": (
        file_listing,
        """SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name, octet_length(encode(html)) AS length FROM pages""",
    ),
    "src_folder_listing": (folder_listing, None),
    "src_target_filter": (
        target_filter,
        "SELECT doc_id, source AS file_name, n_chars FROM documents WHERE source IN ('src1', 'src7', 'src19')",
    ),
    "src_zip_expand": (zip_expand, ZIP_EXPAND),
    "src_csv_parse": (csv_parse, "SELECT doc_id, lang AS language, text, n_chars FROM documents"),
    "src_csv_bad_rows": (csv_bad_rows, CSV_BAD_ROWS),
    "src_decode_charset": (
        decode_charset,
        "SELECT doc_id, translate(text, 'aeiou', 'ａｅｉｏｕ') AS text FROM documents",
    ),
    "src_bom_strip": (bom_strip, "SELECT doc_id, 'text' AS header, text FROM documents"),
    "src_parquet_scan": (
        parquet_scan,
        "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity < 10 AND l_returnflag = 'A'",
    ),
    "content_hash": (
        hashes,
        """SELECT doc_id, sha256(text) AS content_hash, sha256(source || '/' || doc_id) AS name_hash FROM documents""",
    ),
    "schema_match_keywords": (match_keywords, f"SELECT doc_id, {MATCHED} AS schema_name FROM documents"),
    "schema_match_fallback": (match_fallback, f"SELECT doc_id, coalesce({MATCHED}, 'other') AS schema_name FROM documents"),
    "header_normalize": (header_names, HEADER_NAMES),
    "rename_aliases": (rename_aliases, RENAME_ALIASES),
    "reindex_columns": (reindex_columns, REINDEX_COLUMNS),
    "tag_source": (
        tagged_sources,
        """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'taifex_daily_csv' WHEN 'F' THEN 'taifex_weekly_csv'
           ELSE 'unknown_source' END AS source FROM orders""",
    ),
    "file_no_target_columns": (
        has_target_columns,
        """SELECT p_partkey, list_has_any(string_split(lower(p_name), ' '), ['small', 'tiny', 'extent', 'large', 'big'])
           AS has_target FROM part""",
    ),
    "sink_create_from_schema": (created_from_schema, CREATED_FROM_SCHEMA),
}
