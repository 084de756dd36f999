from sievemill.functions.csv_text import csv_fields, csv_line, csv_width
from sievemill.functions.values import (
    NULL_TOKENS,
    VOLUME_NULL_TOKENS,
    base_name,
    cast_declared,
    clean_value,
    coerce_integer,
    coerce_numeric,
    content_hash,
    fits_bigint,
    local_iso,
    normalize_header,
    null_if_token,
    parse_date,
    sql_text,
    strip_bom,
    strip_thousands,
    text_or_null,
)

__all__ = [
    "NULL_TOKENS",
    "VOLUME_NULL_TOKENS",
    "base_name",
    "cast_declared",
    "clean_value",
    "coerce_integer",
    "coerce_numeric",
    "content_hash",
    "csv_fields",
    "csv_line",
    "csv_width",
    "fits_bigint",
    "local_iso",
    "normalize_header",
    "null_if_token",
    "parse_date",
    "sql_text",
    "strip_bom",
    "strip_thousands",
    "text_or_null",
]
