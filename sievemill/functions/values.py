"""Scalar functions on text values. All are plain Column expressions and stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievemill.registry import SPARK_TYPES

# Fields a CSV reader takes for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Trimmed texts that mean "no value" in a volume column.
VOLUME_NULL_TOKENS = ("--", "", "None", "nan", "NaN")

# Accepted shapes of numbers and dates.
NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_SHAPE = r"^\s*[+-]?\d{1,19}\s*$"
DATE_SHAPE = r"^\d{4}(/\d{1,2}/|-\d{1,2}-)\d{1,2}$"

# What counts as white space around names and volumes, whatever the script.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sql_text(text: str) -> str:
    """A text as a SQL literal, for expressions that are long enough to be better built as SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_or_null(col: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """The text as it stands, NULL where it is one of ``tokens``."""
    col = _c(col)
    return F.when(~col.isin(*tokens), col)


def strip(col: Column | str) -> Column:
    return F.btrim(_c(col), F.lit(WHITE_SPACE))


def null_if_token(col: Column | str, tokens: Iterable[str] = VOLUME_NULL_TOKENS) -> Column:
    """Trimmed text, NULL where it is one of ``tokens``."""
    trimmed = strip(col)
    return F.when(~trimmed.isin(*tokens), trimmed)


def strip_thousands(col: Column | str) -> Column:
    return F.replace(_c(col), F.lit(","), F.lit(""))


def coerce_numeric(col: Column | str) -> Column:
    """Text to double; anything that is not written as a plain number becomes NULL.

    A bare cast would also take ``1.5d``, ``NaN`` and ``Infinity``, so the shape is checked first.
    """
    col = _c(col)
    return F.when(col.rlike(NUMBER_SHAPE), F.trim(col).try_cast("double"))


def _written_integer(text: Column) -> Column:
    # Digits only: a failed cast raises and catches an exception inside Spark, once per value.
    return F.when(text.rlike(INTEGER_SHAPE), F.trim(text).try_cast("bigint"))


def fits_bigint(text: Column | str, number: Column) -> Column:
    """Whether a text with numeric value ``number`` is a whole number in the range of bigint."""
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(9.223372036854775e18))
    return whole | _written_integer(_c(text)).isNotNull()


def coerce_integer(col: Column | str) -> Column:
    """Text to bigint. ``100.0`` is 100, ``1.5`` is NULL, and integers beyond 2^53 keep every digit."""
    col = _c(col)
    number = coerce_numeric(col)
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(9.223372036854775e18))
    return F.coalesce(_written_integer(col), F.when(whole, number.try_cast("bigint")))


def parse_date(col: Column | str) -> Column:
    """Year, month and day parted by slashes or hyphens; one- and two-digit months and days are the same.

    The shape is checked and the text cast, as formatter functions raise and catch an exception per text that does
    not fit, which costs far more than all the rest.
    """
    text = F.trim(_c(col))
    return F.when(text.rlike(DATE_SHAPE), F.translate(text, "/", "-").try_cast("date"))


def cast_declared(col: Column | str, db_type: str) -> Column:
    """Text to the Spark type declared for a column, NULL where it does not fit."""
    col = _c(col)
    if db_type == "VARCHAR":
        return col
    convert = {"DATE": parse_date, "DOUBLE": coerce_numeric, "BIGINT": coerce_integer}[db_type]
    return convert(col).cast(SPARK_TYPES[db_type])


def clean_value(col: Column | str, steps: Iterable[str]) -> Column:
    """Apply the cleaning steps configured for a column, in order; the result is text."""
    col, steps = _c(col), list(steps)
    for step in steps:
        if step == "null_tokens":
            # No token is a number, so where numbers are asked for the tokens need no look of their own.
            col = strip(col) if "numeric" in steps else null_if_token(col)
        elif step == "thousands":
            col = strip_thousands(col)
        elif step == "numeric":
            # Keep the digits as written, drop what is no number.
            col = F.when(col.rlike(NUMBER_SHAPE), F.trim(col))
        else:
            raise ValueError(f"unknown cleaning step {step!r}")
    return col


def normalize_header(col: Column | str) -> Column:
    """Header name without surrounding white space, in lower case."""
    return F.lower(strip(col))


def strip_bom(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), "^\\x{FEFF}", "")


def base_name(path: Column | str) -> Column:
    """What follows the last slash."""
    return F.substring_index(_c(path), "/", -1)


def content_hash(col: Column | str) -> Column:
    return F.sha2(_c(col), 256)


def local_iso(utc: Column | str, zone: str = "Asia/Taipei") -> Column:
    """A UTC time without zone as ISO-8601 text in ``zone``; microseconds are left out when zero.

    The session's time zone plays no part.
    """
    utc = _c(utc).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    minutes = F.timestamp_diff("MINUTE", utc, local).cast("int")
    offset = F.format_string(
        "%s%02d:%02d",
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.floor(F.abs(minutes) / 60).cast("int"),
        F.abs(minutes) % 60,
    )
    whole = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(local, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), offset)
