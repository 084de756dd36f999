"""From the header and fields of a CSV record to the canonical columns of its schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import (
    NULL_TOKENS,
    cast_declared,
    clean_value,
    coerce_numeric,
    fits_bigint,
    normalize_header,
    parse_date,
    sql_text,
)
from sievemill.registry import Registry, SchemaSpec
from sievemill.registry_values import UNKNOWN_SOURCE_TAG


def normalized_header(header: Column | str) -> Column:
    return F.transform(F.col(header) if isinstance(header, str) else header, normalize_header)


def match_schema(text: Column | str, registry: Registry, use_fallback: bool = True) -> Column:
    """Name of the first schema one of whose keywords occurs in ``text``, whatever the case.

    Without a hit: the fallback schema where the registry has it, else NULL.
    """
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    names = []
    for spec in registry.data_schemas:
        if spec.keywords:
            hits = [F.contains(lowered, F.lit(k.lower())) for k in spec.keywords]
            anywhere = hits[0]
            for hit in hits[1:]:
                anywhere = anywhere | hit
            names.append(F.when(anywhere, F.lit(spec.name)))
    fallback = registry.fallback_name() if use_fallback else None
    return F.coalesce(*names, F.lit(fallback).cast("string"))


def header_positions(header: str, spec: SchemaSpec, columns: Iterable[str] | None = None) -> Column:
    """Where in the array column ``header`` (from 0) each of ``columns`` (default: the declared ones) finds its value.

    A struct of ``first``, one position per column, NULL where the header lacks it, and ``several``, all positions per
    column, which is NULL unless two header names belong to one column. Worked out once per file or chunk, it lets
    every row pick its values by position instead of looking names up.
    """
    names = spec.header_names()

    def found(column: str) -> str:
        positions = [f"int(array_position({header}, {sql_text(n)})) - 1" for n in names.get(column, [])]
        return f"filter(array({', '.join(positions)}), p -> p >= 0)" if positions else "cast(array() AS array<int>)"

    every = f"array({', '.join(found(c) for c in columns or spec.column_names)})"
    # A transform over an array of one binds the positions to a name, so they are worked out once.
    return F.expr(
        f"get(transform(array({every}), every -> struct(transform(every, p -> get(p, 0)) AS first, "
        f"CASE WHEN exists(every, p -> size(p) > 1) THEN every END AS several)), 0)"
    )


def pick_value(fields: str, positions: str, index: int, null_tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Value of the column at ``index`` of the positions: the first usable one where several fields offer one."""
    tokens = ", ".join(map(sql_text, null_tokens))
    usable = lambda value: f"CASE WHEN {value} NOT IN ({tokens}) THEN {value} END"
    single = usable(f"get({fields}, get({positions}.first, {index}))")
    offered = f"transform(get({positions}.several, {index}), p -> get({fields}, p))"
    several = f"get(filter({offered}, v -> v NOT IN ({tokens})), 0)"
    return F.expr(f"CASE WHEN {positions}.several IS NULL THEN {single} ELSE {several} END")


def canonical_columns(df: DataFrame, fields: str, positions: str, spec: SchemaSpec) -> DataFrame:
    """Replaces ``fields`` by the declared columns in declared order as cleaned text.

    Extra fields are dropped, missing ones are NULL. Picking and cleaning are two projections: the value of a field
    is then worked out once, not at every use.
    """
    others = [c for c in df.columns if c not in (fields, positions, *spec.column_names)]
    picked = df.select(*others, *[pick_value(fields, positions, i).alias(n) for i, n in enumerate(spec.column_names)])
    return picked.withColumns({c.name: clean_value(c.name, c.clean) for c in spec.columns if c.clean})


def has_any_column(header: Column | str, spec: SchemaSpec) -> Column:
    """Whether the header names at least one declared column."""
    header = F.col(header) if isinstance(header, str) else header
    names = sorted({n for ns in spec.header_names().values() for n in ns})
    return F.arrays_overlap(header, F.array(*[F.lit(n) for n in names])) if names else F.lit(False)


def source_tag(schema_name: Column | str, registry: Registry) -> Column:
    """Lineage tag of a schema; it always replaces what the file itself says."""
    name = F.col(schema_name) if isinstance(schema_name, str) else schema_name
    tag = F.lit(UNKNOWN_SOURCE_TAG)
    for spec in registry.data_schemas:
        tag = F.when(name == spec.name, F.lit(spec.source_tag)).otherwise(tag)
    return tag


def reindex(df: DataFrame, columns: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Exactly ``columns`` in that order, absent ones as NULL text."""
    return df.select(
        *keep,
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns],
    )


def rename_by_alias(df: DataFrame, spec: SchemaSpec) -> DataFrame:
    """Data already in named columns: trim and lower-case the names, then give aliases their canonical name.

    When several columns land on one name, the first usable value in the order of the aliases is taken.
    """
    present = {}
    for name in df.columns:
        present.setdefault(name.strip().lower(), name)
    renamed, used = [], set()
    for canonical, names in spec.header_names().items():
        sources = [present[n] for n in names if n in present]
        if sources:
            used.update(sources)
            renamed.append(F.coalesce(*[F.col(f"`{s}`") for s in sources]).alias(canonical))
    rest = [F.col(f"`{original}`").alias(n) for n, original in present.items() if original not in used]
    return df.select(*renamed, *rest)


def typed_columns(spec: SchemaSpec) -> list[Column]:
    return [cast_declared(c.name, c.db_type).alias(c.name) for c in spec.columns]


def cast_failures(
    spec: SchemaSpec, rules: Mapping[str, Mapping], numbers: Mapping[str, Column] | None = None
) -> list[Column]:
    """Reasons for texts that their declared type cannot hold; such rows would lose the value silently.

    Columns under a range rule already report texts that are no number. ``numbers`` may name columns that hold the
    numeric value of a text column already.
    """
    reasons = []
    for c in spec.columns:
        rule = rules.get(c.name, {})
        present = F.col(c.name).isNotNull()
        if c.db_type == "VARCHAR":
            continue
        if c.db_type == "DATE":
            failed = present & parse_date(c.name).isNull()
        else:
            number = (numbers or {}).get(c.name)
            number = coerce_numeric(c.name) if number is None else number
            if "min_value" in rule or "max_value" in rule:
                present = number.isNotNull()
            failed = present & number.isNull()
            if c.db_type == "BIGINT":
                failed = present & ~F.coalesce(fits_bigint(c.name, number), F.lit(False))
        reasons.append(F.when(failed, F.lit(f"Column '{c.name}': failed conversion to {c.db_type}")))
    return reasons
