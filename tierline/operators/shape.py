"""From raw shapes to the declared statistics contract."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import tags_text, to_bool, to_long
from tierline.functions.text import SHORT_DATE_FORMAT
from tierline.plans.contracts import CORRUPT, EXTRA, LANDED_AT, SOURCE_FILE, STATISTICS, Field

ORIGIN = (LANDED_AT, SOURCE_FILE)


def explode_items(envelopes: DataFrame) -> DataFrame:
    """One row per item in ``item``; all other columns stay. Envelopes without items vanish."""
    others = [c for c in envelopes.columns if c not in ("items", EXTRA)]
    return envelopes.select(*others, F.explode("items").alias("item"))


def nested_projection(exploded: DataFrame) -> DataFrame:
    """The API leaves of ``item`` under their double-underscore names, next to the other columns."""
    leaves = [f.api for f in STATISTICS if f.api]
    found = {path: _item_leaf(exploded.schema, path) for path in leaves}
    kept = [c for c in exploded.columns if c != "item"]
    return exploded.select(
        *kept, *[c.alias(path.replace(".", "__")) for path, c in found.items() if c is not None]
    )


def _item_leaf(schema: T.StructType, path: str) -> Column | None:
    """The column for a path below ``item``, or None when the schema has no such leaf."""
    here: T.DataType = schema["item"].dataType
    for part in path.split("."):
        if not isinstance(here, T.StructType) or part not in here.names:
            return None
        here = here[part].dataType
    return F.col(f"item.{path}")


def _flat_name(schema: T.StructType, path: str) -> str | None:
    for name in (path, path.replace(".", "__"), path.replace(".", "_")):
        if name in schema.names:
            return name
    return None


def detect_dialect(schema: T.StructType) -> str:
    """``envelope``, ``item``, ``dotted``, ``dunder`` or ``csv``, from the column names alone."""
    names = set(schema.names)
    if "items" in names:
        return "envelope"
    if "item" in names:
        return "item"
    if "snippet.title" in names:
        return "dotted"
    if "snippet__title" in names:
        return "dunder"
    return "csv"


def _typed(column: Column, field: Field, source_type: T.DataType) -> Column:
    if field.name == "tags":
        return tags_text(column, isinstance(source_type, T.ArrayType))
    if field.type == "bigint":
        # numbers that already are numbers are truncated; only text needs the tolerant path
        return to_long(column) if isinstance(source_type, T.StringType) else column.try_cast("bigint")
    if field.type == "boolean":
        return column if isinstance(source_type, T.BooleanType) else to_bool(column)
    return column.cast(field.type)


def _absent(field: Field) -> Column:
    if not field.optional:
        raise ValueError(f"source has no column for required field {field.name!r}")
    return F.lit(field.default).cast(field.type)


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def conform_api(items: DataFrame, as_of: date | None = None) -> DataFrame:
    """The contract columns from API items, exploded, dotted or double-underscored.

    The trending date is ``as_of`` when given, else the landing partition ``date``,
    else today; it is written in the short text form. Origin columns and an item's extras pass through.
    """
    schema = items.schema
    nested = detect_dialect(schema) == "item"

    def from_source(field: Field) -> Column:
        if field.name == "trending_date":
            if as_of is not None:
                day = F.lit(as_of)
            elif "date" in schema.names:
                day = F.col("date").cast("date")
            else:
                day = F.current_date()
            return F.date_format(day, SHORT_DATE_FORMAT)
        if field.name == "region":
            return F.col("region").cast("string")
        if field.api is None:
            return _absent(field)
        if nested:
            leaf = _item_leaf(schema, field.api)
        else:
            name = _flat_name(schema, field.api)
            leaf = None if name is None else F.col(f"`{name}`")
        if leaf is None:
            return _absent(field)
        return _typed(leaf, field, items.select(leaf).schema[0].dataType)

    extra = _item_leaf(schema, EXTRA) if nested else None
    return items.select(
        *[from_source(f).alias(f.name) for f in STATISTICS],
        *_present(items, ORIGIN),
        *([] if extra is None else [extra.alias(EXTRA)]),
    )


def conform_csv(rows: DataFrame) -> DataFrame:
    """The contract columns from history rows, which already carry the target names. Rows that didn't fit are left out."""
    missing = [f.name for f in STATISTICS if f.name not in rows.columns]
    if missing:
        raise ValueError(f"history rows lack {missing}")
    if CORRUPT in rows.columns:
        rows = rows.where(F.col(CORRUPT).isNull())
    return rows.select(
        *[_typed(F.col(f.name), f, rows.schema[f.name].dataType).alias(f.name) for f in STATISTICS],
        *_present(rows, ORIGIN),
    )


def conform(raw: DataFrame, as_of: date | None = None) -> DataFrame:
    """Whatever the dialect, the contract columns."""
    dialect = detect_dialect(raw.schema)
    if dialect == "envelope":
        return conform_api(explode_items(raw), as_of)
    return conform_csv(raw) if dialect == "csv" else conform_api(raw, as_of)


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Replaces a struct column by its leaves, joined with ``_`` and in snake case."""

    def leaves(path: str, name: str, kind: T.DataType) -> list[Column]:
        if not isinstance(kind, T.StructType):
            return [F.col(path).alias(name)]
        return [
            leaf
            for f in kind.fields
            for leaf in leaves(f"{path}.{f.name}", f"{name}_{_snake(f.name)}" if name else _snake(f.name), f.dataType)
        ]

    kept = [c for c in df.columns if c != column]
    return df.select(*leaves(column, "", df.schema[column].dataType), *kept)


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")
