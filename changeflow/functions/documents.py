"""JSON documents as maps of top-level fields to VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = "map<string,variant>"


def document_fields(doc: Column) -> Column:
    """Top-level fields of a JSON object, null for any other text."""
    return F.from_json(doc, FIELDS)


def document_error(doc: Column, fields: Column) -> Column:
    """Why a document is refused, null if it is absent or a proper JSON object.

    ``fields`` are its :func:`document_fields`.
    """
    return F.when(doc.isNotNull() & fields.isNull(), F.lit("not a JSON object")).when(
        F.size(F.array_distinct(F.map_keys(fields))) != F.size(fields),
        F.lit("repeated field in the JSON object"),
    )


def decoded(text: Column) -> Column:
    """JSON text as its value, any other text as itself."""
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def overlaid(under: Column, over: Column) -> Column:
    """Two maps in one; where both have a field, ``over`` wins. A null map counts as empty."""
    kept = F.map_filter(under, lambda k, _: ~F.coalesce(F.map_contains_key(over, k), F.lit(False)))
    return F.coalesce(F.map_concat(kept, over), over, under)


def lift(cols: Column, data_key: str) -> Column:
    """Columns of one record with the object under ``data_key`` lifted to top level.

    The other columns are decoded where they hold JSON; lifted fields win over
    columns of the same name.
    """
    outer = F.transform_values(
        F.map_filter(cols, lambda k, _: k != data_key), lambda _, v: decoded(v)
    )
    return overlaid(outer, document_fields(cols[data_key]))
