"""JSON text to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from martloom.schemas import ddl

CORRUPT = "_corrupt"


def parse_document(text, columns: dict[str, str], strict: bool = True) -> Column:
    """Parse once into a struct.

    ``strict`` fails on malformed text. Otherwise the bad text is kept in a ``_corrupt`` field so the
    row can be set aside.
    """
    if strict:
        return F.from_json(text, ddl(columns), {"mode": "FAILFAST"})
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(text, ddl({**columns, CORRUPT: "string"}), options)


def text_field(text, name: str) -> Column:
    """One top-level field of JSON text, as text."""
    return F.get_json_object(text, f"$.{name}")


def document_text(*columns) -> Column:
    """Columns as one JSON document; NULL columns are left out."""
    return F.to_json(F.struct(*columns))


def settings_map(text) -> Column:
    return F.from_json(text, T.MapType(T.StringType(), T.StringType()))
