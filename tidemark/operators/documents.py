"""Fields of a semi-structured document column, parsed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """JSON text as a variant value; null for null text and for text that is no JSON."""
    return F.try_parse_json(text)


def malformed(text: Column, document: Column) -> Column:
    """Whether a text was given that could not be parsed."""
    return text.isNotNull() & document.isNull()


def with_fields(rows: DataFrame, text: str, fields: dict[str, tuple[str, str]], bad: str = "malformed") -> DataFrame:
    """``rows`` with a column per field and the flag ``bad`` for texts that are no JSON.

    ``fields`` gives path and type by name, as in ``{"old_len": ("$.length.old", "int")}``.
    A missing path, a value of another type than can be cast, and a field of a malformed
    text are null. A variable of the plan binds the parsed document, so the text is
    parsed once however many fields are taken.
    """

    def row(document: Column) -> Column:
        values = [F.try_variant_get(document, path, kind).alias(name) for name, (path, kind) in fields.items()]
        return F.struct(*values, malformed(F.col(text), document).alias(bad))

    return rows.select("*", F.inline(F.transform(F.array(parsed(F.col(text))), row)))


def malformed_count(rows: DataFrame, text: str) -> DataFrame:
    """How many texts there are and how many of them are no JSON, in one pass."""
    return rows.agg(
        F.count(text).alias("texts"), F.count_if(malformed(F.col(text), parsed(F.col(text)))).alias("malformed")
    )
