"""JSON-in-string helpers: strict documents, runtime-named fields, canonical fields.

``with_document`` parses a text once into a VARIANT; the ``document_*``
expressions read that. The ``json_*`` expressions read single fields of a text
and accept what follows a complete object.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.scalars import col_of

__all__ = ["with_document", "document_number", "document_text", "document_has", "is_object", "keep_last_of_repeated_keys",
           "json_number", "json_text", "json_struct", "json_has_key", "replace_exact"]

_KEY = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _path(key: str) -> str:
    if not _KEY.match(key):
        raise ValueError(f"unsupported JSON key name: {key!r}")
    return f"$.{key}"


def keep_last_of_repeated_keys(spark: SparkSession) -> None:
    """VARIANT parsing in this session keeps the last of repeated keys, as the
    usual JSON readers do, where Spark's default rejects the document."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def with_document(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the JSON value of a text column as VARIANT, parsed once a row; NULL if it
    is malformed or has anything but white space behind the value.

    The parser stops at the end of the first value. So it is given an array of the
    text and a number that the text cannot know, its hash: behind a single whole
    value, and only there, that number is the second element. The array is a column
    of its own first, as an expression that is used twice is computed twice."""
    both, mark = f"{out}__array", F.xxhash64(F.col(text))
    parsed = df.withColumn(both, F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(","), mark.cast("string"), F.lit("]"))))
    value = F.when(F.try_variant_get(both, "$[1]", "bigint") == mark, F.try_variant_get(both, "$[0]", "variant"))
    return parsed.withColumn(out, value).drop(both)


def is_object(document) -> Column:
    return F.schema_of_variant(col_of(document)).startswith("OBJECT")


def document_has(document, key: str) -> Column:
    """Whether an object has the key (a null value counts); NULL for no document."""
    doc = col_of(document)
    return F.when(doc.isNotNull(), F.try_variant_get(doc, _path(key), "variant").isNotNull())


def document_text(document, key: str) -> Column:
    """Field ``key`` as text; missing gives NULL."""
    return F.try_variant_get(col_of(document), _path(key), "string")


def document_number(document, key: str, default: float | None = None) -> Column:
    """Field ``key`` as DOUBLE; missing or non-numeric gives NULL, or ``default``
    where an object lacks the key."""
    value = F.try_variant_get(col_of(document), _path(key), "double")
    if default is None:
        return value
    return F.when(is_object(document) & ~document_has(document, key), F.lit(float(default))).otherwise(value)


def json_text(s, key: str) -> Column:
    """Field ``key`` of a JSON object string as text; malformed JSON gives NULL."""
    return F.get_json_object(col_of(s), _path(key))


def json_number(s, key: str, default: float | None = None) -> Column:
    """Field ``key`` as DOUBLE; missing, non-numeric or malformed gives NULL
    (or ``default`` when the document parses but lacks the key)."""
    value = json_text(s, key).try_cast("double")
    if default is None:
        return value
    keys = F.json_object_keys(col_of(s))
    return (F.when(keys.isNull(), F.lit(None).cast("double"))
             .when(~F.array_contains(keys, F.lit(key)), F.lit(float(default)))
             .otherwise(value))


def json_struct(s, schema: str) -> Column:
    """Typed parse with an explicit schema (a DDL string); bad rows give NULL fields."""
    return F.from_json(col_of(s), schema, {"mode": "PERMISSIVE"})


def json_has_key(s, key: str) -> Column:
    """Key presence in a JSON object string (the intent of a substring test)."""
    return F.array_contains(F.json_object_keys(col_of(s)), F.lit(key))


def replace_exact(c, mapping: dict) -> Column:
    """Whole-value replacement (never substring)."""
    c = col_of(c)
    expr = c
    for old, new in mapping.items():
        expr = F.when(c == F.lit(old), F.lit(new)).otherwise(expr)
    return expr
