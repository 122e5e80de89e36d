"""JSON payload access with the strictness of a warehouse ``json_value`` + ``safe_cast``.

``try_parse_json`` gives NULL on malformed text, NaN, single quotes and empty text, but stops
after the first JSON value and ignores what follows; ``strict_variant`` rejects such text.
Each field is then read with ``try_variant_get``. Strings: objects and arrays give NULL. Numbers: the
text must look like a number (Spark alone would read ``3d`` as 3.0). Of repeated keys the last value
counts (``session.allow_repeated_keys``), as in the typed parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted numeric text for safe casts ---
FLOAT_PATTERN = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
INT_PATTERN = r"^\s*[+-]?\d+\s*$"


def parse_payload(value: str | Column) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.try_parse_json(c)


def strict_variant(value: Column) -> Column:
    """The one JSON value that ``value`` consists of; NULL if anything else precedes or follows it.

    Text after the first value can only pass inside ``[...]`` if it starts with ``]`` or ``,``, and
    only inside ``{"v": ...}`` if it starts with ``}`` or ``,"``; ``,"key":`` is no array element. So text that
    passes both ways, as an array of one element, has nothing after its value.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")))
    one = F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(one & wrapped.isNotNull(), F.try_variant_get(listed, "$[0]", "variant"))


def json_path(key: str) -> str:
    """A variant path for one top-level key; keys with dots are quoted."""
    if all(ch.isalnum() or ch == "_" for ch in key):
        return f"$.{key}"
    return "$[" + "'" + key.replace("'", "\\'") + "'" + "]"


def _raw_text(v: Column, key: str) -> Column:
    return F.try_variant_get(v, json_path(key), "string")


def json_string(v: Column, key: str) -> Column:
    """Scalar value as text; NULL for JSON null, missing keys, objects and arrays."""
    sub = F.try_variant_get(v, json_path(key), "variant")
    kind = F.schema_of_variant(sub)
    return F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("string")).otherwise(
        _raw_text(v, key)
    )


def _numeric(text: Column, pattern: str, dtype: str) -> Column:
    return F.when(text.rlike(pattern), text.try_cast(dtype))


def json_double(v: Column, key: str) -> Column:
    return _numeric(_raw_text(v, key), FLOAT_PATTERN, "double")


def json_long(v: Column, key: str) -> Column:
    return _numeric(_raw_text(v, key), INT_PATTERN, "bigint")
