"""Staging (silver): bronze JSON events -> one typed row per trip.

Parsing is the dominant cost of this layer at scale, so it has two paths that
give the same values:

* fast path: one strict, typed ``from_json`` pass (Jackson streaming, no
  intermediate tree) for every row;
* exact path: a strict variant parse (nothing may follow the value) + per-field reads with
  warehouse ``json_value``/``safe_cast`` semantics, evaluated only for rows the fast path
  flags: malformed or partial records (NaN, single quotes, a quoted number, a
  float or boolean in an integer field, a non-object), text whose first ``}`` is not
  its last character (glued objects, trailing text, a brace in a field), or a text field holding
  an object or array.

A flat object that ends at the first ``}`` of the text ends with the text, so the fast path never
ignores trailing text. For well-formed producer output both paths agree value for value, and
of repeated keys both take the last value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestar.functions.json import json_double, json_long, json_string, strict_variant
from ridestar.operators.dedup import dedup_latest
from ridestar.session import allow_repeated_keys, compiled_methods
from ridestar.spec import DOUBLE, LONG, METADATA_COLUMNS, PAYLOAD_FIELDS, STAGING_COLUMNS, STRING, Field

_TYPED = "__typed"
_EXACT = "__exact"
_READ = "__read"
CORRUPT = "_corrupt_record"

# Latest record wins; partition and offset make the order total (ties are not arbitrary).
DEDUP_ORDER = ("kafka_timestamp", "kafka_partition", "kafka_offset")

STRICT_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowUnquotedControlChars": "false",
    "allowUnquotedFieldNames": "false",
    "allowComments": "false",
    "allowNumericLeadingZeros": "false",
    "allowBackslashEscapingAnyCharacter": "false",
}

_SPARK_TYPES = {STRING: T.StringType(), DOUBLE: T.DoubleType(), LONG: T.LongType()}


def _schema(fields: Sequence[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.key, _SPARK_TYPES[f.dtype]) for f in fields]
                        + [T.StructField(CORRUPT, T.StringType())])


PAYLOAD_SCHEMA = _schema(PAYLOAD_FIELDS)


def _exact_field(v: Column, f) -> Column:
    if f.dtype == DOUBLE:
        return json_double(v, f.key)
    if f.dtype == LONG:
        return json_long(v, f.key)
    return json_string(v, f.key)


def _needs_exact_path(typed: Column, value: Column, read: Sequence[Field] = PAYLOAD_FIELDS) -> Column:
    nested = [
        typed[f.key].startswith("{") | typed[f.key].startswith("[") for f in read if f.dtype == STRING
    ]
    # Text with trailing blanks also takes the exact path (correct, just slower).
    # All bytes but the last are looked through for a brace: ``locate`` counts characters and ``substring_index`` compares slowly.
    but_last = F.substring(value.cast("binary"), F.lit(1), F.octet_length(value) - 1).cast("string")
    cond = typed.isNull() | typed[CORRUPT].isNotNull() | ~value.endswith("}") | but_last.contains("}")
    for c in nested:
        cond = cond | F.coalesce(c, F.lit(False))
    return F.coalesce(cond, F.lit(True))


def _fields_of(columns: Sequence[str] | None) -> Sequence[Field]:
    """Payload fields of the given staging columns (None: all), the id first."""
    if columns is None:
        return PAYLOAD_FIELDS
    unknown = set(columns) - set(STAGING_COLUMNS)
    if unknown:
        raise ValueError(f"not columns of staging: {sorted(unknown)}")
    return [f for f in PAYLOAD_FIELDS if f is PAYLOAD_FIELDS[0] or f.column in columns]


def parse_events(bronze: DataFrame, with_reason: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Flatten the JSON payload to the 57 typed staging columns + 4 metadata columns.

    With ``with_reason``: also ``reject_reason`` (``malformed_json``,
    ``missing_id`` or NULL for an accepted row) and the original ``value``.

    ``columns``: the staging columns that will be read (``trip_id`` and the metadata are always there); payload fields of
    other columns are checked as JSON text, but not converted. The values read are the same.
    """
    read = _fields_of(columns)
    allow_repeated_keys(bronze.sparkSession)
    compiled_methods(bronze.sparkSession)
    meta = [F.col(src).cast(t).alias(dst) for src, dst, t in METADATA_COLUMNS]
    meta_names = [dst for _, dst, _ in METADATA_COLUMNS]
    t, exact = F.col(_TYPED), F.col(_EXACT)
    # The typed parse is produced by a generator (explode of a one-element
    # array): Catalyst keeps filters on parsed fields (``trip_id IS NOT NULL``)
    # above a generator instead of pushing them below the parse, where they
    # would run from_json a second time per row. A second one-element generator
    # carries the path flag as a plain column, so such a filter stays a small
    # predicate on attributes (a large inlined predicate falls out of the JIT).
    typed = bronze.select(
        F.explode(F.array(F.from_json("value", _schema(read), STRICT_JSON_OPTIONS))).alias(_TYPED), "value", *meta
    )
    flag = _needs_exact_path(t, F.col("value"), read)
    typed = typed.select(
        F.explode(F.array(F.struct(t.alias("t"), flag.alias("x"), F.col("value").alias("value")))).alias("__g"),
        *meta_names,
    ).select(F.col("__g.t").alias(_TYPED), F.col("__g.x").alias(_EXACT), F.col("__g.value").alias("value"),
             *meta_names)
    # The exact path works in lambda functions, which run outside generated code, and gives a struct of the typed parse's form: written
    # out per field in the generated loop it made one method too large for HotSpot to compile, so every row was interpreted.

    def exactly(variant: Column) -> Column:
        values = [_exact_field(variant, f).alias(f.key) for f in read]
        return F.struct(variant.isNull().alias("malformed"),
                        F.struct(*values, F.lit(None).cast("string").alias(CORRUPT)).alias("s"))

    read_exactly = F.transform(F.transform(F.when(exact, F.array("value")), strict_variant), exactly)
    as_typed = F.struct(F.lit(False).alias("malformed"), t.alias("s"))
    both = typed.select(F.when(exact, read_exactly[0]).otherwise(as_typed).alias(_READ), *meta_names,
                        *(["value"] if with_reason else []))
    got = F.col(_READ)
    cols = [got["s"][f.key].alias(f.column) for f in read] + [F.col(m) for m in meta_names]
    if with_reason:
        cols += [
            F.when(got["malformed"], F.lit("malformed_json"))
            .when(got["s"][PAYLOAD_FIELDS[0].key].isNull(), F.lit("missing_id"))
            .alias("reject_reason"),
            F.col("value"),
        ]
    return both.select(*cols)


def stg_events(bronze: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The staging model: parse, keep rows with an id, keep the latest row per trip_id.

    ``columns``: only these columns of it, for models that read no others; the rows are the same.
    """
    parsed = parse_events(bronze, columns=columns).where(F.col("trip_id").isNotNull())
    latest = dedup_latest(parsed, ["trip_id"], DEDUP_ORDER)
    return latest if columns is None else latest.select(*[c for c in STAGING_COLUMNS if c in columns])
