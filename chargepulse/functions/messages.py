"""JSON message parsing.

Every field is read as STRING and coerced afterwards with ``try_cast``: a
numeric ``from_json`` schema turns quoted numbers such as ``"100"`` into NULL,
while the messages carry amounts both quoted and bare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

# Field names of the three message kinds, as they appear on the wire.
NOTIFY_FIELDS = ("serviceName", "interFacRst", "bussinessRst", "provinceCode", "chargefee",
                 "requestId", "receiveNotifyTime")
REQUEST_FIELDS = ("serviceName", "interFacRst", "bussinessRst", "provinceCode", "chargefee",
                  "shouldfee", "startReqTime", "endReqTime")
TOPUP_FIELDS = ("openid", "phoneNum", "money", "date", "lat", "log")


def message_schema(fields) -> StructType:
    """All-STRING struct for ``fields`` plus the corrupt-record slot."""
    return StructType([StructField(f, StringType()) for f in fields]
                      + [StructField(CORRUPT, StringType())])


def parse_json(log: DataFrame, fields, value_col: str = "value", keep_value: bool = False, carry=()) -> DataFrame:
    """Parse one JSON object per row into top-level STRING columns.

    ``carry`` names further columns of ``log`` to keep.  Adds ``bad_json``: true for NULL or blank records, non-JSON text and JSON
    that is not an object.  Only the fields a later step uses survive column pruning, so the
    parser reads just those.

    The parsed struct is exploded with ``inline`` (a Generate node): a later
    filter on the parsed fields cannot be pushed below it, so the optimizer never
    substitutes ``from_json`` into a predicate -- each message is parsed exactly
    once, where it is (after any repartition), not once per predicate term.
    """
    msg = F.from_json(F.col(value_col), message_schema(fields),
                      {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    keep = ([F.col(value_col)] if keep_value else []) + [F.col(c) for c in carry]
    blank = F.coalesce(F.trim(F.col(value_col)) == "", F.lit(True))   # NULL, empty or spaces
    out = log.select(*keep, blank.alias("_blank"), F.inline(F.array(msg)))
    bad = F.col("_blank") | F.col(CORRUPT).isNotNull()
    return out.select(*keep, *[F.col(f) for f in fields], bad.alias("bad_json"))


# ---- fields that no schema names ----------------------------------------------------

def message_variant(value_col: str = "value") -> Column:
    """The whole message as one VARIANT, whatever its fields; NULL for text that is no JSON."""
    return F.try_parse_json(F.col(value_col))


def variant_field(message: Column | str, name: str, kind: str = "string") -> Column:
    """Field ``name`` of a VARIANT message as ``kind``; NULL if it is missing or does not convert."""
    quote = "'" if '"' in name else '"'
    if quote in name:
        raise ValueError(f"no path can name {name!r}: it holds both kinds of quotes")
    return F.try_variant_get(F.col(message) if isinstance(message, str) else message, f"$[{quote}{name}{quote}]", kind)


def field_census(log: DataFrame, value_col: str = "value") -> DataFrame:
    """``field, kind, n``: which top-level fields the messages have, of which JSON kind, and how often.

    Text that is no JSON object has no field.  One row per field and task is shuffled.
    """
    spark = log.sparkSession
    messages = log.select(message_variant(value_col).alias("message"))
    fields = messages.lateralJoin(spark.tvf.variant_explode(F.col("message").outer()))
    return (fields.where("key is not null").groupBy(F.col("key").alias("field"), F.schema_of_variant("value").alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))
