"""Raw records as JSON text: their fields, the records of a document, and what a declared schema does not name (CL-6, SRC-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from funnelspark.functions import times
from funnelspark.schemas import CORRUPT, RAW_FIELDS, RECORD, TIME_FIELDS


def json_fields(entity: str) -> StructType:
    """Fields of an entity as they stand in JSON, and the whole text of a record that is none."""
    fields = [StructField(name, VariantType() if name in TIME_FIELDS else StringType()) for name in RAW_FIELDS[entity]]
    return StructType([*fields, StructField(CORRUPT, StringType())])


def parsed(record: Column, schema: StructType, strict: bool = False) -> Column:
    """A record's fields. Of broken JSON only CORRUPT is kept, or the job fails if ``strict``."""
    if strict:
        return F.from_json(record, StructType([f for f in schema if f.name != CORRUPT]), {"mode": "FAILFAST"})
    return F.from_json(record, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def whole(document: Column) -> Column:
    """The text of a document that holds one JSON value; the job fails on one that is broken or goes on behind its value, which a parser would not read."""
    values = F.from_json(F.concat(F.lit("["), document, F.lit("]")), "array<string>")
    return F.when(F.size(values) == 1, document).otherwise(F.raise_error(F.lit("a JSON document that is broken or holds several values")))


def records_of(document: Column) -> Column:
    """Texts of the records in a JSON document: an array of records, a ``data`` envelope, or a single record."""
    inside = F.when(F.ltrim(document).startswith("["), F.from_json(document, "array<string>")).otherwise(
        F.from_json(document, "data array<string>").getField("data"))
    return F.coalesce(inside, F.array(document))


def field(name: str, value: Column) -> Column:
    """Text of a JSON field; a number in a time field means epoch seconds."""
    if name not in TIME_FIELDS:
        return value.alias(name)
    number = F.when(F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(value, "$", "double"))
    as_text = F.try_variant_get(value, "$", "string")
    return F.when(number.isNotNull(), F.when(number != 0, times.epoch_to_text(number))).otherwise(as_text).alias(name)


def undeclared(record: Column, entity: str) -> Column:
    """The record's text if it has fields that the entity does not name, else NULL: then its fields say everything."""
    others = F.array_except(F.json_object_keys(record), F.array(*[F.lit(n) for n in RAW_FIELDS[entity]]))
    return F.when(F.size(others) > 0, record).alias(RECORD)
