"""What messages carry beside the contract: unknown fields and values of another type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.schema import TRANSACTION_SCHEMA

_KIND_OF_TYPE = {T.StringType(): "string", T.DoubleType(): "number", T.BooleanType(): "boolean"}

#: The kind of JSON value that each field of the contract has.
EXPECTED_KINDS = {field.name: _KIND_OF_TYPE[field.dataType] for field in TRANSACTION_SCHEMA.fields}


def _fields() -> Column:
    """Field name to value of a message; NULL unless it is a JSON object of distinct names."""
    parsed = F.try_parse_json(F.col("value").cast("string"))
    return F.try_variant_get(parsed, "$", "map<string,variant>")


def _kind(value: Column) -> Column:
    spelled = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (
        F.when(spelled.isin("STRING", "BOOLEAN", "ARRAY", "OBJECT"), F.lower(spelled))
        .when(value.isNull() | (spelled == "VOID"), "null")
        .otherwise("number")
    )


def _expected(name: Column) -> Column:
    kinds = F.create_map(*(F.lit(x) for pair in EXPECTED_KINDS.items() for x in pair))
    return F.try_element_at(kinds, name)


def _is_drift(name: Column, kind: Column) -> Column:
    expected = _expected(name)
    return expected.isNull() | ((kind != expected) & (kind != "null"))


def field_kinds(envelopes: DataFrame) -> DataFrame:
    """Messages per field and kind of value: the schema that arrives, drift marked.

    ``kind`` is one of ``null boolean number string array object``. ``expected`` is the
    contract's kind, NULL for a field that the contract does not have. ``drifted`` marks
    unknown fields and kinds other than the expected one; an explicit null is allowed.
    Messages that are no JSON object, or name a field twice, are left to the quarantine.
    Counts reduce on the map side; records grow with the field names that arrive.
    """
    seen = envelopes.select(F.explode(_fields()).alias("field", "_value"))
    counted = seen.groupBy("field", _kind(F.col("_value")).alias("kind")).agg(F.count(F.lit(1)).alias("n_messages"))
    return counted.select(
        "field", "kind", "n_messages",
        _expected(F.col("field")).alias("expected"),
        _is_drift(F.col("field"), F.col("kind")).alias("drifted"),
    )


def with_drift(envelopes: DataFrame) -> DataFrame:
    """Envelopes with ``drift``: a JSON object of what the typed parse does not keep.

    That is every field the contract does not have, and every value whose kind is not
    its field's. NULL for messages that lose nothing, and for those without fields.
    """
    lost = F.map_filter(_fields(), lambda name, value: _is_drift(name, _kind(value)))
    return envelopes.select("*", F.when(F.size(lost) > 0, F.to_json(lost)).alias("drift"))
