from __future__ import annotations

import json

from payment_rows import GOOD, plan_text
from pyspark.sql import functions as F

from paystrata.operators import drift
from paystrata.schema import ENVELOPE_SCHEMA


def envelopes(spark, *values):
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    rows = [(None, None if t is None else bytearray(t.encode())) for t in texts]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_what_the_typed_parse_does_not_keep(spark):
    sent = [
        (GOOD, None),
        (GOOD | {"amount": "250.5", "extra": None}, {"amount": "250.5", "extra": None}),
        (GOOD | {"txn_id": 7, "Amount": 1}, {"txn_id": 7, "Amount": 1}),
        (GOOD | {"nested": {"a": [1, {"b": "é"}]}}, {"nested": {"a": [1, {"b": "é"}]}}),
        ({"amount": None}, None),
        ({}, None),
        ([1], None),
        ("text", None),
        ("", None),
        ('{"a": 1, "a": 2}', None),
        (None, None),
    ]
    found = drift.with_drift(envelopes(spark, *(v for v, _ in sent))).collect()
    assert len(found) == len(sent)
    by_value = {None if r.value is None else bytes(r.value).decode(): r.drift for r in found}
    for value, want in sent:
        text = value if value is None or isinstance(value, str) else json.dumps(value)
        assert (by_value[text] and json.loads(by_value[text])) == want


def test_kinds_of_the_fields_that_arrive(spark):
    sent = envelopes(spark, {"amount": 1}, {"amount": 1.5}, {"amount": 1e300}, {"amount": None}, {"amount": True}, {"x": []}, {"x": {}}, "{", None)
    found = {(r.field, r.kind): (r.n_messages, r.expected, r.drifted) for r in drift.field_kinds(sent).collect()}
    assert found == {
        ("amount", "number"): (3, "number", False),
        ("amount", "null"): (1, "number", False),
        ("amount", "boolean"): (1, "number", True),
        ("x", "array"): (1, None, True),
        ("x", "object"): (1, None, True),
    }


def test_a_hot_field_reduces_before_it_moves(spark):
    plan = plan_text(drift.field_kinds(envelopes(spark, GOOD)))
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "Python" not in plan


def test_no_messages(spark):
    none = envelopes(spark).where(F.lit(False))
    assert drift.field_kinds(none).count() == drift.with_drift(none).count() == 0
