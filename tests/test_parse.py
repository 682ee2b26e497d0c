from __future__ import annotations

import json
import math

import pytest
from payment_rows import good
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paystrata.functions.times import event_time_text, parse_event_time, parse_logical_date
from paystrata.operators import parse
from paystrata.schema import BRONZE_COLUMNS, ENVELOPE_SCHEMA, TRANSACTION_COLUMNS
from paystrata.sinks.bronze import append_bronze
from paystrata.sources.bronze import read_bronze


def messages(spark, *values):
    rows = [
        (b"k%d" % n, None if value is None else value.encode()) for n, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def diagnosed(spark, *values):
    rows = parse.parse_with_diagnosis(messages(spark, *values)).collect()
    return sorted(rows, key=lambda row: bytes(row.key))


def test_contract_order(spark):
    parsed = parse.parse_transactions(messages(spark, json.dumps(good())))
    assert tuple(parsed.columns) == BRONZE_COLUMNS
    row = parsed.first()
    assert [row[name] for name in TRANSACTION_COLUMNS] == list(good().values())
    assert (row.arrival_year, row.arrival_month, row.arrival_day, row.arrival_hour) == (2024, 1, 15, 10)
    assert row.pipeline_timestamp is not None


@pytest.mark.parametrize(
    "payload, reason",
    [
        ("not json", "malformed_json"),
        (json.dumps(good())[:200], "malformed_json"),
        ('[{"txn_id":"y"}]', "malformed_json"),
        ("", "empty_payload"),
        ("   ", "empty_payload"),
        (None, "empty_payload"),
        ("null", "malformed_json"),
        ("{}", "no_fields"),
    ],
)
def test_unreadable_payload_is_a_row_of_nulls(spark, payload, reason):
    (row,) = diagnosed(spark, payload)
    assert row.reason == reason
    assert all(row[name] is None for name in TRANSACTION_COLUMNS)
    assert row.arrival_year is None


def test_wrong_type_nulls_one_field(spark):
    text = json.dumps(good()).replace("250.5", '"250.5"')
    boolean = json.dumps(good()).replace("false", '"false"')
    first, second = diagnosed(spark, text, boolean)
    assert (first.amount, first.status, first.reason) == (None, "SUCCESS", "bad_field")
    assert (second.is_international, second.amount, second.reason) == (None, 250.5, "bad_field")


def test_field_coercions(spark):
    duplicate = json.dumps(good())[:-1] + ', "status": "FAILED"}'
    rows = diagnosed(
        spark,
        json.dumps(good(amount=7)),
        json.dumps(good(user_id=12, currency={"a": 1})),
        duplicate,
        json.dumps({**good(), "surplus": 1}),
        json.dumps({"TXN_ID": "x", **{k: v for k, v in good().items() if k != "txn_id"}}),
        json.dumps(good(amount=math.nan)),
    )
    widened, coerced, twice, surplus, cased, nan = rows
    assert widened.amount == 7.0
    assert (coerced.user_id, coerced.currency) == ("12", '{"a":1}')
    assert twice.status == "FAILED"
    assert surplus.txn_id == good()["txn_id"] and "surplus" not in surplus.asDict()
    assert cased.txn_id is None
    assert math.isnan(nan.amount)


def test_diagnosis_agrees_with_plain_parse(spark):
    values = ["not json", "{}", json.dumps(good()), None, json.dumps(good(arrival_timestamp="x"))]
    plain = parse.parse_transactions(messages(spark, *values)).drop("pipeline_timestamp")
    rows = parse.bronze_rows(parse.parse_with_diagnosis(messages(spark, *values)))
    assert plain.exceptAll(rows.drop("pipeline_timestamp")).isEmpty()
    assert plain.count() == rows.count() == 5


@pytest.mark.parametrize(
    "text, parses",
    [
        ("2024-01-15T10:00:00.123Z", True),
        ("2024-01-15T10:00:00.12Z", True),
        ("2024-01-15T10:00:00Z", False),
        ("2024-01-15T10:00:00.123456Z", False),
        ("2024-01-15T10:00:00.123+05:30", False),
        ("2024-1-15T10:00:00.123Z", False),
        ("2024-01-15T24:00:00.123Z", False),
        ("2024-02-30T10:00:00.123Z", False),
        ("2024-01-15T10:00:00.123Z ", False),
        ("", False),
        (None, False),
    ],
)
def test_event_time_format(spark, text, parses):
    row = spark.range(1).select(parse_event_time(F.lit(text).cast("string")).alias("t")).first()
    assert (row.t is not None) == parses


def test_event_time_text_truncates(spark):
    moment = F.timestamp_micros(F.lit(1_704_067_200_123_999))
    assert spark.range(1).select(event_time_text(moment)).first()[0] == "2024-01-01T00:00:00.123Z"


def test_engine_zone_keeps_hours_a_local_zone_would_shift(spark, transactions, conf):
    row = good(arrival_timestamp="2026-03-08T02:30:00.000Z")
    assert parse.to_bronze(transactions([row])).first().arrival_hour == 2
    conf(spark__sql__session__timeZone="America/New_York")
    assert parse.to_bronze(transactions([row])).first().arrival_hour == 3


def test_logical_date():
    assert parse_logical_date("2024-01-05").day == 5
    with pytest.raises(ValueError):
        parse_logical_date("05/01/2024")


def test_unroutable_rows_land_in_the_default_partition(spark, transactions, tmp_path):
    rows = transactions([good(), good(arrival_timestamp="2024-01-15T10:00:00Z")])
    append_bronze(parse.to_bronze(rows), str(tmp_path / "bronze"))
    names = {path.name for path in (tmp_path / "bronze").iterdir() if path.is_dir()}
    assert names == {"arrival_year=2024", "arrival_year=__HIVE_DEFAULT_PARTITION__"}
    assert (tmp_path / "bronze/arrival_year=2024/arrival_month=1/arrival_day=15").is_dir()
    assert read_bronze(spark, str(tmp_path / "bronze")).count() == 2


def test_encoding_keeps_nulls_and_keys(spark, transactions):
    encoded = parse.encode_envelopes(transactions([good(), good(txn_id=None), good(txn_id="")]))
    first, missing, empty = encoded.collect()
    record = json.loads(bytes(first.value))
    assert list(record) == list(TRANSACTION_COLUMNS) and record == good()
    assert bytes(first.key).decode() == good()["txn_id"]
    assert missing.key is None and empty.key is None


TEXT = st.none() | st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=12)
ROW = st.fixed_dictionaries(
    {
        name: st.none() | st.floats(allow_nan=False, allow_infinity=False)
        if name == "amount"
        else st.none() | st.booleans()
        if name == "is_international"
        else TEXT
        for name in TRANSACTION_COLUMNS
    }
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(ROW, min_size=30, max_size=60))
def test_any_row_survives_encoding_and_parsing(transactions, rows):
    parsed = parse.parse_transactions(parse.encode_envelopes(transactions(rows)))
    back = [tuple(row) for row in parsed.select(*TRANSACTION_COLUMNS).collect()]
    assert back == [tuple(row[name] for name in TRANSACTION_COLUMNS) for row in rows]
