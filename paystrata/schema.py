"""The transaction contract: column names, types and order."""

from __future__ import annotations

from pyspark.sql import types as T

# The transaction record, in contract order, all nullable.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("txn_timestamp", T.StringType()),
        T.StructField("arrival_timestamp", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("failure_reason", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_segment", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("gateway_id", T.StringType()),
        T.StructField("gateway_name", T.StringType()),
        T.StructField("processor_id", T.StringType()),
        T.StructField("processor_name", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("location_city", T.StringType()),
        T.StructField("location_state", T.StringType()),
        T.StructField("is_international", T.BooleanType()),
    ]
)
TRANSACTION_COLUMNS = tuple(TRANSACTION_SCHEMA.names)

# Bronze is partitioned by arrival, never by event time.
DAY_COLUMNS = ("arrival_year", "arrival_month", "arrival_day")
PARTITION_COLUMNS = (*DAY_COLUMNS, "arrival_hour")
INGEST_COLUMN = "pipeline_timestamp"
# Folder level of the callback sink: one per micro-batch and hour.
BATCH_COLUMN = "ingest_batch"
BRONZE_COLUMNS = (*TRANSACTION_COLUMNS, *PARTITION_COLUMNS, INGEST_COLUMN)

# Spark's default name for the text of a record that did not parse cleanly.
CORRUPT_COLUMN = "_corrupt_record"
PARSE_SCHEMA = T.StructType(
    [*TRANSACTION_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())]
)

# Message envelope shared by the topic and its file double.
ENVELOPE_SCHEMA = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)
