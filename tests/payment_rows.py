"""A sound transaction and small helpers for the tests."""

from __future__ import annotations

GOOD = {
    "txn_id": "TXN-0000000000AB",
    "txn_timestamp": "2024-01-15T09:30:00.123Z",
    "arrival_timestamp": "2024-01-15T10:00:00.456Z",
    "amount": 250.5,
    "currency": "INR",
    "status": "SUCCESS",
    "failure_reason": None,
    "user_id": "USR-000001",
    "user_segment": "regular",
    "merchant_id": "MRC-000001",
    "merchant_category": "grocery",
    "gateway_id": "GW-001",
    "gateway_name": "Razorpay",
    "processor_id": "PRC-001",
    "processor_name": "NPCI",
    "payment_method": "UPI",
    "device_type": "mobile",
    "location_city": "Pune",
    "location_state": "Maharashtra",
    "is_international": False,
}


def good(**changes) -> dict:
    return {**GOOD, **changes}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
