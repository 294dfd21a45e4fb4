"""The three versioned dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tenure.operators.scd2 import scd2_merge

CUSTOMER_KEY, PLAN_KEY, SUBSCRIPTION_KEY = ["customer_id"], ["plan_id"], ["subscription_id"]

CUSTOMER_TRACKED = ["email_hash", "country", "created_at", "is_valid_country"]
PLAN_TRACKED = ["plan_name", "monthly_price", "tier", "effective_from", "effective_to"]
SUBSCRIPTION_TRACKED = ["customer_id", "plan_id", "status", "sub_start_date", "sub_end_date"]


def merge_customers(target: DataFrame, source: DataFrame, as_of: str | datetime, close_missing: bool = False) -> DataFrame:
    return scd2_merge(target, source, CUSTOMER_KEY, as_of, CUSTOMER_TRACKED, close_missing)


def merge_plans(target: DataFrame, source: DataFrame, as_of: str | datetime, close_missing: bool = False) -> DataFrame:
    return scd2_merge(target, source, PLAN_KEY, as_of, PLAN_TRACKED, close_missing)


def merge_subscriptions(target: DataFrame, source: DataFrame, as_of: str | datetime, close_missing: bool = False) -> DataFrame:
    return scd2_merge(target, source, SUBSCRIPTION_KEY, as_of, SUBSCRIPTION_TRACKED, close_missing)
