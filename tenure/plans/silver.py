"""Bronze to silver: one row per key (the newest), then the validity rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.functions.countries import is_country
from tenure.functions.rules import has_consistent_lifecycle, is_hashed_email, is_plausible_invoice
from tenure.functions.times import parse_event_ts
from tenure.operators.dedup import latest_by


def customer_rule(country_codes: Iterable[str]) -> Column:
    """The rule a customer breaks; null for none."""
    return F.when(~F.coalesce(is_hashed_email(F.col("email_hash")), F.lit(False)), "raw_email").when(
        ~F.coalesce(is_country(F.col("country"), country_codes), F.lit(False)), "country")


def subscription_rule(end: str = "sub_end_date") -> Column:
    return F.when(~F.coalesce(has_consistent_lifecycle(F.col("status"), F.col(end)), F.lit(False)), "lifecycle")


def invoice_rule() -> Column:
    plausible = is_plausible_invoice(F.col("amount"), F.col("currency"), F.col("paid"), F.col("failure_reason"))
    return F.when(~F.coalesce(plausible, F.lit(False)), "quality")


def event_rule() -> Column:
    return F.when(F.col("event_ts").isNull(), "timestamp")


def clean_customers(bronze: DataFrame, country_codes: Iterable[str]) -> DataFrame:
    """Newest row per customer, kept if the e-mail is hashed and the country is assigned."""
    return (
        latest_by(bronze, ["customer_id"], ["last_updated"])
        .filter(is_hashed_email(F.col("email_hash")))
        .withColumn("is_valid_country", is_country(F.col("country"), country_codes))
        .filter("is_valid_country")
    )


def clean_plans(bronze: DataFrame) -> DataFrame:
    """Newest row per plan and effective date."""
    return latest_by(bronze, ["plan_id", "effective_from"], ["last_updated"])


def clean_subscriptions(bronze: DataFrame, apply_lifecycle: bool = True) -> DataFrame:
    """Newest row per subscription and start date, with a consistent status and end date.

    The business dates are renamed so that a versioned dimension can add its own.
    """
    newest = latest_by(bronze, ["subscription_id", "start_date"], ["last_updated"])
    if apply_lifecycle:
        newest = newest.filter(has_consistent_lifecycle(F.col("status"), F.col("end_date")))
    renamed = {"start_date": "sub_start_date", "end_date": "sub_end_date"}
    return newest.select([F.col(c).alias(renamed.get(c, c)) for c in newest.columns])


def clean_invoices(bronze: DataFrame, apply_quality: bool = True) -> DataFrame:
    """Newest row per invoice, kept if plausible (``apply_quality=False`` keeps all)."""
    newest = latest_by(bronze, ["invoice_id"], ["last_updated"])
    if not apply_quality:
        return newest
    return newest.filter(
        is_plausible_invoice(F.col("amount"), F.col("currency"), F.col("paid"), F.col("failure_reason"))
    )


def clean_events(bronze: DataFrame) -> DataFrame:
    """Newest row per event, with a real timestamp (null when malformed, and then oldest)."""
    parsed = bronze.withColumn("event_ts", parse_event_ts(F.col("event_ts")))
    return latest_by(parsed, ["event_id"], ["event_ts"])


def malformed_events(bronze: DataFrame) -> DataFrame:
    """Events whose timestamp text is present but cannot be parsed."""
    return bronze.filter(F.col("event_ts").isNotNull() & parse_event_ts(F.col("event_ts")).isNull())
