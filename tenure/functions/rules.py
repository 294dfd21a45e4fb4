"""Validity rules of the cleaned tables, as boolean columns that are never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a raw e-mail address where a hash is expected.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

ACTIVE, TRIALING, PAUSED, CANCELED = "active", "trialing", "paused", "canceled"


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_hashed_email(value: Column) -> Column:
    """The value is present and is not a raw e-mail address."""
    return _sure(~value.rlike(EMAIL_PATTERN))


def has_consistent_lifecycle(status: Column, end_date: Column) -> Column:
    """Canceled subscriptions have an end date, active ones have none."""
    canceled_without_end = end_date.isNull() & _sure(status == CANCELED)
    active_with_end = end_date.isNotNull() & _sure(status == ACTIVE)
    return ~canceled_without_end & ~active_with_end


def is_plausible_invoice(amount: Column, currency: Column, paid: Column, failure_reason: Column) -> Column:
    """A non-negative dollar amount, or an unpaid invoice that says why."""
    good_amount = _sure(amount >= 0) & _sure(currency == "USD")
    explained_failure = _sure(~paid) & failure_reason.isNotNull()
    return good_amount | explained_failure
