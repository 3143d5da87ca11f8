"""Buckets, tenure and average revenue per user."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abonados.functions import vocabulary as V

ARPU = "decimal(32,10)"


def _bucket(value: Column, bounds) -> Column:
    chain = F.when(value.isNull(), V.UNKNOWN)
    for upper, label in bounds[:-1]:
        chain = chain.when(value <= upper, label)
    return chain.otherwise(bounds[-1][1])


def credit_score_range(score: Column) -> Column:
    return _bucket(score, V.CREDIT_SCORE_RANGES)


def age_bucket(age: Column) -> Column:
    return _bucket(age, V.AGE_BUCKETS)


def months_between(as_of: Column, since: Column) -> Column:
    """Completed months from one date to another, negative if they are reversed.

    A month is complete when the day of the month is reached, also at month
    ends: from 31 January to 29 February is no full month.
    """
    end, start = as_of.cast("date"), since.cast("date")
    late, early = F.greatest(end, start), F.least(end, start)
    whole = (
        (F.year(late) - F.year(early)) * 12
        + (F.month(late) - F.month(early))
        - F.when(F.dayofmonth(late) < F.dayofmonth(early), 1).otherwise(0)
    )
    # greatest and least skip NULL, so a missing date is handled apart
    return F.when(end >= start, whole).when(end < start, -whole)


def arpu_estimated(revenue: Column, payments: Column, bill: Column) -> Column:
    """Revenue per payment, else a positive bill, else NULL."""
    return F.when(
        (revenue > 0) & (payments > 0), (revenue / payments).cast(ARPU)
    ).when(bill > 0, bill.cast(ARPU))


def arpu_real(revenue: Column, months: Column) -> Column:
    """Revenue per month of service, for customers of at least one month."""
    return F.when(months > 0, revenue.cast("double") / months)
