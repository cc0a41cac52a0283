"""Scalar expressions shared by the jobs and the queries."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def revenue(price: Column, quantity: Column) -> Column:
    """Money of one line: the final price is per unit."""
    return price.cast(MONEY) * quantity


def discounted(price: Column, percent: Column) -> Column:
    """Price after a whole-number percentage, in exact decimal arithmetic."""
    share = (F.lit(100) - percent).cast("decimal(10,0)") * F.lit(Decimal("0.01"))
    return F.round(price * share, 2).cast(MONEY)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def order_month(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 7)


def day_at(day: Column, hour: Column, minute: Column) -> Column:
    """The date at hour:minute, as a timestamp without time zone."""
    passed = F.make_dt_interval(F.lit(0), hour.cast("int"), minute.cast("int"))
    return day.cast("timestamp_ntz") + passed


def stamp_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")


def run_date_of(path: Column) -> Column:
    """Run date from ``<table>_YYYYMMDD.csv`` or from a ``run_date=`` folder."""
    dated_file = F.regexp_extract(path, r"_(\d{8})\.csv", 1)
    folder = F.regexp_extract(path, r"run_date=(\d{4}-\d{2}-\d{2})", 1)
    return F.when(dated_file != "", F.try_to_date(dated_file, "yyyyMMdd")).otherwise(
        F.try_to_date(folder, "yyyy-MM-dd")
    )


def as_day(day: dt.date) -> Column:
    return F.lit(day).cast("date")
