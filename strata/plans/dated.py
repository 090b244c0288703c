"""Dated silver orders, and the daily revenue of the dates that changed. `unit` is that of the tables' folders: all calls take the same."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold
from strata.sources import layout, tables
from strata.sources.files import remove
from strata.sources.scratch import scratch_root
from strata.sources.tables import Written, write_files


@contextmanager
def _worked_out(orders: DataFrame, root: str, folder: str, stored: bool) -> Iterator[DataFrame]:
    """The orders, worked out once into a folder that goes afterwards; as they are where `stored` says that they are read from files.

    The shuffles that clean them are gone before they are dealt to their dates, which shuffles them again.
    """
    if stored:
        yield orders
        return
    spark, path = orders.sparkSession, scratch_root(f"{root.rstrip('/')}/silver/{folder}", "orders")
    try:
        write_files(orders, path)
        yield spark.read.parquet(path)
    finally:
        remove(spark, path)


def write_dated_orders(orders: DataFrame, root: str, unit: str = "day", stored: bool = False) -> Written:
    """silver.orders_dated: clean orders by the date of their event. They are worked out once, as late ones are."""
    with _worked_out(orders, root, "_new", stored) as orders:
        return layout.write_dated(orders, root, "silver", "orders_dated", unit=unit)


def add_late_orders(orders: DataFrame, root: str, unit: str = "day", stored: bool = False) -> Written:
    """Adds clean orders, of ids that the table does not have, to their dates; only the folders of these dates are rewritten.

    The orders are read for their dates, then for their rows, so they are worked out once into a folder that goes afterwards; not so
    where `stored` says that they are read from files already.
    """
    spark = orders.sparkSession
    known = tables.try_read_table(spark, root, "silver", "orders_dated")
    if known is None:
        return write_dated_orders(orders, root, unit, stored)
    with _worked_out(orders, root, "_late", stored) as orders:
        new = layout.dated(orders, unit=unit)
        same_dates = known.where(layout.touches(new)).select(*new.columns)
        return layout.replace_dates(same_dates.unionByName(new), root, "silver", "orders_dated", unit=unit)


def revenue_between(spark: SparkSession, root: str, first=None, last=None, unit: str = "day", clock: Column | None = None) -> DataFrame:
    """Daily revenue of some days, from the files of their dates alone."""
    orders = tables.read_table(spark, root, "silver", "orders_dated")
    return gold.daily_revenue(layout.between(orders, first, last, unit=unit), clock)


def latest_revenue(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """Daily revenue of the latest n days with completed orders, newest first.

    Dates without completed orders have no revenue, so the latest folders are taken, doubling their number, until they have n days.
    """
    wide, known = n, len(layout.date_folders(spark, root, "silver", "orders_dated"))
    while True:
        daily = gold.daily_revenue(layout.latest_dates(spark, root, "silver", "orders_dated", wide))
        if wide >= known or daily.count() >= n:
            return daily.orderBy(F.desc_nulls_last("date")).limit(n)
        wide *= 2


def refresh_dates(spark: SparkSession, root: str, new: DataFrame, unit: str = "day", clock: Column | None = None) -> Written:
    """Brings gold.daily_revenue_dated up to date for the dates of the orders `new` alone: only these dates' orders are read, only their
    folders written. Of `new` the dates are read: orders that are costly to work out should be stored before."""
    orders = tables.read_table(spark, root, "silver", "orders_dated").where(layout.touches(layout.dated(new, unit=unit)))
    return layout.replace_dates(gold.daily_revenue(orders, clock), root, "gold", "daily_revenue_dated", "date", unit)
