"""The star schema as one record of DataFrames."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from bazaarlake import schemas


@dataclass(frozen=True)
class RetailTables:
    categories: DataFrame
    products: DataFrame
    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    #: Where the tables hold several runs, told apart by `run_date`: the run that questions are asked of.
    published: dt.date | None = None

    def asked(self) -> RetailTables:
        """The tables of one run: the published one, where they hold several and the caller chose none."""
        return self if self.published is None else self.of_run(self.published)

    def of_run(self, run_date: dt.date) -> RetailTables:
        """One run of all tables; a partition filter, so other runs are not read."""
        scoped = {name: df.where(F.col("run_date") == F.lit(run_date).cast("date")) for name, df in self.items()}
        return replace(self, published=None, **scoped)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in schemas.TABLES]

    def having(self, **changed: DataFrame) -> RetailTables:
        return replace(self, **changed)
