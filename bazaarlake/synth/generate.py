"""The five tables at any size, from a seed.

Tables are ``spark.range`` plus expressions.  An order's customer is a draw, and the
customer's sign-up date follows from the customer's id, so orders need no join.  The
only shuffles are the running total that numbers the items and the few picked orders
that get a future date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.functions import draws, scalars
from bazaarlake.operators import defects
from bazaarlake.operators.picks import cutoff_of
from bazaarlake.operators.prefix import running_total, running_total_before
from bazaarlake.synth import catalogue
from bazaarlake.tables import RetailTables

# Stand-ins for locale text; any list does.
FIRST_NAMES = ["Asha", "Ravi", "Meera", "Arjun", "Kavya", "Rohan", "Divya", "Vikram", "Priya", "Sanjay",
               "Lakshmi", "Nikhil", "Ananya", "Suresh", "Pooja", "Manish"]
LAST_NAMES = ["Rao", "Nair", "Das", "Sharma", "Patel", "Reddy", "Iyer", "Gupta", "Menon", "Singh",
              "Joshi", "Kulkarni", "Bose"]
CITIES = ["Pune", "Kochi", "Delhi", "Mumbai", "Chennai", "Kolkata", "Jaipur", "Nagpur", "Surat",
          "Indore", "Mysuru"]

ROWS_PER_PARTITION = 1_000_000


@dataclass(frozen=True)
class Sizes:
    target_items: int
    customers: int
    orders: int

    @staticmethod
    def of(target_items: int) -> Sizes:
        return Sizes(
            target_items=target_items,
            customers=max(fixed.MIN_CUSTOMERS, target_items // fixed.ITEMS_PER_CUSTOMER),
            orders=max(fixed.MIN_ORDERS, target_items // fixed.ITEMS_PER_ORDER),
        )


def size_columns(target: str) -> list[Column]:
    """The same rule as ``Sizes.of``, from a column of targets."""
    return [
        F.expr(f"greatest({fixed.MIN_CUSTOMERS}L, {target} div {fixed.ITEMS_PER_CUSTOMER})").alias("num_customers"),
        F.expr(f"greatest({fixed.MIN_ORDERS}L, {target} div {fixed.ITEMS_PER_ORDER})").alias("num_orders"),
    ]


@dataclass(frozen=True)
class Maker:
    """One made run: everything below follows from these values."""

    spark: SparkSession
    sizes: Sizes
    as_of: dt.date
    seed: int = 1
    popular: bool = False
    # Given ids (column ``id``, 1 to the size without gaps); else they are counted up.
    customer_ids: DataFrame | None = None
    order_ids: DataFrame | None = None

    # Draws ------------------------------------------------------------------

    def _draw(self, label: str, *ids: Column, slot: int = 0) -> Column:
        return draws.draw(self.seed, label, *ids, slot=slot)

    def _opening_time(self, day: Column, label: str, *ids: Column) -> Column:
        hour = draws.between(self._draw(label, *ids, slot=0), fixed.OPENING_HOUR, fixed.CLOSING_HOUR)
        minute = draws.between(self._draw(label, *ids, slot=1), 0, 59)
        return scalars.day_at(day, hour, minute)

    def signup_age(self, customer_id: Column) -> Column:
        """Days from sign-up to the day of the run."""
        return (self._draw("signup", customer_id) % (fixed.SIGNUP_WINDOW_DAYS + 1)).cast("int")

    def _customer_of(self, order_id: Column) -> Column:
        return F.lit(1) + self._draw("customer", order_id) % self.sizes.customers

    def with_order_date(self, df: DataFrame) -> DataFrame:
        """Add order_date from order_id and customer_id: a day since the customer's sign-up.

        An expression of ids, so neither orders nor items are joined for it.
        """
        later = (self._draw("order_date", F.col("order_id")) % (F.col("_age") + 1)).cast("int")
        return (
            df.withColumn("_age", self.signup_age(F.col("customer_id")))
            .withColumn("order_date", F.date_add(scalars.as_day(self.as_of), later - F.col("_age")))
            .drop("_age")
        )

    def basket_size(self, order_id: Column) -> Column:
        return draws.weighted(self._draw("basket_size", order_id), fixed.BASKET_SIZE_WEIGHTS)

    def with_basket(self, df: DataFrame) -> DataFrame:
        """Add ``basket``: basket_size different product ids for order_id."""
        weights = catalogue.POPULAR_WEIGHTS if self.popular else catalogue.UNIFORM_WEIGHTS
        largest = max(n for n, _ in fixed.BASKET_SIZE_WEIGHTS)
        hs = draws.draws(self.seed, "basket", largest, F.col("order_id"))
        picked = draws.with_distinct_picks(df, "_picks", hs, F.col("basket_size"), weights)
        return picked.withColumn("basket", F.transform("_picks", lambda position: position + 1)).drop("_picks")

    def _partitions(self, rows: int) -> int:
        return max(-(-rows // ROWS_PER_PARTITION), self.spark.sparkContext.defaultParallelism)

    def _ids(self, count: int) -> DataFrame:
        return self.spark.range(1, count + 1, numPartitions=self._partitions(count))

    def _orders(self) -> DataFrame:
        return self._ids(self.sizes.orders) if self.order_ids is None else self.order_ids

    # Tables -----------------------------------------------------------------

    def categories(self) -> DataFrame:
        return catalogue.categories(self.spark)

    def products(self) -> DataFrame:
        return catalogue.products(self.spark)

    def customers(self) -> DataFrame:
        cid = F.col("id")
        suffix = draws.between(self._draw("suffix", cid), 1000, 9999)

        def one_of(label: str, values: list[str]) -> Column:
            return draws.choice(self._draw(label, cid), draws.constants(values))

        ids = self._ids(self.sizes.customers) if self.customer_ids is None else self.customer_ids
        drawn = ids.select(
            cid.alias("customer_id"),
            one_of("first_name", FIRST_NAMES).alias("first_name"),
            one_of("last_name", LAST_NAMES).alias("last_name"),
            suffix.alias("suffix"),
            F.concat(F.lit("+91"), F.lpad((self._draw("phone", cid) % 10**5).cast("string"), 5, "0"),
                     F.lpad((self._draw("phone", cid, slot=1) % 10**5).cast("string"), 5, "0")).alias("phone"),
            one_of("city", CITIES).alias("city"),
            F.date_sub(scalars.as_day(self.as_of), self.signup_age(cid)).alias("signup_date"),
        )
        stamp = self._opening_time(F.col("signup_date"), "customer_time", F.col("customer_id"))
        email = F.concat(F.lower("first_name"), F.lower("last_name"), F.col("suffix").cast("string"),
                         F.lit("@example.com"))
        return drawn.select(
            "customer_id", "first_name", "last_name", email.alias("email"), "phone", "city", "signup_date",
            stamp.alias("created_at"), stamp.alias("updated_at"),
        )

    def orders(self) -> DataFrame:
        oid = F.col("order_id")
        picked = self._orders().select(
            F.col("id").alias("order_id"), self._customer_of(F.col("id")).alias("customer_id"),
        )
        dated = self.with_order_date(picked)
        stamp = self._opening_time(F.col("order_date"), "order_time", oid)
        return dated.select(
            "order_id", "customer_id", "order_date",
            draws.choice(self._draw("payment", oid), draws.constants(fixed.PAYMENT_METHODS)).alias("payment_method"),
            draws.weighted(self._draw("status", oid), fixed.STATUS_WEIGHTS).alias("order_status"),
            stamp.alias("created_at"), stamp.alias("updated_at"),
        )

    def baskets(self) -> DataFrame:
        """Orders that get items, with the number of items before them.

        Items are numbered through the orders by id until the target is reached; orders
        past it get none.
        """
        sized = self._orders().select(
            F.col("id").alias("order_id"), self.basket_size(F.col("id")).alias("basket_size")
        )
        partitions = self._partitions(self.sizes.target_items)
        if self.order_ids is None:
            numbered = running_total_before(
                sized, "basket_size", "order_id", 1, self.sizes.orders, "items_before", partitions=partitions)
        else:  # ids of a given table may have gaps
            numbered = running_total(sized, "basket_size", "order_id", "items_before", partitions)
        return numbered.where(F.col("items_before") < self.sizes.target_items)

    def order_items(self) -> DataFrame:
        """The last order may be cut short at the target, as the count demands."""
        oid, iid = F.col("order_id"), F.col("order_item_id")
        exploded = self.with_basket(self.baskets()).select(
            # Baskets are never empty; the outer form keeps Spark from adding a test for it,
            # which would work out every basket twice.
            oid, "items_before", F.posexplode_outer("basket").alias("position", "product_id"),
        )
        numbered = exploded.withColumn("order_item_id", F.col("items_before") + F.col("position") + 1).where(
            iid <= self.sizes.target_items
        )
        dated = self.with_order_date(numbered.withColumn("customer_id", self._customer_of(oid)))
        drawn = dated.join(F.broadcast(catalogue.product_facts(self.spark)), "product_id").select(
            iid, oid, "product_id", "product_name",
            draws.weighted(self._draw("quantity", iid), fixed.QUANTITY_WEIGHTS).alias("quantity"),
            F.col("default_price").alias("unit_price"),
            draws.choice(self._draw("discount", iid), F.col("discounts")).alias("discount"),
            F.col("order_date").alias("day"),
        )
        stamp = self._opening_time(F.col("day"), "item_time", iid)
        return drawn.select(
            iid, oid, "product_id", "product_name", "quantity", "unit_price", "discount",
            scalars.discounted(F.col("unit_price"), F.col("discount")).alias("final_price"),
            stamp.alias("created_at"), stamp.alias("updated_at"),
        )

    def sound_tables(self) -> RetailTables:
        return RetailTables(
            categories=self.categories(), products=self.products(), customers=self.customers(),
            orders=self.orders(), order_items=self.order_items(),
        )

    # Defects ----------------------------------------------------------------

    def item_count(self) -> int:
        """Items up to the target, or up to the last basket if that ends earlier."""
        sized = self._orders().select(self.basket_size(F.col("id")).alias("n"))
        return min(sized.agg(F.sum("n").alias("n")).first()["n"], self.sizes.target_items)

    def item_ids(self, count: int) -> DataFrame:
        """The ids of the items: a pick needs no more, so it does not build the items."""
        if self.order_ids is None:
            return self._ids(count).withColumnRenamed("id", "order_item_id")
        last = F.least(F.col("items_before") + F.col("basket_size"), F.lit(count))
        return self.baskets().select(F.explode(F.sequence(F.col("items_before") + 1, last)).alias("order_item_id"))

    def is_defective(self) -> Column:
        """Picks the wanted share of items, rounded down, to the exact row."""
        count, iid = self.item_count(), F.col("order_item_id")
        draw = self._draw("defect", iid)
        wanted = count * fixed.DEFECT_RATE_PERCENT // 100
        return cutoff_of(self.item_ids(count), draw, "order_item_id", wanted).picks(draw, iid)

    def defect_kind(self) -> Column:
        """Kind of defect of each item: null for most."""
        draw = self._draw("defect_kind", F.col("order_item_id"))
        return F.when(self.is_defective(), draws.choice(draw, draws.constants(fixed.DEFECT_KINDS)))

    def with_defects(self, tables: RetailTables) -> RetailTables:
        marked = tables.order_items.withColumn("defect", self.defect_kind())
        is_kind = {kind: F.coalesce(F.col("defect") == kind, F.lit(False)) for kind in fixed.DEFECT_KINDS}
        size = draws.between(self._draw("defect_size", F.col("order_item_id")), 1, 5)
        items = defects.break_product(marked, is_kind["invalid_fk"])
        items = defects.negate_quantity(items, is_kind["negative_qty"], size)
        postdated = marked.where(is_kind["future_date"])
        return tables.having(
            order_items=items.drop("defect"),
            orders=defects.postdate_orders(tables.orders, postdated, self.as_of),
        )

    def tables(self) -> RetailTables:
        return self.with_defects(self.sound_tables())


def maker(spark: SparkSession, target_items: int, as_of: dt.date, seed: int = 1, popular: bool = False) -> Maker:
    return Maker(spark, Sizes.of(target_items), as_of, seed, popular)
