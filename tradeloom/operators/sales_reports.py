"""Nine sales reports over one flat ``sales`` table.

Line rows are reduced to one row per order first, so the distinct counts of customers and orders
work on far fewer rows.  Reports are sorted like a report; pass ``ordered=False`` to skip the sort
when the result feeds another job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.ranking import with_rank, with_ranks
from ..session import stored


def with_amount(sales: DataFrame) -> DataFrame:
    """Line amount = quantity times unit price, in whole cents, so that sums are exact."""
    return sales.withColumn("_amount", c.units(F.col("quantity") * F.col("unit_price")))


def _sorted(df: DataFrame, ordered: bool, *by: str | Column) -> DataFrame:
    return df.orderBy(*by) if ordered else df


def _totals(sales: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Orders, customers, items, lines and revenue per key, by way of one row per order."""
    names = [k if isinstance(k, str) else f"_key{i}" for i, k in enumerate(keys)]
    cols = [c.as_col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    per_order = (
        with_amount(sales)
        .groupBy(*cols, "customer_id", "order_id")
        .agg(
            F.sum("_amount").alias("_amount"),
            F.sum(F.col("quantity").cast("long")).alias("_items"),
            F.count("_amount").alias("_lines"),
        )
    )
    return per_order.groupBy(*names).agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("_items").alias("items"),
        F.sum("_lines").alias("lines"),
        c.from_units(F.sum("_amount")).alias("revenue"),
    )


def customer_ranking(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Spend, tier and rank of every customer; ``avg_order_value`` is the mean line amount."""
    customer = ["customer_id", "full_name", "email", "city", "country"]
    named = with_amount(sales).withColumn(
        "full_name", F.concat("first_name", F.lit(" "), "last_name")
    )
    per_order = named.groupBy(*customer, "order_id").agg(
        F.sum("_amount").alias("_amount"),
        F.count("_amount").alias("_lines"),
        F.sum(F.col("quantity").cast("long")).alias("_items"),
        F.min("order_date").alias("_first"),
        F.max("order_date").alias("_last"),
    )
    totals = per_order.groupBy(*customer).agg(
        F.count("order_id").alias("total_orders"),
        c.from_units(F.sum("_amount")).alias("total_spent"),
        F.sum("_lines").alias("_lines"),
        F.sum("_items").alias("total_items_bought"),
        F.min("_first").alias("first_order_date"),
        F.max("_last").alias("last_order_date"),
    )
    totals = stored(totals, "customer_totals")
    ranked = with_rank(totals, [], "total_spent", "spending_rank")
    tier = c.band(F.col("total_spent"), [(1000, "Gold"), (500, "Silver")], "Bronze")
    report = ranked.select(
        *customer,
        tier.alias("customer_tier"),
        "spending_rank",
        "total_orders",
        "total_items_bought",
        "total_spent",
        c.ratio("total_spent", "_lines", 2).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
    )
    return _sorted(report, ordered, "spending_rank")


def sales_by_country(sales: DataFrame, ordered: bool = True) -> DataFrame:
    report = _totals(sales, ["country"]).select(
        "country",
        F.col("customers").alias("customer_count"),
        F.col("orders").alias("order_count"),
        F.col("items").alias("total_items"),
        F.col("revenue").alias("total_revenue"),
        c.ratio("revenue", "lines", 2).alias("avg_order_value"),
        c.ratio("revenue", "customers", 2).alias("lifetime_value_per_customer"),
    )
    return _sorted(report, ordered, F.desc("total_revenue"))


def sales_by_city(sales: DataFrame, ordered: bool = True) -> DataFrame:
    totals = stored(_totals(sales, ["city", "country"]), "city_totals")
    ranked = with_rank(totals, ["country"], "revenue", "city_rank_in_country")
    report = ranked.select(
        "city",
        "country",
        F.col("customers").alias("customer_count"),
        F.col("orders").alias("order_count"),
        F.col("revenue").alias("total_revenue"),
        "city_rank_in_country",
    )
    return _sorted(report, ordered, F.desc("total_revenue"))


def top_category_by_country(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """The category with the highest revenue in each country; ties all stay.

    Rank 1 is the group maximum, so no ranking is needed.
    """
    revenue = with_amount(sales).groupBy("country", "category").agg(
        c.from_units(F.sum("_amount")).alias("revenue")
    )
    revenue = stored(revenue, "category_revenue")
    best = revenue.groupBy(F.col("country").alias("_country")).agg(
        F.max("revenue").alias("_best")
    )
    top = revenue.join(
        best,
        F.col("country").eqNullSafe(F.col("_country")) & (F.col("revenue") == F.col("_best")),
    ).select("country", "category", "revenue", F.lit(1).alias("category_rank"))
    return _sorted(top, ordered, F.desc("revenue"))


def product_performance(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Metrics per product with its rank over all products and in its category."""
    per_customer = (
        with_amount(sales)
        .groupBy("product_name", "category", "customer_id")
        .agg(
            F.count(F.lit(1)).alias("_lines"),
            F.sum(F.col("quantity").cast("long")).alias("_items"),
            F.sum("_amount").alias("_amount"),
            F.sum(c.units("unit_price")).alias("_price"),
            F.count("unit_price").alias("_priced"),
        )
    )
    totals = per_customer.groupBy("product_name", "category").agg(
        F.sum("_lines").alias("times_ordered"),
        F.sum("_items").alias("total_quantity_sold"),
        c.from_units(F.sum("_amount")).alias("total_revenue"),
        c.from_units(F.sum("_price")).alias("_price"),
        F.sum("_priced").alias("_priced"),
        F.count("customer_id").alias("unique_customers"),
    )
    totals = stored(totals, "product_totals")
    ranked = with_ranks(
        totals,
        "total_revenue",
        {"revenue_rank": ([], False), "category_rank": (["category"], False)},
    )
    report = ranked.select(
        "product_name",
        "category",
        "times_ordered",
        "total_quantity_sold",
        "total_revenue",
        c.ratio("_price", "_priced", 2).alias("avg_unit_price"),
        "unique_customers",
        c.ratio("total_revenue", "unique_customers", 2).alias("revenue_per_customer"),
        "revenue_rank",
        "category_rank",
    )
    return _sorted(report, ordered, F.desc("total_revenue"))


def category_performance(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Metrics per category.

    Every distinct count is a pass of its own over stored rows, on narrow keys: all of them in one
    aggregation would multiply the rows of a task by their number.
    """
    rows = stored(
        with_amount(sales).select(
            "category", "product_name", "order_id", "customer_id", "_amount", F.col("quantity").cast("long").alias("_items")
        ),
        "category_lines",
    )
    by_product = rows.groupBy("category", "product_name").agg(
        F.sum("_amount").alias("_amount"), F.count("_amount").alias("_lines"), F.sum("_items").alias("_items")
    )
    report = by_product.groupBy("category").agg(
        F.count("product_name").alias("product_count"),
        F.sum("_items").alias("total_items_sold"),
        c.from_units(F.sum("_amount")).alias("total_revenue"),
        F.sum("_lines").alias("_lines"),
    )
    for column, name in (("order_id", "total_orders"), ("customer_id", "unique_customers")):
        counts = rows.select("category", column).distinct().groupBy(F.col("category").alias("_category"))
        counts = counts.agg(F.count(column).alias(name))
        report = report.join(counts, F.col("category").eqNullSafe(F.col("_category"))).drop("_category")
    report = report.select(
        "category", "product_count", "total_orders", "total_items_sold", "total_revenue", "unique_customers",
        c.ratio("total_revenue", "_lines", 2).alias("avg_order_value"),
    )
    return _sorted(report, ordered, F.desc("total_revenue"))


def daily_sales(sales: DataFrame, ordered: bool = True) -> DataFrame:
    report = _totals(sales, ["order_date"]).select(
        "order_date",
        F.col("orders").alias("orders_count"),
        F.col("customers").alias("unique_customers"),
        F.col("items").alias("items_sold"),
        F.col("revenue").alias("daily_revenue"),
        c.ratio("revenue", "lines", 2).alias("avg_order_value"),
    )
    return _sorted(report, ordered, "order_date")


def sales_by_weekday(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Orders and revenue per weekday, 1 = Sunday."""
    totals = _totals(sales, [F.dayofweek("order_date")])
    names = F.array(
        *[
            F.lit(d)
            for d in (
                "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
            )
        ]
    )
    report = totals.select(
        F.col("_key0").alias("day_of_week"),
        F.try_element_at(names, F.col("_key0")).alias("day_name"),
        F.col("orders").alias("orders_count"),
        F.col("revenue").alias("total_revenue"),
    )
    return _sorted(report, ordered, "day_of_week")


def monthly_trend(sales: DataFrame, ordered: bool = True) -> DataFrame:
    totals = _totals(sales, [F.year("order_date"), F.month("order_date")])
    report = totals.select(
        F.col("_key0").alias("year"),
        F.col("_key1").alias("month"),
        F.col("orders").alias("orders_count"),
        F.col("customers").alias("unique_customers"),
        F.col("revenue").alias("monthly_revenue"),
        c.ratio("revenue", "customers", 2).alias("revenue_per_customer"),
    )
    return _sorted(report, ordered, "year", "month")
