"""Commerce analytics over products, sales, purchases, payments and course offerings.

Listings return one row per line item instead of one row with a nested list: a header with very
many items then stays spread over tasks, and no row grows without bound.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as c

Moment = dt.date | str | None
PAGE_SIZE = 20
MONEY = T.DecimalType(18, 2)


def date_range(start: Moment, end: Moment, as_of: Moment = None) -> tuple[Column, Column]:
    """Both ends of a range, which default to the last thirty days."""
    today = c.as_of_date(as_of)
    first = F.date_sub(today, 30) if start is None else F.lit(str(start)).cast("date")
    last = today if end is None else F.lit(str(end)).cast("date")
    return first, last


def in_range(df: DataFrame, start: Moment, end: Moment, as_of: Moment = None) -> DataFrame:
    first, last = date_range(start, end, as_of)
    return df.filter(F.col("date").between(first, last))


def between_if_given(df: DataFrame, start: Moment, end: Moment, column: str = "date") -> DataFrame:
    """Filter by the ends that are given; a missing end leaves that side open."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(str(end)).cast("date"))
    return df


def page_of(df: DataFrame, page: int, size: int, *order: Column | str) -> DataFrame:
    """One page; ties are broken by the caller's last order column, so pages never overlap.

    A page number costs a sort of all pages before it.  For deep pages the listings take the last
    row of the page before (``after``), so that every page costs the same.
    """
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def older_than(df: DataFrame, after: tuple[Moment, int] | None) -> DataFrame:
    """Rows behind a (date, id) in the order newest first; all rows without one."""
    if after is None:
        return df
    date, last = F.lit(str(after[0])).cast("date"), F.lit(after[1])
    return df.filter((F.col("date") < date) | ((F.col("date") == date) & (F.col("id") < last)))


# ---- summaries ---------------------------------------------------------------------------------


def _money_sum(cond: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(value))), F.lit(0)).cast("decimal(28,2)")


def commerce_summary(
    sale: DataFrame,
    purchase: DataFrame,
    payment: DataFrame,
    start: Moment = None,
    end: Moment = None,
    as_of: Moment = None,
) -> DataFrame:
    """Totals and counts of sales, purchases and payments in a date range, as one row.

    The three tables are reduced to a few counters each, tagged, and summed together.
    """
    incoming = F.col("direction") == "Incoming"
    parts = {
        "sales": in_range(sale, start, end, as_of).agg(
            F.sum("total").alias("a"), F.lit(None).cast("decimal(28,2)").alias("b"),
            F.count(F.lit(1)).alias("n"),
        ),
        "purchases": in_range(purchase, start, end, as_of).agg(
            F.sum("total").alias("a"), F.lit(None).cast("decimal(28,2)").alias("b"),
            F.count(F.lit(1)).alias("n"),
        ),
        "payments": in_range(payment, start, end, as_of).agg(
            F.sum(F.when(incoming, F.col("amount"))).alias("a"),
            F.sum(F.when(F.col("direction") == "Outgoing", F.col("amount"))).alias("b"),
            F.count(F.lit(1)).alias("n"),
        ),
    }
    rows: DataFrame | None = None
    for name, part in parts.items():
        tagged = part.select(
            F.lit(name).alias("part"), F.col("a").cast("decimal(28,2)").alias("a"),
            F.col("b").cast("decimal(28,2)").alias("b"), "n",
        )
        rows = tagged if rows is None else rows.unionByName(tagged)

    def pick(part: str, column: str, zero: object = 0) -> Column:
        found = F.max(F.when(F.col("part") == part, F.col(column)))
        return F.coalesce(found, F.lit(zero).cast("decimal(28,2)" if column != "n" else "long"))

    return rows.agg(
        pick("sales", "a").alias("total_sales"),
        pick("sales", "n").alias("sales_count"),
        pick("purchases", "a").alias("total_purchases"),
        pick("purchases", "n").alias("purchases_count"),
        pick("payments", "a").alias("total_incoming_payments"),
        pick("payments", "b").alias("total_outgoing_payments"),
        (pick("payments", "a") - pick("payments", "b")).alias("net_cash_flow"),
    )


def line_amount() -> Column:
    return F.col("quantity") * F.col("unit_price")


def _top_items(items: DataFrame, product: DataFrame, n: int) -> DataFrame:
    """Top n products by amount; the sum is taken per key before the name is looked up."""
    totals = items.groupBy("product_id").agg(
        F.sum(line_amount().cast(MONEY)).cast("decimal(28,2)").alias("total"),
        F.sum(F.col("quantity").cast("long")).alias("units"),
    )
    known = totals.join(
        product.select(F.col("id").alias("product_id"), "name"), "product_id"
    )
    return known.orderBy(F.desc("total"), "product_id").limit(n)


def top_products(
    sale: DataFrame,
    sale_item: DataFrame,
    product: DataFrame,
    start: Moment = None,
    end: Moment = None,
    as_of: Moment = None,
    n: int = 5,
) -> DataFrame:
    """Best-selling products of a date range by amount."""
    sold = in_range(sale, start, end, as_of).select(F.col("id").alias("sale_id"))
    return _top_items(sale_item.join(sold, "sale_id"), product, n)


def top_products_alltime(sale_item: DataFrame, product: DataFrame, n: int = 5) -> DataFrame:
    return _top_items(sale_item, product, n)


def top_customers(
    sale: DataFrame,
    customer: DataFrame,
    start: Moment = None,
    end: Moment = None,
    as_of: Moment = None,
    n: int = 5,
) -> DataFrame:
    totals = in_range(sale, start, end, as_of).groupBy("customer_id").agg(
        F.sum("total").cast("decimal(28,2)").alias("total"),
        F.count(F.lit(1)).alias("sales_count"),
    )
    known = totals.join(
        customer.select(F.col("id").alias("customer_id"), "name"), "customer_id"
    )
    return known.orderBy(F.desc("total"), "customer_id").limit(n)


def daily_breakdown(
    sale: DataFrame,
    purchase: DataFrame,
    start: Moment = None,
    end: Moment = None,
    as_of: Moment = None,
) -> DataFrame:
    """Sales and purchases per day; a day with only one of them shows 0 for the other."""

    def per_day(df: DataFrame, name: str) -> DataFrame:
        return (
            in_range(df, start, end, as_of)
            .groupBy(F.col("date").cast("date").alias("date"))
            .agg(F.sum("total").alias(name))
        )

    days = per_day(sale, "sales").join(per_day(purchase, "purchases"), "date", "full_outer")
    zero = F.lit(0).cast("decimal(28,2)")
    return days.select(
        "date",
        F.coalesce("sales", zero).cast("decimal(28,2)").alias("sales"),
        F.coalesce("purchases", zero).cast("decimal(28,2)").alias("purchases"),
    ).orderBy("date")


def last30_totals(documents: DataFrame, as_of: Moment = None) -> DataFrame:
    """Total, count and average of sales or purchases since thirty days ago."""
    recent = documents.filter(F.col("date") >= F.date_sub(c.as_of_date(as_of), 30))
    totals = recent.agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(28,2)").alias("total"),
        F.count(F.lit(1)).alias("document_count"),
    )
    return totals.withColumn("average", c.divide_or_zero("total", "document_count"))


def payments_last30(payment: DataFrame, as_of: Moment = None) -> DataFrame:
    recent = payment.filter(F.col("date") >= F.date_sub(c.as_of_date(as_of), 30))
    return recent.agg(
        _money_sum(F.col("direction") == "Incoming", "amount").alias("incoming"),
        _money_sum(F.col("direction") == "Outgoing", "amount").alias("outgoing"),
    ).withColumn("net", (F.col("incoming") - F.col("outgoing")).cast("decimal(28,2)"))


# ---- listings ----------------------------------------------------------------------------------


def _document_listing(
    documents: DataFrame,
    items: DataFrame,
    product: DataFrame,
    partner: DataFrame,
    partner_kind: str,
    document_kind: str,
    start: Moment,
    end: Moment,
    page: int,
    size: int,
    after: tuple[Moment, int] | None,
) -> DataFrame:
    chosen = older_than(between_if_given(documents, start, end), after)
    headers = page_of(chosen, page, size, F.desc("date"), F.desc("id"))
    partners = partner.select(
        F.col("id").alias(f"{partner_kind}_id"), F.col("name").alias(f"{partner_kind}_name")
    )
    lines = items.select(
        F.col("id").alias("item_id"),
        F.col(f"{document_kind}_id").alias("id"),
        "product_id",
        "quantity",
        "unit_price",
    )
    names = product.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    return (
        headers.join(partners, f"{partner_kind}_id")
        .join(lines, "id", "left")
        .join(names, "product_id", "left")
        .select(
            "id",
            "date",
            f"{partner_kind}_id",
            f"{partner_kind}_name",
            "total",
            "status",
            "notes",
            "item_id",
            "product_id",
            "product_name",
            "quantity",
            "unit_price",
            line_amount().cast(MONEY).alias("line_total"),
        )
        # Joins lose the order of the page, which is small enough to be sorted again.
        .orderBy(F.desc("date"), F.desc("id"), "item_id")
    )


def sales_listing(
    sale: DataFrame,
    sale_item: DataFrame,
    product: DataFrame,
    customer: DataFrame,
    start: Moment = None,
    end: Moment = None,
    page: int = 1,
    size: int = PAGE_SIZE,
    after: tuple[Moment, int] | None = None,
) -> DataFrame:
    """A page of sales, newest first, with one row per item."""
    return _document_listing(
        sale, sale_item, product, customer, "customer", "sale", start, end, page, size,
        after,
    )


def purchases_listing(
    purchase: DataFrame,
    purchase_item: DataFrame,
    product: DataFrame,
    supplier: DataFrame,
    start: Moment = None,
    end: Moment = None,
    page: int = 1,
    size: int = PAGE_SIZE,
    after: tuple[Moment, int] | None = None,
) -> DataFrame:
    """A page of purchases, newest first, with one row per item."""
    return _document_listing(
        purchase, purchase_item, product, supplier, "supplier", "purchase", start, end, page, size,
        after,
    )


def nested(listing: DataFrame) -> DataFrame:
    """A listing with one row per document, newest first, and its items as an array of structs.

    The page is cut before the items are looked up, so the number of its documents bounds the rows; a
    document without items has an empty array.
    """
    item = ["item_id", "product_id", "product_name", "quantity", "unit_price", "line_total"]
    header = [c for c in listing.columns if c not in item]
    entry = F.when(F.col("item_id").isNotNull(), F.struct(*item))
    return (
        listing.groupBy(*header)
        .agg(F.sort_array(F.collect_list(entry)).alias("items"))
        .orderBy(F.desc("date"), F.desc("id"))
    )


def payments_listing(
    payment: DataFrame,
    direction: str | None = None,
    start: Moment = None,
    end: Moment = None,
    page: int = 1,
    size: int = PAGE_SIZE,
    after: tuple[Moment, int] | None = None,
) -> DataFrame:
    chosen = older_than(between_if_given(payment, start, end), after)
    if direction is not None:
        chosen = chosen.filter(F.col("direction") == direction)
    return page_of(chosen, page, size, F.desc("date"), F.desc("id")).select(
        "id", "date", "amount", "direction", "reference_id", "reference_type", "notes"
    )


def _search(
    df: DataFrame, search: str | None, columns: list[str], page: int, size: int
) -> DataFrame:
    if search:
        hit = F.lit(False)
        for name in columns:
            hit = hit | F.coalesce(F.col(name).contains(search), F.lit(False))
        df = df.filter(hit)
    return page_of(df, page, size, "name", "id")


def customer_search(
    customer: DataFrame, search: str | None = None, page: int = 1, size: int = PAGE_SIZE
) -> DataFrame:
    return _search(customer, search, ["name", "email"], page, size).select(
        "id", "name", "email", "phone"
    )


def product_search(
    product: DataFrame, search: str | None = None, page: int = 1, size: int = PAGE_SIZE
) -> DataFrame:
    return _search(product, search, ["name", "sku"], page, size).select(
        "id", "name", "sku", "description", "unit_price", "stock_quantity", "is_active"
    )


def supplier_search(
    supplier: DataFrame, search: str | None = None, page: int = 1, size: int = PAGE_SIZE
) -> DataFrame:
    return _search(supplier, search, ["name"], page, size).select(
        "id", "name", "email", "phone", "address", "is_active"
    )


# ---- courses and users -------------------------------------------------------------------------


def reference_list(kind: str, table: DataFrame) -> DataFrame:
    """Classes, subjects and sections by name; timelines newest first."""
    columns = {
        "class": ["id", "name", "description", "is_active"],
        "subject": ["id", "name", "description", "is_active"],
        "section": ["id", "name", "capacity", "is_active"],
        "timeline": ["id", "name", "start_date", "end_date", "is_active"],
    }[kind]
    order = F.desc("start_date") if kind == "timeline" else F.asc("name")
    return table.select(*columns).orderBy(order)


def active_users(users: DataFrame, page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    return page_of(users.filter(~F.col("is_deleted")), page, size, "full_name", "id").select(
        "id", "full_name", "email"
    )


def offering_listing(
    offering: DataFrame,
    classes: DataFrame,
    subject: DataFrame,
    section: DataFrame,
    timeline: DataFrame,
    users: DataFrame,
    class_id: int | None = None,
    subject_id: int | None = None,
    section_id: int | None = None,
    start: Moment = None,
    end: Moment = None,
    page: int | None = 1,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """Offerings with class, subject, section, timeline and optional instructor.

    Filters are applied before the joins.  ``page=None`` returns every offering, unsorted.
    """
    chosen = offering
    wanted = {"class_id": class_id, "subject_id": subject_id, "section_id": section_id}
    for column, value in wanted.items():
        if value is not None:
            chosen = chosen.filter(F.col(column) == value)
    spans = between_if_given(timeline, start, None, "start_date")
    spans = between_if_given(spans, None, end, "end_date")

    def named(df: DataFrame, kind: str, *more: str) -> DataFrame:
        return df.select(
            F.col("id").alias(f"{kind}_id"), F.col("name").alias(f"{kind}_name"), *more
        )

    instructors = users.select(
        F.col("id").alias("instructor_id"), F.col("full_name").alias("instructor_name")
    )
    joined = (
        chosen.join(named(spans, "timeline", "start_date", "end_date"), "timeline_id")
        .join(named(classes, "class"), "class_id")
        .join(named(subject, "subject"), "subject_id")
        .join(named(section, "section"), "section_id")
        .join(instructors, "instructor_id", "left")
        .select(
            "id",
            "class_id",
            "class_name",
            "subject_id",
            "subject_name",
            "section_id",
            "section_name",
            "timeline_id",
            "timeline_name",
            "start_date",
            "end_date",
            "instructor_id",
            "instructor_name",
        )
    )
    if page is None:
        return joined
    return page_of(joined, page, size, "class_name", "subject_name", "id")


# ---- stock -------------------------------------------------------------------------------------


def stock_changes(
    purchase: DataFrame, purchase_item: DataFrame, sale: DataFrame, sale_item: DataFrame
) -> DataFrame:
    """Signed stock change per product and day: purchases add, sales subtract.

    Items are summed per document and product before the header's date is looked up.
    """

    def side(documents: DataFrame, items: DataFrame, kind: str, sign: int) -> DataFrame:
        summed = items.groupBy(f"{kind}_id", "product_id").agg(
            (F.sum(F.col("quantity").cast("long")) * sign).alias("change")
        )
        dates = documents.select(
            F.col("id").alias(f"{kind}_id"), F.col("date").cast("date").alias("date")
        )
        return summed.join(dates, f"{kind}_id").select("product_id", "date", "change")

    changes = side(purchase, purchase_item, "purchase", 1).unionByName(
        side(sale, sale_item, "sale", -1)
    )
    return changes.groupBy("product_id", "date").agg(F.sum("change").alias("change"))


def stock_on_hand(product: DataFrame, changes: DataFrame) -> DataFrame:
    """Opening stock plus all changes, per product.

    A deleted document is absent from the inputs, which takes its effect back.
    """
    moved = changes.groupBy(F.col("product_id").alias("id")).agg(F.sum("change").alias("change"))
    change = F.coalesce("change", F.lit(0))
    return product.join(moved, "id", "left").select(
        F.col("id").alias("product_id"),
        "name",
        F.col("stock_quantity").cast("long").alias("opening_stock"),
        change.alias("net_change"),
        (F.col("stock_quantity") + change).alias("on_hand"),
    )


def running_stock(product: DataFrame, changes: DataFrame) -> DataFrame:
    """Stock per product at the end of each day with a change.

    Changes are summed per day, so the window of a product holds at most one row per day.
    """
    days = Window.partitionBy("product_id").orderBy("date").rowsBetween(
        Window.unboundedPreceding, 0
    )
    opening = product.select(
        F.col("id").alias("product_id"), F.col("stock_quantity").alias("_opening")
    )
    return (
        changes.withColumn("_running", F.sum("change").over(days))
        .join(opening, "product_id")
        .select(
            "product_id",
            "date",
            "change",
            (F.col("_opening") + F.col("_running")).alias("on_hand"),
        )
    )


def order_total(items: DataFrame, document_id: str) -> DataFrame:
    """Header total of every sale or purchase from its items."""
    return items.groupBy(document_id).agg(
        F.sum(line_amount().cast(MONEY)).cast("decimal(28,2)").alias("total")
    )
