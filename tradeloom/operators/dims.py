"""Star schema, dimensions: nine tables with natural keys, plus the currency list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c

# The calendar range of the date dimension.
CALENDAR = ("2020-01-01", "2030-12-31")


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"_is_current": F.lit(True), "_gold_timestamp": F.current_timestamp()}
    )


def current(dim: DataFrame) -> DataFrame:
    """The rows of a dimension that hold now."""
    return dim.filter("_is_current") if "_is_current" in dim.columns else dim


def dim_date(spark: SparkSession, calendar: tuple[str, str] = CALENDAR) -> DataFrame:
    """One row per day.  Its size is fixed by the range, not by the data."""
    first, last = (F.lit(d).cast("date") for d in calendar)
    return _calendar_days(spark.range(1).select(first.alias("first"), last.alias("last")))


def dim_date_covering(table: DataFrame, date_col: str) -> DataFrame:
    """The calendar from the first to the last date of a table."""
    date = F.col(date_col).cast("date")
    return _calendar_days(table.agg(F.min(date).alias("first"), F.max(date).alias("last")))


def _calendar_days(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    year, half = F.year("date").cast("string"), F.when(F.month("date") <= 6, "-H1")
    return days.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        F.date_format("date", "MMMM").alias("month_name"),
        c.year_month("date").alias("year_month"),
        F.concat(F.lit("FY"), year, half.otherwise("-H2")).alias("fiscal_period"),
        F.year("date").alias("fiscal_year"),
        F.quarter("date").alias("fiscal_quarter"),
    )


def dim_vendor(vendors: DataFrame) -> DataFrame:
    """Vendors with tier (from the rating) and status (from the pre-qualification).

    ``sector`` is trimmed as well as upper-cased, like the key of ``dim_sector``, so padded
    values still join.
    """
    approval = F.upper("prequalification_status")
    return _stamp(
        vendors.select(
            "vendor_id",
            "vendor_code",
            "vendor_name",
            "vendor_type",
            F.col("sector_specialization").alias("vendor_sector"),
            c.code("sector_specialization").alias("sector"),
            F.col("country").alias("vendor_country"),
            F.col("state").alias("vendor_state"),
            F.col("city").alias("vendor_city"),
            "payment_terms_days",
            "credit_limit_usd",
            "performance_rating",
            "risk_category",
            "prequalification_status",
            F.col("prequalification_expiry_date").alias("prequalification_expiry"),
            "iso_certified",
            "hse_rating",
            "minority_owned",
            "small_business",
            F.col("contact_name").alias("primary_contact"),
            "contact_email",
            "contact_phone",
            "annual_turnover_usd",
            "years_in_business",
            c.band(
                F.col("performance_rating"), [(4, "STRATEGIC"), (3, "PREFERRED")], "STANDARD"
            ).alias("tier"),
            F.when(approval == "APPROVED", "ACTIVE")
            .when(approval == "PENDING", "PENDING")
            .otherwise("INACTIVE")
            .alias("status"),
        )
    )


def dim_project(projects: DataFrame) -> DataFrame:
    return _stamp(
        projects.select(
            "project_id",
            "project_code",
            "project_name",
            "project_type",
            "client_name",
            "sector",
            "state",
            "project_manager",
            "contract_value_usd",
            "approved_budget_usd",
            "budget_variance_pct",
            "project_status",
            F.col("project_status").alias("status"),
            "start_date",
            F.col("planned_completion_date").alias("end_date"),
            "actual_completion_date",
            F.col("planned_duration_days").alias("project_duration_days"),
            "priority",
            "risk_level",
            c.region_of("country").alias("region"),
        )
    )


def dim_material(materials: DataFrame) -> DataFrame:
    return _stamp(
        materials.select(
            "material_id",
            "material_code",
            "material_name",
            "category",
            F.col("category").alias("material_category"),
            "sub_category",
            "unit_price",
            "weight_kg",
            "lead_time_days",
            "is_active",
        )
    )


def dim_employee(employees: DataFrame) -> DataFrame:
    return _stamp(
        employees.select(
            "employee_id",
            "employee_code",
            "full_name",
            "department",
            "job_title",
            "grade",
            "approval_limit",
            "location",
            "is_active",
            "cost_center",
            "hire_date",
        )
    )


def dim_geography(projects: DataFrame, vendors: DataFrame) -> DataFrame:
    """Distinct places of projects and vendors.

    A missing part of a place counts as empty text in the key, so the key is never NULL.
    """
    place = ["country", "state", "city"]
    parts = [F.coalesce(F.col(p), F.lit("")) for p in place]
    key = F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2])
    places = projects.select(*place).union(vendors.select(*place)).distinct()
    return _stamp(
        places.select(
            F.sha2(key, 256).alias("geography_key"), *place, c.region_of("country").alias("region")
        )
    )


def dim_contract(contracts: DataFrame) -> DataFrame:
    growth = c.difference("revised_value", "contract_value")
    return _stamp(
        contracts.select(
            "contract_id",
            "vendor_id",
            "project_id",
            "contract_type",
            "contract_status",
            F.col("contract_status").alias("status"),
            "contract_value",
            F.col("contract_value").alias("original_value"),
            "revised_value",
            "start_date",
            "end_date",
            "contract_duration_days",
            "payment_terms",
            "retention_pct",
            F.col("performance_bond_pct").alias("performance_bond"),
            F.col("variation_orders").alias("change_order_count"),
            growth.alias("change_order_value"),
            c.percent_or_zero(growth, "contract_value").alias("cost_growth_pct"),
            F.col("contract_manager_id").alias("approved_by"),
        )
    )


def dim_cost_center(employees: DataFrame) -> DataFrame:
    pairs = employees.select("cost_center", "department").distinct()
    return _stamp(
        pairs.select(
            F.col("cost_center").alias("cost_center_key"),
            F.col("cost_center").alias("cost_center_code"),
            F.col("department").alias("cost_center_category"),
        )
    )


def dim_sector(vendors: DataFrame, projects: DataFrame) -> DataFrame:
    names = vendors.select(c.code("sector_specialization").alias("sector_name")).union(
        projects.select(c.code("sector"))
    )
    return _stamp(
        names.distinct().select(F.col("sector_name").alias("sector_key"), "sector_name")
    )


def dim_currency(*facts: DataFrame) -> DataFrame:
    """Distinct currency codes of any facts."""
    codes = [f.select(c.code("currency").alias("currency_key")).distinct() for f in facts]
    out = codes[0]
    for more in codes[1:]:
        out = out.union(more)
    out = out.filter("currency_key IS NOT NULL").distinct()
    return _stamp(out.withColumn("currency_code", F.col("currency_key")))
