"""Calendar, commodity, partner and product dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import PRODUCT_GROUPS, PRODUCT_YEARS, TradeDomain
from monthwise.functions.months import month_spine
from monthwise.plans.staging import has_break, segment


def product_groups(spark: SparkSession) -> DataFrame:
    """The built-in leaf mapping as rows (33 leaves)."""
    first, last = PRODUCT_YEARS
    rows = ", ".join(
        f"('{code}', '{group}', {first}, {last})"
        for group, codes in PRODUCT_GROUPS.items()
        for code in codes
    )
    # VALUES have a known size, so that joins with the mapping broadcast it instead of shuffling the cells.
    schema = contracts.schema("product_groups")
    values = spark.sql(f"SELECT * FROM VALUES {rows} AS leaves({', '.join(schema.names)})")
    return values.select(*[F.col(field.name).cast(field.dataType) for field in schema])


def _calendar(months: DataFrame) -> DataFrame:
    month = F.col("month_key")
    return contracts.conform(
        months.select(
            "month_key",
            F.year(month).cast("long").alias("calendar_year"),
            F.quarter(month).cast("long").alias("calendar_quarter"),
            F.month(month).cast("long").alias("calendar_month"),
            F.date_format(month, "yyyy-MM").alias("month_label"),
        ),
        "dim_calendar_month",
    )


def calendar(
    spark: SparkSession, start: date = date(2015, 1, 1), last: date = date(2026, 8, 1)
) -> DataFrame:
    """dim_calendar_month between two bounds, both included."""
    spine = F.explode(month_spine(F.lit(start), F.lit(last))).alias("month_key")
    return _calendar(spark.range(1).select(spine))


def calendar_of(rows: DataFrame, month: str = "period_month") -> DataFrame:
    """dim_calendar_month spanning the months that occur in a table."""
    bounds = rows.agg(F.min(month).alias("first"), F.max(month).alias("last"))
    return _calendar(
        bounds.where(F.col("first").isNotNull()).select(
            F.explode(month_spine(F.col("first"), F.col("last"))).alias("month_key")
        )
    )


def commodity(
    spark: SparkSession, entries: tuple[tuple[str, str], ...] = (("coffee", "Coffee"), ("cocoa", "Cocoa"))
) -> DataFrame:
    """dim_commodity."""
    return spark.createDataFrame(list(entries), contracts.schema("dim_commodity"))


def trade_partner(staged: DataFrame) -> DataFrame:
    """dim_trade_partner: one label per partner and how many labels it had.

    Labels are reduced to distinct ones first, so a partner that holds most rows
    leaves each task as a handful of rows.
    """
    keys = ["source_dataset", "reporter_code", "partner_code", "partner_class", "is_partner_detail"]
    labels = staged.groupBy(*keys, "partner_label").agg(F.count(F.lit(1)).alias("cells"))
    return contracts.conform(
        labels.groupBy(*keys)
        .agg(
            F.min("partner_label").alias("partner_label"),
            F.count("partner_label").alias("label_count"),
        )
        .withColumn(
            "trade_partner_key",
            F.concat(
                "source_dataset", F.lit(":"), "reporter_code", F.lit(":"), "partner_code"
            ),
        ),
        "dim_trade_partner",
    )


def trade_product(mapping: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    """dim_trade_product: the validity intervals of the mapping, one row per year."""
    group, product, year = F.col("product_group"), F.col("product_code"), F.col("classification_year")
    rule = domain.commodities
    key = F.lit(None).cast("string")
    for name, target in reversed(rule.exact):
        key = F.when(group == name, target).otherwise(key)
    for prefix, target in reversed(rule.prefixes):
        key = F.when(group.startswith(prefix), target).otherwise(key)
    years = mapping.select(
        "product_code",
        "product_group",
        F.explode(F.sequence("valid_from_year", "valid_to_year")).alias("classification_year"),
    )
    return contracts.conform(
        years.withColumns(
            {
                "classification_code": F.lit(domain.classification_code),
                "trade_product_key": F.concat(product, F.lit(":"), year.cast("string")),
                "commodity_key": key,
                "has_scope_break": has_break(product, domain),
                "comparability_segment": segment(product, year, domain),
            }
        ),
        "dim_trade_product",
    )
