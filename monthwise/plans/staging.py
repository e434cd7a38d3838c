"""Typed source rows with classes, units and comparability attached."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import TradeDomain
from monthwise.operators.scope import Scope, in_scope


def benchmark_prices(prices: DataFrame, scopes: Iterable[Scope] | None = None) -> DataFrame:
    """stg_benchmark_prices: source price rows, optionally only those a replacement covers."""
    return contracts.conform(prices.where(in_scope(scopes)), "stg_benchmark_prices")


def partner_class(partner: Column, domain: TradeDomain) -> Column:
    return (
        F.when(partner.isin(*domain.aggregate_partners), "aggregate")
        .when(partner.isin(*domain.special_partners), "special")
        .otherwise("named")
    )


def segment(product: Column, year: Column, domain: TradeDomain) -> Column:
    """Comparability label: differs before and after a scope break of the product."""
    label: Column = F.lit(domain.unbroken_segment)
    for gap in domain.scope_breaks:
        label = F.when(
            product == gap.product_code,
            F.when(year <= gap.last_year_before, gap.before).otherwise(gap.after),
        ).otherwise(label)
    return label


def has_break(product: Column, domain: TradeDomain) -> Column:
    codes = [gap.product_code for gap in domain.scope_breaks]
    return product.isin(*codes) if codes else F.lit(False)


def by_flow(flow: Column, imports: str, exports: str, domain: TradeDomain) -> Column:
    return F.when(flow == domain.import_flow, imports).when(flow == domain.export_flow, exports)


def with_product_group(cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left join on code and year inside the validity interval; unmapped cells stay."""
    spans = (
        mapping.select(
            F.col("product_code").alias("mapped_code"),
            "product_group",
            "valid_from_year",
            "valid_to_year",
        )
    )
    valid = (F.col("product_code") == F.col("mapped_code")) & F.col(
        "classification_year"
    ).between(F.col("valid_from_year"), F.col("valid_to_year"))
    return cells.join(spans, valid, "left").drop(
        "mapped_code", "valid_from_year", "valid_to_year"
    )


def trade_observations(
    cells: DataFrame,
    mapping: DataFrame,
    domain: TradeDomain = TradeDomain(),
    scopes: Iterable[Scope] | None = None,
) -> DataFrame:
    """stg_trade_observations: one row per represented source cell."""
    partner, indicator = F.col("partner_code"), F.col("indicator_code")
    is_value = indicator == domain.value_indicator
    is_mass = indicator == domain.mass_indicator
    staged = with_product_group(cells.where(in_scope(scopes)), mapping).withColumns(
        {
            "partner_class": partner_class(partner, domain),
            "is_partner_detail": ~partner.isin(*domain.aggregate_partners),
            "comparability_segment": segment(
                F.col("product_code"), F.col("classification_year"), domain
            ),
            "flow_name": by_flow(F.col("flow_code"), "imports", "exports", domain),
            "source_unit": F.when(is_value, domain.value_unit).when(
                is_mass, domain.mass_source_unit
            ),
            "normalized_unit": F.when(is_value, domain.value_unit).when(is_mass, domain.mass_unit),
            "normalized_value": F.when(
                is_value, F.col("source_value").cast("decimal(34,4)")
            ).when(is_mass, (F.col("source_value") * domain.mass_factor).cast("decimal(34,4)")),
        }
    )
    return contracts.conform(staged, "stg_trade_observations")


def combine_slices(slices: list[DataFrame]) -> DataFrame:
    """Disjoint slices as one table; check it with ``quality.key_conflicts``."""
    return reduce(lambda left, right: left.unionByName(right), slices)
