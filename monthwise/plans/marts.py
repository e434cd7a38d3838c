"""Monthly marts over the facts.

Each mart is one chain of grouped passes over one scan of the facts: no mart joins
its input to itself, so the facts are read once however large they are.  Grouped
passes combine on the map side, which keeps a key that holds a third of the rows
from reaching one task as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import TradeDomain
from monthwise.functions.numbers import as_amount, ratio
from monthwise.functions.signatures import code_list
from monthwise.plans.staging import by_flow

PERIOD = ("source_dataset", "reporter_code", "month_key")
BLOCK = (*PERIOD, "classification_year", "product_group")
UNIVERSE = "observed named partners with numeric VALUE_IN_EUROS cells"
BALANCE_BASIS = "WORLD rows with identical observed value-leaf sets for both flows"
METRIC_BASIS = "WORLD rows for observed selected CN8 leaves"


def benchmark_dynamics(prices: DataFrame) -> DataFrame:
    """monthly_benchmark_dynamics: price facts with an index, first usable price = 100.

    The base is taken over the series partition; a series is as long as the calendar.
    """
    series = Window.partitionBy("source_dataset", "benchmark_series")
    usable = F.when(F.col("price_usd_per_kg").isNotNull(), F.col("month_key"))
    base = F.min_by("price_usd_per_kg", usable).over(series)
    return contracts.conform(
        prices.withColumns(
            {
                "is_trade_product_identity": F.lit(False),
                "benchmark_index": ratio(F.col("price_usd_per_kg"), base) * 100,
            }
        ),
        "monthly_benchmark_dynamics",
    )


def product_metrics(
    facts: DataFrame, products: DataFrame, domain: TradeDomain = TradeDomain()
) -> DataFrame:
    """monthly_trade_product_metrics: totals, unit value, mix share and leaf coverage.

    Leaves are reduced first; counting distinct leaves is then counting rows, without
    the row expansion of several filtered distinct counts.
    """
    has_value, has_mass = F.col("has_numeric_value"), F.col("has_numeric_mass")
    paired = has_value & has_mass & (F.col("net_mass_kg") > 0)
    value, mass = F.col("trade_value_eur"), F.col("net_mass_kg")
    flags = {
        "represented_value": F.col("value_cell_present"),
        "observed_value": has_value,
        "represented_mass": F.col("quantity_cell_present"),
        "observed_mass": has_mass,
        "paired": paired,
    }
    totals = {
        "world_value_eur": F.when(has_value, value),
        "world_net_mass_kg": F.when(has_mass, mass),
        "paired_value_eur": F.when(paired, value),
        "paired_net_mass_kg": F.when(paired, mass),
    }
    keys = [*BLOCK, "flow_code", "flow_name", "value_basis"]
    leaves = (
        facts.where(F.col("partner_code") == domain.total_partner)
        .groupBy(*keys, "product_code")
        .agg(
            *[F.bool_or(flag).alias(name) for name, flag in flags.items()],
            *[as_amount(F.sum(total)).alias(name) for name, total in totals.items()],
        )
    )
    grouped = leaves.groupBy(*keys).agg(
        *[F.count_if(F.col(name)).alias(f"{name}_product_count") for name in flags],
        *[as_amount(F.sum(name)).alias(name) for name in totals],
    )

    # One row per declared year and group, with the year's total beside it.
    per_year = Window.partitionBy("classification_year")
    expected = (
        products.groupBy("classification_year", "product_group")
        .agg(
            F.count(F.lit(1)).alias("expected_product_count"),
            F.bool_or("has_scope_break").alias("contains_scope_break"),
        )
        .withColumn(
            "universe_expected_product_count", F.sum("expected_product_count").over(per_year)
        )
        .withColumn("classification_year", F.col("classification_year").cast("smallint"))
    )
    covered = grouped.join(
        (expected), ["classification_year", "product_group"]
    )

    # After the join a partition holds at most one row per declared year and group.
    period = Window.partitionBy(*PERIOD, "flow_code")
    mix_total = as_amount(F.sum("world_value_eur").over(period))
    return contracts.conform(
        covered.withColumns(
            {
                **{
                    f"has_complete_{kind}_coverage": F.col(f"{name}_product_count")
                    == F.col("expected_product_count")
                    for kind, name in (
                        ("value", "observed_value"), ("mass", "observed_mass"), ("paired", "paired")
                    )
                },
                "observed_product_mix_denominator_eur": mix_total,
                "universe_observed_value_product_count": F.sum(
                    "observed_value_product_count"
                ).over(period),
                "declared_universe_expected_product_count": F.max(
                    "universe_expected_product_count"
                ).over(period),
                "coverage_basis": F.lit(METRIC_BASIS),
                "observed_unit_value_eur_per_kg": F.when(
                    F.col("paired_net_mass_kg") > 0,
                    ratio(F.col("paired_value_eur"), F.col("paired_net_mass_kg")),
                ),
            }
        ).withColumns(
            {
                "observed_product_value_share": F.when(
                    F.col("observed_product_mix_denominator_eur") > 0,
                    ratio(
                        F.col("world_value_eur"), F.col("observed_product_mix_denominator_eur")
                    ),
                ),
                "has_complete_product_mix_universe": F.col("universe_observed_value_product_count")
                == F.col("declared_universe_expected_product_count"),
            }
        ),
        "monthly_trade_product_metrics",
    )


def trade_balances(facts: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    """monthly_trade_balances: export minus import where both flows cover the same leaves."""
    flow = F.col("flow_code")
    leaves = (
        facts.where(
            (F.col("partner_code") == domain.total_partner) & F.col("has_numeric_value")
        )
        .groupBy(*BLOCK, "flow_code", "product_code")
        .agg(F.sum("trade_value_eur").alias("leaf_value"))
    )
    sides = []
    for side, code, basis in (
        ("import", domain.import_flow, "cif"), ("export", domain.export_flow, "fob")
    ):
        hit = flow == code
        sides += [
            as_amount(F.sum(F.when(hit, F.col("leaf_value")))).alias(f"{side}_value_{basis}_eur"),
            F.nullif(F.count_if(hit), F.lit(0)).alias(f"{side}_product_count"),
            code_list(hit, F.col("product_code")).alias(f"{side}_product_coverage"),
        ]
    same = F.coalesce(
        F.col("import_product_coverage") == F.col("export_product_coverage"), F.lit(False)
    )
    return contracts.conform(
        leaves.groupBy(*BLOCK)
        .agg(*sides)
        .withColumns(
            {
                "coverage_basis": F.lit(BALANCE_BASIS),
                "has_compatible_flow_coverage": same,
                "trade_balance_eur": as_amount(
                    F.when(
                        same, F.col("export_value_fob_eur") - F.col("import_value_cif_eur")
                    )
                ),
            }
        ),
        "monthly_trade_balances",
    )


def partner_values(facts: DataFrame) -> DataFrame:
    """Named partners' value per block and flow, reduced before anything is ranked."""
    keys = [
        *BLOCK, "flow_code", "flow_name", "value_basis",
        "trade_partner_key", "partner_code", "partner_label",
    ]
    named = (F.col("partner_class") == "named") & F.col("has_numeric_value")
    leaves = (
        facts.where(named)
        .groupBy(*keys, "product_code")
        .agg(F.sum("trade_value_eur").alias("leaf_value"))
    )
    return leaves.groupBy(*keys).agg(
        as_amount(F.sum("leaf_value")).alias("partner_value_eur"),
        F.count("product_code").alias("observed_product_count"),
    )


def partner_shares(facts: DataFrame) -> DataFrame:
    """monthly_partner_shares: share and rank inside the observed named partners.

    Denominator and rank use one exchange.  A window partition holds one row per
    partner label of a block, and the partner codes of a source are a declared list
    that ingest verifies, so no partition grows with the observations.
    """
    block = Window.partitionBy(*PERIOD, "product_group", "flow_code")
    rank = block.orderBy(F.col("partner_value_eur").desc(), F.col("partner_code").asc())
    total = F.col("named_partner_denominator_eur")
    return contracts.conform(
        partner_values(facts)
        .withColumn(
            "named_partner_denominator_eur", as_amount(F.sum("partner_value_eur").over(block))
        )
        .withColumns(
            {
                "concentration_universe": F.lit(UNIVERSE),
                "named_partner_value_share": F.when(
                    total > 0, ratio(F.col("partner_value_eur"), total)
                ),
                "has_positive_named_denominator": total > 0,
                "named_partner_rank": F.row_number().over(rank).cast("long"),
            }
        ),
        "monthly_partner_shares",
    )


def top_partners(facts: DataFrame) -> DataFrame:
    """First-ranked named partner of every block and flow.

    A grouped minimum keeps one candidate per task and block; nothing is sorted.
    """
    first = F.min_by(
        F.struct("partner_code", "partner_label", "partner_value_eur"),
        F.struct((-F.col("partner_value_eur")).alias("v"), "partner_code"),
    )
    return (
        partner_values(facts)
        .groupBy(*PERIOD, "product_group", "flow_code")
        .agg(
            first.alias("top"),
            as_amount(F.sum("partner_value_eur")).alias("named_partner_denominator_eur"),
            F.count(F.lit(1)).alias("named_partner_count"),
        )
        .select(
            *PERIOD, "product_group", "flow_code", "named_partner_count",
            "named_partner_denominator_eur", "top.*",
        )
        .withColumn(
            "named_partner_value_share",
            F.when(
                F.col("named_partner_denominator_eur") > 0,
                ratio(F.col("partner_value_eur"), F.col("named_partner_denominator_eur")),
            ),
        )
    )


def partner_concentration(facts: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    """monthly_partner_concentration: Herfindahl index beside special and WORLD amounts.

    One grouping-set pass gives partner sums and leaf sums together, so the facts are
    scanned and shuffled once.  With partner sums v and total D the index is
    sum(v*v) / (D*D).
    """
    block = [*BLOCK, "flow_code"]
    value = F.col("trade_value_eur")
    numeric = F.col("has_numeric_value")
    named = numeric & (F.col("partner_class") == "named")
    special = numeric & (F.col("partner_class") == "special")
    world = numeric & (F.col("partner_code") == domain.total_partner)
    relevant = facts.where(
        (F.col("partner_class") != "aggregate") | (F.col("partner_code") == domain.total_partner)
    ).select(
        *block, "product_code",
        F.when(named, F.struct("partner_code", "partner_label")).alias("named_partner"),
        F.when(named, value).alias("named_value"),
        F.when(special, value).alias("special_value"),
        F.when(world, value).alias("world_value"),
    )
    sums = (
        relevant.groupingSets(
            [[*block, "product_code"], [*block, "named_partner"]],
            *block, "product_code", "named_partner",
        )
        .agg(
            F.grouping("product_code").alias("is_partner_row"),
            as_amount(F.sum("named_value")).alias("named_value"),
            as_amount(F.sum("special_value")).alias("special_value"),
            as_amount(F.sum("world_value")).alias("world_value"),
        )
    )
    leaf = F.col("is_partner_row") == 0
    partner = (F.col("is_partner_row") == 1) & F.col("named_partner").isNotNull()
    partner_value = F.when(partner, F.col("named_value"))
    zero = F.lit(0).cast("decimal(38,4)")
    residual = (
        F.col("world_value")
        - F.coalesce("named_value", zero)
        - F.coalesce("special_value", zero)
    )
    columns = {"named": "named_value", "special": "special_value", "world": "world_value"}
    seen = {name: leaf & F.col(column).isNotNull() for name, column in columns.items()}
    blocks = sums.groupBy(*block).agg(
        as_amount(F.sum(partner_value)).alias("block_named_value"),
        F.count(partner_value).alias("block_partner_count"),
        F.max(partner_value).alias("largest_value"),
        F.sum(partner_value.cast("double") * partner_value.cast("double")).alias("squares"),
        as_amount(F.sum(F.when(leaf, F.col("special_value")))).alias("observed_special_value_eur"),
        as_amount(F.sum(F.when(leaf, F.col("world_value")))).alias("world_value_eur"),
        as_amount(F.sum(F.when(leaf, residual))).alias("reconciliation_residual_eur"),
        *[F.count_if(flag).alias(f"{name}_observed_product_count") for name, flag in seen.items()],
        *[
            code_list(flag, F.col("product_code")).alias(f"{name}_product_coverage")
            for name, flag in seen.items()
        ],
    )
    # The denominator ignores the classification year: few rows per partition by now.
    across_years = Window.partitionBy(*PERIOD, "product_group", "flow_code")
    # A block without a product group has no named figures: null never equals null.
    grouped = F.col("product_group").isNotNull()
    total = F.when(
        grouped & (F.col("block_partner_count") > 0),
        F.sum("block_named_value").over(across_years),
    )
    named_total, world_total = F.col("named_partner_value_eur"), F.col("world_value_eur")
    positive = named_total > 0
    unknown = F.lit("__NULL__")
    status = (
        F.when(world_total.isNull(), "WORLD unavailable")
        .when(
            F.coalesce("named_product_coverage", unknown)
            != F.coalesce("world_product_coverage", unknown),
            "partial WORLD coverage",
        )
        .when(F.col("reconciliation_residual_eur") == 0, "exact")
        .when(F.col("reconciliation_residual_eur") > 0, "positive residual")
        .otherwise("named plus special exceeds WORLD")
    )
    return contracts.conform(
        blocks.withColumn("named_partner_value_eur", as_amount(total)).withColumns(
            {
                "largest_named_partner_share": F.when(
                    positive, ratio(F.col("largest_value"), named_total)
                ),
                "named_partner_hhi": F.when(
                    positive,
                    F.col("squares") / (named_total.cast("double") * named_total.cast("double")),
                ),
                "concentration_universe": F.lit(UNIVERSE),
                "flow_name": by_flow(F.col("flow_code"), "imports", "exports", domain),
                "value_basis": by_flow(
                    F.col("flow_code"), domain.import_basis, domain.export_basis, domain
                ),
                "named_partner_count": F.when(grouped, F.col("block_partner_count")).otherwise(
                    F.lit(0).cast("long")
                ),
                "has_positive_named_denominator": F.coalesce(positive, F.lit(False)),
                "observed_special_share_of_world": ratio(
                    F.col("observed_special_value_eur"), world_total
                ),
                "residual_share_of_world": ratio(
                    F.col("reconciliation_residual_eur"), world_total
                ),
                "reconciliation_status": status,
            }
        ).drop("block_named_value", "block_partner_count", "largest_value", "squares"),
        "monthly_partner_concentration",
    )
