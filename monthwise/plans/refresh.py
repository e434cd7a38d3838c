"""Marts after a replacement: only the groups that touched cells belong to are built again.

Every trade mart is grouped inside one reporter's month, so the touched keys that pass from the cells to the marts
are (source_dataset, reporter_code, month); everything else is taken over from the earlier mart.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from monthwise.domain import TradeDomain
from monthwise.operators.scope_tables import inside_scopes
from monthwise.plans import facts, marts, staging

BLOCK = ("source_dataset", "reporter_code")


def trade_marts(products: DataFrame, domain: TradeDomain = TradeDomain()) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Builders of the marts over the trade fact, by table."""
    return {
        "monthly_product_metrics": lambda fact: marts.product_metrics(fact, products, domain),
        "monthly_trade_balances": lambda fact: marts.trade_balances(fact, domain),
        "monthly_partner_shares": marts.partner_shares,
        "monthly_partner_concentration": lambda fact: marts.partner_concentration(fact, domain),
    }


def trade_fact(cells: DataFrame, mapping: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    return facts.trade_observations(
        facts.paired_measures(staging.trade_observations(cells, mapping, domain), domain), domain
    )


def touched_blocks(
    previous: DataFrame, incoming: DataFrame, scopes: DataFrame, keys: Sequence[str], month: str = "period_month"
) -> DataFrame:
    """Distinct blocks in which a replacement removes or adds a row."""
    both = previous.select(*BLOCK, month, *[k for k in keys if k not in BLOCK]).unionByName(
        incoming.select(*BLOCK, month, *[k for k in keys if k not in BLOCK])
    )
    return inside_scopes(both, scopes, keys, month).select(*BLOCK, month).distinct()


def cells_of(cells: DataFrame, blocks: DataFrame, month: str = "period_month") -> DataFrame:
    """Cells of the blocks; on a table partitioned by month the blocks prune its partitions."""
    return cells.join(blocks, [*BLOCK, month], "left_semi")


def refreshed(earlier: DataFrame, part: DataFrame, blocks: DataFrame, month: str = "period_month") -> DataFrame:
    """An earlier mart with the touched blocks exchanged for newly built rows; emptied blocks vanish."""
    gone = blocks.withColumnRenamed(month, "month_key")
    return earlier.join(gone, [*BLOCK, "month_key"], "left_anti").unionByName(part)


def refreshed_marts(
    earlier: Mapping[str, DataFrame],
    cells: DataFrame,
    blocks: DataFrame,
    mapping: DataFrame,
    products: DataFrame,
    domain: TradeDomain = TradeDomain(),
) -> dict[str, DataFrame]:
    """The marts after a replacement; ``cells`` is the table after it, of which only touched blocks are read."""
    fact = trade_fact(cells_of(cells, blocks), mapping, domain)
    return {
        name: refreshed(earlier[name], build(fact), blocks)
        for name, build in trade_marts(products, domain).items()
        if name in earlier
    }
