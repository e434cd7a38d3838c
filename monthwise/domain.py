"""What is specific to one reporting domain; every builder takes one of these.

The defaults describe the coffee and cocoa trade of one reporter.  Other data
(see ``sources.driver_tables``) passes its own instance.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Partner codes of the source that are totals over other partners.
AGGREGATE_PARTNERS = (
    "WORLD", "INT_EU", "EXT_EU", "INT_EU27_2020", "EXT_EU27_2020",
    "INT_EA", "EXT_EA", "INT_EA21", "EXT_EA21",
)

# Partner codes of the source that name no country.
SPECIAL_PARTNERS = ("QP", "QQ", "QR", "QS", "QU", "QV", "QW", "QX", "QY", "QZ")

# The selected product leaves by group, each valid 2017 to 2026.
PRODUCT_GROUPS = {
    "coffee_unroasted": ("09011100", "09011200"),
    "coffee_roasted": ("09012100", "09012200"),
    "cocoa_beans": ("18010000",),
    "cocoa_paste": ("18031000", "18032000"),
    "cocoa_butter": ("18040000",),
    "cocoa_powder_unsweetened": ("18050000",),
    "cocoa_powder_sweetened": ("18061015", "18061020", "18061030", "18061090"),
    "chocolate_cocoa_preparations": (
        "18062010", "18062030", "18062050", "18062070", "18062080", "18062095",
        "18063100", "18063210", "18063290", "18069011", "18069019", "18069031",
        "18069039", "18069050", "18069060", "18069070", "18069090",
    ),
    "coffee_extracts": ("21011100",),
    "coffee_preparations": ("21011292", "21011298"),
}
PRODUCT_YEARS = (2017, 2026)

# Text cells that mean "no observation".
MISSING_MARKERS = ("..", "n.a.", "N/A")


@dataclass(frozen=True)
class ScopeBreak:
    """A product code whose meaning changed: two segments that must not be compared."""

    product_code: str
    last_year_before: int
    before: str
    after: str


@dataclass(frozen=True)
class CommodityRule:
    """Product group to commodity by prefix or exact name."""

    prefixes: tuple[tuple[str, str], ...]
    exact: tuple[tuple[str, str], ...] = ()
    fact_default: str | None = None


@dataclass(frozen=True)
class TradeDomain:
    aggregate_partners: tuple[str, ...] = AGGREGATE_PARTNERS
    special_partners: tuple[str, ...] = SPECIAL_PARTNERS
    total_partner: str = "WORLD"
    import_flow: str = "1"
    export_flow: str = "2"
    value_indicator: str = "VALUE_IN_EUROS"
    mass_indicator: str = "QUANTITY_IN_100KG"
    value_unit: str = "EUR"
    mass_source_unit: str = "100kg"
    mass_unit: str = "kg"
    mass_factor: int = 100
    import_basis: str = "CIF"
    export_basis: str = "FOB"
    classification_code: str = "CN"
    unbroken_segment: str = "no identified CN8 leaf break"
    scope_breaks: tuple[ScopeBreak, ...] = (
        ScopeBreak("18069090", 2021, "2017-2021", "2022-2026"),
    )
    commodities: CommodityRule = CommodityRule(
        prefixes=(("coffee_", "coffee"), ("cocoa_", "cocoa")),
        exact=(("chocolate_cocoa_preparations", "cocoa"),),
        fact_default="cocoa",
    )


@dataclass(frozen=True)
class PriceDomain:
    """Labels of the wide price sheet and the commodity of each series."""

    dataset: str = "world_bank_pink_sheet_monthly"
    series_labels: tuple[tuple[str, str], ...] = (
        ("Cocoa", "cocoa"),
        ("Coffee, Arabica", "coffee_arabica"),
        ("Coffee, Robusta", "coffee_robusta"),
    )
    description_prefixes: tuple[tuple[str, str], ...] = (
        ("Cocoa (ICCO)", "cocoa"),
        ("Coffee, Arabica (ICO)", "coffee_arabica"),
        ("Coffee, Robusta (ICO)", "coffee_robusta"),
    )
    unit_label: str = "($/kg)"
    missing_markers: tuple[str, ...] = MISSING_MARKERS
    max_months: int = 180
    series_commodity: tuple[tuple[str, str], ...] = (("cocoa", "cocoa"),)
    default_commodity: str = "coffee"
    currency: str = "USD"
    mass_unit: str = "kg"


@dataclass(frozen=True)
class FoldPlan:
    """Rolling-origin evaluation: where each split starts and what a fit needs."""

    history_start: date = date(2015, 1, 1)
    origin_start: date = date(2016, 1, 1)
    development_start: date = date(2020, 1, 1)
    holdout_start: date = date(2024, 1, 1)
    origin_end: date = date(2025, 12, 1)
    history_months: int = 60
    labeled_origins: int = 48
    horizons: tuple[int, ...] = (1, 3)
    lags: tuple[int, ...] = (0, 1, 3, 12)
    season_months: int = 12
    calibration_minimum: int = 12
    interval_level: float = 0.9
    mode: str = "retrospective_current_vintage"
    models: tuple[str, ...] = field(default=("persistence", "seasonal_naive", "ar1"))

    def __post_init__(self) -> None:
        if self.mode != "retrospective_current_vintage":
            raise ValueError(
                "as-of evaluation needs verified release and capture evidence; "
                "only retrospective_current_vintage is supported"
            )
        ordered = (
            self.history_start <= self.origin_start < self.development_start
            < self.holdout_start <= self.origin_end
        )
        if not ordered:
            raise ValueError("fold dates must be ordered")
