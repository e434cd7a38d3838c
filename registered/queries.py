"""Every registered query: (spark, folder) -> DataFrame over the whole tables.

Doubles that are sums are rounded on both sides of the comparison, because a sum of
doubles depends on the order of addition.  Quotients are compared as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from monthwise import contracts
from monthwise.operators import quality, selection
from monthwise.operators.materialize import stored
from monthwise.operators.registry import append_history, first_selected, latest_run, merge_captures
from monthwise.operators.scope import (
    Scope,
    clip_ranges,
    in_scope,
    replace_rows,
    requested_pairs,
    row_differences,
    selection_gaps,
    slice_scopes,
    uncovered_months,
)
from monthwise.operators.scope_tables import replace_rows_by_table, scope_table
from monthwise.operators.vintages import new_captures, version
from monthwise.plans import (
    checks,
    coverage,
    dims,
    facts,
    folds,
    forecast,
    marts,
    presentation,
    publish,
    refresh,
    staging,
)
from monthwise.session import checkpoint_folder
from monthwise.sources import cubes, footers, wide_prices
from monthwise.sources import driver_tables as source
from monthwise.sources.driver_tables import FOLDS, PRICES, TRADE

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(*summed: str) -> Callable[[Query], Query]:
    """Registers a function under its own name; ``summed`` names doubles to round."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(function(spark, folder), summed)

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        REGISTRY[function.__name__] = run
        return run

    return register


def comparable(frame: DataFrame, summed: tuple[str, ...]) -> DataFrame:
    """Nine digits for sums of doubles, and timestamps as text."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in summed:
            column = F.round(column, 9)
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


# --- shared inputs ---------------------------------------------------------------------


def staged_trade(spark: SparkSession, folder: str) -> DataFrame:
    return staging.trade_observations(
        source.trade_cells(spark, folder), source.product_mapping(spark, folder), TRADE
    )


def trade_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts.trade_observations(
        facts.paired_measures(staged_trade(spark, folder), TRADE), TRADE
    )


def price_facts(spark: SparkSession, folder: str) -> DataFrame:
    staged = staging.benchmark_prices(source.monthly_prices(spark, folder))
    return facts.benchmark_prices(facts.price_changes(staged), PRICES)


def products(spark: SparkSession, folder: str) -> DataFrame:
    return dims.trade_product(source.product_mapping(spark, folder), TRADE)


def evaluated(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.evaluated_rows(price_facts(spark, folder), FOLDS)


# --- staging, dimensions, facts --------------------------------------------------------


@query()
def stg_trade(spark, folder):
    return staged_trade(spark, folder)


@query()
def stg_prices(spark, folder):
    return staging.benchmark_prices(source.monthly_prices(spark, folder))


@query()
def trade_pivot(spark, folder):
    return facts.paired_measures(staged_trade(spark, folder), TRADE)


@query()
def dim_calendar(spark, folder):
    lines = source.table(spark, folder, "lineitem").select(
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("period_month")
    )
    return dims.calendar_of(lines)


@query()
def dim_product_years(spark, folder):
    return products(spark, folder)


@query()
def dim_partner(spark, folder):
    return dims.trade_partner(staged_trade(spark, folder))


@query()
def dim_commodity(spark, folder):
    """Commodities that the mapped products use."""
    known = dims.commodity(spark, (("grain", "Grain"), ("metal", "Metal"), ("wood", "Wood")))
    return known.join(products(spark, folder), "commodity_key", "left_semi")


@query()
def fct_trade(spark, folder):
    return trade_facts(spark, folder)


@query()
def fct_prices(spark, folder):
    return price_facts(spark, folder)


# --- marts -----------------------------------------------------------------------------


@query()
def price_changes(spark, folder):
    return facts.price_changes(staging.benchmark_prices(source.monthly_prices(spark, folder)))


@query()
def price_index(spark, folder):
    return marts.benchmark_dynamics(price_facts(spark, folder))


@query()
def product_metrics(spark, folder):
    return marts.product_metrics(trade_facts(spark, folder), products(spark, folder), TRADE)


@query()
def flow_balance(spark, folder):
    return marts.trade_balances(trade_facts(spark, folder), TRADE)


@query()
def partner_shares(spark, folder):
    return marts.partner_shares(trade_facts(spark, folder))


@query()
def top_partner(spark, folder):
    return marts.top_partners(trade_facts(spark, folder))


@query("named_partner_hhi")
def partner_concentration(spark, folder):
    return marts.partner_concentration(trade_facts(spark, folder), TRADE)


# --- forecast --------------------------------------------------------------------------

FITTED_COLUMNS = (
    "prediction_usd_per_kg", "absolute_error", "squared_error", "smape_percent",
    "interval_lower", "interval_upper",
)


@query()
def split_manifest(spark, folder):
    """The manifest of every series that has prices inside the folds' reach."""
    prices = price_facts(spark, folder)
    return folds.series_manifest(prices, FOLDS)


@query()
def origin_features(spark, folder):
    return folds.origin_features(price_facts(spark, folder), FOLDS)


@query()
def forecast_targets(spark, folder):
    return folds.targets(price_facts(spark, folder), FOLDS)


@query()
def history_runs(spark, folder):
    return forecast.autoregression_fits(price_facts(spark, folder), FOLDS).select(
        "source_dataset", "series_id", "month_key", "run_length"
    )


@query("slope", "intercept")
def ar1_fits(spark, folder):
    return forecast.autoregression_fits(price_facts(spark, folder), FOLDS)


@query()
def forecast_predictions(spark, folder):
    """Fitted rows are rounded; the baselines are exact and stay as they are."""
    rows = forecast.predictions_of(evaluated(spark, folder), "check", FOLDS)
    fitted = F.col("model_name") == "ar1"
    return rows.withColumns(
        {c: F.when(fitted, F.round(c, 6)).otherwise(F.col(c)) for c in FITTED_COLUMNS}
    )


@query("development_mae")
def forecast_selection(spark, folder):
    return forecast.selections_of(evaluated(spark, folder))


@query()
def forecast_selection_gaps(spark, folder):
    return forecast.selection_gaps(evaluated(spark, folder))


@query("mae", "rmse", "smape_percent", "interval_coverage", "mean_interval_width")
def forecast_metrics(spark, folder):
    return forecast.metrics_of(evaluated(spark, folder), "check")


# --- ingest ----------------------------------------------------------------------------

PRICE_MONTHS = (date(1995, 1, 1), date(2001, 8, 1))
SHEET_MONTHS = (date(1995, 3, 1), date(2001, 6, 1))
NOW = date(2002, 1, 15)


@query()
def wide_ingest(spark, folder):
    """Long price rows parsed from wide text sheets."""
    return wide_prices.parse_sheets(
        source.wide_sheets(spark, folder), source.SHEET_CELLS, *SHEET_MONTHS, PRICES
    )


@query()
def ingest_violations(spark, folder):
    return wide_prices.sheet_violations(
        source.broken_sheets(spark, folder), source.SHEET_CELLS, *SHEET_MONTHS, PRICES
    )


@query()
def price_coverage(spark, folder):
    return wide_prices.price_coverage(
        source.monthly_prices(spark, folder), *PRICE_MONTHS, PRICES
    )


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """Stored documents, in partitions of even size."""
    documents = source.cube_documents(spark, folder)
    return stored(documents.hint("rebalance"))


@query()
def cube_decode(spark, folder):
    """Cells decoded from JSON cube documents that were built from the cells."""
    documents = _documents(spark, folder)
    parsed = cubes.parse_documents(documents)
    return cubes.decode_cells(parsed, "driver_trade", TRADE).drop("source_capture_id")


@query()
def cube_scope_violations(spark, folder):
    """Documents against a request that lacks one month in nine and one flow in ten."""
    documents = _documents(spark, folder)
    month = F.substring_index("document_id", "-", -1).cast("int")
    year = F.regexp_extract("document_id", r"-(\d{4})-", 1).cast("int")
    step = year * 12 + month - 1
    requests = (
        source.cube_requests(documents.select("document_id"))
        .where(F.pmod(step, F.lit(9)) != 0)
        .withColumn(
            "flows",
            F.when(F.pmod(step, F.lit(10)) == 1, F.array(F.lit("1"))).otherwise(F.col("flows")),
        )
    )
    return cubes.document_violations(cubes.parse_documents(documents, requests))


@query()
def cell_stats(spark, folder):
    return coverage.slice_statistics(source.trade_cells(spark, folder))


@query()
def series_coverage(spark, folder):
    return coverage.series_coverage(source.trade_cells(spark, folder), TRADE)


@query()
def key_conflicts(spark, folder):
    return quality.key_conflicts(source.repeated_cells(spark, folder), contracts.TRADE_KEY)


@query()
def mixed_updates(spark, folder):
    """One dataset holds two source update times after a partial replacement."""
    cells = source.trade_cells(spark, folder)
    revised = F.when(
        F.col("period_month") >= F.lit(date(2000, 1, 1)), F.lit("2002-02-15T11:00:00+0000")
    ).otherwise(F.col("source_update_time"))
    return coverage.mixed_updates(cells.withColumn("source_update_time", revised))


# --- revision --------------------------------------------------------------------------

SCOPES = (
    Scope(
        date(1997, 1, 1), date(1997, 6, 1),
        {"flow_code": ("1",), "reporter_code": ("RA", "RN")},
    ),
    Scope(
        date(1999, 3, 1), date(1999, 4, 1),
        {"product_code": ("Brand#3", "Brand#4", "Brand#12"), "reporter_code": ("RR",)},
    ),
)


SCOPE_KEYS = ("reporter_code", "product_code", "flow_code", "partner_code")


@query()
def scope_replace(spark, folder):
    """Cells after a later version replaced two scopes, withdrawals included."""
    cells = stored(source.trade_cells(spark, folder))
    return replace_rows(cells, source.revised_cells(cells), SCOPES)


@query()
def scope_untouched(spark, folder):
    """Row counts and value sums outside the scopes, before and after a replacement."""
    cells = stored(source.trade_cells(spark, folder))
    after = replace_rows(cells, source.revised_cells(cells), SCOPES)

    def outside(frame: DataFrame, label: str) -> DataFrame:
        return frame.where(~in_scope(SCOPES)).agg(
            F.lit(label).alias("version"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum("source_value").cast("decimal(38,4)").alias("value_sum"),
        )

    return outside(cells, "before").unionByName(outside(after, "after"))


@query()
def refresh_equal(spark, folder):
    """Two steps of replacement against one rebuild: rows that differ, by side."""
    cells = stored(source.trade_cells(spark, folder))
    revised = source.revised_cells(cells)
    stepwise = cells
    for scope in SCOPES:
        stepwise = replace_rows(stepwise, revised, [scope])
    rebuilt = replace_rows(cells, revised, SCOPES)
    different = row_differences(stepwise, rebuilt)
    return quality.one_row(
        different.agg(
            F.count_if(F.col("surplus") > 0).alias("only_stepwise"),
            F.count_if(F.col("surplus") < 0).alias("only_rebuilt"),
        ),
        rebuilt.agg(F.count(F.lit(1)).alias("rebuilt_rows")),
    )


@query()
def restored_vintage(spark, folder):
    """Three selections over one store of captures, the last pins the first captures again: rows that still differ."""
    cells = stored(source.trade_cells(spark, folder))
    revised = source.revised_cells(cells)
    store = stored(cells.unionByName(new_captures(cells, revised)))
    captures = lambda frame: frame.agg(F.array_sort(F.collect_set("source_capture_id")).alias("capture_ids"))
    everything = [Scope(date(1990, 1, 1), date(2005, 12, 1), {})]
    steps = ((1, everything, cells), (2, SCOPES, revised), (3, SCOPES, cells))
    selections = reduce(
        DataFrame.unionByName,
        [
            scope_table(spark, scopes, SCOPE_KEYS).join(captures(pinned)).withColumn("selection_no", F.lit(number).cast("long"))
            for number, scopes, pinned in steps
        ],
    )
    selections = stored(selections)
    after, back = version(store, selections, SCOPE_KEYS, 2), version(store, selections, SCOPE_KEYS)
    return quality.one_row(
        row_differences(back, cells).agg(F.count(F.lit(1)).alias("rows_still_different")),
        row_differences(after, cells).agg(F.count(F.lit(1)).alias("rows_replaced")),
    )


def _slices(spark: SparkSession, folder: str) -> DataFrame:
    """Captured slices: per reporter and year, the products and partners that occur."""
    cells = source.shipped_amounts(spark, folder)
    year = F.year("period_month")
    return cells.groupBy("reporter_code", year.alias("y")).agg(
        F.collect_set("product_code").alias("products"),
        F.collect_set("partner_code").alias("partners"),
    ).select(
        F.concat_ws("-", "reporter_code", "y").alias("slice_id"),
        "reporter_code",
        F.make_date("y", F.lit(1), F.lit(1)).alias("start_month"),
        F.make_date("y", F.lit(12), F.lit(1)).alias("end_month"),
        "products",
        "partners",
    )


@query()
def selection_complete(spark, folder):
    """What a request of all reporters asks for that its slices miss or cover twice; RN holds its 1998 slice twice."""
    wanted = ("Brand#3", "Brand#4", "Brand#99")
    bounds = (date(1997, 5, 1), date(1998, 2, 1))
    slices = _slices(spark, folder)
    again = slices.where("slice_id = 'RN-1998'").withColumn("slice_id", F.lit("RN-1998-again"))
    scoped = slice_scopes(slices.unionByName(again), *bounds, wanted, ("1",))
    return selection_gaps(scoped, requested_pairs(spark, *bounds, wanted, ("RA", "RN", "RR"), ("1",)))


def _price_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """First and last month of each price series in each year."""
    return (
        source.monthly_prices(spark, folder)
        .groupBy("source_dataset", "series_id", F.year("period_month").alias("y"))
        .agg(F.min("period_month").alias("start_month"), F.max("period_month").alias("end_month"))
        .drop("y")
    )


@query()
def backfill_gaps(spark, folder):
    """Months of a backfill run that no range of a price series covers, for every series."""
    return uncovered_months(
        date(1995, 1, 1), date(2001, 12, 1), _price_ranges(spark, folder), ("source_dataset", "series_id")
    )


@query()
def backfill_ranges(spark, folder):
    """Ranges of all price series, cut to a backfill run."""
    return clip_ranges(_price_ranges(spark, folder), date(1996, 3, 1), date(2000, 10, 1))


@query()
def table_replace(spark, folder):
    """A month table written, two scopes replaced in place, and read back; keys must stay unique."""
    path = f"{checkpoint_folder(spark)}/cells-{uuid4().hex}"
    cells = stored(source.trade_cells(spark, folder))
    publish.write_month_table(cells, path)
    publish.replace_in_table(
        spark, path, source.revised_cells(cells), SCOPES, "monthly_trade", key=contracts.TRADE_KEY
    )
    schema = contracts.schema("monthly_trade")
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())


def _many_scopes(cells: DataFrame) -> DataFrame:
    """Some thousand scopes out of the cells: spring months of single products and partners, and one whole month."""
    year = F.year("period_month").alias("y")
    brand = F.substring_index("product_code", "#", -1).cast("int")
    parts = cells.select("reporter_code", "product_code", "partner_code", year).distinct()
    single = parts.where((brand + F.col("y") + F.char_length("partner_code")) % 5 == 0).select(
        F.make_date("y", F.lit(2), F.lit(1)).alias("start_month"), F.make_date("y", F.lit(5), F.lit(1)).alias("end_month"),
        F.array("reporter_code").alias("reporter_code"), F.array("product_code").alias("product_code"),
        F.lit(None).cast("array<string>").alias("flow_code"), F.array("partner_code").alias("partner_code"),
    )
    whole = scope_table(cells.sparkSession, [Scope(date(1998, 7, 1), date(1998, 7, 1), {})], SCOPE_KEYS)
    return stored(single.unionByName(whole))


@query()
def scope_table_replace(spark, folder):
    """Cells after a later version replaced some thousand scopes that are held as a table; keys must stay unique."""
    cells = stored(source.trade_cells(spark, folder))
    return replace_rows_by_table(
        cells, source.revised_cells(cells), _many_scopes(cells), SCOPE_KEYS, unique=contracts.TRADE_KEY
    )


def _selected(spark: SparkSession, folder: str, products: list[str], slices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests by group and by product, resolved to leaves, and the scopes of the slices that hold them."""
    requests = spark.createDataFrame(
        [
            ("grain", "RA", date(1997, 5, 1), date(1999, 2, 1), [], ["grain_3", "grain_4"], ["1"]),
            ("metal", "RN", date(1996, 11, 1), date(1997, 1, 1), products, ["metal_7"], ["1", "2"]),
        ],
        "request_id string, reporter_code string, start_month date, end_month date, products array<string>, "
        "product_groups array<string>, flows array<string>",
    )
    leaves = stored(selection.requested_leaves(requests, source.product_mapping(spark, folder)))
    return leaves, stored(selection.selected_scopes(leaves, slices))


@query()
def selection_replace(spark, folder):
    """A month table in which the scopes of a selection are replaced in place, read back."""
    path = f"{checkpoint_folder(spark)}/cells-{uuid4().hex}"
    cells = stored(source.trade_cells(spark, folder))
    publish.write_month_table(cells, path)
    _, scopes = _selected(spark, folder, ["Brand#16"], stored(_slices(spark, folder)))
    publish.replace_in_table_by(
        spark, path, source.revised_cells(cells), scopes, SCOPE_KEYS, "monthly_trade", key=contracts.TRADE_KEY
    )
    schema = contracts.schema("monthly_trade")
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())


@query()
def selection_gaps_by_group(spark, folder):
    """What a selection by group asks for that no slice holds or several do; no slice has Brand#99, RN-1996 is held twice."""
    slices = stored(_slices(spark, folder))
    again = slices.where("slice_id = 'RN-1996'").withColumn("slice_id", F.lit("RN-1996-again"))
    leaves, scopes = _selected(spark, folder, ["Brand#16", "Brand#99"], slices.unionByName(again))
    return selection.selection_problems(scopes, leaves)


@query()
def price_selection_replace(spark, folder):
    """Prices after the series of every second priority was replaced by a version with doubled prices and no winter."""
    prices = stored(source.monthly_prices(spark, folder))
    wanted = prices.where(F.substring("series_id", 1, 1).cast("int") % 2 == 0).groupBy("source_dataset").agg(F.collect_set("series_id").alias("series"))
    requests = wanted.select(
        F.col("source_dataset").alias("request_id"), "source_dataset", F.lit(date(1996, 3, 1)).alias("start_month"),
        F.lit(date(1997, 4, 1)).alias("end_month"), "series",
    )
    later = prices.where(F.month("period_month").isin(3, 4, 5, 6, 7, 8, 9, 10)).withColumn(
        "price_usd_per_kg", F.col("price_usd_per_kg") * 2
    ).select(*[F.col(f.name).cast(f.dataType) for f in prices.schema.fields])
    return replace_rows_by_table(prices, later, stored(selection.price_scopes(requests)), selection.PRICE_KEYS)


@query()
def marts_after_replacement(spark, folder):
    """Marts of which only the touched blocks were built again, against a full build: rows that differ, cells read."""
    cells = stored(source.trade_cells(spark, folder))
    revised = source.revised_cells(cells)
    scopes = stored(scope_table(spark, SCOPES, SCOPE_KEYS))
    after = stored(replace_rows_by_table(cells, revised, scopes, SCOPE_KEYS))
    mapping, dimension = source.product_mapping(spark, folder), products(spark, folder)
    blocks = stored(refresh.touched_blocks(cells, revised, scopes, SCOPE_KEYS))
    builders = refresh.trade_marts(dimension, TRADE)
    before, full = (stored(refresh.trade_fact(c, mapping, TRADE)) for c in (cells, after))
    earlier = {name: stored(build(before)) for name, build in builders.items()}
    now = refresh.refreshed_marts(earlier, after, blocks, mapping, dimension, TRADE)
    sizes = refresh.cells_of(after, blocks).agg(F.count(F.lit(1)).alias("cells_read")).join(
        after.agg(F.count(F.lit(1)).alias("cells_of_full_build"))
    )
    rows = [
        row_differences(*(comparable(mart, ("named_partner_hhi",)) for mart in (now[name], build(full)))).agg(F.count(F.lit(1)).alias("differing_rows")).select(
            F.lit(name).alias("table_name"), "differing_rows"
        )
        for name, build in builders.items()
    ]
    return reduce(DataFrame.unionByName, rows).join(sizes)


@query()
def file_drift(spark, folder):
    """Cells written in slices of which three differ from the contract: what their footers show."""
    root = f"{checkpoint_folder(spark)}/slices-{uuid4().hex}"
    cells = stored(source.trade_cells(spark, folder))
    year = F.year("period_month")
    slices = {
        "declared": cells.where(year <= 1996),
        "absent": cells.where(year == 1997).drop("source_status"),
        "additional": cells.where(year == 1998).withColumn("note", F.lit("x")),
        "retyped": cells.where(year >= 1999).withColumn("source_value", F.col("source_value").cast("double")),
    }
    for name, frame in slices.items():
        frame.write.parquet(f"{root}/{name}")
    return footers.file_drift(spark, root, "monthly_trade").drop("files", "example_path")


@query()
def pinned_generations(spark, folder):
    """Two generations of the cells, the second after a replacement, both read back by number."""
    root = f"{checkpoint_folder(spark)}/generations-{uuid4().hex}"
    cells = stored(source.trade_cells(spark, folder))
    first = publish.publish_generation(root, {"monthly_trade": cells}, "full", "run-1")
    pinned = publish.read_generation(spark, root, first)["monthly_trade"]
    after = replace_rows(pinned, source.revised_cells(pinned), SCOPES)
    second = publish.publish_generation(root, {"monthly_trade": after}, "replacement", "run-2")
    read = [
        publish.read_generation(spark, root, number)["monthly_trade"].withColumn("generation", F.lit(number).cast("long"))
        for number in (first, second)
    ]
    return reduce(DataFrame.unionByName, read).groupBy("generation", "reporter_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("source_value").cast("decimal(38,4)").alias("value_sum")
    )


# --- captures, lineage, freshness ------------------------------------------------------


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    return merge_captures(None, source.capture_events(spark, folder))


@query()
def capture_registry(spark, folder):
    return _registry(spark, folder)


@query()
def selection_history(spark, folder):
    """Two selection runs over the capture events, the second with later years only."""
    events = source.capture_events(spark, folder).select(
        F.lit("prices").alias("dataset"),
        "source_capture_id",
        "retrieved_at_utc",
        F.date_add(F.col("retrieved_at_utc").cast("date"), 3).cast("timestamp").alias(
            "selected_at_utc"
        ),
    )
    history = append_history(None, events, "run-1")
    later = events.where(F.year("retrieved_at_utc") >= 1999)
    return first_selected(append_history(history, later, "run-2"))


@query()
def latest_selection(spark, folder):
    """Newest of two selection runs, which split the captures by the year of their retrieval."""
    events = source.capture_events(spark, folder).select(
        F.lit("prices").alias("dataset"),
        "source_capture_id",
        "retrieved_at_utc",
        F.col("retrieved_at_utc").alias("selected_at_utc"),
    )
    year = F.year("retrieved_at_utc")
    first = append_history(None, events.where(year <= 1998), "until-1998")
    return latest_run(append_history(first, events.where(year > 1998), "after-1998"))


@query()
def capture_lineage(spark, folder):
    """Captures of forecast inputs that the registry lacks (one year was never registered)."""
    prices = price_facts(spark, folder)
    registry = _registry(spark, folder).where(~F.col("source_capture_id").endswith("-1997"))
    lags = [f"lag_{k}_capture_id" for k in FOLDS.lags]
    return checks.capture_lineage(
        [
            (folds.origin_features(prices, FOLDS), lags),
            (folds.targets(prices, FOLDS), ["target_capture_id"]),
        ],
        registry,
    )


@query()
def provenance(spark, folder):
    registry = _registry(spark, folder).where(~F.col("source_capture_id").endswith("-1997"))
    return coverage.provenance({"prices": price_facts(spark, folder)}, registry)


@query()
def source_versions(spark, folder):
    rows = coverage.provenance(
        {"prices": price_facts(spark, folder)}, _registry(spark, folder)
    )
    return coverage.source_versions(rows)


@query()
def freshness_prices(spark, folder):
    return coverage.price_freshness(source.monthly_prices(spark, folder), NOW)


@query()
def freshness_trade(spark, folder):
    observed = coverage.series_coverage(source.trade_cells(spark, folder), TRADE)
    return coverage.trade_freshness(
        source.requested_universe(spark, folder), observed, NOW, TRADE
    )


# --- data quality ----------------------------------------------------------------------


@query()
def dq_not_null(spark, folder):
    """Null counts of every column of the trade facts."""
    frame = trade_facts(spark, folder)
    return quality.null_counts(frame, frame.columns)


@query()
def dq_unique(spark, folder):
    """Dimension and fact keys that repeat: product codes repeat without their year."""
    return quality.repeated_keys(
        products(spark, folder), ("product_code",)
    ).unionByName(
        quality.repeated_keys(products(spark, folder), ("trade_product_key",)).withColumnRenamed(
            "trade_product_key", "product_code"
        )
    )


@query()
def dq_unique_observations(spark, folder):
    """Natural keys of staged cells that repeat."""
    return quality.repeated_keys(staged_trade(spark, folder), contracts.TRADE_KEY)


@query()
def dq_unique_prices(spark, folder):
    """Natural keys of prices that repeat: every June is planted twice."""
    prices = source.monthly_prices(spark, folder)
    again = prices.where(F.month("period_month") == 6)
    return quality.repeated_keys(prices.unionByName(again), contracts.PRICE_KEY)


@query()
def dq_accepted(spark, folder):
    """Status values outside a declared list, with their counts."""
    return quality.unaccepted(staged_trade(spark, folder), "source_status", ("u", "p"))


@query()
def dq_relationships(spark, folder):
    """Fact product keys without a dimension row."""
    return quality.orphans(
        trade_facts(spark, folder), "trade_product_key", products(spark, folder),
        "trade_product_key",
    )


@query()
def dq_staging_semantics(spark, folder):
    return checks.staging_semantics(staged_trade(spark, folder), TRADE)


@query()
def dq_scope_break(spark, folder):
    """Facts per segment of the broken product, and how many contradict their year."""
    frame = trade_facts(spark, folder)
    wrong = checks.scope_break_labels(frame, TRADE).select("trade_observation_key")
    return wrong.agg(F.count(F.lit(1)).alias("violations"))


@query()
def dq_mapping_shape(spark, folder):
    return checks.mapping_shape(source.product_mapping(spark, folder), 25, 1995, 2001)


@query()
def dq_preservation(spark, folder):
    """Counts and sums before the pivot, after it and after the dimension joins."""
    staged = stored(staged_trade(spark, folder))
    facts_frame = facts.trade_observations(facts.paired_measures(staged, TRADE), TRADE)
    return checks.fact_totals(
        staged, facts_frame, products(spark, folder), dims.trade_partner(staged), TRADE
    )


def _marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    frame = stored(trade_facts(spark, folder))
    return {
        "fct_trade_observations": frame,
        "monthly_partner_shares": marts.partner_shares(frame),
        "monthly_trade_product_metrics": marts.product_metrics(
            frame, products(spark, folder), TRADE
        ),
        "monthly_trade_balances": marts.trade_balances(frame, TRADE),
        "monthly_partner_concentration": marts.partner_concentration(frame, TRADE),
    }


@query()
def dq_metric_invariants(spark, folder):
    return checks.metric_invariants(*_marts(spark, folder).values())


@query()
def dq_forecast_datasets(spark, folder):
    prices = price_facts(spark, folder)
    return checks.fold_invariants(
        folds.series_manifest(prices, FOLDS),
        folds.origin_features(prices, FOLDS),
        folds.targets(prices, FOLDS),
        FOLDS,
    )


@query()
def dq_forecast_results(spark, folder):
    rows = stored(evaluated(spark, folder))
    return checks.result_invariants(
        forecast.predictions_of(rows, "check", FOLDS), forecast.metrics_of(rows, "check"), FOLDS
    )


# --- metadata and presentation ---------------------------------------------------------


@query()
def metric_dictionary(spark, folder):
    """Declared metrics with the rows that publish each of them."""
    tables = _marts(spark, folder)
    tables["monthly_benchmark_dynamics"] = marts.benchmark_dynamics(price_facts(spark, folder))
    return contracts.metric_population(spark, tables)


@query()
def observed_ranges(spark, folder):
    return presentation.observed_ranges(
        marts.benchmark_dynamics(price_facts(spark, folder)),
        ("source_dataset", "benchmark_series"),
    )


@query()
def partial_series(spark, folder):
    return presentation.partial_series(
        presentation.observed_ranges(
            marts.benchmark_dynamics(price_facts(spark, folder)),
            ("source_dataset", "benchmark_series"),
        )
    )


@query()
def price_rows(spark, folder):
    return presentation.price_rows(marts.benchmark_dynamics(price_facts(spark, folder)))


@query()
def product_mix_rows(spark, folder):
    return presentation.product_mix_rows(
        marts.product_metrics(trade_facts(spark, folder), products(spark, folder), TRADE)
    )


@query()
def mix_completeness(spark, folder):
    return presentation.mix_completeness(
        marts.product_metrics(trade_facts(spark, folder), products(spark, folder), TRADE)
    )


@query()
def valid_balances(spark, folder):
    return presentation.valid_balances(marts.trade_balances(trade_facts(spark, folder), TRADE))


@query()
def balance_validity(spark, folder):
    return presentation.balance_validity(marts.trade_balances(trade_facts(spark, folder), TRADE))


@query("named_partner_hhi")
def named_concentration(spark, folder):
    return presentation.named_concentration(
        marts.partner_concentration(trade_facts(spark, folder), TRADE)
    )


@query("mae", "rmse", "smape_percent", "interval_coverage", "mean_interval_width")
def score_rows(spark, folder):
    return presentation.score_rows(forecast.metrics_of(evaluated(spark, folder), "check"))


@query()
def run_identity(spark, folder):
    return presentation.run_identity(
        forecast.predictions_of(evaluated(spark, folder), "check", FOLDS)
    )
