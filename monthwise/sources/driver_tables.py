"""Price and trade sources derived from the order tables, for checks and benchmarks.

lineitem with supplier, nation and part gives bilateral trade cells; orders gives
monthly price series.  The tables hold no nulls and no gaps, so absent cells,
unavailable values and zeros are cut in by fixed arithmetic on the keys: the
branches that treat them differently are then all reached, at any size.

The number of price series grows with the customers (one block of series per 1,500),
so series-keyed work grows with the data too.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import CommodityRule, FoldPlan, PriceDomain, ScopeBreak, TradeDomain
from monthwise.functions.months import first_of_month, month_index

TRADE = TradeDomain(
    aggregate_partners=("WORLD", "BLOC_3"),
    special_partners=("NATION_22", "NATION_23", "NATION_24"),
    classification_code="BRAND",
    scope_breaks=(ScopeBreak("Brand#8", 1997, "1995-1997", "1998-2001"),),
    unbroken_segment="no identified leaf break",
    commodities=CommodityRule(
        prefixes=(("grain_", "grain"), ("metal_", "metal")), fact_default="metal"
    ),
)
PRICES = PriceDomain(
    dataset="orders",
    series_labels=(
        ("1-URGENT", "1-URGENT"), ("2-HIGH", "2-HIGH"), ("3-MEDIUM", "3-MEDIUM"),
        ("4-NOT SPECIFIED", "4-NOT SPECIFIED"), ("5-LOW", "5-LOW"),
    ),
    series_commodity=(),
    default_commodity="orders",
)
FOLDS = FoldPlan(
    history_start=date(1995, 1, 1),
    origin_start=date(1996, 1, 1),
    development_start=date(1998, 1, 1),
    holdout_start=date(2000, 1, 1),
    origin_end=date(2001, 5, 1),
    history_months=24,
    labeled_origins=12,
)
CUSTOMERS_PER_BLOCK = 1500
TOTAL_NO, BLOC_NO, BLOC_REGION = 90, 91, 3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _number_after(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, -1).cast("int")


def shipped_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts by reporter, partner, product, flow and month, with the two totals added.

    Order lines are reduced to partner cells first, on narrow keys; names are looked up
    afterwards.  Only the few cells are repeated for the WORLD and bloc totals, so the
    lines are scanned and shuffled once.  Supplier and part grow with the lines: Spark
    broadcasts them only where their size allows and otherwise splits hot keys (AQE).
    """
    lines = table(spark, folder, "lineitem")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    products = table(spark, folder, "part").select("p_partkey", "p_brand")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    cells = (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(products, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            "l_returnflag",
            "s_nationkey",
            "p_brand",
            "l_linestatus",
            first_of_month(F.col("l_shipdate")).alias("period_month"),
        )
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).alias("amount"),
            F.sum(F.col("l_quantity").cast("decimal(18,4)")).alias("quantity"),
        )
    )
    regions = (nations.drop("n_name"))
    totals = F.when(
        F.col("n_regionkey") == BLOC_REGION,
        F.array(F.col("s_nationkey"), F.lit(TOTAL_NO), F.lit(BLOC_NO)),
    ).otherwise(F.array(F.col("s_nationkey"), F.lit(TOTAL_NO)))
    summed = (
        cells.join(regions, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("partner_no", F.explode(totals))
        .groupBy("l_returnflag", "partner_no", "p_brand", "l_linestatus", "period_month")
        .agg(
            F.sum("amount").cast("decimal(24,4)").alias("amount"),
            F.sum("quantity").cast("decimal(24,4)").alias("quantity"),
        )
    )
    names = (nations.select("n_nationkey", "n_name"))
    return summed.join(names, F.col("partner_no") == F.col("n_nationkey"), "left").select(
        F.concat(F.lit("R"), "l_returnflag").alias("reporter_code"),
        F.when(F.col("partner_no") == TOTAL_NO, "WORLD")
        .when(F.col("partner_no") == BLOC_NO, "BLOC_3")
        .otherwise(F.col("n_name"))
        .alias("partner_code"),
        "partner_no",
        F.col("p_brand").alias("product_code"),
        F.when(F.col("l_linestatus") == "O", "1").otherwise("2").alias("flow_code"),
        "period_month",
        "amount",
        "quantity",
    )


def trade_cells(spark: SparkSession, folder: str) -> DataFrame:
    """monthly_trade with gaps, statuses and zeros cut in (the rules are plain arithmetic)."""
    return _as_cells(shipped_amounts(spark, folder))


def _as_cells(amounts: DataFrame) -> DataFrame:
    numbered = amounts.withColumns(
        {
            "brand": _number_after(F.col("product_code"), "#"),
            "month": month_index(F.col("period_month")),
            "year": F.year("period_month"),
        }
    )
    masked = numbered.withColumn(
        "mask",
        F.pmod(
            F.col("brand") * 7
            + F.col("partner_no") * 13
            + F.col("month") * 5
            + F.col("flow_code").cast("int") * 3,
            F.lit(23),
        ),
    )
    month, partner, brand = F.col("month"), F.col("partner_no"), F.col("brand")
    mask, year = F.col("mask"), F.col("year")
    detail, world = partner < TOTAL_NO, partner == TOTAL_NO
    drop_world = world & (brand % 5 == 2) & (month % 5 == 0)
    hide_mass = (detail & (mask == 1)) | (world & (brand == 9) & (month % 3 == 0))
    shift = (
        F.when(world & (brand == 5) & (month % 4 == 0), F.lit(-1000))
        .when(world & (brand == 6) & (month % 4 == 1), F.lit(500))
        .otherwise(F.lit(0))
    )
    amount = (
        F.when(detail & (mask == 2), F.lit(None))
        .when(detail & (mask == 4), F.lit(0))
        .otherwise(F.col("amount") + shift)
        .cast("decimal(24,4)")
    )
    quantity = (
        F.when(hide_mass, F.lit(None))
        .when(detail & (mask == 3), F.lit(0))
        .otherwise(F.col("quantity"))
        .cast("decimal(24,4)")
    )
    with_status = month % 6 != 0
    renamed = detail & (partner % 7 == 3) & (year >= 1999)
    label = (
        F.when(~detail, F.col("partner_code"))
        .when(renamed, F.concat(F.lit("Nation "), partner.cast("string"), F.lit(" (renamed)")))
        .otherwise(F.concat(F.lit("Nation "), partner.cast("string")))
    )

    def cell(indicator: str, value: Column, status: Column) -> Column:
        return F.struct(
            F.lit(indicator).alias("indicator"), value.alias("value"), status.alias("status")
        )

    value_cell = cell(
        "VALUE_IN_EUROS", amount, F.when(with_status & detail & (mask == 2), F.lit("c"))
    )
    mass_cell = cell("QUANTITY_IN_100KG", quantity, F.when(with_status & hide_mass, F.lit("u")))
    both = F.array(value_cell.alias("v"), mass_cell.alias("q"))
    present = F.when(drop_world, 0).when(detail & (mask == 0), 1).when(
        detail & (mask == 5), 2
    ).otherwise(3)
    rows = masked.select(
        "reporter_code", "partner_code", "product_code", "flow_code", "period_month",
        label.alias("partner_label"),
        with_status.alias("status_available"),
        year.cast("smallint").alias("classification_year"),
        present.alias("present"),
        both.alias("both"),
    ).select("*", F.posexplode("both").alias("place", "cell")).where(
        F.col("present").bitwiseAND((F.col("place") + 1)) != 0
    )
    return rows.select(
        F.lit("driver_trade").alias("source_dataset"),
        F.lit("M").alias("frequency_code"),
        "reporter_code",
        "partner_code",
        "partner_label",
        "product_code",
        "flow_code",
        F.col("cell.indicator").alias("indicator_code"),
        "period_month",
        F.col("cell.value").cast("string").alias("source_value_text"),
        F.col("cell.value").alias("source_value"),
        F.col("cell.status").alias("source_status"),
        "status_available",
        F.lit("BRAND").alias("classification_code"),
        "classification_year",
        F.concat(
            F.lit("trade-"), "reporter_code", F.lit("-"),
            F.col("classification_year").cast("string"),
        ).alias("source_capture_id"),
        F.lit("2002-01-15T11:00:00+0000").alias("source_update_time"),
    ).select(contracts.schema("monthly_trade").fieldNames())


def product_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Brand to group with validity years; one brand moves group, one ends early."""
    brands = table(spark, folder, "part").select(F.col("p_brand").alias("product_code")).distinct()
    brand = _number_after(F.col("product_code"), "#")

    def group_of(bucket: Column) -> Column:
        return (
            F.when(bucket < 5, F.concat(F.lit("grain_"), bucket.cast("string")))
            .when(bucket < 9, F.concat(F.lit("metal_"), bucket.cast("string")))
            .otherwise(F.lit("metal_preparations"))
        )

    def span(group: Column, first: int, last: int) -> Column:
        return F.struct(
            group.alias("product_group"),
            F.lit(first).alias("valid_from_year"),
            F.lit(last).alias("valid_to_year"),
        )

    own = group_of(brand % 10)
    spans = (
        F.when(brand == 13, F.array(span(own, 1995, 1998), span(F.lit("grain_4"), 1999, 2001)))
        .when(brand == 17, F.array(span(own, 1995, 1999)))
        .otherwise(F.array(span(own, 1995, 2001)))
    )
    return brands.select("product_code", F.explode(spans).alias("s")).select(
        "product_code", "s.product_group", "s.valid_from_year", "s.valid_to_year"
    )


def monthly_prices(spark: SparkSession, folder: str) -> DataFrame:
    """monthly_prices: largest order of a status, priority, customer block and month."""
    orders = table(spark, folder, "orders")
    block = F.floor(F.col("o_custkey") / CUSTOMERS_PER_BLOCK).cast("long")
    monthly = orders.groupBy(
        F.concat(F.lit("orders_"), "o_orderstatus").alias("source_dataset"),
        F.concat(
            F.col("o_orderpriority"), F.lit("/"), block.cast("string")
        ).alias("series_id"),
        first_of_month(F.col("o_orderdate")).alias("period_month"),
    ).agg(F.max("o_totalprice").alias("top"))
    month = month_index(F.col("period_month"))
    priority = F.substring("series_id", 1, 1).cast("int")
    gapped = F.col("source_dataset") != "orders_F"
    flat = (F.col("source_dataset") == "orders_P") & (priority == 5)
    absent = gapped & ~flat & (F.pmod(month * 5 + priority * 3, F.lit(31)) == 0)
    unavailable = gapped & ~flat & (F.pmod(month * 7 + priority, F.lit(29)) == 0)
    price = (
        F.when(unavailable, F.lit(None))
        .when(flat, F.lit(100).cast("decimal(20,8)"))
        .otherwise((F.col("top") / 1000).cast("decimal(20,8)"))
    )
    return monthly.where(~absent).select(
        "source_dataset",
        "series_id",
        "period_month",
        F.coalesce(price.cast("string"), F.lit("..")).alias("source_value_text"),
        price.alias("price_usd_per_kg"),
        F.concat(
            F.col("source_dataset"), F.lit("-"), F.year("period_month").cast("string")
        ).alias("source_capture_id"),
        F.lit(None).cast("string").alias("source_status"),
    )


def capture_events(spark: SparkSession, folder: str) -> DataFrame:
    """One retrieval event per order status, year and quarter: capture id, time, update label."""
    orders = table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    return (
        orders.groupBy(
            F.concat(
                F.lit("orders_"), "o_orderstatus", F.lit("-"), F.year(day).cast("string")
            ).alias("source_capture_id"),
            F.quarter(day).alias("quarter"),
        )
        .agg(F.max(day).alias("last_day"))
        .select(
            "source_capture_id",
            F.date_add("last_day", 1).cast("timestamp").alias("retrieved_at_utc"),
            F.concat(
                F.lit("Updated on "), F.date_format("last_day", "MMMM d, yyyy")
            ).alias("source_update_text"),
        )
    )


# --- raw forms of the same data, for the ingest operators ------------------------------

SHEET_CELLS = {
    "urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM",
    "unspecified": "4-NOT SPECIFIED", "low": "5-LOW",
}


def wide_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Price rows as wide text sheets, one per order status and customer block.

    Numbers carry one more digit than the table keeps (a tie that goes to the even digit)
    and null prices are one of the missing markers.
    """
    prices = monthly_prices(spark, folder)
    month = month_index(F.col("period_month"))
    text = F.when(
        F.col("price_usd_per_kg").isNull(), F.when(month % 2 == 0, "..").otherwise(" n.a. ")
    ).otherwise(F.concat(F.col("source_value_text"), F.lit("5")))
    block = F.substring_index("series_id", "/", -1)
    priority = F.substring_index("series_id", "/", 1)
    cells = [
        F.max(F.when(priority == name, text)).alias(column) for column, name in SHEET_CELLS.items()
    ]
    sheets = prices.groupBy(
        F.concat("source_dataset", F.lit("/"), block).alias("source_dataset"), "period_month"
    ).agg(*cells)
    return sheets.select(
        "source_dataset",
        F.concat(F.lit("sheet-"), "source_dataset").alias("source_capture_id"),
        month.cast("int").alias("row_no"),
        F.date_format("period_month", "yyyy'M'MM").alias("period_text"),
        *SHEET_CELLS,
    )


def broken_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """The sheets with errors cut in: bad periods, repeated rows, text, NaN and formulas."""
    row = F.col("row_no")
    return (
        wide_sheets(spark, folder)
        .withColumns(
            {
                "period_text": F.when(
                    row % 17 == 3, F.concat(F.substring("period_text", 1, 5), F.lit("13"))
                ).otherwise(F.col("period_text")),
                "high": F.when(row % 19 == 4, "abc").otherwise(F.col("high")),
                "medium": F.when(row % 23 == 5, "NaN").otherwise(F.col("medium")),
                "unspecified": F.when(row % 31 == 7, "=A1+1").otherwise(F.col("unspecified")),
                "low": F.when(row % 37 == 8, "1000000000000").otherwise(F.col("low")),
            }
        )
        .withColumn(
            "copy",
            F.explode(
                F.when(row % 29 == 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("copy")
    )


def cube_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Trade cells as JSON cube documents, one per reporter and month.

    Even months hold sparse values and mapped positions, odd months dense values and listed
    positions.  A document holds at most partners x products x flows x indicators cells.
    """
    amounts = shipped_amounts(spark, folder)
    cells = _as_cells(amounts)
    partner_codes = [f"NATION_{n}" for n in range(25)] + ["WORLD", "BLOC_3"]
    product_codes = [f"Brand#{n}" for n in range(1, 26)]
    flow_codes, indicators = ["1", "2"], ["VALUE_IN_EUROS", "QUANTITY_IN_100KG"]
    sizes = [1, 1, len(partner_codes), len(product_codes), 2, 2, 1]
    total = len(partner_codes) * len(product_codes) * 4

    def texts(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    place = (
        (
            (F.array_position(texts(partner_codes), F.col("partner_code")) - 1)
            * len(product_codes)
            + F.array_position(texts(product_codes), F.col("product_code")) - 1
        )
        * 2
        + F.array_position(texts(flow_codes), F.col("flow_code")) - 1
    ) * 2 + F.array_position(texts(indicators), F.col("indicator_code")) - 1
    place = place.cast("int")
    number = F.struct(place.alias("at"), F.col("source_value_text").alias("text"))
    mark = F.struct(place.cast("string"), "source_status")
    documents = cells.groupBy("reporter_code", "period_month", "status_available").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("source_value").isNotNull(), number))
        ).alias("values"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("source_status").isNotNull(), mark))
        ).alias("statuses"),
        F.max("source_update_time").alias("updated"),
    )
    month = F.date_format("period_month", "yyyy-MM")
    year, sparse = F.year("period_month"), month_index(F.col("period_month")) % 2 == 0

    def json_text(values: Column) -> Column:
        return F.concat_ws(",", F.transform(values, lambda v: F.concat(F.lit('"'), v, F.lit('"'))))

    def category(values: Column, labels: Column | None = None) -> Column:
        listed = F.concat(F.lit("["), json_text(values), F.lit("]"))
        mapped = F.concat(
            F.lit("{"),
            F.concat_ws(
                ",",
                F.transform(
                    values,
                    lambda v, n: F.concat(F.lit('"'), v, F.lit('":'), n.cast("string")),
                ),
            ),
            F.lit("}"),
        )
        names = F.lit("{}") if labels is None else F.concat(
            F.lit("{"),
            F.concat_ws(
                ",",
                F.zip_with(
                    values, labels,
                    lambda v, t: F.concat(F.lit('"'), v, F.lit('":"'), t, F.lit('"')),
                ),
            ),
            F.lit("}"),
        )
        return F.concat(
            F.lit('{"category":{"index":'), F.when(sparse, mapped).otherwise(listed),
            F.lit(',"label":'), names, F.lit("}}"),
        )

    labels = F.transform(
        texts(partner_codes),
        lambda code, n: F.when(n >= 25, code)
        .when((n % 7 == 3) & (year >= 1999), F.concat(F.lit("Nation "), n.cast("string"), F.lit(" (renamed)")))
        .otherwise(F.concat(F.lit("Nation "), n.cast("string"))),
    )
    dimension = F.concat(
        F.lit('{"freq":'), category(texts(["M"])),
        F.lit(',"reporter":'), category(F.array("reporter_code")),
        F.lit(',"partner":'), category(texts(partner_codes), labels),
        F.lit(',"product":'), category(texts(product_codes)),
        F.lit(',"flow":'), category(texts(flow_codes)),
        F.lit(',"indicators":'), category(texts(indicators)),
        F.lit(',"time":'), category(F.array(month)),
        F.lit("}"),
    )
    def gap(after: Column, before: Column) -> Column:
        return F.repeat(F.lit("null,"), before - after - 1)

    filled = F.transform(
        "values",
        lambda e, n: F.concat(
            gap(F.coalesce(F.get("values", n - 1)["at"], F.lit(-1)), e["at"]), e["text"]
        ),
    )
    last = F.try_element_at("values", F.lit(-1))["at"]
    dense = F.concat(
        F.lit("["), F.concat_ws(",", filled),
        F.repeat(F.lit(",null"), F.lit(total - 1) - last), F.lit("]"),
    )
    sparse_values = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            F.transform(
                "values",
                lambda e: F.concat(F.lit('"'), e["at"].cast("string"), F.lit('":'), e["text"]),
            ),
        ),
        F.lit("}"),
    )
    status = F.when(
        F.col("status_available"), F.concat(F.lit(',"status":'), F.to_json("statuses"))
    ).otherwise("")
    content = F.concat(
        F.lit('{"class":"dataset","version":"2.0","id":["freq","reporter","partner","product","flow","indicators","time"],"size":'),
        F.lit(str(sizes).replace(" ", "")),
        F.lit(',"updated":"'), "updated", F.lit('","dimension":'), dimension,
        F.lit(',"value":'), F.when(sparse, sparse_values).otherwise(dense), status, F.lit("}"),
    )
    return documents.select(
        F.concat("reporter_code", F.lit("-"), month).alias("document_id"), content.alias("content")
    )


def cube_requests(documents: DataFrame) -> DataFrame:
    """The scope each document was asked for, from its id."""
    partners = [f"NATION_{n}" for n in range(25)] + ["WORLD", "BLOC_3"]

    def texts(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    return documents.select(
        "document_id",
        F.array(F.substring_index("document_id", "-", 1)).alias("reporters"),
        texts(partners).alias("partners"),
        texts([f"Brand#{n}" for n in range(1, 26)]).alias("products"),
        texts(["1", "2"]).alias("flows"),
        texts(["VALUE_IN_EUROS", "QUANTITY_IN_100KG"]).alias("indicators"),
        F.array(F.substring_index("document_id", "-", -2)).alias("months"),
    )


def repeated_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Trade cells with some keys repeated: equal rows for one brand, other values for another."""
    brand = _number_after(F.col("product_code"), "#")
    copies = F.when(
        (brand <= 2) & (month_index(F.col("period_month")) % 13 == 0),
        F.array(F.lit(0), F.lit(1)),
    ).otherwise(F.array(F.lit(0)))
    changed = (F.col("copy") == 1) & (brand == 2)
    return (
        trade_cells(spark, folder)
        .withColumn("copy", F.explode(copies))
        .withColumn(
            "source_value_text",
            F.when(changed, F.lit("changed")).otherwise(F.col("source_value_text")),
        )
        .drop("copy")
    )


def revised_cells(cells: DataFrame) -> DataFrame:
    """A later version of the cells: some withdrawn, the others' values raised by one tenth."""
    brand = _number_after(F.col("product_code"), "#")
    kept = F.pmod(brand + month_index(F.col("period_month")), F.lit(7)) != 0
    value = (F.col("source_value") * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(24,4)")
    return cells.where(kept).withColumns(
        {
            "source_value": value,
            "source_value_text": value.cast("string"),
            "source_capture_id": F.concat(F.col("source_capture_id"), F.lit("-b")),
            "source_update_time": F.lit("2002-02-15T11:00:00+0000"),
        }
    )


def requested_universe(spark: SparkSession, folder: str) -> DataFrame:
    """Per reporter every partner, product and flow, and one partner that never trades."""
    names = table(spark, folder, "nation").agg(F.collect_list("n_name"))
    brands = table(spark, folder, "part").select("p_brand").distinct()
    reporters = table(spark, folder, "lineitem").select("l_returnflag").distinct()
    totals = F.array(F.lit("WORLD"), F.lit("BLOC_3"), F.lit("NATION_ABSENT"))
    return reporters.select(
        F.lit("driver_trade").alias("source_dataset"),
        F.concat(F.lit("R"), "l_returnflag").alias("reporter_code"),
        F.concat(names.scalar(), totals).alias("partners"),
        brands.agg(F.collect_list("p_brand")).scalar().alias("products"),
        F.array(F.lit("1"), F.lit("2")).alias("flows"),
    )
