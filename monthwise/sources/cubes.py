"""Sparse cube documents to trade cells, many documents at once.

A document is one JSON text: dimension order and sizes, category positions and labels, and
values and statuses by flat index (last dimension fastest), each dense or sparse.  Parsing
gives one row per document with every problem found; only documents without problems are
decoded.  Number tokens are cut from the text, so no digit passes through a double.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import TradeDomain
from monthwise.functions.numbers import half_even_decimal
from monthwise.operators.materialize import computed_once

# The seven dimensions in document order.
DIMENSIONS = ("freq", "reporter", "partner", "product", "flow", "indicators", "time")

_ENVELOPE = (
    "class string, version string, id array<string>, size array<int>, updated string, "
    "dimension map<string, struct<category: struct<index: string, label: map<string,string>>>>, "
    "status string"
)
_SPARSE = r'"value"\s*:\s*\{([^{}]*+)\}'
_DENSE = r'"value"\s*:\s*\[([^\[\]]*+)\]'
_ENTRY = "array<struct<i: int, v: string>>"


def _codes_by_position(raw: Column) -> tuple[Column, Column]:
    """Category codes in position order, and whether positions run 0..n-1."""
    listed = F.from_json(raw, "array<string>")
    mapped = F.map_entries(F.from_json(raw, "map<string,int>"))
    ordered = F.array_sort(
        F.transform(mapped, lambda e: F.struct(e["value"].alias("p"), e["key"].alias("code")))
    )
    is_list = raw.startswith("[")
    codes = F.when(is_list, listed).otherwise(F.transform(ordered, lambda e: e["code"]))
    positions = F.transform(ordered, lambda e: e["p"])
    contiguous = F.when(is_list, listed.isNotNull()).otherwise(
        positions == F.sequence(F.lit(0), F.size(ordered) - 1)
    )
    return codes, F.coalesce(contiguous, F.lit(False))


def _value_entries(content: Column) -> Column:
    """(flat index, number token) of the value collection; null when there is none."""
    sparse_body = F.trim(F.regexp_extract(content, _SPARSE, 1))
    dense_body = F.trim(F.regexp_extract(content, _DENSE, 1))
    empty = F.array().cast(_ENTRY)

    def sparse_entry(text: Column) -> Column:
        key = F.regexp_replace(F.substring_index(text, ":", 1), r'["\s]', "")
        return F.struct(
            key.try_cast("int").alias("i"), F.trim(F.substring_index(text, ":", -1)).alias("v")
        )

    def dense_entry(text: Column, position: Column) -> Column:
        token = F.regexp_replace(text, r"\s", "")
        return F.struct(position.alias("i"), F.nullif(token, F.lit("null")).alias("v"))

    sparse = F.transform(F.split(sparse_body, ","), sparse_entry)
    dense = F.transform(F.split(dense_body, ","), dense_entry)
    return F.when(
        content.rlike(_SPARSE), F.when(sparse_body == "", empty).otherwise(sparse)
    ).when(content.rlike(_DENSE), F.when(dense_body == "", empty).otherwise(dense))


def _status_entries(raw: Column) -> Column:
    listed = F.from_json(raw, "array<string>")
    mapped = F.map_entries(F.from_json(raw, "map<string,string>"))
    from_list = F.transform(
        listed, lambda text, position: F.struct(position.alias("i"), text.alias("v"))
    )
    from_map = F.transform(
        mapped, lambda e: F.struct(e["key"].try_cast("int").alias("i"), e["value"].alias("v"))
    )
    return F.when(raw.startswith("["), from_list).otherwise(from_map)


def _number(token: Column) -> Column:
    return half_even_decimal(token, 24, 4, "100000000000000000000")


def _bad_entries(entries: Column, cells: Column, dense: Column, numeric: bool) -> Column:
    """Any entry outside the cube, null in a sparse collection, or not a number."""

    def bad(e: Column) -> Column:
        outside = e["i"].isNull() | (e["i"] < 0) | (e["i"] >= cells)
        empty = e["v"].isNull() | (e["v"] == "null")
        wrong = ~empty & _number(e["v"]).isNull() if numeric else F.lit(False)
        return outside | (~dense & empty) | wrong

    return F.coalesce(F.exists(entries, bad), F.lit(False))


def parse_documents(documents: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """One row per document: codes, entries and the ``problems`` that reject it.

    ``documents`` has document_id and content.  ``requests`` (document_id, reporters,
    products, flows, indicators, months, partners: arrays of codes) fixes the exact scope
    each document must have; without it only the document's own shape is checked.
    """
    content = F.col("content")
    read = computed_once(
        documents.select("document_id", "content"),
        {
            "source_capture_id": F.sha2(content, 256),
            "d": F.from_json(content, _ENVELOPE),
            "value_entries": _value_entries(content),
            "dense_values": content.rlike(_DENSE),
        },
    ).drop("content")
    codes, contiguous = {}, []
    for name in DIMENSIONS:
        listing, fine = _codes_by_position(F.col("d.dimension")[name]["category"]["index"])
        codes[name] = listing
        contiguous.append(fine)
    parsed = computed_once(
        read,
        {
            "status_entries": _status_entries(F.col("d.status")),
            "dense_status": F.coalesce(F.col("d.status").startswith("["), F.lit(False)),
            "cell_count": F.aggregate(
                F.col("d.size"), F.lit(1).cast("long"), lambda total, n: total * n
            ),
            "codes": F.struct(*[c.alias(n) for n, c in codes.items()]),
            "contiguous": reduce(lambda a, b: a & b, contiguous),
        },
    )
    sizes_match = reduce(
        lambda a, b: a & b,
        [
            F.col("d.size")[n] == F.size(F.col("codes")[name])
            for n, name in enumerate(DIMENSIONS)
        ],
    )
    order = F.array(*[F.lit(name) for name in DIMENSIONS])
    labels = F.col("d.dimension")["partner"]["category"]["label"]
    cells = F.col("cell_count")
    rules = {
        "unsupported_envelope": ~(
            F.col("d.class").eqNullSafe(F.lit("dataset"))
            & F.col("d.version").eqNullSafe(F.lit("2.0"))
        ),
        "unexpected_dimensions": ~F.col("d.id").eqNullSafe(order),
        "invalid_sizes": ~(
            F.coalesce(
                (F.size("d.size") == len(DIMENSIONS)) & F.forall("d.size", lambda n: n > 0),
                F.lit(False),
            )
        ),
        "positions_not_contiguous": ~F.col("contiguous"),
        "size_mismatch": ~F.coalesce(sizes_match, F.lit(False)),
        "missing_partner_labels": F.coalesce(
            F.size(F.array_except(F.col("codes.partner"), F.map_keys(labels))) > 0, F.lit(True)
        ),
        "missing_update_time": F.coalesce("d.updated", F.lit("")) == "",
        "missing_values": F.col("value_entries").isNull(),
        "invalid_values": _bad_entries(
            F.col("value_entries"), cells, F.col("dense_values"), numeric=True
        )
        | (F.col("dense_values") & (F.size("value_entries") != cells)),
        "invalid_status": _bad_entries(
            F.col("status_entries"), cells, F.col("dense_status"), numeric=False
        )
        | (F.col("d.status").isNotNull() & F.col("status_entries").isNull())
        | (F.col("dense_status") & (F.size("status_entries") != cells)),
    }
    if requests is not None:
        wanted = {
            "reporter": "reporters", "partner": "partners", "product": "products",
            "flow": "flows", "indicators": "indicators", "time": "months",
        }
        asked = requests.select(
            "document_id", F.struct(*wanted.values()).alias("asked")
        )
        parsed = parsed.join(asked, "document_id", "left")
        rules["not_requested"] = F.col("asked").isNull()
        for name, column in wanted.items():
            same = F.array_sort(F.col("codes")[name]).eqNullSafe(
                F.array_sort(F.array_distinct(F.col("asked")[column]))
            )
            rules[f"unexpected_{name}_scope"] = F.col("asked").isNotNull() & ~same
        rules["unexpected_freq_scope"] = ~F.col("codes.freq").eqNullSafe(F.array(F.lit("M")))
    problems = F.array_compact(
        F.array(*[F.when(F.coalesce(test, F.lit(True)), name) for name, test in rules.items()])
    )
    return computed_once(parsed, {"problems": problems})


def document_violations(parsed: DataFrame) -> DataFrame:
    """(document_id, rule) for every problem of every document."""
    return parsed.select("document_id", F.explode("problems").alias("rule"))


def decode_cells(
    parsed: DataFrame, dataset: str, domain: TradeDomain = TradeDomain()
) -> DataFrame:
    """monthly_trade: the represented cells of all valid documents.

    Values and statuses are exploded together, their coordinates decoded in the same
    stage, and the two sides of a cell meet in one grouped pass that combines before the
    shuffle.  An absent coordinate gives no row, a status without a value a null value.
    """
    values = F.transform(
        F.filter("value_entries", lambda e: e["v"].isNotNull()),
        lambda e: F.struct(e["i"].alias("i"), e["v"].alias("token"), F.lit(None).cast("string").alias("status")),
    )
    statuses = F.transform(
        F.filter(
            F.coalesce("status_entries", F.array().cast(_ENTRY)), lambda e: e["v"].isNotNull()
        ),
        lambda e: F.struct(e["i"].alias("i"), F.lit(None).cast("string").alias("token"), e["v"].alias("status")),
    )
    entries = parsed.where(F.size("problems") == 0).select(
        "source_capture_id",
        "codes",
        F.col("d.size").alias("size"),
        F.col("d.dimension")["partner"]["category"]["label"].alias("labels"),
        F.col("d.updated").alias("source_update_time"),
        F.col("d.status").isNotNull().alias("status_available"),
        F.explode(F.concat(values, statuses)).alias("e"),
    )
    coordinates, stride = {}, F.lit(1)
    for n in reversed(range(len(DIMENSIONS))):
        size = F.col("size")[n]
        place = F.pmod(F.floor(F.col("e.i") / stride).cast("int"), size)
        coordinates[DIMENSIONS[n]] = F.get(F.col("codes")[DIMENSIONS[n]], place)
        stride = stride * size
    partner = coordinates["partner"]
    keyed = entries.select(
        coordinates["freq"].alias("frequency_code"),
        coordinates["reporter"].alias("reporter_code"),
        partner.alias("partner_code"),
        F.coalesce(F.try_element_at("labels", partner), partner).alias("partner_label"),
        coordinates["product"].alias("product_code"),
        coordinates["flow"].alias("flow_code"),
        coordinates["indicators"].alias("indicator_code"),
        F.to_date(F.concat(coordinates["time"], F.lit("-01"))).alias("period_month"),
        "status_available",
        "source_capture_id",
        "source_update_time",
        F.col("e.token").alias("token"),
        F.col("e.status").alias("status"),
    )
    keys = [c for c in keyed.columns if c not in ("token", "status")]
    cells = keyed.groupBy(*keys).agg(
        F.max("token").alias("source_value_text"), F.max("status").alias("source_status")
    )
    return contracts.conform(
        cells.withColumns(
            {
                "source_dataset": F.lit(dataset),
                "source_value": _number(F.col("source_value_text")),
                "classification_code": F.lit(domain.classification_code),
                "classification_year": F.year("period_month").cast("smallint"),
            }
        ),
        "monthly_trade",
    )
