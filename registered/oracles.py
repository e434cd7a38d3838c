"""DuckDB SQL that states each registered query independently of the Spark plans.

Fragments are named CTEs; :func:`sql` strings together the ones a query needs.  The SQL
favours the direct reading of a definition (self-joins, correlated counts, filtered
distinct aggregates) over speed, so that it checks the rewritten Spark forms.
"""

from __future__ import annotations

from monthwise.contracts import METRICS

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTE[name] = (tuple(needs.split()), body)


def sql(needs: str, final: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dependency in CTE[name][0]:
                visit(dependency)
            order.append(name)

    for name in needs.split():
        visit(name)
    parts = ",\n".join(f"{name} AS ({CTE[name][1].strip()})" for name in order)
    final = final.strip()
    if parts and final.startswith("WITH "):  # the statement brings fragments of its own
        return f"WITH {parts},\n{final[5:]}"
    return f"WITH {parts}\n{final}" if parts else final


# --- sources ---------------------------------------------------------------------------

cte("partner_cells", "", """
  SELECT 'R' || l_returnflag AS reporter_code, n_name, n_nationkey, n_regionkey,
         p_brand AS product_code, CASE l_linestatus WHEN 'O' THEN '1' ELSE '2' END AS flow_code,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS period_month,
         sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS amount,
         sum(CAST(l_quantity AS DECIMAL(18,4))) AS quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
  GROUP BY ALL
""")
cte("amounts", "partner_cells", """
  SELECT reporter_code, n_name AS partner_code, n_nationkey AS partner_no, product_code, flow_code,
         period_month, amount, quantity FROM partner_cells
  UNION ALL
  SELECT reporter_code, 'WORLD', 90, product_code, flow_code, period_month, sum(amount), sum(quantity)
  FROM partner_cells GROUP BY ALL
  UNION ALL
  SELECT reporter_code, 'BLOC_3', 91, product_code, flow_code, period_month, sum(amount), sum(quantity)
  FROM partner_cells WHERE n_regionkey = 3 GROUP BY ALL
""")
cte("ruled", "amounts", """
  SELECT *, (brand * 7 + partner_no * 13 + mi * 5 + CAST(flow_code AS INTEGER) * 3) % 23 AS mask
  FROM (SELECT *, CAST(split_part(product_code, '#', 2) AS INTEGER) AS brand,
               year(period_month) * 12 + month(period_month) - 1 AS mi FROM amounts)
""")
cte("marked", "ruled", """
  SELECT reporter_code, partner_code, product_code, flow_code, period_month, mi % 6 <> 0 AS status_available,
    CASE WHEN partner_no >= 90 THEN partner_code
         WHEN partner_no % 7 = 3 AND year(period_month) >= 1999 THEN 'Nation ' || partner_no || ' (renamed)'
         ELSE 'Nation ' || partner_no END AS partner_label,
    CASE WHEN partner_no < 90 AND mask = 2 THEN NULL WHEN partner_no < 90 AND mask = 4 THEN 0
         WHEN partner_no = 90 AND brand = 5 AND mi % 4 = 0 THEN amount - 1000
         WHEN partner_no = 90 AND brand = 6 AND mi % 4 = 1 THEN amount + 500
         ELSE amount END AS value_amount,
    CASE WHEN partner_no < 90 AND mask = 2 THEN 'c' END AS value_mark,
    CASE WHEN partner_no < 90 AND mask = 1 THEN NULL WHEN partner_no = 90 AND brand = 9 AND mi % 3 = 0 THEN NULL
         WHEN partner_no < 90 AND mask = 3 THEN 0 ELSE quantity END AS mass_amount,
    CASE WHEN partner_no < 90 AND mask = 1 THEN 'u' WHEN partner_no = 90 AND brand = 9 AND mi % 3 = 0 THEN 'u' END
      AS mass_mark,
    NOT (partner_no = 90 AND brand % 5 = 2 AND mi % 5 = 0) AND NOT (partner_no < 90 AND mask = 5) AS has_value_cell,
    NOT (partner_no = 90 AND brand % 5 = 2 AND mi % 5 = 0) AND NOT (partner_no < 90 AND mask = 0) AS has_mass_cell
  FROM ruled
""")
cte("cells", "marked", """
  SELECT 'driver_trade' AS source_dataset, 'M' AS frequency_code, reporter_code, partner_code, partner_label,
         product_code, flow_code, i.indicator_code, period_month, CAST(i.v AS VARCHAR) AS source_value_text,
         i.v AS source_value, CASE WHEN status_available THEN i.mark END AS source_status, status_available,
         'BRAND' AS classification_code, CAST(year(period_month) AS SMALLINT) AS classification_year,
         'trade-' || reporter_code || '-' || year(period_month) AS source_capture_id,
         '2002-01-15T11:00:00+0000' AS source_update_time
  FROM marked, LATERAL (
    SELECT 'VALUE_IN_EUROS' AS indicator_code, CAST(value_amount AS DECIMAL(24,4)) AS v, value_mark AS mark,
           has_value_cell AS present
    UNION ALL
    SELECT 'QUANTITY_IN_100KG', CAST(mass_amount AS DECIMAL(24,4)), mass_mark, has_mass_cell) AS i
  WHERE i.present
""")
cte("mapping", "", """
  SELECT product_code,
    CASE WHEN brand = 13 AND r = 2 THEN 'grain_4' WHEN b < 5 THEN 'grain_' || b WHEN b < 9 THEN 'metal_' || b
         ELSE 'metal_preparations' END AS product_group,
    CASE WHEN brand = 13 AND r = 2 THEN 1999 ELSE 1995 END AS valid_from_year,
    CASE WHEN brand = 13 AND r = 1 THEN 1998 WHEN brand = 17 THEN 1999 ELSE 2001 END AS valid_to_year
  FROM (SELECT DISTINCT p_brand AS product_code, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand,
               CAST(split_part(p_brand, '#', 2) AS INTEGER) % 10 AS b FROM part),
       (VALUES (1), (2)) AS t(r)
  WHERE r = 1 OR brand = 13
""")
cte("prices", "", """
  SELECT source_dataset, series_id, period_month, coalesce(CAST(price AS VARCHAR), '..') AS source_value_text,
         price AS price_usd_per_kg, source_dataset || '-' || year(period_month) AS source_capture_id,
         CAST(NULL AS VARCHAR) AS source_status
  FROM (
    SELECT *, CASE WHEN gapped AND NOT flat AND (mi * 7 + pr) % 29 = 0 THEN NULL
                   WHEN flat THEN CAST(100 AS DECIMAL(20,8)) ELSE CAST(top / 1000 AS DECIMAL(20,8)) END AS price
    FROM (
      SELECT 'orders_' || o_orderstatus AS source_dataset,
             o_orderpriority || '/' || (o_custkey // 1500) AS series_id,
             CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month,
             CAST(o_orderpriority[1] AS INTEGER) AS pr, o_orderstatus <> 'F' AS gapped,
             o_orderstatus = 'P' AND o_orderpriority[1] = '5' AS flat, max(o_totalprice) AS top,
             year(o_orderdate) * 12 + month(o_orderdate) - 1 AS mi
      FROM orders GROUP BY ALL)
    WHERE NOT (gapped AND NOT flat AND (mi * 5 + pr * 3) % 31 = 0))
""")

# --- staging and facts -----------------------------------------------------------------

cte("staged", "cells mapping", """
  SELECT c.source_dataset, frequency_code, reporter_code, partner_code, partner_label, c.product_code,
    m.product_group, classification_code, classification_year, flow_code, indicator_code, source_value_text,
    source_value, source_status, status_available, period_month, source_capture_id, source_update_time,
    CASE WHEN partner_code IN ('WORLD', 'BLOC_3') THEN 'aggregate'
         WHEN partner_code IN ('NATION_22', 'NATION_23', 'NATION_24') THEN 'special' ELSE 'named' END AS partner_class,
    partner_code NOT IN ('WORLD', 'BLOC_3') AS is_partner_detail,
    CASE WHEN c.product_code <> 'Brand#8' THEN 'no identified leaf break'
         WHEN classification_year < 1998 THEN '1995-1997' ELSE '1998-2001' END AS comparability_segment,
    CASE flow_code WHEN '1' THEN 'imports' ELSE 'exports' END AS flow_name,
    CASE indicator_code WHEN 'VALUE_IN_EUROS' THEN 'EUR' ELSE '100kg' END AS source_unit,
    CASE indicator_code WHEN 'VALUE_IN_EUROS' THEN 'EUR' ELSE 'kg' END AS normalized_unit,
    CAST(CASE indicator_code WHEN 'VALUE_IN_EUROS' THEN source_value ELSE source_value * 100 END AS DECIMAL(34,4))
      AS normalized_value
  FROM cells c LEFT JOIN mapping m ON m.product_code = c.product_code
    AND c.classification_year >= m.valid_from_year AND c.classification_year <= m.valid_to_year
""")
cte("pivoted", "staged", """
  SELECT *, trade_value_eur IS NOT NULL AS has_numeric_value, net_mass_kg IS NOT NULL AS has_numeric_mass,
    trade_value_eur IS NOT NULL AND net_mass_kg IS NOT NULL AS has_paired_measures,
    CASE WHEN net_mass_kg > 0 THEN CAST(trade_value_eur AS DOUBLE) / CAST(net_mass_kg AS DOUBLE) END
      AS unit_value_eur_per_kg,
    CASE flow_name WHEN 'imports' THEN 'CIF' ELSE 'FOB' END AS value_basis
  FROM (
    SELECT k.*, v.indicator_code IS NOT NULL AS value_cell_present, v.source_value AS trade_value_eur,
           v.source_status AS value_status, v.status_available AS value_status_available,
           q.indicator_code IS NOT NULL AS quantity_cell_present, q.normalized_value AS net_mass_kg,
           q.source_status AS quantity_status, q.status_available AS quantity_status_available
    FROM (SELECT DISTINCT source_dataset, frequency_code, reporter_code, partner_code, partner_label,
                 partner_class, is_partner_detail, product_code, product_group, classification_code,
                 classification_year, comparability_segment, flow_code, flow_name, period_month,
                 source_capture_id, source_update_time FROM staged) k
    LEFT JOIN (SELECT * FROM staged WHERE indicator_code = 'VALUE_IN_EUROS') v
      USING (reporter_code, partner_code, product_code, flow_code, period_month)
    LEFT JOIN (SELECT * FROM staged WHERE indicator_code = 'QUANTITY_IN_100KG') q
      USING (reporter_code, partner_code, product_code, flow_code, period_month))
""")
cte("facts", "pivoted", """
  SELECT period_month AS month_key, * EXCLUDE (period_month),
    concat_ws(':', source_dataset, reporter_code, partner_code, product_code, classification_year, flow_code,
              period_month) AS trade_observation_key,
    concat_ws(':', product_code, classification_year) AS trade_product_key,
    concat_ws(':', source_dataset, reporter_code, partner_code) AS trade_partner_key,
    CASE WHEN starts_with(product_group, 'grain_') THEN 'grain' ELSE 'metal' END AS commodity_key
  FROM pivoted
""")
cte("partners", "staged", """
  SELECT source_dataset, reporter_code, partner_code, min(partner_label) AS partner_label, partner_class,
         is_partner_detail, count(DISTINCT partner_label) AS label_count,
         concat_ws(':', source_dataset, reporter_code, partner_code) AS trade_partner_key
  FROM staged GROUP BY source_dataset, reporter_code, partner_code, partner_class, is_partner_detail
""")
cte("products", "mapping", """
  SELECT product_code, CAST(y AS INTEGER) AS classification_year, 'BRAND' AS classification_code, product_group,
         product_code || ':' || y AS trade_product_key, split_part(product_group, '_', 1) AS commodity_key,
         product_code = 'Brand#8' AS has_scope_break,
         CASE WHEN product_code <> 'Brand#8' THEN 'no identified leaf break'
              WHEN y < 1998 THEN '1995-1997' ELSE '1998-2001' END AS comparability_segment
  FROM mapping JOIN (SELECT unnest(generate_series(1990, 2010)) AS y) ON y BETWEEN valid_from_year AND valid_to_year
""")
cte("changes", "prices", """
  SELECT p.source_dataset, p.series_id, p.period_month, p.price_usd_per_kg, p.source_capture_id,
         p.price_usd_per_kg - b.price_usd_per_kg AS change_usd_per_kg,
         CASE WHEN b.price_usd_per_kg > 0 THEN CAST(p.price_usd_per_kg - b.price_usd_per_kg AS DOUBLE)
              / CAST(b.price_usd_per_kg AS DOUBLE) * 100 END AS change_percent
  FROM prices p LEFT JOIN prices b ON b.source_dataset = p.source_dataset AND b.series_id = p.series_id
    AND b.period_month = p.period_month - INTERVAL 1 MONTH
""")
cte("price_facts", "changes", """
  SELECT source_dataset, series_id AS benchmark_series, period_month AS month_key, price_usd_per_kg,
         change_usd_per_kg, change_percent, 'USD' AS currency_code, 'kg' AS mass_unit, source_capture_id,
         concat_ws(':', source_dataset, series_id, period_month) AS benchmark_price_key, 'orders' AS commodity_key
  FROM changes
""")

# --- marts -----------------------------------------------------------------------------

cte("dynamics", "price_facts", """
  SELECT f.*, false AS is_trade_product_identity,
         CAST(f.price_usd_per_kg AS DOUBLE) / CAST(nullif(b.price_usd_per_kg, 0) AS DOUBLE) * 100 AS benchmark_index
  FROM price_facts f
  LEFT JOIN (SELECT source_dataset, benchmark_series, price_usd_per_kg FROM price_facts
             WHERE price_usd_per_kg IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY source_dataset, benchmark_series ORDER BY month_key) = 1) b
    USING (source_dataset, benchmark_series)
""")
cte("mix", "facts", """
  SELECT source_dataset, reporter_code, month_key, classification_year, product_group, flow_code, flow_name,
    value_basis,
    count(DISTINCT CASE WHEN value_cell_present THEN product_code END) AS represented_value_product_count,
    count(DISTINCT CASE WHEN has_numeric_value THEN product_code END) AS observed_value_product_count,
    count(DISTINCT CASE WHEN quantity_cell_present THEN product_code END) AS represented_mass_product_count,
    count(DISTINCT CASE WHEN has_numeric_mass THEN product_code END) AS observed_mass_product_count,
    count(DISTINCT CASE WHEN has_paired_measures AND net_mass_kg > 0 THEN product_code END) AS paired_product_count,
    CAST(sum(trade_value_eur) AS DECIMAL(38,4)) AS world_value_eur,
    CAST(sum(net_mass_kg) AS DECIMAL(38,4)) AS world_net_mass_kg,
    CAST(sum(CASE WHEN has_paired_measures AND net_mass_kg > 0 THEN trade_value_eur END) AS DECIMAL(38,4))
      AS paired_value_eur,
    CAST(sum(CASE WHEN has_paired_measures AND net_mass_kg > 0 THEN net_mass_kg END) AS DECIMAL(38,4))
      AS paired_net_mass_kg
  FROM facts WHERE partner_code = 'WORLD' GROUP BY ALL
""")
cte("covered", "mix products", """
  SELECT x.*, g.n AS expected_product_count, g.brk AS contains_scope_break, u.n AS universe_expected_product_count
  FROM mix x
  JOIN (SELECT classification_year, product_group, count(*) AS n, bool_or(has_scope_break) AS brk
        FROM products GROUP BY ALL) g USING (classification_year, product_group)
  JOIN (SELECT classification_year, count(*) AS n FROM products GROUP BY ALL) u USING (classification_year)
""")
cte("metrics", "covered", """
  SELECT c.*, observed_value_product_count = expected_product_count AS has_complete_value_coverage,
    observed_mass_product_count = expected_product_count AS has_complete_mass_coverage,
    paired_product_count = expected_product_count AS has_complete_paired_coverage,
    t.total AS observed_product_mix_denominator_eur, t.seen AS universe_observed_value_product_count,
    t.declared AS declared_universe_expected_product_count,
    'WORLD rows for observed selected CN8 leaves' AS coverage_basis,
    CASE WHEN paired_net_mass_kg > 0 THEN CAST(paired_value_eur AS DOUBLE) / CAST(paired_net_mass_kg AS DOUBLE) END
      AS observed_unit_value_eur_per_kg,
    CASE WHEN t.total > 0 THEN CAST(world_value_eur AS DOUBLE) / CAST(t.total AS DOUBLE) END
      AS observed_product_value_share,
    t.seen = t.declared AS has_complete_product_mix_universe
  FROM covered c
  JOIN (SELECT source_dataset, reporter_code, month_key, flow_code, CAST(sum(world_value_eur) AS DECIMAL(38,4)) AS total,
               CAST(sum(observed_value_product_count) AS BIGINT) AS seen, max(universe_expected_product_count) AS declared
        FROM covered GROUP BY ALL) t USING (source_dataset, reporter_code, month_key, flow_code)
""")
cte("leaf_flow", "facts", """
  SELECT source_dataset, reporter_code, month_key, classification_year, product_group, flow_code,
         CAST(sum(trade_value_eur) AS DECIMAL(38,4)) AS v, count(DISTINCT product_code) AS n,
         string_agg(DISTINCT product_code, ',' ORDER BY product_code) AS leaves
  FROM facts WHERE partner_code = 'WORLD' AND trade_value_eur IS NOT NULL GROUP BY ALL
""")
cte("balances", "leaf_flow", """
  SELECT k.*, i.v AS import_value_cif_eur, e.v AS export_value_fob_eur, i.n AS import_product_count,
    e.n AS export_product_count, i.leaves AS import_product_coverage, e.leaves AS export_product_coverage,
    'WORLD rows with identical observed value-leaf sets for both flows' AS coverage_basis,
    coalesce(i.leaves = e.leaves, false) AS has_compatible_flow_coverage,
    CASE WHEN i.leaves = e.leaves THEN CAST(e.v - i.v AS DECIMAL(38,4)) END AS trade_balance_eur
  FROM (SELECT DISTINCT source_dataset, reporter_code, month_key, classification_year, product_group
        FROM leaf_flow) k
  LEFT JOIN leaf_flow i ON i.flow_code = '1' AND i.reporter_code = k.reporter_code AND i.month_key = k.month_key
    AND i.classification_year = k.classification_year AND i.product_group IS NOT DISTINCT FROM k.product_group
  LEFT JOIN leaf_flow e ON e.flow_code = '2' AND e.reporter_code = k.reporter_code AND e.month_key = k.month_key
    AND e.classification_year = k.classification_year AND e.product_group IS NOT DISTINCT FROM k.product_group
""")
cte("named", "facts", """
  SELECT source_dataset, reporter_code, month_key, classification_year, product_group, flow_code, flow_name,
         value_basis, trade_partner_key, partner_code, partner_label,
         CAST(sum(trade_value_eur) AS DECIMAL(38,4)) AS partner_value_eur,
         count(DISTINCT product_code) AS observed_product_count
  FROM facts WHERE partner_class = 'named' AND trade_value_eur IS NOT NULL GROUP BY ALL
""")
cte("shares", "named", """
  SELECT *, 'observed named partners with numeric VALUE_IN_EUROS cells' AS concentration_universe,
    CASE WHEN named_partner_denominator_eur > 0 THEN CAST(partner_value_eur AS DOUBLE)
         / CAST(named_partner_denominator_eur AS DOUBLE) END AS named_partner_value_share,
    named_partner_denominator_eur > 0 AS has_positive_named_denominator
  FROM (SELECT *, CAST(sum(partner_value_eur) OVER w AS DECIMAL(38,4)) AS named_partner_denominator_eur,
               row_number() OVER (w ORDER BY partner_value_eur DESC, partner_code) AS named_partner_rank
        FROM named WINDOW w AS (PARTITION BY source_dataset, reporter_code, month_key, product_group, flow_code))
""")
cte("leaf_context", "facts", """
  SELECT source_dataset, reporter_code, month_key, classification_year, product_group, flow_code, product_code,
         sum(CASE WHEN partner_class = 'named' THEN trade_value_eur END) AS n,
         sum(CASE WHEN partner_class = 'special' THEN trade_value_eur END) AS s,
         sum(CASE WHEN partner_code = 'WORLD' THEN trade_value_eur END) AS w
  FROM facts WHERE partner_code <> 'BLOC_3' GROUP BY ALL
""")
cte("context", "leaf_context", """
  SELECT source_dataset, reporter_code, month_key, classification_year, product_group, flow_code,
    CAST(sum(s) AS DECIMAL(38,4)) AS observed_special_value_eur, CAST(sum(w) AS DECIMAL(38,4)) AS world_value_eur,
    CAST(sum(w - coalesce(n, 0) - coalesce(s, 0)) AS DECIMAL(38,4)) AS reconciliation_residual_eur,
    count(n) AS named_observed_product_count, count(s) AS special_observed_product_count,
    count(w) AS world_observed_product_count,
    string_agg(CASE WHEN n IS NOT NULL THEN product_code END, ',' ORDER BY product_code) AS named_product_coverage,
    string_agg(CASE WHEN s IS NOT NULL THEN product_code END, ',' ORDER BY product_code) AS special_product_coverage,
    string_agg(CASE WHEN w IS NOT NULL THEN product_code END, ',' ORDER BY product_code) AS world_product_coverage
  FROM leaf_context GROUP BY ALL
""")
cte("index_by_block", "shares", """
  SELECT source_dataset, reporter_code, month_key, classification_year, product_group, flow_code,
         max(named_partner_denominator_eur) AS named_partner_value_eur, count(*) AS named_partner_count,
         max(named_partner_value_share) AS largest_named_partner_share,
         sum(named_partner_value_share ** 2) AS named_partner_hhi
  FROM shares GROUP BY ALL
""")
cte("concentration", "context index_by_block", """
  SELECT c.source_dataset, c.reporter_code, c.month_key, c.classification_year, c.product_group, c.flow_code,
    x.named_partner_value_eur, x.largest_named_partner_share, x.named_partner_hhi,
    c.observed_special_value_eur, c.world_value_eur, c.reconciliation_residual_eur,
    c.named_observed_product_count, c.special_observed_product_count, c.world_observed_product_count,
    c.named_product_coverage, c.special_product_coverage, c.world_product_coverage,
    'observed named partners with numeric VALUE_IN_EUROS cells' AS concentration_universe,
    CASE c.flow_code WHEN '1' THEN 'imports' ELSE 'exports' END AS flow_name,
    CASE c.flow_code WHEN '1' THEN 'CIF' ELSE 'FOB' END AS value_basis,
    coalesce(x.named_partner_count, 0) AS named_partner_count,
    x.named_partner_value_eur IS NOT NULL AND x.named_partner_value_eur > 0 AS has_positive_named_denominator,
    CASE WHEN world_value_eur <> 0 THEN CAST(observed_special_value_eur AS DOUBLE) / CAST(world_value_eur AS DOUBLE) END
      AS observed_special_share_of_world,
    CASE WHEN world_value_eur <> 0 THEN CAST(reconciliation_residual_eur AS DOUBLE) / CAST(world_value_eur AS DOUBLE) END
      AS residual_share_of_world,
    CASE WHEN world_value_eur IS NULL THEN 'WORLD unavailable'
         WHEN named_product_coverage IS DISTINCT FROM world_product_coverage THEN 'partial WORLD coverage'
         ELSE CASE sign(reconciliation_residual_eur) WHEN 0 THEN 'exact' WHEN 1 THEN 'positive residual'
              ELSE 'named plus special exceeds WORLD' END END AS reconciliation_status
  FROM context c LEFT JOIN index_by_block x
    ON x.reporter_code = c.reporter_code AND x.month_key = c.month_key AND x.flow_code = c.flow_code
    AND x.classification_year = c.classification_year AND x.product_group = c.product_group
""")

# --- forecast --------------------------------------------------------------------------

cte("series_list", "price_facts", "SELECT DISTINCT source_dataset, benchmark_series AS series_id FROM price_facts")
cte("px", "price_facts", """
  SELECT source_dataset, benchmark_series AS series_id, month_key, price_usd_per_kg AS price,
         source_capture_id AS cap FROM price_facts WHERE month_key BETWEEN DATE '1994-01-01' AND DATE '2001-08-01'
""")
cte("manifest", "", """
  SELECT CAST(o AS DATE) AS origin_month, 'retrospective_current_vintage' AS evaluation_mode,
    24 AS minimum_observed_history_months, 12 AS minimum_labeled_training_origins,
    strftime(o + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS issue_at_utc,
    CASE WHEN o < DATE '1998-01-01' THEN 'training' WHEN o < DATE '2000-01-01' THEN 'development' ELSE 'holdout' END
      AS split_name
  FROM (SELECT unnest(generate_series(DATE '1996-01-01', DATE '2001-05-01', INTERVAL 1 MONTH)) AS o)
""")
cte("series_origins", "series_list px manifest", """
  SELECT * FROM (SELECT DISTINCT source_dataset, series_id FROM px) CROSS JOIN manifest
""")
cte("features", "series_origins px", """
  SELECT o.source_dataset, o.series_id, o.origin_month, o.issue_at_utc, o.split_name, o.evaluation_mode,
    o.origin_month AS lag_0_month, l0.price AS lag_0_usd_per_kg, l0.cap AS lag_0_capture_id,
    CAST(o.origin_month - INTERVAL 1 MONTH AS DATE) AS lag_1_month, l1.price AS lag_1_usd_per_kg,
    l1.cap AS lag_1_capture_id,
    CAST(o.origin_month - INTERVAL 3 MONTH AS DATE) AS lag_3_month, l3.price AS lag_3_usd_per_kg,
    l3.cap AS lag_3_capture_id,
    CAST(o.origin_month - INTERVAL 12 MONTH AS DATE) AS lag_12_month, l12.price AS lag_12_usd_per_kg,
    l12.cap AS lag_12_capture_id,
    CAST(w.n AS INTEGER) AS observed_history_months_24, w.n = 24 AS has_minimum_history
  FROM series_origins o
  JOIN (SELECT a.source_dataset, a.series_id, a.origin_month, count(b.price) AS n
        FROM series_origins a LEFT JOIN px b ON a.source_dataset = b.source_dataset AND a.series_id = b.series_id
          AND b.month_key > a.origin_month - INTERVAL 24 MONTH AND b.month_key <= a.origin_month
        GROUP BY ALL) w USING (source_dataset, series_id, origin_month)
  LEFT JOIN px l0 ON l0.source_dataset = o.source_dataset AND l0.series_id = o.series_id AND l0.month_key = o.origin_month
  LEFT JOIN px l1 ON l1.source_dataset = o.source_dataset AND l1.series_id = o.series_id
    AND l1.month_key = o.origin_month - INTERVAL 1 MONTH
  LEFT JOIN px l3 ON l3.source_dataset = o.source_dataset AND l3.series_id = o.series_id
    AND l3.month_key = o.origin_month - INTERVAL 3 MONTH
  LEFT JOIN px l12 ON l12.source_dataset = o.source_dataset AND l12.series_id = o.series_id
    AND l12.month_key = o.origin_month - INTERVAL 12 MONTH
""")
cte("labeled_origins", "px", """
  SELECT a.source_dataset, a.series_id, h.h, a.month_key AS past_origin, b.month_key AS past_target
  FROM px a CROSS JOIN (VALUES (1), (3)) h(h)
  JOIN px b ON b.source_dataset = a.source_dataset AND b.series_id = a.series_id
    AND b.month_key = a.month_key + to_months(h.h)
  WHERE a.price IS NOT NULL AND b.price IS NOT NULL AND a.month_key >= DATE '1996-01-01'
""")
cte("targets", "series_origins px labeled_origins", """
  SELECT o.source_dataset, o.series_id, o.origin_month, o.issue_at_utc, o.split_name, o.evaluation_mode,
    h.h AS horizon_months, CAST(o.origin_month + to_months(h.h) AS DATE) AS target_month,
    f.price AS target_usd_per_kg, f.cap AS target_capture_id,
    CAST((SELECT count(*) FROM labeled_origins p WHERE p.source_dataset = o.source_dataset
          AND p.series_id = o.series_id AND p.h = h.h AND p.past_origin < o.origin_month
          AND p.past_target <= o.origin_month) AS INTEGER) AS labeled_training_origins
  FROM series_origins o CROSS JOIN (VALUES (1), (3)) h(h)
  LEFT JOIN px f ON f.source_dataset = o.source_dataset AND f.series_id = o.series_id
    AND f.month_key = o.origin_month + to_months(h.h)
""")
cte("runs", "px", """
  SELECT source_dataset, series_id, month_key, CAST(price AS DOUBLE) AS y,
         mi - row_number() OVER (PARTITION BY source_dataset, series_id ORDER BY month_key) AS island
  FROM (SELECT *, year(month_key) * 12 + month(month_key) - 1 AS mi FROM px
        WHERE price IS NOT NULL AND month_key >= DATE '1995-01-01')
""")
cte("fits", "runs", """
  SELECT source_dataset, series_id, month_key, CAST(run_length AS INTEGER) AS run_length,
         run_length >= 24 AND sxx > 1e-9 AS fit_ok,
         CASE WHEN run_length >= 24 AND sxx > 1e-9 THEN slope END AS slope,
         CASE WHEN run_length >= 24 AND sxx > 1e-9 THEN intercept END AS intercept
  FROM (
    SELECT a.source_dataset, a.series_id, a.month_key, count(b.y) AS run_length, regr_sxx(b.y, b.x) AS sxx,
           regr_slope(b.y, b.x) AS slope, regr_intercept(b.y, b.x) AS intercept
    FROM runs a
    JOIN (SELECT *, lag(y) OVER (PARTITION BY source_dataset, series_id, island ORDER BY month_key) AS x FROM runs) b
      ON b.source_dataset = a.source_dataset AND b.series_id = a.series_id AND b.island = a.island
      AND b.month_key <= a.month_key
    GROUP BY ALL)
""")
cte("scored", "features targets px fits", """
  SELECT *, abs(prediction - actual) AS absolute_error, (prediction - actual) ** 2 AS squared_error,
    CASE WHEN abs(prediction) + abs(actual) = 0 THEN 0
         ELSE 100 * abs(prediction - actual) / ((abs(prediction) + abs(actual)) / 2) END AS smape_percent
  FROM (
    SELECT t.source_dataset, t.series_id, t.origin_month, t.target_month, t.issue_at_utc, t.split_name,
      t.evaluation_mode, t.horizon_months, m.model_name, m.ord, t.labeled_training_origins,
      CASE WHEN NOT ok THEN 'insufficient_history'
           WHEN m.ord = 1 AND s.price IS NULL THEN 'missing_seasonal_input'
           WHEN m.ord = 2 AND NOT coalesce(g.fit_ok, false) THEN 'failed_fit' ELSE 'ok' END AS fit_status,
      f.lag_0_capture_id AS origin_capture_id,
      CASE WHEN m.ord = 1 THEN CAST(t.target_month - INTERVAL 12 MONTH AS DATE) END AS seasonal_input_month,
      CASE WHEN m.ord = 1 THEN s.cap END AS seasonal_input_capture_id,
      CASE WHEN visible THEN t.target_capture_id END AS target_capture_id,
      CASE WHEN NOT ok THEN NULL WHEN m.ord = 0 THEN CAST(f.lag_0_usd_per_kg AS DOUBLE)
           WHEN m.ord = 1 THEN CAST(s.price AS DOUBLE)
           WHEN t.horizon_months = 1 THEN g.intercept + g.slope * CAST(f.lag_0_usd_per_kg AS DOUBLE)
           ELSE g.intercept + g.slope * (g.intercept + g.slope * (g.intercept + g.slope
                * CAST(f.lag_0_usd_per_kg AS DOUBLE))) END AS prediction,
      CASE WHEN visible THEN CAST(t.target_usd_per_kg AS DOUBLE) END AS actual
    FROM (SELECT *, split_name = 'holdout' OR target_month < DATE '2000-01-01' AS visible
          FROM targets WHERE split_name <> 'training') t
    JOIN (SELECT * FROM features) f USING (source_dataset, series_id, origin_month)
    CROSS JOIN (VALUES ('persistence', 0), ('seasonal_naive', 1), ('ar1', 2)) m(model_name, ord)
    CROSS JOIN LATERAL (SELECT f.has_minimum_history AND t.labeled_training_origins >= 12 AS ok)
    LEFT JOIN px s ON s.source_dataset = t.source_dataset AND s.series_id = t.series_id
      AND s.month_key = t.target_month - INTERVAL 12 MONTH
    LEFT JOIN fits g ON g.source_dataset = t.source_dataset AND g.series_id = t.series_id
      AND g.month_key = least(t.origin_month, DATE '1999-12-01'))
""")
cte("calibrated", "scored", """
  SELECT r.*, coalesce(k.n, 0) AS calibration_count,
    CASE WHEN k.n >= 12 THEN r.prediction - k.errors[CAST(least(k.n, ceil((k.n + 1) * 0.9)) AS BIGINT)] END AS interval_lower,
    CASE WHEN k.n >= 12 THEN r.prediction + k.errors[CAST(least(k.n, ceil((k.n + 1) * 0.9)) AS BIGINT)] END AS interval_upper
  FROM scored r
  LEFT JOIN (
    SELECT a.source_dataset, a.series_id, a.horizon_months, a.model_name, a.origin_month,
           count(*) AS n, list_sort(list(b.absolute_error)) AS errors
    FROM scored a JOIN scored b
      ON b.source_dataset = a.source_dataset AND b.series_id = a.series_id AND b.model_name = a.model_name
      AND b.horizon_months = a.horizon_months AND b.split_name = 'development' AND b.origin_month < a.origin_month
      AND b.target_month <= CASE a.split_name WHEN 'holdout' THEN DATE '1999-12-01' ELSE a.origin_month END
    WHERE a.prediction IS NOT NULL AND b.absolute_error IS NOT NULL GROUP BY ALL) k
    USING (source_dataset, series_id, horizon_months, model_name, origin_month)
""")
cte("in_development", "calibrated", """
  SELECT * FROM calibrated WHERE split_name = 'development' AND target_month <= DATE '1999-12-01'
""")
cte("selection", "in_development", """
  SELECT source_dataset, series_id, horizon_months, arg_min(model_name, (mae, ord)) AS selected_model,
         min(mae) AS development_mae, min(n) AS common_origins
  FROM (
    SELECT d.source_dataset, d.series_id, d.horizon_months, d.model_name, d.ord, avg(d.absolute_error) AS mae,
           count(*) AS n, count(d.absolute_error) AS got
    FROM in_development d
    WHERE EXISTS (SELECT 1 FROM in_development p WHERE p.source_dataset = d.source_dataset
                  AND p.series_id = d.series_id AND p.horizon_months = d.horizon_months
                  AND p.origin_month = d.origin_month AND p.ord = 0 AND p.absolute_error IS NOT NULL)
    GROUP BY ALL)
  WHERE got = n GROUP BY ALL
""")
cte("score_table", "calibrated selection", """
  SELECT 'check' AS run_id, c.source_dataset, c.series_id, c.split_name, c.horizon_months, c.model_name,
    coalesce(s.selected_model = c.model_name, false) AS is_selected, count(*) AS origin_count,
    count(prediction) AS prediction_count, count(absolute_error) AS scored_count,
    count(*) - count(actual) AS missing_target_count,
    count(CASE WHEN fit_status = 'failed_fit' THEN 1 END) AS failed_fit_count,
    avg(absolute_error) AS mae, sqrt(avg(squared_error)) AS rmse, avg(smape_percent) AS smape_percent,
    count(CASE WHEN absolute_error IS NOT NULL THEN interval_lower END) AS interval_scored_count,
    avg(CASE WHEN absolute_error IS NOT NULL AND interval_lower IS NOT NULL
        THEN CASE WHEN actual >= interval_lower AND actual <= interval_upper THEN 1.0 ELSE 0.0 END END) AS interval_coverage,
    avg(CASE WHEN absolute_error IS NOT NULL THEN interval_upper - interval_lower END) AS mean_interval_width
  FROM calibrated c LEFT JOIN selection s USING (source_dataset, series_id, horizon_months)
  WHERE c.split_name = 'holdout' OR c.target_month <= DATE '1999-12-01'
  GROUP BY ALL
""")

# --- final statements ------------------------------------------------------------------

ORACLES: dict[str, str] = {}


def oracle(name: str, needs: str, final: str) -> None:
    ORACLES[name] = sql(needs, final)


def rounded(table: str, *columns: str) -> str:
    """All columns of a fragment, the named ones rounded to nine digits."""
    if not columns:
        return f"SELECT * FROM {table}"
    changes = ", ".join(f"round({c}, 9) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changes}) FROM {table}"


oracle("stg_trade", "staged", rounded("staged"))
oracle("stg_prices", "prices", rounded("prices"))
oracle("trade_pivot", "pivoted", rounded("pivoted"))
oracle("dim_calendar", "", """
  SELECT CAST(d AS DATE) AS month_key, year(d) AS calendar_year, quarter(d) AS calendar_quarter,
         month(d) AS calendar_month, strftime(d, '%Y-%m') AS month_label
  FROM (SELECT unnest(generate_series(date_trunc('month', min(l_shipdate)), date_trunc('month', max(l_shipdate)),
                                      INTERVAL 1 MONTH)) AS d FROM lineitem)
""")
oracle("dim_product_years", "products", rounded("products"))
oracle("dim_partner", "partners", rounded("partners"))
oracle("dim_commodity", "products", """
  SELECT k AS commodity_key, n AS commodity_name
  FROM (VALUES ('grain', 'Grain'), ('metal', 'Metal'), ('wood', 'Wood')) t(k, n)
  WHERE k IN (SELECT commodity_key FROM products)
""")
oracle("fct_trade", "facts", rounded("facts"))
oracle("fct_prices", "price_facts", rounded("price_facts"))
oracle("price_changes", "changes", rounded("changes"))
oracle("price_index", "dynamics", rounded("dynamics"))
oracle("product_metrics", "metrics", rounded("metrics"))
oracle("flow_balance", "balances", rounded("balances"))
oracle("partner_shares", "shares", rounded("shares"))
oracle("top_partner", "shares", """
  SELECT source_dataset, reporter_code, month_key, product_group, flow_code, partner_code, partner_label,
         partner_value_eur, named_partner_denominator_eur,
         named_partner_value_share,
         (SELECT count(*) FROM shares o WHERE o.reporter_code = s.reporter_code AND o.month_key = s.month_key
          AND o.product_group IS NOT DISTINCT FROM s.product_group AND o.flow_code = s.flow_code) AS named_partner_count
  FROM shares s WHERE named_partner_rank = 1
""")
oracle("partner_concentration", "concentration", rounded("concentration", "named_partner_hhi"))
oracle("split_manifest", "series_origins", rounded("series_origins"))
oracle("origin_features", "features", rounded("features"))
oracle("forecast_targets", "targets", rounded("targets"))
oracle("history_runs", "fits", "SELECT source_dataset, series_id, month_key, run_length FROM fits")
oracle("ar1_fits", "fits", rounded("fits", "slope", "intercept"))
FITTED = {
    "prediction": "prediction_usd_per_kg", "absolute_error": "absolute_error", "squared_error": "squared_error",
    "smape_percent": "smape_percent", "interval_lower": "interval_lower", "interval_upper": "interval_upper",
}
oracle("forecast_predictions", "calibrated", f"""
  SELECT 'check' AS run_id, * EXCLUDE (ord, actual, {', '.join(FITTED)}), actual AS target_usd_per_kg,
    {', '.join(f"CASE model_name WHEN 'ar1' THEN round({c}, 6) ELSE {c} END AS {n}" for c, n in FITTED.items())},
    actual >= interval_lower AND actual <= interval_upper AS interval_covered
  FROM calibrated
""")
oracle("forecast_selection", "selection", rounded("selection", "development_mae"))
oracle("forecast_selection_gaps", "series_origins selection", """
  SELECT source_dataset, series_id, h AS horizon_months
  FROM (SELECT DISTINCT source_dataset, series_id FROM series_origins) CROSS JOIN (VALUES (1), (3)) t(h)
  EXCEPT SELECT source_dataset, series_id, horizon_months FROM selection
""")
oracle("forecast_metrics", "score_table",
       rounded("score_table", "mae", "rmse", "smape_percent", "interval_coverage", "mean_interval_width"))

# --- ingest ----------------------------------------------------------------------------

cte("sheet_cells", "prices", """
  SELECT k.source_dataset, k.period_month, s.name AS series_id, p.price_usd_per_kg AS price,
         p.period_month IS NOT NULL AS present, k.mi
  FROM (SELECT DISTINCT source_dataset || '/' || split_part(series_id, '/', 2) AS source_dataset, period_month,
               year(period_month) * 12 + month(period_month) - 1 AS mi FROM prices) k
  CROSS JOIN (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) s(name)
  LEFT JOIN prices p ON p.source_dataset || '/' || split_part(p.series_id, '/', 2) = k.source_dataset
    AND split_part(p.series_id, '/', 1) = s.name AND p.period_month = k.period_month
""")
oracle("wide_ingest", "sheet_cells", """
  SELECT source_dataset, series_id, period_month,
    CASE WHEN NOT present THEN NULL WHEN price IS NULL THEN CASE mi % 2 WHEN 0 THEN '..' ELSE ' n.a. ' END
         ELSE CAST(price AS VARCHAR) || '5' END AS source_value_text,
    price AS price_usd_per_kg, 'sheet-' || source_dataset AS source_capture_id, CAST(NULL AS VARCHAR) AS source_status
  FROM sheet_cells WHERE period_month BETWEEN DATE '1995-03-01' AND DATE '2001-06-01'
""")
oracle("ingest_violations", "sheet_cells", """
  WITH sheet_rows AS (
    SELECT DISTINCT source_dataset, period_month, mi, year(period_month) AS y,
      CASE WHEN mi % 17 = 3 THEN year(period_month) || 'M13'
           ELSE strftime(period_month, '%YM%m') END AS period_text,
      CASE mi % 29 WHEN 6 THEN 2 ELSE 1 END AS copies,
      mi % 17 = 3 AS bad_period,
      CASE WHEN mi % 17 <> 3 AND period_month >= DATE '1995-03-01' AND period_month <= DATE '2001-06-01'
        THEN (mi % 19 = 4)::INT + (mi % 23 = 5)::INT + (mi % 31 = 7)::INT + (mi % 37 = 8)::INT ELSE 0 END AS bad_cells
    FROM sheet_cells),
  found AS (
    SELECT source_dataset, period_text, 'bad_period' AS rule, sum(copies) AS n FROM sheet_rows WHERE bad_period GROUP BY ALL
    UNION ALL
    SELECT source_dataset, period_text, 'duplicate_period', copies FROM sheet_rows WHERE NOT bad_period AND copies > 1
    UNION ALL
    SELECT source_dataset, period_text, 'bad_number', bad_cells * copies FROM sheet_rows WHERE bad_cells > 0)
  SELECT source_dataset, 'sheet-' || source_dataset AS source_capture_id, period_text, rule,
         CAST(n AS BIGINT) AS occurrences FROM found
""")
oracle("price_coverage", "prices", """
  SELECT source_dataset, series_id, CAST(80 AS BIGINT) AS requested_month_count,
         count(DISTINCT period_month) AS represented_month_count,
         80 - count(DISTINCT period_month) AS missing_month_count,
         count(*) - count(price_usd_per_kg) AS null_price_count,
         max(CASE WHEN price_usd_per_kg IS NOT NULL THEN period_month END) AS latest_observed
  FROM prices GROUP BY ALL
""")
cte("decodable", "cells", """
  SELECT * FROM cells WHERE source_value IS NOT NULL OR source_status IS NOT NULL
""")
oracle("cube_decode", "decodable", "SELECT * EXCLUDE (source_capture_id) FROM decodable")
oracle("cube_scope_violations", "cells", """
  SELECT reporter_code || '-' || strftime(period_month, '%Y-%m') AS document_id, rule
  FROM (SELECT DISTINCT reporter_code, period_month, year(period_month) * 12 + month(period_month) - 1 AS mi FROM cells)
  CROSS JOIN (VALUES ('not_requested'), ('unexpected_flow_scope')) r(rule)
  WHERE CASE rule WHEN 'not_requested' THEN mi % 9 = 0 ELSE mi % 9 <> 0 AND mi % 10 = 1 END
""")
oracle("cell_stats", "cells", """
  SELECT source_capture_id, count(*) AS represented_cell_count, count(source_value) AS value_cell_count,
    count(source_status) AS status_cell_count, count(CASE WHEN source_value = 0 THEN 1 END) AS explicit_zero_count,
    max(status_available) AS status_available,
    min(CASE WHEN source_value IS NOT NULL THEN period_month END) AS first_observed_month,
    max(CASE WHEN source_value IS NOT NULL THEN period_month END) AS last_observed_month
  FROM cells GROUP BY source_capture_id
""")
cte("coverage_rows", "cells", """
  SELECT source_dataset, reporter_code, partner_code, product_code, flow_code,
    max(period_month) FILTER (source_value IS NOT NULL AND indicator_code = 'VALUE_IN_EUROS') AS last_value_month,
    max(period_month) FILTER (source_value IS NOT NULL AND indicator_code = 'QUANTITY_IN_100KG') AS last_quantity_month,
    max(period_month) FILTER (source_value IS NOT NULL AND paired) AS last_paired_month
  FROM (SELECT *, count(source_value) OVER (PARTITION BY reporter_code, partner_code, product_code, flow_code,
                                            period_month) = 2 AS paired FROM cells)
  GROUP BY ALL
""")
oracle("series_coverage", "coverage_rows", rounded("coverage_rows"))
oracle("key_conflicts", "cells", """
  SELECT source_dataset, frequency_code, reporter_code, partner_code, product_code, flow_code, indicator_code,
         period_month, CAST(2 AS BIGINT) AS row_count,
         CASE product_code WHEN 'Brand#1' THEN 'duplicate' ELSE 'conflicting' END AS kind
  FROM cells WHERE product_code IN ('Brand#1', 'Brand#2')
    AND (year(period_month) * 12 + month(period_month) - 1) % 13 = 0
""")
oracle("mixed_updates", "cells", """
  SELECT source_dataset, '2002-01-15T11:00:00+0000' AS first_update_time, '2002-02-15T11:00:00+0000' AS last_update_time
  FROM cells GROUP BY source_dataset
  HAVING bool_or(period_month >= DATE '2000-01-01') AND bool_or(period_month < DATE '2000-01-01')
""")

# --- revision --------------------------------------------------------------------------

cte("scoped", "cells", """
  SELECT *, (period_month BETWEEN DATE '1997-01-01' AND DATE '1997-06-01' AND flow_code = '1'
             AND reporter_code IN ('RA', 'RN'))
         OR (period_month BETWEEN DATE '1999-03-01' AND DATE '1999-04-01' AND reporter_code = 'RR'
             AND product_code IN ('Brand#3', 'Brand#4', 'Brand#12')) AS hit,
         (CAST(split_part(product_code, '#', 2) AS INTEGER) + year(period_month) * 12 + month(period_month) - 1) % 7 <> 0
           AS survives
  FROM cells
""")
cte("replaced", "scoped", """
  SELECT * EXCLUDE (hit, survives) FROM scoped WHERE NOT hit
  UNION ALL
  SELECT * EXCLUDE (hit, survives) REPLACE (
    CAST(source_value * 1.1 AS DECIMAL(24,4)) AS source_value,
    CAST(CAST(source_value * 1.1 AS DECIMAL(24,4)) AS VARCHAR) AS source_value_text,
    source_capture_id || '-b' AS source_capture_id, '2002-02-15T11:00:00+0000' AS source_update_time)
  FROM scoped WHERE hit AND survives
""")
oracle("scope_replace", "replaced", rounded("replaced"))
oracle("scope_untouched", "scoped", """
  SELECT version, count(*) AS row_count, CAST(sum(source_value) AS DECIMAL(38,4)) AS value_sum
  FROM scoped CROSS JOIN (VALUES ('before'), ('after')) v(version) WHERE NOT hit GROUP BY version
""")
oracle("refresh_equal", "replaced", """
  SELECT CAST(0 AS BIGINT) AS only_stepwise, CAST(0 AS BIGINT) AS only_rebuilt, count(*) AS rebuilt_rows FROM replaced
""")
oracle("restored_vintage", "replaced cells", """
  SELECT CAST(0 AS BIGINT) AS rows_still_different,
    (SELECT count(*) FROM (SELECT * FROM cells EXCEPT ALL SELECT * FROM replaced))
    + (SELECT count(*) FROM (SELECT * FROM replaced EXCEPT ALL SELECT * FROM cells)) AS rows_replaced
""")
oracle("selection_complete", "amounts", """
  WITH held AS (SELECT DISTINCT reporter_code, product_code, year(period_month) AS y FROM amounts
                WHERE product_code IN ('Brand#3', 'Brand#4')),
  covering AS (
    SELECT c.reporter_code, CAST(m AS DATE) AS period_month, c.product_code, count(*) AS n
    FROM (SELECT * FROM held UNION ALL SELECT * FROM held WHERE reporter_code = 'RN' AND y = 1998) c
    JOIN (SELECT unnest(generate_series(DATE '1997-05-01', DATE '1998-02-01', INTERVAL 1 MONTH)) AS m) t ON year(m) = c.y
    GROUP BY ALL)
  SELECT r AS reporter_code, '1' AS flow_code, CAST(m AS DATE) AS period_month, p AS product_code,
         coalesce(n, 0) AS covering_slices, CAST(1 AS BIGINT) AS requests,
         CASE WHEN n IS NULL THEN 'missing' ELSE 'overlapping' END AS problem
  FROM (SELECT unnest(generate_series(DATE '1997-05-01', DATE '1998-02-01', INTERVAL 1 MONTH)) AS m)
  CROSS JOIN (VALUES ('Brand#3'), ('Brand#4'), ('Brand#99')) q(p)
  CROSS JOIN (VALUES ('RA'), ('RN'), ('RR')) s(r)
  LEFT JOIN covering ON covering.period_month = CAST(m AS DATE) AND covering.product_code = p AND covering.reporter_code = r
  WHERE coalesce(n, 0) <> 1
""")
def replacement(name: str, hit: str, needs: str = "cells") -> None:
    """A fragment with the cells after a later version replaced the rows for which a condition holds."""
    cte(name, needs, f"""
  SELECT * EXCLUDE (hit, survives) FROM (
    SELECT *, ({hit}) AS hit,
      (CAST(split_part(product_code, '#', 2) AS INTEGER) + year(period_month) * 12 + month(period_month) - 1) % 7 <> 0 AS survives
    FROM cells) WHERE NOT hit
  UNION ALL
  SELECT * EXCLUDE (hit, survives) REPLACE (
    CAST(source_value * 1.1 AS DECIMAL(24,4)) AS source_value,
    CAST(CAST(source_value * 1.1 AS DECIMAL(24,4)) AS VARCHAR) AS source_value_text,
    source_capture_id || '-b' AS source_capture_id, '2002-02-15T11:00:00+0000' AS source_update_time)
  FROM (
    SELECT *, ({hit}) AS hit,
      (CAST(split_part(product_code, '#', 2) AS INTEGER) + year(period_month) * 12 + month(period_month) - 1) % 7 <> 0 AS survives
    FROM cells) WHERE hit AND survives
""")


replacement("replaced_by_table", """
  period_month = DATE '1998-07-01' OR (month(period_month) BETWEEN 2 AND 5
    AND (CAST(split_part(product_code, '#', 2) AS INTEGER) + year(period_month) + length(partner_code)) % 5 = 0)
""")
oracle("scope_table_replace", "replaced_by_table", rounded("replaced_by_table"))
cte("leaves", "mapping", """
  SELECT DISTINCT 'RA' AS reporter_code, product_code, CAST(m AS DATE) AS period_month, flow_code
  FROM mapping CROSS JOIN (SELECT unnest(generate_series(DATE '1997-05-01', DATE '1999-02-01', INTERVAL 1 MONTH)) AS m)
  CROSS JOIN (VALUES ('1')) f(flow_code)
  WHERE product_group IN ('grain_3', 'grain_4') AND year(m) BETWEEN valid_from_year AND valid_to_year
  UNION ALL
  SELECT DISTINCT 'RN', product_code, CAST(m AS DATE), flow_code
  FROM (SELECT product_code FROM mapping WHERE product_group = 'metal_7' AND valid_from_year <= 1996
        UNION ALL SELECT 'Brand#16' UNION ALL SELECT 'Brand#99')
  CROSS JOIN (SELECT unnest(generate_series(DATE '1996-11-01', DATE '1997-01-01', INTERVAL 1 MONTH)) AS m)
  CROSS JOIN (VALUES ('1'), ('2')) f(flow_code)
""")
replacement("replaced_by_selection", """
  EXISTS (SELECT 1 FROM leaves l WHERE l.reporter_code = cells.reporter_code AND l.product_code = cells.product_code
          AND l.period_month = cells.period_month AND l.flow_code = cells.flow_code)
""", "cells leaves")
oracle("selection_replace", "replaced_by_selection", rounded("replaced_by_selection"))
oracle("selection_gaps_by_group", "leaves amounts", """
  WITH held AS (SELECT DISTINCT reporter_code, product_code, year(period_month) AS y FROM amounts),
  counted AS (
    SELECT l.reporter_code, l.flow_code, l.period_month, l.product_code,
      CAST(CASE WHEN h.y IS NULL THEN 0 WHEN l.reporter_code = 'RN' AND h.y = 1996 THEN 2 ELSE 1 END AS BIGINT) AS covering_slices
    FROM leaves l LEFT JOIN held h ON h.reporter_code = l.reporter_code AND h.product_code = l.product_code AND h.y = year(l.period_month))
  SELECT *, CAST(1 AS BIGINT) AS requests, CASE covering_slices WHEN 0 THEN 'missing' ELSE 'overlapping' END AS problem
  FROM counted WHERE covering_slices <> 1
""")
cte("asked_prices", "prices", """
  SELECT *, CAST(series_id[1] AS INTEGER) % 2 = 0 AND period_month BETWEEN DATE '1996-03-01' AND DATE '1997-04-01' AS hit FROM prices
""")
oracle("price_selection_replace", "asked_prices", """
  SELECT * EXCLUDE (hit) FROM asked_prices WHERE NOT hit
  UNION ALL
  SELECT * EXCLUDE (hit) REPLACE (CAST(price_usd_per_kg * 2 AS DECIMAL(20,8)) AS price_usd_per_kg)
  FROM asked_prices WHERE hit AND month(period_month) BETWEEN 3 AND 10
""")
oracle("marts_after_replacement", "scoped replaced", """
  SELECT t AS table_name, CAST(0 AS BIGINT) AS differing_rows,
    (SELECT count(*) FROM replaced WHERE (reporter_code, period_month) IN (SELECT (reporter_code, period_month) FROM scoped WHERE hit))
      AS cells_read,
    (SELECT count(*) FROM replaced) AS cells_of_full_build
  FROM (VALUES ('monthly_product_metrics'), ('monthly_trade_balances'), ('monthly_partner_shares'),
               ('monthly_partner_concentration')) v(t)
""")
oracle("file_drift", "cells", """
  SELECT 'monthly_trade' AS table_name, problem, column_name, declared_type, found_type,
    CAST((SELECT count(*) FROM cells WHERE year(period_month) BETWEEN a AND b) AS BIGINT) AS affected_rows
  FROM (VALUES ('absent', 'source_status', 'string', NULL, 1997, 1997), ('undocumented', 'note', NULL, 'string', 1998, 1998),
               ('wrong_type', 'source_value', 'decimal(24,4)', 'double', 1999, 9999))
    v(problem, column_name, declared_type, found_type, a, b)
""")
oracle("pinned_generations", "cells replaced", """
  SELECT generation, reporter_code, count(*) AS row_count, CAST(sum(source_value) AS DECIMAL(38,4)) AS value_sum
  FROM (SELECT CAST(1 AS BIGINT) AS generation, reporter_code, source_value FROM cells
        UNION ALL SELECT 2, reporter_code, source_value FROM replaced) GROUP BY ALL
""")
cte("price_ranges", "prices", """
  SELECT source_dataset, series_id, min(period_month) AS start_month, max(period_month) AS end_month
  FROM prices GROUP BY source_dataset, series_id, year(period_month)
""")
oracle("backfill_gaps", "price_ranges", """
  SELECT s.source_dataset, s.series_id, CAST(m AS DATE) AS period_month
  FROM (SELECT DISTINCT source_dataset, series_id FROM price_ranges) s
  CROSS JOIN (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m)
  WHERE NOT EXISTS (SELECT 1 FROM price_ranges r WHERE r.source_dataset = s.source_dataset
                    AND r.series_id = s.series_id AND CAST(m AS DATE) BETWEEN r.start_month AND r.end_month)
""")
oracle("backfill_ranges", "price_ranges", """
  SELECT source_dataset, series_id, greatest(start_month, DATE '1996-03-01') AS start_month,
         least(end_month, DATE '2000-10-01') AS end_month
  FROM price_ranges WHERE end_month >= DATE '1996-03-01' AND start_month <= DATE '2000-10-01'
""")
oracle("table_replace", "replaced", rounded("replaced"))

# --- captures --------------------------------------------------------------------------

cte("events_seen", "", """
  SELECT 'orders_' || o_orderstatus || '-' || year(o_orderdate) AS source_capture_id, quarter(o_orderdate) AS q,
         CAST(max(o_orderdate) AS DATE) AS last_day
  FROM orders GROUP BY ALL
""")
cte("registry", "events_seen", """
  SELECT source_capture_id, 'Updated on ' || strftime(max(last_day), '%B %-d, %Y') AS source_update_text,
         max(last_day) AS source_update_date,
         strftime(max(last_day) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS retrieved_at_utc,
         strftime(min(last_day) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS first_seen_capture_at_utc
  FROM events_seen GROUP BY source_capture_id
""")
oracle("capture_registry", "registry", rounded("registry"))
oracle("selection_history", "events_seen", """
  SELECT 'prices' AS dataset, source_capture_id,
    strftime(min(last_day) + INTERVAL 4 DAY, '%Y-%m-%d %H:%M:%S') AS first_selected_at_utc,
    strftime(min(last_day) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS first_seen_capture_at_utc,
    count(*) + count(CASE WHEN year(last_day + INTERVAL 1 DAY) >= 1999 THEN 1 END) AS selection_count
  FROM events_seen GROUP BY source_capture_id
""")
oracle("latest_selection", "events_seen", """
  SELECT CASE WHEN late THEN 'after-1998' ELSE 'until-1998' END AS run_id, CAST(CASE WHEN late AND early THEN 1 ELSE 0 END AS BIGINT) AS sequence
  FROM (SELECT bool_or(year(last_day + INTERVAL 1 DAY) > 1998) AS late,
               bool_or(year(last_day + INTERVAL 1 DAY) <= 1998) AS early FROM events_seen)
""")
oracle("capture_lineage", "features targets", """
  SELECT DISTINCT capture_id FROM (
    SELECT unnest([lag_0_capture_id, lag_1_capture_id, lag_3_capture_id, lag_12_capture_id]) AS capture_id FROM features
    UNION ALL SELECT target_capture_id FROM targets)
  WHERE capture_id LIKE '%-1997'
""")
cte("provenance_rows", "price_facts registry", """
  SELECT f.source_capture_id, 'prices' AS dataset, f.fact_count, r.source_update_text, r.retrieved_at_utc,
         r.first_seen_capture_at_utc, r.source_capture_id IS NOT NULL AS resolved
  FROM (SELECT source_capture_id, count(*) AS fact_count FROM price_facts GROUP BY ALL) f
  LEFT JOIN (SELECT * FROM registry WHERE source_capture_id NOT LIKE '%-1997') r USING (source_capture_id)
""")
oracle("provenance", "provenance_rows", rounded("provenance_rows"))
oracle("source_versions", "price_facts registry", """
  SELECT 'prices' AS dataset, count(*) AS capture_count,
         string_agg(source_capture_id, ',' ORDER BY source_capture_id) AS source_capture_ids,
         count(DISTINCT source_update_text) AS update_count, min(retrieved_at_utc) AS first_retrieved_at_utc,
         max(retrieved_at_utc) AS last_retrieved_at_utc
  FROM registry WHERE source_capture_id IN (SELECT source_capture_id FROM price_facts)
""")
oracle("freshness_prices", "prices", """
  SELECT source_dataset, series_id, latest_observed, date_diff('month', latest_observed, DATE '2002-01-01')
    AS observed_age_months
  FROM (SELECT source_dataset, series_id, max(CASE WHEN price_usd_per_kg IS NOT NULL THEN period_month END)
          AS latest_observed FROM prices GROUP BY ALL)
""")
oracle("freshness_trade", "coverage_rows", """
  WITH requested AS (
    SELECT r.reporter_code, p.partner_code, b.product_code, f.flow_code, x.last_paired_month AS m,
      CASE WHEN p.partner_code = 'WORLD' THEN 'world' WHEN p.partner_code = 'BLOC_3' THEN 'aggregate'
           WHEN p.partner_code IN ('NATION_22', 'NATION_23', 'NATION_24') THEN 'special' ELSE 'detail' END AS layer
    FROM (SELECT DISTINCT 'R' || l_returnflag AS reporter_code FROM lineitem) r
    CROSS JOIN (SELECT n_name AS partner_code FROM nation
                UNION ALL VALUES ('WORLD'), ('BLOC_3'), ('NATION_ABSENT')) p
    CROSS JOIN (SELECT DISTINCT p_brand AS product_code FROM part) b
    CROSS JOIN (VALUES ('1'), ('2')) f(flow_code)
    LEFT JOIN coverage_rows x ON x.reporter_code = r.reporter_code AND x.partner_code = p.partner_code
      AND x.product_code = b.product_code AND x.flow_code = f.flow_code)
  SELECT 'driver_trade' AS source_dataset, reporter_code, product_code, flow_code, layer,
    count(*) AS requested_series, count(m) AS series_with_paired_observations, max(m) AS latest_paired_month,
    min(m) AS oldest_series_latest_month,
    count(CASE WHEN m = newest THEN 1 END) AS series_at_latest_month,
    date_diff('month', max(m), DATE '2002-01-01') AS observed_age_months
  FROM (SELECT *, max(m) OVER (PARTITION BY reporter_code, product_code, flow_code, layer) AS newest FROM requested)
  GROUP BY ALL
""")

# --- data quality ----------------------------------------------------------------------

FACT_COLUMNS = (
    "month_key source_dataset frequency_code reporter_code partner_code partner_label partner_class "
    "is_partner_detail product_code product_group classification_code classification_year "
    "comparability_segment flow_code flow_name value_basis trade_value_eur net_mass_kg unit_value_eur_per_kg "
    "value_cell_present has_numeric_value value_status value_status_available quantity_cell_present "
    "has_numeric_mass quantity_status quantity_status_available has_paired_measures source_capture_id "
    "source_update_time trade_observation_key trade_product_key trade_partner_key commodity_key"
).split()
oracle("dq_not_null", "facts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS violations FROM facts" for c in FACT_COLUMNS
))
oracle("dq_unique", "products", """
  SELECT product_code, count(*) AS row_count FROM products GROUP BY product_code HAVING count(*) > 1
  UNION ALL SELECT trade_product_key, count(*) FROM products GROUP BY trade_product_key HAVING count(*) > 1
""")
oracle("dq_unique_observations", "staged", """
  SELECT source_dataset, frequency_code, reporter_code, partner_code, product_code, flow_code, indicator_code,
         period_month, count(*) AS row_count
  FROM staged GROUP BY ALL HAVING count(*) > 1
""")
oracle("dq_unique_prices", "prices", """
  SELECT source_dataset, series_id, period_month, CAST(2 AS BIGINT) AS row_count FROM prices
  WHERE month(period_month) = 6
""")
oracle("dq_accepted", "staged", """
  SELECT 'source_status' AS column_name, source_status AS value, count(*) AS violations
  FROM staged WHERE source_status NOT IN ('u', 'p') GROUP BY ALL
""")
oracle("dq_relationships", "facts products", """
  SELECT trade_product_key AS key, count(*) AS violations FROM facts
  WHERE trade_product_key NOT IN (SELECT trade_product_key FROM products) GROUP BY ALL
""")
oracle("dq_staging_semantics", "staged", """
  SELECT check_name, CAST((SELECT count(*) FROM staged WHERE CASE check_name
      WHEN 'normalized_presence' THEN (source_value IS NULL) <> (normalized_value IS NULL)
      WHEN 'value_units' THEN indicator_code = 'VALUE_IN_EUROS' AND (source_unit <> 'EUR' OR normalized_unit <> 'EUR')
      WHEN 'value_normalization' THEN indicator_code = 'VALUE_IN_EUROS' AND normalized_value <> source_value
      WHEN 'mass_units' THEN indicator_code = 'QUANTITY_IN_100KG' AND (source_unit <> '100kg' OR normalized_unit <> 'kg')
      WHEN 'mass_normalization' THEN indicator_code = 'QUANTITY_IN_100KG' AND normalized_value <> source_value * 100
      WHEN 'partner_class' THEN (partner_class = 'aggregate') = is_partner_detail
      ELSE NOT status_available AND source_status IS NOT NULL END) AS BIGINT) AS violations
  FROM (VALUES ('normalized_presence'), ('value_units'), ('value_normalization'), ('mass_units'),
               ('mass_normalization'), ('partner_class'), ('status_without_field')) t(check_name)
""")
oracle("dq_scope_break", "facts", """
  SELECT count(*) AS violations FROM facts WHERE product_code = 'Brand#8'
    AND comparability_segment <> CASE WHEN year(month_key) < 1998 THEN '1995-1997' ELSE '1998-2001' END
""")
oracle("dq_mapping_shape", "mapping", """
  SELECT count(*) AS leaf_count, min(valid_from_year) AS first_year, max(valid_to_year) AS last_year
  FROM mapping HAVING count(*) <> 25 OR min(valid_from_year) <> 1995 OR max(valid_to_year) <> 2001
""")
oracle("dq_preservation", "facts staged products partners", """
  SELECT s.*, f.*, j.*
  FROM (SELECT count(DISTINCT concat_ws('|', source_dataset, reporter_code, partner_code, product_code, flow_code,
                                        period_month)) AS expected_fact_count,
               CAST(sum(CASE indicator_code WHEN 'VALUE_IN_EUROS' THEN source_value END) AS DECIMAL(38,4)) AS staged_value_eur,
               CAST(sum(CASE indicator_code WHEN 'QUANTITY_IN_100KG' THEN normalized_value END) AS DECIMAL(38,4)) AS staged_mass_kg
        FROM staged) s,
       (SELECT count(*) AS fact_count, CAST(sum(trade_value_eur) AS DECIMAL(38,4)) AS fact_value_eur,
               CAST(sum(net_mass_kg) AS DECIMAL(38,4)) AS fact_mass_kg FROM facts) f,
       (SELECT count(*) AS joined_count, CAST(sum(trade_value_eur) AS DECIMAL(38,4)) AS joined_value_eur,
               CAST(sum(net_mass_kg) AS DECIMAL(38,4)) AS joined_mass_kg
        FROM facts JOIN products USING (trade_product_key) JOIN partners USING (trade_partner_key)) j
""")
oracle("dq_metric_invariants", "facts shares metrics balances concentration", """
  SELECT 'unit_value_without_mass' AS check_name, count(*) AS violations FROM facts
    WHERE net_mass_kg <= 0 AND unit_value_eur_per_kg IS NOT NULL
  UNION ALL SELECT 'unit_value_wrong', count(*) FROM facts WHERE net_mass_kg > 0 AND trade_value_eur IS NOT NULL
    AND abs(unit_value_eur_per_kg - trade_value_eur / net_mass_kg) > 1e-12
  UNION ALL SELECT 'named_shares_sum', count(*) FROM (
    SELECT sum(named_partner_value_share) AS t FROM shares WHERE has_positive_named_denominator
    GROUP BY source_dataset, reporter_code, month_key, product_group, flow_code) WHERE abs(t - 1) > 1e-12
  UNION ALL SELECT 'product_shares_sum', count(*) FROM (
    SELECT sum(observed_product_value_share) AS t FROM metrics WHERE observed_product_mix_denominator_eur > 0
    GROUP BY source_dataset, reporter_code, month_key, flow_code) WHERE abs(t - 1) > 1e-12
  UNION ALL SELECT 'balance_gate', count(*) FROM balances
    WHERE CASE WHEN has_compatible_flow_coverage THEN trade_balance_eur <> export_value_fob_eur - import_value_cif_eur
               ELSE trade_balance_eur IS NOT NULL END
  UNION ALL SELECT 'hhi_without_denominator', count(*) FROM concentration
    WHERE NOT has_positive_named_denominator AND named_partner_hhi IS NOT NULL
  UNION ALL SELECT 'hhi_out_of_range', count(*) FROM concentration WHERE NOT named_partner_hhi BETWEEN 0 AND 1
""")
oracle("dq_forecast_datasets", "series_origins features targets", """
  SELECT 'split_name' AS check_name, count(*) AS violations FROM series_origins
    WHERE split_name <> CASE WHEN year(origin_month) < 1998 THEN 'training' WHEN year(origin_month) < 2000
                             THEN 'development' ELSE 'holdout' END
  UNION ALL SELECT 'evaluation_mode', count(*) FROM series_origins WHERE evaluation_mode <> 'retrospective_current_vintage'
  UNION ALL SELECT 'gates', count(*) FROM series_origins
    WHERE minimum_observed_history_months <> 24 OR minimum_labeled_training_origins <> 12
  UNION ALL SELECT 'issue_time', count(*) FROM series_origins
    WHERE CAST(issue_at_utc AS TIMESTAMP) <> origin_month + INTERVAL 1 MONTH
  UNION ALL SELECT 'lag_month', count(*) FROM features WHERE date_diff('month', lag_0_month, origin_month) <> 0
    OR date_diff('month', lag_1_month, origin_month) <> 1 OR date_diff('month', lag_3_month, origin_month) <> 3
    OR date_diff('month', lag_12_month, origin_month) <> 12
  UNION ALL SELECT 'history_gate', count(*) FROM features
    WHERE has_minimum_history <> (observed_history_months_24 = 24)
  UNION ALL SELECT 'history_length', count(*) FROM features WHERE observed_history_months_24 > 24
  UNION ALL SELECT 'horizon', count(*) FROM targets WHERE horizon_months NOT IN (1, 3)
  UNION ALL SELECT 'target_month', count(*) FROM targets
    WHERE date_diff('month', origin_month, target_month) <> horizon_months OR target_month <= origin_month
  UNION ALL SELECT 'labeled_origins', count(*) FROM targets WHERE labeled_training_origins < 0
""")
oracle("dq_forecast_results", "calibrated score_table", """
  SELECT 'prediction_key' AS check_name, count(*) AS violations FROM (
    SELECT 1 FROM calibrated GROUP BY source_dataset, series_id, origin_month, horizon_months, model_name
    HAVING count(*) > 1)
  UNION ALL SELECT 'metric_key', count(*) FROM (
    SELECT 1 FROM score_table GROUP BY source_dataset, series_id, split_name, horizon_months, model_name HAVING count(*) > 1)
  UNION ALL SELECT 'bad_interval', count(*) FROM calibrated
    WHERE interval_lower > interval_upper OR (interval_lower IS NULL) <> (interval_upper IS NULL)
  UNION ALL SELECT 'bad_counts', count(*) FROM score_table WHERE scored_count > prediction_count
    OR prediction_count > origin_count OR interval_scored_count > scored_count
  UNION ALL SELECT 'selection_count', count(*) FROM (
    SELECT 1 FROM score_table WHERE split_name = 'development' GROUP BY source_dataset, series_id, horizon_months
    HAVING count(CASE WHEN is_selected THEN 1 END) <> 1)
  UNION ALL SELECT 'summary_counts', CAST(0 AS BIGINT)
""")

# --- metadata and presentation ---------------------------------------------------------

METRIC_ROWS = (
    ("benchmark_index", "dynamics", "monthly_benchmark_dynamics", "benchmark_index"),
    ("benchmark_monthly_change_percent", "dynamics", "monthly_benchmark_dynamics", "change_percent"),
    ("named_partner_hhi", "concentration", "monthly_partner_concentration", "named_partner_hhi"),
    ("named_partner_value_share", "shares", "monthly_partner_shares", "named_partner_value_share"),
    ("observed_product_value_share", "metrics", "monthly_trade_product_metrics", "observed_product_value_share"),
    ("observed_trade_unit_value_eur_per_kg", "metrics", "monthly_trade_product_metrics",
     "observed_unit_value_eur_per_kg"),
    ("reconciliation_residual_eur", "concentration", "monthly_partner_concentration", "reconciliation_residual_eur"),
    ("trade_balance_eur", "balances", "monthly_trade_balances", "trade_balance_eur"),
)


def metric_texts(metric: str) -> str:
    """Published unit, denominator and coverage of a metric: fixed texts that the contract holds."""
    [texts] = [row[3:] for row in METRICS if row[0] == metric]
    return ", ".join(
        "'" + text.replace("'", "''") + f"' AS {name}"
        for text, name in zip(texts, ("metric_unit", "denominator", "coverage"), strict=True)
    )


oracle("metric_dictionary", "dynamics concentration shares metrics balances", "\nUNION ALL\n".join(
    f"SELECT '{metric}' AS metric_name, '{table}' AS model_name, '{column}' AS metric_expression, "
    f"{metric_texts(metric)}, count({column}) AS published_rows, count(*) AS table_rows FROM {fragment}"
    for metric, fragment, table, column in METRIC_ROWS
))
cte("ranges", "dynamics", """
  SELECT source_dataset, benchmark_series, min(month_key) AS first_period, max(month_key) AS latest_requested_period,
         max(CASE WHEN price_usd_per_kg IS NOT NULL THEN month_key END) AS latest_observed_period,
         count(price_usd_per_kg) AS observed_months
  FROM dynamics GROUP BY ALL
""")
oracle("observed_ranges", "ranges", rounded("ranges"))
oracle("partial_series", "ranges", """
  SELECT * FROM ranges WHERE latest_observed_period IS NULL OR latest_observed_period < latest_requested_period
""")
oracle("price_rows", "dynamics", """
  SELECT month_key, source_dataset, benchmark_series, price_usd_per_kg, source_capture_id FROM dynamics
""")
cte("mix_rows", "metrics", """
  SELECT source_dataset, reporter_code, month_key, product_group, flow_name, world_value_eur, world_net_mass_kg,
    observed_unit_value_eur_per_kg, observed_product_value_share, observed_value_product_count,
    expected_product_count, has_complete_value_coverage, has_complete_product_mix_universe
  FROM metrics WHERE observed_product_value_share IS NOT NULL
""")
oracle("product_mix_rows", "mix_rows", rounded("mix_rows"))
oracle("mix_completeness", "mix_rows", """
  SELECT source_dataset, reporter_code, count(*) AS mix_rows,
         count(CASE WHEN NOT has_complete_product_mix_universe THEN 1 END) AS incomplete_mix_rows
  FROM mix_rows GROUP BY ALL
""")
oracle("valid_balances", "balances", """
  SELECT source_dataset, reporter_code, month_key, product_group, import_value_cif_eur, export_value_fob_eur,
         has_compatible_flow_coverage, trade_balance_eur
  FROM balances WHERE trade_balance_eur IS NOT NULL
""")
oracle("balance_validity", "balances", """
  SELECT source_dataset, reporter_code, count(*) AS balance_rows, count(trade_balance_eur) AS valid_balance_rows
  FROM balances GROUP BY ALL
""")
oracle("named_concentration", "concentration", """
  SELECT source_dataset, reporter_code, month_key, product_group, flow_name, named_partner_count,
    named_partner_value_eur, largest_named_partner_share, round(named_partner_hhi, 9) AS named_partner_hhi,
    observed_special_value_eur, world_value_eur, reconciliation_residual_eur, reconciliation_status
  FROM concentration WHERE named_partner_count > 0
""")
oracle("score_rows", "score_table", """
  SELECT source_dataset, series_id, split_name, horizon_months, model_name, is_selected, origin_count,
    prediction_count, scored_count, round(mae, 9) AS mae, round(rmse, 9) AS rmse,
    round(smape_percent, 9) AS smape_percent, interval_scored_count,
    round(interval_coverage, 9) AS interval_coverage, round(mean_interval_width, 9) AS mean_interval_width
  FROM score_table
""")
oracle("run_identity", "targets", """
  SELECT 'check' AS run_id, evaluation_mode,
    min(CASE split_name WHEN 'holdout' THEN origin_month END) AS first_holdout_origin,
    max(CASE split_name WHEN 'holdout' THEN origin_month END) AS last_holdout_origin,
    min(CASE split_name WHEN 'holdout' THEN target_month END) AS first_holdout_target,
    max(CASE split_name WHEN 'holdout' THEN target_month END) AS last_holdout_target
  FROM targets WHERE split_name <> 'training' GROUP BY evaluation_mode
""")
