"""The results of ``queries`` as DuckDB SQL over the raw tables.

Written in another shape than the Spark plans where possible: series are densified through a
calendar grid, codes come from window ranks, medians and percentiles from built-ins.
"""

from __future__ import annotations


def _figures(name: str, columns: str) -> str:
    pairs = [
        f"'{c}=' || " + (f"CAST({c} AS VARCHAR)" if c.startswith(("times_", "spikes_")) else f"printf('%.2f', {c})")
        for c in columns.split()
    ]
    return f"'{name} (' || " + " || ', ' || ".join(pairs) + " || ')'"


def _evidence() -> str:
    rules = {
        1: _figures("recurrent", "times_exceeded_500 spikes_same_weekday"),
        2: _figures("sustained", "prior_28d_mean post_7d_mean"),
        3: _figures("above both sides", "spike_vs_prior_max prior_28d_max spike_vs_post_mean post_7d_mean"),
        4: _figures("gone at once", "spike_vs_prior_mean prior_28d_mean post_7d_mean"),
        5: _figures("elevated", "prior_28d_max post_7d_max"),
    }
    signals = {
        "raw_price_base < 1.0": _figures("low price", "raw_price_base"),
        "raw_sum_total <= 0": _figures("no revenue", "raw_sum_total"),
        "target > 3000 AND times_exceeded_1000 = 1": _figures("only peak", "times_exceeded_1000"),
        "price_change <> 0 AND abs(price_change) > price * 0.5": _figures("price jump", "price_change"),
    }
    parts = ["CASE rule " + " ".join(f"WHEN {k} THEN {text}" for k, text in rules.items()) + " END"]
    return ", ".join(parts + [f"CASE WHEN {test} THEN {text} END" for test, text in signals.items()])


_COMMON = """
sales AS (
  SELECT date, store_id, item_id,
         CASE WHEN item_id = 'Brand#7' THEN l_quantity * 100
              WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN -l_quantity
              ELSE l_quantity END AS quantity,
         CASE WHEN item_id = 'Brand#7' THEN CAST(0.01 AS DOUBLE)
              WHEN l_orderkey % 97 = 0 THEN -p_retailprice
              ELSE p_retailprice END AS price_base,
         l_extendedprice * (1 - l_discount) AS sum_total
  FROM (SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey % 4 AS INT) + 1 AS store_id,
               CASE WHEN p_brand IN ('Brand#7', 'Brand#13') AND CAST(l_shipdate AS DATE) < DATE '2001-07-01'
                    THEN p_brand || '/old' ELSE p_brand END AS item_id,
               l_quantity, l_extendedprice, l_discount, l_returnflag, l_linenumber, l_orderkey, p_retailprice
        FROM lineitem JOIN part ON l_partkey = p_partkey) b),
catalog AS (
  SELECT CASE WHEN p_brand = 'Brand#7' THEN 'Brand#7/old' ELSE p_brand END AS item_id, p_partkey AS row_order,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS dept_name,
         concat(p_type, '-', CAST(p_size % 5 AS VARCHAR)) AS class_name,
         concat('S', CAST(p_size % 10 AS VARCHAR)) AS subclass_name,
         split_part(p_name, ' ', 2) AS item_type,
         CASE WHEN p_partkey % 10 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS weight_volume,
         CAST(p_size * 2 AS VARCHAR) AS weight_netto,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size % 4 AS VARCHAR) END AS fatness
  FROM part),
price_history AS (
  SELECT p_brand AS item_id, DATE '1999-07-01' AS date, p_retailprice AS price
  FROM part),
discounts_history AS (
  SELECT DISTINCT CASE WHEN p_brand = 'Brand#7' THEN 'Brand#7/old' ELSE p_brand END
                  || CASE WHEN p_size > 45 THEN '' ELSE '/plain' END AS item_id FROM part),
medians AS (
  SELECT store_id, item_id, median(price_base) AS med
  FROM sales WHERE price_base > 0 GROUP BY store_id, item_id),
clean AS (
  SELECT s.date, s.store_id, s.item_id, s.quantity,
         CASE WHEN s.price_base < 0 THEN m.med ELSE s.price_base END AS price_base, s.sum_total
  FROM sales s LEFT JOIN medians m ON s.store_id = m.store_id AND s.item_id = m.item_id),
daily AS MATERIALIZED (
  SELECT date, store_id, item_id, coalesce(sum(quantity), 0) AS daily_demand,
         avg(price_base) AS price
  FROM clean WHERE date IS NOT NULL AND store_id IS NOT NULL AND item_id IS NOT NULL
  GROUP BY date, store_id, item_id),
bounds AS (
  SELECT store_id, item_id, min(date) AS first_date, max(date) AS last_date
  FROM daily GROUP BY store_id, item_id),
grid AS (
  SELECT store_id, item_id,
         CAST(unnest(generate_series(first_date, last_date, INTERVAL 1 DAY)) AS DATE) AS date
  FROM bounds),
prepared AS MATERIALIZED (
  SELECT g.date, g.store_id, g.item_id,
         CASE WHEN coalesce(d.daily_demand, 0) < 0 THEN 0.0
              ELSE CAST(coalesce(d.daily_demand, 0) AS DOUBLE) END AS daily_demand,
         last_value(d.price IGNORE NULLS) OVER (
           PARTITION BY g.store_id, g.item_id ORDER BY g.date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
  FROM grid g LEFT JOIN daily d
    ON g.date = d.date AND g.store_id = d.store_id AND g.item_id = d.item_id),
lagged AS (
  SELECT *, lead(daily_demand) OVER w AS target, lag(daily_demand) OVER w AS lag_1,
         lag(daily_demand, 7) OVER w AS lag_7, lag(daily_demand, 14) OVER w AS lag_14,
         lag(daily_demand, 28) OVER w AS lag_28, price - lag(price) OVER w AS price_change
  FROM prepared WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date)),
rolled AS (
  SELECT date, store_id, item_id, daily_demand,
         CASE WHEN count(*) OVER w7 = 7 THEN avg(daily_demand) OVER w7 END AS rolling_mean_7,
         CASE WHEN count(*) OVER w14 = 14 THEN avg(daily_demand) OVER w14 END AS rolling_mean_14,
         CASE WHEN count(*) OVER w28 = 28 THEN avg(daily_demand) OVER w28 END AS rolling_mean_28,
         CASE WHEN count(*) OVER w7 = 7 THEN stddev_samp(daily_demand) OVER w7 END AS rolling_std_7,
         CASE WHEN count(*) OVER w28 = 28 THEN stddev_samp(daily_demand) OVER w28 END AS rolling_std_28
  FROM prepared
  WINDOW w7 AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w14 AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING),
         w28 AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
first_rows AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY row_order) AS rn FROM catalog) c
  WHERE rn = 1),
codes AS (
  SELECT item_id,
         CAST(CASE WHEN dept_name IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY dept_name NULLS LAST) - 1 END AS INT) AS dept_code,
         CAST(CASE WHEN class_name IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY class_name NULLS LAST) - 1 END AS INT) AS class_code,
         CAST(CASE WHEN subclass_name IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY subclass_name NULLS LAST) - 1 END AS INT) AS subclass_code,
         CAST(CASE WHEN item_type IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY item_type NULLS LAST) - 1 END AS INT) AS item_type_code,
         TRY_CAST(weight_volume AS DOUBLE) AS weight_volume,
         TRY_CAST(weight_netto AS DOUBLE) AS weight_netto,
         TRY_CAST(fatness AS DOUBLE) AS fatness
  FROM first_rows),
items AS (
  SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INT) AS item_code
  FROM (SELECT DISTINCT item_id FROM daily) d),
features AS (
  SELECT l.date, l.item_id, l.price, l.lag_1, l.lag_7, l.lag_14, l.lag_28,
         r.rolling_mean_7, r.rolling_mean_14, r.rolling_mean_28, r.rolling_std_7, r.rolling_std_28,
         l.price_change,
         CAST(isodow(l.date) - 1 AS INT) AS day_of_week, CAST(day(l.date) AS INT) AS day_of_month,
         CAST(month(l.date) AS INT) AS month, CAST(week(l.date) AS INT) AS week_of_year,
         CAST(CASE WHEN isodow(l.date) >= 6 THEN 1 ELSE 0 END AS INT) AS is_weekend,
         l.store_id, coalesce(i.item_code, -1) AS item_code,
         c.dept_code, c.class_code, c.subclass_code, c.item_type_code,
         c.weight_volume, c.weight_netto, c.fatness, l.target
  FROM lagged l
  JOIN rolled r ON r.date = l.date AND r.store_id = l.store_id AND r.item_id = l.item_id
  LEFT JOIN items i ON i.item_id = l.item_id
  LEFT JOIN codes c ON c.item_id = l.item_id
  WHERE l.target IS NOT NULL),
all_scored AS (
  SELECT *, predicted - target AS error, abs(predicted - target) AS abs_error,
         (predicted - target) * (predicted - target) AS squared_error,
         CASE WHEN date BETWEEN DATE '1995-01-01' AND DATE '2001-01-31' THEN 'train'
              WHEN date BETWEEN DATE '2001-02-01' AND DATE '2001-05-31' THEN 'validation'
              WHEN date BETWEEN DATE '2001-06-01' AND DATE '2001-12-31' THEN 'test'
              ELSE 'outside' END AS split,
         CASE WHEN target = 0 THEN 'demand = 0'
              WHEN target >= 1 AND target <= 5 THEN 'demand 1-5'
              WHEN target >= 6 AND target <= 20 THEN 'demand 6-20'
              WHEN target >= 21 AND target <= 100 THEN 'demand 21-100'
              WHEN target > 100 THEN 'demand > 100'
              ELSE 'unbucketed' END AS demand_range
  FROM (SELECT *, coalesce(rolling_mean_7, lag_1, 0) AS predicted FROM features) f),
scored AS (SELECT * FROM all_scored WHERE split = 'test'),
cases AS (
  SELECT CAST(row_number() OVER (ORDER BY abs_error DESC, date, store_id, item_id) AS INT) AS rank,
         CAST(date + 1 AS DATE) AS target_date, *
  FROM scored QUALIFY row_number() OVER (ORDER BY abs_error DESC, date, store_id, item_id) <= 30),
context AS (
  SELECT c.rank,
         coalesce(avg(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date - 28 AND c.target_date - 1), 0) AS prior_28d_mean,
         coalesce(median(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date - 28 AND c.target_date - 1), 0) AS prior_28d_median,
         coalesce(max(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date - 28 AND c.target_date - 1), 0) AS prior_28d_max,
         coalesce(stddev_samp(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date - 28 AND c.target_date - 1), 0) AS prior_28d_std,
         count(*) FILTER (WHERE h.date BETWEEN c.target_date - 28 AND c.target_date - 1 AND h.daily_demand = 0) AS prior_28d_zeros,
         coalesce(string_agg(CAST(CAST(round(h.daily_demand, 6) AS DECIMAL(28, 6)) AS VARCHAR), ',' ORDER BY h.date) FILTER (WHERE h.date BETWEEN c.target_date - 28 AND c.target_date - 1), '') AS prior_28d_series,
         coalesce(avg(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date + 1 AND c.target_date + 7), 0) AS post_7d_mean,
         coalesce(median(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date + 1 AND c.target_date + 7), 0) AS post_7d_median,
         coalesce(max(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date + 1 AND c.target_date + 7), 0) AS post_7d_max,
         coalesce(stddev_samp(h.daily_demand) FILTER (WHERE h.date BETWEEN c.target_date + 1 AND c.target_date + 7), 0) AS post_7d_std,
         count(*) FILTER (WHERE h.date BETWEEN c.target_date + 1 AND c.target_date + 7 AND h.daily_demand = 0) AS post_7d_zeros,
         coalesce(string_agg(CAST(CAST(round(h.daily_demand, 6) AS DECIMAL(28, 6)) AS VARCHAR), ',' ORDER BY h.date) FILTER (WHERE h.date BETWEEN c.target_date + 1 AND c.target_date + 7), '') AS post_7d_series,
         max(h.daily_demand) AS hist_max_all_time,
         count(*) FILTER (WHERE h.daily_demand >= 100) AS times_exceeded_100,
         count(*) FILTER (WHERE h.daily_demand >= 500) AS times_exceeded_500,
         count(*) FILTER (WHERE h.daily_demand >= 1000) AS times_exceeded_1000,
         count(*) FILTER (WHERE h.daily_demand >= 100 AND isodow(h.date) = isodow(c.target_date)) AS spikes_same_weekday
  FROM cases c JOIN prepared h ON h.store_id = c.store_id AND h.item_id = c.item_id
  GROUP BY c.rank),
raw_match AS (
  SELECT c.rank, count(*) AS raw_rows, sum(s.quantity) AS raw_sales_qty,
         avg(s.price_base) AS raw_price_base, sum(s.sum_total) AS raw_sum_total
  FROM cases c JOIN sales s
    ON s.date = c.target_date AND s.store_id = c.store_id AND s.item_id = c.item_id
  GROUP BY c.rank),
ratios AS (
  SELECT c.*, x.* EXCLUDE (rank), m.* EXCLUDE (rank), f.dept_name, f.class_name, f.subclass_name,
         c.target / greatest(x.prior_28d_mean, 0.01) AS spike_vs_prior_mean,
         c.target / greatest(x.prior_28d_max, 0.01) AS spike_vs_prior_max,
         c.target / greatest(x.post_7d_mean, 0.01) AS spike_vs_post_mean
  FROM cases c LEFT JOIN context x ON x.rank = c.rank LEFT JOIN raw_match m ON m.rank = c.rank
  LEFT JOIN first_rows f ON f.item_id = c.item_id),
ruled AS (
  SELECT *, CASE WHEN times_exceeded_500 >= 3 AND spikes_same_weekday >= 2 THEN 1
                 WHEN post_7d_mean > 0.5 * target OR (prior_28d_mean > 0.3 * target AND post_7d_mean > 0.3 * target) THEN 2
                 WHEN spike_vs_prior_max > 5 AND spike_vs_post_mean > 5 THEN 3
                 WHEN spike_vs_prior_mean > 10 AND post_7d_mean < 0.2 * target THEN 4
                 ELSE 5 END AS rule
  FROM ratios),
investigated AS (
  SELECT *,
         CASE rule WHEN 1 THEN 'Repeated on particular days / recurrent spikes'
                   WHEN 2 THEN 'Part of a sustained increase'
                   WHEN 3 THEN 'Sudden and isolated' WHEN 4 THEN 'Sudden and isolated'
                   ELSE 'Sudden spike with elevated surrounding activity' END AS classification,
         concat_ws('; ', @EVIDENCE@) AS evidence
  FROM ruled),
training_items AS (
  SELECT DISTINCT item_id FROM prepared WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-01-31'),
reaggregated AS (
  SELECT date, store_id, item_id, count(quantity) AS raw_tx_count, count(*) AS raw_rows,
         sum(quantity) AS raw_quantity_sum, avg(price_base) AS raw_price_mean, sum(sum_total) AS raw_sum_total
  FROM sales GROUP BY date, store_id, item_id),
daily_diff AS (
  SELECT coalesce(r.date, d.date) AS date, coalesce(r.store_id, d.store_id) AS store_id,
         coalesce(r.item_id, d.item_id) AS item_id, raw_tx_count, raw_rows, raw_quantity_sum,
         raw_price_mean, raw_sum_total, daily_demand, price,
         coalesce(raw_quantity_sum - daily_demand, 0) AS qty_diff,
         coalesce(raw_price_mean - price, 0) AS price_diff,
         d.date IS NULL AS only_raw, r.date IS NULL AS only_daily
  FROM reaggregated r FULL JOIN daily d
    ON r.date = d.date AND r.store_id = d.store_id AND r.item_id = d.item_id),
prepared_diff AS (
  SELECT coalesce(d.date, p.date) AS date, coalesce(d.store_id, p.store_id) AS store_id,
         coalesce(d.item_id, p.item_id) AS item_id, d.daily_demand AS demand_daily,
         p.daily_demand AS demand_prepared, coalesce(d.daily_demand - p.daily_demand, 0) AS qty_diff,
         p.date IS NULL AS only_daily, d.date IS NULL AS only_prepared
  FROM daily d FULL JOIN prepared p
    ON d.date = p.date AND d.store_id = p.store_id AND d.item_id = p.item_id),
presence AS (
  SELECT i.item_id,
         (SELECT count(*) FROM catalog c WHERE c.item_id = i.item_id) AS catalog_rows,
         (SELECT count(*) FROM price_history c WHERE c.item_id = i.item_id) AS price_history_rows,
         (SELECT min(date) FROM price_history c WHERE c.item_id = i.item_id) AS price_first_date,
         (SELECT max(date) FROM price_history c WHERE c.item_id = i.item_id) AS price_last_date,
         (SELECT count(DISTINCT price) FROM price_history c WHERE c.item_id = i.item_id) AS price_points,
         (SELECT count(*) FROM discounts_history c WHERE c.item_id = i.item_id) AS discounts_history_rows
  FROM (SELECT DISTINCT item_id FROM sales) i),
granularity AS (
  SELECT item_id, min(tx) AS min_tx, max(tx) AS max_tx, avg(tx) AS mean_tx, bool_and(tx = 1) AS already_daily
  FROM (SELECT item_id, date, store_id, count(*) AS tx FROM sales GROUP BY item_id, date, store_id) t
  GROUP BY item_id),
arithmetic AS (
  SELECT *, quantity * price_base AS expected_sum, abs(sum_total - quantity * price_base) AS abs_diff,
         CASE WHEN quantity > 0 THEN sum_total / quantity END AS effective_unit_price
  FROM sales),
statistics AS (
  SELECT item_id, count(*) AS tx_rows, min(date) AS first_date, max(date) AS last_date,
         count(DISTINCT date) AS distinct_dates, count(DISTINCT store_id) AS distinct_stores,
         count(DISTINCT price_base) AS distinct_prices, sum(quantity) AS qty_sum,
         min(quantity) AS qty_min, max(quantity) AS qty_max, avg(quantity) AS qty_mean,
         median(quantity) AS qty_median, stddev_samp(quantity) AS qty_std,
         min(price_base) AS price_min, max(price_base) AS price_max, avg(price_base) AS price_mean,
         sum(sum_total) AS total_sum, min(sum_total) AS total_min, max(sum_total) AS total_max,
         avg(sum_total) AS total_mean, max(abs_diff) AS max_arithmetic_diff,
         avg(abs_diff) AS mean_arithmetic_diff, min(effective_unit_price) AS min_unit_price,
         max(effective_unit_price) AS max_unit_price, avg(effective_unit_price) AS mean_unit_price,
         max(abs_diff) < 0.05 AS arithmetic_ok
  FROM arithmetic GROUP BY item_id),
raw_vs_daily AS (
  SELECT item_id, CAST(coalesce(sum(raw_rows), 0) AS BIGINT) AS raw_rows,
         count(*) FILTER (WHERE NOT only_raw) AS daily_rows,
         max(abs(qty_diff)) > 1e-4 AS qty_discrepancy, max(abs(price_diff)) > 1e-4 AS price_discrepancy,
         count(*) FILTER (WHERE only_raw) AS only_raw, count(*) FILTER (WHERE only_daily) AS only_daily,
         coalesce(sum(raw_rows), 0) = count(*) FILTER (WHERE NOT only_raw) AS row_parity
  FROM daily_diff GROUP BY item_id),
daily_vs_prepared AS (
  SELECT item_id, count(*) FILTER (WHERE NOT only_prepared) AS daily_rows,
         count(*) FILTER (WHERE NOT only_daily) AS prepared_rows,
         max(abs(qty_diff)) > 1e-4 AS qty_discrepancy,
         count(*) FILTER (WHERE only_daily) AS only_daily,
         count(*) FILTER (WHERE only_prepared) AS only_prepared,
         count(*) FILTER (WHERE NOT only_daily) - count(*) FILTER (WHERE NOT only_prepared) AS inserted_rows
  FROM prepared_diff GROUP BY item_id)
""".replace("@EVIDENCE@", _evidence())

_METRICS = """
  count(*) AS rows, avg(abs(predicted - target)) AS mae,
  sqrt(avg((predicted - target) * (predicted - target))) AS rmse,
  CASE WHEN count(*) > 1 AND var_pop(target) * count(*) > 1e-6
       THEN 1 - sum((predicted - target) * (predicted - target)) / (var_pop(target) * count(*)) END AS r2,
  sum(abs(predicted - target)) / nullif(sum(abs(target)), 0) * 100 AS wape,
  avg(target) AS mean_actual, avg(predicted) AS mean_pred, avg(predicted - target) AS bias,
  coalesce(sum((predicted - target) * (predicted - target)), 0) AS sse
"""
_METRIC_DIGITS = "mae rmse r2 wape mean_actual mean_pred bias sse:2"
_PERCENTS = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def _statement(body: str, doubles: str = "") -> str:
    """Prefix the shared views and round the named double columns (6 places unless given)."""
    if doubles:
        rounded = []
        for entry in doubles.split():
            name, _, places = entry.partition(":")
            rounded.append(f"round(CAST({name} AS DOUBLE), {places or 6}) + 0.0 AS {name}")
        body = f"SELECT * REPLACE ({', '.join(rounded)}) FROM ({body}) result"
    return f"WITH {_COMMON.strip()}\n{body}"


def _null_counts(columns: str) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in columns.split())


def _problem_counts() -> str:
    problems = {
        "negative_quantity": "quantity < 0",
        "zero_quantity": "quantity = 0",
        "negative_price": "price_base < 0",
        "zero_price": "price_base = 0",
        "negative_sum_total": "sum_total < 0",
    }
    return ", ".join(
        f"count(*) FILTER (WHERE {test}) AS {name}_count, "
        f"count(*) FILTER (WHERE {test}) * 100.0 / count(*) AS {name}_pct"
        for name, test in problems.items()
    )


def _preparation(group: str) -> str:
    columns = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    join = f"USING ({group})" if group else "ON TRUE"
    return f"""
      SELECT b.*, a.* {f'EXCLUDE ({group})' if group else ''}, prepared_rows - original_rows AS inserted_rows
      FROM (SELECT {columns} count(*) AS original_rows,
                   count(*) FILTER (WHERE daily_demand < 0) AS negative_demand_before
            FROM daily {by}) b
      JOIN (SELECT {columns} count(*) AS prepared_rows,
                   count(*) FILTER (WHERE daily_demand < 0) AS negative_demand_after,
                   count(*) FILTER (WHERE daily_demand IS NULL) AS null_demand,
                   count(*) FILTER (WHERE price IS NULL) AS null_prices,
                   count(*) - count(DISTINCT (date, store_id, item_id)) AS duplicate_keys,
                   count(DISTINCT item_id) AS unique_products, count(DISTINCT store_id) AS unique_stores,
                   min(date) AS min_date, max(date) AS max_date,
                   min(daily_demand) AS min_demand, max(daily_demand) AS max_demand
            FROM prepared {by}) a {join}"""


def _distribution_rows() -> str:
    pairs = {
        "mean": ("avg(target)", "avg(predicted)"),
        "std_dev": ("stddev_pop(target)", "stddev_pop(predicted)"),
        "min": ("min(target)", "min(predicted)"),
        "max": ("max(target)", "max(predicted)"),
        "zero_or_near_zero": (
            "count(*) FILTER (WHERE target = 0)",
            "count(*) FILTER (WHERE abs(predicted) < 0.5)",
        ),
        "zero_or_near_zero_pct": (
            "count(*) FILTER (WHERE target = 0) * 100.0 / count(*)",
            "count(*) FILTER (WHERE abs(predicted) < 0.5) * 100.0 / count(*)",
        ),
        "negative": ("count(*) FILTER (WHERE target < 0)", "count(*) FILTER (WHERE predicted < 0)"),
    }
    for p in (10, 25, 50, 75, 90, 95, 99):
        pairs[f"p{p}"] = (f"quantile_cont(target, {p / 100})", f"quantile_cont(predicted, {p / 100})")
    return " UNION ALL ".join(
        f"SELECT '{name}' AS statistic, CAST({a} AS DOUBLE) AS actual, CAST({p} AS DOUBLE) AS predicted FROM scored"
        for name, (a, p) in pairs.items()
    )


def _cohorts() -> str:
    cohorts = {
        "All Test Records (Baseline)": "TRUE",
        "Seen in Training (All)": "seen",
        "Unseen in Training (All Cold-Start)": "NOT seen",
        "Unseen in Training (Excl. Brand#7)": "NOT seen AND item_id <> 'Brand#7'",
        "Product Brand#7 Alone": "item_id = 'Brand#7'",
        "In First 28 Days (lag_28 is NaN)": "lag_28 IS NULL",
        "Mature History (lag_28 is Available)": "lag_28 IS NOT NULL",
        "Seen in Training & Mature (lag_28 Available)": "seen AND lag_28 IS NOT NULL",
        "Seen in Training & Incomplete (lag_28 is NaN)": "seen AND lag_28 IS NULL",
    }
    marked = "(SELECT *, item_id IN (SELECT item_id FROM training_items) AS seen FROM scored) m"
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS cohort, count(DISTINCT item_id) AS unique_products, {_METRICS} FROM {marked} WHERE {test}"
        for name, test in cohorts.items()
    )
    total = "greatest((SELECT sum(squared_error) FROM scored), 1e-6)"
    return f"SELECT *, sse / {total} * 100 AS sse_share_pct FROM ({parts}) c"


def _long_report() -> str:
    metrics = {
        ("presence", "presence"): "catalog_rows price_history_rows price_points discounts_history_rows "
        "catalog_rows>0:in_catalog price_history_rows>0:in_price_history discounts_history_rows>0:in_discounts_history",
        ("granularity", "granularity"): "min_tx max_tx mean_tx already_daily",
        ("statistics", "statistics"): "tx_rows distinct_dates distinct_stores distinct_prices qty_sum qty_min qty_max "
        "qty_mean qty_median qty_std price_min price_max price_mean total_sum total_min total_max total_mean "
        "max_arithmetic_diff mean_arithmetic_diff min_unit_price max_unit_price mean_unit_price arithmetic_ok",
        ("raw_vs_daily", "raw_vs_daily"): "raw_rows daily_rows qty_discrepancy price_discrepancy only_raw only_daily row_parity",
        ("daily_vs_prepared", "daily_vs_prepared"): "daily_rows prepared_rows qty_discrepancy only_daily only_prepared inserted_rows",
    }
    parts = []
    for (section, source), names in metrics.items():
        for entry in names.split():
            expression, _, name = entry.partition(":")
            parts.append(
                f"SELECT '{section}' AS section, item_id, '{name or expression}' AS metric, "
                f"CAST({expression} AS DOUBLE) AS value, NULL::VARCHAR AS text FROM {source}"
            )
    dates = {"presence": "price_first_date price_last_date", "statistics": "first_date last_date"}
    for source, names in dates.items():
        for name in names.split():
            parts.append(
                f"SELECT '{source}' AS section, item_id, '{name}' AS metric, NULL::DOUBLE AS value, "
                f"strftime({name}, '%Y-%m-%d') AS text FROM {source}"
            )
    return " UNION ALL ".join(parts)


def _cells(section: str, source: str, entry: str, numbers: str = "", dates: str = "", texts: str = "") -> list[str]:
    """Columns of a source as rows ``(section, entry, metric, value, text)``; ``a:b`` names expression a by b."""
    kinds = [
        (numbers, "CAST({0} AS DOUBLE)", "NULL::VARCHAR"),
        (dates, "NULL::DOUBLE", "strftime({0}, '%Y-%m-%d')"),
        (texts, "NULL::DOUBLE", "{0}"),
    ]
    return [
        f"SELECT '{section}' AS section, CAST({entry} AS VARCHAR) AS entry, '{name or expression}' AS metric, "
        f"{value.format(expression)} AS value, {text.format(expression)} AS text FROM {source}"
        for names, value, text in kinds
        for expression, _, name in (e.partition(":") for e in names.split())
    ]


def _investigation_report() -> str:
    summary = (
        "(SELECT count(*) AS total_rows, avg(abs_error) AS mae, sqrt(avg(squared_error)) AS rmse, "
        "sum(abs_error) / nullif(sum(abs(target)), 0) * 100 AS wape, sum(squared_error) AS total_sse FROM scored) a, "
        "(SELECT count(*) AS top_rows, sum(squared_error) AS top_sse, min(abs_error) AS top_min_abs_error, "
        "max(abs_error) AS top_max_abs_error, min(target) AS top_min_actual, max(target) AS top_max_actual, "
        "min(predicted) AS top_min_predicted, max(predicted) AS top_max_predicted FROM cases) b"
    )
    classes = (
        "(SELECT classification, count(*) AS cases, count(*) * 100.0 / (SELECT count(*) FROM investigated) AS pct "
        "FROM investigated GROUP BY classification) c"
    )
    parts = _cells(
        "summary", summary, "'test'",
        "total_rows mae rmse wape total_sse top_rows top_sse top_min_abs_error top_max_abs_error top_min_actual "
        "top_max_actual top_min_predicted top_max_predicted top_sse/total_sse*100:top_sse_share_pct",
    )
    parts += _cells("classification", classes, "classification", "cases pct")
    parts += _cells(
        "case", "investigated", "rank",
        "rank store_id target:actual_demand predicted:predicted_demand error:signed_error abs_error price price_change "
        "lag_1 lag_7 lag_14 lag_28 rolling_mean_7 rolling_mean_14 rolling_mean_28 rolling_std_7 rolling_std_28 "
        "prior_28d_mean prior_28d_median prior_28d_max prior_28d_std prior_28d_zeros post_7d_mean post_7d_median "
        "post_7d_max post_7d_std post_7d_zeros hist_max_all_time times_exceeded_100 times_exceeded_500 raw_rows "
        "raw_sales_qty raw_price_base raw_sum_total spike_vs_prior_mean spike_vs_prior_max",
        "date:feature_date target_date",
        "item_id dept_name class_name subclass_name classification evidence prior_28d_series post_7d_series",
    )
    return " UNION ALL ".join(parts)


def _cold_start_report() -> str:
    counts = (
        "(SELECT (SELECT count(*) FROM training_items) AS training_items, count(DISTINCT item_id) AS active_items, "
        "count(DISTINCT item_id) FILTER (WHERE item_id NOT IN (SELECT item_id FROM training_items)) AS unseen_items "
        "FROM scored) c"
    )
    unseen = (
        "(SELECT t.*, CASE WHEN f.item_id IS NULL THEN 'NOT IN CATALOG' ELSE f.dept_name END AS dept_name, "
        "CASE WHEN f.item_id IS NULL THEN 'NOT IN CATALOG' ELSE f.class_name END AS class_name "
        "FROM (SELECT item_id, count(*) AS test_rows, min(date) AS first_date, max(date) AS last_date, "
        "count(DISTINCT store_id) AS stores_count, sum(target) AS total_demand, avg(target) AS mean_actual, "
        "avg(predicted) AS mean_pred, avg(abs_error) AS mae, sqrt(avg(squared_error)) AS rmse, "
        "sum(abs_error) / greatest(sum(target), 1e-6) * 100 AS wape, "
        "count(*) FILTER (WHERE lag_28 IS NULL) * 100.0 / count(*) AS lag28_null_pct "
        "FROM scored WHERE item_id NOT IN (SELECT item_id FROM training_items) GROUP BY item_id) t "
        "LEFT JOIN first_rows f ON f.item_id = t.item_id) u"
    )
    parts = _cells("overview", counts, "'test'", "training_items active_items unseen_items")
    parts += _cells(
        "cohort", f"({_cohorts()}) m", "cohort",
        "rows unique_products mae rmse r2 wape mean_actual mean_pred bias sse sse_share_pct",
    )
    parts += _cells(
        "unseen_item", unseen, "item_id",
        "test_rows stores_count total_demand mean_actual mean_pred mae rmse wape lag28_null_pct",
        "first_date last_date", "dept_name class_name",
    )
    return " UNION ALL ".join(parts)


_FEATURE_DOUBLES = (
    "price lag_1 lag_7 lag_14 lag_28 rolling_mean_7 rolling_mean_14 rolling_mean_28 rolling_std_7 "
    "rolling_std_28 price_change weight_volume weight_netto fatness target"
)
_CASE_DOUBLES = (
    "actual_demand predicted_demand signed_error abs_error price price_change lag_1 lag_7 lag_14 lag_28 "
    "rolling_mean_7 rolling_mean_14 rolling_mean_28 rolling_std_7 rolling_std_28 prior_28d_mean prior_28d_median "
    "prior_28d_max prior_28d_std post_7d_mean post_7d_median post_7d_max post_7d_std hist_max_all_time "
    "raw_sales_qty raw_price_base raw_sum_total:4 spike_vs_prior_mean spike_vs_prior_max"
)


def statements() -> dict[str, str]:
    s = _statement
    demand_rows = "daily_demand price"
    result: dict[str, str] = {}

    # cleaning
    result["sales_audit"] = s(
        "SELECT count(*) AS total_records, FALSE AS has_index_column, "
        f"{_null_counts('date store_id item_id quantity price_base sum_total')}, {_problem_counts()} FROM sales",
        "negative_quantity_pct zero_quantity_pct negative_price_pct zero_price_pct negative_sum_total_pct",
    )
    result["null_counts"] = s(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM catalog"
            for c in (
                "item_id row_order dept_name class_name subclass_name item_type weight_volume weight_netto fatness"
            ).split()
        )
    )
    result["duplicate_rows"] = s(
        """SELECT count(*) AS total_records,
                  count(*) - count(DISTINCT (date, store_id, item_id, quantity, price_base, sum_total)) AS duplicate_records,
                  (count(*) - count(DISTINCT (date, store_id, item_id, quantity, price_base, sum_total))) * 100.0
                    / count(*) AS duplicate_pct
           FROM (SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE store_id = 2 AND quantity > 45) twice""",
        "duplicate_pct",
    )
    result["unmatched_prices"] = s(
        """SELECT date, store_id, 'Brand#1/bad' AS item_id, price_base AS old_price, 'no_positive_price' AS note
           FROM sales WHERE item_id = 'Brand#1' AND price_base < 0""",
        "old_price",
    )
    result["csv_sales_item"] = s("SELECT * FROM sales WHERE item_id = 'Brand#7'", "quantity price_base sum_total")
    kinds = {"date": "date", "store_id": "int", "item_id": "string", "quantity": "double", "price_base": "double", "sum_total": "double"}
    result["sales_column_types"] = s(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{k}' AS data_type, count({c}) AS values_found FROM sales" for c, k in kinds.items()
        )
    )
    result["gbt_train_score"] = s(
        """SELECT split, count(*) AS rows, sum(target) AS total_target, 0::BIGINT AS null_scores,
                  CASE WHEN split = 'train' THEN TRUE END AS beats_train_mean,
                  TRUE AS near_train_mean_or_better, TRUE AS rounds_ok
           FROM all_scored GROUP BY split""",
        "total_target:2",
    )
    result["price_correction"] = s("SELECT * FROM clean", "quantity price_base sum_total")
    result["sales_without_returns"] = s(
        "SELECT * FROM sales WHERE quantity >= 0", "quantity price_base sum_total"
    )
    result["price_correction_report"] = s(
        """SELECT count(*) AS total_negative_prices, count(med) AS imputed_count,
                  count(*) FILTER (WHERE med IS NULL) AS unmatched_count
           FROM sales s LEFT JOIN medians m ON s.store_id = m.store_id AND s.item_id = m.item_id
           WHERE price_base < 0"""
    )
    result["imputed_price_sample"] = s(
        """SELECT s.date, s.store_id, s.item_id, s.price_base AS old_price, m.med AS imputed_price
           FROM sales s JOIN medians m ON s.store_id = m.store_id AND s.item_id = m.item_id
           WHERE s.price_base < 0 ORDER BY 1, 2, 3, 4 LIMIT 5""",
        "old_price imputed_price",
    )
    result["lenient_parse"] = s(
        """SELECT l_orderkey, l_linenumber,
                  CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) AS parsed_date,
                  TRY_CAST(number_text AS DOUBLE) AS parsed_number,
                  CASE WHEN date_text <> 'not a date' THEN CAST(date_text AS DATE) END AS strict_date,
                  nullif(number_text, 'n/a') AS number_text
           FROM (SELECT l_orderkey, l_linenumber,
                        CASE WHEN l_orderkey % 50 = 0 THEN 'not a date'
                             WHEN l_orderkey % 53 = 0 THEN NULL
                             ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_text,
                        CASE WHEN l_orderkey % 31 = 0 THEN 'n/a'
                             WHEN l_orderkey % 37 = 0 THEN concat(CAST(l_quantity AS VARCHAR), 'kg')
                             ELSE CAST(l_quantity AS VARCHAR) END AS number_text
                 FROM lineitem) t""",
        "parsed_number",
    )

    # daily and prepared demand
    result["daily_demand"] = s("SELECT * FROM daily", demand_rows)
    result["daily_demand_from_clean"] = result["daily_demand"]
    result["daily_profile"] = s(
        f"""SELECT count(*) AS number_of_rows, count(DISTINCT item_id) AS unique_products,
                   count(DISTINCT store_id) AS unique_stores, min(date) AS min_date, max(date) AS max_date,
                   {_null_counts('date store_id item_id daily_demand price')},
                   count(*) - count(DISTINCT (date, store_id, item_id)) AS duplicate_combinations,
                   min(daily_demand) AS min_daily_demand, max(daily_demand) AS max_daily_demand,
                   avg(daily_demand) AS mean_daily_demand, median(daily_demand) AS median_daily_demand,
                   count(*) FILTER (WHERE daily_demand < 0) AS negative_daily_demand_count,
                   count(*) FILTER (WHERE daily_demand < 0) * 100.0 / count(*) AS negative_daily_demand_pct,
                   count(*) FILTER (WHERE daily_demand = 0) AS zero_daily_demand_count,
                   min(price) AS min_price, max(price) AS max_price, avg(price) AS mean_price,
                   count(*) FILTER (WHERE price < 0) AS negative_price_count
            FROM daily""",
        "min_daily_demand max_daily_demand mean_daily_demand median_daily_demand negative_daily_demand_pct "
        "min_price max_price mean_price",
    )
    result["market_trend"] = s(
        """SELECT date, total_demand,
                  avg(total_demand) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS trend
           FROM (SELECT date, sum(daily_demand) AS total_demand FROM daily GROUP BY date) d""",
        "total_demand trend",
    )
    result["series_bounds"] = s(
        "SELECT *, CAST(last_date - first_date + 1 AS INT) AS span_days FROM bounds"
    )
    result["prepared_demand"] = s("SELECT * FROM prepared", demand_rows)
    result["preparation_report"] = s(_preparation(""), "min_demand max_demand")
    result["preparation_by_store"] = s(_preparation("store_id"), "min_demand max_demand")
    roundtrip = """SELECT store_id, '{}' AS source, count(*) AS rows, sum(daily_demand) AS total_demand,
                          avg(price) AS mean_price, min(date) AS min_date, max(date) AS max_date
                   FROM prepared GROUP BY store_id"""
    result["stage_roundtrip"] = s(
        f"{roundtrip.format('parquet')} UNION ALL {roundtrip.format('csv')}", "total_demand mean_price"
    )

    # features
    result["catalog_codes"] = s("SELECT * FROM codes", "weight_volume weight_netto fatness")
    result["item_codes"] = s("SELECT * FROM items")
    result["lag_features"] = s(
        "SELECT date, store_id, item_id, daily_demand, target, lag_1, lag_7, lag_14, lag_28 FROM lagged",
        "daily_demand target lag_1 lag_7 lag_14 lag_28",
    )
    result["rolling_features"] = s(
        "SELECT * FROM rolled",
        "daily_demand rolling_mean_7 rolling_mean_14 rolling_mean_28 rolling_std_7 rolling_std_28",
    )
    result["price_features"] = s(
        "SELECT date, store_id, item_id, price, price_change FROM lagged", "price price_change"
    )
    result["calendar_features"] = s(
        """SELECT date, store_id, item_id, CAST(isodow(date) - 1 AS INT) AS day_of_week,
                  CAST(day(date) AS INT) AS day_of_month, CAST(month(date) AS INT) AS month,
                  CAST(week(date) AS INT) AS week_of_year,
                  CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INT) AS is_weekend
           FROM prepared"""
    )
    result["features_full"] = s("SELECT * FROM features", _FEATURE_DOUBLES)
    result["features_appended"] = result["features_full"]
    calendar = "day_of_week day_of_month month week_of_year is_weekend"
    numbers = f"{_FEATURE_DOUBLES.removesuffix(' target')} {calendar}".split()
    codes = "item_code dept_code class_code subclass_code item_type_code".split()
    result["model_input"] = s(
        "SELECT * REPLACE ("
        + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in numbers)
        + ", store_id + 1 AS store_id, "
        + ", ".join(f"coalesce({c}, -1) + 1 AS {c}" for c in codes)
        + ") FROM features",
        f"{_FEATURE_DOUBLES.replace('price_change', 'price_change:3').replace('price ', 'price:3 ', 1)} {calendar}",
    )
    result["target_stats"] = s(
        """SELECT (SELECT count(*) FROM prepared) AS input_rows, count(*) AS output_rows,
                  (SELECT count(*) FROM prepared) - count(*) AS rows_without_target,
                  min(date) AS min_date, max(date) AS max_date, min(target) AS target_min,
                  max(target) AS target_max, avg(target) AS target_mean, stddev_pop(target) AS target_std
           FROM features""",
        "target_min target_max target_mean target_std",
    )
    result["split_summary"] = s(
        """SELECT n.split, count(f.date) AS rows,
                  count(f.date) * 100.0 / (SELECT count(*) FROM features) AS pct,
                  min(f.date) AS min_date, max(f.date) AS max_date
           FROM (VALUES ('train'), ('validation'), ('test'), ('outside')) n(split)
           LEFT JOIN all_scored f ON f.split = n.split GROUP BY n.split""",
        "pct",
    )
    result["split_checks"] = s(
        """SELECT count(*) AS total_rows, count(*) FILTER (WHERE split <> 'outside') AS assigned_rows,
                  count(*) FILTER (WHERE split = 'outside') AS outside_rows, TRUE AS accounting_ok,
                  TRUE AS ordering_ok, TRUE AS no_overlap_ok, TRUE AS expected_total_ok,
                  max(date) FILTER (WHERE split = 'train') < min(date) FILTER (WHERE split = 'validation')
                    AND max(date) FILTER (WHERE split = 'validation') < min(date) FILTER (WHERE split = 'test') AS dates_apart_ok
           FROM all_scored"""
    )

    # evaluation
    result["forecast_metrics"] = s(
        f"SELECT split, {_METRICS} FROM all_scored GROUP BY split", _METRIC_DIGITS
    )
    result["evaluate_validation"] = s(
        f"SELECT {_METRICS} FROM all_scored WHERE split = 'validation'", _METRIC_DIGITS
    )
    signed = ", ".join(f"quantile_cont(error, {p / 100}) AS error_p{p}" for p in _PERCENTS)
    absolute = ", ".join(f"quantile_cont(abs_error, {p / 100}) AS abs_error_p{p}" for p in (50, 90, 95, 99))
    result["error_distribution"] = s(
        f"""SELECT count(*) AS rows, avg(error) AS mean_error, stddev_pop(error) AS std_error,
                   min(error) AS min_error, max(error) AS max_error, avg(abs_error) AS mean_abs_error,
                   max(abs_error) AS max_abs_error, {signed}, {absolute},
                   count(*) FILTER (WHERE error > 0) AS overpredictions,
                   count(*) FILTER (WHERE error < 0) AS underpredictions,
                   count(*) FILTER (WHERE error = 0) AS exact_matches,
                   count(*) FILTER (WHERE error > 0) * 100.0 / count(*) AS overprediction_pct,
                   count(*) FILTER (WHERE error < 0) * 100.0 / count(*) AS underprediction_pct,
                   count(*) FILTER (WHERE error = 0) * 100.0 / count(*) AS exact_match_pct
            FROM scored""",
        "mean_error std_error min_error max_error mean_abs_error max_abs_error overprediction_pct "
        "underprediction_pct exact_match_pct "
        + " ".join(f"error_p{p}" for p in _PERCENTS)
        + " "
        + " ".join(f"abs_error_p{p}" for p in (50, 90, 95, 99)),
    )
    result["actual_vs_predicted"] = s(_distribution_rows(), "actual predicted")
    totals = "mean_actual mean_predicted total_actual total_predicted mean_difference mean_ratio total_difference total_ratio"
    result["demand_totals"] = s(
        """SELECT avg(target) AS mean_actual, avg(predicted) AS mean_predicted, sum(target) AS total_actual,
                  sum(predicted) AS total_predicted, avg(predicted) - avg(target) AS mean_difference,
                  avg(predicted) / nullif(avg(target), 0) AS mean_ratio,
                  sum(predicted) - sum(target) AS total_difference,
                  sum(predicted) / nullif(sum(target), 0) AS total_ratio
           FROM scored""",
        totals,
    )
    result["bias_summary"] = s(
        """SELECT avg(error) AS mean_bias, median(error) AS median_bias,
                  CASE WHEN avg(error) > 0 THEN 'OVERPREDICTS' WHEN avg(error) < 0 THEN 'UNDERPREDICTS'
                       ELSE 'No systematic bias' END AS direction
           FROM scored""",
        "mean_bias median_bias",
    )
    result["metrics_by_range"] = s(
        """SELECT n.demand_range, count(f.date) AS rows, avg(abs_error) AS mae, sqrt(avg(squared_error)) AS rmse,
                  avg(target) AS mean_actual, avg(predicted) AS mean_pred, avg(error) AS bias,
                  count(f.date) * 100.0 / (SELECT count(*) FROM scored) AS pct,
                  CASE WHEN avg(error) > 0 THEN 'overpredicts' WHEN avg(error) <= 0 THEN 'underpredicts' END AS direction
           FROM (VALUES ('demand = 0'), ('demand 1-5'), ('demand 6-20'), ('demand 21-100'), ('demand > 100'),
                        ('unbucketed')) n(demand_range)
           LEFT JOIN scored f ON f.demand_range = n.demand_range GROUP BY n.demand_range""",
        "mae rmse mean_actual mean_pred bias pct",
    )
    result["sse_by_range"] = s(
        """SELECT *, CASE WHEN pct_sse > pct_rows * 2 THEN 'DISPROPORTIONATE'
                          WHEN pct_sse < pct_rows * 0.5 THEN 'low contribution' ELSE 'proportionate' END AS comment
           FROM (SELECT demand_range, count(*) AS rows, sum(squared_error) AS sse, sqrt(avg(squared_error)) AS rmse,
                        count(*) * 100.0 / (SELECT count(*) FROM scored) AS pct_rows,
                        sum(squared_error) * 100.0 / (SELECT sum(squared_error) FROM scored) AS pct_sse
                 FROM scored GROUP BY demand_range) r""",
        "sse:2 rmse pct_rows pct_sse",
    )
    result["high_demand"] = s(
        """SELECT count(*) AS rows, count(*) FILTER (WHERE error < 0) AS underpredicted,
                  count(*) FILTER (WHERE error > 0) AS overpredicted,
                  count(*) FILTER (WHERE error < 0) * 100.0 / count(*) AS underpredicted_pct,
                  count(*) FILTER (WHERE error > 0) * 100.0 / count(*) AS overpredicted_pct,
                  avg(target) AS mean_actual, avg(predicted) AS mean_pred, avg(error) AS mean_bias,
                  avg(abs_error) AS mae, sqrt(avg(squared_error)) AS rmse,
                  avg(predicted / target) AS ratio_mean, median(predicted / target) AS ratio_median,
                  count(*) FILTER (WHERE predicted / target < 0.5) AS ratio_below_0_5,
                  count(*) FILTER (WHERE predicted / target >= 0.5 AND predicted / target < 0.8) AS ratio_0_5_to_0_8,
                  count(*) FILTER (WHERE predicted / target >= 0.8 AND predicted / target <= 1.2) AS ratio_0_8_to_1_2,
                  count(*) FILTER (WHERE predicted / target > 1.2) AS ratio_above_1_2
           FROM scored WHERE target > 20""",
        "underpredicted_pct overpredicted_pct mean_actual mean_pred mean_bias mae rmse ratio_mean ratio_median",
    )
    result["metrics_by_store"] = s(
        f"SELECT store_id, {_METRICS} FROM scored GROUP BY store_id", _METRIC_DIGITS
    )
    result["top_errors"] = s(
        """SELECT rank, date, target_date, store_id, item_id, target, predicted, error, abs_error, squared_error
           FROM cases""",
        "target predicted error abs_error squared_error:2",
    )
    result["top_error_sse_share"] = s(
        """SELECT count(*) AS total_rows, avg(abs_error) AS mae, sqrt(avg(squared_error)) AS rmse,
                  sum(abs_error) / nullif(sum(abs(target)), 0) * 100 AS wape, sum(squared_error) AS total_sse,
                  (SELECT count(*) FROM cases) AS top_rows, (SELECT sum(squared_error) FROM cases) AS top_sse,
                  (SELECT min(abs_error) FROM cases) AS top_min_abs_error,
                  (SELECT max(abs_error) FROM cases) AS top_max_abs_error,
                  (SELECT min(target) FROM cases) AS top_min_actual, (SELECT max(target) FROM cases) AS top_max_actual,
                  (SELECT min(predicted) FROM cases) AS top_min_predicted,
                  (SELECT max(predicted) FROM cases) AS top_max_predicted,
                  (SELECT sum(squared_error) FROM cases) / sum(squared_error) * 100 AS top_sse_share_pct
           FROM scored""",
        "mae rmse wape total_sse:2 top_sse:2 top_min_abs_error top_max_abs_error top_min_actual top_max_actual "
        "top_min_predicted top_max_predicted top_sse_share_pct",
    )
    result["sample_predictions"] = s(
        """SELECT store_id, item_id, date, target AS actual, predicted, abs_error
           FROM scored ORDER BY store_id, item_id, date LIMIT 20""",
        "actual predicted abs_error",
    )

    # investigation and cohorts
    result["spike_windows"] = s(
        "SELECT * FROM context",
        "prior_28d_mean prior_28d_median prior_28d_max prior_28d_std post_7d_mean post_7d_median post_7d_max "
        "post_7d_std hist_max_all_time",
    )
    frames = {"prior_28d": "28 PRECEDING AND 1 PRECEDING", "post_7d": "1 FOLLOWING AND 7 FOLLOWING"}
    rolling = ", ".join(
        f"coalesce(avg(daily_demand) OVER {w}, 0) AS {w}_mean, coalesce(median(daily_demand) OVER {w}, 0) AS {w}_median, "
        f"coalesce(max(daily_demand) OVER {w}, 0) AS {w}_max, coalesce(stddev_samp(daily_demand) OVER {w}, 0) AS {w}_std, "
        f"count(*) FILTER (WHERE daily_demand = 0) OVER {w} AS {w}_zeros"
        for w in frames
    )
    windows = ", ".join(
        f"{w} AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN {frame})" for w, frame in frames.items()
    )
    result["rolling_context"] = s(
        f"SELECT date, store_id, item_id, {rolling} FROM prepared WINDOW {windows}",
        " ".join(f"{w}_{x}" for w in frames for x in ("mean", "median", "max", "std")),
    )
    around = ", ".join(
        f"coalesce(avg(daily_demand) OVER {w}, 0) AS {w}_mean, coalesce(median(daily_demand) OVER {w}, 0) AS {w}_median, "
        f"coalesce(max(daily_demand) OVER {w}, 0) AS {w}_max, coalesce(stddev_samp(daily_demand) OVER {w}, 0) AS {w}_std, "
        f"count(*) FILTER (WHERE daily_demand = 0) OVER {w} AS {w}_zeros"
        for w in frames
    )
    whole = ", ".join(f"count(*) FILTER (WHERE daily_demand >= {n}) OVER series AS times_exceeded_{n}" for n in (100, 500, 1000))
    result["spike_windows_by_bins"] = s(
        f"""SELECT c.date, c.store_id, c.item_id, h.* EXCLUDE (date, store_id, item_id)
            FROM scored c JOIN (
              SELECT date, store_id, item_id, {around}, max(daily_demand) OVER series AS hist_max_all_time, {whole},
                     count(*) FILTER (WHERE daily_demand >= 100) OVER weekdays AS spikes_same_weekday
              FROM prepared
              WINDOW {windows}, series AS (PARTITION BY store_id, item_id),
                     weekdays AS (PARTITION BY store_id, item_id, isodow(date))) h
            ON h.store_id = c.store_id AND h.item_id = c.item_id AND h.date = c.date + 1""",
        " ".join(f"{w}_{x}" for w in frames for x in ("mean", "median", "max", "std")) + " hist_max_all_time",
    )
    result["investigation_report_long"] = s(_investigation_report(), "value:3")
    result["cold_start_report_long"] = s(_cold_start_report(), "value:3")
    result["spike_classification"] = s(
        """SELECT rank, date AS feature_date, target_date, store_id, item_id, dept_name, class_name, subclass_name,
                  target AS actual_demand, predicted AS predicted_demand, error AS signed_error, abs_error,
                  price, price_change, lag_1, lag_7, lag_14, lag_28, rolling_mean_7, rolling_mean_14, rolling_mean_28,
                  rolling_std_7, rolling_std_28, prior_28d_mean, prior_28d_median, prior_28d_max, prior_28d_std,
                  prior_28d_zeros, post_7d_mean, post_7d_median, post_7d_max, post_7d_std, post_7d_zeros,
                  hist_max_all_time, times_exceeded_100, times_exceeded_500, raw_rows, raw_sales_qty, raw_price_base,
                  raw_sum_total, spike_vs_prior_mean, spike_vs_prior_max, classification, evidence,
                  prior_28d_series, post_7d_series
           FROM investigated""",
        _CASE_DOUBLES,
    )
    result["classification_counts"] = s(
        """SELECT classification, count(*) AS cases, count(*) * 100.0 / (SELECT count(*) FROM investigated) AS pct
           FROM investigated GROUP BY classification""",
        "pct",
    )
    result["cohort_metrics"] = s(_cohorts(), f"{_METRIC_DIGITS} sse_share_pct")
    result["unseen_items"] = s(
        """SELECT t.*, CASE WHEN f.item_id IS NULL THEN 'NOT IN CATALOG' ELSE f.dept_name END AS dept_name,
                  CASE WHEN f.item_id IS NULL THEN 'NOT IN CATALOG' ELSE f.class_name END AS class_name
           FROM (SELECT item_id, count(*) AS test_rows, min(date) AS first_date, max(date) AS last_date,
                        count(DISTINCT store_id) AS stores_count, sum(target) AS total_demand,
                        avg(target) AS mean_actual, avg(predicted) AS mean_pred, avg(abs_error) AS mae,
                        sqrt(avg(squared_error)) AS rmse,
                        sum(abs_error) / greatest(sum(target), 1e-6) * 100 AS wape,
                        count(*) FILTER (WHERE lag_28 IS NULL) * 100.0 / count(*) AS lag28_null_pct
                 FROM scored WHERE item_id NOT IN (SELECT item_id FROM training_items) GROUP BY item_id) t
           LEFT JOIN first_rows f ON f.item_id = t.item_id""",
        "total_demand mean_actual mean_pred mae rmse wape lag28_null_pct",
    )
    result["common_keys"] = s(
        """SELECT item_id, 'both' AS found_in FROM (SELECT item_id FROM sales INTERSECT SELECT item_id FROM catalog) a
           UNION ALL
           SELECT item_id, 'sales' AS found_in FROM (SELECT item_id FROM sales EXCEPT SELECT item_id FROM catalog) b"""
    )

    # reconciliation
    result["tx_granularity"] = s("SELECT * FROM granularity", "mean_tx")
    result["item_stats"] = s(
        "SELECT * FROM statistics",
        "qty_sum qty_min qty_max qty_mean qty_median qty_std price_min price_max price_mean total_sum:4 total_min:4 "
        "total_max:4 total_mean max_arithmetic_diff:4 mean_arithmetic_diff min_unit_price max_unit_price mean_unit_price",
    )
    result["item_prices"] = s(
        "SELECT item_id, price_base, count(*) AS tx_rows FROM sales GROUP BY item_id, price_base", "price_base"
    )
    result["item_by_store"] = s(
        """SELECT item_id, store_id, count(quantity) AS record_count, sum(quantity) AS qty_sum, min(quantity) AS qty_min,
                  avg(quantity) AS qty_mean, max(quantity) AS qty_max, sum(sum_total) AS revenue
           FROM sales GROUP BY item_id, store_id""",
        "qty_sum qty_min qty_mean qty_max revenue:4",
    )
    result["arithmetic_check"] = s(
        "SELECT * FROM arithmetic", "quantity price_base sum_total expected_sum abs_diff effective_unit_price:9"
    )
    result["reconcile_daily"] = s(
        "SELECT * FROM daily_diff",
        "raw_quantity_sum raw_price_mean raw_sum_total:4 daily_demand price qty_diff price_diff",
    )
    result["reconcile_daily_by_item"] = s("SELECT * FROM raw_vs_daily")
    result["reconcile_prepared"] = s("SELECT * FROM prepared_diff", "demand_daily demand_prepared qty_diff")
    result["reconcile_prepared_by_item"] = s("SELECT * FROM daily_vs_prepared")
    result["sales_listing"] = s(
        """SELECT s.date, s.store_id, s.item_id, s.quantity, s.price_base, s.sum_total,
                  p.daily_demand AS prepared_demand
           FROM sales s LEFT JOIN prepared p
             ON p.date = s.date AND p.store_id = s.store_id AND p.item_id = s.item_id""",
        "quantity price_base sum_total:4 prepared_demand",
    )
    result["item_presence"] = s(
        """SELECT *, catalog_rows > 0 AS in_catalog, price_history_rows > 0 AS in_price_history,
                  discounts_history_rows > 0 AS in_discounts_history
           FROM presence"""
    )
    result["audit_report_long"] = s(_long_report(), "value:4")

    # exploration
    result["sales_profile"] = s(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
            f"min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
            f"quantile_cont({c}, 0.75) AS q75 FROM sales"
            for c in ("store_id", "quantity", "price_base", "sum_total")
        ),
        "mean std min:4 max:4 q25 q50 q75",
    )
    result["sales_shape"] = s(
        """SELECT count(*) AS rows, CAST(6 AS INT) AS columns, count(DISTINCT item_id) AS unique_products,
                  count(DISTINCT store_id) AS unique_stores,
                  (SELECT count(*) FROM sales s LEFT JOIN catalog c ON s.item_id = c.item_id) AS joined_rows
           FROM sales"""
    )
    result["approx_counts_by_month"] = s(
        """SELECT strftime(date, '%Y-%m') AS month, count(*) AS rows, count(DISTINCT item_id) AS item_id_exact,
                  count(DISTINCT store_id) AS store_id_exact, TRUE AS item_id_within, TRUE AS store_id_within
           FROM sales GROUP BY 1"""
    )
    result["approx_quantiles_by_store"] = s(
        """SELECT store_id, CAST(p AS DOUBLE) AS prob, count(*) AS "values", TRUE AS within
           FROM sales, (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]) AS p) probs GROUP BY 1, 2"""
    )
    result["top_items"] = s(
        """SELECT s.item_id, sum(s.quantity) AS total_quantity
           FROM sales s LEFT JOIN catalog c ON s.item_id = c.item_id
           GROUP BY s.item_id ORDER BY total_quantity DESC, s.item_id LIMIT 10""",
        "total_quantity",
    )
    result["department_sales"] = s(
        """SELECT dept_name, sum(quantity) AS total_quantity
           FROM sales s LEFT JOIN catalog c ON s.item_id = c.item_id
           WHERE dept_name IS NOT NULL GROUP BY dept_name ORDER BY total_quantity DESC, dept_name LIMIT 15""",
        "total_quantity",
    )
    return result
