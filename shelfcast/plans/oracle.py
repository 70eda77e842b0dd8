"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each oracle is ``WITH <fixture views>, <operator CTEs> SELECT ...`` over the
driver's pre-registered tables.  CTE bodies are written once here and shared, so
an oracle for a composite job is the same chain of CTEs the Spark side builds
from DataFrames.  Doubles are rounded to 4 places on both sides.
"""

from __future__ import annotations

AS_OF = "(SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)"

# ------------------------------------------------------------------ fixture views
FIXTURE_CTES: dict[str, str] = {}

FIXTURE_CTES["dim_product"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CAST(att01 AS VARCHAR) || '-' || p_brand || '-' || att02 AS product_code,
       p_brand AS marka_aciklama,
       att01 AS product_att_01, att02 AS product_att_02,
       string_split(p_name, ' ')[1] AS product_att_03,
       string_split(p_name, ' ')[-1] AS product_att_04,
       att05 AS product_att_05, CAST(NULL AS VARCHAR) AS product_att_06,
       p_type AS product_att_01_desc,
       CASE WHEN p_size % 5 <= 1 THEN 'BAND-9' ELSE 'BAND-' || CAST(p_size % 5 AS VARCHAR) END AS product_att_02_desc,
       CAST(NULL AS VARCHAR) AS product_att_03_desc, CAST(NULL AS VARCHAR) AS product_att_04_desc,
       'BRANDGRP-' || CAST(att05 AS VARCHAR) AS product_att_05_desc,
       CAST(NULL AS VARCHAR) AS product_att_06_desc,
       CAST(CASE WHEN p_partkey % 20 = 0 THEN 1 WHEN p_partkey % 20 = 1 THEN NULL ELSE 0 END AS INTEGER) AS is_blocked
FROM (SELECT *,
        CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                         WHEN 'SMALL' THEN 4 WHEN 'STANDARD' THEN 5 WHEN 'PROMO' THEN 999 END AS INTEGER) AS att01,
        CASE WHEN p_size % 5 = 0 THEN 'D' WHEN p_size % 5 = 1 THEN 'N' ELSE CAST(p_size % 5 AS VARCHAR) END AS att02,
        CAST(CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) % 4 AS INTEGER) AS att05
      FROM part) p
"""

FIXTURE_CTES["store_clustering"] = """
SELECT CAST(1001 + 100 * n_nationkey AS VARCHAR) AS store_code, CAST(n_nationkey % 4 AS INTEGER) AS store_cluster
FROM nation WHERE n_nationkey <> 24
"""

FIXTURE_CTES["dim_calendar"] = """
SELECT d AS date, CAST(month(d) AS INTEGER) AS month,
       CASE WHEN kara THEN 'KARA_CUMA' WHEN ram THEN 'RAMAZAN' WHEN kur THEN 'KURBAN'
            WHEN day(d) = 1 THEN 'YOK' END AS special_day_tag,
       CAST(ram AS INTEGER) AS ramazan_bayrami, CAST(kur AS INTEGER) AS kurban_bayrami, CAST(kara AS INTEGER) AS kara_cuma
FROM (SELECT d,
        month(d) = 11 AND isodow(d) = 5 AND day(d) BETWEEN 23 AND 29 AS kara,
        month(d) = 3 AND day(d) <= 3 AS ram,
        month(d) = 6 AND day(d) BETWEEN 10 AND 13 AS kur
      FROM (SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
            FROM lineitem) g) c
"""

FIXTURE_CTES["history_sales"] = """
SELECT CAST(l.l_shipdate AS DATE) AS date,
       CAST(1001 + 100 * s.s_nationkey AS VARCHAR) AS store_code,
       CAST(l.l_partkey AS VARCHAR) AS product_id,
       dp.product_code AS stok_kodu,
       sgn * l.l_quantity AS net_quantity,
       sgn * l.l_extendedprice * l.l_discount AS discount_amount,
       sgn * l.l_extendedprice * (1.0 - l.l_discount) AS net_amount_wovat,
       l.l_extendedprice / NULLIF(l.l_quantity, 0) AS unit_price
FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1.0 ELSE 1.0 END AS sgn FROM lineitem) l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN dim_product dp ON dp.product_id = CAST(l.l_partkey AS VARCHAR)
"""

FIXTURE_CTES["store_stock"] = f"""
SELECT CAST(l.l_shipdate AS DATE) AS stok_tarihi,
       CAST(1001 + 100 * s.s_nationkey AS VARCHAR) AS magaza,
       dp.product_code AS stok_kodu, CAST(NULL AS VARCHAR) AS color_code, CAST(NULL AS VARCHAR) AS size,
       CAST(l.l_partkey AS VARCHAR) AS product_id, l.l_quantity AS toplam_miktar
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN dim_product dp ON dp.product_id = CAST(l.l_partkey AS VARCHAR)
WHERE l.l_linestatus = 'O' AND l.l_returnflag <> 'R'
"""

FIXTURE_CTES["warehouse_stock"] = f"""
SELECT '90010' || CAST(l_suppkey % 3 + 1 AS VARCHAR) AS alt_yer, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(sum(floor(l_quantity / 10)) AS BIGINT) AS miktar
FROM lineitem WHERE l_linestatus = 'F'
GROUP BY 1, 2
"""

FIXTURE_CTES["stock_movement"] = f"""
SELECT CAST(l.l_partkey AS VARCHAR) AS urun_kodu,
       CAST(1001 + 100 * s.s_nationkey AS VARCHAR) || '01' AS giris_depo_kodu,
       '90010' || CAST(l.l_suppkey % 3 + 1 AS VARCHAR) AS cikis_depo_kodu,
       sum(CASE WHEN l.l_linenumber % 2 = 0 THEN l.l_quantity ELSE 0.0 END) AS toplam_yoldaki_miktar,
       sum(CASE WHEN l.l_linenumber % 2 <> 0 THEN l.l_quantity ELSE 0.0 END) AS toplanmayan_urun
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_returnflag = 'N'
GROUP BY 1, 2, 3
"""

FIXTURE_CTES["dense_need"] = f"""
SELECT hs.store_code, dp.marka_aciklama AS product_id,
       CAST(ceil(sum(greatest(hs.net_quantity, 0.0)) / 10) AS BIGINT) AS ihtiyac_adet
FROM history_sales hs JOIN dim_product dp ON dp.product_id = hs.product_id
GROUP BY 1, 2
"""

FIXTURE_CTES["dense_stock"] = f"""
SELECT '90010' || CAST(l.l_suppkey % 3 + 1 AS VARCHAR) AS alt_yer, p.p_brand AS product_id,
       CAST(sum(floor(l.l_quantity / 12)) AS BIGINT) AS miktar
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_linestatus = 'F' AND p.p_brand <> 'Brand#7'
GROUP BY 1, 2
"""

# ------------------------------------------------------------------ operator CTEs
OP_CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    OP_CTES[name] = body


def build(select: str, needs: list[str] | None = None) -> str:
    """``WITH`` every fixture and operator CTE (DuckDB skips unreferenced ones)."""
    parts = [f"{k} AS ({v})" for k, v in FIXTURE_CTES.items()]
    # the fused job reads the daily forecast, which is defined further down
    parts += [f"{k} AS ({v})" for k, v in sorted(OP_CTES.items(), key=lambda x: "fused" in x[0])]
    return "WITH " + ",\n".join(parts) + "\n" + select


def r4(expr: str, alias: str) -> str:
    """Round a double to 4 places through DECIMAL(38,10), exactly as ``catalog.finish``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 4) AS DOUBLE) AS {alias}"


# H1 (prod): month floor 24 months, daily pre-aggregate, week by arithmetic
cte("prep_daily", f"""
SELECT date, store_code, product_id,
       sum(discount_amount) AS discount_amount, sum(net_amount_wovat) AS net_amount_wovat,
       sum(net_quantity) AS net_quantity,
       sum(net_amount_wovat) / NULLIF(sum(net_quantity), 0) AS unit_price
FROM history_sales
GROUP BY 1, 2, 3
""")

cte("prep_enriched", """
SELECT d.*, date_trunc('week', d.date)::DATE AS week_start_date,
       p.product_att_01, TRY_CAST(translate(p.product_att_02, 'DN', '99') AS DOUBLE) AS product_att_02,
       p.product_att_05, p.product_att_01_desc, p.product_att_02_desc, p.product_att_05_desc,
       c.store_cluster
FROM prep_daily d
LEFT JOIN dim_product p ON p.product_id = d.product_id
LEFT JOIN store_clustering c ON c.store_code = d.store_code
""")

cte("prep_rows", """
SELECT product_att_01, product_att_02, product_att_05, product_att_01_desc, product_att_02_desc,
       product_att_05_desc, store_cluster, week_start_date,
       coalesce(net_quantity, 0.0) AS net_quantity, unit_price,
       least(greatest(CASE WHEN coalesce(discount_amount, 0) + coalesce(net_amount_wovat, 0) > 0
                           THEN coalesce(discount_amount, 0) / (coalesce(discount_amount, 0) + coalesce(net_amount_wovat, 0))
                           ELSE 0.0 END, 0.0), 0.9) AS discount_frac,
       coalesce(discount_amount, 0) + coalesce(net_amount_wovat, 0) AS rev_pre_disc
FROM prep_enriched
WHERE product_att_01 IS DISTINCT FROM 9 AND product_att_02 IS DISTINCT FROM 9
  AND product_att_01 IS NOT NULL AND product_att_02 IS NOT NULL AND product_att_05 IS NOT NULL
  AND product_att_01_desc IS NOT NULL AND product_att_02_desc IS NOT NULL AND product_att_05_desc IS NOT NULL
  AND store_cluster IS NOT NULL AND week_start_date IS NOT NULL
""")

WEEKLY_KEYS = ("product_att_01, product_att_02, product_att_05, product_att_01_desc, product_att_02_desc, "
               "product_att_05_desc, store_cluster, week_start_date")

cte("weekly", f"""
SELECT {WEEKLY_KEYS},
       CAST(round_even(sum(net_quantity), 0) AS BIGINT) AS total_quantity,
       avg(unit_price) AS unit_price_mean,
       median(unit_price) AS unit_price_median,
       avg(discount_frac) AS discount_frac_mean,
       CASE WHEN sum(rev_pre_disc) > 0 THEN sum(discount_frac * rev_pre_disc) / sum(rev_pre_disc) END AS discount_frac_wavg
FROM prep_rows
GROUP BY ALL
""")

ORACLES: dict[str, str] = {}

ORACLES["weekly_segment_sales"] = build(f"""
SELECT {WEEKLY_KEYS}, total_quantity,
       {r4('unit_price_mean', 'unit_price_mean')}, {r4('unit_price_median', 'unit_price_median')},
       {r4('discount_frac_mean', 'discount_frac_mean')}, {r4('discount_frac_wavg', 'discount_frac_wavg')}
FROM weekly
""")

# ---------------------------------------------------------------- step 1 oracles
HS_COLS = "date, store_code, product_id, stok_kodu"
ORACLES["src_parquet_pruned"] = build(f"""
SELECT l_partkey, l_suppkey, {r4('l_quantity', 'l_quantity')}, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
""")
ORACLES["src_csv"] = build(f"""
SELECT {HS_COLS}, {r4('net_quantity', 'net_quantity')}, {r4('discount_amount', 'discount_amount')},
       {r4('net_amount_wovat', 'net_amount_wovat')}, {r4('unit_price', 'unit_price')} FROM history_sales
""")
ORACLES["normalize_sales"] = ORACLES["src_csv"]
ORACLES["src_csv_locale"] = build(f"""
SELECT l_orderkey, l_linenumber, {r4('l_quantity', 'l_quantity')}, {r4('l_extendedprice', 'l_extendedprice')},
       {r4('l_discount', 'l_discount')} FROM lineitem
""")
ORACLES["dim_store_cluster"] = build("SELECT store_code, store_cluster FROM store_clustering")
ORACLES["clean_attribute_code"] = build(f"""
SELECT product_id, product_att_02, {r4("TRY_CAST(translate(product_att_02, 'DN', '99') AS DOUBLE)", 'product_att_02_clean')}
FROM dim_product
""")
ORACLES["exclude_sentinels"] = build(f"""
SELECT product_id, product_att_01, {r4('att02', 'product_att_02')}
FROM (SELECT product_id, product_att_01, TRY_CAST(translate(product_att_02, 'DN', '99') AS DOUBLE) AS att02 FROM dim_product) x
WHERE product_att_01 IS DISTINCT FROM 9 AND product_att_01 IS DISTINCT FROM 999
  AND att02 IS DISTINCT FROM 9 AND att02 IS DISTINCT FROM 999
""")
ORACLES["negative_qty_modes"] = build(f"""
SELECT store_code, product_id,
       {r4('sum(greatest(net_quantity, 0.0))', 'qty_clipped')},
       {r4('sum(CASE WHEN net_quantity >= 0 THEN net_quantity END)', 'qty_filtered')},
       {r4('greatest(sum(net_quantity), 0.0)', 'qty_zeroed_after_sum')}
FROM history_sales GROUP BY 1, 2
""")
ORACLES["discount_fraction"] = build(f"""
SELECT date, store_code, product_id,
       {r4('''least(greatest(CASE WHEN coalesce(discount_amount, 0) + coalesce(net_amount_wovat, 0) > 0
              THEN coalesce(discount_amount, 0) / (coalesce(discount_amount, 0) + coalesce(net_amount_wovat, 0))
              ELSE 0.0 END, 0.0), 0.9)''', 'discount_frac')},
       {r4('coalesce(discount_amount, 0) + coalesce(net_amount_wovat, 0)', 'rev_pre_disc')}
FROM history_sales
""")
ORACLES["daily_unit_price"] = build(f"""
SELECT date, store_code, product_id, {r4('sum(discount_amount)', 'discount_amount')},
       {r4('sum(net_amount_wovat)', 'net_amount_wovat')}, {r4('sum(net_quantity)', 'net_quantity')},
       {r4('sum(net_amount_wovat) / NULLIF(sum(net_quantity), 0)', 'unit_price')}
FROM history_sales GROUP BY 1, 2, 3
""")
ORACLES["month_floor_lookback"] = build(f"""
SELECT date_trunc('month', date)::DATE AS month_start, count(*) AS row_count, {r4('sum(net_quantity)', 'net_quantity')}
FROM history_sales WHERE date >= date_trunc('month', {AS_OF} - INTERVAL 24 MONTH)::DATE GROUP BY 1
""")
ORACLES["lookback_filter"] = build(f"""
SELECT date, store_code, {r4('sum(net_quantity)', 'net_quantity')}
FROM history_sales WHERE date >= (SELECT max(date) FROM history_sales) - 27 AND date <= (SELECT max(date) FROM history_sales)
GROUP BY 1, 2
""")
ORACLES["enrich_sales"] = build(f"""
SELECT h.date, h.store_code, h.product_id, {r4('h.net_quantity', 'net_quantity')}, p.product_att_01, p.product_att_02,
       p.product_att_05, c.store_cluster
FROM history_sales h LEFT JOIN dim_product p ON p.product_id = h.product_id
LEFT JOIN store_clustering c ON c.store_code = h.store_code
""")
ORACLES["calendar_week_join"] = build(f"""
SELECT h.date, h.store_code, h.product_id, {r4('h.net_quantity', 'net_quantity')},
       date_trunc('week', c.date)::DATE AS week_start_date
FROM history_sales h LEFT JOIN dim_calendar c ON c.date = h.date
""")
cte("prep_keyed", f"""
SELECT * FROM prep_enriched
WHERE product_att_01 IS DISTINCT FROM 9 AND product_att_02 IS DISTINCT FROM 9
  AND product_att_01 IS NOT NULL AND product_att_02 IS NOT NULL AND product_att_05 IS NOT NULL
  AND product_att_01_desc IS NOT NULL AND product_att_02_desc IS NOT NULL AND product_att_05_desc IS NOT NULL
  AND store_cluster IS NOT NULL AND week_start_date IS NOT NULL
""")
ORACLES["weekly_quantity"] = build(f"""
SELECT {WEEKLY_KEYS}, {r4('sum(net_quantity)', 'total_quantity')} FROM prep_keyed GROUP BY ALL
""")
ORACLES["weekly_price_stats"] = build(f"""
SELECT {WEEKLY_KEYS}, {r4('avg(unit_price)', 'unit_price_mean')}, {r4('median(unit_price)', 'unit_price_median')}
FROM prep_keyed GROUP BY ALL
""")
ORACLES["weighted_discount"] = build(f"""
SELECT {WEEKLY_KEYS}, {r4('CASE WHEN sum(rev_pre_disc) > 0 THEN sum(discount_frac * rev_pre_disc) / sum(rev_pre_disc) END', 'discount_frac_wavg')}
FROM prep_rows GROUP BY ALL
""")
ORACLES["top_segments"] = build(f"""
SELECT {WEEKLY_KEYS}, total_quantity,
       {r4('unit_price_mean', 'unit_price_mean')}, {r4('unit_price_median', 'unit_price_median')},
       {r4('discount_frac_mean', 'discount_frac_mean')}, {r4('discount_frac_wavg', 'discount_frac_wavg')}
FROM weekly ORDER BY total_quantity DESC, {WEEKLY_KEYS} LIMIT 20
""")
ORACLES["segment_keys"] = build("SELECT DISTINCT product_att_01, product_att_02, product_att_05, store_cluster FROM weekly")
ORACLES["sales_profile"] = build(f"""
SELECT count(*) AS row_count, min(date) AS min_date, max(date) AS max_date, count(DISTINCT store_code) AS stores,
       count(DISTINCT product_id) AS products, {r4('sum(net_quantity)', 'net_quantity')} FROM history_sales
""")

# ---------------------------------------------------------------- step 2 oracles
from ..operators.features import FeatureSpec  # noqa: E402

SEG = "product_att_01, product_att_02, product_att_05, store_cluster"
SEG_W = f"PARTITION BY {SEG} ORDER BY week_start_date, product_att_01_desc, product_att_02_desc, product_att_05_desc"
KEYS_OUT = f"{SEG}, product_att_01_desc, product_att_02_desc, product_att_05_desc, week_start_date"


def _frame(lo: int, hi: int) -> str:
    def b(x):
        return "CURRENT ROW" if x == 0 else (f"{-x} PRECEDING" if x < 0 else f"{x} FOLLOWING")
    return f"({SEG_W} ROWS BETWEEN {b(lo)} AND {b(hi)})"


def _guarded_sql(fn: str, c: str, lo: int, hi: int, mp: int) -> str:
    f = _frame(lo, hi)
    return f"CASE WHEN count({c}) OVER {f} >= {mp} THEN {fn}({c}) OVER {f} END"


def feature_sql(group: str, spec: FeatureSpec = FeatureSpec(), min_periods=2, price_mp=2) -> list[str]:
    t = spec.target
    out = []
    if group in ("lags", "all"):
        out += [f"lag({t}, {k}) OVER ({SEG_W}) AS {t}_shifted_{k}" for k in spec.lag_set()]
    if group in ("last_year", "all"):
        out += [f"lag({t}, {spec.last_year_lag}) OVER ({SEG_W}) AS {t}_last_year"]
    if group in ("pct", "all"):
        for d in spec.pct_diffs:
            a, b = f"lag({t}, {d}) OVER ({SEG_W})", f"lag({t}, {d + 1}) OVER ({SEG_W})"
            out.append(r4(f"CAST({a} - {b} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)", f"pct_change_{d}"))
    if group in ("rolling", "all"):
        for s, ws in spec.rolls.items():
            for n in ws:
                mp = n if min_periods is None else min_periods
                lo, hi = -(s + n - 1), -s
                out.append(f"{_guarded_sql('min', t, lo, hi, mp)} AS min_{t}_roll{n}_shift{s}")
                out.append(r4(_guarded_sql('avg', t, lo, hi, mp), f"mean_{t}_roll{n}_shift{s}"))
                out.append(f"{_guarded_sql('max', t, lo, hi, mp)} AS max_{t}_roll{n}_shift{s}")
    if group in ("price", "all"):
        for c in spec.price_cols:
            out.append(r4(f"lag({c}, 1) OVER ({SEG_W})", f"{c}_l1"))
            out.append(r4(_guarded_sql('avg', c, -4, -1, price_mp), f"{c}_ma4_l1"))
    if group in ("segment_mean", "all"):
        out.append(r4(f"avg({t}) OVER (PARTITION BY {SEG})", "segment_mean"))
    return out


cte("weekly_z", """
SELECT * REPLACE (CASE WHEN total_quantity < 0 THEN 0 ELSE total_quantity END AS total_quantity),
       CAST(weekofyear(week_start_date) AS INTEGER) AS week_of_year
FROM weekly
""")

cte("calendar_weekly", """
SELECT date_trunc('week', date)::DATE AS week_start_date,
       arg_min(month, date) FILTER (WHERE month IS NOT NULL) AS month,
       arg_min(special_day_tag, date) FILTER (WHERE special_day_tag IS NOT NULL) AS tag,
       max(ramazan_bayrami) AS ramazan_bayrami, max(kurban_bayrami) AS kurban_bayrami, max(kara_cuma) AS kara_cuma
FROM dim_calendar GROUP BY 1
""")

CAL_OUT = ("cw.month, cw.ramazan_bayrami, cw.kurban_bayrami, cw.kara_cuma, "
           "CAST(coalesce(cw.tag, 'YOK') <> 'YOK' AS INTEGER) AS is_special_day")

ORACLES["calendar_weekly"] = build(f"SELECT week_start_date, {CAL_OUT} FROM calendar_weekly cw")

for _key, _grp in [("lag_features", "lags"), ("lag_last_year", "last_year"), ("pct_change_features", "pct"),
                   ("rolling_features", "rolling"), ("price_lag_features", "price"), ("segment_mean", "segment_mean")]:
    ORACLES[_key] = build(f"SELECT {KEYS_OUT}, total_quantity, {', '.join(feature_sql(_grp))} FROM weekly_z")

WEEKLY_VALUES = ", ".join([r4(c, c) for c in ["unit_price_mean", "unit_price_median", "discount_frac_mean", "discount_frac_wavg"]])

cte("features", f"""
SELECT {KEYS_OUT}, total_quantity, week_of_year, {WEEKLY_VALUES}, {', '.join(feature_sql('all'))}
FROM weekly_z
""")

ORACLES["demand_features"] = build(f"""
SELECT f.*, {CAL_OUT} FROM features f LEFT JOIN calendar_weekly cw ON cw.week_start_date = f.week_start_date
""")

# ------------------------------------------------------------- step 3-4 oracles
import math as _math  # noqa: E402
import statistics as _stats  # noqa: E402

SAFETY_K = repr(_stats.NormalDist().inv_cdf(0.9) * _math.sqrt(2))


def rnd_even(expr: str, scale: int) -> str:
    """Half-even rounding through DECIMAL(38,10), as ``bround_decimal``."""
    return f"CAST(round_even(CAST({expr} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def not_sent(c: str, values=(9, 999)) -> str:
    return " AND ".join(f"{c} IS DISTINCT FROM {v}" for v in values)


def sales_ctes(name: str, sentinels=(9, 999), since: str | None = None) -> None:
    """Cleaned replenishment sales, their last day, and the seasonal daily demand (+-1 month, all years)."""
    bound = f"h.date >= {since} AND " if since else ""
    cte(f"{name}_sales", f"""
SELECT h.date, h.store_code, h.product_id, h.stok_kodu, coalesce(h.net_quantity, 0.0) AS net_quantity
FROM history_sales h
LEFT JOIN (SELECT product_id, product_att_01, TRY_CAST(translate(product_att_02, 'DN', '99') AS DOUBLE) AS a2
           FROM dim_product) p ON p.product_id = h.product_id
WHERE {bound}coalesce(h.net_quantity, 0.0) >= 0
  AND {not_sent('p.product_att_01', sentinels)} AND {not_sent('p.a2', sentinels)}
""")
    cte(f"{name}_max", f"SELECT max(date) AS mx FROM {name}_sales")
    cte(f"{name}_daily", f"""
SELECT s.store_code, s.product_id, s.date, sum(s.net_quantity) AS net_quantity,
       CAST(max(m.mx) - s.date AS INTEGER) AS days_from_today
FROM {name}_sales s, {name}_max m
WHERE ((month(s.date) - month(m.mx)) % 12 + 12) % 12 IN (0, 1, 11)
GROUP BY 1, 2, 3
""")
    cte(f"{name}_stats", f"""
SELECT store_code, product_id, avg(net_quantity) AS daily_avg, coalesce(stddev_samp(net_quantity), 0.0) AS daily_std
FROM {name}_daily GROUP BY 1, 2
""")


sales_ctes("repl", since=f"date_trunc('month', {AS_OF} - 180)::DATE")
sales_ctes("all")
sales_ctes("local", sentinels=(999,))

cte("stock_agg", f"""
SELECT stok_tarihi, magaza, stok_kodu, product_id, CAST(trunc(sum(toplam_miktar)) AS BIGINT) AS stok_miktar
FROM store_stock WHERE stok_tarihi >= date_trunc('month', {AS_OF} - 30)::DATE AND toplam_miktar > 0
GROUP BY 1, 2, 3, 4
""")
# the local and fused generations read every stock row
cte("stock_all", """
SELECT stok_tarihi, magaza, stok_kodu, product_id, CAST(trunc(sum(toplam_miktar)) AS BIGINT) AS stok_miktar
FROM store_stock GROUP BY 1, 2, 3, 4
""")
cte("stock_max", "SELECT max(stok_tarihi) AS today FROM stock_agg")
cte("sku_pairs", """
SELECT DISTINCT magaza, stok_kodu FROM stock_agg, stock_max
WHERE stok_tarihi >= today - 29 AND stok_tarihi <= today AND stok_miktar > 0
""")
cte("local_sku", """
SELECT DISTINCT magaza, stok_kodu FROM stock_all, (SELECT max(stok_tarihi) AS today FROM stock_all) m
WHERE stok_tarihi >= today - 29 AND stok_tarihi <= today AND stok_miktar > 0
""")
cte("fused_sku", """
SELECT DISTINCT magaza, stok_kodu FROM (
  SELECT magaza, stok_kodu FROM stock_all,
    (SELECT greatest((SELECT max(stok_tarihi) FROM stock_all), (SELECT max(date) FROM daily_pred)) AS today) m
  WHERE stok_tarihi >= today - 29 AND stok_tarihi <= today AND stok_miktar > 0
  UNION ALL SELECT store_code, stok_kodu FROM daily_pred WHERE coalesce(prediction_store_daily, 0.0) > 0.0) u
""")
cte("active_product", "SELECT * FROM dim_product WHERE coalesce(is_blocked, 0) = 0")
for _name, _sku in (("product_pairs", "sku_pairs"), ("local_pairs", "local_sku"), ("fused_pairs", "fused_sku")):
    cte(_name, f"""
SELECT DISTINCT sp.magaza AS store_code, sp.stok_kodu, ap.product_id
FROM {_sku} sp LEFT JOIN active_product ap ON ap.product_code = sp.stok_kodu
""")
cte("fused_weight_pairs", """
SELECT p.* FROM fused_pairs p WHERE EXISTS (SELECT 1 FROM daily_pred d
  WHERE d.store_code = p.store_code AND d.stok_kodu = p.stok_kodu AND d.prediction_store_daily > 0)
""")

def weighted_stats_sql(weight_expr: str, src: str) -> str:
    return f"""
SELECT a.store_code, a.product_id, a.m AS daily_avg,
       CASE WHEN a.n > 1 THEN sqrt(greatest(sum(d.w * (d.net_quantity - a.m) * (d.net_quantity - a.m)) / a.sw, 0.0)) ELSE 0.0 END AS daily_std
FROM (SELECT *, {weight_expr} AS w FROM {src}) d
JOIN (SELECT store_code, product_id, sum(w * net_quantity) / sum(w) AS m, count(*) AS n, sum(w) AS sw
      FROM (SELECT *, {weight_expr} AS w FROM {src}) x GROUP BY 1, 2) a
  ON a.store_code = d.store_code AND a.product_id = d.product_id
GROUP BY a.store_code, a.product_id, a.m, a.n, a.sw
"""


W_EXP = "pow(0.95, CAST(days_from_today AS DOUBLE))"
W_LIN = "greatest(1.0 - CAST(days_from_today AS DOUBLE) / NULLIF(CAST((SELECT max(days_from_today) FROM all_daily) AS DOUBLE), 0), 0.1)"
W_RECENT = "CASE WHEN days_from_today <= 7 THEN 0.6 ELSE 0.4 END"
cte("wstats_exp", weighted_stats_sql(W_EXP, "repl_daily"))
cte("wstats_exp_all", weighted_stats_sql(W_EXP, "all_daily"))
cte("wstats_lin_all", weighted_stats_sql(W_LIN, "all_daily"))
cte("wstats_recent_all", weighted_stats_sql(W_RECENT, "all_daily"))


def safety_sql(src: str) -> str:
    return (f"SELECT store_code, product_id, {r4('daily_avg', 'daily_avg')}, {r4('daily_std', 'daily_std')}, "
            f"{rnd_even(f'{SAFETY_K} * daily_std', 2)} AS safety_stock FROM {src}")


cte("safety_weighted", f"SELECT store_code, product_id, daily_avg, daily_std, {rnd_even(f'{SAFETY_K} * daily_std', 2)} AS safety_stock FROM wstats_exp")

ORACLES["seasonal_months"] = build(f"""
SELECT CAST(year(s.date) AS INTEGER) AS year, CAST(month(s.date) AS INTEGER) AS month, count(*) AS row_count,
       {r4('sum(s.net_quantity)', 'net_quantity')}
FROM all_sales s, all_max m WHERE ((month(s.date) - month(m.mx)) % 12 + 12) % 12 IN (0, 1, 11) GROUP BY 1, 2
""")
ORACLES["demand_stats"] = build(f"SELECT store_code, product_id, {r4('daily_avg', 'daily_avg')}, {r4('daily_std', 'daily_std')} FROM all_stats")
ORACLES["weighted_demand_stats_all_years"] = build(f"SELECT store_code, product_id, {r4('daily_avg', 'daily_avg')}, {r4('daily_std', 'daily_std')} FROM wstats_exp_all")
ORACLES["weighted_demand_stats"] = build(f"SELECT store_code, product_id, {r4('daily_avg', 'daily_avg')}, {r4('daily_std', 'daily_std')} FROM wstats_exp")
ORACLES["safety_stock"] = build(safety_sql("all_stats"))
ORACLES["safety_stock_weighted"] = build(safety_sql("wstats_exp"))
ORACLES["compare_weighting_strategies"] = build(" UNION ALL ".join(
    f"SELECT *, '{name}' AS strategy FROM ({safety_sql(src)})" for name, src in
    [("no_weight", "all_stats"), ("exponential_decay", "wstats_exp_all"), ("linear_decay", "wstats_lin_all"),
     ("recent_heavy", "wstats_recent_all")]))

ORACLES["stock_by_day"] = build("SELECT * FROM stock_agg")
ORACLES["active_products"] = build("SELECT product_id, product_code, is_blocked FROM active_product")
ORACLES["style_to_variants"] = build("""
SELECT DISTINCT sp.magaza AS store_code, sp.stok_kodu, p.product_id FROM sku_pairs sp LEFT JOIN dim_product p ON p.product_code = sp.stok_kodu
""")
ORACLES["store_product_pairs"] = build("SELECT * FROM product_pairs")
ORACLES["stock_product_id"] = build(f"""
SELECT s.stok_tarihi, s.magaza, s.stok_kodu, p.product_att_03 AS color_code, p.product_att_04 AS size, s.product_id,
       s.stok_kodu || p.product_att_03 || p.product_att_04 AS sku_id, {r4('s.toplam_miktar', 'toplam_miktar')}
FROM store_stock s LEFT JOIN dim_product p ON p.product_id = s.product_id
""")

cte("open_orders", """
SELECT urun_kodu AS product_id, left(giris_depo_kodu, 4) AS store_code,
       sum(toplam_yoldaki_miktar) AS toplam_yoldaki_miktar, sum(toplanmayan_urun) AS toplanmayan_urun,
       sum(toplam_yoldaki_miktar) + sum(toplanmayan_urun) AS acik_siparis
FROM stock_movement WHERE toplam_yoldaki_miktar > 0 OR toplanmayan_urun > 0 GROUP BY 1, 2
""")
ORACLES["open_order_qty"] = build(f"""
SELECT product_id, store_code, {r4('toplam_yoldaki_miktar', 'toplam_yoldaki_miktar')},
       {r4('toplanmayan_urun', 'toplanmayan_urun')}, {r4('acik_siparis', 'acik_siparis')} FROM open_orders
""")
ORACLES["extract_open_orders"] = build(f"""
SELECT urun_kodu AS product_id, cikis_depo_kodu AS depo_kodu, {r4('sum(toplam_yoldaki_miktar)', 'toplam_yoldaki_miktar')},
       {r4('sum(toplanmayan_urun)', 'toplanmayan_urun')} FROM stock_movement GROUP BY 1, 2
""")

ORACLES["pairs_semi_join"] = build(f"""
SELECT s.date, s.store_code, s.product_id, s.stok_kodu, {r4('s.net_quantity', 'net_quantity')} FROM repl_sales s
WHERE EXISTS (SELECT 1 FROM product_pairs p WHERE p.store_code = s.store_code AND p.stok_kodu = s.stok_kodu
              AND p.product_id = s.product_id)
""")

def weight_ctes(prefix: str, sales: str, last: str, stock: str, pairs: str) -> None:
    """Shares of sales and stock within (store, style), and the variant weights."""
    cte(f"{prefix}sales_share", f"""
SELECT store_code, stok_kodu, product_id, sales_90d,
       sales_90d / NULLIF(sum(sales_90d) OVER (PARTITION BY store_code, stok_kodu), 0) AS weight_sales
FROM (SELECT s.store_code, s.stok_kodu, s.product_id, greatest(sum(s.net_quantity), 0.0) AS sales_90d
      FROM {sales} s, {last} m
      WHERE s.date >= m.mx - 89 AND s.date <= m.mx AND s.net_quantity > 0
        AND EXISTS (SELECT 1 FROM {pairs} p WHERE p.store_code = s.store_code AND p.stok_kodu = s.stok_kodu
                    AND p.product_id = s.product_id)
      GROUP BY 1, 2, 3) x
""")
    cte(f"{prefix}stock_share", f"""
SELECT store_code, stok_kodu, product_id, onhand_30d,
       onhand_30d / NULLIF(sum(onhand_30d) OVER (PARTITION BY store_code, stok_kodu), 0) AS weight_onhand
FROM (SELECT st.magaza AS store_code, st.stok_kodu, st.product_id, sum(st.stok_miktar) AS onhand_30d
      FROM {stock} st, {last} m
      WHERE st.stok_tarihi >= m.mx - 59 AND st.stok_tarihi <= m.mx AND st.stok_miktar > 0
        AND EXISTS (SELECT 1 FROM {pairs} p WHERE p.store_code = st.magaza AND p.stok_kodu = st.stok_kodu
                    AND p.product_id = st.product_id)
      GROUP BY 1, 2, 3) x
""")
    cte(f"{prefix}wm1", f"""
SELECT p.store_code, p.stok_kodu, p.product_id, coalesce(ss.weight_sales, so.weight_onhand) AS w,
       count(p.product_id) OVER (PARTITION BY p.store_code, p.stok_kodu) AS n,
       bool_or(coalesce(ss.weight_sales, so.weight_onhand) IS NOT NULL) OVER (PARTITION BY p.store_code, p.stok_kodu) AS anyw
FROM {pairs} p
LEFT JOIN {prefix}sales_share ss ON ss.store_code = p.store_code AND ss.stok_kodu = p.stok_kodu AND ss.product_id = p.product_id
LEFT JOIN {prefix}stock_share so ON so.store_code = p.store_code AND so.stok_kodu = p.stok_kodu AND so.product_id = p.product_id
""")
    cte(f"{prefix}wm2", f"SELECT *, CASE WHEN anyw THEN w ELSE 1.0 / NULLIF(n, 0) END AS w1 FROM {prefix}wm1")
    cte(f"{prefix}wm3", f"""
SELECT *, CASE WHEN coalesce(sum(w1) OVER (PARTITION BY store_code, stok_kodu), 0) = 0 THEN 1.0 / NULLIF(n, 0) ELSE w1 END AS w2
FROM {prefix}wm2
""")
    cte(f"{prefix}weight_map", f"""
SELECT store_code, stok_kodu, product_id, w2 / NULLIF(sum(w2) OVER (PARTITION BY store_code, stok_kodu), 0) AS weight FROM {prefix}wm3
""")


weight_ctes("", "repl_sales", "repl_max", "stock_agg", "product_pairs")
weight_ctes("local_", "local_sales", "local_max", "stock_all", "local_pairs")
weight_ctes("fused_", "all_sales", "all_max", "stock_all", "fused_weight_pairs")
ORACLES["variant_sales_share"] = build(f"""
SELECT store_code, stok_kodu, product_id, {r4('sales_90d', 'sales_90d')}, {r4('weight_sales', 'weight_sales')} FROM sales_share
""")
ORACLES["variant_weight_map"] = build(f"SELECT store_code, stok_kodu, product_id, {r4('weight', 'weight')} FROM weight_map")

# naive forecast stand-in, breakdown, week -> day
SEG4 = "product_att_01, product_att_02, product_att_05, store_cluster"
cte("wf_level", f"""
SELECT {SEG4}, avg(q) AS predicted_quantity
FROM (SELECT {SEG4}, greatest(CAST(total_quantity AS DOUBLE), 0.0) AS q,
             row_number() OVER (PARTITION BY {SEG4} ORDER BY week_start_date DESC, product_att_01_desc,
                                product_att_02_desc, product_att_05_desc) AS rn
      FROM weekly) x WHERE rn <= 4 GROUP BY ALL
""")
cte("weekly_forecast", f"""
SELECT {SEG4}, CAST((SELECT max(week_start_date) FROM weekly) + CAST(7 * h AS INTEGER) AS DATE) AS week_start_date,
       predicted_quantity
FROM wf_level, range(1, 13) t(h)
""")
cte("ratio_src", f"""
SELECT h.store_code, h.stok_kodu, coalesce(h.net_quantity, 0.0) AS net_quantity, c.store_cluster,
       st.product_att_01, TRY_CAST(translate(st.product_att_02, 'DN', '99') AS DOUBLE) AS product_att_02, st.product_att_05
FROM history_sales h
LEFT JOIN store_clustering c ON c.store_code = h.store_code
LEFT JOIN (SELECT DISTINCT product_code, product_att_01, product_att_02, product_att_05 FROM dim_product) st
       ON st.product_code = h.stok_kodu
WHERE h.date >= date_trunc('month', {AS_OF} - 56)::DATE AND coalesce(h.net_quantity, 0.0) >= 0
""")
cte("ratio", """
SELECT *, sum(net_quantity) OVER (PARTITION BY store_cluster, product_att_01, product_att_02, product_att_05) AS cluster_total,
       CASE WHEN sum(net_quantity) OVER (PARTITION BY store_cluster, product_att_01, product_att_02, product_att_05) > 0
            THEN net_quantity / sum(net_quantity) OVER (PARTITION BY store_cluster, product_att_01, product_att_02, product_att_05)
            ELSE 0.0 END AS store_ratio
FROM (SELECT CAST(store_cluster AS DOUBLE) AS store_cluster, CAST(product_att_01 AS DOUBLE) AS product_att_01,
             product_att_02, CAST(product_att_05 AS DOUBLE) AS product_att_05, store_code, stok_kodu,
             sum(net_quantity) AS net_quantity
      FROM ratio_src
      WHERE product_att_01 IS DISTINCT FROM 9 AND product_att_02 IS DISTINCT FROM 9
        AND store_cluster IS NOT NULL AND product_att_01 IS NOT NULL AND product_att_02 IS NOT NULL
        AND product_att_05 IS NOT NULL AND store_code IS NOT NULL AND stok_kodu IS NOT NULL
      GROUP BY ALL) g
""")
cte("breakdown", """
SELECT f.week_start_date, r.store_cluster, r.store_code, r.product_att_01, r.product_att_02, r.product_att_05, r.stok_kodu,
       f.predicted_quantity * r.store_ratio AS store_predicted_quantity, f.predicted_quantity, r.store_ratio
FROM (SELECT CAST(store_cluster AS DOUBLE) AS store_cluster, CAST(product_att_01 AS DOUBLE) AS product_att_01,
             CAST(product_att_02 AS DOUBLE) AS product_att_02, CAST(product_att_05 AS DOUBLE) AS product_att_05,
             week_start_date, predicted_quantity FROM weekly_forecast) f
JOIN ratio r ON r.store_cluster = f.store_cluster AND r.product_att_01 = f.product_att_01
            AND r.product_att_02 = f.product_att_02 AND r.product_att_05 = f.product_att_05
""")
cte("wl", """
SELECT *, CAST(CASE WHEN next_week_start - week_start_date <= 0 THEN 7 ELSE next_week_start - week_start_date END AS INTEGER) AS n_days
FROM (SELECT trim(store_code) AS store_code, trim(stok_kodu) AS stok_kodu, week_start_date,
             coalesce(store_predicted_quantity, 0.0) AS store_predicted_quantity,
             store_cluster, product_att_01, product_att_02, product_att_05,
             coalesce(lead(week_start_date) OVER (PARTITION BY trim(store_code), trim(stok_kodu)
                      ORDER BY week_start_date, store_cluster, product_att_01, product_att_02, product_att_05),
                      week_start_date + 7) AS next_week_start
      FROM breakdown) x
""")
cte("daily_pred", """
SELECT store_code, stok_kodu, CAST(week_start_date + CAST(o AS INTEGER) AS DATE) AS date,
       sum(store_predicted_quantity / n_days) AS prediction_store_daily
FROM (SELECT *, unnest(range(0, n_days)) AS o FROM wl) x GROUP BY 1, 2, 3
""")
ORACLES["store_ratio"] = build(f"""
SELECT store_cluster, product_att_01, product_att_02, product_att_05, store_code, stok_kodu,
       {r4('net_quantity', 'net_quantity')}, {r4('cluster_total', 'cluster_total')}, {r4('store_ratio', 'store_ratio')} FROM ratio
""")
ORACLES["breakdown_to_store"] = build(f"""
SELECT week_start_date, store_cluster, store_code, product_att_01, product_att_02, product_att_05, stok_kodu,
       {r4('store_predicted_quantity', 'store_predicted_quantity')}, {r4('predicted_quantity', 'predicted_quantity')},
       {r4('store_ratio', 'store_ratio')} FROM breakdown
""")
ORACLES["week_length"] = build(f"""
SELECT store_code, stok_kodu, week_start_date, {r4('store_predicted_quantity', 'store_predicted_quantity')},
       store_cluster, product_att_01, product_att_02, product_att_05, next_week_start, n_days FROM wl
""")
ORACLES["weekly_to_daily"] = build(f"SELECT store_code, stok_kodu, date, {r4('prediction_store_daily', 'prediction_store_daily')} FROM daily_pred")
ORACLES["store_sku_pairs"] = build("""
SELECT DISTINCT magaza, stok_kodu FROM (
  SELECT magaza, stok_kodu FROM sku_pairs
  UNION ALL
  SELECT d.store_code AS magaza, d.stok_kodu FROM daily_pred d, stock_max m
  WHERE d.date <= m.today + 29 AND coalesce(d.prediction_store_daily, 0.0) > 0.0) u
""")
def pred14_cte(prefix: str, last: str, drop_negative: bool) -> None:
    keep = "q >= 0 AND " if drop_negative else ""
    cte(f"{prefix}pred14", f"""
SELECT w.store_code, w.stok_kodu, w.product_id, coalesce(s.q * w.weight, 0.0) AS prediction_df
FROM (SELECT store_code, stok_kodu, sum(q) AS q
      FROM (SELECT store_code, stok_kodu, date, coalesce(prediction_store_daily, 0.0) AS q FROM daily_pred) d, {last} m
      WHERE {keep}d.date > m.mx AND d.date <= m.mx + 14 GROUP BY 1, 2) s
JOIN {prefix}weight_map w ON w.store_code = s.store_code AND w.stok_kodu = s.stok_kodu
WHERE w.product_id IS NOT NULL
""")


pred14_cte("", "repl_max", True)
pred14_cte("local_", "local_max", True)
pred14_cte("fused_", "all_max", False)
ORACLES["prediction_14d_by_product"] = build(f"SELECT store_code, stok_kodu, product_id, {r4('prediction_df', 'prediction_df')} FROM pred14")

# ---------------------------------------------------------------- step 5 oracles
LT_FACTOR = repr(2 / 14.0)

def job_ctes(prefix: str, sales: str, last: str, stock: str) -> None:
    cte(f"{prefix}on_hand", f"SELECT magaza AS store_code, product_id, arg_max(stok_miktar, stok_tarihi) AS stok_miktar FROM {stock} GROUP BY 1, 2")
    cte(f"{prefix}sales_win", f"""
SELECT s.product_id, s.store_code,
       greatest(coalesce(sum(CASE WHEN s.date >= m.mx - 6 THEN s.net_quantity END), 0.0), 0.0) AS net_quantity_7,
       greatest(coalesce(sum(CASE WHEN s.date >= m.mx - 13 THEN s.net_quantity END), 0.0), 0.0) AS net_quantity_14,
       greatest(coalesce(sum(s.net_quantity), 0.0), 0.0) AS net_quantity_28
FROM {sales} s, {last} m WHERE s.date >= m.mx - 27 AND s.date <= m.mx GROUP BY 1, 2
""")


job_ctes("", "repl_sales", "repl_max", "stock_agg")
job_ctes("local_", "local_sales", "local_max", "stock_all")
job_ctes("fused_", "all_sales", "all_max", "stock_all")
for _name, _src in (("local_safety", "local_stats"), ("fused_safety", "all_stats")):
    cte(_name, f"SELECT store_code, product_id, daily_avg, daily_std, {rnd_even(f'{SAFETY_K} * daily_std', 2)} AS safety_stock FROM {_src}")
# the local and fused generations take the extracted orders: one row per exit depot, missing parts count as 0 in fused
cte("exit_orders", """
SELECT urun_kodu AS product_id, cikis_depo_kodu AS store_code,
       sum(toplam_yoldaki_miktar) + sum(toplanmayan_urun) AS acik_siparis FROM stock_movement GROUP BY 1, 2
""")


def base_sql(prefix: str, pairs: str, safety: str, orders: str, integer_orders: bool) -> str:
    q = {n: f"CAST(trunc(greatest(coalesce(sw.net_quantity_{n}, 0.0), 0.0)) AS BIGINT)" for n in (7, 14, 28)}
    open_orders = "coalesce(oo.acik_siparis, 0.0)"
    open_orders = f"CAST(trunc({open_orders}) AS BIGINT)" if integer_orders else f"CAST({open_orders} AS DOUBLE)"
    return f"""
SELECT p.store_code, p.stok_kodu, p.product_id,
       coalesce(ss.safety_stock, 0.0) AS safety_stock,
       CAST(coalesce(pr.prediction_df, 0.0) AS DOUBLE) AS prediction_df,
       CAST(coalesce(oh.stok_miktar, 0) AS BIGINT) AS stok_miktar,
       {q[7]} AS net_quantity_7, {q[14]} AS net_quantity_14, {q[28]} AS net_quantity_28,
       ((CAST({q[7]} AS DOUBLE) / 7) * 0.5 + (CAST({q[14]} AS DOUBLE) / 14) * 0.3 + (CAST({q[28]} AS DOUBLE) / 28) * 0.2) * 14 AS prediction_ma,
       {open_orders} AS acik_siparis
FROM {pairs} p
LEFT JOIN {safety} ss ON ss.store_code = p.store_code AND ss.product_id = p.product_id
LEFT JOIN {prefix}pred14 pr ON pr.store_code = p.store_code AND pr.product_id = p.product_id
LEFT JOIN {prefix}on_hand oh ON oh.store_code = p.store_code AND oh.product_id = p.product_id
LEFT JOIN {prefix}sales_win sw ON sw.store_code = p.store_code AND sw.product_id = p.product_id
LEFT JOIN {orders} oo ON oo.store_code = p.store_code AND oo.product_id = p.product_id
"""


cte("base", base_sql("", "product_pairs", "safety_weighted", "open_orders", True))
cte("base_local", base_sql("local_", "local_pairs", "local_safety", "exit_orders", True))
cte("base_fused", base_sql("fused_", "fused_pairs", "fused_safety", "exit_orders", False))

MOMENTUM = ("least(greatest(coalesce(CAST(net_quantity_14 AS DOUBLE) / NULLIF(CAST(net_quantity_28 AS DOUBLE) / 2.0, 0.0), 1.0), 0.0), 2.0)")


def need_sql(src: str, prod: bool) -> str:
    if prod:
        w = f"""CASE WHEN net_quantity_7 < 4 THEN 0.0
                WHEN prediction_df <= 0 AND prediction_ma > 0 AND net_quantity_28 > 0 THEN 0.0
                WHEN prediction_ma <= 0 AND prediction_df > 0 THEN 1.0
                ELSE least(greatest(0.1 + 0.1 * ({MOMENTUM} - 1.0), 0.0), 0.2) END"""
    else:
        w = f"""CASE WHEN prediction_df <= 0 AND prediction_ma > 0 AND net_quantity_28 > 0 THEN 0.0
                WHEN prediction_ma <= 0 AND prediction_df > 0 THEN 1.0
                ELSE least(greatest(0.5 + 0.25 * ({MOMENTUM} - 1.0), 0.25), 0.75) END"""
    gap = "greatest(0.0, oul - (stok_miktar - pred_LT + acik_siparis))"
    if prod:
        need = f"CASE WHEN net_quantity_28 = 0 THEN 0 ELSE CAST(round_even({gap}, 0) AS BIGINT) END"
        ss = "CASE WHEN safety_stock > 1.15 * prediction_ma THEN safety_stock * 0.8 ELSE safety_stock END"
        df = "CASE WHEN prediction_df > net_quantity_14 THEN 0.0 ELSE prediction_df END"
        extra = ""
    else:
        need = f"CAST(ceil({gap}) AS BIGINT)"
        ss, df, extra = "safety_stock", "prediction_df", ", oul AS OUL_14"
    return f"""
SELECT store_code, stok_kodu, product_id, {ss} AS safety_stock, {df} AS prediction_df, stok_miktar,
       net_quantity_7, net_quantity_14, net_quantity_28, prediction_ma, acik_siparis, w_model, pred_14_blended, pred_LT,
       {need} AS ihtiyac_adet{extra}
FROM (SELECT *, pred_14_blended * {LT_FACTOR} AS pred_LT, safety_stock + pred_14_blended AS oul
      FROM (SELECT *, w_model * prediction_df + (1.0 - w_model) * prediction_ma AS pred_14_blended
            FROM (SELECT *, {w} AS w_model FROM {src}) a) b) c
"""


cte("need_prod", need_sql("base", True))
cte("need_local", need_sql("base_local", False))
cte("need_fused", need_sql("base_fused", False))

NEED_OUT = ["safety_stock", "prediction_df", "prediction_ma", "w_model", "pred_14_blended", "pred_LT"]
NEED_INT = "stok_miktar, net_quantity_7, net_quantity_14, net_quantity_28, ihtiyac_adet"


def need_select(src: str, extra: str = "", where: str = "", prefix: str = "", orders: str = "acik_siparis") -> str:
    cols = ", ".join(r4(c, c) for c in NEED_OUT)
    return f"SELECT {prefix}store_code, stok_kodu, product_id, {NEED_INT}, {orders}, {cols}{extra} FROM {src} {where}"


ORACLES["sales_7_14_28"] = build(f"""
SELECT product_id, store_code, {r4('net_quantity_7', 'net_quantity_7')}, {r4('net_quantity_14', 'net_quantity_14')},
       {r4('net_quantity_28', 'net_quantity_28')} FROM sales_win
""")
ORACLES["replenishment_base"] = build(f"""
SELECT store_code, stok_kodu, product_id, {r4('safety_stock', 'safety_stock')}, {r4('prediction_df', 'prediction_df')},
       stok_miktar, net_quantity_7, net_quantity_14, net_quantity_28, {r4('prediction_ma', 'prediction_ma')}, acik_siparis
FROM base
""")
ORACLES["blend_weight"] = build(f"""
SELECT store_code, product_id, {r4(MOMENTUM, 'momentum')}, {r4('w_model', 'w_model')} FROM need_prod
""")
ORACLES["replenishment_need_prod"] = build(need_select("need_prod"))
ORACLES["replenishment_need_local"] = build(need_select("need_local", extra=", " + r4("OUL_14", "OUL_14"), where="WHERE ihtiyac_adet > 0"))
ORACLES["replenishment_need_fused"] = build(need_select("need_fused", extra=", " + r4("OUL_14", "OUL_14"), orders=r4("acik_siparis", "acik_siparis")))
ORACLES["publish_replenishment"] = build(need_select("need_prod", where="WHERE ihtiyac_adet > 0", prefix=f"{AS_OF} AS model_date, "))
ORACLES["audit_zero_need"] = build("SELECT store_code, stok_kodu, product_id, ihtiyac_adet, net_quantity_28, stok_miktar FROM need_prod WHERE ihtiyac_adet <= 0")


def alloc_ctes(name: str, needs_sql: str, stock_sql: str) -> None:
    cte(f"{name}_n", f"SELECT CAST(store_code AS VARCHAR) AS store, CAST(product_id AS VARCHAR) AS product, CAST(ihtiyac_adet AS BIGINT) AS need FROM ({needs_sql}) x WHERE ihtiyac_adet > 0 AND product_id IS NOT NULL")
    cte(f"{name}_w", f"""
SELECT warehouse, product, qty, cap, hi, hi - cap AS lo
FROM (SELECT *, CAST(ceil(qty) AS BIGINT) AS cap,
             CAST(sum(CAST(ceil(qty) AS BIGINT)) OVER (PARTITION BY product ORDER BY warehouse ROWS UNBOUNDED PRECEDING) AS BIGINT) AS hi
      FROM (SELECT CAST(alt_yer AS VARCHAR) AS warehouse, CAST(product_id AS VARCHAR) AS product, sum(CAST(miktar AS DOUBLE)) AS qty
            FROM ({stock_sql}) s WHERE miktar > 0 GROUP BY 1, 2) a) b
""")
    cte(f"{name}_s", f"SELECT product, CAST(sum(cap) AS BIGINT) AS s FROM {name}_w GROUP BY 1")
    cte(f"{name}_u", f"""
SELECT product, store, need, r, row_number() OVER (PARTITION BY product ORDER BY r, pos) AS k
FROM (SELECT *, unnest(range(1, least(need, s) + 1)) AS r
      FROM (SELECT n.*, st.s, row_number() OVER (PARTITION BY n.product ORDER BY n.need DESC, n.store) AS pos
            FROM {name}_n n JOIN {name}_s st ON st.product = n.product) p) q
""")
    cte(f"{name}_p", f"""
SELECT u.product, w.warehouse, u.store, count(*) AS shipped, min(u.r) AS first_round, max(u.need) AS need, max(w.qty) AS opening
FROM {name}_u u JOIN {name}_w w ON w.product = u.product AND u.k > w.lo AND u.k <= w.hi
GROUP BY 1, 2, 3
""")
    cte(name, f"""
SELECT warehouse AS gonderen_depo, store AS alan_magaza, product AS urun, CAST(opening AS DOUBLE) AS baslangic_depo_stok,
       CAST(need - first_round + 1 AS BIGINT) AS ihtiyac_adet, CAST(shipped AS BIGINT) AS karsilanan_adet,
       CAST(need - first_round + 1 - shipped AS BIGINT) AS kalan_ihtiyac,
       CAST(sum(shipped) OVER (PARTITION BY product, warehouse) AS BIGINT) AS depo_sevk_toplam,
       CAST(opening - sum(shipped) OVER (PARTITION BY product, warehouse) AS DOUBLE) AS depo_kalan_nihai
FROM {name}_p
UNION ALL
SELECT 'STOK_YOK', store, product, 0.0, need, 0, need, 0, 0.0
FROM {name}_n WHERE product NOT IN (SELECT product FROM {name}_s)
""")


alloc_ctes("dense_alloc", "SELECT * FROM dense_need", "SELECT * FROM dense_stock")
alloc_ctes("sku_alloc", "SELECT * FROM need_prod", "SELECT * FROM warehouse_stock")

DIST_COLS = ("gonderen_depo, alan_magaza, urun, ihtiyac_adet, karsilanan_adet, kalan_ihtiyac, depo_sevk_toplam, "
             + r4("baslangic_depo_stok", "baslangic_depo_stok") + ", " + r4("depo_kalan_nihai", "depo_kalan_nihai"))
ORACLES["warehouse_distribution"] = build(f"SELECT {DIST_COLS} FROM dense_alloc")
ORACLES["warehouse_stockouts"] = build(f"SELECT {DIST_COLS} FROM dense_alloc WHERE gonderen_depo = 'STOK_YOK'")
ORACLES["publish_distribution"] = build(f"SELECT {AS_OF} AS model_date, {DIST_COLS} FROM sku_alloc")
ORACLES["fulfilment_summary"] = build(f"""
SELECT CAST(sum(ihtiyac_adet) AS BIGINT) AS total_need, CAST(sum(karsilanan_adet) AS BIGINT) AS total_shipped,
       CAST(sum(kalan_ihtiyac) AS BIGINT) AS total_unmet,
       {r4('CAST(sum(karsilanan_adet) AS DOUBLE) / NULLIF(CAST(sum(ihtiyac_adet) AS DOUBLE), 0)', 'fill_rate')}
FROM dense_alloc
""")
ORACLES["fulfilment_by_warehouse"] = build("""
SELECT gonderen_depo, CAST(sum(ihtiyac_adet) AS BIGINT) AS ihtiyac_adet, CAST(sum(karsilanan_adet) AS BIGINT) AS karsilanan_adet
FROM dense_alloc GROUP BY 1
""")
ORACLES["fulfilment_by_warehouse_sku"] = build("""
SELECT gonderen_depo, CAST(sum(ihtiyac_adet) AS BIGINT) AS ihtiyac_adet, CAST(sum(karsilanan_adet) AS BIGINT) AS karsilanan_adet
FROM sku_alloc GROUP BY 1
""")
ORACLES["audit_distribution_product"] = build(f"SELECT {DIST_COLS} FROM dense_alloc WHERE urun = 'Brand#3' AND gonderen_depo = '900101'")
ORACLES["audit_distribution_after"] = build(f"SELECT {DIST_COLS} FROM dense_alloc WHERE urun > 'Brand#3' AND gonderen_depo <> '900101'")
ORACLES["edge_rename"] = build("SELECT from_warehouse, to_store, product_id, need_qty, shipped_qty, remaining_need_qty, "
    f"warehouse_shipped_qty, {r4('warehouse_opening_qty', 'warehouse_opening_qty')}, {r4('warehouse_closing_qty', 'warehouse_closing_qty')} "
    "FROM (SELECT gonderen_depo AS from_warehouse, alan_magaza AS to_store, urun AS product_id, baslangic_depo_stok AS warehouse_opening_qty, "
    "ihtiyac_adet AS need_qty, karsilanan_adet AS shipped_qty, kalan_ihtiyac AS remaining_need_qty, "
    "depo_sevk_toplam AS warehouse_shipped_qty, depo_kalan_nihai AS warehouse_closing_qty FROM dense_alloc) x")
ORACLES["audit_first_sale"] = build("SELECT product_id, min(date) AS first_date FROM history_sales GROUP BY 1")
ORACLES["audit_daily_sample"] = build(f"""
SELECT date, store_code, product_id, {r4('sum(discount_amount)', 'discount_amount')},
       {r4('sum(net_amount_wovat)', 'net_amount_wovat')}, {r4('sum(net_quantity)', 'net_quantity')},
       {r4('sum(net_amount_wovat) / NULLIF(sum(net_quantity), 0)', 'unit_price')}
FROM history_sales WHERE date >= date_trunc('month', {AS_OF} - INTERVAL 24 MONTH)::DATE
GROUP BY 1, 2, 3 ORDER BY date, store_code, product_id LIMIT 10
""")
cte("hs14", "SELECT h.* FROM history_sales h, (SELECT max(date) AS mx FROM history_sales) m WHERE h.date >= m.mx - 13 AND h.date <= m.mx")
ORACLES["audit_14d_point"] = build(f"SELECT product_id, store_code, {r4('sum(net_quantity)', 'net_quantity')} FROM hs14 GROUP BY 1, 2")
ORACLES["audit_14d_daily"] = build(f"SELECT product_id, store_code, date, {r4('sum(net_quantity)', 'net_quantity_14')} FROM hs14 GROUP BY 1, 2, 3")

# ---------------------------------------------------------------- step 6 oracles
FEATURE_COLS = (["unit_price_mean", "unit_price_median", "discount_frac_mean", "discount_frac_wavg", "week_of_year"]
                + [f"{c}_{s}" for c in ["discount_frac_wavg", "discount_frac_mean", "unit_price_mean", "unit_price_median"]
                   for s in ("l1", "ma4_l1")]
                + ["total_quantity_last_year"]
                + [f"total_quantity_shifted_{k}" for k in FeatureSpec().lag_set()]
                + [f"pct_change_{d}" for d in FeatureSpec().pct_diffs]
                + [f"{a}_total_quantity_roll{n}_shift{s}" for s, ws in FeatureSpec().rolls.items() for n in ws
                   for a in ("min", "mean", "max")]
                + ["segment_mean", "month", "ramazan_bayrami", "kurban_bayrami", "kara_cuma", "is_special_day"])
FROZEN_COLS = [c for c in FEATURE_COLS if c not in ("month", "week_of_year", "ramazan_bayrami", "kurban_bayrami",
                                                     "kara_cuma", "is_special_day")]
cte("model_frame", "SELECT * FROM features f LEFT JOIN (SELECT week_start_date AS cw_week, month, ramazan_bayrami, "
    "kurban_bayrami, kara_cuma, CAST(coalesce(tag, 'YOK') <> 'YOK' AS INTEGER) AS is_special_day FROM calendar_weekly) cw "
    "ON cw.cw_week = f.week_start_date")
cte("frame_last", f"SELECT {SEG4}, " + ", ".join(
    f"arg_max({c}, week_start_date) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in FROZEN_COLS)
    + " FROM model_frame GROUP BY ALL")
cte("future_grid", f"""
SELECT {SEG4}, CAST((SELECT max(week_start_date) FROM model_frame) + CAST(7 * h AS INTEGER) AS DATE) AS week_start_date
FROM (SELECT DISTINCT {SEG4} FROM model_frame) s, range(1, 13) t(h)
""")


def _out(c: str) -> str:
    # rolling min/max and lags are integers; everything else is a double
    if c.startswith(("min_", "max_")) or c.startswith("total_quantity_") or c == "week_of_year":
        return c
    return r4(c, c)


ORACLES["future_grid"] = build("SELECT * FROM future_grid")
ORACLES["last_observed_features"] = build(f"SELECT {SEG4}, " + ", ".join(_out(c) for c in FROZEN_COLS) + " FROM frame_last")
ORACLES["future_features"] = build(f"""
SELECT g.product_att_01, g.product_att_02, g.product_att_05, g.store_cluster, g.week_start_date,
       {', '.join(f'l.{c} AS {c}' if _out(c) == c else r4(f'l.{c}', c) for c in FROZEN_COLS)},
       CAST(month(g.week_start_date) AS INTEGER) AS month, CAST(weekofyear(g.week_start_date) AS INTEGER) AS week_of_year,
       0 AS ramazan_bayrami, 0 AS kurban_bayrami, 0 AS kara_cuma, 0 AS is_special_day
FROM future_grid g LEFT JOIN frame_last l ON l.product_att_01 = g.product_att_01 AND l.product_att_02 = g.product_att_02
 AND l.product_att_05 = g.product_att_05 AND l.store_cluster = g.store_cluster
""")

# ---------------------------------------------------------------- step 7 oracles
ORACLES["extract_sales_12m"] = build(f"""
SELECT {HS_COLS}, {r4('net_quantity', 'net_quantity')}, {r4('discount_amount', 'discount_amount')},
       {r4('net_amount_wovat', 'net_amount_wovat')}, {r4('unit_price', 'unit_price')}, strftime(date, '%Y-%m') AS month
FROM history_sales WHERE date >= date_trunc('month', {AS_OF} - INTERVAL 12 MONTH)::DATE
""")
ORACLES["sink_parquet_roundtrip"] = ORACLES["weekly_segment_sales"]
ORACLES["sink_csv_formatted"] = build(f"""
SELECT week_start_date, store_code, stok_kodu,
       {r4("round(CAST(store_predicted_quantity AS DECIMAL(38,10)), 6)", 'store_predicted_quantity')},
       {r4("round(CAST(store_ratio AS DECIMAL(38,10)), 6)", 'store_ratio')} FROM breakdown
""")
ORACLES["land_raw_text"] = build("""
SELECT CAST(date AS VARCHAR) AS "Satış_Tarihi", store_code AS "Mağaza_Kodu", product_id AS "_1_Ürün_ID",
       CAST(net_quantity AS VARCHAR) AS "Net_Adet____", stok_kodu AS "net_adet____tutar" FROM history_sales
""")
ORACLES["extract_store_stock"] = build(f"""
SELECT stok_tarihi, magaza, stok_kodu, color_code, size, product_id, {r4('toplam_miktar', 'toplam_miktar')} FROM store_stock
""")
ORACLES["extract_warehouse_stock"] = build("SELECT alt_yer, product_id, miktar FROM warehouse_stock")
ORACLES["forecast_12w_rows"] = build("SELECT *, TRUE AS valid FROM future_grid")
ORACLES["weekly_forecast_job"] = build("SELECT store_code, stok_kodu, date, TRUE AS valid FROM daily_pred")
ORACLES["segment_mean_expanding"] = build(f"""
SELECT {KEYS_OUT}, total_quantity,
       {r4(f'avg(total_quantity) OVER ({SEG_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)', 'segment_mean')} FROM weekly_z
""")
ORACLES["dense_weeks"] = build(f"""
SELECT s.* EXCLUDE (lo, hi), coalesce(w.total_quantity, 0) AS total_quantity
FROM (SELECT *, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week_start_date
      FROM (SELECT {SEG}, product_att_01_desc, product_att_02_desc, product_att_05_desc, min(week_start_date) AS lo, max(week_start_date) AS hi
            FROM weekly GROUP BY ALL) x) s
LEFT JOIN weekly w USING ({SEG}, product_att_01_desc, product_att_02_desc, product_att_05_desc, week_start_date)
""")
# the local weekly table: raw rows, calendar weeks, truncated totals, clipped prices, plain-mean fallback
ORACLES["weekly_segment_sales_local"] = build(f"""
SELECT {WEEKLY_KEYS}, CAST(trunc(sum(q)) AS BIGINT) AS total_quantity, {r4('avg(price)', 'unit_price_mean')},
       {r4('median(price)', 'unit_price_median')}, {r4('avg(f)', 'discount_frac_mean')},
       {r4('CASE WHEN sum(d) > 0 THEN sum(f * d) / sum(d) ELSE avg(f) END', 'discount_frac_wavg')}
FROM (SELECT p.product_att_01, TRY_CAST(translate(p.product_att_02, 'DN', '99') AS DOUBLE) AS product_att_02, p.product_att_05,
             p.product_att_01_desc, p.product_att_02_desc, p.product_att_05_desc, c.store_cluster,
             date_trunc('week', k.date)::DATE AS week_start_date, coalesce(h.net_quantity, 0.0) AS q, greatest(h.unit_price, 0.0) AS price,
             coalesce(h.discount_amount, 0) + coalesce(h.net_amount_wovat, 0) AS d,
             least(greatest(CASE WHEN coalesce(h.discount_amount, 0) + coalesce(h.net_amount_wovat, 0) > 0
               THEN coalesce(h.discount_amount, 0) / (coalesce(h.discount_amount, 0) + coalesce(h.net_amount_wovat, 0)) ELSE 0.0 END, 0.0), 0.9) AS f
      FROM history_sales h JOIN dim_product p ON p.product_id = h.product_id
      JOIN store_clustering c ON c.store_code = h.store_code JOIN dim_calendar k ON k.date = h.date) x
WHERE product_att_01 IS DISTINCT FROM 9 AND product_att_02 IS DISTINCT FROM 9 AND product_att_01 IS NOT NULL
  AND product_att_02 IS NOT NULL AND product_att_05 IS NOT NULL AND product_att_01_desc IS NOT NULL
  AND product_att_02_desc IS NOT NULL AND product_att_05_desc IS NOT NULL
GROUP BY ALL
""")

# ---------------------------------------------------------------- step 8 oracles
ORACLES["land_raw_files"] = build("""
SELECT CAST(date AS VARCHAR) AS "Satış_Tarihi", store_code AS "Mağaza_Kodu", product_id AS "_1_Ürün_ID",
       CASE WHEN store_code <= '2599' THEN CAST(net_quantity AS VARCHAR) END AS "Net_Adet____" FROM history_sales
""")
ORACLES["src_csv_rejects"] = f"""
WITH r AS (
  SELECT CASE WHEN l_orderkey % 101 = 2 THEN 5 WHEN l_orderkey % 103 = 3 THEN 2 ELSE 4 END AS n,
         l_orderkey % 97 = 0 AS no_amount, l_orderkey % 89 = 1 AS no_day, round(l_extendedprice, 2) AS amount FROM lineitem),
o AS (
  SELECT concat_ws('; ', CASE WHEN n <> 4 THEN n || ' of 4 fields' END,
                   CASE WHEN n > 2 AND (no_amount OR no_day) THEN 'not readable: ' ||
                     concat_ws(', ', CASE WHEN no_amount THEN 'l_extendedprice' END, CASE WHEN no_day THEN 'l_shipdate' END) END) AS reason, amount FROM r)
SELECT CASE WHEN reason = '' THEN 'accepted' ELSE reason END AS outcome, count(*) AS records,
       {r4("CASE WHEN reason = '' THEN sum(amount) END", 'amount')}
FROM o GROUP BY reason
"""
ORACLES["extract_sales_incremental"] = ORACLES["extract_sales_12m"]
ORACLES["fulfilment_levels"] = build(f"""
SELECT CASE grouping(gonderen_depo, urun) WHEN 0 THEN 'both' WHEN 1 THEN 'warehouse' WHEN 2 THEN 'product' ELSE 'all' END AS level,
       gonderen_depo, urun, count(*) AS rows, CAST(sum(ihtiyac_adet) AS BIGINT) AS total_need, CAST(sum(karsilanan_adet) AS BIGINT) AS total_shipped,
       CAST(sum(kalan_ihtiyac) AS BIGINT) AS total_unmet,
       {r4('CAST(sum(karsilanan_adet) AS DOUBLE) / NULLIF(CAST(sum(ihtiyac_adet) AS DOUBLE), 0)', 'fill_rate')}
FROM dense_alloc GROUP BY GROUPING SETS ((), (gonderen_depo), (urun), (gonderen_depo, urun))
""")
ORACLES["store_share"] = build(f"""
SELECT {KEYS_OUT}, total_quantity,
       {r4('CAST(total_quantity AS DOUBLE) / NULLIF(sum(total_quantity) OVER (PARTITION BY store_cluster, week_start_date), 0)', 'store_product_share')}
FROM weekly
""")
cte("weekly_sums", f"SELECT {SEG4}, week_start_date, sum(total_quantity) AS q FROM weekly_z GROUP BY ALL")
_SAME_SEG = " AND ".join(f"{{0}}.{c} = w.{c}" for c in ("product_att_01", "product_att_02", "product_att_05", "store_cluster"))
ORACLES["yoy_growth"] = build(f"""
SELECT {', '.join('w.' + c.strip() for c in KEYS_OUT.split(','))}, w.total_quantity, {r4('a.q', 'quantity_back')}, {r4('b.q', 'quantity_year_before')},
       {r4('(CAST(a.q AS DOUBLE) - b.q) / CASE WHEN b.q = 0 THEN 1e-5 ELSE b.q END', 'yoy_growth')}
FROM weekly_z w LEFT JOIN weekly_sums a ON {_SAME_SEG.format('a')} AND a.week_start_date = w.week_start_date - 7
LEFT JOIN weekly_sums b ON {_SAME_SEG.format('b')} AND b.week_start_date = w.week_start_date - 371
""")
ORACLES["sketch_ranges"] = build("""
SELECT strftime(e, '%Y-%m') AS range_end, count(unit_price) AS n, TRUE AS quantile_ok, count(DISTINCT store_code) AS store_code,
       count(DISTINCT product_id) AS product_id, TRUE AS store_code_ok, TRUE AS product_id_ok
FROM (SELECT DISTINCT date_trunc('month', date)::DATE AS e FROM history_sales) m
JOIN history_sales h ON h.date < m.e + INTERVAL 1 MONTH AND h.date >= m.e - INTERVAL 2 MONTH
GROUP BY e
""")
ORACLES["demand_features_incremental"] = "SELECT * FROM (" + ORACLES["demand_features"] + ") f WHERE week_start_date = (SELECT date_trunc('week', max(l_shipdate))::DATE FROM lineitem)"
ORACLES["audit_forecast_conservation"] = build(f"""
SELECT g.*, coalesce(n, 0) AS n_pairs, TRUE AS stores_ok, TRUE AS days_ok
FROM (SELECT CAST(store_cluster AS DOUBLE) AS store_cluster, CAST(product_att_01 AS DOUBLE) AS product_att_01, CAST(product_att_02 AS DOUBLE) AS product_att_02,
             CAST(product_att_05 AS DOUBLE) AS product_att_05, count(*) AS n_weeks FROM future_grid GROUP BY ALL) g
LEFT JOIN (SELECT store_cluster, product_att_01, product_att_02, product_att_05, count(DISTINCT store_code || ' ' || stok_kodu) AS n FROM breakdown GROUP BY ALL) b
  ON b.store_cluster = g.store_cluster AND b.product_att_01 = g.product_att_01 AND b.product_att_02 = g.product_att_02 AND b.product_att_05 = g.product_att_05
""")
