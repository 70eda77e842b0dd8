import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import need, weights
from shelfcast.profiles import LOCAL, PROD

END = dt.date(2001, 11, 4)


def test_weight_map_rules(spark):
    pairs = spark.createDataFrame([
        ("1", "A", "a1"), ("1", "A", "a2"),          # sales shares
        ("1", "B", "b1"), ("1", "B", "b2"),          # stock shares only
        ("1", "C", "c1"), ("1", "C", "c2"), ("1", "C", "c3"),   # neither -> 1/n
        ("1", "D", "d1"), ("1", "D", "d2"),          # d1 sales, d2 nothing -> d2 stays null
    ], "store_code string, stok_kodu string, product_id string")
    sales = spark.createDataFrame([
        (END, "1", "a1", "A", 3.0), (END, "1", "a2", "A", 1.0), (END, "1", "d1", "D", 2.0)],
        "date date, store_code string, product_id string, stok_kodu string, net_quantity double")
    stock = spark.createDataFrame([(END, "1", "B", "b1", 1), (END, "1", "B", "b2", 3)],
                                  "stok_tarihi date, magaza string, stok_kodu string, product_id string, stok_miktar long")
    w = {r["product_id"]: r["weight"] for r in weights.variant_weight_map(sales, stock, pairs, F.lit(END)).collect()}
    assert w["a1"] == 0.75 and w["a2"] == 0.25
    assert w["b1"] == 0.25 and w["b2"] == 0.75
    assert abs(w["c1"] - 1 / 3) < 1e-12
    assert w["d1"] == 1.0 and w["d2"] is None


def _tasks(df):
    """How many tasks the last step's rows come from."""
    return df.select(F.spark_partition_id().alias("t")).distinct().count()


def test_universe_rows_are_not_merged_into_one_task(spark):
    """AQE would put the universe, whose keys compress well, into one task of the semi-join and of the windows."""
    from shelfcast.operators import universe
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    key = [F.concat(F.lit("s"), F.col("id") % 7).alias("store_code"), F.concat(F.lit("A"), F.col("id") % 5).alias("stok_kodu"),
           F.col("id").cast("string").alias("product_id")]
    pairs = spark.range(2000).select(*key)
    sales = spark.range(3000).select(F.lit(END).alias("date"), *key, F.lit(1.0).alias("net_quantity"))
    stock = spark.range(0).select(F.lit(END).alias("stok_tarihi"), key[0].alias("magaza"), *key[1:], F.lit(1).alias("stok_miktar"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        met = universe.pairs_semi_join(sales, pairs)
        assert met.count() == 2000 and _tasks(met) == 4
        share = weights.variant_sales_share(sales, pairs, F.lit(END))
        assert _tasks(share) == 4
        w = weights.variant_weight_map(sales, stock, pairs, F.lit(END))
        assert _tasks(w) == 4 and abs(w.agg(F.sum("weight")).first()[0] - 35) < 1e-9
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_weight_map_reads_the_universe_once(spark):
    """The shares are those of the two operators, also with sales and stock beyond the universe, from one pass over it."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "store_code string, stok_kodu string, product_id string"
    universe_rows = [(str(s), f"A{a}", f"{a}-{v}") for s in range(3) for a in range(4) for v in range(5)] + [("9", "none", None)]
    pairs = spark.createDataFrame(universe_rows, schema)
    key = [F.concat(F.lit(""), F.col("id") % 4).alias("store_code"), F.concat(F.lit("A"), F.col("id") % 3).alias("stok_kodu"),
           F.concat_ws("-", F.col("id") % 3, F.col("id") % 7).alias("product_id")]
    sales = spark.range(60).select(F.date_sub(F.lit(END), (F.col("id") % 120).cast("int")).alias("date"), *key, (F.col("id") % 4).cast("double").alias("net_quantity"))
    sales = sales.unionByName(spark.createDataFrame([(END, "9", "none", None, 5.0)], "date date, store_code string, stok_kodu string, product_id string, net_quantity double"))
    stock = spark.range(90).select(F.date_sub(F.lit(END), (F.col("id") % 80).cast("int")).alias("stok_tarihi"), key[0].alias("magaza"), *key[1:], (F.col("id") % 5).alias("stok_miktar"))
    got = {tuple(r)[:3]: r.weight for r in weights.variant_weight_map(sales, stock, pairs.mapInArrow(counted, schema), F.lit(END)).collect()}
    assert set(got) == set(universe_rows) and len(got) == len(universe_rows)
    by_sales = {tuple(r)[:3]: r.weight_sales for r in weights.variant_sales_share(sales, pairs, F.lit(END)).collect()}
    by_stock = {tuple(r)[:3]: r.weight_onhand for r in weights.variant_stock_share(stock, pairs, F.lit(END)).collect()}
    assert by_sales and set(by_stock) - set(by_sales) and set(by_sales) | set(by_stock) < set(universe_rows)
    for group in {k[:2] for k in got}:
        of = [k for k in got if k[:2] == group]
        first = {k: by_sales.get(k, by_stock.get(k)) for k in of}
        n = sum(k[2] is not None for k in of)
        if all(v is None for v in first.values()) or not sum(v or 0.0 for v in first.values()):
            first = {k: 1 / n if n else None for k in of}
        total = sum(v or 0.0 for v in first.values())
        assert all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v / total) < 1e-12) for k, v in first.items())
    assert read.value == len(universe_rows)


def _base(spark, rows):
    return spark.createDataFrame(rows, "store_code string, stok_kodu string, product_id string, safety_stock double, "
                                       "prediction_df double, stok_miktar long, net_quantity_7 long, net_quantity_14 long, "
                                       "net_quantity_28 long, prediction_ma double, acik_siparis long")


def test_need_rules(spark):
    rows = [
        ("1", "S", "p_q28_zero", 0.0, 10.0, 0, 0, 0, 0, 0.0, 0),          # prod: no sales in 28 days -> 0
        ("1", "S", "p_q7_3", 0.0, 14.0, 0, 3, 7, 14, 7.0, 0),              # q7 < 4 -> w 0
        ("1", "S", "p_q7_4", 0.0, 14.0, 0, 4, 7, 14, 7.0, 0),
        ("1", "S", "p_ma0", 0.0, 3.0, 0, 0, 0, 1, 0.0, 0),                # MA 0, DF > 0 -> w 1 (prod: q7 rule wins)
    ]
    prod = {r["product_id"]: r for r in need.need_with_14day_coverage(_base(spark, rows), PROD).collect()}
    assert prod["p_q28_zero"]["ihtiyac_adet"] == 0
    assert prod["p_q7_3"]["w_model"] == 0.0
    assert abs(prod["p_q7_4"]["w_model"] - 0.1) < 1e-12           # momentum 1 -> 0.1
    loc = {r["product_id"]: r for r in need.need_with_14day_coverage(_base(spark, rows), LOCAL).collect()}
    assert loc["p_ma0"]["w_model"] == 1.0
    # local: no zero rule; w = 1 -> blend 10, lead-time demand 10 * 2 / 14, gap 11.43 -> ceil 12
    assert loc["p_q28_zero"]["ihtiyac_adet"] == 12 and "OUL_14" in loc["p_q28_zero"].asDict()


def test_need_rounding_half_even_vs_ceil(spark):
    # gap = OUL - (onhand - LT + open) with blend 0: gap = safety stock
    rows = [("1", "S", f"p{x}", x, 0.0, 0, 0, 0, 0, 0.0, 0) for x in (0.5, 1.5, 2.5, 3.4999999999999996, 2.50000000000001)]
    pf = PROD.with_(zero_need_without_sales=False)
    got = {r["product_id"]: r["ihtiyac_adet"] for r in need.need_with_14day_coverage(_base(spark, rows), pf).collect()}
    assert got == {"p0.5": 0, "p1.5": 2, "p2.5": 2, "p3.4999999999999996": 3, "p2.50000000000001": 3}
    got = {r["product_id"]: r["ihtiyac_adet"] for r in need.need_with_14day_coverage(_base(spark, rows), LOCAL).collect()}
    assert got == {"p0.5": 1, "p1.5": 2, "p2.5": 3, "p3.4999999999999996": 4, "p2.50000000000001": 3}


def test_variants_are_distinct_without_holding_the_expansion(spark):
    """an aggregate over the joined rows held every variant of every store in one task."""
    from shelfcast.operators import universe
    pairs = spark.createDataFrame([("1", "A"), ("2", "A"), ("1", "A"), ("1", "Z"), ("2", None)], "magaza string, stok_kodu string")
    product = spark.createDataFrame([("A", "a1"), ("A", "a2"), ("A", "a1"), ("B", "b1"), ("A", None)], "product_code string, product_id string")
    out = universe.style_to_variants(pairs, product, only_active=False)
    want = {("1", "A", "a1"), ("1", "A", "a2"), ("1", "A", None), ("2", "A", "a1"), ("2", "A", "a2"), ("2", "A", None), ("1", "Z", None), ("2", None, None)}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan[:plan.index("Join")]
