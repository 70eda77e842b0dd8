"""Warehouse stock allocation (H9) as joins, windows and generators -- no loop.

Semantics (per product): stores queue by need, largest first (ties by store code);
the head store takes ONE unit from the head warehouse and rejoins the back of the
queue while it still needs more; a warehouse is used until empty, then the next
(warehouses in code order).  That queue is round-robin, so the k-th unit handed
out goes to a closed-form slot:

* a store at queue position ``pos`` receives its r-th unit in round r;
* every store ahead of it in the queue needs at least as much, so it is still in
  round r: the unit number is ``U(r) + pos`` where ``U(r) = sum_j min(need_j, r-1)``
  is the number of units handed out in earlier rounds;
* warehouse w covers unit numbers (lo_w, hi_w] of the running sum of its units.

Plan: an ordered sweep over each product's units.  The number of stores still queued in each round
comes from two +-1 events per store (a difference array), so ``U(r)`` is piecewise linear in r.  Its
segments and the warehouse boundaries are merged in one ordered pass; the segment before a boundary
inverts U there: the round of the x-th unit and the units handed out before that round.

The stores that one warehouse serves are then at most two ranges of queue positions, because the
stores of a round are a prefix of the queue: the rest of the round in which the warehouse begins, and the
stores of the next rounds (the first of them has the longest prefix), or of its last round up to
its last unit.  Only those positions are generated, so the rows that meet the stores are exactly the rows of
the result, however many stores and warehouses a product has and however large the quantities.
A store at ``pos`` that needs ``need`` has received ``min(need, R - 1)`` units after x units, plus one if it
takes part in round R at or before the x-th unit; a warehouse ships it the difference between its two
boundaries, and ships ``hi - lo`` in all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

NO_STOCK = "STOK_YOK"


def _prepare(needs: DataFrame, warehouse_stock: DataFrame, store_col: str, product_col: str, need_col: str,
             warehouse_col: str, warehouse_qty_col: str) -> tuple[DataFrame, DataFrame]:
    n = needs.select(F.col(store_col).cast("string").alias("store"), F.col(product_col).cast("string").alias("product"),
                     F.col(need_col).cast("long").alias("need"))
    n = n.filter((F.col("need") > 0) & F.col("product").isNotNull())
    w = warehouse_stock.select(F.col(warehouse_col).cast("string").alias("warehouse"),
                               F.col(product_col).cast("string").alias("product"),
                               F.col(warehouse_qty_col).cast("double").alias("qty"))
    # duplicate (warehouse, product) rows are summed before allocation
    w = w.filter(F.col("qty") > 0).groupBy("warehouse", "product").agg(F.sum("qty").alias("qty"))
    return n, w


def distribute_warehouse_stock(replenishment_needs: DataFrame, warehouse_stock: DataFrame,
                               store_col: str = "store_code", product_col: str = "product_id",
                               need_col: str = "ihtiyac_adet", warehouse_col: str = "alt_yer",
                               warehouse_qty_col: str = "miktar", include_unserved: bool = False,
                               materialize_inputs: bool = True) -> DataFrame:
    n, w = _prepare(replenishment_needs, warehouse_stock, store_col, product_col, need_col,
                    warehouse_col, warehouse_qty_col)
    if materialize_inputs:
        # both inputs feed several branches; written once they are read, not recomputed
        n, w = materialize(n, "alloc-needs"), materialize(w, "alloc-stock")

    # warehouse unit intervals per product (a warehouse with 2.5 units serves 3)
    w = w.withColumn("cap", F.ceil("qty").cast("long"))
    by_wh = Window.partitionBy("product").orderBy("warehouse").rowsBetween(Window.unboundedPreceding, 0)
    w = w.withColumn("hi", F.sum("cap").over(by_wh)).withColumn("lo", F.col("hi") - F.col("cap"))
    stock = w.groupBy("product").agg(F.sum("cap").alias("stock_units"))

    # queue position per product (a group bounded by the number of stores)
    pos = F.row_number().over(Window.partitionBy("product").orderBy(F.col("need").desc(), F.col("store")))
    n = n.withColumn("pos", pos)
    served_products = n.join(stock, "product", "inner")
    demand = served_products.groupBy("product").agg(F.sum("need").alias("total_need"))

    pairs = served_pairs(_served_positions(_segments(served_products), w.join(demand, "product")), n)
    ihtiyac = F.col("need") - F.col("had")
    out = pairs.select(
        F.col("warehouse").alias("gonderen_depo"), F.col("store").alias("alan_magaza"), F.col("product").alias("urun"),
        F.col("baslangic_depo_stok").cast("double").alias("baslangic_depo_stok"),
        ihtiyac.cast("long").alias("ihtiyac_adet"),
        F.col("karsilanan_adet").cast("long").alias("karsilanan_adet"),
        (ihtiyac - F.col("karsilanan_adet")).cast("long").alias("kalan_ihtiyac"),
        F.col("depo_sevk_toplam").cast("long").alias("depo_sevk_toplam"),
        (F.col("baslangic_depo_stok") - F.col("depo_sevk_toplam")).cast("double").alias("depo_kalan_nihai"))

    stockouts = stock_outs(n, stock)
    out = out.unionByName(stockouts)
    if include_unserved:
        served = out.select(F.col("alan_magaza").alias("store"), F.col("urun").alias("product")).distinct()
        missing = served_products.join(served, ["store", "product"], "left_anti")
        out = out.unionByName(missing.select(
            F.lit(None).cast("string").alias("gonderen_depo"), F.col("store").alias("alan_magaza"),
            F.col("product").alias("urun"), F.lit(0.0).alias("baslangic_depo_stok"), F.col("need").alias("ihtiyac_adet"),
            F.lit(0).cast("long").alias("karsilanan_adet"), F.col("need").alias("kalan_ihtiyac"),
            F.lit(0).cast("long").alias("depo_sevk_toplam"), F.lit(0.0).alias("depo_kalan_nihai")))
    return out


def _segments(needs: DataFrame) -> DataFrame:
    """(product, t, m, u, t_next, m_next): from round t to t_next - 1 there are m stores in the queue, u
    units are handed out before round t.  Round 0, before all units, has no stores."""
    zero = F.struct(F.lit(0).cast("long").alias("t"), F.lit(0).alias("d"))
    joins = F.struct(F.lit(1).cast("long").alias("t"), F.lit(1).alias("d"))
    leaves = F.struct((F.col("need") + 1).alias("t"), F.lit(-1).alias("d"))
    events = needs.select("product", F.explode(F.array(zero, joins, leaves)).alias("e"))
    by_t = Window.partitionBy("product").orderBy("t")
    seg = events.groupBy("product", F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d"))
    seg = seg.withColumn("m", F.sum("d").over(by_t.rowsBetween(Window.unboundedPreceding, 0))).withColumn("t_next", F.lead("t").over(by_t))
    handed_out = F.sum((F.col("t_next") - F.col("t")) * F.col("m")).over(by_t.rowsBetween(Window.unboundedPreceding, -1))
    # the first segment begins one unit early, so that the boundary at 0 units lies behind it
    return seg.select("product", "t", "m", F.coalesce(handed_out, F.lit(-1)).cast("long").alias("u"), "t_next",
                      F.coalesce(F.lead("m").over(by_t), F.lit(0)).cast("long").alias("m_next"))


def _served_positions(segments: DataFrame, warehouses: DataFrame) -> DataFrame:
    """One row for each warehouse and queue position it serves, with the round and the units before
    it (r_lo, u_lo, r_hi, u_hi) at the warehouse's two boundaries."""
    w = warehouses.filter(F.col("lo") < F.col("total_need")).withColumn("hi", F.least("hi", "total_need"))
    ends = w.select("product", "warehouse", "qty", "lo", "hi", F.explode(F.array("lo", "hi")).alias("x"))
    where = F.struct("t", "m", "u", "t_next", "m_next")
    line = ends.select("*", F.lit(0).alias("kind"), F.lit(None).cast("struct<t:long,m:long,u:long,t_next:long,m_next:long>").alias("s")) \
        .unionByName(segments.select("product", F.col("u").alias("x"), F.lit(1).alias("kind"), where.alias("s")), allowMissingColumns=True)
    before = Window.partitionBy("product").orderBy("x", "kind").rowsBetween(Window.unboundedPreceding, 0)
    at = line.withColumn("s", F.last("s", ignorenulls=True).over(before)).filter("kind = 0")
    # rounds of the segment that are over before the x-th unit; none at x = 0
    over = F.when(F.col("s.m") > 0, F.expr("(x - s.u - 1) div if(s.m > 0, s.m, 1)")).otherwise(0)
    r = F.col("s.t") + over
    at = at.select("product", "warehouse", "qty", "lo", "hi", "x", F.struct(
        r.alias("r"), F.greatest(F.col("s.u") + over * F.col("s.m"), F.lit(0)).alias("u"), F.col("s.m").alias("m"),
        F.when(r + 1 < F.col("s.t_next"), F.col("s.m")).otherwise(F.col("s.m_next")).alias("m_next")).alias("e"))
    # the window's exchange on product serves this grouping too
    w = at.groupBy("product", "warehouse", "qty", "lo", "hi").agg(
        F.max(F.when(F.col("x") == F.col("lo"), F.col("e"))).alias("a"), F.max(F.when(F.col("x") == F.col("hi"), F.col("e"))).alias("b"))
    same, follows = F.col("a.r") == F.col("b.r"), F.col("b.r") > F.col("a.r") + 1
    head = F.when(same, 0).when(follows, F.col("a.m_next")).otherwise(F.col("hi") - F.col("b.u"))
    start = F.greatest(head, F.col("lo") - F.col("a.u")) + 1
    end = F.when(same, F.col("hi") - F.col("a.u")).otherwise(F.col("a.m"))
    none = F.array().cast("array<long>")
    positions = F.concat(F.when(head >= 1, F.sequence(F.lit(1).cast("long"), head)).otherwise(none),
                         F.when(start <= end, F.sequence(start, end)).otherwise(none))
    return w.select("product", "warehouse", "qty", "lo", "hi", F.col("a.r").alias("r_lo"), F.col("a.u").alias("u_lo"),
                    F.col("b.r").alias("r_hi"), F.col("b.u").alias("u_hi"), F.explode(positions).alias("pos"))


def served_pairs(positions: DataFrame, needs: DataFrame) -> DataFrame:
    """What each served store receives from each of its warehouses, and what it had before."""
    def received(which: str):
        """Units that a store has received when ``which`` units have been handed out."""
        r, left = F.col(f"r_{which}"), F.col(which) - F.col(f"u_{which}")
        return F.greatest(F.least(F.col("need"), r - 1), F.lit(0)) + ((F.col("need") >= r) & (F.col("pos") <= left)).cast("long")

    return positions.join(needs, ["product", "pos"]).select(
        "product", "warehouse", "store", "need", F.col("qty").alias("baslangic_depo_stok"), received("lo").alias("had"),
        (received("hi") - received("lo")).alias("karsilanan_adet"), (F.col("hi") - F.col("lo")).alias("depo_sevk_toplam"))


def stock_outs(needs: DataFrame, stock: DataFrame) -> DataFrame:
    """Products with need but no positive warehouse stock anywhere: one NO_STOCK row per store."""
    miss = needs.join(stock.select("product"), "product", "left_anti")
    return miss.select(
        F.lit(NO_STOCK).alias("gonderen_depo"), F.col("store").alias("alan_magaza"), F.col("product").alias("urun"),
        F.lit(0.0).alias("baslangic_depo_stok"), F.col("need").cast("long").alias("ihtiyac_adet"),
        F.lit(0).cast("long").alias("karsilanan_adet"), F.col("need").cast("long").alias("kalan_ihtiyac"),
        F.lit(0).cast("long").alias("depo_sevk_toplam"), F.lit(0.0).alias("depo_kalan_nihai"))


def warehouse_stockouts(replenishment_needs: DataFrame, warehouse_stock: DataFrame, **kw) -> DataFrame:
    cols = dict(store_col="store_code", product_col="product_id", need_col="ihtiyac_adet",
                warehouse_col="alt_yer", warehouse_qty_col="miktar")
    cols.update(kw)
    n, w = _prepare(replenishment_needs, warehouse_stock, **cols)
    stock = w.groupBy("product").agg(F.sum(F.ceil("qty")).alias("stock_units"))
    return stock_outs(n, stock)


def fulfilment_summary(distribution: DataFrame) -> DataFrame:
    """Total need, shipped, unmet and the fill rate."""
    return distribution.agg(F.sum("ihtiyac_adet").alias("total_need"), F.sum("karsilanan_adet").alias("total_shipped"),
                            F.sum("kalan_ihtiyac").alias("total_unmet")) \
        .withColumn("fill_rate", F.try_divide(F.col("total_shipped").cast("double"), F.col("total_need").cast("double")))


def fulfilment_by_warehouse(distribution: DataFrame) -> DataFrame:
    return distribution.groupBy("gonderen_depo").agg(F.sum("ihtiyac_adet").alias("ihtiyac_adet"),
                                                     F.sum("karsilanan_adet").alias("karsilanan_adet"))


def fulfilment_levels(distribution: DataFrame) -> DataFrame:
    """G10 at every level in one pass: all, by warehouse, by product, and by both.

    ``level`` names the grouping; a column that it does not group by is NULL."""
    sets = [[], ["gonderen_depo"], ["urun"], ["gonderen_depo", "urun"]]
    level = F.element_at(F.array(*map(F.lit, ("both", "warehouse", "product", "all"))), F.grouping_id("gonderen_depo", "urun").cast("int") + 1)
    d = distribution.groupingSets([[F.col(c) for c in s] for s in sets], "gonderen_depo", "urun").agg(
        level.alias("level"), F.count(F.lit(1)).alias("rows"), F.sum("ihtiyac_adet").alias("total_need"),
        F.sum("karsilanan_adet").alias("total_shipped"), F.sum("kalan_ihtiyac").alias("total_unmet"))
    rate = F.try_divide(F.col("total_shipped").cast("double"), F.col("total_need").cast("double"))
    return d.select("level", "gonderen_depo", "urun", "rows", "total_need", "total_shipped", "total_unmet", rate.alias("fill_rate"))
