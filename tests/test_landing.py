import datetime as dt
import gzip
import os
import re

from pyspark.sql import types as T

from shelfcast.sources import landing


def put(folder, name, text, **kw):
    os.makedirs(os.path.dirname(folder / name) or folder, exist_ok=True)
    with open(folder / name, "w", encoding=kw.get("encoding", "utf-8")) as f:
        f.write(text)


def test_headers_of_each_file_are_reconciled(spark, tmp_path):
    put(tmp_path, "a.csv", "Mağaza Kodu,Net Adet (%),Gün\n1001,5,2024-01-02\n1002,,2024-01-03\n", encoding="utf-8-sig")
    put(tmp_path, "b.csv", "Gün;Mağaza Kodu;Net Adet (%)\n2024-02-02;1003;\"7;5\"\n")
    put(tmp_path, "deep/c.csv", "Mağaza Kodu,Gün,Yeni,Yeni\n1004,2024-03-01,x,y\n")
    put(tmp_path, "d.csv", "Gün;Mağaza Kodu;Net Adet (%)\n2024-02-05;1005;2\n")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "header_only.csv", "Başka\n")
    with gzip.open(tmp_path / "e.csv.gz", "wt") as f:
        f.write("Gün|Mağaza Kodu\n2024-04-01|1006\n")
    got = landing.land_raw_files(spark, str(tmp_path), file_column="source_file")
    assert got.columns == ["Mağaza_Kodu", "Net_Adet____", "Gün", "Yeni", "Yeni_1", "Başka", "source_file"]
    rows = {r.Mağaza_Kodu: (r["Net_Adet____"], r.Gün, r.Yeni, r.Yeni_1, os.path.basename(r.source_file)) for r in got.collect()}
    assert rows == {"1001": ("5", "2024-01-02", None, None, "a.csv"), "1002": (None, "2024-01-03", None, None, "a.csv"),
                    "1003": ("7;5", "2024-02-02", None, None, "b.csv"), "1005": ("2", "2024-02-05", None, None, "d.csv"),
                    "1004": (None, "2024-03-01", "x", "y", "c.csv"), "1006": (None, "2024-04-01", None, None, "e.csv.gz")}
    # b.csv and d.csv share a layout: five layouts with rows or a header, five scans
    plan = got.select("Gün")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan csv", plan)) == 5


def test_separators_outside_quotes():
    assert landing.separator_of('"a;b;c;d",x,y') == "," and landing.separator_of("a") == ";"
    assert landing.separator_of("a\tb") == "\t" and landing.separator_of("a|b|c;d") == "|"


SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("qty", T.DoubleType()),
                       T.StructField("day", T.DateType()), T.StructField("n", T.IntegerType())])


def test_rejects_name_their_reasons(spark, tmp_path):
    put(tmp_path, "f.csv", "code,qty,day,n\nA,1.5,2024-01-02,1\nB,n/a,2024-01-02,2\nC,2,2024-13-01,x\n"
        "D,3,2024-01-05\nE,3,2024-01-05,4,extra\n\"F,1\",,,\n\"G,2\",bad,2024-01-01,7\n")
    checked = landing.land_checked_csv(spark, str(tmp_path / "f.csv"), SCHEMA, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in checked.rows.collect()) == [("A", 1.5, dt.date(2024, 1, 2), 1), ("F,1", None, None, None)]
    rejects = {r.record[:2]: (r.n_fields, r.bad_fields, r.reason) for r in checked.rejects.collect()}
    assert rejects == {"B,": (4, ["qty"], "not readable: qty"), "C,": (4, ["day", "n"], "not readable: day, n"),
                       "D,": (3, [], "3 of 4 fields"), "E,": (5, [], "5 of 4 fields"), '"G': (4, ["qty"], "not readable: qty")}
    assert all(r.source_file.endswith("f.csv") for r in checked.rejects.collect())
    counts = {r.outcome: r.records for r in landing.reject_summary(checked).collect()}
    assert counts["accepted"] == 2 and sum(counts.values()) == 7 and counts["not readable: qty"] == 2
    # each result reads its own partition
    for df, flag in ((checked.rows, "false"), (checked.rejects, "true")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*_rejected", plan), flag


def test_rows_are_not_sorted_before_the_write(spark, tmp_path, monkeypatch):
    """A file of each partition stays open while the table is written, so no task sorts its rows."""
    from pyspark.sql.readwriter import DataFrameWriter
    key, seen, parquet = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: seen.append(int(spark.conf.get(key))) or parquet(self, *a, **k))
    put(tmp_path, "f.csv", "code,qty,day,n\n" + "A,1,2024-01-02,1\nB,x,2024-01-02,1\n" * 50)
    before = spark.conf.get(key)
    checked = landing.land_checked_csv(spark, str(tmp_path / "f.csv"), SCHEMA, str(tmp_path / "out"))
    assert seen == [2] and spark.conf.get(key) == before
    assert (checked.rows.count(), checked.rejects.count()) == (50, 50) and len(files_of(tmp_path / "out")) == 2


def test_regional_numbers_are_checked_too(spark, tmp_path):
    put(tmp_path, "f.csv", "code;qty;day;n\nA;1.234,5;2024-01-02;1\nB;12x;2024-01-02;2\n")
    checked = landing.land_checked_csv(spark, str(tmp_path / "f.csv"), SCHEMA, str(tmp_path / "out"), sep=";", locale="tr-TR")
    assert [tuple(r) for r in checked.rows.collect()] == [("A", 1234.5, dt.date(2024, 1, 2), 1)]
    assert [r.reason for r in checked.rejects.collect()] == ["not readable: qty"]


def test_no_rejects_and_no_rows(spark, tmp_path):
    put(tmp_path, "good.csv", "code,qty,day,n\nA,1,2024-01-02,1\n")
    put(tmp_path, "bad.csv", "code,qty,day,n\nA,x,2024-01-02,1\n")
    good = landing.land_checked_csv(spark, str(tmp_path / "good.csv"), SCHEMA, str(tmp_path / "o1"))
    bad = landing.land_checked_csv(spark, str(tmp_path / "bad.csv"), SCHEMA, str(tmp_path / "o2"))
    assert (good.rows.count(), good.rejects.count(), bad.rows.count(), bad.rejects.count()) == (1, 0, 0, 1)
    assert {r.outcome: r.records for r in landing.reject_summary(bad).collect()} == {"accepted": 0, "not readable: qty": 1}


SALES = T.StructType([T.StructField("date", T.DateType()), T.StructField("store", T.StringType()), T.StructField("qty", T.LongType())])


def sales(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), s, q) for d, s, q in rows], SALES)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_reload_touches_only_its_months(spark, tmp_path):
    path = str(tmp_path / "sales")
    extract = landing.MonthlyExtract(spark, path, SALES)
    assert extract.stored_months() == [] and extract.read().count() == 0
    first = [("2024-01-05", "a", 1), ("2024-02-01", "a", 2), ("2024-02-29", "b", 3), ("2024-03-01", "a", 4)]
    extract.load(sales(spark, first), ["2024-01", "2024-02", "2024-03"])
    before = files_of(path)
    restated = [("2024-01-05", "a", 100), ("2024-02-01", "a", 20), ("2024-02-03", "c", 30), ("2024-03-01", "a", 400)]
    extract.load(sales(spark, restated), ["2024-02"])
    after = files_of(path)
    same = {f: m for f, m in before.items() if "month=2024-02" not in f}
    assert same.items() <= after.items() and not {f for f in before if "month=2024-02" in f} & after.keys()
    assert sorted((r.month, r.store, r.qty) for r in extract.read().collect()) == [
        ("2024-01", "a", 1), ("2024-02", "a", 20), ("2024-02", "c", 30), ("2024-03", "a", 4)]
    # a month that has lost all its rows has no partition any more
    extract.load(sales(spark, restated[:1]), ["2024-03"])
    assert extract.stored_months() == ["2024-01", "2024-02"]


def test_reads_prune_by_month_and_sources_by_date(spark, tmp_path):
    extract = landing.MonthlyExtract(spark, str(tmp_path / "sales"), SALES)
    extract.load(sales(spark, [("2024-01-05", "a", 1), ("2024-02-01", "a", 2)]), ["2024-01", "2024-02"])
    some = extract.read(["2024-02"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan) and [r.qty for r in some.collect()] == [2]
    raw = str(tmp_path / "raw")
    sales(spark, [("2024-01-05", "a", 1)]).write.parquet(raw)
    source = spark.read.parquet(raw).filter(extract._of(["2023-12", "2024-01", "2024-03"]))
    plan = source._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(date,2023-12-01),LessThan(date,2024-02-01))" in plan


def test_refresh_loads_missing_and_open_months_and_drops_old_ones(spark, tmp_path):
    extract = landing.MonthlyExtract(spark, str(tmp_path / "sales"), SALES)
    days = [(f"{y}-{m:02d}-10", "a", y * 100 + m) for y in (2023, 2024) for m in range(1, 13)]
    source = sales(spark, days)
    assert extract.refresh(source, dt.date(2024, 2, 29), months=3) == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert extract.refresh(source, dt.date(2024, 3, 1), months=3) == ["2024-02", "2024-03"]
    assert extract.stored_months() == ["2023-12", "2024-01", "2024-02", "2024-03"]
    assert extract.refresh(source, dt.date(2024, 3, 31), months=3, open_months=0) == ["2024-03"]
    assert sorted(r.qty for r in extract.read().collect()) == [202312, 202401, 202402, 202403]
