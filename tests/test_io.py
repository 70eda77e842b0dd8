import os
import tempfile

from pyspark.sql import types as T

from shelfcast.sources import io


def test_locale_csv_with_bom(spark):
    d = tempfile.mkdtemp(prefix="shelfcast-io-")
    p = os.path.join(d, "f.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("code;qty\nA;1.234,5\nB;7,25\n")
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("qty", T.DoubleType())])
    got = sorted(tuple(r) for r in io.read_csv_locale(spark, p, schema).collect())
    assert got == [("A", 1234.5), ("B", 7.25)]


def test_sanitize_names():
    names = ["\ufeffSatış Tarihi", "Mağaza Kodu", "1 Ürün-ID", "Net Adet (%)", "A$B", "A$B", "", " ", "x" * 80, "x" * 80]
    out = io.sanitize_column_names(names)
    assert out[:6] == ["Satış_Tarihi", "Mağaza_Kodu", "_1_Ürün_ID", "Net_Adet____", "A$B", "A$B_1"]
    assert out[6:8] == ["_col", "_col_1"] and len(out[8]) == len(out[9]) == 60 and len(set(out)) == len(out)
