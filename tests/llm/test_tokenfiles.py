import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import frame, random_texts
from tokenizers import Tokenizer

from shelfcast.llm import tokenfiles as K
from shelfcast.llm.common import stage_path, text_bytes
from shelfcast.llm.queries import TOKENIZER

ODD = ["a  b\n\nc \t d", " lead", "trail  ", "\u00a0x \u2003 y\u3000", "don't I'll 12ab", "\x1ca \x85b", "<|endoftext|> z", "中文 字\u200b", "", " ", "\n\n", "a" * 5000, "é" * 300 + "  " * 40]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


def test_pieces_encode_as_whole_texts(tokenizer):
    texts = ODD + [t or "" for t in random_texts(60)]
    encoder = K.Encoder(TOKENIZER)
    for _ in range(2):  # new pieces, then remembered ones
        ids, at = encoder.encode(*text_bytes(pa.array(texts)))
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 2], repr(t)


def test_files_round_trip_in_order(spark, tokenizer):
    texts = ODD + random_texts(30)
    docs = frame(spark, texts).union(spark.createDataFrame([(None, "no id", "s"), (3, "again", "s"), (3, "again", "s")], "doc_id long, text string, source string"))
    got = sorted(K.token_files(docs, TOKENIZER).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:]) and len(got) == docs.count()
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    want = {}
    for r in docs.collect():
        e = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(r.doc_id, []).append((len(e), zlib.crc32(e)))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in want.items()} == {k: sorted(v) for k, v in have.items()}


def test_reads_of_some_documents_and_metadata(spark):
    path = stage_path(spark, "tokens-test")
    K.write_tokens(frame(spark, random_texts(40)), TOKENIZER, path)
    some = K.read_tokens(spark, path, [3, 17])
    assert sorted(r.doc_id for r in some.collect()) == [3, 17]
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString().replace("`", "")
    from pyarrow import orc
    files = [f for f in K.read_tokens(spark, path).inputFiles()]
    one = orc.ORCFile(files[0].removeprefix("file:").replace("//", ""))
    assert one.nstripes >= 1 and one.nrows > 0 and one.row_index_stride == K.ROW_INDEX and str(one.compression).lower().endswith("zstd")


def test_empty_table(spark):
    assert K.token_files(frame(spark, []), TOKENIZER).count() == 0


def orc_parts(spark, files):
    """(stripes, rows, row index entries, Bloom filters on doc_id) of each file, by ORC's own reader."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        rows = reader.rows()
        entries = blooms = 0
        flags = spark.sparkContext._gateway.new_array(jvm.boolean, reader.getSchema().getMaximumId() + 1)
        for i in range(len(flags)):
            flags[i] = True
        for k in range(reader.getStripes().size()):
            index = rows.readRowIndex(k, flags, flags)
            entries += index.getRowGroupIndex()[1].getEntryCount()
            found = index.getBloomFilterIndex()[1]
            blooms += 0 if found is None else found.getBloomFilterCount()
        out.append((reader.getStripes().size(), reader.getNumberOfRows(), entries, blooms))
        rows.close()
    return out


def test_stripes_row_index_and_bloom_filters(spark, monkeypatch):
    monkeypatch.setattr(K, "STRIPE_BYTES", 64 << 10)
    path = stage_path(spark, "tokens-stripes")
    docs = spark.range(0, 24_000, 2, 1).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 20), i -> substr(sha2(concat(id, ':', i), 256), 1, 9))) AS text")
    K.write_tokens(docs.coalesce(1), TOKENIZER, path)
    files = K.read_tokens(spark, path).inputFiles()
    parts = orc_parts(spark, files)
    assert sum(rows for _, rows, *_ in parts) == 12_000 and max(stripes for stripes, *_ in parts) > 1
    assert all(blooms == entries >= stripes for stripes, _, entries, blooms in parts)
    # metadata alone tells that odd ids are in no row group, and where an even one is
    def rows_read(ids):
        df = K.read_tokens(spark, path, ids).select("doc_id")
        got = [r.doc_id for r in df.collect()]
        metrics = df._jdf.queryExecution().executedPlan()
        scan = metrics.collectLeaves().head()
        return got, scan.metrics().get("numOutputRows").get().value()
    got, read = rows_read([11_000])
    assert got == [11_000] and 0 < read <= 2 * K.ROW_INDEX
    got, read = rows_read([11_001])
    assert got == [] and read <= K.ROW_INDEX


def test_equal_rows_are_split_over_files(spark, tokenizer):
    docs = spark.createDataFrame([(7, "the same text again")] * 4000 + [(100 + i, f"other {i}") for i in range(50)], "doc_id long, text string").repartition(4)
    path = stage_path(spark, "tokens-equal")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.write_tokens(docs, TOKENIZER, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    per = {r.part: r["count"] for r in K.read_tokens(spark, path).where("doc_id = 7").groupBy("part").count().collect()}
    assert len(per) > 1 and sum(per.values()) == 4000
    got = sorted(K.token_index(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got) and [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()


def test_very_long_texts(spark, tokenizer):
    texts = [" ".join(f"word{i % 977}" for i in range(200_000)), "ab" * 150_000, " " * 100_000 + "end"]
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in K.token_files(frame(spark, texts), TOKENIZER).collect()}
    for i, t in enumerate(texts):
        e = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert got[i] == (len(e), zlib.crc32(e))
