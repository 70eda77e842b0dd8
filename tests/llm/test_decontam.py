import hashlib
import random
import re

import pytest
from helpers import collected

from shelfcast.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def expected(text, items):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        for k in range(len(v) - n + 1) if v else ():
            for i in range(len(w) - n + 1):
                if w[i:i + n] == v[k:k + n]:
                    hit.update(range(i, i + n))
                    ids.add(item)
    ids = sorted(str(i) for i in ids if i is not None)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def tables(spark):
    rng = random.Random(3)
    vocab = ["Alpha", "béta", "c3", "the", "of", "Ω"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate((14, 10, 3, 1, 25, 9, 12))]
    items += [(7, None), (8, ""), (9, "?!"), (None, "only the nameless one"), (10, items[1][1]), (1, items[1][1])]
    texts = [" ".join(rng.choice(vocab[:5]) for _ in range(rng.randrange(50))) for _ in range(30)]
    texts += [f"intro, {items[k][1].upper()}. tail" for k in (0, 4, 6)] + [words(items[4][1])[0], None, "", "x only the-nameless one", "béta\n" * 12]
    docs = [(i, t, "x") for i, t in enumerate(texts)]
    return items, docs, spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string, hits string").repartition(3)


@pytest.mark.parametrize("most", [200_000, 3])
def test_matches_brute_force(spark, most):
    items, docs, item_table, doc_table = tables(spark)
    got = collected(D.contamination(doc_table, item_table, most=most))
    want = {i: expected(t, items) for i, t, _ in docs}
    assert {i: tuple(got[i][1:]) for i in want} == want
    assert {w[4] for w in want.values()} == {True, False}


def test_clean_keeps_columns(spark):
    _, docs, item_table, doc_table = tables(spark)
    out = D.clean(doc_table, item_table)
    assert out.columns == doc_table.columns and 0 < out.count() < len(docs)


def test_empty_tables(spark):
    _, docs, item_table, doc_table = tables(spark)
    assert D.contamination(doc_table.limit(0), item_table).count() == 0
    assert D.contamination(doc_table, item_table.limit(0)).where("contaminated").count() == 0


def test_prefix_is_the_rarest_shingle_of_the_corpus(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d e f x", "d e f g h i j y", "a b c d", "g h i j k g h i", "h i j k"])], "doc_id long, text string")
    own = D.windows(items)
    distinct = own.dropDuplicates(["window"])
    bits = D.Bits.of(distinct.selectExpr("explode(shingles) AS shingle"), (3,))
    found = {r.window: r.offset for r in D.prefixes(distinct, D.shingle_counts(docs, bits)).collect()}
    # c d e, e f g and f g h occur once each, all others more often; the first of equals
    assert found == {"a b c d e f g h i j": 2, "b c d e f g h i j k": 1}


def test_bit_table_knows_every_shingle_and_few_others(spark):
    import numpy as np
    from shelfcast.llm import text as T
    rng = np.random.default_rng(1)
    keys = rng.integers(-2**63, 2**63, 5000)
    bits = D.Bits.of(spark.createDataFrame([(int(k),) for k in keys], "shingle long"), (1,))
    place = keys.view(np.uint64) >> np.uint64(64 - D.FILTER_BITS)
    assert (bits.packed[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).all()
    assert np.unpackbits(bits.packed).sum() == len(np.unique(place))


def test_long_texts_hot_passages_and_one_window_of_all_items(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(i, passage) for i in range(40)] + [(100, "x y"), (101, "solo")]
    texts = [f"{'w ' * (i % 5)}{passage} end" for i in range(60)] + [" ".join(f"u{i % 977}" for i in range(60_000)) + " solo " + passage, ("x y " * 3000)]
    docs = [(i // 2, t) for i, t in enumerate(texts)]                        # repeated doc_ids
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    # twin: the same sets of words by position, found with string search over space-joined words
    def twin(text):
        w = words(text)
        hit, ids = set(), set()
        for item, t in {t: (i, t) for i, t in items}.values():
            v = words(t)
            n = min(10, len(v))
            where = {}
            for i in range(len(w) - n + 1):
                where.setdefault(tuple(w[i:i + n]), []).append(i)
            for k in range(len(v) - n + 1):
                for i in where.get(tuple(v[k:k + n]), ()):
                    hit.update(range(i, i + n))
                    ids.update(str(j) for j, u in items if u == t)
        return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, *twin(t)) for i, t in docs)


def test_clean_with_clashing_columns(spark):
    _, docs, item_table, doc_table = tables(spark)
    odd = doc_table.selectExpr("*", "1 AS row", "2 AS found", "3 AS n_words", "4 AS window", "5 AS decontam_text", "6 AS `set`")
    odd = odd.selectExpr("*", "7 AS decontam_id", "8 AS gone")
    kept = sorted(map(tuple, D.clean(odd, item_table).collect()), key=str)
    assert D.clean(odd, item_table).columns == odd.columns and len(kept) == D.clean(doc_table, item_table).count()
    assert sorted(map(tuple, D.clean(odd, item_table, few=0).collect()), key=str) == kept
