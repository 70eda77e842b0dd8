"""The whole pipeline against a plain-Python version, stage by stage over lists of rows."""
import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from helpers import words
from test_decontam import words as item_words
from test_mixing import targets
from test_quality import base, buckets_of
from test_simhash import classes, fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import mixing, quality
from shelfcast.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, h string, row int, fp int, copies int"


def plain_quality(rows, labels):
    """Rows whose mean log ratio of n-gram shares reaches the low quantile of the trusted ones."""
    n = quality.BUCKETS
    trusted = {i for i, good, toxic in labels if i is not None and good == 1 and not toxic}
    bags = [collections.Counter(buckets_of(r["text"], n)) for r in rows]
    raw, target = collections.Counter(), collections.Counter()
    for r, bag in zip(rows, bags):
        raw.update(bag)
        if r["doc_id"] in trusted:
            target.update(bag)
    n_raw, n_target = raw.total(), target.total()
    share = lambda b: (raw[b] + 1) / (n_raw + n)
    weight = {b: round(1e6 * math.log((target[b] + n_target * share(b)) / (2 * n_target) / share(b))) for b in raw}
    fits, scores = [], []
    for r, bag in zip(rows, bags):
        n_words, *_, repeat = base(r["text"])
        fits.append(n_words >= 20 and 100 * repeat <= 30 * n_words)
        if fits[-1] and r["doc_id"] in trusted:
            m = bag.total()
            scores.append(sum(c * math.log((target[b] - c + n_target * share(b)) / (2 * n_target - m) / share(b)) for b, c in bag.items()) / m)
    least = 1000 * sorted(math.floor(1e3 * s) for s in scores)[len(scores) // 100] - quality.MARGIN
    return [r for r, bag, ok in zip(rows, bags, fits) if ok and sum(weight[b] * c for b, c in bag.items()) >= least * bag.total()]


def plain_dedup(rows):
    """The row with the smallest doc_id (null last) of each component of fingerprints within 4 bits."""
    best = {}
    for r, c in zip(rows, classes([fingerprint(r["text"]) for r in rows])):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if c not in best or key < best[c][0]:
            best[c] = key, r
    return [r for _, r in best.values()]


def plain_decontamination(rows, items):
    windows = set()
    for t in items:
        w = item_words(t)
        n = min(10, len(w))
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    lengths = {len(w) for w in windows}
    out = []
    for r in rows:
        w = item_words(r["text"])
        if not any(tuple(w[i:i + n]) in windows for n in lengths for i in range(len(w) - n + 1)):
            out.append(r)
    return out


def plain_mix(rows):
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    out = []
    for source, target in targets(sizes).items():
        size, target = sizes[source], float(target)
        repeats = min(math.floor(target / size), mixing.MOST) if size else 0
        budget, before = target - repeats * size, 0
        own = [r for r in rows if r["source"] == source]
        own.sort(key=lambda r: hashlib.md5(f"{'' if r['doc_id'] is None else r['doc_id']}:{r['text'] or ''}".encode()).hexdigest()[:mixing.HASH])
        for r in own:
            n = len(words(r["text"]))
            extra = repeats < mixing.MOST and before <= budget and 2 * (budget - before) > n
            out += [r] * (repeats + extra)
            before += n
    return out


def plain_tokens(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    out, start = [], 0
    for r in sorted(rows, key=lambda r: -1 if r["doc_id"] is None else r["doc_id"]):
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((r["doc_id"], start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """sf0.001 with rows that have nulls, repeat, or are empty, and columns named like the operators' own."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    whole = max(docs, key=lambda r: len(r["text"] or ""))["text"]
    # without a doc_id, a source or a text; a row three times; the longest text again, 30 times over
    docs += [{"doc_id": None, "text": " ".join(f"fresh{i} words{i % 7}" for i in range(60)), "lang": None, "source": None, "n_chars": None},
             {"doc_id": 900_001, "text": None, "lang": "en", "source": "web", "n_chars": 0}, {"doc_id": 900_002, "text": "", "lang": "en", "source": None, "n_chars": 0},
             {"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None}, docs[3], docs[3],
             {"doc_id": 900_003, "text": " ".join([whole] * 30), "lang": "en", "source": "web", "n_chars": 1}]
    odd = [{**r, "kept": "k", "h": str(i % 3), "row": i, "fp": 1, "copies": None} for i, r in enumerate(docs)]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    odd = [{**r, **{k: odd[3][k] for k in ("kept", "h", "row", "fp")}} if r["doc_id"] == docs[3]["doc_id"] else r for r in odd]
    spark.createDataFrame([tuple(r[k] for k in names) for r in odd], SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    return folder, odd, labels, items


def key(r):
    return str(sorted((k, str(v)) for k, v in r.items()))


def test_every_stage_and_the_run(spark, tables):
    folder, rows, labels, items = tables
    plain = [lambda r: plain_quality(r, labels), plain_dedup, lambda r: plain_decontamination(r, items), plain_mix]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, n = docs.columns, [len(rows)]
    for (name, stage), own in zip(corpus_pipeline.STAGES, plain):
        docs, rows = stage(spark, docs, folder), own(rows)
        got = [r.asDict() for r in docs.collect()]
        assert docs.columns == columns and sorted(map(key, got)) == sorted(map(key, rows)), name
        docs = spark.createDataFrame([tuple(r[c] for c in columns) for r in got], SCHEMA)
        n.append(len(rows))
    # each of the first three stages drops some and keeps most
    assert n[0] > n[1] > n[2] > n[3] > n[0] / 3
    want = plain_tokens(rows)
    index = corpus_pipeline.run(spark, folder)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in index.collect()), key=lambda r: r[1]) == want
