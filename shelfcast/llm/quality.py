"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Words and word pairs of every text go into ``buckets`` hash buckets.  Two multinomials are
counted: the raw one over all documents, the target one over all trusted documents.  A document's
score is the mean over its n-grams of log(target / raw); it is kept when the score reaches the
threshold and the base rules hold.  The threshold is derived from the trusted documents: each is
scored with its own n-grams taken out of the target, as a document that is not trusted would be, and
a low quantile of these scores less a margin is the least score.  Bucket weights are integers (millionths), so that sums do not
depend on the order of rows and reruns decide alike.

Nulls and empty texts have no words and fail the base rules.  Repeated rows are judged one by one
and alike.  A null doc_id is judged but never trusted.  Without trusted documents the target equals
the raw multinomial and only the base rules decide.  Other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import drop_stage, map_batches, pieces, protected, restored, text_bytes, written

#: Hash buckets of the multinomials: this bounds what is sent to the driver and broadcast (8 bytes each).
BUCKETS = 1 << 16
#: Words of the filter of trusted doc_ids: the rows that are broadcast at most.
FILTER_WORDS = 1 << 18
#: Pseudo-count of the target, shared by the raw distribution: n-grams for each of the target's own,
#: so that scores keep their scale at any size.  With a given threshold: n-grams for each bucket.
TARGET_SHARE, SMOOTHING = 1.0, 1.0
#: The threshold: percent of the trusted documents' scores below it, and the margin in millionths.
LOW_PERCENT, MARGIN = 1, 20_000
#: A threshold in millionths of a nat that every score reaches.
LEAST = -1_000_000_000
#: Base rules: least words, most percent of words in repeated windows, words of a window.
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
LINE_FEED = np.zeros(256, bool)
LINE_FEED[0x0A] = True


def ngram_buckets(words: np.ndarray, word_offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, then of all pairs of neighbours, and the row of each."""
    rows = T.row_of(word_offsets)
    pairs = T.window_starts(word_offsets, 2)
    both = np.concatenate((words, T.ngram_hashes(words, 2)[pairs]))
    return (both % np.uint64(buckets)).astype(np.int64), np.concatenate((rows, rows[pairs]))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all n-grams of ``docs``."""
    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            data, at = text_bytes(batch.column(0))
            for lo, hi in pieces(at):
                part, off = data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
                starts, ends, words_at = T.runs(part, off, T.SPACE)
                b, _ = ngram_buckets(T.span_hashes(part, starts, ends), words_at, buckets)
                counts += np.bincount(b, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_docs(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text) of every row of ``docs`` that is labelled good and not toxic.

    The ids are not broadcast, they grow with the corpus.  Their hashes set bits in FILTER_WORDS words of 64
    bits; texts whose bit is not set are not shuffled, the join by doc_id decides on the others."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    # hashes agree within one type only
    good = good.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).distinct()
    h = F.xxhash64("doc_id")
    word, bit = F.pmod(h, F.lit(FILTER_WORDS)), F.expr("shiftleft(1L, cast(pmod(shiftright(h, 32), 64) as int))")
    bits = good.withColumn("h", h).select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    some = (docs.select("doc_id", "text").withColumn("h", h).withColumn("word", word).withColumn("bit", bit)
            .join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(F.col("bit")) != 0))
    # an inner join on distinct ids: a semi-join would be pushed below the filter
    return some.select("doc_id", "text").join(good.hint("merge"), "doc_id").select("text")


def bucket_array(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts by bucket.  At most ``buckets`` rows reach the driver."""
    out = np.zeros(buckets)
    got = counts.toPandas()
    out[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    return out


def raw_share(raw: np.ndarray) -> np.ndarray:
    return (raw + 1) / (raw.sum() + len(raw))


def bucket_weights(raw: np.ndarray, target: np.ndarray, pseudo: float) -> np.ndarray:
    """log(target / raw) of each bucket in millionths."""
    if not raw.sum() or not target.sum():
        return np.zeros(len(raw), np.int64)
    p_raw = raw_share(raw)
    p_target = (target + pseudo * p_raw) / (target.sum() + pseudo)
    return np.rint(1e6 * np.log(p_target / p_raw)).astype(np.int64)


def derived_threshold(trusted: DataFrame, raw: np.ndarray, target: np.ndarray, pseudo: float) -> int:
    """The low quantile of the trusted documents' scores, each counted without itself, less the
    margin.  Scores are counted in thousandths, so a bounded histogram reaches the driver."""
    if not target.sum():
        return LEAST
    shared, buckets = trusted.sparkSession.sparkContext.broadcast((raw_share(raw), target)), len(raw)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        (p_raw, counted), found = shared.value, []
        data, at = text_bytes(batch.column(0))
        for lo, hi in pieces(at):
            part, off = data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
            starts, ends, words_at = T.runs(part, off, T.SPACE)
            words = T.span_hashes(part, starts, ends)
            b, row = ngram_buckets(words, words_at, buckets)
            base, n = base_columns(part, off, starts, ends, words_at, words), np.bincount(row, minlength=hi - lo)
            own, times = np.unique(row * buckets + b, return_counts=True)
            row, b = np.divmod(own, buckets)
            without = (counted[b] - times + pseudo * p_raw[b]) / (counted.sum() - n[row] + pseudo)
            score = np.bincount(row, times * np.log(without / p_raw[b]), minlength=hi - lo) / np.maximum(n, 1)
            judged = (base["n_words"] >= MIN_WORDS) & (100 * base["n_repeat_words"] <= MAX_REPEAT_PERCENT * base["n_words"])
            found.append(np.floor(1e3 * score[judged]).astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["score"])

    by_score = map_batches(trusted, one, "score long").groupBy("score").count().toPandas().sort_values("score")
    if by_score.empty:
        return LEAST
    up_to = by_score["count"].cumsum().to_numpy()
    at = np.searchsorted(up_to, up_to[-1] * LOW_PERCENT // 100, side="right")
    return 1000 * int(by_score["score"].iloc[at]) - MARGIN


def fitted(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: int | None = None) -> tuple[np.ndarray, int]:
    """Weights of the buckets and the threshold, derived unless it is given."""
    # read twice: for the target and for the threshold
    trusted = written(trusted_docs(docs, labels), "trusted")
    raw, target = (bucket_array(bucket_counts(d, buckets), buckets) for d in (docs, trusted))
    if threshold is not None:
        weights = bucket_weights(raw, target, SMOOTHING * buckets)
    else:
        pseudo = TARGET_SHARE * target.sum()
        weights, threshold = bucket_weights(raw, target, pseudo), derived_threshold(trusted, raw, target, pseudo)
    drop_stage(trusted)
    return weights, threshold


def base_columns(part: np.ndarray, off: np.ndarray, starts, ends, words_at, words) -> dict[str, np.ndarray]:
    """The counts of the base rules for each row."""
    n_words = np.diff(words_at)
    before = np.concatenate(([0], np.cumsum(T.HEADS[part] & ~T.SPACE[part], dtype=np.int64)))
    rows = T.row_of(words_at)
    windows = T.window_starts(words_at, REPEAT_WINDOW)
    keys = T.mix(T.ngram_hashes(words, REPEAT_WINDOW)[windows] + rows[windows].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    in_repeat = T.covered(windows[T.repeated(keys)], REPEAT_WINDOW, len(words))
    l_start, l_end, lines_at = T.runs(part, off, LINE_FEED)
    has_word = np.searchsorted(starts, l_end) > np.searchsorted(starts, l_start)
    l_row = T.row_of(lines_at)[has_word]
    l_key = T.mix(T.span_hashes(part, l_start, l_end)[has_word] + l_row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    n_rows = len(off) - 1
    n_lines = np.bincount(l_row, minlength=n_rows)
    _, first = np.unique(l_key, return_index=True)
    return {
        "n_words": n_words, "word_chars": before[off[1:]] - before[off[:-1]], "n_symbols": T.sums(SYMBOLS[part], off),
        "n_dup_lines": n_lines - np.bincount(l_row[first], minlength=n_rows), "n_repeat_words": T.sums(in_repeat, words_at),
    }


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_ngrams long, weight long"


def judge(docs: DataFrame, weights: np.ndarray, threshold: int = LEAST, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """All rows of ``docs`` with the columns ``carry``, the base counts, base_failed, score and kept."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(weights)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    names = [s.split()[0] for s in RESULT.split(", ")]
    sent = [*carry, *([] if "text" in carry else ["text"])]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = shared.value
        data, at = text_bytes(batch.column(sent.index("text")))
        found = {k: [] for k in names}
        for lo, hi in pieces(at):
            part, off = data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
            starts, ends, words_at = T.runs(part, off, T.SPACE)
            words = T.span_hashes(part, starts, ends)
            b, row = ngram_buckets(words, words_at, len(w))
            n_rows = hi - lo
            base = base_columns(part, off, starts, ends, words_at, words)
            order = np.argsort(row, kind="stable")
            n = np.bincount(row, minlength=n_rows)
            base |= {"n_ngrams": n, "weight": T.sums(w[b[order]], np.concatenate(([0], np.cumsum(n))))}
            for k in names:
                found[k].append(base[k])
        cols = [batch.column(i) for i in range(len(carry))]
        return pa.RecordBatch.from_arrays([*cols, *(pa.array(np.concatenate(found[k]).astype(np.int64)) for k in names)], [*carry, *names])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carry), RESULT])
    out = map_batches(docs.select(*sent), one, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (out.withColumn("base_failed", failed)
            .withColumn("score", F.try_divide(F.col("weight").cast("double"), F.col("n_ngrams") * F.lit(1e6)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("weight") >= F.col("n_ngrams") * F.lit(threshold)))
            .drop("weight", "n_ngrams"))


def quality_rules(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ("doc_id",), buckets: int = BUCKETS, threshold: int | None = None) -> DataFrame:
    """Fit both multinomials and judge every row of ``docs``."""
    weights, threshold = fitted(docs, labels, buckets, threshold)
    return judge(docs, weights, threshold, carry)


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    names = ("doc_id", "text")
    rows = protected(docs, *names)
    weights, threshold = fitted(docs, labels)
    return restored(judge(rows, weights, threshold, carry=tuple(rows.columns)).where("kept"), docs, *names)
