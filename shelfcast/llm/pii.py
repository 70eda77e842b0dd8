"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

Base matches (e-mail, IP, card, phone) are seeds, and so are strings of the shape of keys (kind secret).
Each occurrence of a seed induces lexical patterns from the units around it, a unit being a word, a number or a run
of punctuation, with or without white space between: two or three units before it, or one or two
before with one after, at least one of them a word (``token = "_``, ``office line _``, ``tel:_ ,``).  Whatever else fills
such a slot and holds a digit or stands around an at sign is a candidate instance: a whole token with its letters,
or a number with its separators.

Spark scores the graph of patterns and instances in rounds: a pattern's confidence in a kind is the mean
confidence of its instances, an instance's the mean confidence of those of its patterns that enough
distinct seeds support, and seeds stay certain.  Candidates of high confidence are accepted with their
kind and are seeds of the next rounds, until these accept no new one: a chain of k contexts, each known only
from the instances of the one before, takes k + 1 passes over the graph, which has no texts.

Offsets are code points, ends exclusive.  Null and empty texts have no spans.  Repeated rows get
equal results, and copies count once in the graph.  An empty table gives no rows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dealt_join, drop_stage, frequent, map_batches, text_bytes, written

#: The base kinds, and that of keys.
KINDS = ("email", "ip", "card", "phone", "secret")
SECRET = 4
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Strings of the shape of keys: 32 to 128 characters, letters and digits mixed.
KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,128}(?![A-Za-z0-9+/_-])")
KEY_DIGITS, KEY_LETTERS = 6, 6
#: A number with few separators, an at sign in words, and what may stand inside a token beside letters and digits.
NUMERIC = re.compile(r"\(?[0-9](?:[\x20().-]{0,2}[0-9]){5,}")
DIGITS = re.compile(r"[0-9]+")
AT = re.compile(r"@|\x20?[\[(]at[\])]\x20?")
INSIDE = frozenset("_-./+:=%~")
#: Rounds of scoring before candidates are accepted, least confidence, least distinct seeds of a pattern.
ROUNDS, CONFIDENCE, SUPPORT = 3, 0.8, 4

MARKS = np.zeros(256, bool)
MARKS[[*range(0x30, 0x3A), 0x40]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from the at signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        if start < at and (m := EMAIL_DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)
    return out


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split(".")))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 12 and 12 <= len(d := digits_of(m.group())) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


def key_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of strings of the shape of keys."""
    def mixed(s: str) -> bool:
        digits = sum("0" <= c <= "9" for c in s)
        return digits >= KEY_DIGITS and sum(c.isalpha() for c in s) >= KEY_LETTERS
    return [(m.start(), SECRET, m.end()) for m in KEY.finditer(text) if mixed(m.group())]


def kind_of(c: str) -> int:
    return 0 if c.isspace() else 1 if c.isalpha() else 2 if "0" <= c <= "9" else 3


def units(text: str, at: int, step: int, many: int) -> list[str]:
    """Up to ``many`` units before (step -1) or from (step 1) a place, the nearest first: lower-case
    words, 0 for a number, punctuation; a space marks white space on the side of the place."""
    out, i, end = [], at - 1 if step < 0 else at, -1 if step < 0 else len(text)
    while i != end and len(out) < many:
        gap = False
        while i != end and kind_of(text[i]) == 0:
            gap, i = True, i + step
        if i == end:
            break
        kind, first = kind_of(text[i]), i
        while i != end and kind_of(text[i]) == kind:
            i += step
        unit = "0" if kind == 2 else (text[i + 1:first + 1] if step < 0 else text[first:i]).lower()
        out.append((unit + " " if gap else unit) if step < 0 else (" " + unit if gap else unit))
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span."""
    left, right = units(text, start, -1, 3), units(text, end, 1, 1)
    two, three, one = "".join(left[1::-1]), "".join(left[2::-1]), left[0] if left else ""
    some = [two + "_"] if len(left) >= 2 else []
    some += [three + "_"] if len(left) == 3 else []
    some += [one + "_" + right[0]] if left and right else []
    some += [two + "_" + right[0]] if len(left) >= 2 and right else []
    return [p for p in some if any(c.isalpha() for c in p)]


def token(text: str, start: int, end: int, free: int) -> tuple[int, int]:
    """The token around a run of digits, without punctuation at its ends; not before ``free``."""
    while start > free and (text[start - 1].isalnum() or text[start - 1] in INSIDE):
        start -= 1
    while end < len(text) and (text[end].isalnum() or text[end] in INSIDE):
        end += 1
    while text[start] in INSIDE:
        start += 1
    while text[end - 1] in INSIDE:
        end -= 1
    return start, end


def side(text: str, at: int, step: int) -> int:
    """How far a word next to an at sign reaches."""
    while 0 <= (i := at - 1 if step < 0 else at) < len(text) and not text[i].isspace() and text[i] != "@":
        at += step
    return at


def candidates(text: str):
    """(start, end) of what may be an identifier: words around an at sign, tokens with a digit, and
    numbers with their separators."""
    for m in AT.finditer(text):
        start, end = side(text, m.start(), -1), side(text, m.end(), 1)
        if start < m.start() and end > m.end():
            yield start, end
    free = 0
    for m in DIGITS.finditer(text):
        if m.start() < free:
            continue
        start, end = token(text, m.start(), m.end(), free)
        if not any(c.isalpha() for c in text[start:end]):
            open_ = start - (start > free and text[start - 1] == "(")
            number = NUMERIC.match(text, open_) or NUMERIC.match(text, start)
            start, end = number.span() if number else (start, end)
        yield start, end
        free = end


def occurrences(text: str, seeds: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and candidates with their values and patterns; candidates do not overlap what comes before them."""
    known = bytearray(len(text))
    spans = []
    for start, kind, end in seeds:
        known[start:end] = b"\1" * (end - start)
        spans.append((start, end, kind))
    for start, end in candidates(text):
        if not any(known[start:end]):
            known[start:end] = b"\1" * (end - start)
            spans.append((start, end, -1))
    every = [{"kind": kind, "start": start, "end": end, "value": text[start:end].lower(), "patterns": patterns(text, start, end)} for start, end, kind in spans]
    return [x for x in every if x["patterns"]]


SCAN = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, known array<struct<start:int,kind:int,end:int>>, seen array<struct<kind:int,start:int,end:int,value:string,patterns:array<string>>>"
_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_SEEN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])


def scan(docs: DataFrame) -> DataFrame:
    """Base and key spans and occurrences of every row: the only pass over the texts."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1)
        data, at = text_bytes(texts)
        marks = np.concatenate(([0], np.cumsum(MARKS[data], dtype=np.int64)))
        some = marks[at[1:]] > marks[at[:-1]]
        # an at sign spelled out
        spelled = np.flatnonzero(((data[:-2] == 0x28) | (data[:-2] == 0x5B)) & (data[1:-1] == 0x61) & (data[2:] == 0x74)) if len(data) > 2 else np.zeros(0, np.int64)
        some[np.searchsorted(at, spelled, "right") - 1] = True
        counts, digests, found, seen = np.zeros((4, batch.num_rows), np.int64), [], [], []
        for i, has in enumerate(some.tolist()):
            text = texts[i].as_py() if has else ""
            spans = base_spans(text) if has else []
            for _, kind, _ in spans:
                counts[kind, i] += 1
            digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest())
            taken = bytearray(len(text))
            for a, _, b in spans:
                taken[a:b] = b"\1" * (b - a)
            spans = sorted(spans + [x for x in key_spans(text) if not any(taken[x[0]:x[2]])]) if has else []
            found.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
            seen.append(occurrences(text, spans) if has else [])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, counts), pa.array(digests), pa.array(found, pa.list_(_SPAN)), pa.array(seen, pa.list_(_SEEN))],
            ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "known", "seen"])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), one, SCAN)


def fits(value: Column, kind: Column) -> Column:
    """Whether a candidate can be of the kind: an address has an at sign, a number six digits and no
    letters, a key eight characters without a blank."""
    digits = F.regexp_count(value, F.lit("[0-9]")) >= 6
    return (F.when(kind == 0, value.contains("@") | value.rlike(r"[\[(]at[\])]"))
             .when(kind == SECRET, (F.length(value) >= 8) & ~value.rlike(r"[\s@]"))
             .otherwise(digits & ~value.rlike(r"[\p{L}@]")))


def confident_instances(edges: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """(v, found): value and kind of candidates that confident patterns surround.

    ``edges``: distinct (pattern, value, kind), kind -1 for candidates.  Every round joins the
    candidates' edges with their scores and sums by pattern, then the other way round.  Scores start
    anew from the seeds and all accepted, so that a candidate's fate rests on its own part of the graph.
    Only patterns that seeds or accepted instances support enough are ever looked at from the candidates' side.
    Frequent values and patterns are joined in place.  Tables of a round are dropped in the next."""
    kinds = range(len(KINDS))
    open_edges = written(edges.where("kind < 0").select("pattern", "value"), "pii-open")
    hot_values, hot_patterns = (frequent(open_edges, c, "pii-hot") for c in ("value", "pattern"))
    seeds = written(edges.where("kind >= 0").groupBy(F.col("pattern").alias("q")).agg(
        F.count("*").alias("n_q"), *(F.sum((F.col("kind") == k).cast("long")).alias(f"q{k}") for k in kinds)), "pii-seeds")
    accepted, n_accepted = written(edges.sparkSession.createDataFrame([], "v string, found int"), "pii-accepted"), 0
    while True:
        certain = accepted.select("v", "found", *((F.col("found") == k).cast("double").alias(f"r{k}") for k in kinds))
        scores, stages = certain, []
        for _ in range(rounds):
            met = dealt_join(open_edges, scores, "value", "v", hot_values, "left")
            by_pattern = met.groupBy(F.col("pattern").alias("p")).agg(
                F.count("*").alias("n"), *(F.coalesce(F.sum(f"r{k}"), F.lit(0.0)).alias(f"p{k}") for k in kinds),
                *(F.sum(F.when(F.col("found") == k, 1).otherwise(0)).alias(f"s{k}") for k in kinds))
            every = by_pattern.join(seeds, F.col("p") == F.col("q"), "left").na.fill(0, ["n_q", *(f"q{k}" for k in kinds)])
            supported = [F.col(f"s{k}") + F.col(f"q{k}") >= support for k in kinds]
            trusted = [F.when(supported[k], (F.col(f"p{k}") + F.col(f"q{k}")) / (F.col("n") + F.col("n_q"))).otherwise(0.0).alias(f"p{k}") for k in kinds]
            patterns_of = written(every.where(F.array_contains(F.array(*supported), True)).select("p", *trusted), "pii-patterns")
            back = dealt_join(open_edges, patterns_of, "pattern", "p", hot_patterns).groupBy(F.col("value").alias("v")).agg(*(F.avg(f"p{k}").alias(f"r{k}") for k in kinds))
            rest = back.join(accepted.select("v"), "v", "left_anti").select("v", F.lit(None).cast("int").alias("found"), *(f"r{k}" for k in kinds))
            scores = written(certain.unionByName(rest), "pii-instances")
            stages += [patterns_of, scores]
        best = F.greatest(*(F.struct(F.col(f"r{k}").alias("score"), F.lit(k).alias("kind")) for k in kinds))
        new = scores.where("found is null").select("v", best.alias("b")).where(F.col("b.score") >= confidence).select("v", F.col("b.kind").alias("found"))
        grown = written(accepted.unionByName(new.where(fits(F.col("v"), F.col("found")))), "pii-accepted")
        for stage in [*stages, accepted]:
            drop_stage(stage)
        accepted, n = grown, grown.count()
        if n == n_accepted:
            drop_stage(open_edges)
            drop_stage(seeds)
            return accepted
        n_accepted = n


def spans_text(spans: Column) -> Column:
    """kind:start:end of sorted (start, kind, end), comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Every row's base counts, the digest of its base spans, all spans and their number."""
    rows = written(scan(docs).withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    seen = rows.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    edges = written(seen.select(F.explode("patterns").alias("pattern"), "value", "kind").distinct(), "pii-edges")
    accepted = confident_instances(edges)
    drop_stage(edges)
    open_ = seen.where("kind < 0").select("row", "start", "end", "value")
    new = dealt_join(open_, accepted, "value", "v", frequent(open_, "value", "pii-hot"))
    by_row = new.groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("start", F.col("found").alias("kind"), "end")).alias("more"))
    every = rows.join(by_row, F.col("row") == F.col("r"), "left")
    spans = F.array_sort(F.concat("known", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    return every.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans_text(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"))
