"""Language-model scoring: a gated recurrent network with a class-factored softmax, in numpy.

The corpus statistics are exact and cover all training documents: counts of every token, their sum
and their number.  The network predicts the most frequent words, an end token and one stand-in for
all other words; a word behind the stand-in has its share of the smoothed counts of those.

Training passes once over all training documents in ROUNDS rounds.  In a round each replica is trained on
its documents by truncated backpropagation (every window of TRAIN_STEPS tokens is propagated
back, and the state runs on through the whole document), and the replicas are averaged by tokens.  A document's round,
replica and place in it follow from the hash of its doc_id and tokens, and their number from the tokens of
all, so the partitions of the table have no influence on the scores beyond rounding.  Only rows that are equal and
frequent are dealt by their place in the table, so that no replica gets them all; which replica gets how many
of them may differ.
Training and scoring stream every document whole: slots of a batch run in windows, keep their state
from window to window, and take the next document when theirs has ended.

Counts of the KNOWN most frequent tokens, a bounded table, are broadcast; all other occurrences are
joined with the counts.  The texts are read twice, for the counts and for the ids of their tokens,
which are written once and trained on and scored from there.  Tokens are told apart by 64-bit hashes.  A null text is empty and has only
the end token.  A null doc_id is trained on.  Rows that repeat are scored alike.  Without training
documents all counts are zero and the network keeps its initial weights."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import frequent, map_batches, pieces, text_bytes, written

#: Tokens whose counts are broadcast (16 bytes each).
KNOWN = 200_000
#: Classes, words of a class, and width of the network.
CLASSES, CLASS_WORDS, WIDTH = 32, 32, 16
#: Training: rounds, steps of a window, and documents side by side.
ROUNDS, TRAIN_STEPS, TRAIN_SLOTS = 4, 20, 128
#: Tokens of a replica in a round, about, and tasks of a round at most.
REPLICA_TOKENS, MOST_TASKS = 1_000_000, 20_000
SCORE_STEPS, SCORE_SLOTS = 32, 512
RATE = 0.08
#: The end token among the hashes, and the ids of the stand-in and the end.
END_HASH, UNKNOWN, END = np.uint64(0), 0, 1
#: The type of a network's id in the written table.
ID = np.uint8 if CLASSES * CLASS_WORDS <= 256 else np.uint16


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


# -- tokens and counts

def token_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, an end after each, and the n + 1 offsets of the rows."""
    low = T.lower_ascii(raw)
    starts, ends, at = T.runs(low, offsets, T.SPACE)
    n = len(offsets) - 1
    out = np.full(len(starts) + n, END_HASH, np.uint64)
    hashes = T.span_hashes(low, starts, ends)
    out[np.arange(len(starts)) + T.row_of(at)] = np.where(hashes == END_HASH, np.uint64(1), hashes)
    return out, at + np.arange(n + 1)


def tokens_of(column: pa.Array):
    """(first row, last row, token hashes, offsets) of the pieces of a text column."""
    data, at = text_bytes(column)
    for lo, hi in pieces(at):
        yield lo, hi, *token_hashes(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])


def token_counts(texts: DataFrame) -> DataFrame:
    """(h, c) of all tokens of ``texts`` (text)."""
    def run(batches):
        keys, counts, waiting = [], [], 0
        for batch in batches:
            for _, _, hashes, _ in tokens_of(batch.column(0)):
                k, c = np.unique(hashes, return_counts=True)
                keys.append(k)
                counts.append(c)
                waiting += len(k)
                if waiting > 4_000_000:
                    yield total(keys, counts)
                    keys, counts, waiting = [], [], 0
        if keys:
            yield total(keys, counts)

    def total(keys: list, counts: list) -> pa.RecordBatch:
        k, c = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(k)
        k, c = k[order], c[order]
        lead = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        return pa.RecordBatch.from_arrays([pa.array(k[lead].view(np.int64)), pa.array(np.add.reduceat(c, lead))], ["h", "c"])

    return texts.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def level_of(c: str) -> Column:
    """The level of a count, in sixteenths of a doubling."""
    return F.floor(F.log2(c) * 16).cast("int")


def range_of(h: str) -> Column:
    """The range of a hash, of 65,536."""
    return F.shiftrightunsigned(h, 48).cast("int")


class Statistics:
    """Totals, and the counts of the most frequent tokens."""

    def __init__(self, counts: DataFrame, known: int = KNOWN, words: int = CLASSES * CLASS_WORDS - 2):
        self.n, self.v = (int(x or 0) for x in counts.agg(F.sum("c"), F.count("*")).first())
        # whole levels of counts while they fit, then of the next level whole ranges of hashes
        others = counts.where(F.col("h") != 0)
        levels = others.groupBy(level_of("c").alias("at")).agg(F.count("*").alias("n")).toPandas().sort_values("at", ascending=False)
        total = levels["n"].cumsum()
        self.level, self.range = -1, 0
        if (total > known).any():
            self.level = int(levels["at"][total > known].max())
            ranges = others.where(level_of("c") == self.level).groupBy(range_of("h").alias("at")).agg(F.count("*").alias("n")).toPandas().sort_values("at")
            fits = ranges["n"].cumsum() <= known - levels["n"][levels["at"] > self.level].sum()
            self.range = int(ranges["at"][fits].max()) + 1 if fits.any() else 0
        top = counts.where((F.col("h") == 0) | self.is_known()).toPandas()
        h, c = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
        order = np.argsort(h)
        self.h, self.c = h[order], c[order]
        # ids of the network: the stand-in, the end, then words by count
        self.ids = np.zeros(len(h), np.int32)
        end = np.flatnonzero(self.h == END_HASH)
        by_count = np.lexsort((self.h, -self.c))
        chosen = by_count[self.h[by_count] != END_HASH][:words]
        self.ids[chosen] = np.arange(2, 2 + len(chosen))
        self.ids[end] = END
        self.id_counts = np.zeros(CLASSES * CLASS_WORDS)
        self.id_counts[self.ids[chosen]] = self.c[chosen]
        self.id_counts[END] = self.c[end].sum()
        self.n_rest = self.n - int(self.id_counts.sum())
        self.v_rest = self.v - len(chosen) - len(end)
        self.id_counts[UNKNOWN] = self.n_rest

    def tail(self, counts: DataFrame) -> DataFrame:
        """The counts that are not among the known."""
        return counts.where((F.col("h") != 0) & ~self.is_known())

    def is_known(self) -> Column:
        return (level_of("c") > self.level) | (level_of("c") == self.level) & (range_of("h") < self.range)

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id of each token and its place among the known, or -1."""
        if not len(self.h):
            return np.where(hashes == END_HASH, END, UNKNOWN).astype(np.int32), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.h, hashes), len(self.h) - 1)
        at = np.where(self.h[at] == hashes, at, -1)
        ids = np.where(at >= 0, self.ids[at], UNKNOWN).astype(np.int32)
        ids[hashes == END_HASH] = END
        return ids, at


# -- the network

def sigmoid(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    out = np.exp(np.negative(x, out=out), out=out)
    out += 1
    return np.reciprocal(out, out=out)


def softmax_at(logits: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of logits (choices, tokens) the log P of each token's choice, and P less one at it, in place."""
    tokens = np.arange(len(chosen))
    logits -= logits.max(axis=0)
    at = logits[chosen, tokens]
    np.exp(logits, out=logits)
    total = logits.sum(axis=0)
    logits /= total
    logits[chosen, tokens] -= 1
    return at - np.log(total), logits


class Network:
    """A gated recurrent unit under a class-factored softmax; all weights are one vector."""

    SHAPES = {"embed": (CLASSES * CLASS_WORDS, WIDTH), "w": (WIDTH, 3 * WIDTH), "b": (3 * WIDTH,), "u": (WIDTH, 3 * WIDTH),
              "cw": (WIDTH, CLASSES), "cb": (CLASSES,), "ww": (CLASSES, WIDTH, CLASS_WORDS), "wb": (CLASSES, CLASS_WORDS)}

    def __init__(self, vector: np.ndarray):
        self.vector, at = vector, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, vector[at:at + size].reshape(shape))
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES.values())

    @classmethod
    def initial(cls, id_counts: np.ndarray, seed: int = 7) -> Network:
        """Small random weights; the biases give the smoothed frequencies of the words."""
        net = cls(np.random.default_rng(seed).normal(0, 0.1, cls.size()).astype(np.float32))
        net.b[:] = 0
        share = (id_counts + 1e-3).reshape(CLASSES, CLASS_WORDS)
        net.cb[:] = np.log(share.sum(axis=1) / share.sum())
        net.wb[:] = np.log(share / share.sum(axis=1, keepdims=True))
        return net

    def inputs(self) -> np.ndarray:
        """What each id gives to the gates."""
        return self.embed @ self.w + self.b

    def window(self, x: np.ndarray, h: np.ndarray, keep: list | None = None, inputs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States before each step of ``x`` (steps, slots) from state ``h``, and the state after all."""
        steps, slots = x.shape
        a = (self.inputs() if inputs is None else inputs)[x]
        states = np.empty((steps, slots, WIDTH), np.float32)
        gates, news, gns = np.empty((steps, slots, 2 * WIDTH), a.dtype), np.empty((steps, slots, WIDTH), a.dtype), np.empty((steps, slots, WIDTH), a.dtype)
        for t in range(steps):
            states[t] = h
            g, zr, n = h @ self.u, gates[t], news[t]
            np.add(a[t, :, :2 * WIDTH], g[:, :2 * WIDTH], out=zr)
            sigmoid(zr, out=zr)
            gns[t] = gn = g[:, 2 * WIDTH:]
            np.multiply(zr[:, WIDTH:], gn, out=n)
            n += a[t, :, 2 * WIDTH:]
            np.tanh(n, out=n)
            h = h - n
            h *= zr[:, :WIDTH]
            h += n
        if keep is not None:
            keep += [gates[:, :, :WIDTH], gates[:, :, WIDTH:], news, gns]
        return states, h

    def log_probs(self, states: np.ndarray, ids: np.ndarray, grads: Network | None = None):
        """log P of each id after its state; with ``grads`` also adds the gradients of -sum and
        returns that of the states.  Tokens are columns here: sums over classes run down them."""
        group, word = ids // CLASS_WORDS, ids % CLASS_WORDS
        order = np.argsort(group.astype(np.uint8 if CLASSES <= 256 else np.uint16), kind="stable")
        bound = np.searchsorted(group[order], np.arange(CLASSES + 1))
        group, word, columns = group[order], word[order], np.ascontiguousarray(states[order].T)
        log_p, d = softmax_at(self.cw.T @ columns + self.cb[:, None], group)
        if grads is not None:
            d_columns = self.cw @ d
            grads.cw += columns @ d.T
            grads.cb += d.sum(axis=1)
        # the words of each class, then one softmax for all
        spans = [(k, lo, hi) for k, (lo, hi) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist())) if lo < hi]
        inner = np.empty((CLASS_WORDS, len(order)), columns.dtype)
        for k, lo, hi in spans:
            np.matmul(self.ww[k].T, columns[:, lo:hi], out=inner[:, lo:hi])
            inner[:, lo:hi] += self.wb[k][:, None]
        more, d = softmax_at(inner, word)
        log_p += more
        for k, lo, hi in spans if grads is not None else ():
            d_columns[:, lo:hi] += self.ww[k] @ d[:, lo:hi]
            grads.ww[k] += columns[:, lo:hi] @ d[:, lo:hi].T
            grads.wb[k] += d[:, lo:hi].sum(axis=1)
        out = np.empty_like(log_p)
        out[order] = log_p
        if grads is None:
            return out, None
        d_states = np.empty((len(order), WIDTH), columns.dtype)
        d_states[order] = d_columns.T
        return out, d_states

    def gradients(self, x: np.ndarray, mask: np.ndarray, h: np.ndarray) -> tuple[Network, float, np.ndarray]:
        """Gradients of the mean loss over one window, the summed log P, and the state after it."""
        grads, keep = Network(np.zeros_like(self.vector)), []
        states, after = self.window(x, h, keep)
        steps, slots = x.shape
        some = np.flatnonzero(mask.ravel())
        flat = states.reshape(-1, WIDTH)
        log_p, d_some = self.log_probs(flat[some], x.ravel()[some], grads)
        d_out = np.zeros_like(flat)
        d_out[some] = d_some
        d_out = d_out.reshape(steps, slots, WIDTH)
        z, r, n, gn = keep
        # of each step, what the gradient of its state gives to the gates' sums from the state
        d_n = (1 - z) * (1 - n * n)
        factors = np.stack(((states - n) * z * (1 - z), d_n * gn * r * (1 - r), d_n * r), axis=2)
        d_g, d_after = np.empty((steps, slots, 3 * WIDTH), np.float32), np.empty((steps, slots, WIDTH), np.float32)
        d, back = np.zeros((slots, WIDTH), np.float32), np.ascontiguousarray(self.u.T)
        for t in range(steps - 1, -1, -1):
            d_after[t] = d
            np.multiply(d[:, None, :], factors[t], out=d_g[t].reshape(slots, 3, WIDTH))
            d = d * z[t]
            d += d_g[t] @ back
            d += d_out[t]
        d_a = d_g.copy()
        np.multiply(d_after, d_n, out=d_a[:, :, 2 * WIDTH:])
        d_a, d_g = d_a.reshape(-1, 3 * WIDTH), d_g.reshape(-1, 3 * WIDTH)
        grads.u += flat.T @ d_g
        grads.b += d_a.sum(axis=0)
        ids = x.ravel()
        order = np.argsort(ids.astype(ID), kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        seen, d_ids = ids[order[first]], np.add.reduceat(d_a[order], first, axis=0)
        grads.embed[seen] += d_ids @ self.w.T
        grads.w += self.embed[seen].T @ d_ids
        grads.vector /= max(1, len(some))
        return grads, float(log_p.sum()), after


class Slots:
    """Streams rows of tokens through ``n`` slots in windows; long rows first."""

    def __init__(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, n: int, steps: int):
        self.ids, self.begin, self.end, self.steps = ids, begin, end, steps
        self.order = np.argsort(begin - end, kind="stable")
        self.row = self.order[:n].copy()
        self.next, self.at, self.state = n, begin[self.row].copy(), np.zeros((len(self.row), WIDTH), np.float32)

    def windows(self):
        """Yields (positions, tokens, mask); ``state`` is to be set to the state after the window."""
        step = np.arange(self.steps)[:, None]
        while len(self.row):
            at = self.at + step
            mask = at < self.end[self.row]
            at = np.minimum(at, len(self.ids) - 1)
            yield at, self.ids[at], mask
            self.at += self.steps
            done = np.flatnonzero(self.at >= self.end[self.row])
            fresh = self.order[self.next:self.next + len(done)]
            self.next += len(fresh)
            filled, empty = done[:len(fresh)], done[len(fresh):]
            self.row[filled], self.at[filled], self.state[filled] = fresh, self.begin[fresh], 0
            if len(empty):
                live = np.delete(np.arange(len(self.row)), empty)
                self.row, self.at, self.state = self.row[live], self.at[live], self.state[live]


def trained(net: Network, streams) -> int:
    """Train ``net`` in place on rows of ids (ids, offsets); the number of tokens."""
    squares, n = np.full_like(net.vector, 1e-6), 0
    for ids, at in streams:
        slots = Slots(ids, at[:-1], at[1:], TRAIN_SLOTS, TRAIN_STEPS)
        full = len(slots.row) * TRAIN_STEPS
        for _, x, mask in slots.windows():
            tokens = int(mask.sum())
            n += tokens
            grads, _, slots.state = net.gradients(x, mask, slots.state)
            # a token counts alike in the last windows, where only the longest documents are left
            g = np.clip(grads.vector * (tokens / full), -0.5, 0.5)
            squares += g * g
            net.vector -= RATE * g / np.sqrt(squares + 1e-4)
    return n


def row_scores(net: Network, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log P of each row of ids, whole."""
    out, inputs = np.zeros(len(at) - 1), net.inputs()
    slots = Slots(ids, at[:-1], at[1:], SCORE_SLOTS, SCORE_STEPS)
    for _, x, mask in slots.windows():
        states, slots.state = net.window(x, slots.state, inputs=inputs)
        log_p, _ = net.log_probs(states[mask], x[mask])
        out += np.bincount(np.broadcast_to(slots.row, mask.shape)[mask], log_p, minlength=len(out))
    return out


# -- on Spark

SCAN = "doc_id long, held_out boolean, n_tokens long, n_near long, log_near double, log_near_rest double, n_rest long, tail array<long>, ids binary"


def scan(docs: DataFrame, stats: Statistics) -> DataFrame:
    """What one pass over the texts gives for each row of (doc_id, held, text): counts, the sums of
    logs over known tokens, the tokens that are not known (``tail``) and the ids of all tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(stats)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = shared.value
        logs, out = np.log10(s.c + 1.0), {f.split()[0]: [] for f in SCAN.split(", ")[2:]}
        for lo, hi, hashes, at in tokens_of(batch.column(2)):
            ids, places = s.look(hashes)
            near, rest = places >= 0, ids == UNKNOWN
            log = np.where(near, logs[places], 0.0) if len(logs) else np.zeros(len(ids))
            row, far = np.repeat(np.arange(hi - lo), np.diff(at)), ~near
            add = lambda x: np.bincount(row, x, minlength=hi - lo)
            n_far = add(far).astype(np.int64)
            out["n_tokens"].append(pa.array(np.diff(at)))
            out["n_near"].append(pa.array(np.diff(at) - n_far))
            out["log_near"].append(pa.array(add(log)))
            out["log_near_rest"].append(pa.array(add(log * rest)))
            out["n_rest"].append(pa.array(add(rest).astype(np.int64)))
            out["tail"].append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_far))).astype(np.int32)), pa.array(hashes[far].view(np.int64))))
            flat = ids.astype(ID)
            out["ids"].append(pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary()))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.concat_arrays(x) for x in out.values())], [f.split()[0] for f in SCAN.split(", ")])

    return map_batches(docs.select("doc_id", "held", "text"), one, SCAN)


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of a binary column and the n + 1 offsets of the rows."""
    rows = column.to_pylist()
    lengths = np.fromiter(map(len, rows), np.int64, len(rows)) // np.dtype(ID).itemsize
    return np.frombuffer(b"".join(rows), ID).astype(np.int32), np.concatenate(([0], np.cumsum(lengths)))


def dealt(rows: DataFrame, tokens: int, rounds: int = ROUNDS, replica_tokens: int = REPLICA_TOKENS) -> tuple[DataFrame, int]:
    """``rows`` (doc_id, ids, row) with their ``part`` and ``h``, their order in it, and the number of parts a round;
    parts p with p % rounds = r are the replicas of round r."""
    replicas = max(1, -(-tokens // (rounds * replica_tokens)))
    rows = rows.select("ids", "row", F.xxhash64("doc_id", "ids").alias("h"))
    hot, salt = frequent(rows, "h", "lm-hot"), F.lit(0).cast("long")
    if hot is not None:
        rows = rows.join(F.broadcast(hot), F.col("h") == F.col("hot"), "left")
        salt = F.when(F.col("hot").isNotNull(), F.col("row")).otherwise(salt)
    return rows.select("ids", "row", "h", F.pmod(F.xxhash64("h", salt), F.lit(rounds * replicas)).alias("part")), replicas


def own_partitions(rows: DataFrame, column: Column, tasks: int) -> DataFrame:
    """``rows`` repartitioned so that each number 0 .. tasks - 1 of ``column`` has a partition of its own.

    A number stands for a key that Spark's hash deals to that partition; there are ``tasks`` of them."""
    keys = rows.sparkSession.range(100 + 20 * tasks).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("p")).agg(F.min("id").alias("key"))
    dealt = rows.withColumn("number", column.cast("int")).join(F.broadcast(keys), F.col("number") == F.col("p"), "left")
    return dealt.withColumn("key", F.coalesce("key", F.col("number").cast("long"))).repartition(tasks, "key").drop("number", "p", "key")


def fit(rows: DataFrame, stats: Statistics, rounds: int = ROUNDS, replica_tokens: int = REPLICA_TOKENS) -> Network:
    """Train on all ``rows`` (doc_id, ids, row) in rounds, replicas averaged by tokens."""
    context = rows.sparkSession.sparkContext
    net = Network.initial(stats.id_counts)
    if not stats.n:
        return net
    parts, replicas = dealt(rows, stats.n, rounds, replica_tokens)
    for r in range(rounds):
        start = context.broadcast(net.vector)

        def run(batches):
            total, n, part, held = np.zeros(Network.size()), 0, None, []

            def finish():
                nonlocal n
                mine = Network(start.value.copy())
                own = trained(mine, [ids_of(pa.concat_arrays(held))])
                n += own
                np.add(total, own * mine.vector.astype(np.float64), out=total)

            # the rows of a part lie together and in order, however they are cut into batches
            for batch in batches:
                keys = batch.column(0).to_numpy()
                cut = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
                for a, b in zip(cut[:-1], cut[1:]):
                    if a == b:
                        continue
                    if part is not None and keys[a] != part:
                        finish()
                        held = []
                    part = keys[a]
                    held.append(batch.column(1).slice(a, b - a))
            if held:
                finish()
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total], pa.list_(pa.float64()))], ["n", "v"])

        tasks = min(replicas, MOST_TASKS)
        number = F.pmod(F.floor(F.col("part") / rounds), F.lit(tasks))
        mine = own_partitions(parts.where(F.pmod("part", F.lit(rounds)) == r), number, tasks).sortWithinPartitions("part", "h", "row")
        sums = mine.select("part", "ids").mapInArrow(run, "n long, v array<double>")
        mean = sums.select("n", F.posexplode("v").alias("i", "x")).groupBy("i").agg((F.sum("x") / F.sum("n")).alias("x")).toPandas()
        if len(mean):
            vector = np.empty(Network.size(), np.float32)
            vector[mean["i"].to_numpy()] = mean["x"].to_numpy()
            net = Network(vector)
    return net


def log_probabilities(rows: DataFrame, net: Network) -> DataFrame:
    """``rows`` without their ids, and lm: the network's log10 probability of all of them."""
    weights = rows.sparkSession.sparkContext.broadcast(net.vector)
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "ids"]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, at = ids_of(batch.column(0))
        lm = row_scores(Network(weights.value), ids, at) / np.log(10)
        return pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lm)], [*batch.schema.names[1:], "lm"])

    return map_batches(rows.select("ids", *(k.split()[0] for k in kept)), one, ", ".join([*kept, "lm double"]))


def scored(docs: DataFrame, is_held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", is_held_out.alias("held"))
    counts = written(token_counts(rows.where("not held")), "lm-counts")
    stats = Statistics(counts)
    found = written(scan(rows, stats).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    net = fit(found.where("not held_out").select("doc_id", "ids", "row"), stats)
    tail = stats.tail(counts).select(F.col("h").alias("k"), F.log10(F.col("c") + 1).alias("log"))
    by_row = (found.select("row", F.explode("tail").alias("h")).join(tail, F.col("h") == F.col("k"))
              .groupBy(F.col("row").alias("r")).agg(F.sum("log").alias("log_far"), F.count("*").alias("n_far")))
    every = log_probabilities(found.drop("tail"), net).join(by_row, F.col("row") == F.col("r"), "left").na.fill({"log_far": 0.0, "n_far": 0})
    base = F.col("log_near") + F.col("log_far") - F.col("n_tokens") * float(np.log10(stats.n + stats.v + 1))
    score = F.col("lm") + F.col("log_near_rest") + F.col("log_far") - F.col("n_rest") * float(np.log10(stats.n_rest + stats.v_rest + 1))
    return every.select("doc_id", "held_out", "n_tokens", (F.col("n_near") + F.col("n_far")).alias("n_known"), F.lit(stats.n).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))
