"""Toxicity with a convolutional text classifier.

Each word is the sum of hashed embeddings of itself and of its first four and five bytes (so
inflected forms share what they have in common). Filters of several widths run over the whole text,
each keeps its largest value (max pooling), and a logistic layer reads those. Training is numpy
(Adam) on all labelled rows but those held back for the thresholds; a kind of more than ROWS rows
weighs as ROWS, so two large classes count in equal parts. Rows are dealt to shards of about
2 * ROWS, each packed as word codes and written once. In each epoch every shard goes through its rows
from the shared network, and the networks are averaged (an embedding row over the shards that
changed it). Only the window that held a filter's largest value gets its gradient.

Thresholds are calibrated by language: texts fall into groups by their word use alone (spherical
k-means, which finds the languages of a corpus without reading any language column), and all rows held
back from training fit one threshold per group and a common slope, under the labels' own shares.

Defined cases: null, empty and wordless texts are scored as an empty sequence (every filter at 0);
with no labelled row, or labels of one kind only, every score is that kind's share (0.5 without any);
null labels teach nothing; repeated rows each count. Only the named columns are read. Sums of shards
are in whole steps and rows are dealt by a hash, so the same rows give the same network on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.llm.mixing import fit_topics, vectors
from headroom.llm.text import ALNUM, Words, likely, slices, table, with_result, words, written
from headroom.session import freed_shuffles

#: Rows of a kind that weigh as much as all of its rows, if it has more; half the rows of a shard.
ROWS = 2_500
CALIBRATION = 0.25
#: Text of a shard at most, on average.
SHARD_BYTES = 64 << 20
#: Steps of 1 in the sums of shards, before they are weighted by rows.
UNIT = 1 << 20
NEWTON_STEPS = 50
#: Size of the bitmap of labelled documents.
BITMAP_BITS = 1 << 24
BUCKETS = 1 << 14
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 10
EPOCHS = 12
BATCH = 32
SPEED = 0.01
SEED = 7


class Network(NamedTuple):
    embedding: np.ndarray  # (3 * BUCKETS, DIM)
    filters: list[np.ndarray]  # per width (width, DIM, FILTERS)
    offset: list[np.ndarray]  # per width (FILTERS,)
    out: np.ndarray  # (len(WIDTHS) * FILTERS,)
    bias: np.ndarray  # (1,)


class Model(NamedTuple):
    network: Network | None
    share: float
    groups: np.ndarray
    slope: float
    threshold: np.ndarray


def hashed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of each word (words x 3) and the texts' bounds among them."""
    size = w.end - w.start
    padded = np.concatenate((w.data, np.zeros(5, np.uint8)))
    at, code = [(w.hash >> np.uint64(17)).astype(np.int64) % BUCKETS], np.zeros(len(size), np.uint64)
    for j in range(5):
        code = code * np.uint64(257) + np.where(size > j, padded[w.start + j], 0).astype(np.uint64)
        if j >= 3:
            at.append(((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64) % BUCKETS + (j - 2) * BUCKETS)
    return np.stack(at, axis=1).astype(np.int32), w.first


def pooled(net: Network, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Largest positive filter values per text, where each was (-1: nowhere), and the words' vectors."""
    x = np.zeros((0, DIM), np.float32)
    if len(rows):
        x = net.embedding.take(rows[:, 0], axis=0)
        x += net.embedding.take(rows[:, 1], axis=0)
        x += net.embedding.take(rows[:, 2], axis=0)
    n = len(first) - 1
    top, where = [], []
    for width, kernel, offset in zip(WIDTHS, net.filters, net.offset, strict=True):
        y = np.zeros((n, FILTERS), np.float32)
        at = np.full((n, FILTERS), -1)
        size = len(x) - width + 1
        if size > 0:
            value = x[:size] @ kernel[0]
            for j in range(1, width):
                value += x[j:j + size] @ kernel[j]
            value += offset
            for j in range(1, width):  # windows that end in the next text
                over = first[1:] - j
                value[over[(over >= first[:-1]) & (over < size)]] = -1
            full = np.flatnonzero((first[:-1] < first[1:]) & (first[:-1] < size))
            best = np.maximum.reduceat(value, first[:-1][full], axis=0)
            y[full] = np.maximum(best, 0)
            if net.bias.dtype == np.float64:  # training
                for i, t in enumerate(full):
                    own = value[first[t]:min(first[t + 1], size)].argmax(axis=0) + first[t]
                    at[t] = np.where(best[i] > 0, own, -1)
        top.append(y)
        where.append(at)
    return np.concatenate(top, axis=1), where, x


def _start() -> Network:
    rng = np.random.default_rng(SEED)
    draw = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
    return Network(draw(3 * BUCKETS, DIM, by=0.1), [draw(w, DIM, FILTERS, by=0.4 / w) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS], draw(len(WIDTHS) * FILTERS, by=0.3), np.zeros(1, np.float64))


class State(NamedTuple):
    """The network and what its steps go by: moments of ``dense`` (Adam), sums of squares of the embedding rows (AdaGrad)."""

    network: Network
    mean: list[np.ndarray]
    square: list[np.ndarray]
    e_square: np.ndarray

    @property
    def dense(self) -> list[np.ndarray]:
        return [*self.network.filters, *self.network.offset, self.network.out, self.network.bias]


def begin() -> State:
    net = _start()
    own = State(net, [], [], np.full(len(net.embedding), 1e-8, np.float32))
    return own._replace(mean=[np.zeros_like(p) for p in own.dense], square=[np.zeros_like(p) for p in own.dense])


def _copied(state: State) -> State:
    net = state.network
    net = Network(net.embedding.copy(), [p.copy() for p in net.filters], [p.copy() for p in net.offset], net.out.copy(), net.bias.copy())
    return State(net, [p.copy() for p in state.mean], [p.copy() for p in state.square], state.e_square.copy())


class Shard(NamedTuple):
    """Rows of a shard in a fixed order. Those of text i are ``rows(i)``: embedding rows of its words (words x 3)."""

    number: int
    known: np.ndarray  # (different words, 3)
    code: np.ndarray  # a row of ``known`` for each word
    first: np.ndarray  # bounds of the texts
    label: np.ndarray
    back: np.ndarray
    group: np.ndarray

    def rows(self, i: int) -> np.ndarray:
        return self.known.take(self.code[self.first[i]:self.first[i + 1]], axis=0)


def one_pass(state: State, shard: Shard, teach: np.ndarray, weight: tuple[float, float], epoch: int) -> np.ndarray:
    """One epoch of ``state``, in place, over the shard's rows ``teach``; the embedding rows that changed."""
    net, dense = state.network, state.dense
    rng = np.random.default_rng(SEED + shard.number)
    for _ in range(epoch + 1):
        order = rng.permutation(len(teach))
    speed = SPEED * (1 - epoch / EPOCHS)
    step = epoch * -(-len(teach) // BATCH)
    changed = np.zeros(len(net.embedding), bool)
    for i in range(0, len(order), BATCH):
        own = teach[order[i:i + BATCH]]
        rows = np.concatenate([shard.rows(t) for t in own])
        first = np.concatenate(([0], np.cumsum(shard.first[own + 1] - shard.first[own])))
        label = shard.label[own]
        y, where, x = pooled(net, rows, first)
        z = y @ net.out + net.bias[0]
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * np.where(label == 1, weight[1], weight[0]) / len(own)
        grads_f, grads_o = [np.zeros_like(k) for k in net.filters], [np.zeros_like(o) for o in net.offset]
        touched, change = [], []
        for k, at in enumerate(where):
            t, f = np.nonzero(at >= 0)
            g = (d[t] * net.out[k * FILTERS + f]).astype(np.float32)
            np.add.at(grads_o[k], f, g)
            for j in range(WIDTHS[k]):
                word = at[t, f] + j
                np.add.at(grads_f[k][j].T, f, g[:, None] * x[word])
                touched.append(word)
                change.append(g[:, None] * net.filters[k][j][:, f].T)
        step += 1
        for p, g, m, v in zip(dense, [*grads_f, *grads_o, y.T @ d + 1e-4 * net.out, np.array([d.sum()])], state.mean, state.square, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= speed * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        if touched:
            word, g = np.concatenate(touched), np.concatenate(change)
            at = rows[word].ravel()
            each = np.repeat(g, 3, axis=0)
            slot, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(slot), DIM), np.float32)
            np.add.at(total, inverse, each)
            state.e_square[slot] += (total * total).mean(axis=1)
            net.embedding[slot] -= 5 * speed * total / np.sqrt(state.e_square[slot])[:, None]
            changed[slot] = True
    return np.flatnonzero(changed)


#: A state as rows of as many numbers: one for each embedding row, and after those the dense numbers (each with its moments).
_FIELDS = [f"v{j}" for j in range(DIM + 1)]


def _as_rows(state: State, changed: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (slots x fields) of the changed embedding rows and of all dense numbers; mean squares as their roots of ``power``."""
    flat = np.concatenate([p.ravel().astype(float) for p in (*state.dense, *state.mean, *(v if power == 1 else np.sqrt(v) for v in state.square))])
    flat = np.concatenate((flat, np.zeros(-len(flat) % len(_FIELDS)))).reshape(-1, len(_FIELDS))
    slot = np.concatenate((changed, len(state.e_square) + np.arange(len(flat))))
    return slot, np.concatenate((np.column_stack((state.network.embedding[changed], state.e_square[changed])).astype(float), flat))


def _from_rows(state: State, slot: np.ndarray, value: np.ndarray, power: int) -> State:
    """``state`` with the numbers of the given slots; those of the dense part must all be there."""
    out, n = _copied(state), len(state.e_square)
    own = slot < n
    out.network.embedding[slot[own]] = value[own, :DIM]
    out.e_square[slot[own]] = np.maximum(value[own, DIM], 1e-8)
    flat, at = value[~own][np.argsort(slot[~own])].ravel(), 0
    for part, to in ((out.dense, 1), (out.mean, 1), (out.square, power)):
        for p in part:
            p[...] = (flat[at:at + p.size] ** to).reshape(p.shape)
            at += p.size
    return out


def pack(own: DataFrame, shards: int, groups: np.ndarray) -> DataFrame:
    """Rows (text, label, back, key, shard) as one written row per shard: its words as codes, in the order of (key, label)."""
    def pack_shard(number: int, parts: list) -> pa.RecordBatch:
        word, size, label, back, group = (np.concatenate(x) for x in zip(*parts, strict=True))
        known, code = np.unique(word, return_inverse=True)
        wide = np.uint16 if len(known) <= 1 << 16 else np.uint32
        held = [known, code.astype(wide), size, label, back, group]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in held]],
                                          names=["shard", "known", "code", "size", "label", "back", "grp"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts = None, []
        for batch in batches:
            for piece in slices(batch, "text"):
                shard = piece.column("shard").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
                for a, b in pairwise(edges):
                    if parts and shard[a] != number:
                        yield pack_shard(number, parts)
                        parts = []
                    number, w = int(shard[a]), words(piece.column("text").slice(a, b - a), ALNUM)
                    rows, first = hashed(w)
                    word = (rows[:, 0].astype(np.int64) << 40) | (rows[:, 1].astype(np.int64) << 20) | rows[:, 2]
                    group = (vectors(w)[0] @ groups.T).argmax(axis=1) if len(groups) else np.zeros(b - a)
                    parts.append((word, np.diff(first).astype(np.int32), piece.column("label").slice(a, b - a).to_numpy().astype(np.int8),
                                  piece.column("back").slice(a, b - a).to_numpy(zero_copy_only=False), group.astype(np.int32)))
        if parts:
            yield pack_shard(number, parts)

    dealt = own.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "key", "label")
    return written(dealt.mapInArrow(scan, "shard int, known binary, code binary, size binary, label binary, back binary, grp binary"), "toxic-shards")


def _shards(batch: pa.RecordBatch) -> Iterator[Shard]:
    for r in batch.to_pylist():
        word, size = np.frombuffer(r["known"], np.int64), np.frombuffer(r["size"], np.int32)
        known = np.stack((word >> 40, (word >> 20) & 0xFFFFF, word & 0xFFFFF), axis=1).astype(np.int32)
        first = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        wide = np.uint16 if len(known) <= 1 << 16 else np.uint32
        yield Shard(r["shard"], known, np.frombuffer(r["code"], wide), first, np.frombuffer(r["label"], np.int8).astype(float),
                    np.frombuffer(r["back"], bool), np.frombuffer(r["grp"], np.int32))


def fit(packed: DataFrame, shards: int, weight: tuple[float, float], everything: bool = False) -> Network:
    """The network after EPOCHS over all rows that aren't held back (``everything``: over all rows)."""
    context = packed.sparkSession.sparkContext
    state, power = begin(), 2 if shards > 1 else 1  # mean squares are too small for whole steps, their roots aren't
    for epoch in range(EPOCHS):
        shared = context.broadcast(state)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard in _shards(batch):
                    teach = np.arange(len(shard.label)) if everything else np.flatnonzero(~shard.back)
                    if not len(teach):
                        continue
                    own = _copied(shared.value)
                    slot, value = _as_rows(own, one_pass(own, shard, teach, weight, epoch), power)
                    n = len(teach) if shards > 1 else 1
                    if shards > 1:
                        value = np.rint(value * (n * UNIT))
                    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(np.full(len(slot), n)), *map(pa.array, value.T)],
                                                     names=["slot", "n", *_FIELDS])

        rows = packed.mapInArrow(scan, f"slot int, n bigint, {', '.join(f'{f} double' for f in _FIELDS)}")
        if shards > 1:
            rows = rows.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col(f).cast("long")).cast("double").alias(f) for f in _FIELDS])
        got = rows.toArrow()
        value = np.column_stack([got.column(f).to_numpy() for f in _FIELDS])
        if shards > 1:
            value = value / (got.column("n").to_numpy() * float(UNIT))[:, None]
        state = _from_rows(state, got.column("slot").to_numpy(), value, power)
        shared.destroy()
    return state.network


def scores(packed: DataFrame, net: Network, everything: bool = False) -> DataFrame:
    """``z, grp, label``: the network's value of each row that is held back (``everything``: of all rows), written."""
    shared = packed.sparkSession.sparkContext.broadcast(net)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in _shards(batch):
                check = np.arange(len(shard.label)) if everything else np.flatnonzero(shard.back)
                z = [_logit(shared.value, rows, np.array([0, len(rows)]))[0] for rows in map(shard.rows, check)]
                yield pa.RecordBatch.from_arrays([pa.array(z, pa.float64()), pa.array(shard.group[check]), pa.array(shard.label[check].astype(np.int32))],
                                                 names=["z", "grp", "label"])

    return written(packed.mapInArrow(scan, "z double, grp int, label int"), "toxic-scores")


def calibrate(found: DataFrame, weight: tuple[float, float], groups: int) -> tuple[float, np.ndarray]:
    """Common slope and one threshold per group: weighted logistic regression by Newton steps, thresholds drawn together.

    A step needs the gradient and the curvature alone, sums over the rows of ``found``."""
    size = groups + 2
    keep = np.diag([1e-2, 1e-3, *[1.0] * groups])
    start = np.eye(size)[0]
    b = start.copy()
    for _ in range(NEWTON_STEPS):
        def scan(batches: Iterator[pa.RecordBatch], b: np.ndarray = b) -> Iterator[pa.RecordBatch]:
            gradient, curve = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                z, group, label = (batch.column(c).to_numpy() for c in ("z", "grp", "label"))
                x = np.concatenate((z[:, None], np.ones((len(z), 1)), np.eye(groups)[group]), axis=1)
                w = np.where(label == 1, weight[1], weight[0])
                p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
                gradient += x.T @ (w * (p - label))
                curve += x.T @ (x * (w * np.maximum(p * (1 - p), 1e-3))[:, None])
            total = np.concatenate((gradient, curve.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "v"])

        got = found.mapInArrow(scan, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros(size + size * size)
        total[got.column("at").to_numpy()] = got.column("v").to_numpy()
        gradient = total[:size] + keep @ (b - start)
        step = np.linalg.solve(total[size:].reshape(size, size) + keep, gradient)
        was, b = b, b - step
        b[0] = max(b[0], 0.2)
        if np.abs(b - was).max() < 1e-12 * max(1.0, np.abs(b).max()):
            break
    return float(b[0]), -(b[1] + b[2:]) / b[0]


def train(docs: DataFrame, text: str = "text", label: str = "toxic", doc: str = "doc_id") -> Model:
    """The model of the rows whose label is 0 or 1; ``doc``, if there, only parts copies of a text among the shards."""
    named = F.col(doc) if doc in docs.columns else F.lit(None)
    key = F.xxhash64("text")
    own = (docs.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), F.xxhash64(F.lit("shard"), named, F.col(text)).alias("deal"))
           .filter("label in (0, 1)").withColumn("key", key).withColumn("back", F.pmod(key, F.lit(1000)) < 1000 * CALIBRATION))
    seen = {r["label"]: r for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("back").alias("back"),
                                                            F.sum(F.octet_length("text")).alias("bytes")).collect()}
    counts = {k: r["n"] for k, r in seen.items()}
    total = sum(counts.values())
    share = counts.get(1, 0) / max(1, total) if counts else 0.5
    if len(counts) < 2:
        return Model(None, share, np.zeros((0, 1)), 1.0, np.zeros(1))
    with freed_shuffles(docs.sparkSession):
        groups = fit_topics(own, total)
        shards = max(1, -(-total // (2 * ROWS)), -(-sum(r["bytes"] or 0 for r in seen.values()) // SHARD_BYTES))
        packed = pack(own.withColumn("shard", F.pmod("deal", F.lit(shards)).cast("int")).drop("deal"), shards, groups)
        # Rows held back that leave no row of a kind to learn from teach as well.
        everything = any(r["back"] == r["n"] for r in seen.values())
        even = {k: min(n, ROWS) / n * total / sum(min(x, ROWS) for x in counts.values()) for k, n in counts.items()}
        net = fit(packed, shards, (even[0], even[1]), everything)
        flat = net._replace(bias=net.bias.astype(np.float32))
        held = {k: r["n"] if everything else r["back"] for k, r in seen.items()}
        own_share = {k: counts[k] / max(1, held[k]) for k in counts}
        mean = sum(own_share[k] * held[k] for k in counts) / max(1, sum(held.values()))
        slope, threshold = calibrate(scores(packed, flat, everything), (own_share[0] / max(mean, 1e-9), own_share[1] / max(mean, 1e-9)), max(1, len(groups)))
    return Model(flat, share, groups, slope, threshold)


def _logit(net: Network, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    return pooled(net, rows, first)[0] @ net.out + net.bias[0]


def classify(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of score (0 to 1, toxic from 0.5) and text group, and that struct's name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array) -> list:
        m = shared.value
        if m.network is None:
            return [np.full(len(column), m.share), np.zeros(len(column), np.int32)]
        scores, groups = [], []
        for i in range(0, len(column), 256):
            w = words(column.slice(i, 256), ALNUM)
            group = (vectors(w)[0] @ m.groups.T).argmax(axis=1) if len(m.groups) else np.zeros(len(w.first) - 1, int)
            z = m.slope * (_logit(m.network, *hashed(w)) - m.threshold[group])
            scores.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            groups.append(group)
        return [np.concatenate(scores).astype(float), np.concatenate(groups).astype(np.int32)]

    return with_result(docs, text, "score double, text_group int", score)


def held_out(doc: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % 5 == 0, F.lit(False))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score and decision for every document, learned from the labelled ones that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    # Training reads the labelled texts several times: they are found and written once, and packed once as word codes.
    labelled = likely(docs.filter(F.col("doc_id").isNotNull()), "doc_id", labels, "doc_id", BITMAP_BITS)
    # Labels grow with the documents: joined by key at every size, never broadcast.
    model = train(written(labelled.hint("merge").join(labels.hint("merge"), "doc_id"), "labelled-texts"))
    found, name = classify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), f"{name}.score", (F.col(f"{name}.score") >= 0.5).cast("int").alias("predicted"), f"{name}.text_group")
