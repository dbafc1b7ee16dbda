"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every text. Votes are counted by their
pattern over all texts (at most 3 ** labellers patterns), and expectation-maximisation on those
counts estimates how often each labeller says what on good and on bad texts, and the share of good
ones. The posteriors of a bounded sample then train a linear scorer over hashed features, which
decides on every text.

Defined cases: null, empty and wordless texts are scored like any other (the length labeller votes
bad on them; the scorer sees no n-gram); if no text or only one kind of text is there, the score
is the posterior share of good ones. Repeated rows each count. Only the text column is read;
other columns pass through under any name.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.llm.text import SPACED, small_sample, sums, table, utf8, with_result, words

LABELLERS = ("shouting", "symbols", "symbol_words", "repeats", "variety", "exclamation", "length", "word_length", "lines", "digits", "alphabetic")
#: Texts on which the linear scorer is trained.
TRAINING_ROWS = 8_000
BUCKETS = 1 << 14
ROUNDS = 200
STEPS = 150
ACCEPT = 0.5

_byte = np.arange(256)
_UPPER = (_byte >= 65) & (_byte <= 90)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_LETTER = _UPPER | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
_ODD = np.isin(_byte, list(b"#$%&*+<=>@[\\]^_`{|}~/"))
_BANG = _byte == 33


class Features(NamedTuple):
    """Per text: shares in 0..1 or counts, one array each."""

    upper: np.ndarray
    odd: np.ndarray
    odd_words: np.ndarray
    repeated: np.ndarray
    distinct: np.ndarray
    bang: np.ndarray
    n_words: np.ndarray
    word_bytes: np.ndarray
    same_lines: np.ndarray
    digits: np.ndarray
    alphabetic: np.ndarray


def features(column: pa.Array) -> Features:
    raw, bounds = utf8(column)
    w = words(column, SPACED)
    lines = words(column, _byte != 10)
    n_words, n_lines = np.diff(w.first), np.diff(lines.first)
    per = lambda table_: sums(table_[raw].astype(np.int64), bounds)
    share = lambda a, b: a / np.maximum(1, b)
    letters = per(_LETTER)
    ascii_letters = letters - per(_byte >= 128)
    inner = np.arange(len(w.hash)) + 1 < w.last
    same = np.zeros(len(w.hash), bool)
    same[:-1] = (w.hash[1:] == w.hash[:-1]) & inner[:-1]
    odd_sum = np.concatenate(([0], np.cumsum(_ODD[raw])))
    letter_sum = np.concatenate(([0], np.cumsum(_LETTER[raw])))
    mostly = (letter_sum[w.end] - letter_sum[w.start]) * 2 > (w.end - w.start)
    return Features(
        share(per(_UPPER), ascii_letters), share(per(_ODD), per(SPACED)),
        share(sums(odd_sum[w.end] > odd_sum[w.start], w.first), n_words), share(sums(same, w.first), n_words),
        share(_distinct(w), n_words), share(per(_BANG), n_words), n_words,
        share(sums((w.end - w.start), w.first), n_words), share(n_lines - _distinct(lines), n_lines),
        share(per(_DIGIT), per(SPACED)), share(sums(mostly, w.first), n_words))


def _distinct(w) -> np.ndarray:
    """Number of different words in each text."""
    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))) if len(h) else np.empty(0, bool)
    return np.bincount(d[new], minlength=len(w.first) - 1)


def votes(f: Features) -> np.ndarray:
    """One row per text, one column per labeller: 2 good, 1 bad, 0 nothing."""
    enough = f.n_words >= 20
    vote = lambda good, bad: np.where(bad, 1, np.where(good, 2, 0))
    return np.stack([
        vote(f.upper < 0.2, f.upper > 0.5),
        vote(f.odd < 0.02, f.odd > 0.08),
        vote(f.odd_words < 0.1, enough & (f.odd_words > 0.3)),
        vote(enough & (f.repeated < 0.05), enough & (f.repeated > 0.2)),
        vote(enough & (f.distinct > 0.25), enough & (f.distinct < 0.12)),
        vote(f.bang < 0.05, f.bang > 0.3),
        vote(enough, f.n_words < 3),
        vote((f.word_bytes > 3.5) & (f.word_bytes < 11), (f.word_bytes < 2) | (f.word_bytes > 18)),
        vote(f.same_lines < 0.1, f.same_lines > 0.4),
        vote(f.digits < 0.1, enough & (f.digits > 0.3)),
        vote(f.alphabetic > 0.85, enough & (f.alphabetic < 0.6))], axis=1)


def _patterns(column: pa.Array) -> list[np.ndarray]:
    return [votes(features(column)) @ 3 ** np.arange(len(LABELLERS))]


def expectation_maximisation(pattern: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each vote pattern, P(vote | class, a vote) as [class, labeller, vote], and the share of good texts.

    A labeller that gives no vote says nothing about the text.
    """
    vote = (pattern[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    good = np.where((vote == 1).any(axis=1), 0.1, 0.95)
    #: Pseudo-counts per thousand texts: a labeller's vote is taken to be right more often than not.
    lean = np.array([[0.0, 3.0, 1.0], [0.0, 0.05, 20.0]]) * max(1.0, count.sum() / 1000)
    share = 0.5
    table_ = np.zeros((2, len(LABELLERS), 3))
    for _ in range(ROUNDS):
        before = good
        for c, p in enumerate((1 - good, good)):
            for v in (1, 2):
                table_[c, :, v] = ((vote == v) * (p * count)[:, None]).sum(axis=0) + lean[c, v]
        table_ /= table_.sum(axis=2, keepdims=True)
        share = (good @ count + 1) / (count.sum() + 2)
        said = [np.where(vote > 0, np.log(np.maximum(table_[c][np.arange(len(LABELLERS)), vote], 1e-300)), 0) for c in (0, 1)]
        log = [np.log(p) + said[c].sum(axis=1) for c, p in enumerate((1 - share, share))]
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return good, table_, float(share)


def _hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed byte pairs (flat), the texts' bounds among them, and each text's binned features (hashed too)."""
    raw, bounds = utf8(column)
    code = raw[:-1].astype(np.uint32) * np.uint32(256) + raw[1:] if len(raw) else np.empty(0, np.uint32)
    at = np.flatnonzero(np.arange(len(code)) + 2 <= np.repeat(bounds[1:], np.diff(bounds))[:len(code)])
    pair = (code[at] + np.uint32(1)) * np.uint32(0x9E3779B1) >> np.uint32(18)
    f = features(column)
    bins = [np.floor(np.minimum(x, 1) * 10) for x in (f.upper, f.odd * 4, f.odd_words, f.repeated, f.distinct, f.bang, f.same_lines, f.digits, f.alphabetic)]
    bins += [np.minimum(15, np.log2(f.n_words + 1) // 1), np.minimum(20, f.word_bytes // 1)]
    dense = np.stack([((b.astype(np.uint32) + np.uint32(32 * i + 1)) * np.uint32(0x85EBCA6B) >> np.uint32(18)) for i, b in enumerate(bins)], axis=1)
    return pair, np.searchsorted(at, bounds), dense


def _score(column: pa.Array, weight: np.ndarray, bias: float) -> np.ndarray:
    pair, first, dense = _hashed(column)
    z = sums(weight[pair], first) / np.maximum(1, np.diff(first)) + weight[BUCKETS + dense].sum(axis=1) + bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _sparse(column: pa.Array) -> list:
    """Features of a training text as (index, value) lists, for the driver's bounded sample."""
    pair, first, dense = _hashed(column)
    index, value = [], []
    for i in range(len(first) - 1):
        own, n = np.unique(pair[first[i]:first[i + 1]], return_counts=True)
        index.append(np.concatenate((own, dense[i] + np.uint32(BUCKETS))).astype(np.int32))
        value.append(np.concatenate((n / max(1, n.sum()), np.ones(dense.shape[1]))).astype(np.float32))
    return [index, value, _patterns(column)[0]]


def fit_linear(index: np.ndarray, value: np.ndarray, row: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets with classes of equal weight; features scaled by their root mean square."""
    size = 2 * BUCKETS
    scale = 1 / np.sqrt(np.bincount(index, value.astype(float) ** 2, size) / len(target) + 1e-5)
    x = value * scale[index]
    mass = np.array([max((1 - target).sum(), 1e-9), max(target.sum(), 1e-9)])
    each = target / mass[1] / 2 + (1 - target) / mass[0] / 2
    w, bias, speed, speed_b = np.zeros(size), 0.0, np.zeros(size), 0.0
    norm = np.bincount(row, x.astype(float) ** 2, len(target)).mean() + 1
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * w[index], len(target)) + bias, -50, 50)))
        g = (p - target) * each
        speed = 0.9 * speed - 4 / norm * (np.bincount(index, x * g[row], size) + 1e-4 * w)
        speed_b = 0.9 * speed_b - 4 / norm * g.sum()
        w, bias = w + speed, bias + speed_b
    return w * scale, float(bias)


class Model(NamedTuple):
    weight: np.ndarray
    bias: float
    pattern: np.ndarray
    good: np.ndarray
    accuracy: np.ndarray
    share: float


def train(docs: DataFrame, text: str = "text") -> Model:
    own = docs.select(F.col(text).alias("text"))
    seen, name = with_result(own, "text", "pattern bigint", _patterns)
    counted = seen.groupBy(f"{name}.pattern").count().orderBy("pattern").toArrow()
    pattern, count = counted["pattern"].to_numpy(), counted["count"].to_numpy().astype(float)
    good, accuracy, share = expectation_maximisation(pattern, count)
    flat = Model(np.zeros(2 * BUCKETS), float(np.log(share / (1 - share))), pattern, good, accuracy, share)
    if not len(count) or good.min() > 0.5 or good.max() < 0.5:
        return flat
    sample = small_sample(own, TRAINING_ROWS, int(count.sum()), "quality", "text")
    seen, name = with_result(sample, "text", "index array<int>, value array<float>, pattern bigint", _sparse)
    rows = seen.select(f"{name}.*").toArrow().combine_chunks()
    if not rows.num_rows:
        return flat
    target = good[np.searchsorted(pattern, rows["pattern"].to_numpy())]
    index, value = (pc.list_flatten(rows[c]).to_numpy() for c in ("index", "value"))
    row = np.repeat(np.arange(rows.num_rows, dtype=np.int32), pc.list_value_length(rows["index"]).to_numpy())
    weight, bias = fit_linear(index, value, row, target)
    return flat._replace(weight=weight, bias=bias)


def classify(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of score (of the linear scorer), posterior (of the votes), votes and good, and its name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array) -> list:
        m = shared.value
        s = _score(column, m.weight, m.bias)
        vote = votes(features(column))
        at = np.minimum(np.searchsorted(m.pattern, vote @ 3 ** np.arange(len(LABELLERS))), max(0, len(m.pattern) - 1))
        return [s, m.good[at] if len(m.good) else np.full(len(s), m.share), list(vote.astype(np.int32)), s >= ACCEPT]

    return with_result(docs, text, "score double, posterior double, votes array<int>, good boolean", score)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    """Score, vote posterior and decision for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = classify(docs, train(docs))
    return found.select("doc_id", f"{name}.*")


def accept(docs: DataFrame) -> DataFrame:
    """The rows that the classifier takes for good, with their columns. For the corpus pipeline."""
    found, name = classify(docs, train(docs))
    return found.filter(f"{name}.good").select(*docs.columns)
