"""Language identification with error-correcting output codes.

Each language owns a codeword of +1/-1 bits. One binary classifier per bit (naive Bayes over hashed
byte n-grams of the letters) tells the languages with +1 from those with -1; its n-gram counts come
from every training text. Decoding weighs each bit's logistic loss by how well that classifier did
on that language and takes the nearest codeword; a narrow lead over the second is flagged.

Defined cases: null, empty or letterless text is ``und`` with score 0 and never ambiguous; no
training language at all makes every text ``und``; with one language, every text with letters is
that language (score 1). Texts too short for an n-gram go to the most frequent language. Repeated
rows each count. Only the named columns are read; others pass through under any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.llm.text import small_sample, slices, sums, table, utf8, with_result

ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
#: Languages up to this number get the exhaustive code, more get CODE_BITS * log2(languages) random bits.
EXHAUSTIVE = 6
CODE_BITS = 10
#: Training texts on which the classifiers' margins and accuracies are measured (counts use all texts).
CALIBRATION_ROWS = 10_000
#: A lead over the second codeword, in mean weighted loss, under which a text is ambiguous.
NARROW = 0.1
UNKNOWN = "und"
#: Bytes of text looked at together: each makes three n-grams with a weight a code bit, some 300 bytes in all.
SLICE = 1 << 18

_TEXTS = -1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray
    gram_weight: np.ndarray


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each text (flat) and the texts' bounds among them; runs of non-letters are blanks."""
    raw, bounds = utf8(pc.utf8_lower(pc.fill_null(column, "")))
    data = _FOLD[raw].astype(np.uint32)
    last = np.repeat(bounds[1:], np.diff(bounds))
    flat, start = [], []
    for n in ORDERS:
        size = max(0, len(data) - n + 1)
        code = data[:size].copy()
        blank = data[:size] == 0x20
        for j in range(1, n):
            code = code * np.uint32(0x01000193) ^ data[j:j + size]
            blank &= data[j:j + size] == 0x20
        code = (code * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0x85EBCA6B) >> np.uint32(16)
        at = np.flatnonzero((np.arange(size) + n <= last[:size]) & ~blank)
        flat.append(code[at])
        start.append(at)
    order = np.argsort(np.concatenate(start), kind="stable")
    return np.concatenate(flat)[order], np.searchsorted(np.concatenate(start)[order], bounds)


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, bucket, n`` over all texts; bucket -1 counts the texts."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                langs = part.column("lang").to_pylist()
                for name in dict.fromkeys(langs):
                    own = part.filter(pc.equal(part.column("lang"), name))
                    seen.setdefault(name, np.zeros(BUCKETS, np.int64))
                    seen[name] += np.bincount(buckets(own.column("text"))[0], minlength=BUCKETS)
                    texts[name] = texts.get(name, 0) + own.num_rows
        for name, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(at) + 1), pa.string()), pa.array(np.append(at, _TEXTS).astype(np.int32)),
                 pa.array(np.append(n[at], texts[name]))], names=["lang", "bucket", "n"])

    own = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return own.mapInArrow(scan, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(languages: int) -> np.ndarray:
    """A +1/-1 codeword per language with distinct, non-constant and non-complementary bits."""
    if languages < 2:
        return np.empty((languages, 0))
    if languages <= EXHAUSTIVE:
        bits = np.arange(1, 1 << (languages - 1))
        rest = (bits[None, :] >> np.arange(languages - 1)[:, None]) & 1
        return np.vstack([np.ones(len(bits)), 1.0 - 2 * rest])
    best, apart = None, -1
    for seed in range(64):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (languages, int(CODE_BITS * np.log2(languages))))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        gap = (code.shape[1] - (code @ code.T)[np.triu_indices(languages, 1)].max()) / 2
        if gap > apart:
            best, apart = code, gap
    return best


def _margins(column: pa.Array, gram_weight: np.ndarray) -> np.ndarray:
    flat, first = buckets(column)
    return sums(gram_weight[flat], first) / np.maximum(1, np.diff(first))[:, None].astype(np.float32)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of the rows whose language isn't null."""
    rows = gram_counts(docs, text, lang).toArrow().to_pandas()
    texts = rows[rows.bucket == _TEXTS].set_index("lang").n
    languages = sorted(texts.index, key=lambda x: (-texts[x], x))
    code = codewords(len(languages))
    counts = np.zeros((len(languages), BUCKETS))
    grams = rows[rows.bucket != _TEXTS]
    counts[grams.lang.map({x: i for i, x in enumerate(languages)}).to_numpy(int), grams.bucket.to_numpy(int)] = grams.n
    share = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)
    gram_weight = np.empty((BUCKETS, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        gram_weight[:, b] = np.log(share[code[:, b] > 0].mean(axis=0)) - np.log(share[code[:, b] < 0].mean(axis=0))
    if not code.shape[1]:
        return Model(languages, code, np.ones_like(code), gram_weight)
    known = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(gram_weight)
    seen, name = with_result(small_sample(known, CALIBRATION_ROWS, int(texts.sum()), "calibration", "lang", "text"), "text",
                             "m array<float>", lambda column: [list(_margins(column, shared.value))], SLICE)
    bits = seen.select("lang", F.posexplode(f"{name}.m").alias("bit", "m"))
    size, right = np.ones(code.shape[1]), np.ones_like(code)
    own = (bits.groupBy("lang", "bit").agg(F.avg(F.abs("m")).alias("size"), F.avg((F.col("m") > 0).cast("double")).alias("up"),
                                          F.count("*").alias("n")).toPandas())
    for b, part in own.groupby("bit"):
        size[b] = max(1e-6, np.average(part["size"], weights=part["n"]))
    for row in own.itertuples():
        k = languages.index(row.lang)
        right[k, row.bit] = row.up if code[k, row.bit] > 0 else 1 - row.up
    weight = np.maximum(right - 0.5, 0.01)
    shared.unpersist()
    return Model(languages, code, weight / weight.sum(axis=1, keepdims=True), (gram_weight * (4 / size)).astype(np.float32))


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword, its share of exp(-loss), and whether the second is near, per row of margins."""
    loss = np.stack([(np.logaddexp(0, -margins * c) * w).sum(axis=1) for c, w in zip(model.code, model.weight, strict=True)], axis=1)
    best = loss.argmin(axis=1)
    odds = np.exp(-max(1, model.code.shape[1]) * (loss - loss.min(axis=1, keepdims=True)))
    lead = np.partition(loss, 1, axis=1)[:, 1] - loss.min(axis=1) if loss.shape[1] > 1 else np.full(len(loss), np.inf)
    return best, 1 / odds.sum(axis=1), lead < NARROW


def _predict(column: pa.Array, shared) -> list:
    model = shared.value
    letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    if not model.languages:
        return [[UNKNOWN] * len(column), np.zeros(len(column)), np.zeros(len(column), bool)]
    best, score, narrow = decode(_margins(column, model.gram_weight).astype(float), model)
    return [np.where(letters, np.array(model.languages, object)[best], UNKNOWN), np.where(letters, score, 0.0), narrow & letters]


def identify(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of lang_pred, score and ambiguous, and that struct's name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return with_result(docs, text, "lang_pred string, score double, ambiguous boolean", lambda column: _predict(column, shared), SLICE)


def held_out(doc: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % 4 == 2, F.lit(False))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    found, name = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), f"{name}.lang_pred", f"{name}.score", f"{name}.ambiguous")


def accept(docs: DataFrame) -> DataFrame:
    """The rows with a language of their own: not ``und``, not ambiguous. For the corpus pipeline."""
    found, name = identify(docs, train(docs.filter(~held_out())))
    return found.filter((F.col(f"{name}.lang_pred") != UNKNOWN) & ~F.col(f"{name}.ambiguous")).select(*docs.columns)
