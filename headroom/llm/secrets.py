"""Secrets in texts: fixed patterns, and a battery of randomness tests for the other long tokens.

The patterns (``assign``, ``access``, ``hex``) give the base spans. A long run of token characters that
touches none of them has its encoding inferred from the characters it uses and goes through three tests,
twice. Against the encoding's own null, uniform and independent characters, none may fail: chi-squared on
the alphabet, runs about its middle, serial correlation. Against the null of ordinary words, whose letter,
case and neighbour frequencies are counted over all texts, each test gives a probability: a chi-squared
this small, so many changes of character class, a serial product this far off. These are combined (Cauchy
combination, valid for dependent tests) and Benjamini-Hochberg over the distinct tokens of each encoding
and length class controls the share of false discoveries, so many short tokens don't open the door for
chance and few long ones aren't judged by the crowd of short ones.

Defined cases: null text is empty and has no spans; repeated documents each get their row, a token that
repeats is one hypothesis; an empty table gives no rows; texts of any length are read whole; tokens of
digits alone are never random (numbers are everywhere, and long ones are ``hex`` anyway). Only the named
columns are read, so further columns may have any name. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headroom.llm.text import lists, mix, slices, table, utf8, written

# The base patterns. A hex or access match is a whole run, so its least length can stand in the pattern.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex")
# End of fixed values.

LEAST = 16
TOKENS = 1 << 14
FALSE_DISCOVERIES = 0.01
LIMIT = 3.3
LENGTH_CLASSES = (16, 20, 24, 32, 40, 48, 64, 96, 128, 256)
P_STEPS = 100
P_MOST = 300

_byte = np.arange(256)
_DIGIT, _UPPER, _LOWER = (_byte >= 48) & (_byte <= 57), (_byte >= 65) & (_byte <= 90), (_byte >= 97) & (_byte <= 122)
_HEX, _CAPITAL = _DIGIT | ((_byte >= 97) & (_byte <= 102)), _DIGIT | _UPPER
_TOKEN = _DIGIT | _UPPER | _LOWER | np.isin(_byte, np.frombuffer(b"+/_-", np.uint8))
_SEPARATOR = np.isin(_byte, np.frombuffer(b":=", np.uint8))
_ALNUM = _DIGIT | _UPPER | _LOWER
#: Digits, capitals, small letters, then the other token characters: 0 to 63 in some order, 64 for none.
CODE = np.full(256, 64)
CODE[_DIGIT], CODE[_UPPER], CODE[_LOWER] = np.arange(10), 10 + np.arange(26), 36 + np.arange(26)
CODE[list(b"+-")], CODE[list(b"/_")] = 62, 63
#: Class of a code: digit, capital, small, other.
CLASS = np.repeat(np.arange(4), (10, 26, 26, 2))
ENCODINGS = {"random_hex": "0123456789ABCDEF", "random_base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "random_lower": "abcdefghijklmnopqrstuvwxyz", "random_lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
             "random_upper36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "random_base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
             "random_base64": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"}
_NAMES = list(ENCODINGS)
_MIXED = np.array([len({int(CLASS[c]) for c in CODE[list(a.encode())]}) > 1 for a in ENCODINGS.values()])
#: Which codes an encoding has, and their place in its alphabet.
_HAS = np.array([np.isin(np.arange(64), CODE[list(a.encode())]) for a in ENCODINGS.values()])
_PLACE = np.cumsum(_HAS, axis=1) - 1
_SIZE = _HAS.sum(axis=1)
_MASK = np.array([sum(1 << int(c) for c in np.flatnonzero(has)) for has in _HAS], np.uint64)


def _runs(data: np.ndarray, keep: np.ndarray, edges: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal runs of ``keep`` bytes of at least ``least``, inside one document each."""
    inside = keep[data]
    start = np.flatnonzero(inside & (edges[:-1] | ~np.concatenate(([False], inside[:-1]))))
    end = np.flatnonzero(inside & (edges[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    long = end - start >= least
    return start[long], end[long]


def _edges(bounds: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n + 1, bool)
    out[bounds] = True
    return out


def _inside(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Indexes of all bytes of some runs, one after the other."""
    n = end - start
    return np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def base_spans(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Byte starts and ends of the base matches of a slice's documents, by kind."""
    edges = _edges(bounds, len(data))
    view, assign = memoryview(np.ascontiguousarray(data)), []
    separators = np.searchsorted(np.flatnonzero(_SEPARATOR[data]), bounds)
    for i in np.flatnonzero(np.diff(separators)).tolist():  # no match without one
        a, b = int(bounds[i]), int(bounds[i + 1])
        assign += [(a + m.start(), a + m.end()) for m in ASSIGN.finditer(view[a:b]) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    access = []
    for a, b in zip(*_runs(data, _CAPITAL, edges, ACCESS_LEAST), strict=True):
        at = bytes(view[a:b]).find(b"AKIA")
        if at >= 0 and b - a - at >= ACCESS_LEAST:
            access.append((a + at, b))
    return [np.array(assign, np.int64).reshape(-1, 2), np.array(access, np.int64).reshape(-1, 2),
            np.stack(_runs(data, _HEX, edges, HEX_LEAST), axis=1)]


def pair_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often each code follows each other one inside ordinary words (runs too short for a token)."""
    edges = _edges(bounds, len(data))
    start, end = _runs(data, _ALNUM, edges, 2)
    short = end - start < LEAST
    first = _inside(start[short], end[short] - 1)
    return np.bincount(CODE[data[first]] * 64 + CODE[data[first + 1]], minlength=64 * 64)


class WordNull:
    """What the three statistics look like on ordinary words, for each encoding."""

    def __init__(self, pairs: np.ndarray):
        pairs = pairs.reshape(64, 64).astype(float) + 1e-6
        single = pairs.sum(axis=0) + pairs.sum(axis=1)
        self.s2, self.s3, self.mean, self.sd = [], [], [], []
        for has, place, size in zip(_HAS, _PLACE, _SIZE, strict=True):
            p = np.where(has, single, 0.0)
            p /= p.sum()
            self.s2.append((p ** 2).sum())
            self.s3.append((p ** 3).sum())
            centred = np.where(has, (place - (size - 1) / 2) / math.sqrt((size ** 2 - 1) / 12), 0.0)
            both = np.where(has[:, None] & has[None, :], pairs, 0.0)
            both /= both.sum()
            product = np.outer(centred, centred)
            self.mean.append((both * product).sum())
            self.sd.append(math.sqrt(max((both * product ** 2).sum() - self.mean[-1] ** 2, 1e-9)))
        alike = CLASS[:, None] == CLASS[None, :]
        self.change = float(pairs[~alike].sum() / pairs.sum())
        self.s2, self.s3, self.mean, self.sd = (np.array(x) for x in (self.s2, self.s3, self.mean, self.sd))


_erfc = np.vectorize(math.erfc, otypes=[float])


def _tail(z: np.ndarray) -> np.ndarray:
    """Probability that a normal value is at least ``z``."""
    return 0.5 * _erfc(z / math.sqrt(2)) if len(z) else np.empty(0)


def battery(data: np.ndarray, start: np.ndarray, end: np.ndarray, null: WordNull) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token its encoding, its probability as ordinary words, and whether it passes as uniform."""
    parts = [_battery(data, start[i:i + TOKENS], end[i:i + TOKENS], null) for i in range(0, len(start), TOKENS)]
    return tuple(np.concatenate(x) for x in zip((np.empty(0, np.int64), np.empty(0), np.empty(0, bool)), *parts, strict=True))


def _battery(data, start, end, null):
    n, m = end - start, len(start)
    token, code = np.repeat(np.arange(m), n), CODE[data[_inside(start, end)]]
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    seen = np.bincount(token * 64 + code, minlength=m * 64).reshape(m, 64)
    # The smallest alphabet that holds the whole token, in the order of ENCODINGS.
    used = np.bitwise_or.reduceat(np.uint64(1) << code.astype(np.uint64), first)
    kind = np.argmax((used[:, None] & ~_MASK) == 0, axis=1)
    k = _SIZE[kind].astype(float)
    squares = (seen.astype(float) ** 2).sum(axis=1)
    chi = k * squares / n - n

    place = _PLACE[kind[token], code]
    centred = (place - (k[token] - 1) / 2) / np.sqrt((k[token] ** 2 - 1) / 12)
    follows = np.ones(len(code), bool)
    follows[first] = False
    at = np.flatnonzero(follows)
    product = np.bincount(token[at], centred[at] * centred[at - 1], minlength=m)
    high = place >= k[token] / 2
    runs = 1 + np.bincount(token[at], high[at] != high[at - 1], minlength=m)
    above = np.bincount(token, high, minlength=m)
    changes = np.bincount(token[at], CLASS[code[at]] != CLASS[code[at - 1]], minlength=m)

    z_chi = (chi - (k - 1)) / np.sqrt(2 * (k - 1) * (n - 1) / n)
    below = n - above
    expected = 2 * above * below / n + 1
    spread = np.sqrt(np.maximum((expected - 1) * (expected - 2) / (n - 1), 1e-9))
    z_runs = np.where((above > 0) & (below > 0), (runs - expected) / spread, LIMIT * 2)
    z_serial = product / np.sqrt(n - 1)
    uniform = (z_chi < LIMIT) & (np.abs(z_runs) < LIMIT) & (np.abs(z_serial) < LIMIT) & ((used & ~np.uint64((1 << 10) - 1)) != 0)

    s2, s3 = null.s2[kind], null.s3[kind]
    chi_mean = k * (1 + (n - 1) * s2) - n
    chi_sd = k / n * np.sqrt(2 * n * (n - 1) * (s2 - s2 ** 2) + 4 * n * (n - 1) * (n - 2) * (s3 - s2 ** 2))
    p_chi = _tail((chi_mean - chi) / chi_sd)
    share, rate = np.clip(changes / (n - 1), 1e-12, 1 - 1e-12), np.clip(null.change, 1e-6, 1 - 1e-6)
    bound = -(n - 1) * (share * np.log(share / rate) + (1 - share) * np.log((1 - share) / (1 - rate)))
    p_runs = np.where(share > rate, np.exp(np.maximum(bound, -690)), 1.0)
    gap = (null.mean[kind] - product / (n - 1)) * np.sign(null.mean[kind]) * np.sqrt(n - 1) / null.sd[kind]
    p_serial = _tail(gap)
    each = np.clip(np.stack([p_chi, p_runs, p_serial]), 1e-290, 0.99)
    # An alphabet of one class has no changes: that test says nothing then.
    weight = np.stack([np.ones(m), _MIXED[kind].astype(float), np.ones(m)])
    total = (np.where(each < 1e-8, 1 / (each * math.pi), np.tan((0.5 - each) * math.pi)) * weight).sum(axis=0) / weight.sum(axis=0)
    p = np.where(total > 1e8, 1 / (np.maximum(total, 1.0) * math.pi), 0.5 - np.arctan(total) / math.pi)
    return kind, p, uniform


def _token_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = end - start
    where = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(n) else np.empty(0, np.int64)
    part = mix(mix(data[_inside(start, end)].astype(np.uint64) + np.uint64(257) * (where.astype(np.uint64) + np.uint64(1))) + np.uint64(7))
    return np.add.reduceat(part, np.concatenate(([0], np.cumsum(n)[:-1]))).view(np.int64) if len(n) else np.empty(0, np.int64)


def word_null(docs: DataFrame, text: str) -> WordNull:
    """The null of ordinary words, counted over all texts (64 x 64 numbers)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(64 * 64, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                total += pair_counts(*utf8(part.column("text")))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    pairs = np.zeros(64 * 64, np.int64)
    for r in docs.select(F.col(text).alias("text")).mapInArrow(scan, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[r.pair] = r.n
    return WordNull(pairs)


_SPAN = "struct<kind:int,start:int,stop:int>"
_TOKENS = "array<struct<kind:int,start:int,stop:int,hash:bigint,size:int,p:int>>"


def scanned(docs: DataFrame, doc: str, text: str, null: WordNull) -> DataFrame:
    """``doc, base, tokens``: base spans, and the tokens that pass as uniform or not, with their p (in steps of its logarithm).

    Tokens that fail as uniform keep p 0 (they count as hypotheses, but can't be discovered).
    """
    kind_of_doc = docs.schema[doc].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = utf8(part.column("text"))
                base = base_spans(data, bounds)
                kinds = np.repeat(np.arange(len(base)), [len(b) for b in base])
                spans = np.concatenate(base)
                start, end = _runs(data, _TOKEN, _edges(bounds, len(data)), LEAST)
                by_start = np.sort(spans[:, 0])
                reach = np.maximum.accumulate(spans[np.argsort(spans[:, 0], kind="stable"), 1]) if len(spans) else by_start
                before = np.searchsorted(by_start, end) - 1  # the last base span that starts before the token ends
                free = (before < 0) | (reach[np.maximum(before, 0)] <= start) if len(spans) else np.ones(len(start), bool)
                start, end = start[free], end[free]
                kind, p, uniform = battery(data, start, end, null)
                steps = np.where(uniform, np.minimum(np.floor(-np.log10(np.maximum(p, 1e-300)) * P_STEPS), P_MOST * P_STEPS), 0).astype(np.int32)

                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                doc_of = lambda at: np.searchsorted(bounds, at, side="right") - 1
                # Empty documents share a bound with the next one: the last document that starts there holds the byte.
                at, tok = doc_of(spans[:, 0]), doc_of(start)
                order = np.lexsort((kinds, spans[:, 0]))
                origin = points[bounds[:-1]]
                b = pa.StructArray.from_arrays(
                    [pa.array(kinds[order].astype(np.int32)), pa.array((points[spans[:, 0]] - origin[at])[order].astype(np.int32)),
                     pa.array((points[spans[:, 1]] - origin[at])[order].astype(np.int32))], names=["kind", "start", "stop"])
                t = pa.StructArray.from_arrays(
                    [pa.array((kind + len(KINDS)).astype(np.int32)), pa.array((points[start] - origin[tok]).astype(np.int32)),
                     pa.array((points[end] - origin[tok]).astype(np.int32)), pa.array(_token_hash(data, start, end)),
                     pa.array(np.searchsorted(LENGTH_CLASSES, end - start, side="right").astype(np.int32)), pa.array(steps)],
                    names=["kind", "start", "stop", "hash", "size", "p"])
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), lists(b, np.bincount(at, minlength=n)), lists(t, np.bincount(tok, minlength=n))],
                    names=["doc", "base", "tokens"])

    return (docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
            .mapInArrow(scan, f"doc {kind_of_doc}, base array<{_SPAN}>, tokens {_TOKENS}"))


def discoveries(found: DataFrame, rate: float) -> DataFrame:
    """``kind, size, least``: the smallest step of p that Benjamini-Hochberg lets through, by encoding and length class."""
    group = ["kind", "size"]
    steps = (found.select(F.inline("tokens")).groupBy(*group, "hash").agg(F.max("p").alias("p"))
             .groupBy(*group, "p").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(*group)  # at most P_MOST * P_STEPS + 1 rows a group
    limit = F.pow(F.lit(10.0), -F.col("p") / P_STEPS) <= rate * F.col("upto") / F.col("all")
    return (steps.withColumn("upto", F.sum("n").over(w.orderBy(F.col("p").desc()))).withColumn("all", F.sum("n").over(w))
            .where((F.col("p") > 0) & limit).groupBy(*group).agg(F.min("p").alias("least")))


def find_secrets(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """Per row of ``docs``: doc, ``base`` and ``spans`` (with the random tokens), arrays of (kind, start, stop) by start and kind."""
    found = written(scanned(docs, doc, text, word_null(docs, text)), "secret-tokens")
    never = F.lit(P_MOST * P_STEPS + 1)
    least = {-1: never}
    for r in discoveries(found, rate).collect():  # one row for each encoding and length class
        least[r["kind"] * 100 + r["size"]] = F.lit(r["least"])
    limits = F.create_map(*[v for k, steps in least.items() for v in (F.lit(k), steps)])
    random = F.filter("tokens", lambda x: x["p"] >= F.coalesce(F.try_element_at(limits, x["kind"] * 100 + x["size"]), never))
    names = F.array(*[F.lit(n) for n in (*KINDS, *_NAMES)])

    def by_start(column):
        return F.transform(column, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop")))

    def named(column):
        return F.transform(column, lambda x: F.struct(F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))

    return found.select("doc", named(F.col("base")).alias("base"), named(F.array_sort(F.concat(by_start("base"), by_start(random)))).alias("spans"))


def op11_secrets(spark, sf_dir: str) -> DataFrame:
    """Every secret in every document."""
    def joined(column):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return (find_secrets(table(spark, sf_dir, "documents"))
            .select(F.col("doc").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")))
