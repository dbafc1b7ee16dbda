"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: each word with the words after it in its piece, ``longest`` in all,
padded where the piece ends. Summing a window's counts over its last columns gives the counts of its
prefixes, so one Spark ROLLUP over the window's columns yields the frequencies of all phrases of every
length, of all words and of the language, and no shorter n-grams are emitted on their own. Words travel as
64-bit hashes; tasks count the windows of a slice before they leave it. Windows below the least frequency
are no phrases, but parts of prefixes: each is folded into its prefix where the partition of the window's
first two words already holds it, so the ROLLUP sees little more than the frequent phrases.

A candidate is a phrase of 2 to ``longest`` words with at least ``least`` occurrences; its score is that of
its weakest cut, floor(10^6 a^2 / (l r)) in exact decimals; it goes where a longer candidate that contains
it has at least ``share`` per cent of its occurrences. Words of the survivors are looked up in a second
scan, which fails if two words ever share a hash.

Defined cases: null text is empty, null language is ``und``; a text without words adds nothing; overlapping
occurrences and repeated documents all count; ties in the ranking go by frequency, then phrase; an empty
table has no phrases. Only the named columns are read, so further columns may have any name. Frequencies
up to 10^14.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headroom.llm.text import bitmap, in_bitmap, mix, slices, table, words, written

LONGEST = 3
LEAST = 10
SHARE = 50
TOP = 2000
UNKNOWN = "und"
SLICE = 4 << 20
SALTS = 16
BUCKETS = 64
BITS = 1 << 23

_byte = np.arange(256)
#: Bytes that end a piece, and bytes of words.
_SPLIT = np.isin(_byte, np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8))
#: Any value for each byte; sums of them tell words apart that share a hash.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_WORD = ~(_SPLIT | (_byte == 0x20) | (_byte == 0x09))


def _words(column: pa.Array):
    """The words of a slice, their hashes (never 0) and how many following words each has in its piece at least, up to all."""
    w = words(column, _WORD)
    splits = np.concatenate(([0], np.cumsum(_SPLIT[w.data])))
    cut = np.ones(len(w.start), bool)  # no word of the same piece follows
    if len(cut):
        cut[:-1] = (splits[w.start[1:]] != splits[w.end[:-1]]) | (w.doc[1:] != w.doc[:-1])
    return w, np.maximum(w.hash, 1).view(np.int64), cut


def _windows(column: pa.Array, lang: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct padded windows of a slice: language number, word columns (0 pads) and count."""
    w, own, cut = _words(column)
    columns, inside = [own], np.ones(len(own), bool)
    for k in range(1, longest):
        inside = inside.copy()
        inside[len(own) - k:] = False
        inside[:len(own) - k] &= ~cut[k - 1:len(own) - 1]
        following = np.zeros(len(own), np.int64)
        following[inside] = own[np.flatnonzero(inside) + k]
        columns.append(following)
    code = lang[w.doc]
    order = np.lexsort((*columns[::-1], code))
    new = np.ones(len(order), bool)
    new[1:] = reduce(np.logical_or, [c[order][1:] != c[order][:-1] for c in (code, *columns)])
    first = np.flatnonzero(new)
    return code[order][first], [c[order][first] for c in columns], np.diff(np.append(first, len(order)))


def longest_windows(docs: DataFrame, text: str, lang: str, longest: int) -> DataFrame:
    """``lang, w1 .. wN, n``: padded longest windows, counted within slices."""
    names = [f"w{k}" for k in range(1, longest + 1)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                coded = part.column("lang").dictionary_encode()
                code, columns, n = _windows(part.column("text"), coded.indices.to_numpy(), longest)
                for a in range(0, len(n), 1 << 16):
                    s = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code[s])), *[pa.array(c[s]) for c in columns], pa.array(n[s])],
                                                     names=["lang", *names, "n"])

    return (docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .mapInArrow(scan, "lang string, " + ", ".join(f"{c} bigint" for c in names) + ", n bigint"))


def frequencies(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, w1 .. wN, length, f``: every phrase of 1 .. N words (0 beyond it) with at least ``least``
    occurrences, and for length 0 the words of each language."""
    columns = [f"w{k}" for k in range(1, longest + 1)]
    lead = ["lang", *columns[:2]]
    counts = (longest_windows(docs, text, lang, longest).repartition(*lead)
              .groupBy("lang", *columns).agg(F.sum("n").alias("n")))
    # Fold windows that are too rare into their prefix, longest first; a prefix of two words or more is whole in its partition.
    for k in range(longest, 1, -1):
        whole = F.sum("n").over(Window.partitionBy("lang", *columns[:k]))
        counts = counts.withColumn("whole", F.col("n") if k == longest else whole)
        counts = counts.withColumn(columns[k - 1], F.when(F.col("whole") >= least, F.col(columns[k - 1])).otherwise(0)).drop("whole")
    folded = counts.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    # grouping_id has a one for each column that is summed over: 0 is the whole window, 2^N - 1 the language, 2^(N+1) - 1 everything.
    level = F.grouping_id()
    rolled = folded.rollup("lang", *columns).agg(F.sum("n").alias("f"), level.alias("level")).where(F.col("level") < (1 << (longest + 1)) - 1)
    rolled = rolled.withColumn("length", (longest - F.bit_count("level")).cast("int"))
    last = reduce(lambda out, k: F.when(F.col("length") == k, F.col(columns[k - 1])).otherwise(out), range(1, longest + 1), F.lit(1))
    return (rolled.where((last != 0) & ((F.col("length") == 0) | (F.col("f") >= least)))
            .select("lang", *[F.coalesce(c, F.lit(0)).alias(c) for c in columns], "length", "f"))


def _part(columns: list[str], first: int, size: int) -> list[Column]:
    """The window of the words ``first .. first + size - 1`` (from 0), padded."""
    return [F.col(columns[first + k]) if k < size else F.lit(0).cast("long") for k in range(len(columns))]


def _exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (l r)) in decimals of 38 digits; a frequency has at most 14."""
    a, left, right = (c.cast("decimal(14,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right)


def scored(freq: DataFrame, longest: int, share: int) -> DataFrame:
    """Candidates that stay: lang, words, length, a, l, r, score."""
    columns = [f"w{k}" for k in range(1, longest + 1)]
    phrases = freq.where("length > 0")
    candidates = freq.where("length > 1")
    # Every contiguous shorter part of a longer candidate, with its largest frequency.
    inner = [candidates.where(F.col("length") == n).select("lang", *[c.alias(x) for c, x in zip(_part(columns, i, size), columns, strict=True)], "f")
             for n in range(3, longest + 1) for size in range(2, n) for i in range(n - size + 1)]
    kept = candidates
    if inner:
        around = reduce(DataFrame.unionAll, inner).groupBy("lang", *columns).agg(F.max("f").alias("around"))
        kept = (candidates.join(around, ["lang", *columns], "left")
                .where(F.coalesce(F.col("around").cast("decimal(14,0)") * 100 < F.col("f").cast("decimal(14,0)") * share, F.lit(True))).drop("around"))
    cuts = [kept.where(F.col("length") == n).select(
        "lang", *columns, "length", "f", F.lit(k).alias("k"), F.struct(*[c.alias(x) for c, x in zip(_part(columns, 0, k), columns, strict=True)]).alias("left"),
        F.struct(*[c.alias(x) for c, x in zip(_part(columns, k, n - k), columns, strict=True)]).alias("right"))
        for n in range(2, longest + 1) for k in range(1, n)]
    # A frequent word is part of many candidates: single words are looked up under one of SALTS numbers.
    parts = phrases.select("lang", F.struct(*columns).alias("part"), F.col("f").alias("part_f"),
                           F.explode(F.when(F.col("length") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))

    def looked_up(df: DataFrame, side: str, name: str) -> DataFrame:
        salt = F.when(F.col(side)[columns[1]] == 0, F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")).otherwise(0)
        return (df.withColumn("salt", salt).withColumnRenamed(side, "part").join(parts, ["lang", "part", "salt"])
                .withColumnRenamed("part_f", name).drop("part", "salt"))

    cut = looked_up(looked_up(reduce(DataFrame.unionAll, cuts), "left", "l"), "right", "r")
    weakest = F.min(F.struct(_exact_score(F.col("f"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    return (cut.groupBy("lang", *columns, "length", F.col("f").alias("a")).agg(weakest.alias("cut"))
            .select("lang", *columns, "length", "a", "cut.l", "cut.r", "cut.score"))


def leading(df: DataFrame, top: int) -> DataFrame:
    """The rows that can be among the first ``top`` of their language by score and frequency, ties included."""
    order = [F.col("score").desc(), F.col("a").desc()]
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(BUCKETS))
    few = df.withColumn("bucket", bucket).withColumn("place", F.rank().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("place") <= top)
    return few.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("bucket", "place")


def spelled(docs: DataFrame, text: str, needed: DataFrame) -> DataFrame:
    """``word, spelling`` for the hashes ``word`` of ``needed``; fails if a hash has two spellings."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(needed, "word", BITS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, own, _ = _words(part.column("text"))
                some = np.flatnonzero(in_bitmap(own, shared.value))
                # One word for each pair of the hash and an unrelated sum, so that two words with one hash both come out.
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[w.data])))
                other = total[w.end[some]] - total[w.start[some]]
                order = np.lexsort((other, own[some]))
                new = np.ones(len(order), bool)
                new[1:] = (own[some][order][1:] != own[some][order][:-1]) | (other[order][1:] != other[order][:-1])
                some = some[order[new]]
                spelling = [bytes(w.data[a:b]) for a, b in zip(w.start[some].tolist(), w.end[some].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(spelling, pa.binary())], names=["word", "spelling"])

    found = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(scan, "word bigint, spelling binary")
    found = found.join(needed.distinct(), "word", "left_semi").groupBy("word").agg(F.min("spelling").alias("least"), F.max("spelling").alias("most"))
    clash = F.raise_error(F.lit("two words share a hash"))
    return found.select("word", F.when(F.col("least") == F.col("most"), F.decode("least", "UTF-8")).otherwise(clash).alias("spelling"))


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 share: int = SHARE, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    columns = [f"w{k}" for k in range(1, longest + 1)]
    freq = written(frequencies(docs, text=text, lang=lang, longest=longest, least=least), "phrase-counts")
    best = written(leading(scored(freq, longest, share), top), "phrase-leaders")
    needed = best.select(F.explode(F.array(*columns)).alias("word")).where("word != 0")
    names = written(spelled(docs, text, needed), "phrase-words")
    each = (best.select("lang", *columns, F.posexplode(F.slice(F.array(*columns), F.lit(1), F.col("length"))).alias("at", "word"))
            .join(names, "word").groupBy("lang", *columns).agg(F.sort_array(F.collect_list(F.struct("at", "spelling"))).alias("words"))
            .withColumn("phrase", F.array_join(F.transform("words", lambda x: x["spelling"]), " ")).drop("words"))
    size = freq.where("length = 0").select("lang", F.col("f").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase")))
    return (best.join(each, ["lang", *columns]).join(size, "lang").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The collocations of all documents, by language."""
    return collocations(table(spark, sf_dir, "documents"))
