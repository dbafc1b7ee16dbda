"""Benchmark decontamination by winnowing.

Every window of ``size`` words keeps the smallest hash of its k-grams as fingerprint, so two equal
windows always keep the same one: no shared span of ``size`` words can be missed. Documents drop
the windows whose fingerprint is in no benchmark item (a bitmap of fixed size tells most of them),
the rest join the benchmark's fingerprints in Spark, and a hit extends to the whole window, which
must be equal.

Defined cases: null or wordless text has no words and no hits; a benchmark item of fewer than
``size`` words is one window of its own length; an item without words is never found; an item with
a null id makes hits but is not named; repeated item ids count once; repeated documents each get
their row; an empty table on either side gives documents without hits. Only the named columns are
read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.llm.text import ALNUM, Words, bitmap, free_names, grams, in_bitmap, lists, slices, table, text_key, words, written

WINDOW = 10
KGRAM = 5
BITMAP_BITS = 1 << 23

_FOUND = "array<struct<print:bigint,size:int,start:int,windows:array<bigint>>>"


def _windows(w: Words, size: int, kgram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (flat), fingerprint and hash of every window of ``size`` words inside one document."""
    k = min(kgram, size)
    own = grams(w.hash, size)
    least = grams(w.hash, k)
    smallest = least[:len(own)]
    for j in range(1, size - k + 1):
        smallest = np.minimum(smallest, least[j:j + len(own)])
    start = np.flatnonzero(np.arange(len(own)) + size <= w.last[:len(own)])
    return start, smallest[start] + np.uint64(size), own[start]


def _runs(w: Words, start, prints, own, size: int):
    """Neighbouring windows with one fingerprint as (document, fingerprint, size, start, windows)."""
    if not len(start):
        return []
    doc = np.searchsorted(w.first, start, side="right") - 1
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(start) != 1) | (prints[1:] != prints[:-1]) | (np.diff(doc) != 0))))
    ends = np.append(cut[1:], len(start))
    own, prints = own.view(np.int64), prints.view(np.int64)
    return [(int(doc[a]), int(prints[a]), size, int(start[a] - w.first[doc[a]]), own[a:b]) for a, b in zip(cut, ends, strict=True)]


def _found(runs: list, n_docs: int) -> pa.Array:
    runs.sort(key=lambda r: r[0])
    inner = lists(np.concatenate([r[4] for r in runs]) if runs else np.empty(0, np.int64), [len(r[4]) for r in runs])
    flat = pa.StructArray.from_arrays(
        [pa.array([r[1] for r in runs], pa.int64()), pa.array([r[2] for r in runs], pa.int32()),
         pa.array([r[3] for r in runs], pa.int32()), inner], names=["print", "size", "start", "windows"])
    return lists(flat, np.bincount(np.array([r[0] for r in runs], dtype=np.int64), minlength=n_docs))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int, kgram: int) -> DataFrame:
    """``print, size, item, windows``: an item's windows that kept this fingerprint."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), ALNUM)
                n, runs = np.diff(w.first), []
                for size in range(1, window + 1):
                    start, prints, own = _windows(w, size, kgram)
                    if size < window:
                        whole = n[np.searchsorted(w.first, start, side="right") - 1] == size
                        start, prints, own = start[whole], prints[whole], own[whole]
                    runs += _runs(w, start, prints, own, size)
                yield pa.RecordBatch.from_arrays([part.column("item"), _found(runs, part.num_rows)], names=["item", "found"])

    own = (benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
           .mapInArrow(scan, f"item string, found {_FOUND}"))
    return (own.select("item", F.inline("found")).select("print", "size", "item", F.explode("windows").alias("window"))
            .groupBy("print", "size", "item").agg(F.collect_set("window").alias("windows")))


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW, kgram: int = KGRAM) -> DataFrame:
    """Per row of ``docs``: doc, text_key, n_words, n_hit, n_items, items (sorted), spans of hit words.

    ``spans`` are the merged ``[start, stop)`` word ranges covered by benchmark windows.
    """
    items = written(benchmark_windows(benchmark, item, item_text, window, kgram), "benchmark-windows")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(items, "print", BITMAP_BITS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), ALNUM)
                runs = []
                for size in sizes:
                    start, prints, own = _windows(w, size, kgram)
                    seen = np.flatnonzero(in_bitmap(prints, bits))
                    runs += _runs(w, start[seen], prints[seen], own[seen], size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("text_key"), pa.array(np.diff(w.first).astype(np.int64)), _found(runs, part.num_rows)],
                    names=["doc", "text_key", "n_words", "found"])

    kind = docs.schema[doc].dataType.simpleString()
    own = docs.select(F.col(doc).alias("doc"), text_key(doc, text).alias("text_key"), F.col(text).alias("text"))
    own = written(own.mapInArrow(scan, f"doc {kind}, text_key bigint, n_words bigint, found {_FOUND}"), "document-windows")
    hits = (own.filter(F.size("found") > 0).select("doc", "text_key", F.inline("found"))
            .join(items.withColumnRenamed("windows", "known"), ["print", "size"])
            .select("doc", "text_key", "item", "size", F.expr(
                "filter(transform(windows, (w, i) -> named_struct('at', start + i, 'same', array_contains(known, w))), x -> x.same)").alias("same"))
            .filter(F.size("same") > 0)
            .groupBy("doc", "text_key")
            .agg(F.array_sort(F.collect_set("item")).alias("items"),
                 F.collect_set(F.expr("transform(same, x -> named_struct('start', x.at, 'stop', x.at + size))")).alias("ranges")))
    spans = F.expr("""aggregate(array_sort(array_distinct(flatten(ranges))),
        cast(array() as array<struct<start:int,stop:int>>),
        (acc, x) -> if(size(acc) > 0 and element_at(acc, -1).stop >= x.start,
            concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'stop', greatest(element_at(acc, -1).stop, x.stop)))),
            concat(acc, array(x))))""")
    hits = hits.select(F.col("doc").alias("d"), F.col("text_key").alias("k"), "items", spans.alias("spans"))
    return (own.select("doc", "text_key", "n_words")
            .join(hits, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
            .select("doc", "text_key", "n_words",
                    F.expr("coalesce(aggregate(spans, 0L, (n, s) -> n + (s.stop - s.start)), 0L)").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
                    F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,stop:int>>)")).alias("spans")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` without a hit, with their columns."""
    doc, text = names.get("doc", "doc_id"), names.get("text", "text")
    bad_doc, bad_key = free_names(docs, "bad_doc", "bad_key")
    bad = (contamination(docs, benchmark, **names).filter("n_hit > 0")
           .select(F.col("doc").alias(bad_doc), F.col("text_key").alias(bad_key)).distinct())
    return docs.join(bad, F.col(doc).eqNullSafe(F.col(bad_doc)) & (text_key(doc, text) == F.col(bad_key)), "left_anti")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
