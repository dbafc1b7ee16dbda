"""Vectorised words, hashes and n-grams over Arrow string columns, and small Spark helpers.

A task walks its record batches in slices of bounded size, and everything inside a slice is numpy
over the UTF-8 bytes. Lower-casing is A-Z only, so byte offsets never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.session import fresh_path

SLICE_BYTES = 2 << 20
SEGMENT_BYTES = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_byte = np.arange(256)
#: Bytes of words that white space separates: all but space and \t \n \v \f \r.
SPACED = ~((_byte == 0x20) | ((_byte >= 9) & (_byte <= 13)))
#: Bytes of words made of ASCII letters, digits and everything beyond ASCII.
ALNUM = (_byte >= 0x80) | ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | ((_byte >= 0x41) & (_byte <= 0x5A))

_ROOT = 0x9E3779B97F4A7C15 | 1
_ROOT_INVERSE = pow(_ROOT, -1, 1 << 64)
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def _powers(root: int, n: int) -> np.ndarray:
    out = np.full(n, root, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_ROOT, SEGMENT_BYTES * 2)
_INVERSES = _powers(_ROOT_INVERSE, SEGMENT_BYTES * 2)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64); bijective."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of a slice, flat; those of document i are ``first[i]:first[i + 1]``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray

    @property
    def last(self) -> np.ndarray:
        """For each word, the index after its document's last word."""
        return np.repeat(self.first[1:], np.diff(self.first))

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and the documents' bounds in them; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def words(column: pa.Array, keep: np.ndarray) -> Words:
    """Maximal runs of ``keep`` bytes, A-Z lower-cased, with a 64-bit hash of each."""
    raw, bounds = utf8(column)
    data = LOWER[raw]
    inside = keep[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + SEGMENT_BYTES)))
        lo, hi = int(start[i]), int(end[j - 1])
        fits = hi - lo < len(_POWERS)
        powers = _POWERS[:hi - lo] if fits else _powers(_ROOT, hi - lo)
        back = _INVERSES if fits else _powers(_ROOT_INVERSE, hi - lo)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
        at = start[i:j] - lo
        out[i:j] = (sums[end[i:j] - lo] - sums[at]) * back[at]
        i = j
    return Words(mix(out + (end - start).astype(np.uint64)), start, end, np.searchsorted(start, bounds), data)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries; entry i stands for i .. i + k - 1 (documents not regarded)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = out * _GRAM + hashes[j:j + n]
    return mix(out + np.uint64(k))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text at most (one text may be longer)."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    total, i = np.concatenate(([0], np.cumsum(size))), 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def lists(flat: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list array of the consecutive runs of ``flat`` with the given lengths."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), flat if isinstance(flat, pa.Array) else pa.array(flat))


def text_key(*columns: str) -> Column:
    """A 64-bit key of some columns, nulls included."""
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` cut from its lineage: written to the cluster's shared folder and read again."""
    spark: SparkSession = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_result(docs: DataFrame, text: str, fields: str, score, limit: int = SLICE_BYTES, **kept) -> tuple[DataFrame, str]:
    """``docs`` with all its columns and one struct more, and that struct's (unused) name.

    ``score(column, **kept)`` gets a string array of about ``limit`` bytes and returns an array for each of ``fields``.
    """
    name, = free_names(docs, "result")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType.fromDDL(fields))])
    names = T.StructType.fromDDL(fields).names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit):
                own = pa.StructArray.from_arrays([pa.array(x) for x in score(part.column(text), **kept)], names=names)
                yield pa.RecordBatch.from_arrays([*part.columns, own], names=[*part.schema.names, name])

    return docs.mapInArrow(scan, schema), name


def sums(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs ``first[i]:first[i + 1]`` along axis 0; an empty run gives zero."""
    total = np.zeros((len(first) - 1, *flat.shape[1:]), dtype=flat.dtype if flat.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        total[full] = np.add.reduceat(flat, first[:-1][full], axis=0, dtype=total.dtype)
    return total


def small_sample(docs: DataFrame, rows: int, total: int, seed: str, *columns: str) -> DataFrame:
    """About ``rows`` of the ``total`` rows (at most a tenth more, all if fewer), by a hash of ``columns``."""
    if total <= rows:
        return docs
    share = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), F.lit(1 << 40))
    return docs.filter(share < int((1 << 40) * rows / total))


def bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of fixed size (a power of two) with the low bits of every value of ``column`` set."""
    cells = (keys.select(F.col(column).bitwiseAND(bits - 1).alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[cells.column("cell").to_numpy()] = cells.column("mask").to_numpy()
    return out.view(np.uint64)


def in_bitmap(values: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which values may be among a bitmap's keys (none of its keys is missed)."""
    low = values.view(np.uint64) & np.uint64(len(cells) * 64 - 1)
    return ((cells[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1)).astype(bool)


def likely(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The rows of ``df`` whose long ``column`` may be in ``keys``; spares most others a shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap(keys, key, bits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(batch.column(column).to_numpy(), shared.value)))

    return df.mapInArrow(scan, df.schema)
