"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by cell (source, language, topic) over all documents. Raking multiplies the
cells by one factor per source, per language and per topic in turn until the weighted token shares
meet the three target marginals. A cell's weight, scaled to the token budget, is the probability
with which each of its documents is kept; where that would pass 1 the document is kept and carries
the rest as ``loss_weight``, so expected weighted shares still meet the targets. Decisions come from
a hash of the document, so a repeated task decides the same.

Topics are the nearest of a few centroids over hashed words. A bounded sample gives their seeds, all
documents the centroids.

Defined cases: null source or language is the cell value ``unknown``; null, empty and wordless texts
have no tokens, topic -1 (``none``), weight 0 in the counts, and get the weight of their source and
language alone; equal rows get equal decisions; target values without tokens are left out and the
others scaled up; values without a target keep their share of the tokens, scaled to what the named
targets leave; an empty table gives no rows. Only the named columns are read, the others pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headroom.llm.text import ALNUM, Words, free_names, slices, small_sample, sums, table, with_result, words, written

TOPICS = 8
#: Texts from which the topic centroids are seeded, and the hashed dimensions.
TOPIC_ROWS = 4_000
TOPIC_BUCKETS = 256
TOPIC_ROUNDS = 12
#: Steps of 1 in the sums of vectors.
UNIT = 1 << 20
#: Default targets are the shares to this power, scaled to 1: small values gain, large ones lose.
FLATTEN = 0.5
#: Share of all tokens that the sample should hold.
BUDGET = 0.5
SWEEPS = 30
TOLERANCE = 5e-4
SEED = "mix"
DIMENSIONS = ("source", "lang", "topic")
UNKNOWN = "unknown"


def _counted(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words by hashed dimension, and the number of words."""
    n, rows = np.diff(w.first), len(w.first) - 1
    at = w.doc * TOPIC_BUCKETS + (w.hash >> np.uint64(40)).astype(np.int64) % TOPIC_BUCKETS
    return np.bincount(at, minlength=rows * TOPIC_BUCKETS).reshape(rows, TOPIC_BUCKETS).astype(np.int32), n


def _unit(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.sqrt(counts.astype(np.float32)) / np.maximum(1e-9, np.sqrt(n))[:, None].astype(np.float32)


def vectors(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of square roots of hashed word shares, and the number of words."""
    counts, n = _counted(w)
    return _unit(counts, n), n


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return vectors(words(column, ALNUM))


def _word_counts(texts: DataFrame) -> DataFrame:
    """``x``: the 32-bit word counts of each text that has words."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for i in range(0, part.num_rows, 512):
                    counts, n = _counted(words(part.column("text").slice(i, 512), ALNUM))
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in counts[n > 0]], pa.binary())], names=["x"])

    return written(texts.mapInArrow(scan, "x binary"), "topic-counts")


def _topic_sums(counts: DataFrame, centre: np.ndarray) -> np.ndarray:
    """The sum of the vectors nearest to each centroid, over all texts (in whole steps of 1 / UNIT, so in any order)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre), TOPIC_BUCKETS), np.int64)
        for batch in batches:
            for part in slices(batch, "x"):
                own = np.frombuffer(b"".join(part.column("x").to_pylist()), np.int32).reshape(-1, TOPIC_BUCKETS)
                x = _unit(own, own.sum(axis=1))
                topic, steps = (x @ centre.T).argmax(axis=1), np.rint(x * UNIT).astype(np.int64)
                for k in range(len(centre)):
                    total[k] += steps[topic == k].sum(axis=0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])], names=["at", "n"])

    rows = counts.mapInArrow(scan, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(centre) * TOPIC_BUCKETS)
    out[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(len(centre), TOPIC_BUCKETS)


def fit_topics(docs: DataFrame, total: int, text: str = "text") -> np.ndarray:
    """Unit centroids (topics x buckets) by spherical k-means over all texts, seeded from a sample; fewer if the sample is small."""
    texts = docs.select(F.col(text).alias("text"))
    sample = small_sample(texts, TOPIC_ROWS, total, "topics", "text").distinct()
    seen, name = with_result(sample, "text", "x array<float>, n bigint", lambda column: [list(_vectors(column)[0]), _vectors(column)[1]])
    rows = seen.filter(f"{name}.n > 0").select(f"{name}.x").toArrow().column("x").combine_chunks()
    if not len(rows):
        return np.zeros((0, TOPIC_BUCKETS), np.float32)
    x = np.unique(np.stack(rows.to_numpy(zero_copy_only=False)).astype(np.float32), axis=0)
    centre = x[[0]]
    while len(centre) < min(TOPICS, len(x)):
        centre = np.vstack((centre, x[(x @ centre.T).max(axis=1).argmin()]))
    counts = _word_counts(texts)
    for _ in range(TOPIC_ROUNDS):
        total_x = _topic_sums(counts, centre)
        size = np.linalg.norm(total_x, axis=1, keepdims=True)
        new = np.where(size > 0, total_x / np.maximum(size, 1e-9), centre).astype(np.float32)
        if (new == centre).all():
            break
        centre = new
    return centre


def assign_topics(docs: DataFrame, centre: np.ndarray, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of topic and n_tokens, and that struct's name."""
    shared = docs.sparkSession.sparkContext.broadcast(centre)

    def score(column: pa.Array) -> list:
        topic, n = [], []
        for i in range(0, len(column), 512):
            x, own = _vectors(column.slice(i, 512))
            topic.append(np.where(own > 0, (x @ shared.value.T).argmax(axis=1), -1) if len(shared.value) else np.full(len(own), -1))
            n.append(own)
        return [np.concatenate(topic).astype(np.int32), np.concatenate(n).astype(np.int64)]

    return with_result(docs, text, "topic int, n_tokens bigint", score)


def _targets(cells: DataFrame, given: dict[str, dict[str, float]] | None) -> DataFrame:
    """``dim, value, target``: shares of each dimension that sum to 1 over the values with tokens."""
    shares = None
    for dim in DIMENSIONS:
        own = cells.groupBy(F.lit(dim).alias("dim"), F.col(dim).cast("string").alias("value")).agg(F.sum("tokens").alias("tokens"))
        shares = own if shares is None else shares.union(own)
    shares = shares.filter("tokens > 0")
    named = [(d, str(v), float(t)) for d, own in (given or {}).items() for v, t in own.items()]
    spark = cells.sparkSession
    named = spark.createDataFrame(named, "dim string, value string, named double")
    flat = shares.join(named, ["dim", "value"], "left") if given else shares.withColumn("named", F.lit(None).cast("double"))
    free = F.when(F.col("named").isNull(), F.pow(F.col("tokens").cast("double"), F.lit(FLATTEN)))
    total = flat.groupBy("dim").agg(F.sum("named").alias("taken"), F.sum(free).alias("free"))
    left = F.greatest(F.lit(0.0), 1 - F.coalesce("taken", F.lit(0.0)))
    raw = flat.join(total, "dim").select("dim", "value", F.coalesce("named", free / F.col("free") * left).alias("raw"))
    scale = raw.groupBy("dim").agg(F.sum("raw").alias("all"))
    return raw.join(scale, "dim").select("dim", "value", (F.col("raw") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """``cells`` with ``weight``, the factor that brings their token shares to the targets.

    One sweep adjusts each dimension once and writes the cells after each, so every step is one
    small plan; sweeps end when no marginal is off by more than TOLERANCE, or after SWEEPS (cells
    that no weights can reconcile). Values without a target keep their weight.
    """
    targets = written(targets, "mix-targets")
    state = cells.withColumn("weight", F.lit(1.0) / F.lit(max(1, cells.agg(F.sum("tokens")).first()[0] or 1)))
    for dim in DIMENSIONS:
        own = targets.filter(F.col("dim") == dim).select(F.col("value").alias(f"of_{dim}"), F.col("target").alias(f"target_{dim}"))
        state = state.join(own, F.col(dim).cast("string") == F.col(f"of_{dim}"), "left").drop(f"of_{dim}")
    state = written(state, "mix-cells")
    columns = state.columns
    for _ in range(SWEEPS):
        worst = 0.0
        for dim in DIMENSIONS:
            seen, target = Observation(), F.col(f"target_{dim}")
            now = state.groupBy(dim).agg(F.sum(F.col("tokens") * F.col("weight")).alias("now"))
            factor = F.when((F.col("now") > 0) & target.isNotNull(), target / F.col("now")).otherwise(F.lit(1.0))
            step = state.join(now, dim).withColumn("weight", F.col("weight") * factor)
            step = step.observe(seen, F.max(F.abs(target - F.col("now"))).alias("gap"))
            state = written(step.select(columns).coalesce(8), "mix-cells")
            worst = max(worst, seen.get.get("gap") or 0.0)
        if worst < TOLERANCE:
            break
    return state.select(*cells.columns, "weight")


def calibrate(cells: DataFrame, budget: float) -> DataFrame:
    """``cells`` (tokens, weight) with ``scale``: expected kept tokens, the sum of tokens * min(1, scale * weight), meet the budget.

    That sum is concave and made of straight pieces, so Newton's steps from below never pass the
    goal and end in the piece that holds it.
    """
    every = cells.agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("weight")).alias("weighted")).first()
    goal = budget * (every["tokens"] or 0)
    scale = goal / every["weighted"] if every["weighted"] else 1.0
    while goal:
        part = F.col("weight") * F.lit(scale)
        row = cells.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), part)).alias("kept"),
                        F.sum(F.when(part < 1, F.col("tokens") * F.col("weight"))).alias("slope")).first()
        if not row["slope"] or goal - row["kept"] <= 1e-9 * goal:
            break
        scale += (goal - row["kept"]) / row["slope"]
    return cells.withColumn("scale", F.lit(scale))


def mix(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
        targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> tuple[DataFrame, str]:
    """``docs`` with a struct of n_tokens, topic, weight, probability, sampled and loss_weight, and that struct's name.

    ``targets`` names wanted token shares, as ``{"lang": {"en": 0.5}}``; without, each dimension's
    shares are flattened.
    """
    centre = fit_topics(docs, docs.count(), text)
    cell = [F.coalesce(F.col(source).cast("string"), F.lit(UNKNOWN)).alias("source"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang")]
    key = F.xxhash64(F.lit(SEED), F.col(doc).isNull(), F.col(doc), F.col(text))
    small, name = assign_topics(docs.select(key.alias("key"), *cell, F.col(text).alias("text")), centre, "text")
    cells = (small.select("source", "lang", f"{name}.topic", f"{name}.n_tokens").groupBy("source", "lang", "topic")
             .agg(F.sum("n_tokens").alias("tokens")))
    cells = written(cells.filter("tokens > 0"), "mix-counts")
    raked = rake(cells, _targets(cells, targets))
    raked = written(calibrate(raked, budget), "mix-weights")
    plain = (raked.groupBy("source", "lang").agg((F.sum(F.col("tokens") * F.col("weight")) / F.sum("tokens")).alias("weight"), F.max("scale").alias("scale"))
             .select("source", "lang", F.lit(-1).alias("topic"), "weight", "scale"))
    known = raked.select("source", "lang", "topic", "weight", "scale").union(plain)
    out, own = assign_topics(docs, centre, text)
    topic = F.col(f"{own}.topic")
    free = dict(zip(known.columns, free_names(out, *known.columns), strict=True))
    known = known.select(*[F.col(c).alias(x) for c, x in free.items()])
    joined = out.join(known, (cell[0] == F.col(free["source"])) & (cell[1] == F.col(free["lang"])) & (topic == F.col(free["topic"])), "left")
    weight = F.col(free["weight"])
    wanted = F.coalesce(F.col(free["scale"]) * weight, F.lit(1.0))
    chance = F.least(F.lit(1.0), wanted)
    draw = F.pmod(key, F.lit(1 << 40)) / float(1 << 40)
    return joined.select(*docs.columns, F.struct(
        F.col(f"{own}.n_tokens").alias("n_tokens"), topic.alias("topic"), weight.alias("weight"), chance.alias("probability"),
        (draw < chance).alias("sampled"), F.greatest(F.lit(1.0), wanted).alias("loss_weight")).alias(own)), own


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """Weight, probability and decision for every document."""
    docs = table(spark, sf_dir, "documents")
    found, name = mix(docs.select("doc_id", "text", "source", "lang"))
    return found.select("doc_id", "source", "lang", f"{name}.*")


def sample(docs: DataFrame, **how) -> DataFrame:
    """The sampled rows with their columns, and loss_weight unless a column has that name. For the corpus pipeline."""
    found, name = mix(docs, **how)
    more = [] if "loss_weight" in {c.lower() for c in docs.columns} else [f"{name}.loss_weight"]
    return found.filter(f"{name}.sampled").select(*docs.columns, *more)
