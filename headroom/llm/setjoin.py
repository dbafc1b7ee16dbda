"""N-gram Jaccard join with set-relation skipping.

A text's set is its distinct word k-shingles. Equal sets are one class from the start. Every class
puts a prefix of its shingles, rarest first, into an inverted index; two classes with the asked
similarity share an entry there. Three kinds of set relations spare most of the comparisons, and
none of them loses a link:

* Index skipping: an index list is cut into blocks by set size and position; blocks whose sizes or
  remaining lengths cannot reach the similarity are never joined.
* Answer skipping: each list first compares its members with a few leaders only. What a leader's
  answer holds belongs to its component at once; members of one component are never compared again.
* Incremental answers: of two sets compared with one leader L, the answer follows from their differences
  from L alone, |A ^ B| = |A ^ L| + |B ^ L| - 2 |(A ^ L) & (B ^ L)|. Where the two sizes are small enough
  the sets link without a look (one representative per leader takes all such links); elsewhere they must
  share a minimum of difference elements, so they meet only in an index of the rarest of these, and the
  common part of two short differences is the exact answer. No text is read for such pairs. Here too, if lists
  are large, each first compares its members with one only, the closest to L; then only members of different components
  meet, and only where enough elements are left from the shared one on.

Rarity is the number of sets that hold a shingle, counted over all texts inside each task (a shingle
alone in its task counts nothing there) and summed; it only orders the prefix, so any count is right.

Defined cases: null, empty and wordless texts have no set and are their own components; a text of
fewer than k words has one shingle, its whole sequence; equal texts are linked; a repeated doc_id
gets a row for each repeat; a null doc_id takes part and gets the component's smallest id that isn't
null; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headroom.llm.text import SPACED, free_names, grams, likely, lists, mix, slices, table, text_key, words, written

#: Bytes of text that a task splits into shingles at once, and in how many parts it counts a batch's shingles.
SLICE, PARTS = 1 << 18, 16
#: Of the shingles seen most, so many are told apart by their count; the rest are ordered by hash alone.
RANKED = 1 << 20
#: Leaders with which each list's members are compared, round by round, before the blocks are joined.
LEADERS = (1, 4)
#: Size of the bitmap of wanted texts.
BITMAP_BITS = 1 << 24
#: Members of one component and size band in a block.
BLOCK = 256
#: Members of one list, component and size band from which they get blocks of their own; members of a difference
#: list above which its closest one is compared first.
LARGE = 64
#: Width of a size band.
BAND = 1.04
#: A leader's members up to this Jaccard distance are settled by differences, where more than so many of them are
#: outside its largest component; all others meet in the blocks, at most OUTSIDERS pairs a member.
CLOSE, OUTSIDERS = 0.5, 32
#: Bands of a leader's members by how far they are from linking with it.
GAPS = 8


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text (flat), and the texts' bounds among them."""
    w = words(column, SPACED)
    n = np.diff(w.first)
    full = grams(w.hash, k)
    at = np.flatnonzero(np.arange(len(full)) + k <= w.last[:len(full)])
    value, doc = [full[at]], [np.searchsorted(w.first, at, side="right") - 1]
    for size in range(1, k):
        short = np.flatnonzero(n == size)
        value.append(mix(grams(w.hash, size)[w.first[short]] + np.uint64(size)) if len(short) else np.empty(0, np.uint64))
        doc.append(short)
    value, doc = np.concatenate(value).view(np.int64), np.concatenate(doc)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.searchsorted(doc[new], np.arange(len(column) + 1))


def signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set: a sum over hashes of its members and their number."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value.view(np.uint64)), dtype=np.uint64)))
    return mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def _first_seen(own: np.ndarray, n: np.ndarray, done: set[int]) -> np.ndarray:
    """Which sets are not empty and not yet in ``done``; adds them to it."""
    new = np.zeros(len(n), bool)
    for i, s in enumerate(own.tolist()):
        if n[i] and s not in done:
            done.add(s)
            new[i] = True
    return new


def _prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Of n shingles, how many must be indexed so that sets with percent/100 similarity share one."""
    return n - -(-n * percent // 100) + 1


def _repeated(kept: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The values that ``kept`` holds more than once and how often, a part of their range at a time."""
    width = (1 << 64) // PARTS
    for i in range(PARTS):
        least, most = i * width - (1 << 63), (i + 1) * width - 1 - (1 << 63)
        value, times = np.unique(np.concatenate([np.empty(0, np.int64), *[x[(x >= least) & (x <= most)] for x in kept]]), return_counts=True)
        yield value[times > 1], times[times > 1]


def _profile(docs: DataFrame, k: int) -> DataFrame:
    """Per row: doc, key, set (its signature) and n; and rows of a shingle and its sets in this batch."""
    kind = docs.schema["doc"].dataType.simpleString()
    names = ["doc", "key", "set", "n", "shingle", "times"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: set[int] = set()
            kept: list[np.ndarray] = []
            for part in slices(batch, "text", SLICE):
                value, first = shingle_sets(part.column("text"), k)
                own, n = signatures(value, first), np.diff(first)
                kept.append(value[np.repeat(_first_seen(own, n, done), n)])
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("key"), pa.array(own), pa.array(n.astype(np.int64)), none, none], names=names)
            for shingle, times in _repeated(kept):
                none = pa.nulls(len(shingle), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(shingle), batch.column("doc").type), none, none, none, pa.array(shingle), pa.array(times)], names=names)

    return docs.mapInArrow(scan, f"doc {kind}, key bigint, set bigint, n bigint, shingle bigint, times bigint")


def _common(seen: DataFrame) -> np.ndarray:
    """The shingles seen most, at most RANKED of them, most frequent first."""
    counted = seen.groupBy("shingle").agg(F.sum("times").alias("times"))
    counted = counted.withColumn("step", F.floor(F.log2("times") * 8))
    least, total = None, 0
    for row in counted.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > RANKED:
            break
        least = row["step"]
    if least is None:
        return np.empty(0, np.int64)
    rows = counted.filter(F.col("step") >= least).select("shingle", "times").toArrow()
    shingle, times = (rows.column(c).to_numpy() for c in ("shingle", "times"))
    return shingle[np.lexsort((shingle, -times))]


def _index(docs: DataFrame, common: np.ndarray, k: int, percent: int) -> DataFrame:
    """``shingle, set, n, pos`` for the prefix of each text's set, rarest shingles first."""
    shared = docs.sparkSession.sparkContext.broadcast((np.sort(common), np.argsort(common, kind="stable")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in batches:
            done: set[int] = set()
            for part in slices(batch, "text", SLICE):
                value, first = shingle_sets(part.column("text"), k)
                own, n = signatures(value, first), np.diff(first)
                new = np.repeat(_first_seen(own, n, done), n)
                doc = np.repeat(np.arange(len(n)), n)[new]
                value = value[new]
                order = np.zeros(len(value), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                    order = np.where(known[at] == value, len(known) - rank[at], 0)
                by = np.lexsort((value, order, doc))
                pos = np.arange(len(value)) - np.searchsorted(doc, doc)
                take = pos < _prefix_length(n, percent)[doc]
                doc, pos = doc[take], pos[take]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[by][take]), pa.array(own[doc]), pa.array(n[doc].astype(np.int32)), pa.array(pos.astype(np.int32))],
                    names=["shingle", "set", "n", "pos"])

    return docs.select("text").mapInArrow(scan, "shingle bigint, set bigint, n int, pos int")


def _texts(docs: DataFrame, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``set, text``: one text for each of ``sets``."""
    wanted = written(rows.join(sets, "set").groupBy("set").agg(F.min("key").alias("key")), "wanted-texts")
    found = likely(docs.select("key", "text"), "key", wanted, "key", BITMAP_BITS).join(wanted, "key")
    return found.groupBy("set").agg(F.any_value("text").alias("text"))


def _overlap(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``a, b, common, n_a, n_b, linked`` of each pair of sets, counted on whole texts."""
    both = (pairs.join(texts.select(F.col("set").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("set").alias("b"), F.col("text").alias("text_b")), "b"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hold = None, np.empty(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text_a", SLICE):
                value, first = shingle_sets(part.column("text_a"), k)
                names = part.column("b").to_numpy()
                common, size = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
                for i, name in enumerate(names.tolist()):
                    if name != last:
                        last, hold = name, shingle_sets(part.column("text_b").slice(i, 1), k)[0]
                    own = value[first[i]:first[i + 1]]
                    size[i] = len(hold)
                    if len(hold):
                        common[i] = np.count_nonzero(hold[np.minimum(np.searchsorted(hold, own), len(hold) - 1)] == own)
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(common), pa.array(n), pa.array(size),
                     pa.array(100 * common >= percent * (n + size - common))], names=["a", "b", "common", "n_a", "n_b", "linked"])

    return both.mapInArrow(scan, "a bigint, b bigint, common bigint, n_a bigint, n_b bigint, linked boolean")


def _unsettled(pairs: DataFrame) -> DataFrame:
    """Sets that keep the distinct ``pairs`` (a, b) from being stars: with two centres, or a centre and member at once."""
    ends = pairs.select(F.col("a").alias("set"), F.lit(1).alias("member"), F.lit(0).alias("centre")).union(
        pairs.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("set").agg(F.sum("member").alias("member"), F.max("centre").alias("centre")).filter("member + centre > 1")


def components(edges: DataFrame) -> DataFrame:
    """``set, root`` of every end of ``edges`` (a, b): the smallest set it is connected with.

    Alternating large-star and small-star steps, each written to the shared folder, until only stars are left.
    """
    pairs = written(edges.select("a", "b"), "edges")
    while True:
        both = pairs.union(pairs.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.u).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        joined = large.join(low, large.a == low.u)
        small = joined.select("a", F.col("m").alias("b")).union(joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        after = written(small, "stars")
        pairs = after
        if not _unsettled(pairs).limit(1).count():
            roots = pairs.select(F.col("b").alias("set")).distinct()
            return pairs.select(F.col("a").alias("set"), F.col("b").alias("root")).union(roots.select("set", F.col("set").alias("root")))


def _short_lists(index: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the open pairs inside lists of at most BLOCK members: a join with the same tests as blocks have."""
    a, b = (index.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("set", "root", "n", "pos", "leader")]) for x in "ab")
    most = F.least(F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) + F.least("pos_a", "pos_b"), F.least("n_a", "n_b"))
    fits = (most * 100 >= (F.col("n_a") + F.col("n_b") - most) * percent) & (F.col("leader_a") != F.col("leader_b"))
    on = (a.shingle == b.shingle) & (F.col("set_a") < F.col("set_b")) & (F.col("root_a") != F.col("root_b")) & fits
    return a.join(b, on).select(F.col("set_a").alias("a"), F.col("set_b").alias("b"))


def _blocks(index: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks of one list whose sizes can reach the similarity.

    Large components have blocks of their own, which are not joined with each other.
    """
    own = index.withColumn("band", F.floor(F.log(F.col("n")) / float(np.log(BAND))))
    by_root = own.groupBy("shingle", "band", "root").agg(F.count("*").alias("members"))
    own = own.join(by_root, ["shingle", "band", "root"]).withColumn("group", F.when(F.col("members") >= LARGE, F.col("root")))
    by_group = (by_root.groupBy("shingle", "band", F.when(F.col("members") >= LARGE, F.col("root")).alias("g"))
                .agg(F.ceil(F.sum("members") / BLOCK).alias("parts")))
    rows = F.collect_list(F.struct("set", "root", "n", "pos", "leader")).alias("rows")
    block = (own.alias("o").join(by_group.alias("g"), (F.col("o.shingle") == F.col("g.shingle")) & (F.col("o.band") == F.col("g.band"))
                                 & F.col("o.group").eqNullSafe(F.col("g.g")))
             .select("o.*", F.pmod(F.xxhash64("set"), F.col("parts")).alias("part"))
             .groupBy("shingle", "band", "group", "part").agg(rows, F.min("n").alias("least"), F.max("n").alias("most"))
             .withColumn("id", F.struct("band", F.coalesce("group", F.lit(0)).alias("g"), F.col("group").isNull().alias("mixed"), "part")))
    a, b = (block.select([F.col(c).alias(c if c == "shingle" else f"{c}_{x}") for c in block.columns]) for x in "ab")
    return (a.join(b, "shingle").filter("id_a <= id_b")
            .filter(F.col("group_a").isNull() | F.col("group_b").isNull() | (F.col("group_a") != F.col("group_b")))
            .filter((F.col("most_a") * 100 >= F.col("least_b") * percent) & (F.col("most_b") * 100 >= F.col("least_a") * percent))
            .select("rows_a", "rows_b"))


def _open_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the block pairs' members that components, sizes, positions and leaders' answers leave open."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(x)[i].values for x in ("rows_a", "rows_b"))
                of = lambda name: (a.field(name).to_numpy(zero_copy_only=False)[:, None], b.field(name).to_numpy(zero_copy_only=False)[None, :])  # noqa: B023, E731
                (n, m), (at, at2), (root, root2), (lead, lead2) = map(of, ("n", "pos", "root", "leader"))
                most = np.minimum(np.minimum(n - at, m - at2) + np.minimum(at, at2), np.minimum(n, m)).astype(np.int64)
                fits = (100 * most >= percent * (n + m - most)) & (root != root2)
                fits &= lead != lead2
                x, y = np.nonzero(fits)
                one, two = of("set")[0][x, 0], of("set")[1][0, y]
                pair = np.unique(np.stack((np.minimum(one, two), np.maximum(one, two))), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["a", "b"])

    return blocks.mapInArrow(scan, "a bigint, b bigint")


def _mains(first: DataFrame) -> DataFrame:
    """``set, leader, n, apart``: each set's main leader, the first by hash of those it was compared with in round
    one or is itself, and the Jaccard distance; sets that share a list mostly share it."""
    leaders = first.groupBy(F.col("b").alias("set")).agg(F.max("n_b").alias("n")).select("set", F.col("set").alias("leader"), "n", F.lit(0.0).alias("apart"))
    apart = 1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))
    each = first.select(F.col("a").alias("set"), F.col("b").alias("leader"), F.col("n_a").alias("n"), apart.alias("apart")).union(leaders)
    best = F.min_by(F.struct("leader", "n", "apart"), F.struct(F.xxhash64(F.lit(0), F.lit(0), "leader"), "leader"))
    return each.groupBy("set").agg(best.alias("x")).select("set", "x.leader", "x.n", "x.apart")


def _settled(mains: DataFrame, roots: DataFrame) -> DataFrame:
    """``set, leader, n, root`` of the close members of leaders that leave many of them in other components."""
    close = (mains.filter(F.col("apart") <= CLOSE).join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
             .select("set", "leader", "n", "root"))
    sizes = close.groupBy("leader", "root").agg(F.count("*").alias("size")).groupBy("leader").agg((F.sum("size") - F.max("size")).alias("outside"))
    return close.join(sizes.filter(F.col("outside") > OUTSIDERS).select("leader"), "leader").select("set", "leader", "n", "root")


def _differences(sets: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``set, leader, n, root, delta``: the shingles in which each set differs from its leader."""
    both = (sets.join(texts, "set").join(texts.select(F.col("set").alias("leader"), F.col("text").alias("leader_text")), "leader")
            .select("set", "leader", "n", "root", "text", "leader_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hold = None, np.empty(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                value, first = shingle_sets(part.column("text"), k)
                names, delta = part.column("leader").to_numpy(), []
                for i, name in enumerate(names.tolist()):
                    if name != last:
                        last, hold = name, shingle_sets(part.column("leader_text").slice(i, 1), k)[0]
                    delta.append(np.setxor1d(value[first[i]:first[i + 1]], hold, assume_unique=True))
                flat = np.concatenate(delta) if delta else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("set", "leader", "n", "root")), lists(flat, np.array([len(d) for d in delta]))],
                                                 names=["set", "leader", "n", "root", "delta"])

    return both.mapInArrow(scan, "set bigint, leader bigint, n bigint, root bigint, delta array<bigint>")


def _links_by_difference(sets: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``a, b`` linked: enough links that sets with one main leader are connected exactly as all of theirs would.

    With q = 100 + percent and gap = q |A ^ L| - (100 - percent) |A|, two sets of leader L link when their gaps
    are at most 2 q times the number of common difference elements.
    """
    q = 100 + percent
    own = sets.filter("set = leader").select("set", "leader", "n", "root", F.expr("cast(array() as array<bigint>)").alias("delta"))
    found = _differences(sets.filter("set <> leader"), texts, k).union(own)
    found = written(found.withColumn("gap", F.size("delta") * q - F.col("n") * (100 - percent)), "set-differences")
    group = found.groupBy("leader").agg(F.min_by("set", F.struct("gap", "set")).alias("close"), F.min("gap").alias("low"), F.max("gap").alias("high"))
    near = found.join(group, "leader")
    direct = near.filter((F.col("gap") + F.col("low") <= 0) & (F.col("set") != F.col("close"))).select(F.col("set").alias("a"), F.col("close").alias("b"))

    width = F.greatest(F.lit(2 * q).cast("long"), F.ceil((F.col("high") - F.col("low") + 1) / GAPS))
    near = near.withColumn("width", width).withColumn("band", F.floor((F.col("gap") - F.col("low")) / F.col("width")))
    rarity = near.select("leader", F.explode("delta").alias("element")).groupBy("leader", "element").agg(F.count("*").alias("times"))
    rarity = rarity.filter("times > 1")  # an element of one set alone is in no other's difference
    ranked = (near.select("leader", "set", "gap", "root", "band", "low", "width", F.size("delta").alias("d"), F.explode("delta").alias("element"))
              .join(rarity, ["leader", "element"])
              .groupBy("leader", "set", "gap", "root", "band", "low", "width", "d").agg(F.sort_array(F.collect_list(F.struct("times", "element"))).alias("shared")))
    # With a partner in a band so many difference elements are common at least; those that no other set has count as the rarest.
    least = F.greatest(F.lit(1), F.ceil((F.col("gap") + F.col("low") + F.col("partner") * F.col("width")) / (2 * q)))
    met = (ranked.withColumn("partner", F.explode(F.sequence(F.lit(0), F.lit(GAPS)))).withColumn("least", least)
           .withColumn("take", F.size("shared") - F.col("least") + 1).filter("take > 0")
           .select("leader", "set", "gap", "root", "band", "partner", F.size("shared").alias("d"),
                   F.posexplode(F.slice(F.transform("shared", lambda x: x["element"]), F.lit(1), F.col("take").cast("int"))).alias("at", "element"))
           .select("leader", "set", "gap", "root", "band", "partner", "element", (F.col("d") - F.col("at")).alias("rest")))
    met = written(met, "difference-lists")
    side = found.select("set", "gap", "delta")
    close, sizes = direct, met.filter("partner = 0").groupBy("leader", "element").count()
    if sizes.filter(F.col("count") > LARGE).limit(1).count():
        close = written(direct.union(_linked(_with_closest(met), side, q)), "links-with-closest")
        roots = components(close.union(sets.filter("set <> root").select("set", "root")))
        met = met.join(roots.select("set", F.col("root").alias("now")), "set", "left").withColumn("root", F.coalesce("now", "root"))
    return close.union(_linked(_open_meetings(met, q), side, q))


def _with_closest(met: DataFrame) -> DataFrame:
    """``a, b``: each difference list's members with the one closest to the leader, where components differ."""
    every = met.filter("partner = 0")  # the longest prefixes hold all others
    first = every.groupBy("leader", "element").agg(F.min(F.struct("gap", "set", "root")).alias("x"))
    first = first.select("leader", "element", F.col("x.set").alias("b"), F.col("x.root").alias("root_b"))
    return every.join(first, ["leader", "element"]).filter("root <> root_b").select(F.col("set").alias("a"), "b").distinct()


def _open_meetings(met: DataFrame, q: int) -> DataFrame:
    """``a, b`` of different components that share an entry and can still have enough elements in common from there on."""
    both = met.select("leader", F.least("band", "partner").alias("lower"), F.greatest("band", "partner").alias("upper"), "element", "set", "root", "band", "gap", "rest")
    x, y = (both.select("leader", "lower", "upper", "element", *[F.col(c).alias(f"{c}_{side}") for c in ("set", "root", "band", "gap", "rest")]) for side in "ab")
    return (x.filter("band_a = lower").join(y.filter("band_b = upper"), ["leader", "lower", "upper", "element"])
            .filter(f"root_a <> root_b and (lower < upper or set_a < set_b) and gap_a + gap_b <= {2 * q} * least(rest_a, rest_b)")
            .select(F.col("set_a").alias("a"), F.col("set_b").alias("b")).distinct())


def _linked(pairs: DataFrame, side: DataFrame, q: int) -> DataFrame:
    """The ``pairs`` (a, b) that link, from the gaps and differences in ``side``."""
    known = (pairs.join(side.select(*[F.col(c).alias(f"{c}_a") for c in side.columns]), F.col("a") == F.col("set_a"))
             .join(side.select(*[F.col(c).alias(f"{c}_b") for c in side.columns]), F.col("b") == F.col("set_b")))
    return known.filter(F.col("gap_a") + F.col("gap_b") <= 2 * q * F.size(F.array_intersect("delta_a", "delta_b"))).select("a", "b")


def _untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    if tried is None:
        return pairs
    both = tried.select("a", "b").union(tried.select("b", "a"))
    return pairs.join(both, ["a", "b"], "left_anti")


def similar_components(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc, key (of doc and text), n_shingles, component (its smallest doc) and root (its key)."""
    own = docs.select(F.col(doc).alias("doc"), text_key(doc, text).alias("key"), F.col(text).alias("text"))
    seen = written(_profile(own, k), "shingle-profile")
    rows = seen.filter("n is not null").select("doc", "key", "set", "n")
    index = written(_index(own, _common(seen.filter("times is not null")), k, percent), "prefix-index")
    several = index.groupBy("shingle").agg(F.min("set").alias("low"), F.max("set").alias("high")).filter("low <> high").select("shingle")
    several = written(several, "shared-shingles")
    index = written(likely(index, "shingle", several, "shingle", BITMAP_BITS).join(several, "shingle").distinct(), "prefix-lists")
    texts = written(_texts(own, rows.filter("n > 0"), index.select("set").distinct()), "listed-texts")
    tried, mains, roots, state = None, None, None, index.withColumn("root", F.col("set"))
    for turn in range(len(LEADERS) + 1):
        mixed = state.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("shingle")
        state = state.join(mixed, "shingle")
        if turn < len(LEADERS):
            first = [F.min(F.struct(F.xxhash64(F.lit(turn), F.lit(i), "set").alias("o"), F.col("set").alias("lead"), F.col("root").alias("lead_root"), F.col("n").alias("lead_n")))
                     for i in range(LEADERS[turn])]
            first = state.groupBy("shingle").agg(F.array(*first).alias("x")).select("shingle", F.inline(F.array_distinct("x")))
            pairs = (state.join(first.drop("o").distinct(), "shingle").filter("root <> lead_root")
                     .filter((F.col("n") * 100 >= F.col("lead_n") * percent) & (F.col("lead_n") * 100 >= F.col("n") * percent))
                     .select(F.col("set").alias("a"), F.col("lead").alias("b")).distinct())
        else:
            state = state.join(mains.select("set", "leader"), "set", "left").withColumn("leader", F.coalesce("leader", "set"))
            state = written(state, "open-lists")
            long = state.groupBy("shingle").count().filter(F.col("count") > BLOCK).select("shingle")
            pairs = (_short_lists(state.join(long, "shingle", "left_anti"), percent)
                     .union(_open_pairs(_blocks(state.join(long, "shingle"), percent), percent)).distinct())
        found = written(_overlap(_untried(pairs, tried), texts, k, percent), "answers")
        tried = found if tried is None else tried.union(found)
        links = found.filter("linked").select("a", "b")
        if turn == 0:
            mains = written(_mains(found), "main-leaders")
        if turn == len(LEADERS) - 1:  # before the blocks: whatever follows from differences
            now = links if roots is None else links.union(roots.filter("set <> root").select("set", "root"))
            roots = written(components(now), "roots")
            mains = written(_settled(mains, roots), "settled-sets")
            links = links.limit(0) if not mains.limit(1).count() else written(_links_by_difference(mains, texts, k, percent), "links-by-difference")
        if roots is None:
            roots = written(components(links), "roots")
        elif links.limit(1).count():  # without a new link the components stay
            roots = written(components(links.union(roots.filter("set <> root").select("set", "root"))), "roots")
        state = index.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    by_set = (rows.filter("n > 0").groupBy("set").agg(F.min("doc").alias("least"))
              .join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")))
    by_root = by_set.groupBy("root").agg(F.min("least").alias("component"))
    found = by_set.select("set", "root").join(by_root, "root")
    whole = rows.filter("n > 0").join(found, "set").select("doc", "key", F.col("n").alias("n_shingles"), "component", "root")
    return whole.union(rows.filter("n = 0").select("doc", "key", "n", "doc", F.lit(None).cast("long")))


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Of each component the row with the smallest doc (nulls last), and every row without a set; same columns."""
    found = written(similar_components(docs, doc=doc, text=text, **how), "similar-components")
    one = found.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "key")).alias("x"))
    own, key, once, copy = free_names(docs, "own", "key", "once", "copy")
    kept = one.select(F.col("x.key").alias(key), F.lit(True).alias(once)).union(
        found.filter("root is null").select("key", F.lit(False)).distinct())
    rows = docs.withColumn(own, text_key(doc, text)).join(kept, F.col(own) == F.col(key))
    rows = rows.withColumn(copy, F.row_number().over(Window.partitionBy(own).orderBy(own)))
    return rows.filter(~F.col(once) | (F.col(copy) == 1)).select(*docs.columns)


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles and a Jaccard similarity of at least 0.85."""
    found = similar_components(table(spark, sf_dir, "documents"), k=4, percent=85)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
