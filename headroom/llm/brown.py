"""Language-model scoring with Brown classes.

Words and their counts come from all training texts. Exchange clustering puts the most frequent
words (CORE) into classes so that the mutual information of neighbouring classes is largest, from
the counts of all their neighbourhoods. Every other word then makes two exchange steps: it joins the
class that best explains the classes seen before and after it in all training texts, first those of
CORE words, then those of all words. The transitions between classes are then counted over all
bigrams of the training texts, with the classes of the whole vocabulary.

The model: P(word | before) = LAMBDA * P(class of word | class of before) * P(word | class of word)
+ (1 - LAMBDA) * base(word), where base is the add-one unigram estimate. Before a text stands its
end token. Words not seen in training are one class of their own, whose share is that of training
words seen once. So the probabilities of all seen words and one unseen add up to 1.

Frequent words after frequent words (HEAD, a bounded number) are scored where the text is; all other
occurrences join the whole vocabulary in Spark, by the word, by the word before or by both. So HEAD
decides where a word is scored and never its score.

Defined cases: null and empty texts are one end token; with no training text every token is unseen
and base and score are 0 for each; repeated rows each count and each get their row; a null doc_id
is not held out; a word beside no word with a class joins the largest class. Only the named columns
are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.llm.text import lists, slices, table, text_key, written

CORE = 1024
HEAD = 1 << 17
CLASSES = 32
EXCHANGES = 6
LAMBDA = 0.95
#: Weight, in tokens, of the class shares in each row of class transitions.
SMOOTH = 20.0
#: Words that a task holds before it passes their counts on.
HELD = 200_000
#: Bytes of text that a task splits into word objects at once.
SLICE = 1 << 18
#: The end token; no word is empty.
END = b""


def tokens(text: str | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased, then the end token."""
    out = text.encode().lower().split() if text else []
    out.append(END)
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            for text in part.column("text").to_pylist():
                yield tokens(text)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts, end tokens included."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for own in _texts(batches):
            held.update(own)
            if len(held) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
                held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    return docs.mapInArrow(scan, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int, *more: str) -> pa.Table:
    """At most ``limit`` words with the largest counts (words tied at the cut are left out together), sorted."""
    step = F.floor(F.log2("n") * 64)
    least, total = None, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > limit:
            break
        least = row["step"]
    found = counts.filter(step >= least) if least is not None else counts.filter("false")
    return found.select("word", "n", *more).toArrow().sort_by([("n", "descending"), ("word", "ascending")])


def encode(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """``ids, rare`` per text: its tokens as 32-bit numbers (``len(ids)`` for a word without one), and those words in their order."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, rest = shared.value.get, len(shared.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                codes, rare = [], []
                for text in part.column("text").to_pylist():
                    own = tokens(text)
                    code = [find(w, rest) for w in own]
                    codes.append(np.array(code, np.int32).tobytes())
                    rare.append(b" ".join([w for w, c in zip(own, code, strict=True) if c == rest]))
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()), pa.array(rare, pa.binary())], names=["ids", "rare"])

    return written(docs.mapInArrow(scan, "ids binary, rare binary"), "encoded-texts")


def _pairs(batches: Iterator[pa.RecordBatch], rest: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Of some texts: each token's left neighbour, the tokens, and the words that stand for ``rest``, ``rest + 1``, ..."""
    for batch in batches:
        for part in slices(batch, "ids"):
            now = np.frombuffer(b"".join(part.column("ids").to_pylist()), np.int32).astype(np.int64)
            known: dict[bytes, int] = {}
            now[now == rest] = [known.setdefault(w, rest + len(known)) for text in part.column("rare").to_pylist() for w in text.split()]
            yield np.concatenate(([0], now[:-1])), now, list(known)


def neighbours(encoded: DataFrame, rest: int, size: int) -> np.ndarray:
    """How often core word i is followed by core word j, over all texts (the end token, word 0, stands before each)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for before, now, _ in _pairs(batches, rest):
            both = (before < size) & (now < size)
            total += np.bincount(before[both] * size + now[both], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    rows = encoded.mapInArrow(scan, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, fixed: int, classes: int = CLASSES, rounds: int = EXCHANGES) -> np.ndarray:
    """Class of each word: moves single words between classes while the mutual information of neighbours grows.

    Words come most frequent first. Word ``fixed`` (the end token) keeps the last class to itself.
    """
    size = len(pairs)
    own = np.arange(size) % classes
    own[fixed] = classes
    total = classes + 1
    member = np.zeros((size, total))
    member[np.arange(size), own] = 1
    after, before = pairs @ member, pairs.T @ member
    joint = member.T @ after
    for _ in range(rounds):
        moved = 0
        for w in range(size):
            if w == fixed:
                continue
            a, self_ = own[w], pairs[w, w]
            right, left = after[w].copy(), before[w].copy()
            right[a] -= self_
            left[a] -= self_
            joint[a, :] -= right
            joint[:, a] -= left
            joint[a, a] -= self_
            rows, columns = joint.sum(axis=1), joint.sum(axis=0)
            n_right, n_left = right.sum() + self_, left.sum() + self_
            f = _xlogx(joint)
            gain_r = _xlogx(joint + right[None, :]) - f
            gain_l = _xlogx(joint + left[:, None]) - f
            diagonal = np.diagonal(joint)
            gain = (gain_r.sum(axis=1) - np.diagonal(gain_r) + gain_l.sum(axis=0) - np.diagonal(gain_l)
                    + _xlogx(diagonal + right + left + self_) - np.diagonal(f)
                    - _xlogx(rows + n_right + left) + _xlogx(rows + left)
                    - _xlogx(columns + n_left + right) + _xlogx(columns + right))
            b = int(gain[:classes].argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            joint[b, :] += right
            joint[:, b] += left
            joint[b, b] += self_
            if b != a:
                own[w] = b
                after[:, a] -= pairs[:, w]
                after[:, b] += pairs[:, w]
                before[:, a] -= pairs[w, :]
                before[:, b] += pairs[w, :]
                moved += 1
        if not moved:
            break
    return own


WIDTH = CLASSES + 2
#: A cell of a word's neighbourhood: the slot in the upper 8 bits (a class before the word, or WIDTH + a class after
#: it; the last class: a word without one), how often in the others.
COUNT_BITS = 24
_CELLS = "word binary, own int, cells binary"


def _cells(names: list[bytes] | None, word: np.ndarray, slot: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each run of ``word`` (ascending) with its cells; without ``names``, ``word`` is a class (``own``)."""
    first = np.flatnonzero(np.diff(word, prepend=-1))
    data = ((slot.astype(np.uint32) << COUNT_BITS) | n.astype(np.uint32)).tobytes()
    ends = np.append(first, len(word)).astype(np.int32) * 4
    cells = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
    words = pa.array([names[k] for k in word[first].tolist()], pa.binary()) if names else pa.nulls(len(first), pa.binary())
    own = pa.nulls(len(first), pa.int32()) if names else pa.array(word[first].astype(np.int32))
    return pa.RecordBatch.from_arrays([words, own, cells], names=["word", "own", "cells"])


def _events(names: list[bytes], word: np.ndarray, slot: np.ndarray) -> pa.RecordBatch:
    code, n = np.unique(word * (2 * WIDTH) + slot, return_counts=True)
    return _cells(names, code // (2 * WIDTH), code % (2 * WIDTH), n)


def _dense(names: list[bytes] | None, total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The cells of a table with a row of slots for each word, 10,000 rows at a time."""
    for i in range(0, len(total), 10_000):
        word, slot = np.nonzero(total[i:i + 10_000])
        if len(word):
            yield _cells(names, word + i, slot, total[word + i, slot])


def _opened(cells: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an array of cells: each one's row, slot and count."""
    cells = cells.cast(pa.large_binary())
    _, offsets, data = cells.buffers()
    ends = np.frombuffer(offsets, np.int64)[cells.offset:cells.offset + len(cells) + 1]
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(np.uint32)
    return np.repeat(np.arange(len(cells)), np.diff(ends) // 4), (flat >> COUNT_BITS).astype(np.int64), (flat & ((1 << COUNT_BITS) - 1)).astype(np.int64)


def contexts(encoded: DataFrame, ids: dict[bytes, int], classes: np.ndarray, vocabulary: DataFrame | None, core: int) -> DataFrame:
    """``word, own, cells``: how often each class stands before and after each word, over all texts; several rows a word.

    ``classes`` are those of the numbered words; the classes of all others come from a join with
    ``vocabulary`` (None: they have none yet). The last token's right neighbour isn't counted. The first
    ``core`` words keep their classes, so what stands beside them is only counted.
    """
    rest, whole = len(ids), vocabulary is not None
    shared = encoded.sparkSession.sparkContext.broadcast((list(ids), classes))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, own = shared.value
        total = np.zeros((rest, 2 * WIDTH), np.int32)
        for before, now, rare in _pairs(batches, rest):
            of = np.append(own, np.full(len(rare), WIDTH - 1))
            rare_word, rare_slot = [], []
            for word, slot, near in ((now, of[before], before), (before, WIDTH + of[now], now)):
                if whole:
                    here = (near < rest) | (word < core)
                    word, slot = word[here], slot[here]
                head = word < rest
                np.add.at(total.reshape(-1), word[head] * (2 * WIDTH) + slot[head], np.int32(1))
                rare_word.append(word[~head] - rest)
                rare_slot.append(slot[~head])
            yield _events(rare, np.concatenate(rare_word), np.concatenate(rare_slot))
            if total.max(initial=0) > 1 << (COUNT_BITS - 1):
                yield from _dense(names, total)
                total[:] = 0
        yield from _dense(names, total)

    seen = encoded.mapInArrow(scan, _CELLS)
    if whole:
        def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """near (a word without a number), the word beside it, and whether near stands after it."""
            names, _ = shared.value
            for before, now, rare in _pairs(batches, rest):
                every, size = names + rare, rest + len(rare)
                left, right = (before >= rest) & (now >= core), (now >= rest) & (before >= core)
                code, n = np.unique(np.concatenate(((before[left] * size + now[left]) * 2, (now[right] * size + before[right]) * 2 + 1)), return_counts=True)
                near, word = np.divmod(code // 2, size)
                yield pa.RecordBatch.from_arrays([pa.array([rare[k - rest] for k in near.tolist()], pa.binary()), pa.array([every[k] for k in word.tolist()], pa.binary()),
                                                  pa.array((code % 2).astype(np.int32)), pa.array(n.astype(np.int64))], names=["near", "word", "after", "n"])

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.arange(batch.num_rows)
                found = _cells(None, at, batch.column("slot").to_numpy(), batch.column("n").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("word"), pa.nulls(len(at), pa.int32()), found.column("cells")], names=["word", "own", "cells"])

        other = vocabulary.select(F.col("word").alias("near"), "class")
        more = (encoded.mapInArrow(beside, "near binary, word binary, after int, n bigint").join(other, "near")
                .select("word", (F.col("class") + F.col("after") * WIDTH).alias("slot"), "n"))
        seen = seen.union(more.mapInArrow(spread, _CELLS))
    return seen


def assign(seen: DataFrame, core: dict[bytes, int], joint: np.ndarray, share: np.ndarray | None) -> DataFrame:
    """``word, n, class``: core words keep their class, others take the one likeliest beside their neighbours' classes.

    A word whose neighbours all lack a class gets none (CLASSES + 1), or the largest of ``share`` if given.
    """
    joint = joint[:WIDTH - 1, :WIDTH - 1] + 0.5
    likely = np.zeros((2 * WIDTH, CLASSES))
    likely[:WIDTH - 1] = np.log(joint[:, :CLASSES] / joint[:, :CLASSES].sum(axis=0))
    likely[WIDTH:-1] = np.log(joint[:CLASSES] / joint[:CLASSES].sum(axis=1, keepdims=True)).T
    shared = seen.sparkSession.sparkContext.broadcast((core, likely))

    def classed(words: list[bytes], n: np.ndarray) -> pa.RecordBatch:
        known, log = shared.value
        own = (n @ log).argmax(axis=1).astype(np.int32)
        none = ~(n[:, :WIDTH - 1].any(axis=1) | n[:, WIDTH:-1].any(axis=1))
        own[none] = WIDTH - 1 if share is None else share[:CLASSES].argmax()
        for i, word in enumerate(words):
            own[i] = known.get(word, own[i])
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n[:, :WIDTH].sum(axis=1)), pa.array(own)], names=["word", "n", "class"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by word; the last word of a batch may go on in the next."""
        held: list[bytes] = []
        n_held = np.zeros((1, 2 * WIDTH), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word").to_pylist()
            new = np.array([True, *[a != b for a, b in zip(words, words[1:], strict=False)]])
            run = np.cumsum(new) - 1
            row, slot, times = _opened(batch.column("cells"))
            n = np.zeros((run[-1] + 1, 2 * WIDTH), np.int64)
            np.add.at(n.reshape(-1), run[row] * (2 * WIDTH) + slot, times)
            if held and held[0] == words[0]:
                n[0] += n_held[0]
            elif held:
                yield classed(held, n_held)
            ended = [words[i] for i in np.flatnonzero(new).tolist()]
            if len(ended) > 1:
                yield classed(ended[:-1], n[:-1])
            held, n_held = ended[-1:], n[-1:]
        if held:
            yield classed(held, n_held)

    dealt = seen.select("word", "cells").repartition("word").sortWithinPartitions("word")
    return written(dealt.mapInArrow(scan, "word binary, n bigint, class int"), "word-classes")


def numbered(words: DataFrame, ids: dict[bytes, int]) -> np.ndarray:
    """The classes of the numbered words, by number."""
    shared = words.sparkSession.sparkContext.broadcast(ids)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([shared.value.get(w, -1) for w in batch.column("word").to_pylist()], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own[own >= 0]), pa.array(batch.column("class").to_numpy()[own >= 0])], names=["id", "class"])

    found = words.mapInArrow(scan, "id int, class int").toArrow()
    out = np.zeros(len(ids), np.int64)
    out[found.column("id").to_numpy()] = found.column("class").to_numpy()
    return out


def class_pairs(encoded: DataFrame, ids: dict[bytes, int], classes: np.ndarray, vocabulary: DataFrame) -> np.ndarray:
    """How often class i is followed by class j over all bigrams, the classes of words without a number from ``vocabulary``."""
    rest = len(ids)
    shared = encoded.sparkSession.sparkContext.broadcast(classes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bigrams with a number on one side at least: by the word without one, else by the class that comes first."""
        of = shared.value
        total = np.zeros((WIDTH, 2 * WIDTH), np.int64)
        for before, now, rare in _pairs(batches, rest):
            both, left, right = (before < rest) & (now < rest), (before >= rest) & (now < rest), (before < rest) & (now >= rest)
            total[:, WIDTH:] += np.bincount(of[before[both]] * WIDTH + of[now[both]], minlength=WIDTH * WIDTH).reshape(WIDTH, WIDTH)
            yield _events(rare, np.concatenate((before[left], now[right])) - rest, np.concatenate((WIDTH + of[now[left]], of[before[right]])))
            if total.max() > 1 << (COUNT_BITS - 1):
                yield from _dense(None, total)
                total[:] = 0
        yield from _dense(None, total)

    def unnumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bigrams of two words without a number."""
        for before, now, rare in _pairs(batches, rest):
            both = (before >= rest) & (now >= rest)
            code, n = np.unique((before[both] - rest) * max(1, len(rare)) + now[both] - rest, return_counts=True)
            left, right = np.divmod(code, max(1, len(rare)))
            yield pa.RecordBatch.from_arrays([*[pa.array([rare[k] for k in side.tolist()], pa.binary()) for side in (left, right)], pa.array(n.astype(np.int64))], names=["lw", "rw", "n"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH * WIDTH, np.int64)
        for batch in batches:
            row, slot, n = _opened(batch.column("cells"))
            own = batch.column("own").to_numpy().astype(np.int64)[row]
            np.add.at(total, np.where(slot < WIDTH, slot * WIDTH + own, own * WIDTH + slot - WIDTH), n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((at // WIDTH).astype(np.int32)), pa.array((at % WIDTH).astype(np.int32)), pa.array(total[at])], names=["l", "r", "n"])

    of = vocabulary.select("word", "class")
    rows = encoded.mapInArrow(scan, _CELLS).join(of, "word", "left").select(F.coalesce("own", "class").alias("own"), "cells")
    other = encoded.mapInArrow(unnumbered, "lw binary, rw binary, n bigint")
    other = other.join(of, F.col("lw") == F.col("word")).select(F.col("class").alias("l"), "rw", "n")
    other = other.join(of, F.col("rw") == F.col("word")).select("l", F.col("class").alias("r"), "n")
    found = rows.mapInArrow(summed, "l int, r int, n bigint").union(other).groupBy("l", "r").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((WIDTH, WIDTH))
    out[found.column("l").to_numpy(), found.column("r").to_numpy()] = found.column("n").to_numpy()
    return out


class Model(NamedTuple):
    vocabulary: DataFrame
    head: dict[bytes, int]
    head_n: np.ndarray
    head_class: np.ndarray
    tokens: int
    words: int
    class_tokens: np.ndarray
    transition: np.ndarray


def train(docs: DataFrame, text: str = "text") -> Model:
    """The model of all rows of ``docs``. Classes: 0.. words, CLASSES the end, CLASSES + 1 unseen."""
    docs = docs.select(F.col(text).alias("text"))
    counts = written(word_counts(docs), "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum((F.col("n") == 1).cast("long")).alias("once")).first()
    if not total.n:
        return Model(counts.withColumn("class", F.lit(0)), {}, np.zeros(0), np.zeros(0, int), 0, 0, np.zeros(CLASSES + 2), np.full((CLASSES + 2, CLASSES + 2), 1.0 / (CLASSES + 2)))
    core = dict.fromkeys([END, *most_frequent(counts, CORE - 1).column("word").to_pylist()])
    ids = {w: i for i, w in enumerate(dict.fromkeys([*core, *most_frequent(counts, HEAD).column("word").to_pylist()]))}
    encoded = encode(docs, ids)
    pairs = neighbours(encoded, len(ids), len(core))
    own = exchange(pairs, 0)
    core = {w: int(c) for w, c in zip(core, own, strict=True)}
    member = np.zeros((len(own), WIDTH))
    member[np.arange(len(own)), own] = 1
    classes = np.append(own, np.full(len(ids) - len(own), WIDTH - 1))
    words = assign(contexts(encoded, ids, classes, None, len(core)), core, member.T @ pairs @ member, None)
    classes = numbered(words, ids)
    joint = class_pairs(encoded, ids, classes, words)
    words = assign(contexts(encoded, ids, classes, words, len(core)), core, joint, joint.sum(axis=0))
    moves = class_pairs(encoded, ids, numbered(words, ids), words)
    class_tokens = moves.sum(axis=0)
    share = class_tokens / class_tokens.sum()
    new = max(total.once, 1) / (total.n + 1)
    transition = (moves + SMOOTH * share) / (moves.sum(axis=1, keepdims=True) + SMOOTH) * (1 - new)
    transition[:, CLASSES + 1] = new
    head = most_frequent(words, HEAD, "class")
    return Model(words.select("word", "n", "class"), {w: i for i, w in enumerate(head.column("word").to_pylist())}, head.column("n").to_numpy().astype(float),
                 head.column("class").to_numpy().astype(int), int(total.n), int(total.v), class_tokens, transition)


def score(docs: DataFrame, model: Model, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc, n_tokens, n_known, base_score and score (log10 probabilities of the whole text)."""
    spark, size = docs.sparkSession, CLASSES + 2
    below = float(model.tokens + model.words + 1)
    shared = spark.sparkContext.broadcast((model.head, np.append(model.head_class, size - 1), model.head_n, model.class_tokens, model.transition))
    kind = docs.schema[doc].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, classes, counts, class_tokens, transition = shared.value
        find, rest = head.get, len(head)
        base = np.append((counts + 1) / below, 1.0)
        emission = np.append(counts / np.maximum(1, class_tokens[classes[:-1]]), 0.0)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = [tokens(t) for t in part.column("text").to_pylist()]
                ids = [np.array([find(w, rest) for w in own]) for own in texts]
                n = np.array([len(x) for x in ids])
                flat = np.concatenate(ids)
                first = np.concatenate(([0], np.cumsum(n)))
                left = np.concatenate(([rest], flat[:-1]))
                own, before = classes[flat], classes[left]
                before[first[:-1]] = CLASSES
                seen, open_ = flat < rest, left == rest
                open_[first[:-1]] = False
                sure = seen & ~open_
                p = np.where(sure, LAMBDA * transition[before, own] * emission[flat] + (1 - LAMBDA) * base[flat], 1.0)
                add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: B023, E731
                rare = []
                for t, start, end in zip(texts, first[:-1], first[1:], strict=True):
                    at = np.flatnonzero(~sure[start:end])
                    rare.append(Counter((None if k else t[i], f if k else rest, t[i - 1] if o else None, c)
                                        for i, k, f, o, c in zip(at.tolist(), seen[start:end][at].tolist(), flat[start:end][at].tolist(),
                                                                 open_[start:end][at].tolist(), before[start:end][at].tolist(), strict=True)))
                keys = [k for r in rare for k in r]
                known = np.array([k[1] for k in keys], np.int64)
                others = pa.StructArray.from_arrays([pa.array([k[0] for k in keys], pa.binary()), pa.array(np.append(counts, 0)[known].astype(np.int64)), pa.array(classes[known].astype(np.int32)),
                                                     pa.array([k[2] for k in keys], pa.binary()), pa.array([k[3] for k in keys], pa.int32()),
                                                     pa.array([x for r in rare for x in r.values()], pa.int32())], names=["word", "n", "class", "left", "before", "times"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("key"), pa.array(n), pa.array(add(seen.astype(np.int64))), pa.array(add(np.log10(base[flat]))),
                     pa.array(add(np.log10(p))), lists(others, np.array([len(r) for r in rare]))],
                    names=["doc", "key", "n_tokens", "known", "base", "own", "others"])

    rows = docs.select(F.col(doc).alias("doc"), text_key(doc, text).alias("key"), F.col(text).alias("text"))
    rows = written(rows.mapInArrow(scan, f"doc {kind}, key bigint, n_tokens bigint, known bigint, base double, own double, "
                                         "others array<struct<word:binary,n:bigint,class:int,left:binary,before:int,times:int>>"), "scored-texts")
    pending = rows.select("doc", "key", F.inline("others"))
    lefts = model.vocabulary.select(F.col("word").alias("left_word"), F.col("class").alias("left_class"))
    kept = ["doc", "key", "word", "n", "class"]
    pending = (pending.filter("left is null").select(*kept, "before", "times")
               .union(pending.filter("left is not null").join(lefts, F.col("left") == F.col("left_word"), "left")
                      .select(*kept, F.coalesce("left_class", F.lit(size - 1)).alias("before"), "times")))
    words = model.vocabulary.select("word", F.col("n").alias("own_n"), F.col("class").alias("own_class"))
    tail = (pending.filter("word is not null").join(words, "word", "left")
            .select("doc", "key", F.lit(True).alias("rare"), F.col("own_n").alias("n"), F.col("own_class").alias("class"), "before", "times")
            .union(pending.filter("word is null").select("doc", "key", F.lit(False), "n", "class", "before", "times")))
    count = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    of = F.coalesce(F.col("class"), F.lit(size - 1))
    pick = lambda values, at: F.element_at(F.array(*[F.lit(float(x)) for x in values]), at + 1)
    emission = F.when(F.col("n").isNull(), F.lit(1.0)).otherwise(count / F.greatest(F.lit(1.0), pick(model.class_tokens, of)))
    p = LAMBDA * pick(model.transition.ravel(), F.col("before") * size + of) * emission + (1 - LAMBDA) * (count + 1) / below
    tail = (tail.select("doc", "key", F.when(F.col("rare") & (count > 0), F.col("times")).otherwise(0).alias("known"),
                        F.when(F.col("rare"), F.col("times") * F.log10((count + 1) / below)).otherwise(0.0).alias("base"), (F.col("times") * F.log10(p)).alias("own"))
            .groupBy(F.col("doc").alias("d"), F.col("key").alias("k"))
            .agg(F.sum("known").alias("known2"), F.sum("base").alias("base2"), F.sum("own").alias("own2")))
    same = rows.groupBy("doc", "key").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n_tokens", "known", "base", "own")])
    found = same.join(tail, F.col("doc").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    more = lambda c: F.col(c) + F.coalesce(F.col(f"{c}2") / F.col("copies"), F.lit(0.0))
    return (found.withColumn("_copy", F.explode(F.expr("sequence(1, cast(copies as int))")))
            .select("doc", "n_tokens", F.round(more("known")).cast("long").alias("n_known"), more("base").alias("base_score"), more("own").alias("score")))


def held_out(doc: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % 7 == 2, F.lit(False))


def op2_brown_lm(spark, sf_dir: str) -> DataFrame:
    """Base and class-model score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.filter(~held_out()))
    found = score(docs, model)
    return found.select(F.col("doc").alias("doc_id"), held_out("doc").alias("held_out"), "n_tokens", "n_known",
                        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
