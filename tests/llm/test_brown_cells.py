"""What passes between op2's scans and its classes: cells for what stands beside a word, nothing for what doesn't."""

from collections import Counter, defaultdict

import numpy as np

from headroom.llm import brown
from tests.llm.test_operators import frame, prose


def test_contexts_hold_only_what_was_seen(spark):
    texts = [f"{prose(i, 30)} rare{i} once{i} {prose(i + 100, 5)}" for i in range(40)] + [None, ""]
    docs = frame(spark, [(t,) for t in texts], "text string").repartition(3)
    counts = Counter(w for t in texts for w in brown.tokens(t))
    ids = {w: i for i, w in enumerate([brown.END, *sorted(w for w in counts if w != brown.END and counts[w] > 3)])}
    classes = np.arange(len(ids)) % brown.CLASSES
    rare = sorted(w for w in counts if w not in ids)
    assert len(rare) > 60
    vocabulary = spark.createDataFrame([(bytearray(w), i % brown.CLASSES) for i, w in enumerate(rare)]
                                       + [(bytearray(w), int(classes[i])) for w, i in ids.items()], "word binary, class int")
    of = {w: int(classes[i]) for w, i in ids.items()} | {w: i % brown.CLASSES for i, w in enumerate(rare)}
    encoded = brown.encode(docs, ids)
    for whole in (False, True):
        want: dict[bytes, Counter] = defaultdict(Counter)
        for t in texts:
            line = [brown.END, *brown.tokens(t)]
            for a, b in zip(line, line[1:], strict=False):
                slot = lambda w: of[w] if whole or w in ids else brown.WIDTH - 1  # noqa: B023, E731
                want[b][slot(a)] += 1
                want[a][brown.WIDTH + slot(b)] += 1
        rows = brown.contexts(encoded, ids, classes, vocabulary if whole else None, 1).select("word", "cells").collect()
        assert sum(len(r.cells) for r in rows) <= 4 * 2 * sum(counts.values())
        got: dict[bytes, Counter] = defaultdict(Counter)
        for r in rows:
            for cell in np.frombuffer(bytes(r.cells), np.uint32).tolist():
                got[bytes(r.word)][cell >> brown.COUNT_BITS] += cell & ((1 << brown.COUNT_BITS) - 1)
        want.pop(brown.END), got.pop(brown.END)  # the one core word: its neighbours are only counted
        assert got == want
    moves = np.zeros((brown.WIDTH, brown.WIDTH))
    for t in texts:
        line = [brown.END, *brown.tokens(t)]
        for a, b in zip(line, line[1:], strict=False):
            moves[of[a], of[b]] += 1
    assert (brown.class_pairs(encoded, ids, classes, vocabulary) == moves).all()
