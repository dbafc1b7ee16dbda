"""Links from differences: a large group of near copies on both sides of the limit, against all pairs."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from headroom.llm import setjoin
from tests.llm.test_operators import brute_components, frame, prose


def near_copies(seed, n, words, edits):
    rng = random.Random(seed)
    base = prose(seed, words).split()
    rows = []
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(words), rng.choice(edits)):
            own[at] = prose(rng.random(), 1) + str(i)
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize(("k", "percent", "edits"), [(4, 85, [1, 2, 3, 3, 4, 4, 5, 6]), (5, 80, [2, 4, 5, 6, 7, 9])])
def test_a_large_group_on_both_sides_of_the_limit(spark, monkeypatch, k, percent, edits):
    calls, real = [], setjoin._links_by_difference
    monkeypatch.setattr(setjoin, "_links_by_difference", lambda sets, *rest: calls.append(sets.count()) or real(sets, *rest))
    rows = near_copies(3, 400, 120, edits)
    # A second family of edits that members share, so that differences have common parts.
    rng = random.Random(4)
    for i in range(400, 460):
        own = rows[rng.randrange(400)][1].split()
        own[7:12] = [f"common{rng.randrange(3)}"] * 5
        rows.append((i, " ".join(own)))
    got = setjoin.similar_components(frame(spark, rows, "doc_id long, text string"), k=k, percent=percent)
    found = sorted((repr(r.doc), r.n_shingles, repr(r.component)) for r in got.collect())
    want = brute_components(rows, k, percent)
    assert found == want
    assert calls[0] > 100
    sizes = Counter(c for _, _, c in want)
    assert len(sizes) > 20 and max(sizes.values()) > 20  # some linked, some not


def links(sets, percent):
    return {(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 100 * len(x & y) >= percent * len(x | y)}


def roots(names, pairs):
    up = {n: n for n in names}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in names}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_by_difference_connect_what_all_pairs_connect(spark, seed):
    percent, k = 80, 2
    texts = [t for _, t in near_copies(seed, 60, 60, [0, 1, 2, 3, 4, 5, 8, 20])]
    value, first = setjoin.shingle_sets(pa.array(texts), k)
    names = setjoin.signatures(value, first).tolist()
    sets = {s: set(value[a:b].tolist()) for s, a, b in zip(names, first[:-1], first[1:], strict=True)}
    leader = names[seed]
    rows = spark.createDataFrame([(s, leader, len(x), s) for s, x in sets.items()], "set long, leader long, n long, root long")
    shown = spark.createDataFrame(list(zip(names, texts, strict=True)), "set long, text string").dropDuplicates(["set"])
    got = {tuple(sorted(r)) for r in setjoin._links_by_difference(rows, shown, k, percent).collect()}
    every = links(sets, percent)
    assert got <= every
    assert roots(sets, got) == roots(sets, every)
    assert len(got) <= len(every)
    delta = {r.set: set(r.delta) for r in setjoin._differences(rows.filter("set <> leader"), shown, k).collect()}
    assert delta == {s: x ^ sets[leader] for s, x in sets.items() if s != leader}
    assert np.array_equal(sorted(sets), sorted(set(names)))


def test_members_of_one_component_do_not_meet_again(spark, monkeypatch):
    """The pairs compared by their differences grow with a group's members, not with their square."""
    monkeypatch.setattr(setjoin, "LARGE", 8)

    def compared(n):
        texts = [t for _, t in near_copies(7, n, 120, [1, 2, 3])]
        value, first = setjoin.shingle_sets(pa.array(texts), 4)
        names = setjoin.signatures(value, first).tolist()
        rows = spark.createDataFrame([(s, names[0], int(b - a), s) for s, a, b in zip(names, first[:-1], first[1:], strict=True)], "set long, leader long, n long, root long")
        shown = spark.createDataFrame(list(zip(names, texts, strict=True)), "set long, text string")
        pairs, real = [], setjoin._linked
        monkeypatch.setattr(setjoin, "_linked", lambda p, *rest: pairs.append(p.count()) or real(p, *rest))
        got = {tuple(r) for r in setjoin._links_by_difference(rows, shown, 4, 85).collect()}
        monkeypatch.setattr(setjoin, "_linked", real)
        sets = {s: set(value[a:b].tolist()) for s, a, b in zip(names, first[:-1], first[1:], strict=True)}
        assert roots(sets, got) == roots(sets, links(sets, 85))
        return sum(pairs)

    small, large = compared(150), compared(600)
    assert large < 8 * small and large < 20 * 600
