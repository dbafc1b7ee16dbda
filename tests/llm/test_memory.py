"""What tasks and the driver hold at once: small slices of text, few rounds of components."""

import random

import numpy as np
import pyarrow as pa

from headroom.llm import brown, langid, setjoin
from headroom.llm.text import with_result

TEXTS = ["ein Wort und noch ein Wort " * 40, None, "", "the words of a text " * 90] * 300  # over a megabyte


def test_language_margins_are_taken_from_small_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").coalesce(1)
    found, name = with_result(docs, "text", "bytes long", lambda column: [[sum(len(t or "") for t in column.to_pylist())] * len(column)], 1 << 14)
    assert found.agg({f"{name}.bytes": "max"}).first()[0] <= 1 << 14
    seen = []
    monkeypatch.setattr(langid, "with_result", lambda docs, text, fields, score, limit=None, **kept: seen.append(limit))
    langid.identify(docs, langid.Model(["a"], langid.codewords(1), langid.codewords(1), None))
    assert seen == [langid.SLICE] and langid.SLICE <= 1 << 18


def test_margins_do_not_depend_on_the_slice(spark):
    rng = random.Random(3)
    rows = [(" ".join("".join(rng.choice("abcdeäß ") for _ in range(7)) for _ in range(rng.randrange(40))), rng.choice(["de", "en", "fr", None])) for _ in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    model = langid.train(docs)
    column = pa.array([t for t, _ in rows])
    whole = langid._margins(column, model.gram_weight)
    parts = [langid._margins(column.slice(i, 7), model.gram_weight) for i in range(0, len(rows), 7)]
    assert (whole == [x for p in parts for x in p]).all()


def test_brown_words_are_split_from_small_slices(monkeypatch):
    limits, real = [], brown.slices
    monkeypatch.setattr(brown, "slices", lambda batch, text, limit=2 << 20: limits.append(limit) or real(batch, text, limit))
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS)], names=["text"])
    assert sum(map(len, brown._texts(iter([batch])))) == sum(len(brown.tokens(t)) for t in TEXTS)
    assert limits == [brown.SLICE] and brown.SLICE <= 1 << 18


def test_components_end_with_the_first_round_of_stars(spark, monkeypatch):
    written, real = [], setjoin.written
    monkeypatch.setattr(setjoin, "written", lambda df, name: written.append(name) or real(df, name))
    found = setjoin.components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1)]
    assert written == ["edges", "stars"]


def test_components_of_a_random_graph(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 230)] + [(300, 300)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = setjoin.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted(root.items())


def test_components_of_no_edges(spark):
    assert setjoin.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_counted_in_parts():
    rng = np.random.default_rng(4)
    kept = [rng.integers(-(1 << 63), 1 << 63, 500), np.array([-(1 << 63), (1 << 63) - 1, 0, -1, 7])]
    kept += [kept[0][::3].copy(), kept[1].copy(), np.empty(0, np.int64)]
    value, times = np.unique(np.concatenate(kept), return_counts=True)
    parts = list(setjoin._repeated(kept))
    assert len(parts) == setjoin.PARTS and max(len(v) for v, _ in parts) < 60
    assert dict(zip(value[times > 1].tolist(), times[times > 1].tolist())) == {v: n for vs, ns in parts for v, n in zip(vs.tolist(), ns.tolist())}
    assert [x.tolist() for x, _ in setjoin._repeated([])] == [[]] * setjoin.PARTS


def test_shingles_come_from_small_slices_and_settled_components_are_not_joined_again(spark, monkeypatch):
    made, real = [], setjoin.written
    monkeypatch.setattr(setjoin, "written", lambda df, name: made.append(name) or real(df, name))
    near = " ".join(f"w{i}" for i in range(40))
    rows = [(1, near), (2, near + " more"), (3, "other words of no other text"), (4, None), (5, near + " more"), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = setjoin.similar_components(docs, k=4, percent=85)
    assert {r.doc: r.component for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1, 6: 6}
    # with no leader to settle and no link in the blocks: the components of round one, and with those of round two
    assert made.count("roots") == 2 and "set-differences" not in made
    assert setjoin.SLICE <= 1 << 18
