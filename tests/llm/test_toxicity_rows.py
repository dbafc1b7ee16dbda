"""Toxicity learns from all labelled rows, in shards."""

import random

import numpy as np
import pytest

from headroom.llm import toxicity
from tests.llm.test_operators import prose

SCHEMA = "doc_id long, text string, toxic int"
MARKS = ["".join(random.Random(100 + i).choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for i in range(24)]
WORDS = prose(1, 300).split()


def plain(seed: int) -> list[str]:
    rng = random.Random(seed)
    return [rng.choice(WORDS) for _ in range(14)]


@pytest.fixture(scope="module")
def labelled(spark):
    """A third is toxic by one of many words, each in 18 texts; half as many more rows by copies of one text."""
    rng, rows = random.Random(5), []
    for i in range(3 * 18 * len(MARKS)):
        words = plain(i)
        if i % 3 == 0:
            words.insert(rng.randrange(len(words)), MARKS[i // 3 % len(MARKS)])
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    rows += [(5000 + i, "the same old harmless text again", 0) for i in range(600)] + [(9000, None, 0), (9001, "", 0), (9002, "new", None), (None, "null", 0)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_words_in_few_of_many_labelled_rows_are_learned(spark, labelled, monkeypatch):
    monkeypatch.setattr(toxicity, "ROWS", 150)  # far fewer than the rows of either kind
    model = toxicity.train(labelled)
    docs = spark.createDataFrame([(i, " ".join([*plain(7000 + i), m]), 1) for i, m in enumerate(MARKS)] + [(100 + i, " ".join(plain(8000 + i)), 0) for i in range(100)], SCHEMA)
    found, name = toxicity.classify(docs, model)
    got = found.select("toxic", f"{name}.score").collect()
    assert sum(r.score >= 0.5 for r in got if r.toxic) >= 22
    assert sum(r.score >= 0.5 for r in got if not r.toxic) <= 3


def test_the_network_does_not_depend_on_how_rows_come(labelled, monkeypatch):
    monkeypatch.setattr(toxicity, "ROWS", 250)
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    one, other = toxicity.train(labelled.coalesce(1)), toxicity.train(labelled.repartition(7, "text"))
    for a, b in zip([one.network.embedding, one.network.out, *one.network.filters], [other.network.embedding, other.network.out, *other.network.filters], strict=True):
        assert (a == b).all()
    assert np.allclose(one.threshold, other.threshold, atol=1e-9) and abs(one.slope - other.slope) < 1e-9


def test_a_shard_takes_every_row_once_and_copies_are_spread(labelled):
    own = labelled.where("toxic is not null").selectExpr("text", "toxic as label", "xxhash64(text) as key", "doc_id is null as back", "cast(coalesce(doc_id, 0) % 4 as int) as shard")
    packed = toxicity.pack(own, 4, np.zeros((0, 1)))
    shards = sorted((s for b in packed.toArrow().to_batches() for s in toxicity._shards(b)), key=lambda s: s.number)
    want = {r.shard: r for r in own.selectExpr("*", "coalesce(regexp_count(text, '[A-Za-z0-9]+'), 0) as words").groupBy("shard").agg({"label": "sum", "words": "sum", "*": "count"}).collect()}
    assert [s.number for s in shards] == sorted(want)
    for s in shards:
        assert (len(s.label), s.label.sum(), s.first[-1]) == (want[s.number]["count(1)"], want[s.number]["sum(label)"], want[s.number]["sum(words)"])
    texts = {r.text for r in own.where("shard = 1").collect()}
    rows, first = toxicity.hashed(toxicity.words(toxicity.pa.array(sorted(texts)), toxicity.ALNUM))
    seen = {rows[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)}
    assert {shards[1].rows(i).tobytes() for i in range(len(shards[1].label))} == seen


def test_thresholds_equal_plain_newton_steps(spark):
    rng = np.random.default_rng(3)
    z, group = rng.normal(0, 2, 400), rng.integers(0, 3, 400)
    label = (rng.random(400) < 1 / (1 + np.exp(1 - z - 0.5 * group))).astype(int)
    weight = (0.7, 1.9)
    rows = spark.createDataFrame([(float(a), int(b), int(c)) for a, b, c in zip(z, group, label, strict=True)], "z double, grp int, label int").repartition(3)
    slope, threshold = toxicity.calibrate(rows, weight, 3)
    x = np.concatenate((z[:, None], np.ones((400, 1)), np.eye(3)[group]), axis=1)
    keep, start, w = np.diag([1e-2, 1e-3, 1.0, 1.0, 1.0]), np.eye(5)[0], np.where(label == 1, weight[1], weight[0])
    b = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b -= np.linalg.solve(x.T @ (x * (w * np.maximum(p * (1 - p), 1e-3))[:, None]) + keep, x.T @ (w * (p - label)) + keep @ (b - start))
        b[0] = max(b[0], 0.2)
    assert abs(slope - b[0]) < 1e-9 and np.allclose(threshold, -(b[1] + b[2:]) / b[0], atol=1e-9)
