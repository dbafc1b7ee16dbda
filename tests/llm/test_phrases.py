"""Phrase mining against plain counts, and its defined cases."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headroom.llm import phrases

DOCS = "doc_id long, text string, lang string"


def plain(rows, longest=3, least=10, share=50, top=2000):
    freq, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(w)
            for k in range(1, longest + 1):
                freq["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in freq.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        gone = {x[i:i + k] for x, b in found.items() for k in range(2, len(x)) for i in range(len(x) - k + 1) if 100 * b >= share * found[x[i:i + k]]}
        best = []
        for g, a in found.items():
            if g not in gone:
                score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                best.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, i, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus(seed, n, words="aa Bb cc dd ee ff zz é É 日本".split()):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", " , ", " "]) for _ in range(rng.randrange(80))),
             rng.choice(["en", "en", "en", "de", None])) for i in range(n)]


def found(spark, rows, schema=DOCS, **how):
    return sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, schema), **how).collect()))


@pytest.mark.parametrize("how", [{}, {"longest": 2, "least": 3}, {"longest": 4, "least": 3, "share": 80}, {"longest": 5, "least": 2, "top": 7}])
def test_equals_plain_counts(spark, how):
    rows = corpus(3, 60)
    rows += [(100 + i, rows[1][1], "en") for i in range(12)]  # copies
    assert found(spark, rows, **how) == plain(rows, **how)


def test_slices_and_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 200)
    rows = corpus(8, 80)
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == plain(rows)


def test_windows_stay_in_pieces_and_documents():
    column = pa.array(["a b c. d", "", "e", None, "f\tg"])
    w, own, cut = phrases._words(column)
    code, columns, n = phrases._windows(column, pa.array([0, 0, 0, 1, 1]).to_numpy(), 3)
    a, b, c, d, e, f, g = own.tolist()
    assert sorted(zip(code.tolist(), *(x.tolist() for x in columns), n.tolist(), strict=True)) == sorted(
        [(0, a, b, c, 1), (0, b, c, 0, 1), (0, c, 0, 0, 1), (0, d, 0, 0, 1), (0, e, 0, 0, 1), (1, f, g, 0, 1), (1, g, 0, 0, 1)])


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 99_999_999_999_977, 99_999_999_999_989, 99_999_999_999_981
    got = spark.range(1).select(phrases._exact_score(F.lit(a), F.lit(left), F.lit(right)).alias("x")).first().x
    assert got == 10 ** 6 * a * a // (left * right)


def test_two_words_with_one_hash_fail(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two", "en")], DOCS)
    needed = spark.createDataFrame([(7,)], "word long")
    real = phrases._words

    def clash(column):
        w, own, cut = real(column)
        own[:] = 7
        return w, own, cut

    monkeypatch.setattr(phrases, "_words", clash)
    with pytest.raises(Exception, match="share a hash"):
        phrases.spelled(docs, "text", needed).collect()


def test_defined_cases(spark):
    assert found(spark, []) == [] == found(spark, [(1, None, None), (2, "", "en"), (None, " . ", "de")])
    rows = [(None, "New York. ", "en")] * 12 + [(1, "x y " * 50_000, None), (2, None, "en"), (3, "tie a, tie b, " * 10, "")]
    clash = [(*r, 1, "x", 2, 3) for r in rows]
    assert found(spark, clash, DOCS + ", w1 int, n string, level int, score int") == plain(rows)
    assert [r[2] for r in found(spark, rows) if r[0] == ""] == ["tie a", "tie b"]
