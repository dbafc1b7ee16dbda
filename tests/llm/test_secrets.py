"""Secret scan: base spans against plain regular expressions, planted random tokens, and the defined cases."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from headroom.llm import secrets, text
from tests.llm.test_operators import prose

DOCS = "doc_id long, text string"
PATTERNS = {
    "assign": r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def plain(t):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, t or ""):
            if len(m.group(2) if kind == "assign" else m.group()) >= (12, 18, 16)[k]:
                out.append((m.start(), k, m.end()))
    return [(list(PATTERNS)[k], a, b) for a, k, b in sorted(out)]


def token(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


HARD = [
    "token=password:abcdefghijklmnop", "TOKEN = \"abcdefghijkl", "apikey:abcdefghijk", "api_key'  =  'a.b-c_d+e/f==g", "é" * 7 + "passwd=ÀÀ secret=0123456789ab",
    "toKen=abcdefghijklm ſecret=abcdefghijklm", "token==" + "x" * 12, "AKIA" + "A" * 13, "AKIA" + "B" * 14, "xxAKIAAKIA" + "C" * 14, "AKIAéAKIA" + "9" * 14 + "z",
    "0123456789abcdef0", "0123456789abcde", "g0123456789abcdefg", "password=" + "ab12" * 6, "secret=AKIA" + "Z" * 20, "日本token=abcdefghijkl日本 deadbeefdeadbeef",
    "token = \n abcdefghijklmnop", "token=abcdefghijkl token=abcdefghijkl", "", None, " ", ":", "=" * 50]


def test_base_spans_equal_plain_expressions(spark):
    rng = random.Random(4)
    pieces = ["password", "Token", "api_key", "=", ":", "\"", " ", "AKIA", "A9Z" * 5, "0af" * 6, "é", "xyz-_.", "\n"]
    texts = HARD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(300)]
    got = {r.doc: r for r in secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert [tuple(x) for x in got[i].base] == plain(t), t
        assert [x for x in got[i].spans if x.kind in PATTERNS] == list(got[i].base)


@pytest.mark.parametrize("kind", [k for k in secrets.ENCODINGS if k not in ("random_lower", "random_hex", "random_base32")])
def test_random_tokens_are_found_and_prose_is_not(spark, kind):
    rng = random.Random(kind)
    rows = [(i, prose(i, 300) + " " + " ".join("".join(prose(i + j, 5).split()) for j in range(3))) for i in range(200)]
    planted = {i: token(rng, secrets.ENCODINGS[kind], 40) for i in range(0, 200, 5)}
    rows = [(i, t + (" " + planted[i] + " é" if i in planted else "")) for i, t in rows]
    found = {r.doc: [t[x.start:x.stop] for x in r.spans] for r, t in
             ((r, rows[r.doc][1]) for r in secrets.find_secrets(spark.createDataFrame(rows, DOCS)).collect())}
    assert sum(planted[i] in found[i] for i in planted) >= 0.9 * len(planted)
    assert sum(bool(found[i]) for i in found if i not in planted) <= 1


def words_null():
    column = pa.array([prose(i, 2000, "etaoinshrdlueeettaaooinn") for i in range(20)])
    return secrets.WordNull(secrets.pair_counts(*text.utf8(column)))


def test_battery_on_random_and_on_repeating_tokens():
    rng, null = random.Random(2), words_null()
    for name, alphabet in secrets.ENCODINGS.items():
        data, bounds = text.utf8(pa.array([token(rng, alphabet, 48) for _ in range(400)]))
        kind, p, uniform = secrets.battery(data, bounds[:-1], bounds[1:], null)
        assert uniform.mean() > 0.95, name
        assert np.median(p) < 1e-2, name
        repeated = [t[:4] * 12 for t in (token(rng, alphabet, 4) for _ in range(400))]
        data, bounds = text.utf8(pa.array(repeated))
        assert secrets.battery(data, bounds[:-1], bounds[1:], null)[2].mean() < 0.05, name


def test_battery_in_chunks(monkeypatch):
    rng, null = random.Random(2), words_null()
    data, bounds = text.utf8(pa.array([token(rng, secrets.ENCODINGS["random_base62"], rng.randint(16, 90)) for _ in range(50)]))
    whole = secrets.battery(data, bounds[:-1], bounds[1:], null)
    monkeypatch.setattr(secrets, "TOKENS", 7)
    for a, b in zip(whole, secrets.battery(data, bounds[:-1], bounds[1:], null), strict=True):
        assert (a == b).all()


def test_benjamini_hochberg_by_length_class(spark):
    steps = [(0, 1, h, p) for h, p in enumerate([250, 210, 130, 10, 0, 0, 0, 0])] + [(0, 2, 1, 150)]
    rows = [(i, [(3 + k, 0, 9, h, size, p)] * 2) for i, (k, size, h, p) in enumerate(steps)]  # a repeated token is one hypothesis
    found = spark.createDataFrame(rows, f"doc long, tokens {secrets._TOKENS}")
    got = {(r.kind, r["size"]): r.least for r in secrets.discoveries(found, 0.05).collect()}

    def plain_limit(ps):
        ps = sorted(ps, reverse=True)
        passed = [p for i, p in enumerate(ps) if p > 0 and 10 ** (-p / 100) <= 0.05 * (i + 1) / len(ps)]
        return min(passed) if passed else None

    assert got == {(3, 1): plain_limit([250, 210, 130, 10, 0, 0, 0, 0]), (3, 2): plain_limit([150])}


def test_defined_cases(spark):
    assert secrets.find_secrets(spark.createDataFrame([], DOCS)).collect() == []
    long = "a b " * 300_000 + "token=" + "q" * 20
    rows = [(None, "token=abcdefghijkl", "x", 1), (1, None, "x", 2), (1, "token=abcdefghijkl", "x", 1), (1, "token=abcdefghijkl", "x", 1), (2, long, "x", 3), (3, "4" * 40, "", 0)]
    docs = spark.createDataFrame(rows, DOCS + ", tokens string, base int")
    got = secrets.find_secrets(docs).collect()
    assert sorted((str(r.doc), len(r.base), len(r.spans)) for r in got) == [("1", 0, 0), ("1", 1, 1), ("1", 1, 1), ("2", 1, 1), ("3", 1, 1), ("None", 1, 1)]
    assert [tuple(x) for r in got if r.doc == 2 for x in r.base] == [("assign", 1_200_000, 1_200_026)]


def test_query_columns(spark):
    from headroom.llm.text import table
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    got = secrets.op11_secrets(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for k, _, _ in want) for kind in PATTERNS]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == [x for x in line.split(",") if x]
