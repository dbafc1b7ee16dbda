"""Each operator against a plain version, and its defined cases: nulls, empty tables, ties, repeats, clashing names."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from headroom.llm import ann, brown, decontam, html, langid, mixing, quality, setjoin, text, toxicity, warc
from headroom.session import fresh_path

LATIN = "abcdefghijklmnopqrstuvwxyz"


def prose(seed: int, n: int = 60, letters: str = LATIN) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


DOCS = "doc_id long, text string, lang string, source string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# ---- text ----

@pytest.mark.parametrize("keep", [text.SPACED, text.ALNUM])
def test_words_split_like_a_regular_expression(keep):
    import re
    pattern = rb"[^\x20\x09-\x0D]+" if keep is text.SPACED else rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    texts = ["", None, "a", " A  b\tÜber c-d\n", "x" * 600_000 + " y", "Çé ñ!?", "end "]
    w = text.words(pa.array(texts), keep)
    for i, t in enumerate(texts):
        want = re.findall(pattern, (t or "").encode().lower())
        got = [bytes(w.data[a:b]) for a, b in zip(w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]], strict=True)]
        assert got == want
    again = text.words(pa.array(["y b A", "y"]), keep)
    assert again.hash[0] == again.hash[3] and len(set(again.hash.tolist())) == 3
    assert w.hash[w.first[4] + 1] == again.hash[0]


# ---- language ID ----

def test_codewords_differ_in_many_bits():
    for n in (2, 4, 6, 12):
        code = langid.codewords(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= max(1, code.shape[1] // 4)


def test_language_id(spark):
    rows = [(i, prose(i, 80, "abcde"), "xx", None) for i in range(40)] + [(100 + i, prose(i, 80, "vwxyz"), "yy", None) for i in range(40)]
    rows += [(200, None, None, None), (201, "", "xx", None), (202, "12 34 !", None, None), (None, prose(3, 50, "abcde"), None, None), (0, rows[0][1], "xx", None)]
    docs = frame(spark, rows).selectExpr("*", "1 as score", "2 as result")
    model = langid.train(docs)
    found, name = langid.identify(docs, model)
    got = found.select("doc_id", "lang", "result", f"{name}.*").collect()
    assert len(got) == len(rows) and all(r.result == 2 for r in got)
    for r in got:
        if r.doc_id in (200, 201, 202):
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, False)
        elif r.lang:
            assert r.lang_pred == r.lang and 0 <= r.score <= 1
    empty = docs.limit(0)
    found, name = langid.identify(docs, langid.train(empty))
    assert {r[0] for r in found.select(f"{name}.lang_pred").collect()} == {"und"}
    assert langid.accept(empty).count() == 0


# ---- Brown classes ----

def test_brown_scores_are_a_distribution_and_base_matches(spark):
    rows = [(i, prose(i % 7, 40) + " the cat sat", None, None) for i in range(20)] + [(50, None, None, None), (51, "Unseen zzzz\tTHE", None, None), (51, "Unseen zzzz\tTHE", None, None), (None, "the cat", None, None)]
    docs = frame(spark, rows)
    model = brown.train(docs.filter("doc_id < 50"))
    train = Counter(w for i, t, *_ in rows if i is not None and i < 50 for w in brown.tokens(t))
    total, kinds = sum(train.values()), len(train)
    assert (model.tokens, model.words) == (total, kinds)
    assert np.allclose(model.transition.sum(axis=1), 1)
    words = {bytes(r.word): (r.n, r["class"]) for r in model.vocabulary.collect()}
    assert {w: n for w, (n, _) in words.items()} == dict(train)
    got = brown.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        own = {brown.tokens(t).__len__() for i, t, *_ in rows if i == r.doc}
        assert r.n_tokens in own
    for i, t, *_ in rows:
        base = sum(math.log10((train[w] + 1) / (total + kinds + 1)) for w in brown.tokens(t))
        known = sum(train[w] > 0 for w in brown.tokens(t))
        assert any(r.doc == i and abs(r.base_score - base) < 1e-9 and r.n_known == known for r in got)
    # every context: known words and one unseen add up to 1
    for c in range(brown.CLASSES + 2):
        p = sum(brown.LAMBDA * model.transition[c, k] * n / model.class_tokens[k] + (1 - brown.LAMBDA) * (n + 1) / (total + kinds + 1) for n, k in words.values())
        p += brown.LAMBDA * model.transition[c, brown.CLASSES + 1] + (1 - brown.LAMBDA) / (total + kinds + 1)
        assert abs(p - 1) < 1e-9


def test_words_beyond_the_head_score_the_same(spark, monkeypatch):
    docs = frame(spark, [(i, prose(i % 5, 60), None, None) for i in range(12)])
    model = brown.train(docs)
    whole = {r.doc: r.score for r in brown.score(docs, model).collect()}
    core = [w for w in model.head][:1000]
    few = model._replace(head={w: i for i, w in enumerate(core[:50])}, head_n=model.head_n[:50], head_class=model.head_class[:50])
    short = brown.score(docs, few).collect()
    assert {r.doc for r in short} == set(whole) and all(r.n_known == r.n_tokens for r in short)
    assert brown.train(docs.limit(0)).tokens == 0
    assert {r.score for r in brown.score(docs, brown.train(docs.limit(0))).select("score").collect()} is not None


def test_the_head_never_changes_a_score(spark):
    docs = frame(spark, [(i, prose(i % 5, 60) + " unseen" * (i % 3), None, None) for i in range(12)] + [(3, None, None, None), (4, prose(4, 60) + " unseen", None, None)])
    model = brown.train(docs.filter("doc_id < 10 and text not like '%unseen'"))
    whole = sorted((r.doc, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in brown.score(docs, model).collect())
    words = {bytes(r.word): (r.n, r["class"]) for r in model.vocabulary.collect()}
    for size in (50, 0):
        few = model._replace(head=dict(list(model.head.items())[:size]), head_n=model.head_n[:size], head_class=model.head_class[:size])
        assert sorted((r.doc, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in brown.score(docs, few).collect()) == whole
    text = brown.tokens(prose(2, 60) + " unseen unseen")
    of = [brown.CLASSES, *[words.get(w, (0, brown.CLASSES + 1))[1] for w in text]]
    plain = 0.0
    for w, a, b in zip(text, of, of[1:], strict=False):
        n = words.get(w, (0, 0))[0]
        plain += math.log10(brown.LAMBDA * model.transition[a, b] * (n / model.class_tokens[b] if n else 1) + (1 - brown.LAMBDA) * (n + 1) / (model.tokens + model.words + 1))
    assert (2, round(plain, 6)) in {(r[0], r[4]) for r in whole}


def test_transitions_count_all_bigrams(spark, monkeypatch):
    monkeypatch.setattr(brown, "CORE", 8)
    rows = [(i, prose(i % 9, 40, "abcd") + f" the{i} cat", None, None) for i in range(24)] + [(90, None, None, None)]
    docs, models = frame(spark, rows), []
    for head in (1 << 17, 12):
        monkeypatch.setattr(brown, "HEAD", head)
        models.append(brown.train(docs))
        own = {bytes(r.word): r["class"] for r in models[-1].vocabulary.collect()}
        moves = np.zeros((brown.CLASSES + 2, brown.CLASSES + 2))
        for _, t, *_ in rows:
            line = [brown.END, *brown.tokens(t)]
            for a, b in zip(line, line[1:], strict=False):
                moves[own[a], own[b]] += 1
        share = moves.sum(axis=0) / moves.sum()
        total = Counter(w for _, t, *_ in rows for w in brown.tokens(t))
        new = max(1, sum(n == 1 for n in total.values())) / (sum(total.values()) + 1)
        want = (moves + brown.SMOOTH * share) / (moves.sum(axis=1, keepdims=True) + brown.SMOOTH) * (1 - new)
        want[:, brown.CLASSES + 1] = new
        assert np.allclose(models[-1].transition, want)
    assert {bytes(r.word): r["class"] for r in models[0].vocabulary.collect()} == own


def test_exchange_finds_word_classes():
    rng = np.random.default_rng(1)
    own = np.arange(30) % 3
    pairs = np.zeros((31, 31))
    for _ in range(20_000):
        a = rng.integers(30)
        b = rng.choice(np.flatnonzero(own == (own[a] + 1) % 3))
        pairs[a, b] += 1
    found = brown.exchange(pairs, 30, classes=3, rounds=20)
    assert found[30] == 3
    assert all(len(set(found[:30][own == k])) == 1 for k in range(3))


# ---- toxicity ----

def test_toxicity_learns_words_and_handles_odd_rows(spark):
    rng = random.Random(2)
    rows = []
    for i in range(240):
        words = prose(i, 40).split()
        bad = i % 4 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["viletype", "vileform", "rotten"]))
        rows.append((i, " ".join(words), int(bad)))
    rows += [(900, None, 0), (901, "", None), (902, "...", 0), (0, rows[0][1], 1)]
    docs = frame(spark, rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs)
    found, name = toxicity.classify(docs.select("doc_id", "text", "toxic"), model)
    got = found.select("toxic", f"{name}.score").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    right = [(r.score >= 0.5) == bool(r.toxic) for r in got if r.toxic is not None]
    assert sum(right) > 0.97 * len(right)
    one = toxicity.train(docs.filter("toxic = 0"))
    found, name = toxicity.classify(docs, one)
    assert {r[0] for r in found.select(f"{name}.score").collect()} == {0.0}
    assert toxicity.train(docs.limit(0)).share == 0.5


# ---- WARC ----

def test_warc_round_trip_revisits_and_push_down(spark):
    big, small = "é" * 900, "s" * 10
    rows = [(1, "http://a/\r\nx", big), (2, None, big), (3, "u", small), (4, "u", small), (None, "u", big), (5, "u", None), (6, "u", "")]
    pages = frame(spark, rows, "page_id long, url string, html string")
    path = fresh_path(spark, "warc-test")
    warc.archive(pages, path)
    got = {r.record_id: r for r in spark.read.format("warc").load(path).collect()}
    assert len(got) == len(rows)
    assert bytes(got["<urn:page:2>"].payload).decode() == big and got["<urn:page:2>"].record_type == "response"
    for page in ("<urn:page:1>", "<urn:page:>"):
        assert (got[page].record_type, got[page].refers_to, got[page].payload_bytes) == ("revisit", "<urn:page:2>", 1800)
    assert got["<urn:page:1>"].target_uri == "http://a/%0D%0Ax" and got["<urn:page:2>"].target_uri is None
    assert {got[f"<urn:page:{i}>"].record_type for i in (3, 4, 5, 6)} == {"response"}
    assert got["<urn:page:5>"].payload_digest == "sha1:" + hashlib.sha1(b"").hexdigest()
    only = spark.read.format("warc").load(path).filter("record_type = 'revisit'")
    assert only.count() == 2
    heads = spark.read.format("warc").option("payload", "false").load(path)
    assert "payload" not in heads.columns and heads.count() == len(rows)
    empty = fresh_path(spark, "warc-empty")
    warc.archive(pages.limit(0), empty)
    assert spark.read.format("warc").load(empty).count() == 0


def test_warc_reads_plain_and_foreign_gzip(spark, tmp_path):
    import gzip
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "plain.warc").write_bytes(record % 1 + record % 2)
    (tmp_path / "packed.warc.gz").write_bytes(gzip.compress(record % 3) + gzip.compress(record % 4))
    warc.register(spark)
    got = spark.read.format("warc").load(str(tmp_path)).collect()
    assert sorted(r.record_id for r in got) == [f"<urn:x:{i}>" for i in (1, 2, 3, 4)]
    assert {bytes(r.payload) for r in got} == {b"hello"}
    kept = spark.read.format("warc").load(str(tmp_path)).filter("record_id = '<urn:x:4>'").collect()
    assert [bytes(r.payload) for r in kept] == [b"hello"]


# ---- main text ----

PAGE = ("<html><head><title>t</title><script>var x='</p>'</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><header><h1>Site</h1></header>"
        "<div class='cookie-notice'>We use cookies</div><div class=\"ad\">buy</div><{box}><h1>Head &amp; line</h1><p>First  <b>bold</b> text\n of it.<p>Second<br>line &copy;"
        "<form>send <input></form><aside>more</aside><ul><li>item one<li>item two</ul></{end}><section id=comments><p>nice post</p></section><footer>foot</footer></body></html>")
TEXT = "Head & line\n\nFirst bold text of it.\n\nSecond line ©\n\nitem one\n\nitem two"


def test_main_text(spark):
    article = PAGE.format(box="article", end="article")
    div = PAGE.format(box="div class='post p12'", end="div")
    short = "<body><nav>menu</nav><div class='post p7'><p>Tiny</p></div><div>much longer text that is not the article at all, on this one page</div></body>"
    rows = [(1, "http://h/1", article), (2, "http://d/1", div), (3, "http://d/2", div), (4, "http://d/3", short), (5, None, None), (6, "x", ""), (7, "http://h/2", article[:article.index("Second") + 3] + "<a hre"), (1, "http://h/1", article)]
    pages = frame(spark, rows, "page_id long, url string, html string").selectExpr("*", "'c' as main", "'k' as host", "1 as paths")
    found, name = html.main_text(pages)
    got = [(r.page_id, r.text, r.n_chars) for r in found.select("page_id", f"{name}.*").collect()]
    assert sorted(got) == sorted([(1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, TEXT, len(TEXT)), (3, TEXT, len(TEXT)), (4, "Tiny", 4), (5, "", 0), (6, "", 0),
                                  (7, "Head & line\n\nFirst bold text of it.\n\nSec", 40)])
    assert found.select("main", "host", "paths").distinct().collect() == [("c", "k", 1)]
    assert html.main_text(pages.limit(0))[0].count() == 0


def test_all_voted_paths_of_a_host_count(spark):
    running = "The running text of this page goes on for a while, line after line."
    page = "<body><div class={box}><div class=story><p>{text}</p></div>{more}</div><div class=other><p>Short words below.</p></div></body>"
    kinds = [chr(97 + k) for k in range(12)]
    rows = [(100 * k + i, "http://h/x", page.format(box=b, text=f"{running} {i}", more="")) for k, b in enumerate(kinds) for i in range(5)]
    # most of this page's running text is beside the story that the host's pages chose; box a is there without text
    rows += [(5000, "http://h/y", page.format(box="c", text="Only this is the story.", more=f"<div class=talk><p>{running * 2}</p></div>").replace("<body>", "<body><div class=a><div class=story><p><a href=/>all of it link</a></p></div></div>"))]
    found, name = html.main_text(frame(spark, rows, "page_id long, url string, html string"))
    got = {r.page_id: r.text for r in found.select("page_id", f"{name}.text").collect()}
    assert got == {i: "Only this is the story." if i == 5000 else f"{running} {i % 100}" for i, *_ in rows}


def test_links_and_attribute_values_are_text():
    odd = ['a href="/hidden-gems"', 'a title="a hidden cost"', 'div aria-hidden="false"', 'div data-id="related"', "a href=/p?id=share", "div data-class='menu' title='style=\"display:none\"'"]
    parts = "".join(f"<p>Part {i} with <{x}>words {i}</{x.split()[0]}></p>" for i, x in enumerate(odd))
    page = f"<body><article><p>A long first line of running text.</p>{parts}<ul><li><a href=/s>Source one</a><li><a href=/t>Source two</a></ul><div hidden>gone</div><div style='display: none'>gone</div><ul class=menu><li><a>gone</a></ul></article></body>"
    text = html.extract(page, [])
    assert all(f"words {i}" in text for i in range(len(odd)))
    assert text.endswith("Source one\n\nSource two") and "gone" not in text


def test_unclosed_quotes_do_not_hang():
    assert html.extract("<p>a</p><a href=\"" + "x='" * 5000 + "<p>b", []) is not None


# ---- Jaccard join ----

def brute_components(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((repr(d), len(s), repr(least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize(("k", "percent", "leaders", "block"), [(4, 85, (1, 4, 8), 256), (5, 80, (1,), 4)])
def test_components_equal_brute_force(spark, monkeypatch, k, percent, leaders, block):
    monkeypatch.setattr(setjoin, "LEADERS", leaders)
    monkeypatch.setattr(setjoin, "BLOCK", block)
    monkeypatch.setattr(setjoin, "LARGE", 3)
    rng = random.Random(5)
    rows = []
    for g in range(12):
        base = prose(g, 70).split()
        for _ in range(14 if g else 40):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                own[rng.randrange(len(own))] = prose(rng.random(), 1)
            rows.append((len(rows), " ".join(own[:rng.choice([70, 70, 66, 60])])))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One\tTWO"), (905, "one"), (5, rows[5][1]), (5, rows[5][1]), (None, rows[7][1]), (None, "alone here now then so")]
    got = setjoin.similar_components(frame(spark, rows, "doc_id long, text string"), k=k, percent=percent)
    assert sorted((repr(r.doc), r.n_shingles, repr(r.component)) for r in got.collect()) == brute_components(rows, k, percent)


def test_keep_one_per_component(spark):
    base = prose(1, 80)
    rows = [(3, base, "a", "s"), (2, base + " tail", "a", "s"), (2, base + " tail", "a", "s"), (9, prose(2, 50), None, None), (10, None, None, None), (None, base, None, None)]
    docs = frame(spark, rows).selectExpr("*", "7 as root", "8 as n")
    got = setjoin.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 9, 10]
    assert setjoin.keep_one(docs.limit(0)).count() == 0


# ---- mixing ----

def test_topics_are_fitted_on_all_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TOPIC_ROWS", 60)
    rows = [(i, prose(i, 40, ["abcd", "klmn", "wxyz"][i % 3]), None, None) for i in range(500)] + [(i, "same old text again", None, None) for i in range(500, 700)] + [(900, None, None, None)]
    docs = frame(spark, rows)
    found = mixing.fit_topics(docs, len(rows))
    monkeypatch.setattr(mixing, "TOPIC_ROUNDS", 0)
    centre = mixing.fit_topics(docs, len(rows))
    x = mixing._vectors(pa.array([t for _, t, *_ in rows if t]))[0]
    for _ in range(12):
        own = (x @ centre.T).argmax(axis=1)
        new = np.stack([x[own == k].sum(axis=0) if (own == k).any() else centre[k] for k in range(len(centre))])
        centre = new / np.linalg.norm(new, axis=1, keepdims=True)
    assert found.shape == centre.shape and np.allclose(found, centre, atol=1e-4)


def test_raking_meets_the_targets_and_probabilities_the_budget(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.randint(5, 60), "abcde" if i % 3 else "vwxyz"), rng.choice(["en", "en", "de", None]), rng.choice(["s1"] * 6 + ["s2", None])) for i in range(400)]
    rows += [(500, None, "en", "s1"), (501, "", "de", "s2"), (1, *rows[1][1:])]
    docs = frame(spark, rows).selectExpr("*", "5 as weight", "6 as result")
    found, name = mixing.mix(docs, targets={"lang": {"en": 0.2}}, budget=0.3)
    got = found.select("doc_id", "lang", "source", "result", f"{name}.*").toPandas()
    assert len(got) == len(rows) and (got.result == 6).all()
    mass = got.n_tokens * got.probability * got.loss_weight
    share = mass.groupby(got.lang.fillna("unknown")).sum() / mass.sum()
    assert abs(share["en"] - 0.2) < 2e-3
    tokens = got.n_tokens.groupby(got.source.fillna("unknown")).sum()
    want = tokens ** mixing.FLATTEN / (tokens ** mixing.FLATTEN).sum()
    assert (abs(mass.groupby(got.source.fillna("unknown")).sum() / mass.sum() - want) < 2e-3).all()
    assert abs((got.n_tokens * got.probability).sum() - 0.3 * got.n_tokens.sum()) < 0.01 * got.n_tokens.sum()
    assert got[got.doc_id == 1].sampled.nunique() == 1
    again = mixing.mix(docs, targets={"lang": {"en": 0.2}}, budget=0.3)
    assert again[0].select("doc_id", f"{again[1]}.sampled").toPandas().sampled.sum() == got.sampled.sum()
    assert mixing.sample(docs.limit(0)).count() == 0


# ---- quality ----

def test_quality_rejects_what_labellers_agree_on(spark):
    good = [(i, ". ".join(prose(i * 9 + j, 12) for j in range(4)) + ".", None, None) for i in range(150)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 50).split()), None, None) for i in range(20)]
    bad += [(2000 + i, " ".join(w + "%%%" for w in prose(i, 50).split()), None, None) for i in range(20)]
    odd = [(3000, None, None, None), (3001, "", None, None), (3002, "x", None, None)]
    docs = frame(spark, good + bad + odd).selectExpr("*", "0.5D as score", "true as good")
    found, name = quality.classify(docs, quality.train(docs))
    got = {r.doc_id: r.good for r in found.select("doc_id", f"{name}.good").collect()}
    assert len(got) == 193
    assert sum(got[i] for i, *_ in good) >= 148 and sum(got[i] for i, *_ in bad) <= 2
    assert quality.accept(docs).columns == docs.columns
    assert quality.accept(docs.limit(0)).count() == 0


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.8
    right = rng.random((20_000, len(quality.LABELLERS))) < np.where(truth, 0.98, 0.7)[:, None]
    vote = np.where(right == truth[:, None], 2, 1)
    pattern, count = np.unique(vote @ 3 ** np.arange(len(quality.LABELLERS)), return_counts=True)
    _, accuracy, share = quality.expectation_maximisation(pattern, count.astype(float))
    assert abs(share - 0.8) < 0.02
    assert np.allclose(accuracy[1, :, 2], 0.98, atol=0.02) and np.allclose(accuracy[0, :, 1], 0.7, atol=0.05)


# ---- nearest neighbours ----

def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[40:200] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [1.0, None] * 8), (1080, [1.0]), (None, x[3].tolist()), (20, x[20].tolist())]
    df = frame(spark, rows, "vec_id long, embedding array<float>")
    got = ann.search(df, k=20, every=20).collect()
    y = x.astype(float)
    hits = 0
    for q in range(0, 600, 20):
        score = y @ y[q]
        best = [i for i in np.lexsort((np.arange(600), -np.round(score, 9))) if i != q][:20]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(abs(r.score - y[q] @ y[r.vec_id]) < 1e-9 for r in own)
        hits += len(set(best) & {r.vec_id for r in own})
        if 40 <= q < 200:
            assert [r.vec_id for r in own if 40 <= r.vec_id < 200] == [i for i in best if 40 <= i < 200]
    assert hits >= 0.95 * 30 * 20
    assert {r.query_id for r in got} == set(range(0, 600, 20))
    assert ann.search(df.limit(0)).count() == 0


# ---- decontamination ----

def test_decontamination_defined_cases(spark):
    item = prose(1, 30)
    words = item.split()
    rows = [(1, "x y " + " ".join(words[5:15]) + " z", "a", "s"), (2, " ".join(words[5:14]), "a", "s"), (3, None, None, None), (4, "", None, None), (5, "say hello, world now", None, None),
            (1, "x y " + " ".join(words[5:15]) + " z", "a", "s"), (None, item.upper(), None, None), (6, " ".join(words[:12] + ["q"] + words[10:20]), None, None)]
    bench = frame(spark, [(10, item), (9, "Hello World"), (8, None), (7, "!!"), (10, item)], "item_id long, text string")
    docs = frame(spark, rows).selectExpr("*", "1 as n_words", "2 as items")
    got = sorted((repr(r.doc), r.n_words, r.n_hit, r["items"]) for r in decontam.contamination(docs, bench).collect())
    assert got == sorted([("1", 13, 10, ["10"])] * 2 + [("2", 9, 0, []), ("3", 0, 0, []), ("4", 0, 0, []), ("5", 4, 2, ["9"]), ("None", 30, 30, ["10"]), ("6", 23, 22, ["10"])])
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert decontam.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontam.contamination(docs.limit(0), bench).count() == 0
