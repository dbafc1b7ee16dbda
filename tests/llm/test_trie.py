"""Prefix trie against a plain trie, and its defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from headroom.llm import trie

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows, block=20, heads=4):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[c].append(((t is not None, t or 0), key, len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    for turns in own.values():
        turns.sort()
    members, words = defaultdict(list), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        turns = own.get(c - int(math.fmod(c, block)), [])[:h] + turns[h:]
        path = tuple(t[1] for t in turns)
        for d in range(len(path) + 1):
            members[path[:d]].append((c, d == len(path)))
            words[path[:d]] = turns[d - 1][2] if d else 0
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * words[p]
    return sorted(((min(m)[0], len(p), min(members[p[:-1]])[0] if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c, e in sorted(m) if e).encode()).hexdigest())
                   for p, m in members.items()), key=repr)


def found(spark, rows, **how):
    return sorted(map(tuple, trie.prefix_trie(spark.createDataFrame(rows, TURNS), **how).collect()), key=repr)


def conversations(seed, n, longest):
    """Conversations that share beginnings, with long common paths and whole copies."""
    rng = random.Random(seed)
    stems = [[rng.choice("ab") for _ in range(longest)] for _ in range(3)]
    rows = []
    for c in range(n):
        stem = stems[min(rng.randrange(4), 2)]
        cut = rng.choice([0, 1, 2, longest // 2, longest, longest])
        texts = stem[:cut] + [rng.choice("xyz") * rng.randint(0, 2) for _ in range(rng.randrange(3))]
        rows += [(c, t, ("user", "assistant")[t % 2], f"{x} words {t}") for t, x in enumerate(texts)]
    return rows


@pytest.mark.parametrize("how", [{}, {"width": 2, "shards": 7}, {"width": 3, "shards": 1}, {"width": 64, "shards": 13}])
def test_equals_a_plain_trie(spark, how):
    rows = conversations(5, 150, 9)
    assert found(spark, rows, **how) == plain(rows)


def test_one_path_over_many_shards(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(120) for t in range(6)]
    assert found(spark, rows, shards=9) == plain(rows)
    assert found(spark, rows, shards=9, width=2) == plain(rows)


def test_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 4)
    rows = [(c, t, "user", f"same {t}") for c in range(90) for t in range(1 + c % 3)]
    assert found(spark, rows, shards=5) == plain(rows)


def test_defined_cases(spark):
    rows = [(20, 1, "user", "a"), (20, None, None, None), (20, 0, "user", "b"), (20, 0, "user", "b"),  # null turn first, a tie, a repeat
            (None, 0, "user", "lost"), (21, 0, "user", "a"), (22, 0, None, "a"), (23, 0, "", "a"),       # null id, null and empty role
            (47, 0, "user", "gone"), (48, 0, "user", "  \t\n"), (49, 5, "us", "era"), (50, 5, "user", "a"),  # absent start conversation
            (-3, 0, "user", "a"), (-20, 0, "user", "a"), (-21, 0, "user", "z"), (61, 0, "user", "x" * 300_000)]
    assert any(h for c in (47, 48, 49) if (h := zlib.crc32(str(c).encode()) % 4))
    assert found(spark, rows, shards=3) == plain(rows)
    assert found(spark, rows[4:5]) == [] == found(spark, [])
    clash = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], TURNS + ", base int, conv int, ids string, open string")
    assert sorted(map(tuple, trie.prefix_trie(clash).collect()), key=repr) == plain(rows)
    renamed = spark.createDataFrame(rows, "c long, turn long, role string, text string")
    assert sorted(map(tuple, trie.prefix_trie(renamed, conv="c").collect()), key=repr) == plain(rows)
