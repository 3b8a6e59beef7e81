import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward_documents, empty_like, frame, prose
from pyspark.sql import functions as F

from kiln.llm import phrases as P


def plain(docs, min_count, top):
    """The contract in plain Python; ``docs`` are (lang, text)."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        f = {p: n for p, n in f.items() if n >= min_count}
        scored, longest = [], {}
        for q, n in f.items():
            for k in range(2, len(q)):
                for part in (q[i:i + k] for i in range(len(q) - k + 1)):
                    longest[part] = max(n, longest.get(part, 0))
        for p, a in f.items():
            if len(p) < 2:
                continue
            score, k, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if 100 * longest.get(p, 0) < 80 * a:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, totals[lang], -score)
                for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = [prose(seed * 100 + k, 1) for k in range(25)] + ["É", "ü\x0bx", "a\x00b", "A", "|"]
    fixed = [" ".join(r.choices(vocabulary, k=r.randrange(2, 6))) for _ in range(8)]
    out = []
    for _ in range(n):
        words = [r.choice(fixed) if r.random() < 0.3 else r.choice(vocabulary) + r.choice(["", "", ",", ". ", "\n", " \t"])
                 for _ in range(r.randrange(40))]
        out.append((r.choice(["en", "de", None, "und", ""]), " ".join(words)))
    return out


def test_intervals_count_every_phrase():
    r = np.random.default_rng(1)
    symbols = r.integers(0, 6, 3000).astype(np.int32)
    symbols[0] = symbols[-1] = 0
    symbols = symbols[np.concatenate(([True], (symbols[1:] > 0) | (symbols[:-1] > 0)))]
    index = P.BiIndex.build(symbols)
    want = Counter()
    for k in range(1, 5):
        want.update(g for g in zip(*(symbols[j:len(symbols) - k + 1 + j].tolist() for j in range(k))) if 0 not in g)
    for sides in (("right",) * 3, ("left",) * 3, ("right", "left", "right"), ("left", "right", "left"), ("right", "right", "left")):
        at = index.words()
        grams = [(int(w),) for w in at["word"]]
        got = dict(zip(grams, at["n"].tolist()))
        for side in sides:
            at = index.extend(at, side)
            grams = [(*grams[p], int(w)) if side == "right" else (int(w), *grams[p]) for p, w in zip(at["parent"], at["word"])]
            assert len(set(grams)) == len(grams)
            got.update(zip(grams, at["n"].tolist()))
        assert got == dict(want)


@pytest.mark.parametrize("shard_words, small", [(1 << 21, 500_000), (400, 0)])
def test_phrases_match_brute_force(spark, monkeypatch, shard_words, small):
    """One shard, and many shards with shuffled instead of broadcast joins."""
    monkeypatch.setattr(P, "SMALL", small)
    monkeypatch.setattr(P, "RANGE_WORDS", max(300, small))
    docs = texts(3, 250) + [("en", "same words here again " * 50)] * 20
    rows = frame(spark, docs, "lang string, text string").repartition(4)
    got = P.mine_phrases(rows, min_count=6, top=40, shard_words=shard_words).collect()
    assert sorted(tuple(r) for r in got) == plain(docs, 6, 40) and len(got) > 60


def test_awkward_documents(spark):
    docs = awkward_documents(spark)
    many = docs.unionByName(docs).unionByName(docs).withColumn("phrase", F.lit("x")).withColumn("rank", F.lit(1))
    got = P.mine_phrases(many, min_count=3, top=500).collect()
    assert sorted(tuple(r) for r in got) == plain([(r.lang, r.text) for r in many.collect()], 3, 500)
    assert P.mine_phrases(empty_like(docs)).collect() == []
    assert P.mine_phrases(frame(spark, [("en", None), ("en", " ., "), (None, "")], "lang string, text string"), min_count=1).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000_000_000
    rows = [("en", "a", 1, big + 1), ("en", "b", 1, big), ("en", "a b", 2, big - 1), ("en", "a b c", 3, big // 5 * 4),
            ("en", "c", 1, big), ("en", "b c", 2, big - 2)]
    known = frame(spark, rows, "lang string, phrase string, size int, f long")
    got = {r.phrase: r for r in P.scored(known).collect()}
    assert got["a b"].score == 2_000_000 * (big - 1) // (2 * big + 1) == 999_999
    assert got["a b c"].score == min(2_000_000 * (big // 5 * 4) // (x + y) for x, y in ((big + 1, big - 2), (big - 1, big)))
    assert {r.phrase for r in P.not_contained(P.scored(known), known).collect()} == {"a b c"}
    rows[3] = ("en", "a b c", 3, (80 * (big - 1) + 99) // 100 - 1)  # a hair below 80 per cent of "a b"
    known = frame(spark, rows, "lang string, phrase string, size int, f long")
    assert "a b" in {r.phrase for r in P.not_contained(P.scored(known), known).collect()}
