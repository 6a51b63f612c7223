import random
import re
from collections import Counter

import numpy as np
import pytest

from batchkit.llm import phrases

SCHEMA = "text string, lang string, f string, w0 string, rank long, n long"


def plain(docs, longest=3, least=10, absorbed=50, top=2000):
    f, totals = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(
                100 * b >= absorbed * a
                for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ):
                continue
            cuts = [(counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, k = min((1_000_000 * a * a // (x * y), k) for k, (x, y) in enumerate(cuts))
            rows.append((-score, -a, " ".join(p).encode(), *cuts[k]))
        for rank, (score, a, p, x, y) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, totals[lang], -score))
    return sorted(out)


def mined(spark, docs, **options):
    rows = [(t, l, "x", "y", 1, 2) for t, l in docs]
    return sorted(tuple(r) for r in phrases.mine(spark.createDataFrame(rows, SCHEMA), **options).collect())


def corpus(seed=3, size=300):
    rng = random.Random(seed)
    words = ["The", "of", "Ärger", "x-1", "b", "c d", "\x1c", "日本", "a"] + [f"v{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(None, "en"), ("", None), (". . ,", "en"), ("a", "")]
    for _ in range(size):
        parts = rng.choices(words, weights, k=rng.randint(1, 60))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b"]) for w in parts)
        docs.append((text, rng.choice(["en", "en", "de", None, ""])))
    return docs + [docs[-1]] * 20


@pytest.mark.parametrize("routing", [{}, {"rows_per_task": 30, "window": 500}])
def test_against_plain_counts(spark, routing):
    docs = corpus()
    assert mined(spark, docs, **routing) == plain(docs)


def test_longer_phrases_and_top(spark):
    docs = corpus(9, 120)
    options = {"longest": 4, "least": 4, "absorbed": 80, "top": 15}
    assert mined(spark, docs, rows_per_task=20, window=300, **options) == plain(docs, **options)


def test_hot_word_and_pair(spark):
    # a third of all words is one word; a quarter of all pairs is one pair
    docs = [(f"hot hot pair{i % 2} hot w{i % 50}", "en") for i in range(400)]
    docs += [(" ".join(["hot"] * 5000), "en")]
    got = mined(spark, docs, rows_per_task=5, window=100)
    assert got == plain(docs)


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), ("a b", "en")]) == []


@pytest.mark.parametrize("small", [1, 4, 64, 10_000])
@pytest.mark.parametrize("least", [1, 3])
def test_groups_of_the_sort(monkeypatch, least, small):
    monkeypatch.setattr(phrases, "SMALL", small)
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(3000):
        length = rng.integers(1, 4)
        rows.append([*rng.integers(1, 12, length), *[0] * (3 - length)])
    columns = [np.array(c, np.int32) for c in zip(*rows, strict=True)]
    weights = rng.integers(1, 3, len(rows))
    whole, starts = Counter(), Counter()
    for row, weight in zip(rows, weights.tolist(), strict=True):
        row = tuple(w for w in row if w)
        whole[row] += weight
        for m in range(1, min(len(row), 2) + 1):
            starts[row[:m]] += weight
    found = {True: {}, False: {}}
    for m, at, weight, final in phrases.equal_groups(columns, weights, least):
        for i, n in zip(at, weight.tolist(), strict=True):
            key = tuple(int(c[i]) for c in columns[:m])
            assert key not in found[final]
            found[final][key] = n
    assert found[True] == {k: n for k, n in whole.items() if n >= least}
    assert found[False] == {k: n for k, n in starts.items() if n >= least}
    assert not list(phrases.equal_groups([c[:0] for c in columns], weights[:0], 1))
