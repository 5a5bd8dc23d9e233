import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ODD, frame, prose
from tollgate.llm import ranked_search as op12

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(UPPER, UPPER.lower())))


def brute(docs, items, k=10):
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_words = sum(n > 0 for *_, n in own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in own:
            m = 25 + (75 * n * n_docs) // max(n_words, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, parts=3, **more):
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'y' AS score")
    got = op12.ranked_search(frame(spark, docs).repartition(parts), table, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(n=400, seed=2):
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randrange(1, 120)))) for i in range(n)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randrange(1, 30)))) for i in range(40)]
    return docs, items


@pytest.mark.parametrize("k", [1, 10])
def test_equals_brute_force(spark, k):
    docs, items = corpus()
    docs += [(1000 + i, docs[i % 5][1]) for i in range(60)]           # ties
    assert search(spark, docs, items, k=k) == brute(docs, items, k)


def test_slices_and_blocks_change_nothing(spark, monkeypatch):
    docs, items = corpus(200)
    want = brute(docs, items)
    assert search(spark, docs, items, block_terms=25) == want         # several rounds
    monkeypatch.setattr(op12, "DOCS_PER_TASK", 64)
    assert search(spark, docs, items, parts=7) == want


def test_one_slice_after_another_keeps_the_best():
    r = np.random.default_rng(4)
    plan = op12.Plan(None, r.integers(1, 9000, 12), None, 500, 20_000, 5)
    for _ in range(200):
        n, postings = 60, r.integers(0, 500)
        pairs = np.unique(r.integers(0, n, postings) * 12 + r.integers(0, 12, postings))
        part = op12.Slice(plan, r.integers(1, 90, n), pairs // 12, pairs % 12, r.integers(1, 5, len(pairs)))
        terms, repeats = r.permutation(12)[:r.integers(1, 12)].tolist(), r.integers(1, 3, 12).tolist()
        full = np.zeros(n, np.int64)
        for t, x in zip(terms, repeats, strict=False):
            if t in part.lo:
                np.add.at(full, part.owner[part.lo[t]:part.hi[t]], part.gain[part.lo[t]:part.hi[t]] * x)
        least = int(r.integers(0, full.max() + 2))
        at, score = part.answer(terms, repeats[:len(terms)], 5, least)
        assert (score == full[at]).all() or (score <= full[at]).all()
        fifth = max(least, int(np.sort(full)[-5]), 1)
        wanted = set(np.flatnonzero(full >= fifth).tolist())
        assert wanted <= set(at.tolist())                              # nothing that can be among the best is missing
        assert all(s == full[a] for a, s in zip(at.tolist(), score.tolist(), strict=True) if a in wanted)
        assert not part.scores.any()


def test_odd_rows(spark):
    items = [(1, "the same text"), (1, "ONE two"), (None, "漢字 é"), (3, None), (4, ""), (5, "no-such-word-here"), (6, "one " * 50)]
    assert search(spark, ODD, items) == brute(ODD, items)


def test_empty_tables(spark, empty):
    assert search(spark, [], [(1, "a")]) == []
    assert search(spark, [(1, "a")], []) == []


def test_hot_word_and_copies(spark):
    docs = [(i, "hot hot word") for i in range(700)] + [(1000 + i, "hot " + " ".join(prose(i, 30))) for i in range(50)]
    items = [(1, "hot"), (2, "hot word wabx"), (3, " ".join(prose(3, 10)))]
    assert search(spark, docs, items, parts=5) == brute(docs, items)
