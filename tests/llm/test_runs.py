import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD, frame, prose
from tollgate.llm import periodic_runs as op13
from tollgate.llm.textarrays import blocks, words


def brute(s, least=6, exponent=4):
    out, n = [], len(s)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, exponent * q) and not any(
                    a <= i and i + length <= a + m and q % p == 0 for a, m, p in out):
                out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(count, seed=1):
    r = random.Random(seed)
    for _ in range(count):
        k, n = r.choice([1, 2, 2, 3, 4]), r.randrange(0, 60)
        s = [r.randrange(k) + 1 for _ in range(n)]
        if n and r.random() < 0.5:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randrange(3, 10)
            s = s[:a] + [s[a + (i - a) % p] for i in range(a, n)]
        yield s


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (1, 3)])
def test_runs_equal_brute_force(least, exponent):
    for s in sequences(1000):
        assert op13.runs_of(s, least, exponent) == brute(s, least, exponent)


def test_extensions_and_leaves():
    for s in sequences(100, 2):
        if not s:
            continue
        tree, n = op13.SuffixTree(s), len(s)
        longest = tree.extensions()
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        if pairs:
            got = longest(*(np.array(x) for x in zip(*pairs, strict=True)))
            want = [next((d for d in range(n) if max(i, j) + d >= n or s[i + d] != s[j + d]), 0) for i, j in pairs]
            assert got.tolist() == want
        for falling in (False, True):
            key = [[-x if falling else x for x in s[i:]] for i in range(n)]
            order = sorted(range(n), key=lambda i: key[i])
            rank = tree.leaves(falling)[:n]
            assert sorted(range(n), key=lambda i: rank[i]) == order


def test_stretches_hold_every_run():
    for s in sequences(600, 3):
        texts = pa.array([" ".join(f"w{x}" for x in s), "a b c", " ".join(f"w{x}" for x in s)])
        for block in blocks(texts):
            w = words(block)
            found = [[], [], []]
            for a, b in zip(*op13.stretches(w), strict=True):
                at = int(np.searchsorted(w.offsets, a, side="right")) - 1
                lo, hi = int(a - w.offsets[at]), int(b - w.offsets[at])
                found[at] += [(lo + i, n, q) for i, n, q in op13.runs_of(s[lo:hi])]
            assert found == [brute(s), [], brute(s)]


def wanted(doc_id, text, rewrite=True):
    own = (text or "").encode().split()
    n, h = len(own), zlib.crc32(str(doc_id).encode())
    if rewrite and doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = own[:a] + [own[a + (i - a) % p] for i in range(a, n)]
    runs = brute(own)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = b" ".join(x for i, x in enumerate(own) if i not in drop)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def digests(spark, rows, **more):
    got = op13.run_digests(op13.periodic_runs(frame(spark, rows), **more))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_query_equals_brute_force(spark):
    r = random.Random(7)
    rows = [(i, " ".join(prose(i, r.randrange(0, 300), r.choice([2, 5, 400])))) for i in range(150)]
    rows += [(1000 + i, " ".join((prose(i, 30) + prose(i + 1, i % 9 + 1) * (3 + i % 5) + prose(i, 5)))) for i in range(60)]
    rows += [(2000, "x\n" * 500), (2001, "\t".join(["a b a c"] * 40)), (2002, " ".join(prose(4, 2000) * 5))]
    assert digests(spark, rows, rewrite=op13.planted_repeats) == sorted([wanted(*r) for r in rows], key=repr)


def test_odd_rows(spark, empty):
    odd = [r for r in ODD if r[0] != 16]  # the long one beyond the brute force's reach follows
    assert digests(spark, odd, rewrite=op13.planted_repeats) == sorted([wanted(*r) for r in odd], key=repr)
    long = prose(1, 9000)
    (row,) = op13.periodic_runs(frame(spark, [(16, " ".join(long * 4 + ["end"]))])).collect()
    assert [tuple(x) for x in row.runs] == [(0, 36_000, 9000)] and row.collapsed == " ".join([*long, "end"])
    assert op13.periodic_runs(empty).count() == 0


def test_collapsed_text_has_no_runs_of_its_own_words(spark):
    (row,) = op13.periodic_runs(frame(spark, [(1, "go on and on and on and on and on to x y x y x y x y")])).collect()
    assert [tuple(x) for x in row.runs] == [(1, 9, 2), (11, 8, 2)]
    assert row.collapsed == "go on and to x y"
