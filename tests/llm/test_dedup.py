import hashlib
import random
import re
import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD, frame, prose
from tollgate.llm import exact_dedup as op1
from tollgate.llm import near_dedup as op5
from tollgate.llm import substring_dedup as op2
from tollgate.llm.graph import connected_components
from tollgate.llm.staging import discard, materialise
from tollgate.llm.textarrays import blocks, words

# ------------------------------------------------------------------ exact ---


def exact_brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, norm):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(rows, norm):
        ids = [x for x in groups[t] if x is not None]
        out.append((i, min(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("table_bytes", [op1.TABLE_BYTES, 700])  # the small table overflows again and again
def test_exact_dedup_equals_brute_force(spark, table_bytes):
    rows = ODD + [(100 + i, f"copy {i % 7}") for i in range(60)]
    got = op1.exact_dedup(frame(spark, rows), table_bytes=table_bytes, buckets=2).collect()
    want, groups = exact_brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_content_table_compares_whole_contents():
    t = op1.ContentTable(10_000)
    assert [t.group(5, b"a", 1), t.group(5, b"b", 2), t.group(5, b"a", 3)] == [1, 2, 1]  # one hash, two contents
    for i in range(5000):
        t.group(i, b"", 10 + i)
    assert t.group(3, b"", -1) in (13, None)


def test_exact_dedup_empty(empty):
    assert op1.exact_dedup(empty).count() == 0


# ------------------------------------------------------------------- near ---

def shingle_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None] if sets[i] else [d]
        c = min(known) if known and known != [None] else None
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def edited(words, r, share):
    return [w if r.random() > share else f"e{r.randrange(10**6)}" for w in words]


def near_rows():
    """Groups of light and of heavy edits (alike, but mostly not enough), chains, and odd rows."""
    r, rows, n = random.Random(3), list(ODD), 200
    for base, share, size in ((1, 0.01, 25), (2, 0.035, 30), (3, 0.06, 20)):
        words = prose(base, 120)
        for _ in range(size):
            rows.append((n, " ".join(edited(words, r, share))))
            n += 1
    walk = prose(9, 100)
    for i in range(12):  # neighbours are linked, ends are not
        walk = walk[4:] + [f"n{i}{j}" for j in range(4)]
        rows.append((n, " ".join(walk)))
        n += 1
    return rows + [(n + 1, rows[-1][1].upper()), (n + 2, None)]


def test_near_dedup_equals_brute_force(spark):
    rows = near_rows()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op5.near_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == near_brute(rows)


def test_rare_ends_hold_every_similar_pair(spark):
    rows = [(i, t) for i, t in near_rows() if i and shingle_set(t) and len(t) < 5000]
    texts = materialise(spark.createDataFrame(rows, "row long, body string").dropDuplicates(["row"]), "t")
    nodes = texts.selectExpr("row as node", "row as component")
    found = {frozenset(p) for p in op5.rare_end_pairs(nodes, texts, 5, 75).collect()}
    sets = {r.row: shingle_set(r.body) for r in texts.collect()}
    similar = {frozenset((a, b)) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert similar and similar <= found
    assert len(found) < 0.7 * sum(1 for a in sets for b in sets if a < b and len(sets[a] & sets[b]))


def test_rare_ends_of_singletons_in_different_size_classes(spark):
    """Pairs near the threshold, each sharing few rare shingles: components of equal size at both keys."""
    rows = []
    for i in range(60):
        words = [f"p{i}w{j}" for j in range(104)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:79 + i % 4]))]
    sets = {i: shingle_set(t) for i, t in rows}
    similar = {frozenset((2 * i, 2 * i + 1)) for i in range(60)
               if 100 * len(sets[2 * i] & sets[2 * i + 1]) >= 75 * len(sets[2 * i] | sets[2 * i + 1])}
    texts = materialise(spark.createDataFrame(rows, "row long, body string"), "t")
    r = random.Random(4)
    name = {i: r.randrange(10 ** 9) for i, _ in rows}  # arrival and order of the components are unrelated
    nodes = spark.createDataFrame([(i, name[i]) for i, _ in rows], "node long, component long")
    # Every shuffle really deals the rows, so ties arrive in any order.
    conf = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        found = {frozenset(p) for p in op5.rare_end_pairs(nodes, texts, 5, 75).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(similar) > 20 and similar <= found


def test_sketch_fills_and_estimates():
    r = np.random.default_rng(0)
    a = np.sort(r.integers(0, 2 ** 63, 300, dtype=np.uint64))
    b = np.sort(np.concatenate([a[:240], r.integers(0, 2 ** 63, 60, dtype=np.uint64)]))
    one = a[:1]
    s = op5.sketch(np.concatenate([a, b, one]), np.array([0, 300, 600, 601]))
    assert (s != op5._EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 240 / 360) < 0.15


def test_near_dedup_empty(empty):
    assert op5.near_dedup(empty).count() == 0


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(1, 1)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    least = {i: i for e in edges for i in e}
    for _ in range(200):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {k: v for k, v in least.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# -------------------------------------------------------------- passages ---

def test_passages_exact_fuzzy_and_clean(spark):
    r = random.Random(11)
    shared = prose(50, 70, 4000)
    fuzzy = prose(51, 160, 4000)

    def around(words, seed):
        return " ".join([*prose(seed, 60, 4000), *words, *prose(seed + 1, 60, 4000)])

    less = [w for i, w in enumerate(fuzzy) if i % 40 != 11]      # words missing: the diagonal moves
    rows = [(i, around(shared, 1000 + 10 * i)) for i in range(30)]
    rows += [(40, around(fuzzy, 3000)), (41, around(less, 3010)), (42, around(edited(fuzzy, r, 0.03), 3020))]
    rows += [(50 + i, " ".join(prose(5000 + i, 200, 4000))) for i in range(10)]
    rows += [(70, rows[-1][1]), (71, "too short to repeat"), (72, "too short to repeat")]
    got = op2.repeated_passages(frame(spark, rows + [(-i if i and i < 12 else i, t) for i, t in ODD])).collect()
    pairs = {(x.doc_id, x.ref_doc_id) for x in got}
    flagged = {i for p in pairs for i in p}
    assert set(range(30)) <= flagged and {40, 41, 42} <= flagged and {59, 70} <= flagged
    assert not flagged & {*range(50, 59), 71, 72, -7, -8, -9, -10, -11}
    for x in got:
        if x.doc_id < 30:
            assert (x.start_word, x.end_word) == (60, 130) and x.identity == 1.0
    assert any({40, 41} == {x.doc_id, x.ref_doc_id} and x.end_word - x.start_word >= 150 for x in got)


def test_passages_empty(empty):
    assert op2.repeated_passages(empty).count() == 0


def test_passage_whose_seeds_are_split_over_earlier_documents(spark):
    stock = [prose(7000 + i, 10, 4000) for i in range(6)]
    joints = [a + b for a, b in zip(stock, stock[1:])]
    rows = [(i, " ".join([*prose(7100 + i, 40, 4000), *part, *prose(7200 + i, 40, 4000)])) for i, part in enumerate(stock + joints)]
    passage = [w for part in stock for w in part]
    rows += [(i, " ".join([*prose(7300 + i, 33, 4000), *passage, *prose(7400 + i, 40, 4000)])) for i in (50, 51)]
    got = op2.repeated_passages(frame(spark, rows).coalesce(1)).collect()
    assert {50, 51} == {x.doc_id for x in got if x.end_word - x.start_word >= 60} | {
        x.ref_doc_id for x in got if x.end_word - x.start_word >= 60}
    assert any((x.doc_id, x.ref_doc_id, x.passage_start, x.passage_end) == (51, 50, 33, 93) for x in got)


def fuzzy_mix(pairs, held, seed):
    """Pairs of documents that share 200 words with every 20th word changed; other documents hold ``held`` pieces of 20
    words of a passage each, in any order among them."""
    r, rows = random.Random(seed), []
    for p in range(pairs):
        passage = prose(9000 + p, 200, 3000)
        changed = [f"new{p}x{i}" if i % 20 == 19 else w for i, w in enumerate(passage)]
        for kind, words in (("b", passage), ("c", changed)):
            rows.append((p, kind, [*prose(10_000 + 2 * p, 60, 3000), *words, *prose(10_001 + 2 * p, 60, 3000)]
                         if kind == "b" else [*prose(20_000 + p, 50, 3000), *words, *prose(30_000 + p, 70, 3000)]))
        for i in range(0, 200 - 20 * held + 1, 20):
            piece = passage[i:i + 20 * held]
            rows.append((p, "d", [*prose(40_000 + 100 * p + i, 40, 3000), *piece, *prose(50_000 + 100 * p + i, 40, 3000)]))
    r.shuffle(rows)
    return [(i, " ".join(w)) for i, (_, _, w) in enumerate(rows)], [
        tuple(i for i, (q, kind, _) in enumerate(rows) if q == p and kind != "d") for p in range(pairs)]


@pytest.mark.parametrize("held", [1, 2])
def test_recall_of_fuzzy_passages_among_their_pieces(spark, held):
    rows, pairs = fuzzy_mix(30, held, held)
    got = op2.repeated_passages(frame(spark, rows).repartition(3)).collect()
    found = 0
    for a, b in pairs:
        spans = [s for s in got if {s.doc_id, s.ref_doc_id} == {a, b}]
        found += max((s.end_word - s.start_word for s in spans), default=0) >= 170
    assert found >= 0.9 * len(pairs)


@pytest.mark.parametrize("size", [1, 5, 50, 64])
def test_window_hashes_tell_runs_apart(size):
    r = np.random.default_rng(size)
    h = r.integers(0, 3, 400).astype(np.uint64)
    got = op2.window_hashes(h, size)
    runs = [tuple(h[i:i + size].tolist()) for i in range(401 - size)]
    assert len(got) == len(runs) and len(set(got.tolist())) == len(set(runs)) == len(set(zip(runs, got.tolist())))


def chain_score(segments, path, cost):
    total = 0
    for n, i in enumerate(path):
        x, y, length, weight = segments[i]
        total += weight
        if n:
            ax, ay, alength, _ = segments[path[n - 1]]
            assert ax + alength <= x and ay + alength <= y
            total -= cost * (x - ax - alength + y - ay - alength)
    return total


@pytest.mark.parametrize("seed", range(20))
def test_chains_equal_quadratic_dynamic_programme(seed):
    r = random.Random(seed)
    s = [(r.randrange(200), r.randrange(200), r.randrange(1, 15), r.randrange(1, 30)) for _ in range(25)]
    order = sorted(range(len(s)))
    best = {}

    def score(i):
        if i not in best:
            x, y, _, w = s[i]
            best[i] = w + max([0] + [score(j) - 0.25 * (x - s[j][0] - s[j][2] + y - s[j][1] - s[j][2])
                                     for j in order if s[j][0] + s[j][2] <= x and s[j][1] + s[j][2] <= y])
        return best[i]
    want = max(score(i) for i in order)
    chains = op2.chain(s, 0.25, 10**6)
    assert chain_score(s, chains[0], 0.25) == pytest.approx(want)
    assert sorted(i for c in chains for i in c) == order


@pytest.mark.parametrize("seed", range(20))
def test_chains_within_the_gap_equal_quadratic_dynamic_programme(seed):
    r = random.Random(seed)
    # A long block outweighs all, and is too far away for most.
    s = [(0, 0, 60, 400)] + [(r.randrange(60, 260), r.randrange(60, 260), r.randrange(1, 15), r.randrange(1, 30)) for _ in range(40)]
    best = {}

    def score(i):
        if i not in best:
            x, y, _, w = s[i]
            gaps = [(j, x - a - n, y - b - n) for j, (a, b, n, _) in enumerate(s)]
            best[i] = w + max([0] + [score(j) - 0.25 * (g + h) for j, g, h in gaps if 0 <= g <= 32 and 0 <= h <= 32])
        return best[i]
    chains = op2.chain(s, 0.25, 32)
    assert chain_score(s, chains[0], 0.25) == pytest.approx(max(map(score, range(len(s)))))
    assert sorted(i for c in chains for i in c) == list(range(len(s)))
    for c in chains:
        for i, j in zip(c, c[1:]):
            assert all(0 <= s[j][d] - s[i][d] - s[i][2] <= 32 for d in (0, 1))


def test_pieces_after_a_long_block_are_chained():
    s = [(0, 0, 400, 400)] + [(460 + 16 * i, 460 + 15 * i, 8, 8) for i in range(6)]
    assert sorted(op2.chain(s), key=len) == [[0], [1, 2, 3, 4, 5, 6]]


def test_align_extends_and_bridges():
    a = np.arange(100)
    b = np.concatenate([np.arange(500, 505), a[3:40], [7777, 7778], a[42:50], a[53:90]])
    x0, x1, y0, y1, equal = op2.align(a, b, [10, 44, 60], [12, 46, 59], [20, 5, 20])
    assert (x0, x1, y0, y1) == (3, 90, 5, 89) and equal == 82


def filled_in(common, seed):
    """A template: 55 equal words, then three times 16 of one's own and 20 equal ones."""
    own = iter([f"f{seed}n{i}" for i in range(48)])
    out, at = list(common[:55]), 55
    for _ in range(3):
        out += [next(own) for _ in range(16)] + common[at:at + 20]
        at += 20
    return out


def test_passages_of_a_template_with_fill_ins(spark):
    common = prose(60, 115, 4000)
    rows = [(i, " ".join([*prose(6000 + i, 30, 4000), *filled_in(common, i), *prose(6100 + i, 30, 4000)])) for i in range(4)]
    got = op2.repeated_passages(frame(spark, rows)).collect()
    for i in (1, 2, 3):  # of the first one the others are copies
        assert any(x.doc_id == i and x.start_word <= 30 and x.end_word >= 85 and x.identity >= 0.8 for x in got)
    assert {x.doc_id for x in got} | {x.ref_doc_id for x in got} == {0, 1, 2, 3}


@pytest.mark.parametrize("seed", range(20))
def test_good_spans_equal_brute_force(seed):
    r = random.Random(seed)
    a = np.arange(300)
    equal = np.array([r.random() < p for p in [0.98] * 70 + [0.3] * 60 + [0.85] * 60 + [0.2] * 50 + [1.0] * 60])
    equal[0] = equal[-1] = True
    b = np.where(equal, a, a + 1000)
    got = op2.good_spans(a, b, [0], [0], [300], 0.8, 12)
    assert all(equal[x0:x1].mean() == share >= 0.8 and (x0, x1) == (y0, y1) for x0, x1, y0, y1, share in got)
    longest = max((j - i for i in range(300) for j in range(i + 12, 301)
                   if equal[i] and equal[j - 1] and equal[i:j].mean() >= 0.8 - 1e-12), default=0)
    assert max(x[1] - x[0] for x in got) == longest
    assert all(p[1] <= q[0] for p, q in zip(got, got[1:]))


def repeating_text_batch(texts, seed):
    """Texts as the window step gets them, with some of their seeds marked as repeating."""
    r, at = np.random.default_rng(seed), []
    column = pa.array([" ".join(t) for t in texts])
    for block in blocks(column):
        of, pos, _ = op2.seeds(words(block))
        at += [p[r.random(len(p)) < 0.9].astype(np.int32) for p in (pos[of == i] for i in range(block.n))]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts)) + 7), pa.array(at, pa.list_(pa.int32())), column],
                                      names=["row", "at", "body"])


@pytest.mark.parametrize("size", [5, 20, 30, 50])
def test_runs_that_may_repeat_equal_brute_force(size):
    r = random.Random(size)
    texts = [prose(i, r.randrange(0, 300), 4000) for i in range(60)]
    texts += [prose(90, 120, 4000) * 2, [], ["one"], prose(91, size, 4000), prose(92, size - 1, 4000)]
    batch = repeating_text_batch(texts, size)
    want = set()
    for i, at in enumerate(batch.column("at").to_pylist()):
        for block in blocks(pa.array([" ".join(texts[i])])):
            seed = list(zip(*(x.tolist() for x in op2.seeds(words(block))[1:])))
            known = {g for p, g in seed if p in set(at)}
            once = [p for p, g in seed if g not in known]
            for s in range(len(texts[i]) - size + 1):
                # The k-mers a seed was chosen from all lie in the run.
                if not any(s <= p - op2.W + 1 and p + op2.W - 1 + op2.K <= s + size for p in once):
                    want.add((i + 7, s))
    got = pa.Table.from_batches(op2._whole_windows(op2.K, op2.W, size)(iter([batch.slice(0, 13), batch.slice(13)])))
    told = {(row, spot >> 32) for row, spot in zip(got.column("row").to_pylist(), got.column("spot").to_pylist())}
    # Of runs that a text has twice, the first place is told.
    assert told <= want
    assert {" ".join(texts[i - 7][s:s + size]) for i, s in told} == {" ".join(texts[i - 7][s:s + size]) for i, s in want}


def test_window_step_does_no_python_work_per_text():
    def calls(texts):
        batch, n = repeating_text_batch(texts, 1), 0

        def count(frame, event, arg):
            nonlocal n
            n += event == "call"
        sys.setprofile(count)
        try:
            list(op2._whole_windows(op2.K, op2.W, 50)(iter([batch])))
        finally:
            sys.setprofile(None)
        return n
    assert calls([prose(i, 80, 4000) for i in range(400)]) < calls([prose(i, 80, 4000) for i in range(40)]) + 100


def test_anchors_equal_brute_force_whatever_the_batches():
    r = random.Random(3)
    seeds = sorted(((g, row, r.randrange(500), r.randrange(2)) for row in range(300) for g in {r.randrange(-40, 40) for _ in range(3)}),
                   key=lambda x: (x[0], r.random()))
    seeds += [(99, row, 5, 0) for row in (9, 8, 7)] + [(100, 3, 4, 0), (101, 6, 2, 1)]
    ready = [(1000 + i, 3, (i << 32) | 8, 55) for i in range(20)]
    rows = [(row, -1, (pos << 32) | many, g) for g, row, pos, many in seeds]
    for i in ready:
        rows.insert(r.randrange(len(rows)), i)
    groups = defaultdict(list)
    for g, row, pos, many in seeds:
        groups[g].append((row, pos, many))
    want = set(ready)
    for g, own in groups.items():
        (ref, rpos, _), *later = sorted(own)
        if later or own[0][2]:
            want |= {(row, ref, (pos << 32) | rpos, g) for row, pos, _ in sorted(own)}
    for size in (1, 7, 100, 5000):
        parts = [rows[i:i + size] for i in range(0, len(rows), size)] + [[]]
        made = op2._anchored(pa.RecordBatch.from_arrays([pa.array([x[c] for x in p], pa.int64()) for c in range(4)], names=op2._MATCH)
                             for p in parts)
        got = [x for b in made for x in zip(*(c.to_pylist() for c in b.columns))]
        assert set(got) == want and len(got) == len(want)


def test_chain_of_one_segment_needs_no_alignment_columns(monkeypatch):
    r = random.Random(5)
    cases = []
    for _ in range(300):
        p = r.choice([0.85, 0.95, 1.0])
        a = np.arange(r.randrange(20, 150))
        b = np.concatenate([np.arange(900, 900 + r.randrange(5)), np.where([r.random() < p for _ in a], a, -1 - a),
                            np.arange(800, 800 + r.randrange(5))])
        shift, x = int(np.sum(b[:5] >= 900)), r.randrange(10)
        n = r.randrange(6, len(a) - x + 1)
        x0, x1, y0, y1, equal = op2.align(a, b, [x], [x + shift], [n])
        cases.append((a, b, x, x + shift, n, (x0, x1, y0, y1, equal / max(x1 - x0, 1))))
    cases = [c for c in cases if c[-1][-1] >= 0.8]
    assert len(cases) > 200
    monkeypatch.setattr(op2, "columns", None)
    for a, b, x, y, n, want in cases:
        assert op2.good_spans(a, b, [x], [y], [n], 0.8, 12) == [want]


def test_slices_are_the_words_asked_for(monkeypatch):
    texts = [prose(i, n, 4000) for i, n in enumerate([30, 1, 0, 200])]
    asked = [(i, lo, hi) for i in range(4) for lo, hi in ((-5, 10), (0, 500), (3, 3), (20, 26), (250, 260))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i for i, _, _ in asked]), pa.array(range(len(asked))), pa.array([0] * len(asked), pa.int32()),
         pa.array([lo for _, lo, _ in asked], pa.int32()), pa.array([hi for _, _, hi in asked], pa.int32()),
         pa.array([" ".join(texts[i]) for i, _, _ in asked])], names=["row", "chain", "side", "lo", "hi", "body"])
    for most in (op2._SLICED, 7):
        monkeypatch.setattr(op2, "_SLICED", most)
        got = [x for b in op2._slices(iter([batch])) for x in zip(*(b.column(c).to_pylist() for c in ("chain", "lo", "words")))]
        assert [x[0] for x in got] == list(range(len(asked)))
        for (i, lo, hi), (_, start, cut) in zip(asked, got):
            line = [words(b).hash.astype(np.uint32) for b in blocks(pa.array([" ".join(texts[i])]))][0]
            assert start == max(lo, 0) and cut == line[start:max(hi, start)].tobytes()


def test_passages_keep_no_text_until_the_result_is_read(spark, monkeypatch):
    staged, gone = {}, set()

    def materialised(df, label):
        table = materialise(df, label)
        staged[label] = table
        return table

    monkeypatch.setattr(op2, "materialise", materialised)
    monkeypatch.setattr(op2, "discard", lambda *tables: (gone.update(t._staged for t in tables), discard(*tables)))
    shared = prose(80, 70, 4000)
    rows = [(i, " ".join([*prose(8000 + i, 40, 4000), *shared])) for i in range(4)] + [(9, " ".join(prose(8100, 60, 4000)))] * 2
    got = op2.repeated_passages(frame(spark, rows).coalesce(1))
    left = {label for label, table in staged.items() if table._staged not in gone}
    assert left == {"ids", "spans", "inside"}
    assert {(x.doc_id, x.ref_doc_id, x.start_word, x.end_word) for x in got.collect()} == {
        *((i, 0, 40, 110) for i in (1, 2, 3)), (9, 9, 0, 60)}
