import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD, frame, prose
from tollgate.llm import toxicity as op11
from tollgate.llm.textarrays import blocks

INSULTS, GROUPS = ["zorbish", "vlackle", "snerg"], ["northlings", "bakers", "sailors"]


def pair_rows(n=2000, seed=3):
    """Toxic is an insult with a mention of a group, or neither; one alone is not."""
    r, rows = random.Random(seed), []
    for i in range(n):
        insult, group = r.random() < 0.5, r.random() < 0.5
        ws = prose(i, r.randrange(10, 60), 60) + [r.choice(INSULTS)] * insult + [r.choice(GROUPS)] * group
        r.shuffle(ws)
        rows.append((" ".join(ws), int(insult == group)))
    return rows


def features(texts, dim=1 << 14):
    out = []
    for block in blocks(pa.array(texts)):
        values, offsets = op11.terms(block, dim)
        out += [values[offsets[i]:offsets[i + 1]] for i in range(block.n)]
    return out


def test_pairs_are_learned_that_linear_weights_miss():
    rows, dim = pair_rows(), 1 << 14
    x, y = features([t for t, _ in rows], dim), np.array([v for _, v in rows], float)
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in x[1500:]])])
    right = {}
    for factors in (4, 0):
        m = op11.fit_machine(x[:1500], y[:1500], np.ones(1500), dim, factors=factors, epochs=40, floor=0.5)
        right[factors] = ((m.scores(np.concatenate(x[1500:]), offsets) >= 0.5) == y[1500:]).mean()
    assert right[4] > 0.9 and right[0] < 0.65


def test_margin_is_the_sum_over_all_pairs():
    r = np.random.default_rng(1)
    m = op11.FactorizationMachine(0.3, r.normal(size=50), r.normal(size=(50, 3)))
    rows = [np.array([3, 7, 9, 40]), np.array([], np.int64), np.array([5])]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in rows])])
    want = [0.3 + m.weight[x].sum() + sum(m.factor[a] @ m.factor[b] for k, a in enumerate(x) for b in x[k + 1:]) for x in rows]
    assert m.margins(np.concatenate(rows), offsets) == pytest.approx(want)


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def insult_rows(n=500):
    r = random.Random(5)
    out = []
    for i in range(n):
        bad = i % 4 == 0
        ws = prose(i, r.randrange(5, 80)) + [r.choice(INSULTS) for _ in range(3)] * bad
        r.shuffle(ws)
        out.append((1000 + i, " ".join(ws), int(bad)))
    return out


def test_held_out_rows_and_odd_rows(spark):
    rows = insult_rows()
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows] + [(None, 1, "x"), (1000, None, "x"), (5000, 1, "x")],
                                   "doc_id long, toxic int, text string")
    docs = frame(spark, [(i, t) for i, t, _ in rows] + ODD + [(6000, " ".join(prose(9, 40_000))), (6001, "Zorbish, snerg VLACKLE!")])
    got = op11.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(ODD) + 2
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == held(r.doc_id) for r in got if r.doc_id is not None) and not by[None].held_out
    out = [(i, y) for i, _, y in rows if held(i)]
    assert sum(by[i].predicted == y for i, y in out) >= 0.97 * len(out)
    assert by[6000].predicted == 0 and by[6001].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    same = [r.score for r in got if r.doc_id in (7, 8, 9)]
    assert len(set(same)) == 1                                       # without terms: the bias alone


def test_a_text_that_a_third_of_the_rows_repeat(spark):
    rows = insult_rows(300)
    hot = [(10_000 + i, "the same text of very many rows", 0) for i in range(150)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows + hot], "doc_id long, toxic int")
    docs = frame(spark, [(i, t) for i, t, _ in rows + hot])
    once = {r.doc_id: r.score for r in op11.toxicity(docs, labels).collect()}
    again = {r.doc_id: r.score for r in op11.toxicity(docs.repartition(7), labels).collect()}
    assert once == again                                             # whatever the partitions
    assert all(once[i] < 0.5 for i, _, _ in hot)
    assert sum((once[i] >= 0.5) == y for i, _, y in rows if held(i)) >= 0.95 * sum(held(i) for i, _, _ in rows)


def test_one_class_no_labels_no_documents(spark, empty):
    docs = frame(spark, [(1, "a"), (2, "b c")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in op11.toxicity(docs, none).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(i, 0) for i in range(1, 9)], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in op11.toxicity(frame(spark, [(i, "a") for i in range(1, 9)]), one).collect())
    assert op11.toxicity(empty, none).count() == 0
