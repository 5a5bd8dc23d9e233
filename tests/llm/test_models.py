import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, frame, prose
from tollgate.llm import language_id as op4
from tollgate.llm import mixing as op6
from tollgate.llm import quality as op3

WORDS = {"aa": ["ganda", "ndago", "gogan", "danga"], "bb": ["zíxel", "lexíz", "xelle", "zílex"], "cc": ["hurou", "rouhu", "ouhur"]}


def language_rows(n=60):
    r, out = random.Random(1), []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        out.append((1000 + i, " ".join(r.choice(WORDS[lang]) for _ in range(r.randrange(1, 40))), lang))
    return out


def test_language_id_learns_and_rejects(spark):
    rows = language_rows() + [(1, "12 - 34", None), (2, None, "aa"), (3, "漢字漢字漢字漢字", None), (4, "", None), (None, "ganda", None)]
    got = {r.doc_id: r for r in op4.language_id(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == lang for i, _, lang in language_rows())
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (1, 2, 4))
    assert got[3].lang_pred in WORDS and got[3].rejected          # a letter, so a learned language, but not accepted
    assert got[None].lang_pred == "aa" and not got[None].rejected and not got[None].held_out
    assert 0 <= min(r.score for r in got.values()) and max(r.score for r in got.values()) <= 1
    assert any(r.held_out for r in got.values())


def letter_grams(text):
    """4-grams of a text's letter runs: each letter and the boundary after the run, with up to three letters before it."""
    runs, run = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            run += c
        elif run:
            runs, run = [*runs, run], ""
    return [("\0\0\0" + w + "\0")[i:i + 4] for w in runs for i in range(len(w) + 1)]


class PlainKneserNey:
    """Interpolated Kneser-Ney by its recursive definition, over dictionaries."""

    def __init__(self, grams, vocabulary):
        self.vocabulary = vocabulary
        self.levels = {4: Counter(grams)}
        for order in (3, 2, 1):
            self.levels[order] = Counter(g[1:] for g in self.levels[order + 1])
        self.discount = {}
        for order, level in self.levels.items():
            n1, n2 = (sum(v == x for v in level.values()) for x in (1, 2))
            self.discount[order] = min(0.99, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.05

    def p(self, gram):
        order = len(gram)
        if not order:
            return 1 / self.vocabulary
        after = {g: n for g, n in self.levels[order].items() if g[:-1] == gram[:-1]}
        if not after:
            return self.p(gram[1:])
        d, total = self.discount[order], sum(after.values())
        return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * self.p(gram[1:])


@pytest.mark.parametrize("model_grams", [op4.MODEL_GRAMS, 0])
def test_language_id_equals_plain_models(spark, model_grams):
    r = random.Random(12)
    rows = [(i, " ".join(r.choice(WORDS[lang]) + r.choice(["", "s", "é", "漢"]) for _ in range(r.randrange(1, 9))), lang)
            for i in range(45) for lang in [sorted(WORDS)[i % 3]]]
    rows += [(100, "ganda zíxel, HUROU!", None), (101, "Zzz", None), (102, "漢é s", None), (103, "go-gan 12 da\nnga", None)]
    learned = [(t, lang) for i, t, lang in rows if lang and zlib.crc32(str(i).encode()) % 5]
    vocabulary = len({g[-1] for t, _ in learned for g in letter_grams(t)}) + 1
    models = {x: PlainKneserNey([g for t, lang in learned if lang == x for g in letter_grams(t)], vocabulary) for x in sorted(WORDS)}
    got = {x.doc_id: x for x in op4.language_id(frame(spark, rows), model_grams=model_grams).collect()}
    for i, text, _ in rows:
        grams = letter_grams(text)
        entropy = {x: -sum(math.log(m.p(g)) for g in grams) / len(grams) for x, m in models.items()}
        best = min(entropy, key=lambda x: (entropy[x], x))
        assert got[i].lang_pred == best and got[i].n_events == len(grams)
        assert got[i].cross_entropy == pytest.approx(entropy[best], abs=1e-5)
        apart = [min(e - entropy[best], 50) * min(len(grams), 60) for e in entropy.values()]
        assert got[i].score == pytest.approx(1 / sum(math.exp(-x) for x in apart), abs=1e-4)


def test_models_as_tables_give_the_same(spark):
    odd = [(1, "12 - 34", None), (2, None, "aa"), (3, "漢字漢字漢字漢字", None), (4, "", None), (None, "ganda ganda", None), (5, "ÀÉ 𐌰𐌱", "bb"),
           (6, "ganda " * 400, None)]
    docs = frame(spark, language_rows() + odd)
    columns = ["doc_id", "lang_pred", "rejected", "n_events", "held_out"]
    broadcast = {tuple(r[c] for c in columns): (r.score, r.cross_entropy) for r in op4.language_id(docs).collect()}
    tabled = {tuple(r[c] for c in columns): (r.score, r.cross_entropy) for r in op4.language_id(docs, model_grams=0).collect()}
    assert broadcast.keys() == tabled.keys()
    for key, value in broadcast.items():
        assert tabled[key] == pytest.approx(value, abs=1e-5)   # costs of words are kept in 32 bits on one side


def test_texts_without_a_letter_are_undetermined(spark):
    none = ["😀🎉 😀", "𝟏𝟐𝟑 𝟜", "🙂", "12 - 34 €", "— … «»", "\u20e3 \U0001F1E9\U0001F1EA"]
    docs = frame(spark, language_rows() + [(i, t, None) for i, t in enumerate(none)])
    got = {r.doc_id: r for r in op4.language_id(docs).collect()}
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in range(len(none))] == [("und", 0.0, True)] * len(none)


def test_letters_beyond_the_first_plane_are_told_apart(spark):
    r = random.Random(3)
    words = {"got": "𐌰𐌱𐌲𐌳𐌴𐌵𐌶𐌷", "osa": "𐓀𐓁𐓂𐓃𐓄𐓅𐓆𐓇", "mix": "a𐌰b𐓀c𐌲d"}
    rows = [(100 + i, " ".join("".join(r.choice(words[lang]) for _ in range(r.randrange(2, 8))) for _ in range(20)), lang)
            for i in range(90) for lang in [sorted(words)[i % 3]]]
    got = {r.doc_id: r for r in op4.language_id(frame(spark, rows + [(1, "𐌰𐌱𐌲", None), (2, "𐓀𐓁", None)])).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert got[1].lang_pred == "got" and got[2].lang_pred == "osa" and got[1].n_events == 7


def test_a_small_language_beside_millions_of_4_grams(spark):
    r = np.random.default_rng(5)
    points = r.integers(0x4E00, 0x9FA0, (560_000, 7)).astype(np.uint32)
    points[:, 6] = 0x20
    many = [points[i:i + 5000].astype("<u4").tobytes().decode("utf-32-le") for i in range(0, len(points), 5000)]
    few = ["".join(map(chr, r.integers(0x61, 0x7B, 7))) for _ in range(40)]  # every word once
    rows = [(i, t, "many") for i, t in enumerate(many)] + [(1000, " ".join(few), "few")]
    model = op4.fit_language_models(frame(spark, rows))
    assert model.languages == ["few", "many"]
    assert len(model.models[1].grams[3]) > 3_000_000
    assert len(model.models[0].grams[3]) == len({("\0\0\0" + w + " ")[i:i + 4] for w in few for i in range(8)})
    assert op4.predict_language(frame(spark, [(1, few[3])]), model).first().lang_pred == "few"


def test_kneser_ney_is_a_distribution():
    text = "abacabadabacabaeabacab"
    key = {}
    padded = "\0\0\0" + text
    for i in range(3, len(padded)):
        g = 0
        for c in padded[i - 3:i + 1]:
            g = g << 16 | ord(c)
        key[g] = key.get(g, 0) + 1
    grams = np.array(sorted(key), np.uint64)
    m = op4.KneserNey.fit(grams, np.array([key[int(g)] for g in grams]), 7)
    for context in ("aba", "bac", "xyz", "axa"):
        base = 0
        for c in context:
            base = base << 16 | ord(c)
        seen = np.exp(m.score(np.array([base << 16 | ord(c) for c in "abcde"], np.uint64))).sum()
        unseen = np.exp(m.score(np.array([base << 16 | ord("q")], np.uint64)))[0]
        assert seen + 2 * unseen == pytest.approx(1, abs=1e-9)


def test_keep_identified_keeps_columns_and_clean_rows(spark):
    rows = language_rows() + [(3, "漢字漢字漢字漢字", "aa"[:0] or None), (4, None, None)]
    docs = frame(spark, rows)
    kept = op4.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in language_rows()}


def test_long_gibberish_is_rejected_beside_one_letter_rows(spark):
    r = random.Random(9)
    odd = [(2000 + i, c, "aa") for i, c in enumerate("ωжقहㄱ")]        # training rows of one rare letter
    gibberish = ["".join(r.choice("bcfhjklmpqrstvwyzüøß") for _ in range(6)) for _ in range(60)]
    rows = language_rows(300) + odd + [(1, " ".join(gibberish), None), (2, "жωжωжω " * 30, None)]
    got = {x.doc_id: x for x in op4.language_id(frame(spark, rows)).collect()}
    assert got[1].rejected and got[2].rejected
    assert not any(got[i].rejected for i, _, _ in language_rows(300))


def test_language_models_empty_and_without_labels(spark, empty):
    assert op4.language_id(empty).count() == 0
    got = op4.language_id(frame(spark, [(1, "abc", None)])).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


# --------------------------------------------------------------- quality ---

def quality_rows(n=240):
    r, docs, labels = random.Random(2), [], []
    for i in range(n):
        words = prose(i, r.randrange(5, 60))
        bad = i % 4 == 0
        if bad:
            words = [f"{w}{r.choice(['***', '%%%'])}" for w in words] if i % 8 else [words[0]] * len(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    return docs, labels


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_held_out(spark):
    docs, labels = quality_rows()
    odd = [(10_000 + (i or 0), t) for i, t in ODD] + [(None, "abc")]
    got = op3.quality(frame(spark, docs + odd), labels_frame(spark, labels + [(0, None, None), (None, 1, 0)])).collect()
    assert len(got) == len(docs) + len(odd)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_one_class_and_empty(spark, empty):
    docs, labels = quality_rows(12)
    one = [(i, 1, 0) for i, _, _ in labels]
    assert {r.predicted for r in op3.quality(frame(spark, docs), labels_frame(spark, one)).collect()} == {1}
    assert {r.score for r in op3.quality(frame(spark, docs), labels_frame(spark, [])).collect()} == {0.5}
    assert op3.quality(empty, labels_frame(spark, labels)).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    r = np.random.default_rng(0)
    x = r.normal(size=(60, 4))
    y = np.where(x @ np.array([1, -2, 0.5, 0]) + 0.3 * r.normal(size=60) > 0, 1.0, -1.0)
    index = [np.arange(4)] * 60
    w, b = op3.fit_hinge(index, list(x), y, np.ones(60), 4, epochs=2000)

    def loss(w, b):
        return (w @ w + b * b) / 2 + np.maximum(0, 1 - y * (x @ w + b)).sum()
    best = loss(w, b)
    for _ in range(200):
        assert best <= loss(w + 0.05 * r.normal(size=4), b + 0.05 * r.normal()) + 1e-3


# ---------------------------------------------------------------- mixing ---

def test_the_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    docs, labels = quality_rows()
    hot = [(100_000 + i, "the same text of a third of all rows", "en") for i in range(len(docs) // 2)]
    training = frame(spark, docs + hot).select("doc_id", "text").join(
        labels_frame(spark, labels + [(i, 1, 0) for i, _, _ in hot]).select("doc_id", "quality"), "doc_id")
    seen = []
    fit = op3.fit_hinge
    monkeypatch.setattr(op3, "fit_hinge", lambda rows, *rest, **more: seen.append(len(rows)) or fit(rows, *rest, **more))
    one = op3.fit_quality(training, sample=40)
    two = op3.fit_quality(training.repartition(5), sample=40)
    assert max(seen) <= 40 and (one.weight == two.weight).all() and one.bias == two.bias


def test_rates_meet_the_targets(spark):
    docs, labels = quality_rows()
    domains = op6.quality_domains(labels_frame(spark, labels[:200] + [(1, None, 0)]))
    got = op6.document_rates(frame(spark, docs + ODD), domains, {"quality1_toxic0": 0.6, "quality0_toxic0": 0.4})
    assert got.count() == len(docs) + len(ODD)
    s = got.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col(c)).alias(c) for c in ("p_quality0_toxic0", "p_quality1_toxic0")],
                F.sum("n_tokens").alias("n"), F.min("rate").alias("least"),
                F.max(F.abs(F.col("p_quality0_toxic0") + F.col("p_quality1_toxic0") - 1)).alias("off")).first()
    assert s.p_quality1_toxic0 == pytest.approx(0.6 * s.n, rel=1e-3) and s.p_quality0_toxic0 == pytest.approx(0.4 * s.n, rel=1e-3)
    assert s.least >= 0 and s.off < 1e-9
    assert {r.residual < 1e-3 for r in got.select("residual").distinct().collect()} == {True}


def test_a_miss_of_the_targets_is_told(spark):
    docs, labels = quality_rows()
    domains = op6.quality_domains(labels_frame(spark, labels[:200]))
    with pytest.warns(UserWarning, match="miss their targets"):
        got = op6.document_rates(frame(spark, docs), domains, {"quality1_toxic0": 0.99, "quality0_toxic0": 0.01}, iterations=1)
    names = ["p_quality0_toxic0", "p_quality1_toxic0"]
    s = got.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col(c)).alias(c) for c in names], F.sum("n_tokens").alias("n"),
                F.max("residual").alias("residual")).first()
    assert s.residual == pytest.approx(max(abs(s[c] / s.n - w) for c, w in zip(names, (0.01, 0.99))), abs=1e-6)
    assert s.residual > 1e-3


def test_projection_holds_rates_at_zero_and_matches_a_plain_solver(spark):
    n = np.array([10, 20, 30, 5, 8, 40.0])
    p = np.array([[1, 0], [0.9, 0.1], [0.2, 0.8], [0, 1], [0.5, 0.5], [0.7, 0.3]])
    wanted = np.array([10.0, 80.0])  # below what the soft rows bring along
    frame_ = materialised(spark, n, p)
    steps, z, r, t, a = [], np.ones(6), np.ones(6), 1.0, n @ p
    for _ in range(30):
        g = ((n * z) @ p - wanted) / a
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        m = (t - 1) / after
        new = np.maximum(0, z - p @ g)
        z, r, t = new + m * (new - r), new, after
        steps.append((list(g), m))
    got = [x[0] for x in frame_.select(op6._state(steps, 2)["r"]).collect()]
    assert got == pytest.approx(list(r)) and min(got) == 0


def materialised(spark, n, p):
    return spark.createDataFrame([(float(a), [float(x) for x in b]) for a, b in zip(n, p)], "_n double, _p array<double>")


def test_mixing_without_labels_targets_or_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert {r.rate for r in op6.document_rates(odd, none, {"x": 1.0}).collect()} == {1.0}
    assert op6.document_rates(empty, none, {"x": 1.0}).count() == 0
    whole = op6.mixed_documents(odd, none, {"x": 1.0})
    assert whole.columns == odd.columns and whole.count() == odd.count()
