import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import frame, prose
from tests.llm.test_output import thue_morse
from tollgate.llm import contamination as op9
from tollgate.llm import near_dedup as op5
from tollgate.llm import quality as op3
from tollgate.llm import substring_dedup as op2
from tollgate.llm import textarrays as T
from tollgate.llm.textarrays import blocks, words

#: Pairs of words that hashes with algebraic structure take for equal.
PAIRS = [thue_morse(n) for n in range(2, 13)]


def test_hashes_of_regular_words():
    texts = [f"{x} {y} {x.upper()} {x}{y} {y}{x}" for x, y in PAIRS] + ["", None, "x" * 300 + " " + "x" * 299 + " " + "x" * 300]
    for block in blocks(pa.array(texts)):
        w = words(block)
        found = [w.hash[w.offsets[i]:w.offsets[i + 1]].tolist() for i in range(block.n)]
        for h in found[:len(PAIRS)]:
            assert h[0] == h[2] and len({h[0], h[1], h[3], h[4]}) == 4
        assert found[-1][0] == found[-1][2] != found[-1][1]


def test_hashes_do_not_depend_on_the_block():
    texts = [" ".join(prose(i, 40)) + " é漢字 " + "y" * (50 + i) for i in range(30)]
    whole = [h for b in blocks(pa.array(texts)) for h in words(b).hash.tolist()]
    assert whole == [h for b in blocks(pa.array(texts), 64) for h in words(b).hash.tolist()]


def docs_of(k):
    """Texts alike but for the words of one pair; every shingle holds one."""
    x, y = PAIRS[-1 - k]
    return " ".join([x] * 40), " ".join([y] * 40)


@pytest.mark.parametrize("k", [0, 1, 2])
def test_near_duplicates_and_contamination(spark, k):
    a, b = docs_of(k)
    groups = {r.doc_id: r.component_id for r in op5.near_dedup(frame(spark, [(1, a), (2, b), (3, a)])).collect()}
    assert groups == {1: 1, 2: 2, 3: 1}
    benchmark = spark.createDataFrame([(7, b)], "item_id long, text string")
    assert op9.decontaminate(frame(spark, [(1, a), (2, b)]), benchmark).select("doc_id").collect() == [(1,)]


def test_quality_features_and_seeds():
    (block,) = blocks(pa.array([x for p in PAIRS[-3:] for x in p]))
    values, offsets = op3.features(block)
    rows = [set(values[offsets[i]:offsets[i + 1]].tolist()) for i in range(block.n)]
    assert all(rows[i] != rows[i + 1] for i in (0, 2, 4))
    grams = [set(op2.seeds(words(next(blocks(pa.array([t])))), op2.K, op2.W)[2].tolist()) for t in docs_of(0)]
    assert grams[0] and not grams[0] & grams[1]


def test_span_hashes_equal_sums_by_byte():
    data = np.frombuffer(("aB " + "x" * 63 + " " + "Y" * 64 + " " + "z" * 65 + " " + "Q" * 300 + " é 漢 end").encode(), np.uint8)
    start = np.flatnonzero((data != 32) & np.concatenate([[True], data[:-1] == 32]))
    end = np.flatnonzero((data != 32) & np.concatenate([data[1:] == 32, [True]])) + 1
    start, end = np.append(start, len(data)), np.append(end, len(data))  # and an empty span
    for lower in (False, True):
        raw = np.frombuffer(data.tobytes().lower(), np.uint8) if lower else data
        want = [int(T._values((np.arange(b - a) << 8) + raw[a:b]).sum(dtype=np.uint64)) for a, b in zip(start, end)]
        want = T.mix(np.array(want, np.uint64) + (end - start).astype(np.uint64) * T._STEP)
        assert (T.span_hashes(data, start, end, lower) == want).all()


def test_words_need_few_bytes_for_one_of_text():
    texts = pa.array([" ".join("word%d" % (i * j % 977) for i in range(2000)) for j in range(60)])
    block = next(iter(T.blocks(texts)))
    T.words(block)
    tracemalloc.start()
    T.words(block)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 16 * len(block.data)
