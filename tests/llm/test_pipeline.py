import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.conftest import ODD, frame, prose
from tests.llm.test_dedup import near_brute, near_rows
from tollgate.llm import token_output
from tollgate.llm.staging import materialise


def tables(spark, folder, docs):
    frame(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(prose(77, 30)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i % 3 > 0), int(i % 4 == 0)) for i, _ in docs if i]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return f"{folder}"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    leak = (900, " ".join([*prose(80, 50), *prose(77, 30), *prose(81, 50)]))
    rows = near_rows() + [leak]
    d = tables(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    sizes = {}
    for name, stage in P.STAGES:
        before, docs = docs, materialise(stage(spark, docs, d), name)
        sizes[name] = (before, docs)
        if name != "token_output":
            assert docs.columns == before.columns
    before, after = sizes["language_id"]
    assert {r.doc_id for r in after.collect()} >= {i for i, t in rows if i and t and any(c.isalpha() for c in t) and i < 15}
    before, after = sizes["near_dedup"]
    brute = near_brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted((r.doc_id for r in after.collect()), key=repr) == sorted({x[0] for x in brute if x[3]}, key=repr)
    before, after = sizes["decontamination"]
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == {900}
    before, after = sizes["mixing"]
    assert set(after.distinct().collect()) <= set(before.collect())
    mixed, tokens = sizes["token_output"]
    plain = Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))
    want = sorted((r.doc_id if r.doc_id is not None else -1, len(plain.encode(r.text or "").ids) + 1) for r in mixed.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in tokens.collect()) == want


def test_run_on_an_empty_table(spark, tmp_path):
    assert P.run(spark, tables(spark, tmp_path, [])).count() == 0
    assert P.ORACLE_SQL is None


def test_one_row_of_each_group_where_ids_repeat_or_lack(spark, tmp_path):
    a, b, c = (prose(90 + i, 60) for i in range(3))
    near = [" ".join([*w[:-1], "other"]) for w in (a, b, c)]
    a, b, c = (" ".join(w) for w in (a, b, c))
    rows = [(5, a), (6, near[0]), (5, b), (7, near[1]), (None, c), (None, near[2]), (8, ""), (8, "")]
    got = P.drop_near_duplicates(spark, frame(spark, rows), str(tmp_path)).select("doc_id", "text").collect()
    kept = {(r.doc_id, r.text) for r in got}
    assert len(got) == len(kept) == 4 and {(5, a), (5, b), (8, "")} <= kept
    assert kept & {(None, c), (None, near[2])}


def test_empty_benchmark_and_labels(spark, tmp_path):
    rows = [(i, " ".join(prose(300 + i, 40))) for i in range(1, 6)] + [(None, None), (9, ""), (9, "")]
    d = tables(spark, tmp_path, [])
    spark.createDataFrame([], "item_id long, text string").write.mode("overwrite").parquet(f"{d}/benchmark.parquet")
    docs = frame(spark, rows)
    assert sorted(map(tuple, P.drop_contaminated(spark, docs, d).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    assert sorted(map(tuple, P.mix_sources(spark, docs, d).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    tokens = P.write_tokens(spark, docs, d).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in tokens if not r.doc_id or r.doc_id == 9), key=repr) == [(9, 1), (9, 1), (None, 1)]
