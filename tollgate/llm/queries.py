"""One registered query per operator, with production parameters, over its
whole table.  ``ORACLES`` has the SQL where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import contamination as op9
from tollgate.llm import exact_dedup as op1
from tollgate.llm import language_id as op4
from tollgate.llm import license_scan as op8
from tollgate.llm import mixing as op6
from tollgate.llm import near_dedup as op5
from tollgate.llm import periodic_runs as op13
from tollgate.llm import quality as op3
from tollgate.llm import ranked_search as op12
from tollgate.llm import substring_dedup as op2
from tollgate.llm import token_output as op7
from tollgate.llm import toxicity as op11
from tollgate.llm import url_filter as op10
from tollgate.llm.staging import workers_import_this

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import_this(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return register


@query("op1_exact_dedup", op1.ORACLE_SQL)
def q_exact_dedup(spark, d):
    return op1.exact_dedup(table(spark, d, "documents"))


@query("op8_license_scan", op8.ORACLE_SQL)
def q_license_scan(spark, d):
    return op8.license_scan(table(spark, d, "documents"))


@query("op10_url_filter", op10.ORACLE_SQL)
def q_url_filter(spark, d):
    return op10.url_filter(table(spark, d, "pages"), op10.fixed_rules(spark))


@query("op5_near_dedup", op5.ORACLE_SQL)
def q_near_dedup(spark, d):
    return op5.near_dedup(table(spark, d, "documents")).drop("content")


@query("op7_token_output")
def q_token_output(spark, d):
    return op7.token_output(table(spark, d, "documents"))


@query("op9_decontamination", op9.ORACLE_SQL)
def q_decontamination(spark, d):
    return op9.contamination(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("content")


@query("op4_language_id")
def q_language_id(spark, d):
    return op4.language_id(table(spark, d, "documents"))


@query("op3_quality")
def q_quality(spark, d):
    return op3.quality(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op2_substring_dedup")
def q_substring_dedup(spark, d):
    return op2.repeated_passages(table(spark, d, "documents"))


@query("op6_mixing")
def q_mixing(spark, d):
    return op6.document_rates(table(spark, d, "documents"), op6.quality_domains(table(spark, d, "labels")))


@query("op11_toxicity")
def q_toxicity(spark, d):
    return op11.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op12_ranked_search", op12.ORACLE_SQL)
def q_ranked_search(spark, d):
    return op12.ranked_search(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op13_periodic_runs")
def q_periodic_runs(spark, d):
    return op13.run_digests(op13.periodic_runs(table(spark, d, "documents"), rewrite=op13.planted_repeats))
