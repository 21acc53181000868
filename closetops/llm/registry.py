"""The registered queries of this subpackage and their SQL for DuckDB, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import (cascade, classifier, convtrie, decontaminate, htmltemplate, linededup, mixing, secretscan, sharding, simhash,
               spelling, suffixtree, warc)
from .oracle_sql import SQL as _SQL


def _over(f: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _over(mixing.op1, "documents"),
    "op2_simhash": _over(simhash.op2, "documents"),
    "op3_warc": _over(warc.op3, "pages"),
    "op4_quality_rules": _over(cascade.op4, "documents"),
    "op5_sharding": _over(sharding.op5, "documents"),
    "op6_quality_classifier": _over(classifier.op6, "documents", "labels"),
    "op7_decontamination": _over(decontaminate.op7, "documents", "benchmark"),
    "op8_line_dedup": _over(linededup.op8, "documents"),
    "op9_html_extraction": _over(htmltemplate.op9, "pages"),
    "op10_secret_scan": _over(secretscan.op10, "documents"),
    "op11_lm_scoring": _over(suffixtree.op11, "documents"),
    "op12_conversation_trie": _over(convtrie.op12, "conversations"),
    "op13_spelling_variants": _over(spelling.op13, "documents"),
    "pipeline": corpus_pipeline.run,
}
SQL = {**_SQL, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
