"""Operators marked native run no Python on the executors."""

import re

from pyspark.sql import functions as F

from cadenza.llm import quality_rules, url_filter


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_operators_have_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ledger = quality_rules.ledger(docs)
    rules = docs.where(quality_rules.passes("v1", quality_rules.failures(F.col("text"))))
    for df in (ledger, quality_rules.ablations(ledger), rules, url_filter.op8_url_filter(spark, sf_dir)):
        assert not re.search(r"Python|Arrow|Pandas", physical(df))
    assert "Exchange" not in physical(ledger) and "Exchange" not in physical(rules)
    assert re.findall(r"ReadSchema: struct<([^>]*)>", physical(quality_rules.op4_quality_rules(spark, sf_dir))) == ["doc_id:bigint,text:string"]
