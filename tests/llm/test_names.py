"""Columns of the input that are called like an operator's own ones pass through unchanged."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import common, decontam, linededup, packing, quality, queries, simhash

SF = "/root/testdata/sf0.001"
NAMES = ["doc", "key", "runs", "more", "id", "gone", "nth", "score", "bytes", "item", "hash", "__doc", "__key", "__id", "__nth",
         "__score", "__runs", "__more", "__gone", "__bytes_of_text", "_doc", "_key", "KEY", "value", "fp", "text_key", "n", "grams", "d", "k", "i"]


@pytest.fixture(scope="module")
def docs(spark):
    own = [n for n in NAMES if n != "KEY"]
    return common.read(spark, SF, "documents").select("doc_id", "text", *(F.concat(F.lit(f"mine {n} "), F.col("doc_id")).alias(n) for n in own))


STAGES = {
    "quality": lambda spark, docs: quality.keep_good(docs, "text", queries.quality_model(spark, SF, docs), threshold=0.3),
    "lines": lambda spark, docs: linededup.dedup(docs, "doc_id", "text", min_words=50),
    "lines with spans": lambda spark, docs: linededup.dedup(docs, "doc_id", "text", min_words=50, spans_col="removed").drop("removed"),
    "simhash": lambda spark, docs: simhash.keep_one(docs, "doc_id", "text", shingle=3, max_bits=3),
    "benchmark": lambda spark, docs: decontam.keep_clean(docs, common.read(spark, SF, "benchmark"), "doc_id", "text"),
}


@pytest.mark.parametrize("stage", STAGES)
def test_reserved_names(spark, docs, stage):
    plain = {r.doc_id: r.text for r in STAGES[stage](spark, docs.select("doc_id", "text")).collect()}
    got = STAGES[stage](spark, docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r.doc_id: r.text for r in rows} == plain and len(rows) == len(plain)
    assert all(r[n] == f"mine {n} {r.doc_id}" for r in rows for n in docs.columns[2:])


def test_added_columns_take_the_place_of_others(spark, docs):
    some = docs.select("doc_id", "text", F.lit("old").alias("removed"), F.lit("old").alias("Score"))
    assert linededup.dedup(some, "doc_id", "text", spans_col="removed").columns == ["doc_id", "text", "Score", "removed"]
    scored = quality.with_score(some, "text", queries.quality_model(spark, SF, some), "score")
    assert scored.columns == ["doc_id", "text", "removed", "score"] and scored.schema["score"].dataType.typeName() == "double"


def test_packing_ignores_other_columns(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    some = docs.filter("doc_id < 20")
    got, want = (packing.pieces(d, "doc_id", "text", path) for d in (some, some.select("doc_id", "text")))
    assert sorted(got.collect()) == sorted(want.collect())
