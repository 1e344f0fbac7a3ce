"""The pipeline against the brute-force versions of its stages."""

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerlake.llm import common, queries

from . import test_decontam, test_linededup, test_packing, test_simhash

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = common.read(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    good = {r.doc_id for r in queries.op6_quality(spark, SF).collect() if r.predicted}
    rows = [r for r in rows if r[0] in good]
    clean = test_linededup.brute(rows)
    rows = [(d, clean[d, t][0]) for d, t in rows]
    first = {d for d, _, c in test_simhash.brute(rows) if d == c}
    rows = [r for r in rows if r[0] in first]
    bench = [(r.item_id, r.text) for r in common.read(spark, SF, "benchmark").collect()]
    bad = {d for d, *_ in test_decontam.brute(rows, bench)}
    rows = [r for r in rows if r[0] not in bad]
    want = test_packing.brute_pieces(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), rows)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    test_packing.check_bins(got)
    assert 0 < len(rows) < docs.count() and bad


def test_stages_keep_the_columns(spark):
    docs = common.read(spark, SF, "documents").limit(0)
    odd = spark.createDataFrame([(1, None, "en", None, None, "x", 2), (None, "text", None, "s", 4, None, None)],
                                "doc_id long, text string, lang string, source string, n_chars long, `__extra` string, label int")
    for some in (docs, odd):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, SF)
            assert out.columns == some.columns, name
            assert out.count() <= some.count()
        assert corpus_pipeline.STAGES[-1][1](spark, some, SF).count() == some.count()


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n in entry.queries() if n.startswith("op")] == [n for n in queries.QUERIES]
