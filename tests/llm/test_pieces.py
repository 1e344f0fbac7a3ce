"""Piece encoding: same ids, byte spans and decoded texts as the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2, sentencepiece_pb2

from ledgerlake.llm import common, pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a  b  ", "▁", "a▁b ▁ c ▁▁", "<s> </s> <unk> <0x0A>", "\x00\n\t", "🙂🙂 é中文字符日本語" * 20, "x" * 100_000,
       " " * 50_000 + "a" + "\n" * 50_000, "�", "ﬁ①Ａ　é½ｶﾞ"]


def some_texts(n, seed=1):
    rng = random.Random(seed)
    letters = " ▁abcdeé中🙂\n\t<>s/0xAﬁ①Ａ　́e½ｶﾞ"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 80))) for _ in range(n)]


def spans(processor, text):
    found = sentencepiece_pb2.SentencePieceText()
    found.ParseFromString(processor.encode(text, out_type="serialized_proto"))
    return [(p.id, p.begin, p.end) for p in found.pieces]


def test_query_equals_the_library(spark):
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = {}
    for r in common.read(spark, SF, "documents").collect():
        ids = processor.encode(r.text or "", add_eos=True)
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(processor.decode(ids).encode()).hexdigest())
    got = queries.op11_sentencepiece(spark, SF).collect()
    assert len(got) == len(want)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("fallback", [False, True])
def test_compiled_character_maps(rule, squeeze, fallback):
    """Longest-prefix normalisation with offsets, on models that differ from the file in their settings."""
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    rules = sentencepiece_model_pb2.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    model.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = squeeze
    model.normalizer_spec.add_dummy_prefix = fallback
    model.trainer_spec.byte_fallback = fallback
    if not fallback:
        for p in model.pieces:
            if p.type == p.BYTE:
                p.type, p.score = p.NORMAL, -1e6
    raw = model.SerializeToString()
    processor, codec = sentencepiece.SentencePieceProcessor(model_proto=raw), pieces.PieceCodec(raw)
    texts = some_texts(400) + ODD
    for text, found in zip(texts, codec.encode_all(texts)):
        assert list(zip(*(v.tolist() for v in found))) == spans(processor, text)
        assert codec.decode(found[0].tolist()) == processor.decode(found[0].tolist())


def test_decoding_any_ids():
    processor, codec, rng = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.PieceCodec(open(PATH, "rb").read()), random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(259, 32000), 259, 29871])
               for _ in range(rng.randrange(0, 9))]
        assert codec.decode(ids) == processor.decode(ids)


def test_memory_of_parts_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "PART_CHARS", 200)
    processor, codec = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.PieceCodec(open(PATH, "rb").read())
    for text in some_texts(100, 3):
        assert codec.encode(text)[0].tolist() == processor.encode(text)
        assert codec.chars <= 200


def test_edge_cases(spark):
    rows = [(1, None, "x", 1), (2, "", "y", 2), (None, "a b", "z", 3), (2, "a b", "z", 4), (2, "a b", "z", 4), (3, "é", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, value int")
    out = pieces.decode(pieces.encode(docs, "text", PATH), "ids", PATH)
    assert out.columns == ["doc_id", "text", "value", "ids", "starts", "ends", "decoded"]
    got = sorted(((r.value, r.doc_id, r.text, len(r.ids), r.decoded) for r in out.collect()))
    assert got == [(1, 1, None, 1, ""), (2, 2, "", 1, ""), (3, None, "a b", 3, "a b"), (4, 2, "a b", 3, "a b"),
                   (4, 2, "a b", 3, "a b"), (5, 3, "é", 2, "é")]
    assert pieces.encode(docs.limit(0), "text", PATH).count() == 0
    numbers = spark.createDataFrame([(1, [9, None, 5]), (2, None)], "id int, ids array<int>")
    assert [r.decoded for r in pieces.decode(numbers.select("id", "ids"), "ids", PATH).filter("id = 2").collect()] == [""]


def test_only_pair_models():
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        pieces.PieceCodec(model.SerializeToString())
