"""Pieces, spans and texts against the library itself."""

import hashlib
import random

import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from demandtide.llm import pieces
from demandtide.llm.queries import QUERIES
from tests.conftest import SF

FILE = path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def _odd_texts(n=400):
    """Marks, white space, characters without a piece, compatibility forms, and a text of one part."""
    rnd = random.Random(3)
    alphabet = " ▁ab\n\té日😀<s>0x0A.é\u0000ｆ①ﬁ​㍿¨\u0007"
    return ["", " ", "  ", "▁", "\u0007", " \u0007 a  ", "x" * 5000, "日" * 3000, *["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]]


def _coded(spark, texts, model):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r["doc_id"]: r for r in pieces.encode(docs, model).collect()}


def _spans(processor, text):
    return [(p.id, p.begin, p.end) for p in processor.encode(text, return_type="proto").pieces]


def test_query_equals_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_pieces"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r["covered"] == len(texts[r["doc_id"]].encode())


@pytest.mark.parametrize("remembered, few", [(1 << 18, 64), (3, 64), (3, 0)])
def test_pieces_and_spans_equal_library(spark, library, monkeypatch, remembered, few):
    monkeypatch.setattr(pieces, "REMEMBERED", remembered)
    monkeypatch.setattr(pieces, "FEW", few)
    texts = _odd_texts()
    got = _coded(spark, texts, pieces.read_model(FILE))
    for i, text in enumerate(texts):
        size = len(text.encode())
        assert list(zip(got[i].ids, got[i].starts, got[i].ends)) == [*_spans(library, text), (2, size, size)]


@pytest.mark.parametrize("trim", [True, False])
@pytest.mark.parametrize("suffix", [True, False])
def test_character_map_equals_library(spark, trim, suffix):
    """The pieces of the given model behind the compatibility map of the library."""
    rules = sentencepiece_model_pb2.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(pieces.read_model(FILE))
    model.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = trim
    model.trainer_spec.treat_whitespace_as_suffix = suffix
    data = model.SerializeToString()
    processor = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = _odd_texts()
    got = _coded(spark, texts, data)
    for i, text in enumerate(texts):
        assert list(zip(got[i].ids, got[i].starts, got[i].ends))[:-1] == _spans(processor, text)


def test_decode_equals_library(spark, library):
    rnd = random.Random(5)
    lists = [[], [1, 2], [1, 28705, 28705, 264], [0, 264], *[[rnd.randrange(300) if rnd.random() < 0.5 else rnd.randrange(32000) for _ in range(rnd.randrange(12))] for _ in range(300)]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None)], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in pieces.decode(rows, pieces.read_model(FILE)).collect()}
    assert got.pop(-1) == ""
    for i, x in enumerate(lists):
        assert got[i] == library.decode(x), x


def test_odd_rows(spark):
    """Null ids and texts, repeated rows, columns named like the results, and no rows."""
    model = pieces.read_model(FILE)
    docs = spark.createDataFrame([(1, "a b", 7), (1, "a b", 7), (None, None, 8), (2, "", 9)], "doc_id int, text string, ids int")
    rows = sorted(((r["doc_id"] or 0, r["ids"], r["ends"]) for r in pieces.encode(docs, model).collect()))
    assert rows == [(0, [2], [0]), (1, [264, 287, 2], [1, 3, 3]), (1, [264, 287, 2], [1, 3, 3]), (2, [2], [0])]
    assert pieces.decode(pieces.encode(docs.limit(0), model), model).collect() == []
    with pytest.raises(Exception, match="outside the model"):
        pieces.decode(spark.range(1).select(F.array(F.lit(32000)).alias("ids")), model).collect()


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(pieces.read_model(FILE))
        model.trainer_spec.model_type = 1
        pieces.Model(model.SerializeToString())
