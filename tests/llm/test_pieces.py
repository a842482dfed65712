"""Encoding and decoding of pieces against the library whose model files these are."""

import hashlib
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as contract
from emberwatch.llm import pieces

MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
PARTS = [*"abcehtz", "the", " of", " ", "  ", "\t", "\n", "\x00", "▁", "é", "é", "Å", "ﬁ", "①", "ｶﾞ", "中", "文", "😀", "　", " ", "​", "ß", "x" * 70, "<s>", "<0x41>", "가", "ᄀ", "ᅡ"]


def _number(value):
    made = b""
    while value > 127:
        made += bytes([value & 127 | 128])
        value >>= 7
    return made + bytes([value])


def _field(number, data):
    return bytes([number << 3 | 2]) + _number(len(data)) + data


def changed_model(rules, prefix, collapse):
    """The model with other normalisation: later parts of a message override earlier ones."""
    made = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    charmap = dict(pieces._fields(dict(pieces._fields(made))[3]))[2]
    return MODEL + _field(3, (_field(2, charmap) if rules else b"") + bytes([0x18, prefix, 0x20, collapse]))


def some_texts(count):
    rng = random.Random(11)
    fixed = ["", " ", "   ", "a", " a ", "a  b", "ab" * 400 + " x", "　", "​", "é" * 60, " ▁", "▁ ▁"]
    return fixed + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60))) for _ in range(count)]


@pytest.mark.parametrize("rules, prefix, collapse", [(0, 1, 0), (1, 1, 1), (1, 0, 0), (0, 0, 1)])
def test_ids_spans_and_text_are_those_of_the_library(rules, prefix, collapse):
    model = changed_model(rules, prefix, collapse)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.PieceModel(model)
    texts = some_texts(400)
    for text, (ids, spans) in zip(texts, own.encode_all(texts), strict=True):
        wanted = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [piece.id for piece in wanted], text
        assert spans.tolist() == [[piece.begin, piece.end] for piece in wanted], text
        assert own.decode(ids) == library.decode(ids.tolist()), text


def test_any_ids_decode_as_the_library_does():
    library, own = sentencepiece.SentencePieceProcessor(model_proto=MODEL), pieces.PieceModel(MODEL)
    rng = random.Random(12)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(259), rng.randrange(3)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, int)) == library.decode(ids), ids


def test_the_three_ways_to_merge_agree():
    own = pieces.PieceModel(MODEL)
    rng = random.Random(13)
    for _ in range(300):
        word = "".join(rng.choice("aeinorst▁lthe") for _ in range(rng.randint(1, 40)))
        short = own._joined(own._merge_short(word))
        assert short == own._joined(own._merge_long(word)) == dict(own._merge_many([word]))[word]


def test_a_forgetful_task_gives_the_same(monkeypatch):
    texts = some_texts(60)
    whole = [ids.tolist() for ids, _ in pieces.PieceModel(MODEL).encode_all(texts)]
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    own = pieces.PieceModel(MODEL)
    assert [own.encode(text)[0].tolist() for text in texts] == whole


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.PieceModel(MODEL + _field(2, bytes([0x18, 1])))  # unigram
    with pytest.raises(ValueError):
        pieces.PieceModel(MODEL + _field(1, _field(1, b"odd") + bytes([0x18, 4])))  # user-defined piece


def test_awkward_rows(spark):
    rows = [(1, "one two", "a", b"x"), (1, "one two", "a", b"x"), (None, None, None, None), (3, "", "b", None), (4, "x" * 300_000 + " end", "c", b"y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Ids string, decoded binary")
    coded = pieces.encode(docs, MODEL)
    assert coded.columns == ["doc_id", "text", "decoded", "ids", "spans"]
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    read = pieces.decode(coded, MODEL)
    assert read.columns == ["doc_id", "text", "ids", "spans", "decoded"]
    got = read.collect()
    assert len(got) == 5
    same = pieces.encode(docs, MODEL, read_back=True)
    assert same.columns == read.columns and sorted(map(str, same.collect())) == sorted(map(str, got))
    for row in got:
        wanted = library.encode(row.text or "", add_bos=True, add_eos=True)
        assert pieces.unpacked(row.ids) == wanted and row.decoded == library.decode(wanted) == (row.text or "")
        assert len(pieces.unpacked(row.spans)) == 2 * len(wanted)
    assert pieces.encode(docs.limit(0), MODEL, keep_text=False).columns == ["doc_id", "decoded", "ids", "spans"]
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
    nothing = pieces.decode(docs.select(F.lit(None).cast("binary").alias("ids")), MODEL).collect()
    assert all(row.decoded == "" for row in nothing)


def test_query(spark, folder):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = contract.queries()["op11_pieces"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_bos=True, add_eos=True)
        packed, text = np.array(ids, "<u4").tobytes(), library.decode(ids).encode()
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text).hexdigest())
