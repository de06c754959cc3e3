"""SentencePiece operator against the library."""

import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from conftest import SF001, SF01  # noqa: E402
from tidecast.llm import piece_bpe, queries  # noqa: E402

PATH = public_tokenizers.path(queries.PIECE_FILE)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(PATH)


def ids_of(model, text):
    import numpy as np
    return np.frombuffer(model.encode(text), "<i4").tolist()


def test_fuzz_equals_the_library(library, model):
    rnd = random.Random(1)
    bits = ["a", "b", "the", " ", "  ", "▁", "\n", "\t", ".", "...", "é", "日本", "☃", "\U0001F600", "�", "\x00", "<0x41>", "<s>", "ing", "1", "    ", "──",
            "'s", "Привет", "({", "//", "́", " ", "　", "الس", "er", "==", "──", "—"]
    pieces = list(model.vocabulary)
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8))) for _ in range(8000)]
    texts += [c * k for c in " a-─" for k in (1, 2, 15, 16, 17, 33, 500)]
    assert [ids_of(model, t) for t in texts] == library.encode(texts, num_threads=1)


def test_one_word_of_a_whole_text(library, model):
    """Cutting into words changes nothing, and a long text without a border is one word."""
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgin tr") for _ in range(3000)).replace(" ", piece_bpe.SPACE)
    tokens = model.tokens(piece_bpe.SPACE + text)
    assert [model.vocabulary[t][1] for t in tokens] == library.encode(text, num_threads=1)
    assert ids_of(model, "x" * 50_000) == library.encode("x" * 50_000, num_threads=1)


def test_adjacent_tokens_decide(model):
    """A sequence whose neighbours fit is what merging the whole word gives."""
    rnd = random.Random(3)
    for _ in range(300):
        word = "".join(rnd.choice("ethinrsao") for _ in range(rnd.randint(1, 14)))
        assert model.tokens(word) == model.merge(word)


def test_any_ids_decode_as_the_library_does(library, model):
    import pyarrow as pa
    rnd = random.Random(4)
    rows = [[rnd.choice([rnd.randrange(32000), rnd.randrange(300), 259, 28705, 0, 1, 2]) for _ in range(rnd.randint(0, 12))] for _ in range(5000)]
    assert model.decode(pa.array(rows, pa.list_(pa.int32()))).to_pylist() == [library.decode(r) for r in rows]


def test_cases_and_columns(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, " ", "x"), (3, " ", "x"), (4, "\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = piece_bpe.encode(docs, model)
    assert out.columns == ["doc_id", "ids", "n_tokens"]
    assert sorted((r.doc_id, list(r.ids), r.n_tokens) for r in out.collect()) == [(1, [], 0), (2, [], 0), (3, [259], 1), (3, [259], 1), (4, [28705, 13], 2)]
    back = piece_bpe.decode(out, model, out="n_tokens")
    assert sorted((r.doc_id, r.n_tokens) for r in back.collect()) == [(1, ""), (2, ""), (3, " "), (3, " "), (4, "\n")]
    strange = spark.createDataFrame([([None, -5, 99999, 259],), (None,)], "ids array<int>")
    assert sorted(r.text for r in piece_bpe.decode(strange, model).collect()) == ["", " "]
    assert piece_bpe.decode(piece_bpe.encode(docs.limit(0), model), model).collect() == []


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "unigram.model"
    path.write_bytes(b"\x12\x02\x18\x01")  # a trainer field that says unigram
    with pytest.raises(ValueError):
        piece_bpe.PieceModel(str(path))


def test_query_equals_the_library(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {}
    for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", num_threads=1)
        expected[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_sentencepiece(spark, SF01).collect()}
    assert got == expected and SF001
