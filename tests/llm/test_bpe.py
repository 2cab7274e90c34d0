import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from covey.llm import bpe
from covey.llm.queries import BYTE_BPE, op2_byte_bpe
from tests.llm.fixtures import make_docs, table_dir

PATTERN = public_tokenizers.PATTERN
PARTS = ["a", "e", "th", "'", "s", " ", "  ", "\n", "1", "é", "ß", "!", "re", "'re", "中", "_", "²", "😀", "\t"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.coder(BYTE_BPE, PATTERN).ranks, special_tokens={}
    )


def _texts(n, most):
    pick = random.Random(3)
    return ["".join(pick.choices(PARTS[: pick.randint(1, len(PARTS))], k=pick.randint(0, most))) for _ in range(n)]


def test_small_leaves_force_joins(library, monkeypatch):
    monkeypatch.setattr(bpe, "_LEAF_CHARS", 16)
    monkeypatch.setattr(bpe, "_LEAF_BYTES", 6)
    coder = bpe.ByteBpe(BYTE_BPE, PATTERN)
    for text in _texts(600, 250):
        ids = coder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_one_long_piece(library):
    text = "ab" * 5000 + " " * 3000 + "x" + "\n" * 500
    assert bpe.coder(BYTE_BPE, PATTERN).encode(text).tolist() == library.encode_ordinary(text)


def test_rows_of_every_kind(spark, library):
    """Null and empty texts, repeated rows, null and repeated ids, texts in many segments."""
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x y"), (4, "word's " * 300), (4, "other " * 299)]
    docs = make_docs(spark, rows + [(10 + i, t) for i, t in enumerate(_texts(20, 400))])
    got = bpe.encode(docs, BYTE_BPE, PATTERN, segment_chars=100).collect()
    want = sorted((str(r.doc_id), library.encode_ordinary(r.text or "")) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert bpe.encode_decode(docs.limit(0), BYTE_BPE, PATTERN).count() == 0
    both = bpe.encode_decode(docs, BYTE_BPE, PATTERN, segment_chars=100).collect()
    assert sorted((str(r.doc_id), r.ids) for r in both) == want
    texts = sorted((str(r.doc_id), (r.text or "").encode()) for r in docs.collect())
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in both) == texts


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 64])
def test_cuts_anywhere(library, monkeypatch, leaf):
    """Halves that end within words, numbers, white space and characters' runs."""
    monkeypatch.setattr(bpe, "_LEAF_CHARS", leaf)
    coder = bpe.ByteBpe(BYTE_BPE, PATTERN)
    texts = [*_texts(150, 120), "don't 'll stop''re  \n\n x12345678 y", "a", "", "ab" * 300 + "'s" + " " * 90 + "é" * 50]
    for text, ids in zip(texts, coder.encode_many(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)


def test_ordinary_documents_are_joined(spark, sf_dir, library):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(200).collect()]
    coder = bpe.ByteBpe(BYTE_BPE, PATTERN)
    for text, ids in zip(texts, coder.encode_many(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
    assert coder.joins >= sum(len(t) > 2048 for t in texts) > 20


def test_table_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "_KEPT_BYTES", 5_000)
    coder = bpe.ByteBpe(BYTE_BPE, PATTERN)
    for text in _texts(300, 250):
        assert coder.encode(text).tolist() == library.encode_ordinary(text)
        assert len(coder.seen) < 5_000 // 200 + 250


def test_query(spark, tmp_path, library):
    path = table_dir(tmp_path, spark, documents=make_docs(spark, [(1, "It's a tést"), (2, None)]))
    rows = {r.doc_id: r for r in op2_byte_bpe(spark, path).collect()}
    ids = " ".join(map(str, library.encode_ordinary("It's a tést")))
    assert rows[1].ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert rows[1].decoded_sha256 == hashlib.sha256("It's a tést".encode()).hexdigest()
    assert rows[2].n_tokens == 0 and rows[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
