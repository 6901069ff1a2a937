import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm.bpe import Encoder, Vocabulary, decode_documents, decode_ids, encode_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = Vocabulary(PATH)
ENCODER = Encoder(VOCABULARY)
PEER = Tokenizer.from_file(PATH)


def same(text):
    ids = PEER.encode(text, add_special_tokens=False).ids
    mine = ENCODER.encode(text)
    assert list(memoryview(mine).cast("I")) == ids
    assert decode_ids(VOCABULARY, mine) == PEER.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["the ", "'ll", " don't", "\n\n", "  ", "\x1c", "\x85", "é", "ß12", "<|endoftext|>", "<|end", "aaaaaaa", "日本", "​", "🙂"])))
def test_pieces(parts):
    same("".join(parts))


def test_long_word():
    same("abcab" * 4000)
    same(" " * 5000 + "x")


def test_frame(spark):
    rows = [(1, "The <|endoftext|> end", 5), (2, None, 6), (3, "", 7), (None, "  tab\tß", 8), (1, "The <|endoftext|> end", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS int")
    out = decode_documents(encode_documents(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.decoded, r.n_tokens) for r in out) == sorted(
        (i or 0, t or "", t or "", len(PEER.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows
    )
    assert encode_documents(docs.limit(0), PATH).count() == 0


def test_query(spark):
    from barloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op1_bpe"](spark, folder).collect():
        ids = PEER.encode(texts[r.doc_id], add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(PEER.decode(ids, skip_special_tokens=False).encode()).hexdigest()

