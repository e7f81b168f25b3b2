import functools
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe

ODD = [
    "", None, "<|endoftext|> a", "x<|ENDOFTEXT|>y <|startoftext|>", "ΑΣ ΑΣ. ΟΔΟΣ", "a b ̈x c\x1cd\x85e", "É." * 50 + "x" * 3000,
    "don't I'LL 's", "Ⅷ ① ½ 漢字。かな", "👍🏽 ok", "İ. KK", "\x00 a\x00b", "a .\n b. , c", "é. ×. é, x", "… . a. b,\nc", " \n\t ", "word " * 60_000,
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer_path())


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False) if ids else ""
    return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def run(texts, **options):
    encoder = bpe.Encoder(bpe.default_tokenizer_path(), **options)
    raw = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    return list(encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets))


def test_equals_library(spark, make_docs, tokenizer, sf001_texts):
    rows = list(enumerate(ODD)) + [(1000 + i, t) for i, t in sf001_texts.items()] + [(1000, sf001_texts[0])]
    got = sorted(tuple(r) for r in bpe.encoding_digests(make_docs(rows)).collect())
    assert got == sorted((i, *expected(tokenizer, t)) for i, t in rows)


def test_full_output_round_trip(spark, make_docs, tokenizer):
    rows = list(enumerate(ODD))
    for r in bpe.encode_documents(make_docs(rows)).collect():
        ids = tokenizer.encode(ODD[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == (tokenizer.decode(ids, skip_special_tokens=False) if ids else "")


def test_decoding_ids(spark, make_docs):
    encoded = bpe.encode_documents(make_docs(list(enumerate(ODD))))
    want = {r["doc_id"]: r["decoded"] for r in encoded.collect()}
    assert {r["doc_id"]: r["decoded"] for r in bpe.decode_documents(encoded.selectExpr("*", "'x' AS text")).collect()} == want
    assert bpe.decode_documents(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).where("decoded <> ''").count() == 0


def test_empty_table(spark, make_docs):
    assert bpe.encoding_digests(make_docs([])).collect() == []


@functools.cache
def _shared():
    return bpe.Encoder(bpe.default_tokenizer_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB .,\n'sé×…́<|>9 漢ΣİK-"), max_size=80), min_size=1, max_size=4))
def test_joins_are_repaired(texts):
    encoder = _shared()
    tokenizer = encoder.tokenizer
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    for text, (ids, decoded) in zip(texts, encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode() == (tokenizer.decode(want, skip_special_tokens=False) if want else "")


def test_chunks_are_shared_and_caches_bounded(sf001_texts):
    long = max((t for t in sf001_texts.values() if t), key=len)
    encoder = bpe.Encoder(bpe.default_tokenizer_path())
    raw = [long.encode(), ("Another start. " + long).encode()]
    offsets = np.array([0, len(raw[0]), len(raw[0]) + len(raw[1])])
    list(encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets))
    assert len(encoder.chunks) <= len(bpe.cuts(np.frombuffer(raw[0], np.uint8))) + 5  # all but the first chunk are shared
    assert [run([t], chunk_bytes=1000, word_bytes=1000) for t in (long, long)] == [run([long])] * 2


def test_long_words_leave_no_memory(spark):
    """A run without white space is one word, however long: it is encoded, not kept."""
    encoder = bpe.Encoder(bpe.default_tokenizer_path())
    raw = ("漢字仮名交じり文" * 40_000).encode()
    (ids, _), = encoder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(raw.decode(), add_special_tokens=False).ids
    kept = sum(len(k) + len(v[0]) + len(v[1]) for k, v in encoder.words.items()) + sum(map(len, encoder.chunks))
    assert kept < 3 * len(raw) and all(len(w) <= bpe.LONGEST_WORD for w in encoder.words)
    encoder.forget()
    assert not encoder.words and not encoder.chunks


def test_cased_tokenizer_gets_texts_as_they_are(tmp_path):
    """Without lower-casing and stop splitting in the tokenizer, the shortcuts are off."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = {w: i for i, w in enumerate(["a", "b,", ".", "Hello", "hello", "hello.", "[U]"])}
    own = Tokenizer(models.WordLevel(vocab, unk_token="[U]"))
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    own.save(path := str(tmp_path / "cased.json"))
    encoder = bpe.Encoder(path)
    assert (encoder.lowers, encoder.splits_stops) == (False, False)
    text = "Hello hello. Hello a . b, Hello " * 200
    raw = text.encode()
    (ids, _), = encoder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids
