"""Operator 1: BPE encoding and decoding with content-defined chunk reuse.

Each text's bytes are cut where a rolling hash of the last ``WINDOW`` bytes
meets a mask, so equal passages in different texts yield equal chunks wherever
they stand. A task encodes each distinct chunk once and keeps the result (a
bounded cache). A cut falls anywhere, also inside a word or a character, so
only the chunk's *body* - what lies between its first and last ASCII white
space - is trusted: the tokenizer drops white space and never merges across
it, hence no text outside the chunk can change the body's ids. The join of two
chunks is repaired by re-encoding from the end of the left body to the start
of the right one; a chunk with no white space widens the repair into the next
chunk until both sides agree. Words met before are taken from a second bounded
cache; only new ones reach the tokenizer.

The result equals encoding each whole text with the tokenizers library
(``add_special_tokens=False``; truncation and padding off) and decoding with
``skip_special_tokens=False``. The scheme holds for tokenizers that drop white
space before merging; ``check_tokenizer`` tests this property on load.

Defined results: null text counts as empty; an empty text has no ids, an empty
decoded text and the hashes of the empty string; repeated rows are encoded row
by row; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import table, text_slices, trimmed
from tessera.llm.merges import WordEncoder

WINDOW = 16
CHUNK_BITS = 9  # cuts lie 512 bytes apart on average
#: Bytes of Python memory that a task's caches of chunks and of words may take.
CHUNK_CACHE_BYTES = 32 << 20
WORD_CACHE_BYTES = 80 << 20
#: What an entry takes besides its contents; longer words and chunks are not kept.
CHUNK_ENTRY_BYTES, WORD_ENTRY_BYTES = 450, 330
LONGEST_CHUNK, LONGEST_WORD = 8192, 256

DIGEST_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
FULL_SCHEMA = "doc_id bigint, ids array<int>, decoded string"


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions of the content-defined cuts in ``data`` (ascending)."""
    if len(data) <= WINDOW:
        return np.zeros(0, np.int64)
    # A 32-bit rolling hash: each byte's value is shifted out after 16 steps.
    value = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(2654435761)
    h = value.copy()
    width = 1
    while width < WINDOW:  # h[i] covers the `width` bytes that end at i; double it
        h[width:] = h[width:] + h[:-width] * np.uint32(pow(2246822519, width, 1 << 32))
        width *= 2
    found = np.flatnonzero((h >> np.uint32(32 - CHUNK_BITS)) == 0) + 1
    return found[(found >= WINDOW) & (found < len(data))]


_SPACE = re.compile(rb"[ \t-\r]")
#: A stop or comma before white space that may not stand after a letter.
_NOT_AFTER_LETTER = re.compile(rb"(?<![A-Za-z])(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])[.,][ \n]")


def split_words(chunk: bytes, stops: bool = True) -> tuple[bytes, list[bytes], bytes] | None:
    """The open start of a chunk, the words of its body, and its open end;
    None without white space. With ``stops`` (the tokenizer splits there),
    where all final stops and commas of the body follow letters, they are
    words of their own."""
    found = _SPACE.search(chunk)
    if not found:
        return None
    lo = found.start()
    hi = max(chunk.rfind(c) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
    body = chunk[lo : hi + 1]
    if stops and not _NOT_AFTER_LETTER.search(body):
        body = body.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" . ").replace(b",\n", b" , ")
    return chunk[:lo], body.split(), chunk[hi + 1 :]


class Encoder:
    """Encodes batches of texts; ids and decoded text come as bytes."""

    def __init__(self, path: str, chunk_bytes: int = CHUNK_CACHE_BYTES, word_bytes: int = WORD_CACHE_BYTES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lowers, self.splits_stops = check_tokenizer(self.tokenizer)
        top = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.token = [(self.tokenizer.id_to_token(i) or "").encode() + b" " for i in range(top)]
        self.distinct = WordEncoder(self.tokenizer, self.lowers)
        self.chunk_limit, self.word_limit = chunk_bytes, word_bytes
        self.forget()

    def forget(self) -> None:
        """Empty the caches (at the end of a task: a pooled worker serves
        other operators' tasks next)."""
        self.words: dict[bytes, tuple[bytes, bytes]] = {}
        self.chunks: dict[bytes, tuple[bytes, bytes, bytes, bytes] | None] = {}
        self.word_size = self.chunk_size = 0

    def _learn(self, new: set[bytes]) -> None:
        """Encode words that the cache lacks."""
        if not new:
            return
        words, token, known = list(new), self.token, self.words
        size = np.array([len(w) for w in words], np.int64)
        ids, counts = self.distinct.encode(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)
        raw, each, lo = ids.astype("<u4").tobytes(), ids.tolist(), 0
        for w, n in zip(words, counts.tolist()):
            known[w] = (raw[4 * lo : 4 * (lo + n)], b"".join([token[i] for i in each[lo : lo + n]]))
            lo += n

    def _encode_words(self, words: list[bytes]) -> tuple[bytes, bytes]:
        got = [self.words[w] for w in words]
        return b"".join([g[0] for g in got]), b"".join([g[1] for g in got])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        """Per text: its ids as little-endian unsigned 32-bit integers, and
        the decoded text in UTF-8."""
        if self.word_size > self.word_limit:
            self.words, self.word_size = {}, 0
        if self.chunk_size > self.chunk_limit:
            self.chunks, self.chunk_size = {}, 0
        raw = data.tobytes()
        if self.lowers and b"<|" not in raw:  # else a special token might appear by lowering
            raw = raw.lower()  # ASCII letters, as the tokenizer does itself
        at = np.unique(np.concatenate([cuts(data), offsets]))
        # Rolling-hash windows that reach over a text's start are not content
        # of that text alone; such cuts are dropped so that chunks are shared.
        owner = np.searchsorted(offsets, at, "right") - 1
        owner_start = offsets[np.minimum(owner, len(offsets) - 1)]
        at = at[(at - owner_start >= WINDOW) | np.isin(at, offsets)]
        bounds = at.tolist()
        pieces = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        split: dict[bytes, tuple[bytes, list[bytes], bytes] | None] = {}
        for p in set(pieces):
            if p not in self.chunks:
                split[p] = split_words(p, self.splits_stops)
        # Lay the texts out as bodies and join words.
        first = np.searchsorted(at, offsets).tolist()
        plans: list[list] = []
        new: set[bytes] = set()
        bodies: dict[bytes, tuple[bytes, list[bytes], bytes] | None] = {}
        for p, words in split.items():
            bodies[p] = words
            if words:
                new.update(words[1])
        known, chunks = self.words, self.chunks
        for a, b in zip(first, first[1:]):
            plan: list = []
            carry = b""
            for p in pieces[a:b]:
                body = bodies[p] if p in bodies else chunks[p]
                if body is None:
                    carry += p
                    continue
                carry += body[0]
                if carry:
                    plan.append(carry)
                    new.add(carry)
                plan.append((p,))
                carry = body[-1]
            if carry:
                plan.append(carry)
                new.add(carry)
            plans.append(plan)
        fresh = {w for w in new if w not in known}
        self._learn(fresh)
        for p, body in bodies.items():
            if body is None:
                chunks[p] = None
                self.chunk_size += len(p) + CHUNK_ENTRY_BYTES
            else:
                ids, decoded = self._encode_words(body[1])
                chunks[p] = (body[0], ids, decoded, body[2])
                self.chunk_size += 2 * len(p) + len(ids) + len(decoded) + CHUNK_ENTRY_BYTES
        for plan in plans:
            got = [chunks[x[0]][1:3] if type(x) is tuple else known[x] for x in plan]
            yield b"".join([g[0] for g in got]), b"".join([g[1] for g in got])[:-1]
        for w in fresh:
            ids, decoded = known[w] if len(w) <= LONGEST_WORD else known.pop(w)
            if len(w) <= LONGEST_WORD:
                self.word_size += len(w) + len(ids) + len(decoded) + WORD_ENTRY_BYTES
        for p in bodies:
            if len(p) > LONGEST_CHUNK:
                chunks.pop(p)


def check_tokenizer(tokenizer) -> tuple[bool, bool]:
    """Fail unless ids are independent on both sides of ASCII white space and
    decoding joins token strings with one space. Says whether the tokenizer
    lower-cases ASCII letters itself, and whether it splits a final stop or
    comma off a letter; a tokenizer that doesn't is fed texts as they are."""
    enc = lambda s: tokenizer.encode(s, add_special_tokens=False).ids
    probes = ["Abc", "x-1", "café.", "'s", "42"]
    for a in probes:
        for b in probes:
            for gap in (" ", "\n", "\t \r", "\x0b\x0c"):
                if enc(a + gap + b) != enc(a) + enc(b):
                    raise ValueError("the tokenizer keeps white space or merges across it; chunk joins can't be repaired at white space")
    ids = enc("Abc café 42")
    if tokenizer.decode(ids, skip_special_tokens=False) != " ".join(tokenizer.id_to_token(i) for i in ids):
        raise ValueError("the tokenizer's decoder does more than join token strings")
    letters = "abcdefghijklmnopqrstuvwxyz"
    cased = [letters.upper(), *letters.upper(), *(f"{c.upper()}{d}" for c, d in zip(letters, letters[1:])), "Hello World", "McDONALD'S"]
    lowers = all(enc(w) == enc(w.lower()) for w in cased)
    stops = all(enc(f"{w}{stop}{gap}") == enc(f"{w} {stop}") for w in (*letters, *letters.upper(), "word", "café", "Ünß") for stop in ".," for gap in " \n")
    return lowers, stops


#: Bytes of text that are encoded in one round (a longer text goes alone).
ROUND_BYTES = 1 << 20
#: One encoder for a worker process; its caches serve one task.
_ENCODERS: dict[str, Encoder] = {}


def _run(docs: DataFrame, path: str | None, schema: str, make) -> DataFrame:
    path = path or default_tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        try:
            for batch in batches:
                ids = batch.column(0)
                for lo, hi, data, offsets in text_slices(batch.column(1), ROUND_BYTES):
                    yield make(ids.slice(lo, hi - lo), list(encoder.encode(data, offsets)))
        finally:
            encoder.forget()

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), schema)


def encode_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded text of every row."""

    def make(doc_ids: pa.Array, got: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        ids = pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i, _ in got], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), ids, pa.array([d.decode() for _, d in got], pa.string())], ["doc_id", "ids", "decoded"])

    return _run(docs, tokenizer_path, FULL_SCHEMA, make)


def decode_documents(encoded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id and the decoded text of every row of (doc_id, ids); null ids
    count as none. An id outside the vocabulary fails the job."""
    path = tokenizer_path or default_tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = (_ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))).token
        for batch in batches:
            lists = [ids or [] for ids in batch.column(1).to_pylist()]
            if any(min(ids) < 0 for ids in lists if ids):
                raise IndexError("negative token id")
            texts = [b"".join([token[i] for i in ids])[:-1].decode() for ids in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded string")


def encoding_digests(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; ids and
    decoded texts are hashed where they are made and never leave the task."""
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def make(doc_ids: pa.Array, got: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        columns = [
            doc_ids.cast(pa.int64()),
            pa.array([len(i) // 4 for i, _ in got], pa.int64()),
            pa.array([sha(i) for i, _ in got], pa.string()),
            pa.array([sha(d) for _, d in got], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _run(docs, tokenizer_path, DIGEST_SCHEMA, make)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"))
