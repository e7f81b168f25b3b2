"""Encoding many distinct words at once, for tokenizers that drop white space.

Words of common letters, digits and signs are cut in pieces, and the distinct
pieces go through the tokenizer's own merges together, by array operations
(``Merges``); all others, long ones, and all words of a tokenizer for which that
does not give the library's ids, go to the tokenizers library.
"""

from __future__ import annotations

import numpy as np

from tessera.llm.common import HASH_BYTES, mix

#: Longer words go to the library.
LONGEST_WORD = 256
_NEVER = np.iinfo(np.int64).max


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs ``starts[i] .. starts[i] + sizes[i]``, one run after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Merges:
    """The tokenizer's merges applied to many pieces of words at once.

    Pieces are runs of letters, runs of signs, or single digits, as the
    tokenizer cuts them. All their symbols lie in one array; in each step every
    piece applies its merge of the lowest rank, wherever it stands in the piece
    (of overlapping places the left one), until no piece has one left.
    """

    def __init__(self, tokenizer):
        import json

        spec = json.loads(tokenizer.to_str())["model"]
        vocab, merges = spec["vocab"], [m if isinstance(m, list) else m.split(" ", 1) for m in spec["merges"]]
        ends = spec["end_of_word_suffix"]
        names = [_byte_name(b) for b in range(256)]
        self.inner = np.array([vocab.get(c, -1) for c in names], np.int64)
        self.last = np.array([vocab.get(c + ends, -1) for c in names], np.int64)
        pairs = dict.fromkeys(vocab[a] << 32 | vocab[b] for a, b in reversed(merges))
        made = {vocab[a] << 32 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
        # Pairs by hash, in a table with a fifth of its places taken; a pair whose place is taken stands in the next free one.
        self.bits = max(4, (5 * len(pairs)).bit_length())
        self.pairs = np.full((1 << self.bits) + 64, -1, np.int64)
        self.rank, self.made = np.full(len(self.pairs), _NEVER, np.int64), np.zeros(len(self.pairs), np.int64)
        keys = np.array(list(pairs), np.int64)
        for key, at in zip(keys.tolist(), self._place(keys).tolist()):
            while self.pairs[at] >= 0:
                at += 1
            self.pairs[at], (self.rank[at], self.made[at]) = key, made[key]

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Where each pair stands in the table, or a free place."""
        at = self._place(key)
        found = self.pairs[at]
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] += 1
            found = self.pairs[at[open_]]
            open_ = open_[(found != key[open_]) & (found >= 0)]
        return at

    def encode(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of ``size`` bytes each, one piece after the other,
        and how many each has."""
        ends = np.cumsum(size)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        piece = np.repeat(np.arange(len(size)), size)
        at, rank = self._ranked(symbols, piece)
        done_symbols, done_piece = [], []
        while len(symbols):
            start = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(piece))))
            open_ = least != _NEVER
            done_symbols.append(symbols[~open_])
            done_piece.append(piece[~open_])
            # Of places that follow each other (a pair of equal symbols) every second one.
            here = np.flatnonzero((rank == least) & open_)
            if len(here):
                run = np.concatenate([[True], np.diff(here) > 1])
                count = np.arange(len(here))
                here = here[(count - np.maximum.accumulate(np.where(run, count, 0))) % 2 == 0]
            symbols[here] = self.made[at[here]]
            keep = open_
            keep[here + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, piece, at, rank = symbols[keep], piece[keep], at[keep], rank[keep]
            if len(here):
                for changed in (moved[here], np.maximum(moved[here] - 1, 0)):
                    at[changed], rank[changed] = self._ranked(symbols, piece, changed)
        symbols, piece = np.concatenate(done_symbols), np.concatenate(done_piece)
        order = np.argsort(piece, kind="stable")
        return symbols[order], np.bincount(piece, minlength=len(size))

    def _ranked(self, symbols: np.ndarray, piece: np.ndarray, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For (some) symbols, the merge with the symbol behind and its rank."""
        i = np.arange(len(symbols)) if places is None else places
        j = np.minimum(i + 1, len(symbols) - 1)
        at = self._find(symbols[i] << 32 | symbols[j])
        return at, np.where((piece[i] == piece[j]) & (j > i), self.rank[at], _NEVER)


def _byte_name(b: int) -> str:
    """The character that stands for a byte in a byte-level vocabulary:
    printable Latin-1 ones themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return chr(b) if b in plain else chr(0x100 + sum(x not in plain for x in range(b)))


#: Kinds of bytes in words that ``Merges`` takes: letters of ASCII and Latin-1,
#: digits, and ASCII signs without those of contractions and special tokens.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3]] = 1
_KIND[0x30:0x3A] = 2
_KIND[list(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{}~")] = 3


#: Words by which a tokenizer must show that ``Merges`` gives its ids, else it encodes all words itself.
_PROBES = ["the", "a", "aaaaaaa", "information", "ndaab", "xyzzyqj", "été", "straße", "ÉtÀÞ", "naïveté", "ñandú", "x1y22", "3,14%", "(word)", "a.b,c", "---", "!!!", "e-mail@host.org", "%%%$$$", "ababababab", "mississippi"]


class WordEncoder:
    """Ids of distinct words."""

    def __init__(self, tokenizer, lowers: bool):
        self.tokenizer, self.lowers = tokenizer, lowers
        self.merges = self._own_merges()

    def _own_merges(self) -> Merges | None:
        try:
            merges = Merges(self.tokenizer)
        except (KeyError, TypeError):  # not a byte-level BPE with word ends
            return None
        if not self.lowers or min(merges.inner.min(), merges.last.min()) < 0:
            return None
        probes = [w.encode() for w in _PROBES]
        size = np.array([len(w) for w in probes])
        ids, counts = self._by_pieces(np.frombuffer(b"".join(probes), np.uint8), size, merges)
        want = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in _PROBES]
        return merges if ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want] else None

    def _by_pieces(self, raw: np.ndarray, size: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words of ``size`` bytes each, and how many each has."""
        raw = raw.copy()
        after = np.flatnonzero(raw[:-1] == 0xC3) + 1
        after = after[(raw[after] <= 0x9E) & (raw[after] != 0x97)]
        raw[after] += 0x20  # Latin-1 capitals
        ends = np.cumsum(size)
        kind = _KIND[raw]
        first = np.ones(len(raw), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)  # a digit is a piece of its own
        first[ends[:-1]] = True
        start = np.flatnonzero(first)
        length = np.diff(np.append(start, len(raw)))
        stands, place = grouped(raw, start, start + length)
        ids, counts = merges.encode(raw[runs(start[stands], length[stands])], length[stands])
        at = np.cumsum(counts) - counts
        of = np.searchsorted(start, ends - size)  # each word's first piece
        return ids[runs(at[place], counts[place])], np.add.reduceat(counts[place], of)

    def encode(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words at ``start``, one word after the other, and how many each has."""
        flat = data[runs(start, size)]
        kind = _KIND[flat]
        # Two signs among these letters are none: their words go to the library.
        kind[1:][(flat[:-1] == 0xC3) & ((flat[1:] == 0x97) | (flat[1:] == 0xB7))] = 0
        if not len(size):
            return np.zeros(0, np.int64), size
        plain = (np.minimum.reduceat(kind, np.cumsum(size) - size) > 0) & (size <= LONGEST_WORD) & (self.merges is not None)
        which, ids, counts = [], [], []
        if plain.any():
            which.append(np.flatnonzero(plain))
            found = self._by_pieces(flat[np.repeat(plain, size)], size[plain], self.merges)
            ids.append(found[0])
            counts.append(found[1])
        if not plain.all():
            which.append(np.flatnonzero(~plain))
            raw = data.tobytes()
            words = [raw[a : a + n].decode("utf-8", "replace") for a, n in zip(start[~plain].tolist(), size[~plain].tolist())]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            counts.append(np.array([len(x) for x in got], np.int64))
            ids.append(np.fromiter((i for x in got for i in x), np.int64, int(counts[-1].sum())))
        order = np.argsort(np.concatenate(which))
        count = np.concatenate(counts)
        return np.concatenate(ids)[runs((np.cumsum(count) - count)[order], count[order])], count[order]


_SPACE = np.zeros(256, np.int8)
_SPACE[[0x20, *range(0x09, 0x0E)]] = 1


def words_at(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between ASCII white space and texts' bounds."""
    n = len(data)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = 1 - _SPACE[data]
    first, last = inside[1:] > inside[:-1], inside[1:] < inside[:-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    joined = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
    first[joined] = last[joined] = True
    return np.flatnonzero(first), np.flatnonzero(last)


def grouped(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct word, and each occurrence's place among
    them. Words are grouped by hash and then compared with the one that stands
    for them; should two words share a hash, the round is grouped by content."""
    _, first, place = np.unique(_word_hashes(data, start, end), return_index=True, return_inverse=True)
    size = end - start
    stands = first[place]
    same = bool((size == size[stands]).all())
    for a in range(0, len(start), 1 << 15):  # compare byte by byte, some words at a time
        if not same:
            break
        b = a + (1 << 15)
        step = np.arange(int(size[a:b].sum())) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
        same = bool((data[np.repeat(start[a:b], size[a:b]) + step] == data[np.repeat(start[stands[a:b]], size[a:b]) + step]).all())
    if same:
        return first, place
    raw, seen = data.tobytes(), {}
    place = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist())])
    return np.unique(place, return_index=True)[1], place


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: its 8-byte pieces, mixed one after the other."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    pieces = np.lib.stride_tricks.sliding_window_view(padded, 8)
    h = mix(size.astype(np.uint64))
    open_ = np.arange(len(start))
    done = 0
    while len(open_):
        at, left = start[open_] + done, size[open_] - done
        for lo in range(0, len(open_), HASH_BYTES):
            part = slice(lo, lo + HASH_BYTES)
            word = np.ascontiguousarray(pieces[at[part]]).view("<u8").ravel()
            short = left[part] < 8
            word[short] &= (np.uint64(1) << (8 * left[part][short]).astype(np.uint64)) - np.uint64(1)
            h[open_[part]] = mix(h[open_[part]] * np.uint64(0x9E3779B97F4A7C15) + word)
        done += 8
        open_ = open_[size[open_] > done]
    return h
