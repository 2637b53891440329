"""Exact ids of a byte-level BPE tokenizer file, with a bounded cache of text pieces.

The tokenizer first splits text by a fixed pattern and merges bytes inside each part only. Some
part borders can be told from single bytes: before a blank that a non-blank follows, around a
single line feed, and between an ASCII letter and an ASCII mark. Pieces cut there repeat far more
often than texts, so numpy cuts and hashes them, the library encodes each new piece, and ids of a
text are gathered from the cache. The hash only finds a piece: its bytes are compared with those that
were encoded, and texts of a batch in which two pieces share a hash go through the library whole, as do texts
with other white space.

A new piece of letters only is one part, so the library's model merges its bytes without the pattern. When the cache is
full, pieces that came again stay and the others go.
"""

from __future__ import annotations

import contextlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from colonnade.llm.common import same_spans, span_hashes

#: White space other than the blank and the line feed.
ODD_SPACE = re.compile(r"[^\S \n]")
#: Marks that never join an ASCII letter next to them (no apostrophe: it begins contractions).
MARKS = b".,;:!?#$%&*|()[]{}\"-_=+/<>@^~`\\"

CACHE_PIECES = 400_000  # entries a worker holds (about 80 bytes each); a full cache drops those that did not come again

RUN = 32  # pieces encoded as one string
CALL = 128  # such strings in one call: the library's result takes a few hundred bytes a token
TEXT_BYTES = 1 << 19  # of regular texts cut and looked up at a time (one long text may exceed it)

IS_MARK = np.zeros(256, bool)
IS_MARK[list(MARKS)] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[65:91] = IS_LETTER[97:123] = True
#: Bytes of ASCII letters and of U+00C0 to U+023F, which are letters too but for U+00D7 and U+00F7 (0xC3 0x97, 0xC3 0xB7).
IN_WORD = IS_LETTER.copy()
IN_WORD[0xC3:0xC9] = IN_WORD[0x80:0xC0] = True


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones of Latin-1 for themselves,
    the others in turn from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_lengths(tokenizer) -> np.ndarray:
    """Bytes that each id stands for: in byte-level vocabularies one character is one byte."""
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    return np.array([len(tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)


def regular(text: str) -> bool:
    """Each white space is one blank or line feed before a non-blank character."""
    return not (text[-1].isspace() or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
                or ODD_SPACE.search(text))


def piece_starts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of regular texts."""
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    line = raw == 10
    cut[:n] = line | (raw == 32)
    cut[1:] |= line
    letter, mark = IS_LETTER[raw], IS_MARK[raw]
    cut[1:n] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    cut[off[:-1]] = True
    return np.flatnonzero(cut[:n])


def places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, ``count`` of them, one run after the other."""
    ends = np.cumsum(count, dtype=np.int64)
    return np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values in order, where each comes first, and the number of each element's value; most repeat, so only
    different ones are sorted."""
    coded = pa.array(h).dictionary_encode()
    keys, number = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    first = np.empty(len(keys), np.int64)
    first[number[::-1]] = np.arange(len(h))[::-1]
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    return keys[order], first[order], rank[number]


def words_only(data: bytes, start: np.ndarray) -> np.ndarray:
    """Whether each piece (none is empty) has letters up to U+023F only, with or without a blank before: the pattern
    leaves such a piece whole."""
    raw = np.frombuffer(data, np.uint8)
    other = ~IN_WORD[raw]
    other[1:] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
    size = np.append(start[1:], len(raw)) - start
    other[start[(raw[start] == 32) & (size > 1)]] = False
    return ~np.logical_or.reduceat(other, start)


class PieceEncoder:
    """Ids equal to the library's ``encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.lengths = byte_lengths(self.tokenizer)
        self.letters = Tokenizer(self.tokenizer.model)  # the same merges, for parts in byte characters, a line each
        self.letters.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.characters = byte_characters() | {10: "\n"}
        cut = self.tokenizer.pre_tokenizer
        self.by_word = (self.tokenizer.normalizer is None and isinstance(cut, pre_tokenizers.ByteLevel)
                        and cut.use_regex and not cut.add_prefix_space)  # another pattern may cut words
        self.cache_pieces = cache_pieces
        self.keys = np.zeros(0, np.uint64)
        self.lo = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.place = np.zeros(0, np.int64)  # of the piece in ``bytes``
        self.size = np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)  # whether the piece came again since it was added or last kept
        self.bytes = np.zeros(1 << 16, np.uint8)
        self.held = 0
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        with contextlib.suppress(AttributeError):  # its own cache only slows new pieces down
            self.tokenizer.model._resize_cache(0)

    @property
    def vocab_size(self) -> int:
        return len(self.lengths)

    def whole(self, text: str) -> np.ndarray:
        """Straight through the library."""
        e = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(e.ids, np.uint32)

    def run_ids(self, runs: list[str]) -> np.ndarray:
        """Ids of the strings one after the other."""
        found = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        return np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)

    def letter_ids(self, runs: list[str]) -> np.ndarray:
        """Ids of the lines, each a part in byte characters, one after the other."""
        found = self.letters.encode_batch_fast(runs, add_special_tokens=False)
        return np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)

    def new_ids(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        if not self.by_word:
            return self.new_others(new)
        size = np.array([len(p) for p in new], np.int64)
        plain = words_only(b"".join(new), np.cumsum(size) - size)
        count = np.zeros(len(new), np.int64)
        found = []
        for kind, ids_of in ((plain, self.new_words), (~plain, self.new_others)):
            chosen = np.flatnonzero(kind).tolist()
            ids, count[kind] = ids_of([new[i] for i in chosen]) if chosen else (np.zeros(0, np.uint32), 0)
            found.append(ids)
        of_plain = np.repeat(plain, count)
        out = np.empty(len(of_plain), np.uint32)
        out[of_plain], out[~of_plain] = found
        return out, count

    def new_words(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``new_ids`` for pieces of letters: byte lengths tell the ids apart."""
        runs = [b"\n".join(new[i:i + RUN]).decode("latin-1").translate(self.characters) for i in range(0, len(new), RUN)]
        ids = np.concatenate([self.letter_ids(runs[i:i + CALL]) for i in range(0, len(runs), CALL)])
        ends, want = np.cumsum(self.lengths[ids]), np.cumsum([len(p) for p in new])
        at = np.searchsorted(ends, want)
        if (at < len(ends)).all() and (ends[at] == want).all() and ends[-1] == want[-1]:
            return ids, np.diff(at, prepend=-1)
        return self.each_ids(new)

    def new_others(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``new_ids`` for any pieces. A line feed between two pieces is a part of its own, so one call encodes all;
        byte lengths tell the ids apart."""
        sizes = np.array([len(p) for p in new], np.int64)
        runs = [b"\n".join(new[i:i + RUN]).decode() + "\n" for i in range(0, len(new), RUN)]
        runs[-1] = runs[-1][:-1]
        ids = np.concatenate([self.run_ids(runs[i:i + CALL]) for i in range(0, len(runs), CALL)])
        ends = np.cumsum(self.lengths[ids])
        want = np.cumsum(sizes + 1) - 1
        at = np.searchsorted(ends, want)
        first = np.searchsorted(ends, want - sizes, "right")
        if (at < len(ends)).all() and (ends[at] == want).all() and (first == np.r_[0, at[:-1] + 2]).all():
            keep = np.ones(len(ids), bool)
            keep[at[:-1] + 1] = False
            return ids[keep], at + 1 - first
        return self.each_ids(new)

    def each_ids(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``new_ids`` by one call a piece."""
        each = [self.whole(p.decode()) for p in new]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def add(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray, data: bytes, size: np.ndarray) -> None:
        """Append ids and bytes to the pools; ``keys`` are sorted and new."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        while self.held + len(data) > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros(len(self.bytes), np.uint8)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.bytes[self.held:self.held + len(data)] = np.frombuffer(data, np.uint8)
        lo, place = self.used + np.cumsum(count) - count, self.held + np.cumsum(size) - size
        self.used += len(ids)
        self.held += len(data)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.lo, self.count = np.insert(self.keys, at, keys), np.insert(self.lo, at, lo), np.insert(self.count, at, count)
        self.place, self.size = np.insert(self.place, at, place), np.insert(self.size, at, size)
        self.again = np.insert(self.again, at, False)

    def forget(self) -> None:
        """Keep the pieces that came again, but at most about half of what the cache may hold: hashes are like random
        numbers, so every n-th of them is a fair choice."""
        kept = np.flatnonzero(self.again)
        most = max(1, self.cache_pieces // 2)
        kept = kept[::max(1, -(-len(kept) // most))]
        self.keys, self.lo, self.count, self.place, self.size = (x[kept] for x in (self.keys, self.lo, self.count, self.place, self.size))
        self.again = np.zeros(len(kept), bool)
        ids, data = self.pool[places(self.lo, self.count)], self.bytes[places(self.place, self.size)]
        self.used, self.held = len(ids), len(data)
        self.pool[:self.used], self.bytes[:self.held] = ids, data
        self.lo, self.place = (np.cumsum(n, dtype=np.int64) - n for n in (self.count, self.size))

    def encode_regular(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all texts one after the other, and n + 1 offsets into them; None if two pieces share a hash."""
        start = piece_starts(raw, off)
        size = np.append(start[1:], len(raw)) - start
        h = span_hashes(raw, start, start + size)
        keys, first, inverse = distinct(h)
        long = size > 8  # shorter ones cannot collide at one size
        origin = first[inverse]
        if (size != size[origin]).any() or not same_spans(raw, start[long], raw, start[origin[long]], size[long]).all():
            return None
        at = np.searchsorted(self.keys, keys)
        missing = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        missing[inside] = self.keys[at[inside]] != keys[inside]
        known, own = at[~missing], first[~missing]
        if (self.size[known] != size[own]).any() or not same_spans(self.bytes[:self.held], self.place[known], raw, start[own], size[own]).all():
            return None
        self.again[known] = True
        if missing.any():
            if len(self.keys) > self.cache_pieces:
                self.forget()
                return self.encode_regular(raw, off)
            data = raw.tobytes()
            s, n = start[first[missing]], size[first[missing]]
            new = [data[a:b] for a, b in zip(s.tolist(), (s + n).tolist())]
            line = [i for i, p in enumerate(new) if p == b"\n"]
            ids, count = self.new_ids([p if p != b"\n" else b"." for p in new])
            if line:
                each = np.split(ids, np.cumsum(count)[:-1])
                for i in line:
                    each[i] = self.whole("\n")
                ids, count = np.concatenate(each), np.array([len(x) for x in each], np.int64)
            self.add(keys[missing], ids, count, b"".join(new), n)
            at = np.searchsorted(self.keys, keys)
        count = self.count[at][inverse].astype(np.int64)
        ids = self.pool[places(self.lo[at][inverse], count)]
        return ids, np.append(0, np.cumsum(count))[np.searchsorted(start, off)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; none for null."""
        out = [np.zeros(0, np.uint32)] * len(texts)
        plain, size = [], 0

        def flush():
            if not plain:
                return
            data = [texts[i].encode() for i in plain]
            off = np.zeros(len(data) + 1, np.int64)
            np.cumsum([len(d) for d in data], out=off[1:])
            found = self.encode_regular(np.frombuffer(b"".join(data), np.uint8), off)
            if found is None:
                for i in plain:
                    out[i] = self.whole(texts[i])
            else:
                ids, at = found
                for i, lo, hi in zip(plain, at[:-1].tolist(), at[1:].tolist()):
                    out[i] = ids[lo:hi]
            plain.clear()

        for i, text in enumerate(texts):
            if text:
                if regular(text):
                    if size + len(text) > TEXT_BYTES:
                        flush()
                        size = 0
                    plain.append(i)
                    size += len(text)
                else:
                    out[i] = self.whole(text)
        flush()
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizer files are."""
    import public_tokenizers

    return public_tokenizers.path(name)
