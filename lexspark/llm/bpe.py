"""Byte-pair encoding by the tokenizers library, with a bounded table of its pre-tokens.

Both vocabularies merge inside pre-tokens only, so a text's ids are those of its pre-tokens in a row. Texts within
U+0000..U+024F, whose letters, digits and spaces no Unicode version moves, are split here by array operations and
looked up by a 64-bit hash, whose hits are compared with the entry's characters; any other text, and any that holds an
added token's string, goes to the library whole. The library's model encodes every pre-token that the table lacks, that is
longer than LONGEST characters, or whose hash another one holds. A full table is emptied: that costs time, no result.
"""

from __future__ import annotations

import codecs
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np

_TOP = 0x250
_EDGE = 0x2FF  # stands between texts; no text that is split here holds it
_SPACE, _LETTER, _NUMBER, _OTHER, _STOP = range(5)
_WHITE = {9, 10, 11, 12, 13, 32, 0x85, 0xA0}
_CLASS = np.full(_EDGE + 1, _STOP, np.uint8)
_CLASS[:_TOP] = [_SPACE if c in _WHITE else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(_TOP)]
_LOWER = np.arange(_EDGE + 1, dtype=np.uint16)
_LOWER[:_TOP] = [ord(x) if len(x := chr(c).lower()) == 1 and ord(x) < _TOP else _EDGE for c in range(_TOP)]
_ODD = {chr(c) for c in range(_TOP) if _LOWER[c] == _EDGE}  # lower case leaves the range
# the printable signs that byte-level vocabularies write bytes with
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_MARKS = {c: chr(256 + k) for k, c in enumerate(c for c in range(256) if c not in _PLAIN)}
_SIGNS = "".join(_MARKS.get(c, chr(c)) for c in range(256))
_HIGH = re.compile(f"[^\x00-{chr(_TOP - 1)}]")
_CHARS = 1 << 19
LONGEST = 64  # characters of a pre-token that the table takes
_HELD_CHARS = 1 << 24  # characters of all entries
_R = 0x9E3779B97F4A7C15
_POWERS = np.ones(0, np.uint64)
_BACK = np.ones(0, np.uint64)


def _powers(n: int) -> None:
    global _POWERS, _BACK
    if len(_POWERS) < n:
        n = max(n, _CHARS + (1 << 16))
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.full(n, _R, np.uint64))
            _BACK = np.cumprod(np.full(n, pow(_R, -1, 1 << 64), np.uint64))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] for each span: differences of one running sum, brought to a common power."""
    _powers(len(values) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(values)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * _BACK[starts] + (ends - starts).astype(np.uint64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _spread(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each span, n of them, one span after the other."""
    ends = np.cumsum(n, dtype=np.int64)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)  # a batch's ids and characters are few enough
    out += np.repeat((starts - ends + n).astype(np.int32), n)
    return out


class _Table:
    """Open addressing over 64-bit hashes; each entry has a row number. 0 marks an empty place."""

    def __init__(self, bits: int):
        self.bits, self.rows = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.row = np.zeros(1 << bits, np.int32)

    def _place(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where there is none."""
        at, out = self._place(h), np.full(len(h), -1, np.int32)
        key = self.keys[at]
        hit = key == h
        out[hit] = self.row[at[hit]]
        left = np.flatnonzero(~hit & (key != 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            key = self.keys[at[left]]
            hit = key == h[left]
            out[left[hit]] = self.row[at[left[hit]]]
            left = left[~hit & (key != 0)]
        return out

    def add(self, h: np.ndarray) -> None:
        """Distinct new hashes get the next rows, in order."""
        at, left = self._place(h), np.arange(len(h))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.row[at[won]] = h[won], self.rows + won
            left = np.setdiff1d(left, won, assume_unique=True)
            taken = left[self.keys[at[left]] != 0]
            at[taken] = (at[taken] + 1) & (len(self.keys) - 1)
        self.rows += len(h)


class PretokenEncoder:
    """kind 'byte': byte-level BPE without a normaliser; 'word': lower-cased BPE with word ends."""

    def __init__(self, path: str, kind: str, table_bits: int = 21):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind, self.table_bits = kind, table_bits
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._empty()

    def _empty(self) -> None:
        self.table = _Table(self.table_bits)
        self.flat, self.used = np.empty(1 << 16, self.dtype), 0
        self.start, self.length = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int32)
        self.chars, self.held = np.empty(1 << 16, np.uint16), 0  # the entries' characters
        self.first, self.size = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int32)

    def _own(self, text: str) -> bool:
        """True where the array path splits this text as the library does."""
        if any(s in text for s in self.special):
            return False
        return text.isascii() or (not _HIGH.search(text) and not (self.kind == "word" and any(c in text for c in _ODD)))

    def _cut(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens."""
        kind = _CLASS[code]
        first = np.empty(len(code), bool)
        first[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        space = kind == _SPACE
        # a lone apostrophe before s, t, re, ve, m, ll or d
        quote = np.flatnonzero(code == 39)
        if len(quote):
            pad = np.concatenate([code, np.full(3, _EDGE, code.dtype)])
            a, b = pad[quote + 1], pad[quote + 2]
            tail = np.where(np.isin(a, [115, 116, 109, 100]), 1, np.where(((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108), 2, 0))
            ok = (tail > 0) & first[quote]
            if self.kind == "byte":
                ok &= (quote == 0) | (code[quote - 1] != 32)
            quote, tail = quote[ok], tail[ok]
        if self.kind == "byte":
            last = np.flatnonzero(space[:-1] & ~space[1:] & (kind[1:] != _STOP))  # of white space before something
            first[last] = True
            first[last[code[last] == 32] + 1] = False
        else:
            first |= kind == _NUMBER
        if len(quote):
            first[quote + 1] = False
            first[np.minimum(quote + 1 + tail, len(code) - 1)] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(code))
        drop = kind[starts] == _STOP
        if self.kind == "word":
            drop |= space[starts]
        return starts[~drop], ends[~drop]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens in a row, and how many each has: the library's model alone, as they are cut and normalised."""
        if self.kind == "word":
            words = [w.lower() for w in words]
        # 0xff stands in no UTF-8
        signs = codecs.charmap_decode(b"\xff".join([w.encode() for w in words]), "strict", _SIGNS)[0].split("\xff")
        tokenize = self.model.tokenize
        found = [tokenize(w) for w in signs[: len(words)]]
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([t.id for f in found for t in f], self.dtype), n

    def _put(self, new: np.ndarray) -> None:
        """Ids behind those in use; they last until the table takes further entries."""
        while len(self.flat) < self.used + len(new):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(new)] = new

    def _learn(self, hashes: np.ndarray, words: list[str], code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        new, n = self._encode(words)
        rows, size = self.table.rows, ends - starts
        self._put(new)
        while len(self.start) < rows + len(n):
            self.start, self.length, self.first, self.size = (np.concatenate([x, np.empty_like(x)]) for x in (self.start, self.length, self.first, self.size))
        while len(self.chars) < self.held + int(size.sum()):
            self.chars = np.concatenate([self.chars, np.empty_like(self.chars)])
        part = slice(rows, rows + len(n))
        self.start[part], self.length[part] = self.used + np.cumsum(n) - n, n
        self.first[part], self.size[part] = self.held + np.cumsum(size) - size, size
        self.chars[self.held : self.held + int(size.sum())] = code[_spread(starts, size)]
        self.table.add(hashes)
        self.used += len(new)
        self.held += int(size.sum())

    def _same(self, row: np.ndarray, code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether each span's characters are those of its entry."""
        size = ends - starts
        same = self.size[row] == size
        k = np.flatnonzero(same) if not same.all() else slice(None)
        size, starts, first = size[k], starts[k], self.first[row[k]]
        at = _spread(starts, size)
        given = code[at]
        at += np.repeat((first - starts).astype(np.int32), size)
        unequal = self.chars[at] != given
        if unequal.any():
            same[np.repeat(np.arange(len(row))[k], size)[unequal]] = False
        return same

    def _spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all pre-tokens: where their ids begin in flat, how many they are, and of which text each is."""
        joined = chr(_EDGE).join(texts)
        code = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
        if self.kind == "word":
            code = _LOWER[code]
        starts, ends = self._cut(code)
        at, n = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        own = ends - starts <= LONGEST
        mine = np.flatnonzero(own)
        s, e = starts[mine], ends[mine]
        h = span_hashes(code, s, e)
        h[h == 0] = 1
        row = self.table.find(h)
        lack = np.flatnonzero(row < 0)
        if len(lack):
            new, which = np.unique(h[lack], return_index=True)
            which = lack[which]
            if self.table.rows + len(new) > (1 << self.table_bits) // 2 or self.held + int((e - s)[which].sum()) > _HELD_CHARS:
                self._empty()
                new, which = np.unique(h, return_index=True)
                lack = np.arange(len(h))
                while len(new) > (1 << self.table_bits) // 2:  # one batch fills the table: a larger one from here on
                    self.table_bits += 1
                    self._empty()
            words = [joined[i:j] for i, j in zip(s[which].tolist(), e[which].tolist())]
            self._learn(new, words, code, s[which], e[which])
            row[lack] = self.table.find(h[lack])
        same = self._same(row, code, s, e)
        at[mine], n[mine] = self.start[row], self.length[row]
        own[mine[~same]] = False
        rest = np.flatnonzero(~own)
        if len(rest):
            words = [joined[i:j] for i, j in zip(starts[rest].tolist(), ends[rest].tolist())]
            kinds = {w: k for k, w in enumerate(dict.fromkeys(words))}
            ids, many = self._encode(list(kinds))
            self._put(ids)
            which = np.fromiter((kinds[w] for w in words), np.int64, len(words))
            at[rest], n[rest] = (self.used + np.cumsum(many) - many)[which], many[which]
        bounds = np.cumsum([len(t) + 1 for t in texts])
        return at, n, np.searchsorted(bounds, starts, "right")

    def _groups(self, texts: list[str | None]) -> Iterator[list[str]]:
        part, held = [], 0
        for text in texts:
            part.append(text or "")
            held += len(part[-1])
            if held > _CHARS:
                yield part
                part, held = [], 0
        if part:
            yield part

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Number of ids of each whole text; null counts as empty."""
        out = []
        for part in self._groups(texts):
            own = [self._own(t) if t else False for t in part]
            _, many, of = self._spans([t if o else "" for t, o in zip(part, own)])
            n = np.bincount(of, many, len(part)).astype(np.int64)
            for k, (t, o) in enumerate(zip(part, own)):
                if t and not o:
                    n[k] = len(self.tokenizer.encode(t, add_special_tokens=False).ids)
            out.append(n)
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def batch(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each whole text, in order; null counts as empty."""
        for part in self._groups(texts):
            own = [self._own(t) if t else False for t in part]
            at, n, of = self._spans([t if o else "" for t, o in zip(part, own)])
            total = np.cumsum(n)
            ids = self.flat[_spread(at, n)]
            cut = np.concatenate([[0], total])[np.searchsorted(of, np.arange(len(part) + 1))]
            for k, (t, o) in enumerate(zip(part, own)):
                yield ids[cut[k] : cut[k + 1]] if o or not t else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.dtype)


_HELD: dict[tuple[str, str], PretokenEncoder] = {}


def encoder(path: str, kind: str) -> PretokenEncoder:
    """One encoder for each vocabulary in a Python worker, kept between tasks."""
    if (path, kind) not in _HELD:
        _HELD[path, kind] = PretokenEncoder(path, kind)
    return _HELD[path, kind]


def vocabulary(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
