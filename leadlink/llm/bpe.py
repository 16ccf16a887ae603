"""Token ids of whole texts, cut into pre-tokens first and encoded once per distinct pre-token and worker.

A tokenizer encodes each pre-token on its own, so the ids of a text are its pre-tokens' ids in order. Splitting and
looking up is several times faster than encoding, and each distinct pre-token is encoded by the tokenizers library once
per worker process (a bounded cache; of a full one, the pre-tokens met again stay). The short cut is taken only where it is provably the same: for the two public
splitting rules below, and for texts whose characters are Latin letters, digits, punctuation and signs, without the
start of a special token. Every other text is encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import cached_property

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from leadlink.llm.common import per_worker, ship

ship(__name__)

SPACES = "\t\n\x0b\x0c\r \x85\xa0"
CACHE = 300_000
#: An entry of _Words takes less than a third of the memory of one in a dictionary.
WORDS = 3


def _byte_letters() -> np.ndarray:
    """The visible character by which a byte-level tokenizer writes each byte; the blank stays, it parts words here."""
    out = np.arange(256, dtype="<u2")
    hidden = [b for b in range(256) if not (32 < b < 127 or 160 < b and b != 173)]
    out[hidden] = 256 + np.arange(len(hidden))
    out[32] = 32
    return out


BYTES = _byte_letters()


def _letters(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


def _splitter(spec: dict):
    """(pattern, lower) for the rules known here, else None."""
    letter, digit = _letters("L"), _letters("N")
    pre, norm = spec["pre_tokenizer"], spec["normalizer"]
    if norm is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{SPACES}{letter}{digit}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
        ), False
    steps = [n["type"] for n in norm["normalizers"]] if norm and norm["type"] == "Sequence" else []
    if steps == ["NFC", "Replace", "Lowercase"] and pre["type"] == "Sequence" and pre["pretokenizers"][0]["pattern"] == {
        "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    }:
        return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^{SPACES}{letter}{digit}]+"), True
    return None


#: Characters of which the classes above know everything: Latin, general punctuation, currency signs.
_UNKNOWN = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]")


class Coder:
    def __init__(self, path: str, cache: int = CACHE):
        self.path = path
        with open(path) as f:
            spec = json.load(f)
        self.rule = _splitter(spec)
        self.special = [t["content"][:2] for t in spec["added_tokens"]]
        self.limit = cache
        self.known: dict[str, bytes] = {}
        self.words = _Words(self._encode_words, WORDS * cache) if self.rule is not None and self.rule[1] else None
        self.closing = self._closing(spec["model"])
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

    @staticmethod
    def _closing(model: dict) -> np.ndarray | None:
        """Whether an id ends a word, if the ids show it: every last byte carries the suffix and none else does."""
        vocab, suffix = model.get("vocab"), model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not suffix or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")):
            return None
        if any(chr(c) + tail not in vocab for c in BYTES if c != 32 for tail in ("", suffix)):
            return None
        closing = np.zeros(1 + max(vocab.values()), bool)
        closing[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return closing

    @cached_property
    def inner(self) -> Tokenizer:
        """For pre-tokens: they are normalised and split already, the library has only bytes and merges left to do."""
        inner = Tokenizer.from_file(self.path)
        if self.rule is not None:
            inner.normalizer = normalizers.Sequence([])
            inner.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return inner

    @cached_property
    def merger(self) -> Tokenizer:
        """For words between blanks whose bytes are written as letters already: only merges are left to do."""
        merger = Tokenizer.from_file(self.path)
        merger.normalizer = normalizers.Sequence([])
        merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        return merger

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """The tokenizer as it is, for whole texts; few workers need it."""
        return Tokenizer.from_file(self.path)

    def pieces(self, text: str) -> list[str] | None:
        """The pre-tokens of a text, None if only the library may split it."""
        if self.rule is None or any(s in text for s in self.special):
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if _UNKNOWN.search(text):
                return None
        pattern, lower = self.rule
        return pattern.findall(text.lower() if lower else text)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens in a row, where each one's begin, and the end)."""
        done = self.inner.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        words = np.array([-1 if w is None else w for w in done.word_ids], dtype=np.int64)
        return np.array(done.ids, dtype="<u4"), np.searchsorted(words, np.arange(len(pieces) + 1))

    def _encode_words(self, words: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each); one blank between words, none in them."""
        if self.closing is not None:
            letters = BYTES[np.frombuffer(words.encode(), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(self.merger.encode_batch_fast([letters], add_special_tokens=False)[0].ids, dtype="<u4")
            return ids, np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)
        ids, begin = self._encode(words.split(" "))
        return ids, np.diff(begin)

    def lengths(self, pieces: list[str]) -> list[int]:
        """Number of ids of each pre-token."""
        return np.diff(self._encode(pieces)[1]).tolist()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list = [None] * len(texts)
        plain: list[tuple[int, bytes]] = []
        for k, text in enumerate(texts):
            if self.words is not None and not any(s in text for s in self.special):
                try:
                    plain.append((k, text.lower().encode("latin-1")))
                    continue
                except UnicodeEncodeError:
                    pass
            out[k] = self._encode_pieces(text)
        while plain:
            n, size = 0, 0
            while n < len(plain) and size < 1 << 19:
                size += len(plain[n][1])
                n += 1
            for (k, _), ids in zip(plain[:n], self.words.encode([raw for _, raw in plain[:n]]), strict=True):
                out[k] = ids if ids is not None else self._encode_pieces(texts[k])
            del plain[:n]
        return out

    def _encode_pieces(self, text: str) -> bytes:
        parts = self.pieces(text)
        if parts is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if missing := list({p for p in parts if p not in self.known}):
            if len(self.known) + len(missing) > self.limit:
                self.known.clear()
                missing = list(set(parts))
            for k in range(0, len(missing), 20_000):
                part = missing[k : k + 20_000]
                ids, begin = self._encode(part)
                raw, at = ids.tobytes(), (begin * 4).tolist()
                self.known.update((w, raw[a:b]) for w, a, b in zip(part, at, at[1:], strict=False))
        return b"".join(map(self.known.__getitem__, parts))


def _spots(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    ends = np.cumsum(size)
    spots = np.repeat(begin - (ends - size), size)
    spots += np.arange(len(spots))
    return spots


class _Words:
    """Ids of lower-case Latin-1 texts, many at a time: numpy finds, hashes and looks up the words, the library encodes new ones.

    Words are told apart by a 64-bit polynomial hash of at most LONGEST bytes; a text with a longer word is left to the
    caller. Known words are in an open hash table (numpy arrays, half empty at least). When it is full, those met in a
    batch after their first stay, up to half of the limit; the others, most of them met once, go.
    """

    LONGEST = 256
    SPACE, LETTER, DIGIT, OTHER = range(4)

    def __init__(self, encode, limit: int):
        self.encode_words, self.limit = encode, limit
        kinds = []
        for c in map(chr, range(256)):
            kind = unicodedata.category(c)[0]
            kinds.append(self.SPACE if c in SPACES else self.LETTER if kind == "L" else self.DIGIT if kind == "N" else self.OTHER)
        self.kind = np.array(kinds, np.uint8)
        rng = np.random.default_rng(1)
        self.value = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        base = 0x9E3779B97F4A7C15
        self.factor = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self.forget()

    def forget(self) -> None:
        self.known, self.used = 0, 0
        self.slot, self.shift = np.full(4096, -1, np.int32), np.uint64(64 - 12)
        self.mark, self.again = np.zeros(1024, np.uint64), np.zeros(1024, bool)
        self.begin, self.size, self.ids = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(4096, np.uint32)

    def _write(self, name: str, at: int, new) -> None:
        old = getattr(self, name)
        if len(old) < at + len(new):
            setattr(self, name, np.concatenate([old, np.zeros(max(at + len(new) - len(old), len(old) // 4), old.dtype)]))
        getattr(self, name)[at : at + len(new)] = new

    def _find(self, mark: np.ndarray) -> np.ndarray:
        """Where each word is, -1 for words not known."""
        at = (mark >> self.shift).astype(np.int64)
        place = self.slot[at]
        left = np.flatnonzero((place >= 0) & (self.mark[place] != mark))
        while len(left):
            at[left] = step = (at[left] + 1) & (len(self.slot) - 1)
            place[left] = found = self.slot[step]
            left = left[(found >= 0) & (self.mark[found] != mark[left])]
        return place

    def _enter(self, first: int) -> None:
        """Put the words from place `first` on into the hash table."""
        place = np.arange(first, self.known, dtype=np.int32)
        at = (self.mark[first : self.known] >> self.shift).astype(np.int64)
        while len(place):
            free = self.slot[at] < 0
            self.slot[at[free]] = place[free]
            left = self.slot[at] != place  # taken, also by another one of these words
            place, at = place[left], (at[left] + 1) & (len(self.slot) - 1)

    def _add(self, mark: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Learn words not known, each once."""
        first = self.known
        for name, new in (("mark", mark), ("begin", self.used + np.cumsum(size) - size), ("size", size), ("again", np.zeros(len(mark), bool))):
            self._write(name, first, new)
        self._write("ids", self.used, ids)
        self.known, self.used = first + len(mark), self.used + len(ids)
        if 2 * self.known > len(self.slot):
            bits = int(2 * self.known).bit_length()
            self.slot, self.shift, first = np.full(1 << bits, -1, np.int32), np.uint64(64 - bits), 0
        self._enter(first)

    def _thin(self) -> None:
        """Keep the words met again, as far as half of the limit goes."""
        keep = np.flatnonzero(self.again[: self.known])[: self.limit // 2]
        keep = keep[np.cumsum(self.size[keep]) <= 4 * self.limit]
        mark, size = self.mark[keep], self.size[keep]
        ids = self.ids[_spots(self.begin[keep], size)]
        self.forget()
        self._add(mark, size, ids)

    def _places(self, mark: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where each word is; new ones are encoded."""
        place = self._find(mark)
        self.again[place[place >= 0]] = True
        new = np.flatnonzero(place < 0)
        words, where = np.unique(mark[new], return_index=True)
        if self.known + len(words) > self.limit or self.used > 8 * self.limit:
            self._thin()
            place = self._find(mark)
            new = np.flatnonzero(place < 0)
            words, where = np.unique(mark[new], return_index=True)
        where = new[where]
        for k in range(0, len(words), 20_000):
            few = where[k : k + 20_000]
            size = end[few] - begin[few] + 1
            raw = data[_spots(begin[few], size)]
            raw[np.cumsum(size) - 1] = 32
            ids, size = self.encode_words(raw[:-1].tobytes().decode("latin-1"))
            self._add(words[k : k + 20_000], size, ids)
        place[new] = self._find(mark[new])
        return place

    def _power(self, n: int) -> list[np.ndarray]:
        if len(self.powers[0]) < n:
            self.powers = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, f)]).astype(np.uint64)) for f in self.factor]
        return self.powers

    def _cut(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every pre-token; data starts and ends with a space."""
        kind = self.kind[data]
        change = kind[1:] != kind[:-1]
        starts = np.empty(len(data), bool)
        starts[0] = False
        starts[1:] = change & (kind[1:] != self.SPACE) | (kind[1:] == self.DIGIT)
        ends = np.empty(len(data), bool)
        ends[0] = False
        ends[1:] = change & (kind[:-1] != self.SPACE) | (kind[:-1] == self.DIGIT)
        # A lone apostrophe takes s, t, m, d, re, ve or ll along.
        mark = np.flatnonzero((data[:-1] == 39) & starts[:-1] & (kind[1:] == self.LETTER))
        for at in mark.tolist():
            tail = bytes(data[at + 1 : at + 3])
            n = 2 if tail in (b"re", b"ve", b"ll") else 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 0
            if n:
                starts[at + 1] = ends[at + 1] = False
                ends[at + 1 + n] = True
                starts[at + 1 + n] |= kind[at + 1 + n] == self.LETTER
        return np.flatnonzero(starts), np.flatnonzero(ends)

    def encode(self, texts: list[bytes]) -> list[bytes | None]:
        data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        begin, end = self._cut(data)
        first = np.cumsum([1] + [len(t) + 1 for t in texts])  # where each text starts
        fits = end - begin <= self.LONGEST
        long = set((np.searchsorted(first, begin[~fits], side="right") - 1).tolist())
        begin, end = begin[fits], end[fits]
        word_at = np.searchsorted(begin, first)
        forth, back = self._power(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * forth[: len(data)], out=total[1:])
        at = self._places((total[end] - total[begin]) * back[begin], data, begin, end)
        size = self.size[at].astype(np.int64)
        ids = self.ids[_spots(self.begin[at], size)].astype("<u4")
        bounds = np.concatenate([[0], np.cumsum(size)])[word_at].tolist()
        return [None if k in long else ids[a:b].tobytes() for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]


def coder(path: str) -> Coder:
    """The worker's coder for this tokenizer file."""
    return per_worker(("coder", path), lambda: Coder(path))
