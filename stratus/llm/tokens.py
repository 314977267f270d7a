"""Token ids of whole texts with the public tokenizers, as little-endian uint32.

Both tokenizers treat parts of a text independently, so the ids of each part
are looked up in a bounded per-process cache and only parts that are not in it
are encoded.  Texts of Latin letters are parted as the tokenizers themselves
do before their merges (word, number, punctuation), which keeps parts short and
often seen; other texts are parted between blanks.  Before that, texts are
split at the tokenizers' added tokens (<|endoftext|>), each of which is one id.
WordEncoder.each parts many texts of Latin letters at once and looks all their
words up together, in arrays.  tests/llm checks that the result equals encoding
the whole text.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

from stratus.llm.common import use_cache

_CACHE_MAX = 250_000
_GROUP = 1 << 20          # characters parted at once, whole texts
_GROUP_WORDS = 1 << 18    # words looked up at once
_SLOT_BITS = 20           # of the places for words of up to 15 bytes
_SPARE_IDS = 1 << 22      # ids kept before those of replaced words are dropped
_BLANKS = re.compile(r" (?:\s|\Z)")
_LONG = 64        # longer parts are not worth a place in the cache


def _latin(*categories: str) -> str:
    """The characters before U+0180 of these categories, for a character set."""
    return "".join(re.escape(c) for c in map(chr, range(0x180)) if unicodedata.category(c)[0] in categories)


# Below U+0180 no category depends on the Unicode version, composition changes
# nothing and lower-casing goes letter by letter, but for U+0130.
_OTHER_SCRIPT = re.compile("[\u0130\u0180-\U0010ffff]")
_L, _N, _S = _latin("L"), _latin("N"), r"\t-\r \x85\xa0"
_SHORT = "'(?:s|t|re|ve|m|ll|d)"
_WORD_PARTS = re.compile(f"[{_L}]+|[{_N}]|{_SHORT}|[^{_S}{_L}{_N}]+")
_BYTE_PARTS = re.compile(f" ?[{_L}]+| ?[{_N}]+|{_SHORT}| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

_BLANK, _LETTER, _NUMBER, _OTHER = range(4)
_KIND = np.full(0x180, _OTHER, np.uint8)
for _kind, _set in ((_BLANK, _S), (_LETTER, _L), (_NUMBER, _N)):
    _KIND[[ord(c) for c in re.findall(f"[{_set}]", "".join(map(chr, range(0x180))))]] = _kind


def _word_parts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """_WORD_PARTS over lower-cased UTF-8 below U+0180 that ends in three blanks:
    where each part starts and its bytes."""
    raw = np.frombuffer(text, np.uint8)
    kind = np.frombuffer(text.translate(_KIND[:256].tobytes()), np.uint8).copy()
    lead = np.flatnonzero(raw >= 0xC0)          # of two bytes each
    kind[lead] = kind[lead + 1] = _KIND[(raw[lead] & 31).astype(np.int64) << 6 | raw[lead + 1] & 63]
    cut = np.ones(len(raw), bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut |= kind == _NUMBER                      # each number is a part
    cut[lead + 1] = False
    # An apostrophe that starts a part takes these letters along.
    at = np.flatnonzero((raw[:-3] == ord("'")) & cut[:-3])
    a, b = raw[at + 1], raw[at + 2]
    one = at[np.isin(a, list(b"stmd"))]
    two = at[np.isin(a, list(b"rv")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))]
    cut[one + 1] = cut[two + 1] = False
    cut[one + 2] = cut[two + 3] = True
    at = np.flatnonzero(cut)
    part = kind[at] != _BLANK
    return at[part], np.diff(at, append=len(raw))[part]


def _runs(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """values[f:f + k] for each f of `first` and k of `n`, one after another."""
    end = np.cumsum(n)
    return values[np.repeat(first - (end - n), n) + np.arange(end[-1] if len(end) else 0)]


class _Known(dict):
    """part -> its ids; parts not seen yet are encoded when looked up.

    Once there are _CACHE_MAX entries they become the older half, of which
    what is used again moves over and the rest is dropped at the next turn.
    """

    def __init__(self, encode):
        super().__init__()
        self._encode, self._old = encode, {}

    def turn(self) -> None:
        if len(self) > _CACHE_MAX:
            self._old = dict(self)
            super().clear()

    def clear(self) -> None:
        super().clear()
        self._old = {}

    def __missing__(self, part: str) -> bytes:
        ids = self._old.get(part)
        if ids is None:
            ids = self._encode(part)
        if len(part) <= _LONG:
            self[part] = ids
        return ids


class _KnownWords(_Known):
    """Beside the parts of single texts, the words of many, looked up as arrays.

    A word of up to 15 bytes is its own key: its bytes and, in the sixteenth,
    their number.  It has one place (key, first id and number of ids), which
    the next word of that place takes over.  Longer words are encoded each time.
    """

    _MASK = np.array([[(1 << 8 * min(k, 8)) - 1, (1 << 8 * max(k - 8, 0)) - 1] for k in range(16)] + [[0, 0]], "<u8")

    def __init__(self, encode, word_ids):
        super().__init__(encode)
        self._word_ids = word_ids
        self._forget()

    def _forget(self) -> None:
        self._places = np.zeros((0, 3), "<u8")
        self._ids, self._used, self._most = np.empty(0, "<u4"), 0, _SPARE_IDS

    def clear(self) -> None:
        super().clear()
        self._forget()

    def _keep(self, ids: np.ndarray) -> int:
        """Put ids behind those kept; returns where."""
        at, self._used = self._used, self._used + len(ids)
        if self._used > len(self._ids):
            self._ids = np.resize(self._ids if at else ids, 2 * self._used)
        self._ids[at:self._used] = ids
        return at

    def _drop_replaced(self) -> None:
        taken = np.flatnonzero(self._places[:, 1])
        value = self._places[taken, 2].astype(np.int64)
        n = value & 15
        ids = _runs(self._ids, value >> 4, n)
        self._places[taken, 2] = np.cumsum(n) - n << 4 | n
        self._ids, self._used, self._most = ids, len(ids), max(_SPARE_IDS, 2 * len(ids))

    def words(self, text: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words text[at:at + size], and how many each has.
        At least 15 bytes follow the last word."""
        if not len(self._places):
            self._places = np.zeros((1 << _SLOT_BITS, 3), "<u8")
        if self._used > self._most:
            self._drop_replaced()
        short = size < 16
        key = np.ndarray(len(text) - 15, "V16", text, strides=(1,))[at].view("<u8").reshape(-1, 2)
        key = key & self._MASK[np.minimum(size, 16)]
        key[:, 1] |= (size * short).astype("<u8") << np.uint64(56)
        mixed = key[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        mixed = ((mixed ^ mixed >> np.uint64(32)) + key[:, 1]) * np.uint64(0xC2B2AE3D27D4EB4F)
        place = (mixed >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        found = self._places[place]
        value = found[:, 2].astype(np.int64)
        first, n = value >> 4, value & 15
        new = np.flatnonzero((found[:, 0] != key[:, 0]) | (found[:, 1] != key[:, 1]) | ~short)
        if len(new):
            distinct: dict[bytes, int] = {}
            which = [distinct.setdefault(text[a:b], len(distinct))
                     for a, b in zip(at[new].tolist(), (at + size)[new].tolist(), strict=True)]
            ids, lengths = [], []
            for word in distinct:
                got = self._word_ids(word)
                ids += got
                lengths.append(len(got))
            lengths = np.array(lengths)
            start = self._keep(np.array(ids, "<u4")) + np.cumsum(lengths) - lengths
            first[new], n[new] = start[which], lengths[which]
            new = new[short[new]]
            taken, one = np.unique(place[new], return_index=True)
            one = new[one]
            self._places[taken] = np.column_stack([key[one], (first[one] << 4 | n[one]).astype("<u8")])
        return _runs(self._ids, first, n), n


class _Encoder:
    # A part that the tokenizer takes as it is, as one: spelt in the byte-level
    # alphabet it goes straight to the merges.  Of ASCII letters and a blank,
    # that alphabet spells the blank alone differently.
    _SPELT = re.compile("(?!)")

    def __init__(self, path: str):
        # Spark runs a task on each core; the library's own threads add nothing.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self._tok = Tokenizer.from_file(path)
        self._model = self._tok.model
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._known = _Known(self._encode)
        # All of them are found in the text as it is, before it is normalised.
        self._added = {t.content: self._packed([k]) for k, t in self._tok.get_added_tokens_decoder().items()}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(map(re.escape, longest_first)) or '(?!)'})").split

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        ids = array("I", ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _encode(self, part: str) -> bytes:
        if self._SPELT.fullmatch(part):
            spelt = (part.replace(" ", "\u0120") if part.isascii()
                     else self._bytes.pre_tokenize_str(part)[0][0])
            ids = [t.id for t in self._model.tokenize(spelt)]
        else:
            ids = self._tok.encode(part, add_special_tokens=False).ids
        return self._packed(ids)

    def ids(self, text: str) -> bytes:
        if not any(map(text.__contains__, self._added)):
            return self._plain(text)
        return b"".join(self._added[t] if k % 2 else self._plain(t) for k, t in enumerate(self._split(text)) if t)

    def _joined(self, parts: list[str]) -> bytes:
        use_cache(self._known)
        self._known.turn()
        return b"".join(map(self._known.__getitem__, parts))


class WordEncoder(_Encoder):
    """Tokenizers that drop white space: words are independent."""

    _SPELT = re.compile(f"[{''.join(c for c in _L if c == c.lower())}]+")

    def __init__(self, path: str):
        super().__init__(path)
        self._known = _KnownWords(self._encode, self._word_ids)
        spelt = dict(pair for c in map(chr, range(0x180))
                     for pair in zip(c.encode(), self._bytes.pre_tokenize_str(c)[0][0], strict=True))
        self._alphabet = "".join(spelt.get(b, "\ufffe") for b in range(256))

    def _encode(self, part: str) -> bytes:
        # Most parts not seen yet: spelt in the byte-level alphabet as they are.
        if part.isascii() and part.isalpha() and part.islower():
            return self._packed([t.id for t in self._model.tokenize(part)])
        return super()._encode(part)

    def _word_ids(self, word: bytes) -> list[int]:
        """The ids of one part of a lower-cased text below U+0180: spelt in the
        byte-level alphabet, it goes straight to the merges."""
        return [t.id for t in self._model.tokenize(charmap_decode(word, "strict", self._alphabet)[0])]

    def _plain(self, text: str) -> bytes:
        if text.isascii() or not _OTHER_SCRIPT.search(text):
            return self._joined(_WORD_PARTS.findall(text.lower()))
        return self._joined(text.replace("\n", " ").split(" "))

    def each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= _GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        latin = [(t.isascii() or not _OTHER_SCRIPT.search(t)) and not any(map(t.__contains__, self._added)) for t in texts]
        found = iter(self._latin([t.lower().encode() for t, is_latin in zip(texts, latin, strict=True) if is_latin]))
        for text, is_latin in zip(texts, latin, strict=True):
            yield next(found) if is_latin else self.ids(text)

    def _latin(self, texts: list[bytes]) -> list[bytes]:
        """The ids of lower-cased texts below U+0180 without added tokens."""
        use_cache(self._known)
        text = b"\n".join([*texts, b"\n" * 16])
        at, size = _word_parts(text)
        counts, out = np.zeros(len(at) + 1, np.int64), [np.empty(0, "<u4")]
        for k in range(0, len(at), _GROUP_WORDS):
            ids, n = self._known.words(text, at[k:k + _GROUP_WORDS], size[k:k + _GROUP_WORDS])
            out.append(ids)
            counts[k + 1:k + 1 + len(n)] = n
        raw = memoryview(np.concatenate(out).tobytes())
        # Each text and the line break after it, in bytes.
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        cuts = 4 * np.cumsum(counts)[np.r_[0, np.searchsorted(at, ends)]]
        return [bytes(raw[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


class ByteEncoder(_Encoder):
    """Byte-level BPE: a token never spans the place before a single space that
    something other than white space follows."""

    _SPELT = re.compile(f" ?[{_L}]+")

    def _plain(self, text: str) -> bytes:
        if text.isascii() or not _OTHER_SCRIPT.search(text):
            return self._joined(_BYTE_PARTS.findall(text))
        first, *parts = text.split(" ")
        if _BLANKS.search(text):
            first, parts = _rejoin(first, parts)
        return self._joined([first, *[" " + part for part in parts]])


def _rejoin(first: str, parts: list[str]) -> tuple[str, list[str]]:
    """Join parts that start with white space (or nothing) to the one before."""
    groups = [[first]]
    for p in parts:
        if not p or p[0].isspace():
            groups[-1].append(p)
        else:
            groups.append([p])
    joined = [" ".join(g) for g in groups]
    return joined[0], joined[1:]


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)
