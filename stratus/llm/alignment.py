"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Tokenizer A is byte-level BPE over a space and the text, B is sentencepiece BPE
over the text, which adds that space itself.  Both give byte ranges over the
same bytes.  A is read from its rank file, whose ids are those of the same
vocabulary's byte_bpe_50k.json (tests compare them) at a fifth of the time.  A cut is an offset where a token of A and a token of B both end.
An interval of tokens is divided at the cut nearest its middle, which is found
by bisecting B's ends for A's, from the middle outward; both halves are divided
in turn, and an interval without a cut inside is a leaf: one group.

Texts are first parted before blanks that follow something else than white
space, where both tokenizers always cut (tests compare with whole texts), and
the groups of a part are kept in a bounded per-process cache.  Parts that
aren't kept yet are made for many texts at once, as a call of B's library
costs as much as hundreds of parts; short parts are divided together, level by
level, in arrays.

An id pair's links in a document are kept as (pair, how often), so a long
group of a and b tokens costs its distinct pairs.  Documents are read once;
each task deals them to chunks of bounded size and writes, per document, its
pairs and, per chunk, in how many documents each pair stands.  Only these
chunk counts are shuffled by pair; corpus-wide counts go back to each chunk
that holds the pair, so a pair met in every document is one row a chunk, and
each chunk settles its documents with its own table of counts.

Defined results: texts that are NULL or empty, or whose tokens don't spell the
space and the text (U+2581 in the text, for one), have zeros and an empty
`groups_sha256`; special tokens' strings are plain text; repeated rows and NULL
ids are documents of their own, each of which counts; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, materialize, text_of, use_cache
from stratus.llm.tokens import vocabulary

CHUNK = 8_000_000          # pairs (and 16 a document) of a chunk
_GROUP = 1 << 20           # characters whose parts are made together, whole texts
_BLOCK = 1 << 14           # parts given to the tokenizers at once
_SHORT = 24                # characters a part divided among others may have
_ONE = array("q", [1]).tobytes()
_UNSPELT = ()              # stands for a part that its tokens don't spell
_RUNS = re.compile(r" (?: |\Z)|[^\S ] ")
_CUT = re.compile(r"(?<=\S)(?= +\S)")


def shared_cut(a: list[int], b: list[int], a_lo: int, a_hi: int, b_lo: int, b_hi: int) -> tuple[int, int] | None:
    """(i, j) with A's tokens before i and B's before j ending at one offset
    inside the interval, i nearest its middle; None without such an offset."""
    left = middle = (a_lo + a_hi) // 2
    right = middle + 1
    while left > a_lo or right < a_hi:
        if left > a_lo:
            j = bisect_left(b, a[left - 1], b_lo, b_hi)
            if b[j] == a[left - 1]:
                return left, j + 1
            left -= 1
        if right < a_hi:
            j = bisect_left(b, a[right - 1], b_lo, b_hi)
            if b[j] == a[right - 1]:
                return right, j + 1
            right += 1
    return None


def align(a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups (a_lo, a_hi, b_lo, b_hi) in order.  a, b: ends of the tokens,
    increasing, with the same last end."""
    out, todo = [], [(0, len(a), 0, len(b))] if a else []
    while todo:
        interval = a_lo, a_hi, b_lo, b_hi = todo.pop()
        if a_hi - a_lo > 1 and b_hi - b_lo > 1:
            cut = shared_cut(a, b, a_lo, a_hi, b_lo, b_hi)
            if cut is not None:
                todo.append((cut[0], a_hi, cut[1], b_hi))
                todo.append((a_lo, cut[0], b_lo, cut[1]))
                continue
        out.append(interval)
    return out


def align_many(a: np.ndarray, b: np.ndarray, todo: np.ndarray) -> np.ndarray:
    """align() of many intervals, whose halves are divided level by level.
    a, b: ends, increasing throughout.  todo: rows a_lo, a_hi, b_lo, b_hi, an
    interval a column; so are the groups, in order."""
    at = np.searchsorted(b, a)
    shared = b[at] == a
    out = [todo[:, :0]]
    while todo.shape[1]:
        a_lo, a_hi, b_lo, b_hi = todo
        middle, cut, far = (a_lo + a_hi) // 2, np.zeros_like(a_lo), 0
        look = np.flatnonzero((a_hi - a_lo > 1) & (b_hi - b_lo > 1))
        while len(look):
            for i in (middle[look] + 1 + far, middle[look] - far):     # of two as near the left one
                hit = (i > a_lo[look]) & (i < a_hi[look])
                hit[hit] = shared[i[hit] - 1]
                cut[look[hit]] = i[hit]
            far += 1
            m = middle[look]
            look = look[(cut[look] == 0) & ((m - far > a_lo[look]) | (m + 1 + far < a_hi[look]))]
        leaf = cut == 0
        out.append(todo[:, leaf])
        a_lo, a_hi, b_lo, b_hi = todo[:, ~leaf]
        cut = cut[~leaf]
        b_cut = at[cut - 1] + 1
        todo = np.concatenate([[a_lo, cut, b_lo, b_cut], [cut, a_hi, b_cut, b_hi]], axis=1)
    out = np.concatenate(out, axis=1)
    return out[:, np.argsort(out[0])]


class _Parts(dict):
    """part -> its groups.  Past `most` entries they become the older half, of
    which what is used again moves over; the rest goes at the next turn."""

    def __init__(self, most: int = 250_000, longest: int = 64):
        super().__init__()
        self._most, self._longest, self._old = most, longest, {}

    def clear(self) -> None:
        super().clear()
        self._old = {}

    def missing(self, parts: Iterable[str]) -> list[str]:
        """The parts to be made, each once."""
        new = {p for p in set(parts) if p not in self}
        if new and self._old:
            self.update((p, self._old[p]) for p in new if p in self._old)
            new = {p for p in new if p not in self}
        return list(new)

    def turn(self, made: list[str]) -> None:
        """Texts are done: `made` parts too long to be met again go."""
        for p in made:
            if len(p) > self._longest:
                del self[p]
        if len(self) > self._most:
            old = dict(self)
            super().clear()
            self._old = old


class Aligner:
    def __init__(self, rank_path: str, piece_path: str):
        import public_tokenizers
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self._a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = SentencePieceProcessor(model_file=piece_path)
        self._a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._a_bytes[rank] = token
        self._b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(k) else p.replace("▁", " ").encode()
                         for k, p in ((k, self._b.id_to_piece(k)) for k in range(len(self._b)))]
        self._a_size, self._b_size = list(map(len, self._a_bytes)), list(map(len, self._b_bytes))
        self._sizes = np.array(self._a_size), np.array(self._b_size)
        self._a_text, self._b_text = list(map(str, range(len(self._a_bytes)))), list(map(str, range(len(self._b_bytes))))
        # Tokens as they are shown: A's within and at the end of a group, B's.
        self._shown = [f"{k}{c}" for size, c in ((len(self._a_bytes), ","), (len(self._a_bytes), "|"),
                                                 (len(self._b_bytes), ","), (len(self._b_bytes), ";")) for k in range(size)]
        self._shown_size = np.array(list(map(len, self._shown)))
        self._known = _Parts()
        # A letter and a stop or comma behind it: A's pattern parts them, and so
        # does B if no piece holds both.  Words then share their groups.
        pieces = "\n".join(self._b.id_to_piece(k) for k in range(len(self._b)))
        self._marks = {c: (f"{ranks[c.encode()]}|{self._b.piece_to_id(c)}",
                           array("q", [ranks[c.encode()] << 32 | self._b.piece_to_id(c)]).tobytes())
                       for c in ".," if c.encode() in ranks and not self._b.is_unknown(self._b.piece_to_id(c))
                       and not re.search(f"[A-Za-z]{re.escape(c)}", pieces)}

    def tokens(self, spaced: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B of texts, each of which stands behind its space."""
        return zip(map(self._a.encode_ordinary, spaced), self._b.encode([s[1:] for s in spaced], num_threads=1), strict=True)

    def _groups(self, spaced: str, a: list[int], b: list[int]):
        """(groups as text, tokens of A, of B, groups, pairs, how often each,
        empty for once); None if the tokens don't spell the part."""
        # A always spells the part: its merges only ever join the part's bytes.
        if b"".join(map(self._b_bytes.__getitem__, b)) != spaced.encode():
            return None
        groups = ((0, len(a), 0, len(b)),) if len(a) == 1 or len(b) == 1 else align(
            list(accumulate(map(self._a_size.__getitem__, a))), list(accumulate(map(self._b_size.__getitem__, b))))
        a_text, b_text = list(map(self._a_text.__getitem__, a)), list(map(self._b_text.__getitem__, b))
        shown, links, often = [], [], []
        for a_lo, a_hi, b_lo, b_hi in groups:
            if a_hi - a_lo == 1:
                x = a[a_lo]
                if b_hi - b_lo == 1:
                    shown.append(a_text[a_lo] + "|" + b_text[b_lo])
                    links.append(x << 32 | b[b_lo])
                else:
                    shown.append(a_text[a_lo] + "|" + ",".join(b_text[b_lo:b_hi]))
                    links += [x << 32 | y for y in b[b_lo:b_hi]]
                continue
            shown.append(",".join(a_text[a_lo:a_hi]) + "|" + ",".join(b_text[b_lo:b_hi]))
            if (a_hi - a_lo) * (b_hi - b_lo) < 64:
                links += [x << 32 | y for x in a[a_lo:a_hi] for y in b[b_lo:b_hi]]
            else:
                in_b = Counter(b[b_lo:b_hi])
                often += [1] * (len(links) - len(often))
                for x, n in Counter(a[a_lo:a_hi]).items():
                    links += [x << 32 | y for y in in_b]
                    often += [n * m for m in in_b.values()]
        if often:
            often += [1] * (len(links) - len(often))
        return (";".join(shown), len(a), len(b), len(groups), array("q", links).tobytes(),
                array("q", often).tobytes() if often else b"")

    def _together(self, parts: list[str]):
        """Short parts, each a blank before and up to something else than white
        space, and their _groups; None if a part isn't spelt.  A cuts them
        from each other, B gets them one by one."""
        text = "".join(parts)
        b = self._b.encode([p[1:] for p in parts], num_threads=1)
        n_b = np.array(list(map(len, b)))
        a, b = self._a.encode_ordinary(text), list(chain.from_iterable(b))
        spelt = b"".join(map(self._b_bytes.__getitem__, b)) == text.encode()
        a, b = np.array(a), np.array(b)
        ends = np.cumsum(list(map(len, map(str.encode, parts))))
        a_end, b_end = np.cumsum(self._sizes[0][a]), np.cumsum(self._sizes[1][b])
        a_to, b_to = np.searchsorted(a_end, ends) + 1, np.cumsum(n_b)
        if not spelt or not n_b.all() or (a_end[a_to - 1] != ends).any() or (b_end[b_to - 1] != ends).any():
            return None
        n_a = np.diff(a_to, prepend=0)
        a_lo, a_hi, b_lo, b_hi = align_many(a_end, b_end, np.stack([a_to - n_a, a_to, b_to - n_b, b_to]))
        in_a, in_b = a_hi - a_lo, b_hi - b_lo
        # Each group shows A's tokens, then B's.
        shown = np.empty(len(a) + len(b), np.int64)
        at_a, at_b = np.arange(len(a)) + np.repeat(b_lo, in_a), np.arange(len(b)) + np.repeat(a_hi, in_b)
        shown[at_a], shown[at_b] = a, b + 2 * len(self._a_bytes)
        shown[at_a[a_hi - 1]] += len(self._a_bytes)
        shown[at_b[b_hi - 1]] += len(self._b_bytes)
        text, text_to = "".join(map(self._shown.__getitem__, shown.tolist())), np.cumsum(self._shown_size[shown])[a_to + b_to - 1]
        n = in_a * in_b
        pair_to = np.cumsum(n)
        group, nth = np.repeat(np.arange(len(n)), n), np.arange(pair_to[-1]) - np.repeat(pair_to - n, n)
        i, j = np.divmod(nth, in_b[group])
        pairs = (a[a_lo[group] + i] << 32 | b[b_lo[group] + j]).tobytes()
        group_to = np.searchsorted(a_hi, a_to) + 1
        pair_to = 8 * pair_to[group_to - 1]
        out, text_at, pair_at = [], 0, 0
        for x, y, k, t, p in zip(n_a.tolist(), n_b.tolist(), np.diff(group_to, prepend=0).tolist(), text_to.tolist(),
                                 pair_to.tolist(), strict=True):
            out.append((text[text_at:t - 1], x, y, k, pairs[pair_at:p], b""))
            text_at, pair_at = t, p
        return zip(parts, out, strict=True)

    def _make(self, parts: list[str]) -> None:
        short = [p for p in parts if len(p) <= _SHORT and not p[-1].isspace() and not p[1].isspace() and "▁" not in p]
        together = self._together(short) if short else ()
        self._known.update(together or ())
        rest = parts if together is None else list(set(parts).difference(short)) if len(short) < len(parts) else []
        if rest:
            self._known.update((p, self._groups(p, a, b) or _UNSPELT) for p, (a, b) in zip(rest, self.tokens(rest), strict=True))

    def _learn(self, parts: list[str]) -> list[str]:
        """Make the groups of parts; returns the words that were made besides."""
        known = self._known
        marked = [p for p in parts if p[-1] in self._marks and p[-2].isascii() and p[-2].isalpha()]
        words = known.missing([p[:-1] for p in marked])
        plain = list(set(parts).difference(marked).union(words))
        for k in range(0, len(plain), _BLOCK):
            self._make(plain[k:k + _BLOCK])
        for p in marked:
            word = known[p[:-1]]
            shown, pair = self._marks[p[-1]]
            known[p] = word if word is _UNSPELT else (f"{word[0]};{shown}", word[1] + 1, word[2] + 1, word[3] + 1, word[4] + pair,
                                 word[5] and word[5] + _ONE)
        return list(set(words).difference(parts))

    def parts(self, text: str) -> list[str]:
        if text[0].isspace() or _RUNS.search(text):
            return _CUT.split(" " + text)
        return [" " + p for p in text.split(" ")]

    def documents(self, texts: Iterable[str]) -> Iterator:
        """document() of each text, in order."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= _GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def document(self, text: str, parted: bool = True):
        """(groups as text, tokens of A, of B, groups, distinct pairs, how
        often each) of a text; None for one without tokens."""
        return self._group([text], parted)[0]

    def _group(self, texts: list[str], parted: bool = True) -> list:
        use_cache(self._known)
        parts = [(self.parts(t) if parted else [" " + t]) if t else [] for t in texts]
        new = self._known.missing(chain.from_iterable(parts))
        new += self._learn(new)
        found = [self._joined(list(map(self._known.__getitem__, p))) if p else None for p in parts]
        self._known.turn(new)
        return [self.document(t, False) if f is None and len(p) > 1 else f
                for t, p, f in zip(texts, parts, found, strict=True)]

    def _joined(self, found: list):
        """document() from its parts'; None if one of them isn't spelt."""
        if _UNSPELT in found:
            return None
        shown, a, b, groups, pairs, often = zip(*found, strict=True)
        pair = np.frombuffer(b"".join(pairs), np.int64)
        if not any(often):
            pair = np.sort(pair)
            first = np.flatnonzero(np.diff(pair, prepend=-1))
            pair, n = pair[first], np.diff(first, append=len(pair))
        else:
            weights = np.concatenate([np.frombuffer(o, np.int64) if o else np.ones(len(p) // 8, np.int64)
                                      for p, o in zip(pairs, often, strict=True)])
            order = np.argsort(pair)
            pair, weights = pair[order], weights[order]
            first = np.flatnonzero(np.diff(pair, prepend=-1))
            pair, n = pair[first], np.add.reduceat(weights, first)
        return ";".join(shown), sum(a), sum(b), sum(groups), pair, n


@lru_cache(maxsize=2)
def aligner(rank_path: str, piece_path: str) -> Aligner:
    return Aligner(rank_path, piece_path)


def _narrow(values: np.ndarray) -> bytes:
    """Positive integers in the fewest bytes each that hold the largest."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if not len(values) or values.max() < 1 << 8 * int(k[2]))
    return values.astype(kind).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


_NO_PAIRS = np.zeros(0, np.int64)


def linked(docs: DataFrame, rank_path: str, piece_path: str, chunk: int = CHUNK,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents (with their chunk, groups, pairs and how often each stands)
    and, where `total` is set, one row per chunk: its pairs and in how many of
    its documents each stands."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        tools, part, nth = aligner(rank_path, piece_path), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def total():
            pair, n = np.unique(np.concatenate([_NO_PAIRS, *held]), return_counts=True)
            return {"doc_id": pa.nulls(1), "total": [True], "chunk": [part << 32 | nth], "n_a": [0], "n_b": [0],
                    "n_groups": [0], "n_links": [0], "groups_sha256": [""], "n_pairs": [len(pair)],
                    "pairs": [pair.tobytes()], "often": [_narrow(n)]}

        for batch in batches:
            ids = batch.column(0)
            out = {k: [] for k in ("chunk", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs", "pairs", "often")}
            closed = []
            for found in tools.documents(text.as_py() for text in batch.column(1)):
                shown, a, b, groups, pair, n = found or ("", 0, 0, 0, _NO_PAIRS, _NO_PAIRS)
                for name, value in (("chunk", part << 32 | nth), ("n_a", a), ("n_b", b), ("n_groups", groups),
                                    ("n_links", int(n.sum())), ("n_pairs", len(pair)), ("pairs", pair.tobytes()),
                                    ("often", _narrow(n)),
                                    ("groups_sha256", sha256(shown.encode()).hexdigest() if found else "")):
                    out[name].append(value)
                held.append(pair)
                size += len(pair) + 16
                if size >= chunk:
                    closed.append(total())
                    nth, held, size = nth + 1, [], 0
            yield {"doc_id": ids, "total": np.zeros(len(ids), bool), **out}
            yield from closed
        if size:
            yield total()

    return map_batches(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), run,
                       f"doc_id {id_type}, total boolean, chunk long, n_a long, n_b long, n_groups long, n_links long, "
                       "groups_sha256 string, n_pairs long, pairs binary, often binary")


def pair_counts(made: DataFrame) -> DataFrame:
    """chunk, pair, n: in how many of the chunk's documents each pair stands."""
    def run(batches):
        for batch in batches:
            for chunk, n, pairs, often in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pair, count = np.frombuffer(pairs, np.int64), _wide(often, n)
                for at in range(0, n, 1 << 18):
                    some = pair[at:at + (1 << 18)]
                    yield {"chunk": np.full(len(some), chunk), "pair": some, "n": count[at:at + (1 << 18)]}

    return map_batches(made.filter("total").select("chunk", "n_pairs", "pairs", "often"), run,
                       "chunk long, pair long, n long")


def scored(made: DataFrame, in_chunk: DataFrame) -> DataFrame:
    """Documents with n_best and count_sum from the corpus-wide counts."""
    id_type = made.schema["doc_id"].dataType.simpleString()
    # A token of A has at most as many pairs as B has ids: a bounded window.
    counts = (in_chunk.groupBy("pair").agg(F.sum("n").alias("count"))
              .withColumn("best", F.col("count") == F.max("count").over(
                  Window.partitionBy(F.shiftright("pair", 32)))))
    table = in_chunk.select("chunk", "pair").join(counts, "pair").select(
        "chunk", "pair", (F.col("count") * 2 + F.col("best").cast("long")).alias("value"))
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def settle(documents: pa.Table, values: pa.Table) -> pa.Table:
        keys, value = values.column("pair").to_numpy(), values.column("value").to_numpy()
        order = np.argsort(keys)
        keys, value = keys[order], value[order]
        n_best, count_sum = [], []
        for n, pairs, often in zip(*(documents.column(c).to_pylist() for c in ("n_pairs", "pairs", "often")), strict=True):
            found, links = value[np.searchsorted(keys, np.frombuffer(pairs, np.int64))] if n else _NO_PAIRS, _wide(often, n)
            n_best.append(int(links[found & 1 == 1].sum()))
            count_sum.append(int((links * (found >> 1)).sum()))
        return documents.select(out).append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64()))

    return (made.filter("not total").select("chunk", *out, "n_pairs", "pairs", "often").groupBy("chunk")
            .cogroup(table.groupBy("chunk"))
            .applyInArrow(settle, f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, "
                          "groups_sha256 string, n_best long, count_sum long"))


def cross_align(docs: DataFrame, rank_path: str | None = None, piece_path: str | None = None,
                chunk: int = CHUNK, **cols) -> DataFrame:
    made = materialize(linked(docs, rank_path or vocabulary("byte_bpe_50k.tiktoken"),
                              piece_path or vocabulary("piece_bpe_32k.model"), chunk, **cols), "op11-links")
    return scored(made, pair_counts(made))


def query(docs: DataFrame) -> DataFrame:
    return cross_align(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
