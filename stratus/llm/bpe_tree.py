"""Byte-level BPE by monoid tree reduction, and its decoding.

Each match of the vocabulary's pattern is encoded by itself.  A match that is
a token as a whole is that token; short ones are merged directly.  A longer one
is halved, both halves are encoded recursively and the two results are joined:

* Neighbouring tokens a, b are stable if merging the bytes of both gives a, b
  again.  Merges are picked by lowest rank, leftmost first, so as long as no
  merge has crossed a border between tokens, the picks inside two neighbours
  are just those of merging these two alone.  Hence a sequence whose
  neighbours all are stable is the encoding of its bytes, and conversely.
* So halves whose inner neighbours are stable need no work.  Otherwise a window
  of tokens about the border is encoded again and grows on the side whose
  window edge isn't stable, doubling, until both are (or the window holds all);
  what lies outside is then provably final.

Decoding concatenates the bytes of tokens up the tree.  Encoded parts are kept
in a bounded per-process cache.  Documents are rows: they are encoded in the
tasks that read them, with no shuffle.

Defined results: NULL text is the empty text, which has no ids; repeated rows
and NULL ids give rows of their own; an empty table gives no rows; very long
texts and very long matches are encoded whole; extra columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, text_of, use_cache
from stratus.llm.tokens import _Known, vocabulary

LEAF = 24                 # bytes that are merged directly
_FAN = 4096               # tokens that are decoded at once
_STABLE_MAX = 200_000


class TreeBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        import regex
        self._ranks, self._leaf = ranks, max(1, leaf)
        self._findall = regex.compile(pattern).findall
        self._bytes = {k: token for token, k in ranks.items()}
        self._stable: dict[tuple[int, int], bool] = {}
        self._known = _Known(self._match)

    # ------------------------------------------------------------- merging --

    def _merge(self, data: bytes) -> list[int]:
        """All merges over `data`: lowest rank first, leftmost first."""
        return self._merge_few(data) if len(data) <= 2 * self._leaf else self._merge_many(data)

    def _merge_few(self, data: bytes) -> list[int]:
        ranks = self._ranks
        none = len(ranks) + 1
        parts = [data[k:k + 1] for k in range(len(data))]
        pairs = [ranks.get(data[k:k + 2], none) for k in range(len(data) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            k = pairs.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], none)
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], none)
        return [ranks[p] for p in parts]

    def _merge_many(self, data: bytes) -> list[int]:
        """The same with a heap and linked parts, for windows that have grown."""
        ranks, n = self._ranks, len(data)
        end = list(range(1, n + 1))          # end of the part that starts here; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = [(r, k) for k in range(n - 1) if (r := ranks.get(data[k:k + 2])) is not None]
        heapify(heap)
        while heap:
            rank, k = heappop(heap)
            middle = end[k]
            if not middle or middle >= n or ranks.get(data[k:end[middle]]) != rank:
                continue                     # either part has changed since
            end[k], end[middle] = end[middle], 0
            if end[k] < n:
                before[end[k]] = k
                r = ranks.get(data[k:end[end[k]]])
                if r is not None:
                    heappush(heap, (r, k))
            if before[k] >= 0:
                r = ranks.get(data[before[k]:end[k]])
                if r is not None:
                    heappush(heap, (r, before[k]))
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k:end[k]]])
            k = end[k]
        return out

    # ---------------------------------------------------------------- tree --

    def _is_stable(self, a: int, b: int) -> bool:
        known = self._stable.get((a, b))
        if known is None:
            if len(self._stable) >= _STABLE_MAX:
                self._stable.clear()
            known = self._stable[a, b] = self._merge(self._bytes[a] + self._bytes[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings, one after the other."""
        if not left or not right or self._is_stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self._merge(self.decode(left[-i:] + right[:j]))
            left_done = i == len(left) or self._is_stable(left[-i - 1], window[0])
            right_done = j == len(right) or self._is_stable(window[-1], right[j])
            if left_done and right_done:
                return left[:-i] + window + right[j:]
            if not left_done:
                i = min(2 * i, len(left))
            if not right_done:
                j = min(2 * j, len(right))

    def _tree(self, data: bytes) -> list[int]:
        if len(data) <= self._leaf:
            return self._merge(data)
        middle = len(data) // 2
        return self.join(self._tree(data[:middle]), self._tree(data[middle:]))

    def _match(self, part: str) -> list[int]:
        data = part.encode()
        whole = self._ranks.get(data)
        return self._tree(data) if whole is None else [whole]

    def encode(self, text: str) -> list[int]:
        use_cache(self._known)
        self._known.turn()
        return list(chain.from_iterable(map(self._known.__getitem__, self._findall(text))))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= _FAN:
            return b"".join(map(self._bytes.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def tree_bpe(path: str) -> TreeBPE:
    import public_tokenizers
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return TreeBPE(ranks, public_tokenizers.PATTERN)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>), decoded (binary)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = tree_bpe(path)
        for batch in batches:
            ids = [bpe.encode(text.as_py()) for text in batch.column(1)]
            yield {"doc_id": batch.column(0), "ids": ids, "decoded": list(map(bpe.decode, ids))}

    return map_batches(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), run,
                       f"doc_id {id_type}, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, without moving the ids."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = tree_bpe(path)
        decimal = {k: str(k) for k in bpe._bytes}.__getitem__
        for batch in batches:
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(sha256(bpe.decode(ids)).hexdigest())
            yield {"doc_id": batch.column(0), **out}

    return map_batches(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), run,
                       f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(docs: DataFrame) -> DataFrame:
    return digests(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))
