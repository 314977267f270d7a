"""Token-id files in Simple-8b, word-aligned.

Each 64-bit word holds a 4-bit selector and as many ids of one width as fit in
60 bits.  An id of more than 60 bits is an escape: selector 15 with its index
in the block's exceptions.  A block holds whole documents, about BLOCK_IDS ids;
its bytes are a header (ids, words, exceptions), the words, the exceptions.
Files are Parquet tables of blocks, one file a range of document ids, each
block with the ids before it in its file, so a reader decodes any block by
itself, without loops over ids.

Documents are dealt by range of (id, text hash), so files and blocks ascend by
id; the sort spills like any other.  NULL ids come first; repeated rows are
written each by itself; NULL text is the empty text (the end id alone); an
empty table gives no blocks.
"""

from __future__ import annotations

import struct
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, text_of
from stratus.llm.tokens import vocabulary, word_encoder
from stratus.session import shared_dir

END_ID = 2
BLOCK_IDS = 1 << 16
# Fixed values of the format: ids a word and bits an id, for selectors 1 to 14.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
         (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
_HEAD = struct.Struct("<QQQ")


def encode(ids: np.ndarray) -> bytes:
    """One block of unsigned ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    selector = np.full(n, ESCAPE, np.uint8)
    length = np.ones(n, np.int64)
    top = int(ids.max()) if n else 0
    fits = np.arange(n)
    for s in range(len(PACKS), 0, -1):        # few wide ids first; more narrow ones overrule
        count, bits = PACKS[s - 1]
        # Where more narrow ids fit, fewer wide ones do: only those places are left.
        fits = fits[:np.searchsorted(fits, n - count, "right")]
        if top >> bits:
            over = np.concatenate([[0], np.cumsum(ids >> np.uint64(bits) != 0, dtype=np.int32)])
            fits = fits[over[fits + count] == over[fits]]
        if not len(fits):
            break
        selector[fits] = s
        length[fits] = count
    steps, at, i = length.tolist(), [], 0
    while i < n:
        at.append(i)
        i += steps[i]
    at = np.array(at, np.int64)
    sel = selector[at]
    words = sel.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(PACKS, 1):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            k = np.arange(count)
            parts = ids[at[mine][:, None] + k] << (k * bits).astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(parts, axis=1)
    escaped = np.flatnonzero(sel == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return _HEAD.pack(n, len(words), len(escaped)) + words.astype("<u8").tobytes() + ids[at[escaped]].astype("<u8").tobytes()


def decode(block: bytes) -> np.ndarray:
    """The ids of one block."""
    n, n_words, n_escaped = _HEAD.unpack_from(block)
    words = np.frombuffer(block, "<u8", n_words, _HEAD.size)
    exceptions = np.frombuffer(block, "<u8", n_escaped, _HEAD.size + 8 * n_words)
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = np.array([0] + [c for c, _ in PACKS] + [1])[sel]
    start = np.cumsum(count) - count
    out = np.empty(n, np.uint64)
    for s, (c, bits) in enumerate(PACKS, 1):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            k = np.arange(c)
            out[start[mine][:, None] + k] = (words[mine][:, None] >> (k * bits).astype(np.uint64)) & np.uint64((1 << bits) - 1)
    mine = np.flatnonzero(sel == ESCAPE)
    out[start[mine]] = exceptions[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def write_token_files(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text and write the files to the folder `out`."""
    path = path or vocabulary("word_bpe_49k.json")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = (docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
            .withColumn("mark", F.xxhash64("text")))
    ranged = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    end = np.array([end_id], "<u4").tobytes()

    def blocks(batches):
        encoder, part = word_encoder(path), TaskContext.get().partitionId()
        ids, lengths, texts, size, base, seq = [], [], [], 0, 0, 0

        def flush():
            payload = encode(np.frombuffer(b"".join(texts), "<u4"))
            return {"part": [part], "block": [seq], "base": [base], "doc_ids": [ids],
                    "lengths": [lengths], "payload": [payload]}

        for batch in batches:
            found = encoder.each(text.as_py() for text in batch.column(1))
            for doc_id, got in zip(batch.column(0).to_pylist(), found, strict=True):
                got += end
                ids.append(doc_id)
                lengths.append(len(got) // 4)
                texts.append(got)
                size += len(got) // 4
                if size >= block_ids:
                    yield flush()
                    base, seq = base + size, seq + 1
                    ids, lengths, texts, size = [], [], [], 0
        if ids:
            yield flush()

    map_batches(ranged.select("doc_id", "text"), blocks,
                f"part int, block int, base long, doc_ids array<{id_type}>, lengths array<long>, payload binary"
                ).write.parquet(out)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens,
    ids_crc32, ids."""
    blocks = spark.read.parquet(path)
    # One line per file: its ids, then the ids of the files before it.
    files = blocks.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches):
        for batch in batches:
            start, doc_ids, lengths, payload = (batch.column(k) for k in range(4))
            for k in range(batch.num_rows):
                n = lengths[k].values.to_numpy()
                end = np.cumsum(n)
                ids = decode(payload[k].as_py()).astype("<u4")
                if end[-1] != len(ids):
                    raise ValueError("damaged token block")
                raw = memoryview(ids.tobytes())
                cuts = list(zip((end - n).tolist(), end.tolist(), strict=True))
                yield {"doc_id": doc_ids[k].values, "start": start[k].as_py() + end - n, "n_tokens": n,
                       "ids_crc32": [crc32(raw[4 * a:4 * b]) for a, b in cuts],
                       "ids": pa.ListArray.from_arrays(pa.array(np.r_[0, end], pa.int32()), pa.array(ids.astype(np.int64)))}

    # One line of two numbers per file, and a file per task of the write: a
    # proven bound, so the blocks need no shuffle.
    placed = blocks.join(F.broadcast(files), "part").select((F.col("before") + F.col("base")).alias("start"),
                                               "doc_ids", "lengths", "payload")
    return map_batches(placed, documents, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, ids array<long>")


def query(docs: DataFrame) -> DataFrame:
    out = shared_dir(docs.sparkSession, "op7-tokens")
    write_token_files(docs, out)
    return read_token_files(docs.sparkSession, out).drop("ids")
