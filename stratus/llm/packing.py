"""Best-fit packing of token documents into sequences, swept on the driver.

Documents longer than a sequence are cut into full pieces (the first may be
shorter).  Documents and gaps are kept by size; sizes are integers up
to the sequence length, and pieces of one length, like gaps of one size, are
interchangeable, so the sorted order is kept as runs: (length, how many) and
(gap, first sequence, how many).  In one loop on the driver, longest first, the pieces of
one length sweep the gaps from their own size upward (the successor), runs are
matched rank for rank, so no two pieces meet in a place, matched gaps are
updated, and what finds no gap opens new sequences.

What grows with the data is distributed: encoding, the rank of each piece
among those of its length (task by task, then prefix sums over tasks), and
the look-up of its place by rank.  The sweep sees at most `capacity` counts, so
it is one sequential loop in place of distributed bulk-synchronous rounds.

Defined results: NULL text is the empty text, a document of the end id alone;
repeated rows are packed each by itself; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, materialize, text_of
from stratus.llm.tokens import byte_encoder, vocabulary

CAPACITY = 2048
END_ID = 0
_RANK = 1 << 44        # a piece's key is length * _RANK + rank


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, crc, part, nth: the piece is the nth of
    its length in task `part`."""
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        encoder, part = byte_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out = {k: [] for k in ("row", "piece", "start", "length", "crc", "nth")}
            for row, text in enumerate(batch.column(1)):
                ids = memoryview(encoder.ids(text.as_py()) + end)
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out["row"].append(row)
                    out["piece"].append(k)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["crc"].append(crc32(ids[4 * start:4 * (start + length)]))
                    out["nth"].append(seen[length])
                    seen[length] += 1
            yield {"doc_id": batch.column(0).take(pa.array(out.pop("row"), pa.int64())), **out,
                   "part": np.full(len(out["nth"]), part)}

    return map_batches(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), encode,
                       f"doc_id {id_type}, piece int, start long, length long, crc long, nth long, part int")


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rows (key of the first piece, first sequence, offset, pieces a sequence)
    sorted by key, and the number of sequences.  counts: pieces by length."""
    gaps: list[int] = []                      # sizes that have open runs, sorted
    runs: dict[int, list[list[int]]] = {}     # size -> [first sequence, how many]
    plan, sequences = [], 0

    def opened(size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            if size not in runs:
                runs[size] = []
                insort(gaps, size)
            runs[size].append([first, n])

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            k = bisect_left(gaps, length)     # the successor of this length
            if k < len(gaps):
                size = gaps[k]
                run = runs[size].pop()
                if not runs[size]:
                    del runs[size], gaps[k]
            else:
                size, each = capacity, capacity // length
                run = [sequences, -(-todo // each)]
                sequences += run[1]
            each = size // length             # as many as fit: a smaller gap is the better fit next
            full, part = divmod(min(todo, each * run[1]), each)
            plan.append((length * _RANK + rank, run[0], capacity - size, each))
            rank += full * each + part
            todo -= full * each + part
            opened(size - each * length, run[0], full)
            if part:
                opened(size - part * length, run[0] + full, 1)
            opened(size, run[0] + full + bool(part), run[1] - full - bool(part))
    return np.array(sorted(plan), np.int64).reshape(-1, 4), sequences


def place(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`made` (from pieces(), re-readable) with sequence_id and offset."""
    spark = made.sparkSession
    in_task = materialize(made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "op8-counts")
    counts = {r.length: r.n for r in in_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = sweep(counts, capacity)
    shared = spark.sparkContext.broadcast(plan)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = made.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "crc",
        (F.col("length") * F.lit(_RANK) + F.col("before") + F.col("nth")).alias("key"))
    id_type = made.schema["doc_id"].dataType.simpleString()

    def look_up(batches):
        p = shared.value
        for b in batches:
            key, length = (b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                           for n in ("key", "length"))
            row = p[np.searchsorted(p[:, 0], key, "right") - 1]
            nth = key - row[:, 0]
            yield {n: b.column(b.schema.get_field_index(n)) for n in ("doc_id", "piece", "start", "length", "crc")} | {
                "sequence_id": row[:, 1] + nth // row[:, 3],
                "offset": row[:, 2] + nth % row[:, 3] * length}

    return map_batches(ranked, look_up, f"doc_id {id_type}, piece int, start long, length long, crc long, "
                       "sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, **cols) -> DataFrame:
    made = materialize(pieces(docs, path or vocabulary("byte_bpe_50k.json"), capacity, end_id, **cols), "op8-pieces")
    return place(made, capacity)


def query(docs: DataFrame) -> DataFrame:
    return pack(docs).withColumnRenamed("crc", "ids_crc32").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
