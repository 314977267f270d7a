"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of 2 bits; the vector of
segment popcounts embeds it in a grid.  The Manhattan distance of two vectors
is never above the bit distance of the fingerprints, so it is a lower bound.
The range join works on that grid: with at most D differing bits over B = 3
blocks of segments, one block's vectors lie within floor(D / B) steps, so
each distinct fingerprint is put into its own cell of each block and looked
up from the cells that many steps up (both sides do this, so a pair that
differs down meets from the other side).  Every candidate is verified on the
64 bits.

Only distinct fingerprints are joined (copies share one).  Cells are read as
sorted streams; a cell with more than TILE members is dealt as tiles over many
tasks.  A task turns the links that it verifies into star edges of their
connected parts, so its output is bounded by its input rows, not by pairs.
Components come from alternating large-star / small-star rounds, each written
to the shared folder.

Defined results: NULL text is the empty text; texts without words have the
fingerprint 0 and link like any other; rows with a NULL id take part, and a
component with no id but NULL has component_id NULL; repeated rows are members
each by itself; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, materialize, words

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENT = 2
BLOCKS = 3
TILE = 8192
_PAIRS = 1 << 21


# ------------------------------------------------------------ fingerprints --

def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """SimHash of the word n-gram shingles, repeats included."""
    ws = words(text)
    if not ws:
        return 0
    line = b" ".join(ws)
    if len(ws) <= n:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        at = np.cumsum([0] + [len(w) + 1 for w in ws])
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED)
                  for a, b in zip(at[:-n].tolist(), (at[n:] - 1).tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        part = np.unpackbits(hashes[k:k + 65536, None].view(np.uint8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint_udf(n: int = SHINGLE):
    """Column function: binary text -> fingerprint as a signed long."""
    @F.pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        got = np.fromiter((fingerprint(t, n) for t in text), np.uint64, len(text))
        return pd.Series(got.view(np.int64))

    return lambda c: fp(F.coalesce(c.cast("binary"), F.lit(b"")))


# -------------------------------------------------------------------- grid --

def popcounts(fps: np.ndarray) -> np.ndarray:
    """(n, 32) popcounts of the 2-bit segments of unsigned fingerprints."""
    shifts = np.arange(0, 64, SEGMENT, dtype=np.uint64)
    return np.bitwise_count((fps[:, None] >> shifts) & np.uint64((1 << SEGMENT) - 1))


def cells(fps: np.ndarray, max_bits: int = MAX_BITS):
    """(member, cell, probe) arrays: each fingerprint's home cell in each
    block (probe 0) and the cells that it is looked up in (probe 1)."""
    steps, out = max_bits // BLOCKS, []
    grid = popcounts(fps).astype(np.int64)
    for b, cols in enumerate(np.array_split(np.arange(grid.shape[1]), BLOCKS)):
        place = (SEGMENT + 1) ** np.arange(len(cols), dtype=np.int64)
        home = grid[:, cols] @ place
        label = np.int64(b) << 48
        who = np.arange(len(fps))
        out += [(who, label + home, 0), (who, label + home, 1)]
        # Offsets with |up| + |down| <= steps; of each pair +v and -v one is enough.
        for offset in offsets(len(cols), steps):
            to = grid[:, cols] + offset
            ok = ((to >= 0) & (to <= SEGMENT)).all(axis=1)
            out.append((who[ok], label + (to[ok] @ place), 1))
    member = np.concatenate([m for m, _, _ in out])
    cell = np.concatenate([c for _, c, _ in out])
    probe = np.concatenate([np.full(len(m), p, np.int8) for m, _, p in out])
    return member, cell, probe


def offsets(dims: int, steps: int) -> list[np.ndarray]:
    """Non-zero offsets of at most `steps` Manhattan steps, one of each +v, -v."""
    seen: dict[tuple, np.ndarray] = {}
    for k in range(1, steps + 1):
        for axes in combinations_with_replacement(range(2 * dims), k):
            v = np.zeros(dims, np.int64)
            for a in axes:
                v[a // 2] += 1 if a % 2 == 0 else -1
            if v.any() and tuple(v) not in seen and tuple(-v) not in seen:
                seen[tuple(v)] = v
    return list(seen.values())


# ------------------------------------------------------- links inside cells --

def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its connected part) of links a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


class _Links:
    """Collects verified links and keeps them as star edges."""

    def __init__(self):
        self.a, self.b, self.n, self.kept = [], [], 0, 0

    def add(self, a, b):
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.n += len(a)
            if self.n > 2 * self.kept + (1 << 20):
                self.shrink()

    def shrink(self):
        if self.n:
            a, b = stars(np.concatenate(self.a), np.concatenate(self.b))
            self.a, self.b, self.n, self.kept = [a], [b], len(a), len(a)


def link_cells(cell, probe, fp, max_bits, links: _Links) -> None:
    """Verify home x probe within each cell; rows are sorted by (cell, probe)."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.r_[starts[1:], len(cell)]
    homes = np.add.reduceat((probe == 0).astype(np.int64), starts)
    split = starts + homes
    pairs = homes * (ends - split)
    for g in np.flatnonzero(pairs > _PAIRS):
        h, p = fp[starts[g]:split[g]], fp[split[g]:ends[g]]
        step = max(1, _PAIRS // len(h))
        for k in range(0, len(p), step):
            i, j = np.nonzero(np.bitwise_count(p[k:k + step, None] ^ h[None, :]) <= max_bits)
            links.add(*_apart(p[k + i], h[j]))
    small = np.flatnonzero((pairs > 0) & (pairs <= _PAIRS))
    total = np.cumsum(pairs[small])
    k = 0
    while k < len(small):
        upto = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + 2 * _PAIRS)))
        g = small[k:upto]
        n = pairs[g]
        rep = np.repeat(np.arange(len(g)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = (ends - split)[g][rep]
        h, p = fp[starts[g][rep] + nth // wide], fp[split[g][rep] + nth % wide]
        ok = np.bitwise_count(h ^ p) <= max_bits
        links.add(*_apart(h[ok], p[ok]))
        k = upto


def _apart(a, b):
    keep = a != b
    return a[keep], b[keep]


def grid_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) star edges of all links between distinct fingerprints."""
    def spread(batches):
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k in range(0, len(all_fps), 8192):
                fps = all_fps[k:k + 8192]
                member, cell, probe = cells(fps, max_bits)
                yield {"cell": cell, "probe": probe, "fp": fps[member].view(np.int64)}

    rows = materialize(map_batches(distinct.select("fp"), spread, "cell long, probe byte, fp long"),
                       "op10-cells")
    # Cells of over TILE homes or probes: their rows are copied to tiles of
    # (home part x probe part), so no task gets more than 2 * TILE of one cell.
    heavy = (rows.groupBy("cell").agg(F.sum((F.col("probe") == 0).cast("long")).alias("nh"),
                                      F.sum(F.col("probe").cast("long")).alias("np"))
             .filter((F.col("nh") > 0) & (F.greatest("nh", "np") > TILE))
             .select("cell", F.ceil(F.col("nh") / TILE).cast("int").alias("th"),
                     F.ceil(F.col("np") / TILE).cast("int").alias("tp")))
    mine = lambda n: F.pmod(F.xxhash64("fp", "cell"), F.col(n)).cast("int")
    tiles = F.when(F.col("th").isNull(), F.array(F.lit(0))).when(
        F.col("probe") == 0,
        F.transform(F.sequence(F.lit(0), F.col("tp") - 1), lambda j: mine("th") * F.col("tp") + j),
    ).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("th") - 1), lambda i: i * F.col("tp") + mine("tp")))
    dealt = (rows.join(heavy, "cell", "left").select("cell", "probe", "fp", F.explode(tiles).alias("tile"))
             .repartition("cell", "tile").sortWithinPartitions("cell", "tile", "probe"))

    def match(batches):
        links, rest = _Links(), None
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[3][1:] != cols[3][:-1]))
            done = change[-1] + 1 if len(change) else 0
            if done:
                _match(cols, done, links, max_bits)
            rest = [c[done:] for c in cols]
        if rest is not None and len(rest[0]):
            _match(rest, len(rest[0]), links, max_bits)
        links.shrink()
        for k, (a, b) in enumerate(zip(links.a, links.b, strict=True)):
            yield {"a": a.view(np.int64), "b": b.view(np.int64)}

    return map_batches(dealt, match, "a long, b long")


def _match(cols, n, links, max_bits):
    cell, probe, fp, tile = (c[:n] for c in cols)
    group = np.cumsum(np.r_[0, (cell[1:] != cell[:-1]) | (tile[1:] != tile[:-1])])
    link_cells(group, probe, fp.astype(np.int64).view(np.uint64), max_bits, links)


# -------------------------------------------------------------- components --

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node
    of its component.  Alternating large-star / small-star until nothing changes."""
    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(low, "a")
        if small:      # a > b: hang a and its smaller neighbours under the smallest
            to = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select("a", F.col("m").alias("b")))
        else:          # hang larger neighbours under the smallest
            to = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return to.filter("a <> b").distinct()

    down = lambda e: e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    cur = materialize(down(edges).filter("a <> b").distinct(), "op10-edges")
    state = None
    while True:
        r = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if r.n == 0 or (r.n, r.h) == state:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (r.n, r.h)
        cur = materialize(star(star(cur, small=False), small=True), "op10-edges")


def link_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(node, root) of the fingerprints that have a link to a different one."""
    return components(grid_links(distinct, max_bits))


# ------------------------------------------------------------------ results --

def near_dedup(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """`fps` (doc_id, fp, other columns; re-readable) with `root` (fp of the
    component) and `component_id` (its smallest doc_id)."""
    # One row per fingerprint that has documents: partial aggregation takes the copies.
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "op10-classes")
    roots = link_fingerprints(classes, max_bits)
    # Only linked fingerprints need a component table; others are their own.
    linked = classes.join(roots, classes.fp == roots.node).select("fp", "root", "low").unionByName(
        classes.join(roots.select(F.col("root").alias("fp")).distinct(), "fp")
        .select("fp", F.col("fp").alias("root"), "low"))
    lowest = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    found = linked.select("fp", "root").join(lowest, "root")
    whole = classes.join(found, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("component_id")).alias("component_id"))
    return fps.join(whole, "fp")


def fingerprints(docs: DataFrame, n: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text", extra=()) -> DataFrame:
    return materialize(docs.select(F.col(id_col).alias("doc_id"),
                                   fingerprint_udf(n)(F.col(text_col)).alias("fp"), *extra), "op10-fps")


def query(docs: DataFrame) -> DataFrame:
    return near_dedup(fingerprints(docs)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
