"""Hashed maximum-entropy language model with a class-factored softmax.

P(w | h) = P(class(w) | h) * P(w | class(w)).  The class is a softmax over
weights of hashed features of the words before w: the last word, the last two,
and the skips over one and two words.  Within a class the only feature of a word
is its own bias; the maximum-entropy weights of such a factor are known without
gradients, the log of its share, here of its count plus one, with one slot for
unseen words.  So the probabilities of all words, each class's unseen slot
included, sum to 1.

Classes come from the corpus: the UNITS most frequent words and hashed
three-byte endings of all other words are clustered by the words beside them
(k-means on square roots of neighbour shares); the end of a text is a class of
its own.  Weights are trained by distributed gradient updates: in each round
every task runs batched updates over its part of the corpus from the shared
weights, and the changes, weighted by how often a task met a feature, are summed
by ranges of buckets in a shuffle.  The rounds share out the documents, each is
used once.  The number of buckets grows with the root of the training tokens
(`buckets_of`), from BUCKETS to MAX_BUCKETS; the latter bounds the broadcast.

Texts are split twice, to count words and to write each text as an array of
32-bit codes; clustering, training and scoring read the codes.  Counts cover
every training document.  The FREQUENT most frequent words are broadcast (a
fixed bound); occurrences of all other words, summed per document, meet their
counts in a shuffle.

Defined results: NULL text is the empty text, which has the end token alone; a
word not in the training documents has count 0; without training documents
all counts are 0 and the class weights are even; repeated rows count and are
scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import id_crc, map_batches, materialize, words

FREQUENT = 1 << 17
UNITS = 2048
ENDINGS = 1024
CONTEXTS = 256
CLASSES = 24
BUCKETS = 1 << 14
MAX_BUCKETS = 1 << 20  # 100 MB of weights
ROUNDS = 3
RATE = 0.5
BATCH = 8192
HELD_OUT = 2
END = b"\n"            # no word has a line end
END_CLASS = 0
_FLUSH = 300_000
_HASH = 20             # bits of a rare word's hash in its code
_CHUNK = 1024          # buckets summed together
_MIX = np.uint64(0x9E3779B97F4A7C15)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows, END once a row; summed in the tasks first."""
    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(words(t.as_py()))
                seen[END] += 1
                if len(seen) > _FLUSH:
                    yield {"word": list(seen), "n": list(seen.values())}
                    seen.clear()
        yield {"word": list(seen), "n": list(seen.values())}

    return map_batches(texts, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(vocabulary: DataFrame, most: int) -> list:
    """At most `most` (word, n), by n.  A histogram of counts (16 bins a
    doubling) sets the cut, so that no task sends its own longest list."""
    size = F.floor(F.log2("n") * 16)
    cut, kept = 0, 0
    for r in sorted(vocabulary.groupBy(size.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.bin):
        kept += r.n
        if kept > most:
            cut = r.bin + 1
            break
    return sorted(vocabulary.filter(size >= F.lit(cut)).collect(), key=lambda r: (-r.n, bytes(r.word)))


def buckets_of(tokens: int) -> int:
    """Buckets for a corpus: a power of two near the root of 8 * tokens."""
    n = BUCKETS
    while n < MAX_BUCKETS and n * n < 8 * tokens:
        n *= 2
    return n


def _parts(a: np.ndarray, rows: int) -> dict:
    """`a` as one row per range of `rows` rows."""
    return {"part": np.arange(-(-len(a) // rows)),
            "a": [a[k:k + rows].astype(np.float32).tobytes() for k in range(0, len(a), rows)]}


def _sum_tasks(frame: DataFrame, shape: tuple) -> np.ndarray:
    """Sum of the tasks' arrays (part, a): a range of rows meets in one task,
    the driver gets each range once."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, a in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                more = np.frombuffer(a.as_buffer(), np.float32)
                total[part] = total[part] + more if part in total else more.copy()
        yield {"part": list(total), "a": [a.tobytes() for a in total.values()]}

    got = sorted(map_batches(frame.repartition("part"), add, "part int, a binary").collect(), key=lambda r: r.part)
    if not got:
        return np.zeros(shape, np.float32)
    return np.frombuffer(b"".join(bytes(r.a) for r in got), np.float32).reshape(shape)


def _ending(word: bytes) -> int:
    return crc32(word[-3:]) % ENDINGS


class Codes(dict):
    """32-bit code of a word: its rank, or below zero its ending and a hash."""

    def __init__(self, frequent: list[bytes]):
        super().__init__(zip(frequent, range(len(frequent)), strict=True))
        self.ranks = frequent

    def __missing__(self, word: bytes) -> int:
        if len(self) > FREQUENT + _FLUSH:
            self.clear()
            self.update(zip(self.ranks, range(len(self.ranks)), strict=True))
        code = self[word] = -1 - (_ending(word) << _HASH | crc32(word) & (1 << _HASH) - 1)
        return code

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.int32, len(ws))


def rank_units(frequent: list[bytes]) -> np.ndarray:
    return np.array([r if r < UNITS else UNITS + _ending(w) for r, w in enumerate(frequent)], np.int64)


def _units(codes: np.ndarray, of_rank: np.ndarray) -> np.ndarray:
    return np.where(codes < 0, UNITS + (-1 - codes.astype(np.int64) >> _HASH), of_rank[np.maximum(codes, 0)])


def cluster(profile: np.ndarray, classes: int = CLASSES, seed: int = 7) -> np.ndarray:
    """Class (1 .. classes - 1) of each unit: k-means on square roots of its
    neighbour shares, units weighing as often as they occur."""
    total = profile.sum(axis=1)
    x = np.sqrt(profile / np.maximum(total, 1)[:, None])
    used = np.flatnonzero(total > 0)
    out = np.ones(len(profile), np.int64)
    k = min(classes - 1, len(used))
    if k == 0:
        return out
    rng, weight = np.random.default_rng(seed), np.sqrt(total[used])
    centre = x[used[rng.choice(len(used), k, replace=False, p=weight / weight.sum())]]
    for _ in range(12):
        near = (x[used] @ centre.T * 2 - (centre * centre).sum(axis=1)).argmax(axis=1)
        for c in range(k):
            mine = near == c
            if mine.any():
                centre[c] = np.average(x[used[mine]], axis=0, weights=weight[mine])
    out[used] = 1 + near
    return out


def features(codes: np.ndarray, starts: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """(n, 5) buckets: bias, last word, last two, skip one, skip two.  starts:
    position of each token within its text."""
    back = []
    for d in (1, 2, 3):
        b = np.zeros(len(codes), np.uint64)
        b[d:] = codes[:-d] if d < len(codes) + 1 else 0
        b[starts < d] = 1 << 33
        back.append(b)
    one, two, three = back
    out = np.empty((len(codes), 5), np.int64)
    out[:, 0] = 0
    for j, key in enumerate((one * np.uint64(4), (one * np.uint64(31) + two * _MIX) * np.uint64(4) + np.uint64(1),
                             two * np.uint64(4) + np.uint64(2), three * np.uint64(4) + np.uint64(3)), 1):
        out[:, j] = 1 + ((key * _MIX >> np.uint64(33)) % np.uint64(buckets - 1)).astype(np.int64)
    return out


def log_softmax(weights: np.ndarray, feats: np.ndarray) -> np.ndarray:
    z = weights.take(feats[:, 0], axis=0)
    for j in range(1, feats.shape[1]):
        z += weights.take(feats[:, j], axis=0)
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def _update(weights, hits, feats, target, rate) -> None:
    grad = np.exp(log_softmax(weights, feats))
    grad[np.arange(len(grad)), target] -= 1
    flat = feats.T.ravel()
    met = np.zeros(len(weights), bool)
    met[flat] = True
    rows = np.flatnonzero(met)
    at = np.zeros(len(weights), np.int64)
    at[rows] = np.arange(len(rows))
    at = at[flat]
    n = np.bincount(at, minlength=len(rows)).astype(np.float32)
    hits[rows] += n
    step = rate / np.sqrt(n * hits[rows])
    total = np.empty((weights.shape[1], len(rows)), np.float32)
    for c, g in enumerate(grad.T.astype(float)):
        total[c] = np.bincount(at, np.tile(g, feats.shape[1]), len(rows))
    weights[rows] -= (step * total).T


def _blocks(codes: pa.Array):
    """Of the texts of a batch: codes one after the other, position of each in
    its text, number of its text."""
    wide = pa.types.is_large_binary(codes.type)
    ends = np.frombuffer(codes.buffers()[1], np.int64 if wide else np.int32)[codes.offset:codes.offset + len(codes) + 1]
    flat = np.frombuffer(codes.buffers()[2], np.int32)[ends[0] // 4:ends[-1] // 4]
    n = np.diff(ends).astype(np.int64) // 4
    return flat, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n), np.repeat(np.arange(len(n)), n)


def _feature_blocks(flat, place, buckets):
    """(slice, features) of BATCH tokens at a time."""
    for k in range(0, len(flat), BATCH):
        low, end = max(0, k - 3), min(k + BATCH, len(flat))
        yield slice(k, end), features(flat[low:end].astype(np.int64).astype(np.uint64), place[low:end], buckets)[k - low:]


def train(coded: DataFrame, frequent: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, weights) from all rows of `coded` (doc_id, codes)."""
    sc = coded.sparkSession.sparkContext
    units, of_rank = UNITS + ENDINGS, sc.broadcast(rank_units(frequent))

    def neighbours(batches):
        out = np.zeros(units * CONTEXTS, np.float32)
        for batch in batches:
            flat, place, _ = _blocks(batch.column(0))
            unit = _units(flat, of_rank.value)
            inner = place[1:] > 0
            left, right = unit[:-1][inner], unit[1:][inner]
            half = CONTEXTS // 2
            out += np.bincount(right * CONTEXTS + left % half, minlength=len(out))
            out += np.bincount(left * CONTEXTS + half + right % half, minlength=len(out))
        if out.any():
            yield _parts(out.reshape(units, CONTEXTS), units // 16)

    unit_class = cluster(_sum_tasks(map_batches(coded.select("codes"), neighbours, "part int, a binary"), (units, CONTEXTS)))
    unit_class[0] = END_CLASS
    weights = np.zeros((buckets, CLASSES), np.float32)
    for r in range(ROUNDS):
        shared = sc.broadcast((unit_class, weights))

        def learn(batches, rate=RATE / (r + 1), shared=shared):
            classes, start = shared.value
            w, hits = start.copy(), np.zeros(buckets, np.float32)
            for batch in batches:
                flat, place, _ = _blocks(batch.column(0))
                for at, feats in _feature_blocks(flat, place, buckets):
                    _update(w, hits, feats, classes[_units(flat[at], of_rank.value)], rate)
            if hits.any():
                yield _parts(np.column_stack([(w - start) * hits[:, None], hits]), _CHUNK)

        part = coded.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == r).select("codes")
        got = _sum_tasks(map_batches(part, learn, "part int, a binary"), (buckets, CLASSES + 1))
        weights = weights + got[:, :-1] / np.maximum(got[:, -1:], 1)
    return unit_class, weights


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row
    of `docs`; `training`: a condition on its columns."""
    sc = docs.sparkSession.sparkContext
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
                       F.coalesce(training, F.lit(False)).alias("training"))
    vocabulary = materialize(count_words(rows.filter("training").select("text")), "op4-vocabulary")
    is_end = F.col("word") == F.lit(END)
    size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                          F.coalesce(F.sum(F.when(is_end, F.col("n"))), F.lit(0)).alias("ends")).first()
    top = _most_frequent(vocabulary.filter(~is_end), FREQUENT - 1)
    frequent = [END, *(bytes(r.word) for r in top)]
    numbers = np.array([size.ends, *(r.n for r in top)], float)
    shared = sc.broadcast(frequent)

    def encode(batches):
        codes = Codes(shared.value)
        for batch in batches:
            out = {k: [] for k in ("codes", "rare", "times")}
            for t in batch.column(2):
                ws = [*words(t.as_py()), END]
                of = codes.of(ws)
                rare = Counter([ws[i] for i in np.flatnonzero(of < 0)])
                out["codes"].append(of.tobytes())
                out["rare"].append(list(rare))
                out["times"].append(list(rare.values()))
            yield {"doc_id": batch.column(0), "training": batch.column(1), **out}

    coded = materialize(map_batches(rows.select("doc_id", "training", "text"), encode, f"doc_id {id_type}, training boolean, "
                                    "codes binary, rare array<binary>, times array<long>")
                        .withColumn("rid", F.monotonically_increasing_id()), "op4-codes")
    buckets = buckets_of(size.n)
    unit_class, weights = train(coded.filter("training").select("doc_id", "codes"), frequent, buckets)

    def masses(batches):
        """Per class: sum of count + 1 over its words."""
        codes, of_rank, out = Codes(shared.value), rank_units(shared.value), np.zeros(CLASSES)
        for b in batches:
            cls = unit_class[_units(codes.of(b.column(0).to_pylist()), of_rank)]
            out += np.bincount(cls, b.column(1).to_numpy() + 1, CLASSES)
        yield {"class": np.arange(CLASSES), "mass": out}

    mass = np.ones(CLASSES)
    for r in map_batches(vocabulary, masses, "class int, mass double").groupBy("class").agg(F.sum("mass").alias("m")).collect():
        mass[r["class"]] += r.m
    mass[END_CLASS] = max(1.0, mass[END_CLASS] - 1)        # the one word of its class
    of_rank = rank_units(frequent)
    model = sc.broadcast((of_rank, numbers, unit_class, weights, np.log10(mass)))

    def score_rows(batches):
        of_rank, numbers, classes, w, log_mass = model.value
        counts, ln10 = np.log10(numbers + 1), np.log(10)
        for batch in batches:
            flat, place, text = _blocks(batch.column(2))
            n = len(batch.column(0))
            known, part, common = np.zeros(n), np.zeros(n), np.zeros(n)
            for at, feats in _feature_blocks(flat, place, buckets):
                cls, rank, low = classes[_units(flat[at], of_rank)], np.maximum(flat[at], 0), text[at.start]
                met, mine = flat[at] >= 0, text[at] - low
                lp = log_softmax(w, feats)[np.arange(len(cls)), cls] / ln10 - log_mass[cls]
                for out, values in ((part, lp), (common, counts[rank] * met), (known, (numbers[rank] > 0) & met)):
                    got = np.bincount(mine, values)
                    out[low:low + len(got)] += got
            yield {"doc_id": batch.column(0), "rid": batch.column(1), "n_tokens": np.bincount(text, minlength=n),
                   "n_known": known.astype(np.int64), "part": part, "common": common}

    scored = map_batches(coded.select("doc_id", "rid", "codes"), score_rows,
                         f"doc_id {id_type}, rid long, n_tokens long, n_known long, part double, common double")
    rare = (coded.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x"))
            .select("rid", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
            .join(vocabulary, "word").groupBy("rid")
            .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("more_known")))
    logs = F.col("common") + F.coalesce("more", F.lit(0.0))
    return scored.join(rare, "rid", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(size.n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(size.n + size.v + 1))).alias("base_score"),
        (logs + F.col("part")).alias("score"))


def query(docs: DataFrame) -> DataFrame:
    held_out = id_crc(F.col("doc_id")) % 7 == HELD_OUT
    return score(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                         "base_score", "score")
