"""Personal data, with information-theoretic sanitisation.

Base spans are e-mail addresses, IPv4 addresses, payment cards and phone
numbers.  They are the protected entities.  How strongly a term reveals one is
estimated from the whole corpus: with document frequencies,

    IC(e)      = log(N / df(e))
    PMI(e, t)  = log(N * df(e, t) / (df(e) * df(t)))

where df(e, t) counts documents that hold e and, outside base spans, t, and
df(t) all documents with t.  PMI reaches IC when t is found only with e.
A term with PMI >= `generalise` * IC is a candidate.  It is telling if the two
meet more often than by chance: the chance that df(e, t) of the df(t) documents
are among those of e is at most

    p = C(df(e), df(e, t)) * C(df(t), df(e, t)) / C(N, df(e, t))

and Benjamini-Hochberg at level `fdr` over all pairs of an entity and a term of
the corpus sets the cut, from a histogram of 0.05-decade bins (each counted by
its upper edge).  A telling term is generalised (kind `term`), from `remove` *
IC on it is removed (kind `drop`), wherever it stands outside base spans, in
all documents.  Terms are words of three or more characters, lower-cased.

Defined results: NULL text is the empty text; without findings counts are zero
and strings empty; repeated rows are documents of their own, in the counts
too; an empty table gives no rows.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, materialize, text_of

FDR = 0.01
GENERALISE = 0.8
REMOVE = 0.95
KINDS = ("email", "ip", "card", "phone")
TERM, DROP = "term", "drop"
_FLUSH = 200_000
_PAIRS = 20_000       # pairs given on at a time
_COMMON = 1 << 16     # terms that are broadcast as too common for any entity
_MOST_BITS = 1 << 24  # of the filter that finds where telling terms may stand
_SENT = 1 << 16       # telling terms that are broadcast as they are
_SHIFTS = (0, 20, 40) # its bits of a term: these places of the hash
_BIN = 0.05           # decades of a p-value per bin
_MOST = 1 << 13       # bins

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Each starts where no digit stands before it: a match can't start inside a run
# that an earlier try from its first digit failed on.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9](?:[ .-]?[0-9]){3}")    # every address and card holds this
_NOT_DIGIT = re.compile("[^0-9]+")
_WORD = re.compile(r"\w+")


def emails(text: str):
    """Leftmost matches of local@label(.label)+, from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done:                      # back over the local part, a slice at a time
            low = max(done, start - 64)
            part = _LOCAL.search(text, low, start)
            moved = part.start() < start
            start = part.start()
            if start > low or not moved:
                break
        hit = _DOMAIN.match(text, at) if start < at else None
        if hit:
            yield start, hit.end()
            done = hit.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    digits = _DIGITS.search(text) is not None
    for m in _IP.finditer(text) if digits else ():
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text) if digits else ():
        if m.end() - m.start() >= 12:
            number = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(number) <= 19 and luhn(number):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _terms(text: str, spans: list[tuple[int, int, int]]):
    """(start, end) of the words of three or more characters outside the spans."""
    k, reach = 0, 0                              # spans before k start before the word ends
    for m in _WORD.finditer(text):
        s, e = m.span()
        while k < len(spans) and spans[k][0] < e:
            reach = max(reach, spans[k][2])
            k += 1
        if e - s >= 3 and reach <= s:
            yield s, e


def _entity(text: str, kind: int, a: int, b: int) -> int:
    value = text[a:b].lower() if kind < 2 else _NOT_DIGIT.sub("", text[a:b])
    return xxhash.xxh64_intdigest(f"{kind}:{value}") - (1 << 63)


def terms_of(text: str) -> set[str]:
    """The text's different terms.  Lower-casing the text first gives the words'
    own lower-case forms but for two letters: one grows, one looks beyond its word."""
    if "\u0130" in text or "\u03a3" in text:
        return {w.lower() for w in set(_WORD.findall(text)) if len(w) >= 3}
    return {w for w in set(_WORD.findall(text.lower())) if len(w) >= 3}


class MayBe:
    """Which terms may be telling: all telling ones where they are few enough to
    be sent, else those that a filter lets through; answers are kept, bounded."""

    def __init__(self, sent: set[str] | bytes):
        self.exact = not isinstance(sent, bytes)
        self.yes: set[str] = sent if self.exact else set()
        self.no: set[str] = set()
        if not self.exact:
            self.bits, self.top = sent, len(sent) * 8 - 1

    def _asked(self, term: str) -> bool:
        h = xxhash.xxh64_intdigest(term.encode(), 42)      # 42: as xxhash64 does
        return all(self.bits[(h >> k & self.top) >> 3] >> (h >> k & 7) & 1 for k in _SHIFTS)

    def of(self, terms: set[str]) -> set[str]:
        if not self.exact:
            for kept in (self.yes, self.no):
                if len(kept) > _FLUSH:
                    kept.clear()
            for t in terms - self.no - self.yes:
                (self.yes if self._asked(t) else self.no).add(t)
        return terms & self.yes


def _log10_p(n_pair: pd.Series, n_entity: pd.Series, n_term: pd.Series, rows: pd.Series) -> pd.Series:
    def choose(n, k):
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    return pd.Series([min(0.0, (choose(e, k) + choose(t, k) - choose(n, k)) / math.log(10))
                      for k, e, t, n in zip(n_pair, n_entity, n_term, rows, strict=True)], dtype=float)


def _telling(source: DataFrame, generalise: float, remove: float, fdr: float) -> DataFrame | None:
    """term, kind: the terms to generalise (4) and to remove (5)."""
    def read(batches):
        """One pass: documents per term, summed in the task and given on in
        bounded parts, and the entities and terms of texts that hold any."""
        seen: Counter = Counter()

        def counted():
            out = {"entities": [None] * len(seen), "terms": [None] * len(seen), "term": list(seen), "n": list(seen.values())}
            seen.clear()
            return out

        for batch in batches:
            entities, terms = [], []
            for t in batch.column(0):
                text = t.as_py()
                seen.update(terms_of(text))
                if spans := base_spans(text):
                    entities.append(list({_entity(text, k, a, b) for a, k, b in spans}))
                    terms.append(list({text[s:e].lower() for s, e in _terms(text, spans)}))
                if len(seen) > _FLUSH:
                    yield counted()
            yield {"entities": entities, "terms": terms, "term": [None] * len(terms), "n": [None] * len(terms)}
        yield counted()

    texts = source.select("text")
    rows = texts.count()
    both = materialize(map_batches(texts, read, "entities array<long>, terms array<string>, term string, n long"), "op6-read")
    held = both.filter("entities IS NOT NULL").select("entities", "terms")
    known = materialize(held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity")), "op6-entities")
    entities, most = known.agg(F.count(F.lit(1)), F.max("n_entity")).first()
    if not entities:
        return None
    terms = materialize(both.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n_term")), "op6-terms")
    # PMI >= generalise * IC asks for df(t) <= df(e, t) * (N / df(e)) ** (1 - generalise),
    # and df(e, t) <= df(e): beyond the bound of the most frequent entity no pair needs to be made.
    bound = most ** generalise * rows ** (1 - generalise) * (1 + 1e-9) if 0 <= generalise <= 1 else math.inf
    common = source.sparkSession.sparkContext.broadcast({r.term for r in terms.filter(
        F.col("n_term") > F.lit(float(bound))).orderBy(F.desc("n_term"), "term").limit(_COMMON).collect()})

    def pair(batches):
        """A document's pairs, in bounded parts."""
        for batch in batches:
            entity, term = [], []
            for es, ts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ts = [t for t in ts if t not in common.value]
                for e in es:
                    entity += [e] * len(ts)
                    term += ts
                    if len(term) > _PAIRS:
                        yield {"entity": entity, "term": term}
                        entity, term = [], []
            yield {"entity": entity, "term": term}

    pairs = map_batches(held, pair, "entity long, term string").groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_pair"))
    n = F.lit(float(rows))
    ic = F.log(n / F.col("n_entity"))
    pmi = F.log(n * F.col("n_pair") / (F.col("n_entity") * F.col("n_term")))
    candidates = materialize(
        pairs.join(terms, "term").join(known, "entity").filter((ic > 0) & (pmi >= generalise * ic))
        .select("term", F.when(pmi >= remove * ic, 5).otherwise(4).alias("kind"), "n_pair", "n_entity", "n_term")
        .select("term", "kind", F.least(F.floor(-F.pandas_udf(_log10_p, "double")("n_pair", "n_entity", "n_term", n) / _BIN), F.lit(_MOST))
                .cast("int").alias("bin")), "op6-candidates")
    tests = math.log10(entities) + math.log10(max(1, terms.count()))
    cut, rank = None, 0
    for r in sorted(candidates.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.bin):
        rank += r.n
        if -r.bin * _BIN <= math.log10(fdr) + math.log10(rank) - tests:
            cut = r.bin
    if cut is None:
        return None
    return materialize(candidates.filter(F.col("bin") >= cut).groupBy("term").agg(F.max("kind").alias("kind")), "op6-telling")


def _filter(telling: DataFrame) -> bytes:
    """Bloom filter of the terms.  16 bits a term keep what it lets through in
    proportion to the words, up to 2 MB; a fuller one only passes more."""
    bits = 1 << 16
    while bits < min(16 * telling.count(), _MOST_BITS):
        bits *= 2
    at = F.explode(F.array(*[F.shiftrightunsigned(F.xxhash64("term"), k).bitwiseAND(F.lit(bits - 1).cast("long")) for k in _SHIFTS]))
    out = np.zeros(bits // 64, "<i8")
    for r in telling.select(at.alias("bit")).groupBy(F.expr("bit div 64").alias("at")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect():
        out[r["at"]] = r.bits
    return out.tobytes()


def _sent(telling: DataFrame) -> set[str] | bytes:
    """The telling terms, up to _SENT of them, or their filter: the same results."""
    few = telling.select("term").limit(_SENT + 1).collect()
    return _filter(telling) if len(few) > _SENT else {r.term for r in few}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
         remove: float = REMOVE, fdr: float = FDR) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind number, end); kinds 4 and
    5 are terms to generalise and to remove."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    telling = _telling(source, generalise, remove, fdr)
    sent = docs.sparkSession.sparkContext.broadcast(None if telling is None else _sent(telling))

    def mark(batches):
        """Base spans, and the words that may be telling: the join decides."""
        maybe = MayBe(sent.value) if sent.value else None
        for batch in batches:
            base, near = [], []
            for t in batch.column(1):
                text = t.as_py()
                spans = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                hits = maybe and maybe.of(terms_of(text))
                near.append([{"term": text[s:e].lower(), "start": s, "end": e} for s, e in _terms(text, spans)
                             if text[s:e].lower() in hits] if hits else [])
            yield {"doc_id": batch.column(0), "base": base, "near": near}

    found = materialize(map_batches(
        source, mark, f"doc_id {id_type}, base array<struct<start:int,kind:int,end:int>>, "
        "near array<struct<term:string,start:int,end:int>>")
        .withColumn("rid", F.monotonically_increasing_id()), "op6-found")
    if telling is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    added = (found.select("rid", F.explode("near").alias("x")).select("rid", "x.*").join(telling, "term")
             .groupBy("rid").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")))
    return found.join(added, "rid", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(
            "array<struct<start:int,kind:int,end:int>>")))).alias("spans"))


def redact_udf():
    """Column function (text, spans) -> the sanitised text."""
    @F.pandas_udf("string")
    def redact(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([redacted(t or "", [(s["start"], s["kind"], s["end"]) for s in (p if p is not None else [])])
                          for t, p in zip(text, spans, strict=True)])
    return redact


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Entities become <KIND>, terms <NUMBER> or <WORD>; removed terms go.
    What overlaps an earlier span is covered with it."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out.append(text[at:start])
            out.append(f"<{KINDS[kind].upper()}>" if kind < 4 else "" if kind == 5 else
                       "<NUMBER>" if text[start:end].isdigit() else "<WORD>")
        at = max(at, end)
    return "".join(out) + text[at:]


def text_of_spans(a: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM, DROP)])
    return F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(docs: DataFrame) -> DataFrame:
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return find(docs).select("doc_id", *[n(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                             F.sha2(text_of_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                             text_of_spans(F.col("spans")).alias("spans"))
