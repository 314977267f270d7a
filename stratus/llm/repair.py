"""Conversation structure repair by weighted CYK interval parsing.

The repair grammar is in Chomsky normal form.  Its non-terminals are pairs of
states of `(s?(ua)+)?`: X(p, q) derives the rows of a span, after edits, as
roles that lead from state p to q.  Binary rules X(p, q) -> X(p, r) X(r, q);
terminal rules keep, rerole or delete a row; the insertion closure (the cells
of the empty span) lets empty user or assistant turns stand anywhere.  A cell
holds the minimum (cost, audit).  The cost of an audit over given rows follows
from the audit alone and no audit is a proper prefix of one of equal cost over
the same rows, so the minimum of a concatenation is that of its parts.

Spans are combined bottom-up by length: all spans and all splits up to BLOCK
rows; from there on whole blocks, then pairs of neighbours, level by level
(X(p, q) has a derivation at every split, so one split a level loses nothing).

On Spark: rows without their texts are counted per (conversation, turn, role,
text hash), so that repeated rows meet before any shuffle; the first turn of
each (role, text) marks the later ones as duplicates.  A range sort by
(conversation, turn, role, hash) deals a hot conversation over many tasks, each
of which parses its segment; segments meet again as cells.  A last pass streams
the sorted texts of each conversation through SHA-256, row by row in bounded
memory: a hash over a whole conversation has no parallel form, so that stream
is one task's, but it neither collects nor parses.

Defined results: NULL conversation ids, turns, roles and texts are one space in
the damage key; NULL role and text are one space; NULL ids are one
conversation; rows of one turn follow by role, then by SHA-256 of the text;
repeated rows are rows of their own; empty and very long texts are as any
other; a conversation without rows after damage has zeros, an empty audit and
the hash of the empty string; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import map_batches, materialize

BLOCK = 16                 # rows of a full chart
_CACHE_MAX = 100_000
_BLANKS = " \t\n\x0b\f\r"
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPT = (0, 3)
_PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or (p < q) or (p, q) == (3, 2)]
_AT = {pq: k for k, pq in enumerate(_PAIRS)}
_RULES = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, q in _PAIRS for r in range(4)
          if (p, r) in _AT and (r, q) in _AT]
_NAMES = {"u": "user", "a": "assistant"}
_INSERT, _REROLE, _DELETE, _TRUNCATED = 2, 2, 3, 1


def joined(left: list, right: list) -> list:
    """Cells of two neighbouring spans, joined by the binary rules."""
    out = [None] * len(_PAIRS)
    for pq, pr, rq in _RULES:
        a, b = left[pr], right[rq]
        if a is not None and b is not None:
            c = (a[0] + b[0], a[1] + b[1])
            if out[pq] is None or c < out[pq]:
                out[pq] = c
    return out


def _least(one: list, other: list) -> list:
    return [a if b is None else b if a is None else min(a, b) for a, b in zip(one, other, strict=True)]


def _closure() -> list:
    cells = [(0, "") if p == q else None for p, q in _PAIRS]
    for (p, role), q in _STEP.items():
        if role in _NAMES:
            cells = _least(cells, [(_INSERT, "I") if k == _AT[p, q] else None for k in range(len(_PAIRS))])
    while (more := _least(cells, joined(cells, cells))) != cells:
        cells = more
    return cells


_EMPTY = _closure()


def _terminal(symbol: str) -> list:
    """Cells of one row.  Its symbol: x where it must go, else the initial of
    its role (o: none of s, u, a), upper case where it is truncated."""
    cells = [(_DELETE, "D") if p == q else None for p, q in _PAIRS]
    if symbol != "x":
        late = _TRUNCATED * symbol.isupper()
        for (p, role), q in _STEP.items():
            best = [None] * len(_PAIRS)
            if role == symbol.lower():
                best[_AT[p, q]] = (late, "K")
            elif role in _NAMES:
                best[_AT[p, q]] = (_REROLE + late, "R")
            cells = _least(cells, best)
    return joined(joined(_EMPTY, cells), _EMPTY)


_charts: dict[str, list] = {}


def _chart(symbols: str) -> list:
    """Cells of the whole of `symbols` (BLOCK at most): CYK by span length."""
    if symbols in _charts:
        return _charts[symbols]
    if len(_charts) > _CACHE_MAX:
        _charts.clear()
    n = len(symbols)
    table = {}
    for length in range(1, n + 1):
        for i in range(n - length + 1):
            span = symbols[i:i + length]
            cells = _charts.get(span)
            if cells is None:
                if length == 1:
                    cells = _terminal(span)
                else:
                    cells = [None] * len(_PAIRS)
                    for k in range(i + 1, i + length):
                        cells = _least(cells, joined(table[i, k], table[k, i + length]))
                _charts[span] = cells
            table[i, i + length] = cells
    return table[0, n]


def parse(symbols: str) -> list:
    """Cells of a span of rows of any length."""
    return combine([_chart(symbols[k:k + BLOCK]) for k in range(0, len(symbols), BLOCK)])


def combine(spans: list[list]) -> list:
    """Cells of neighbouring spans joined in pairs, level by level."""
    while len(spans) > 1:
        spans = [joined(spans[k], spans[k + 1]) if k + 1 < len(spans) else spans[k]
                 for k in range(0, len(spans), 2)]
    return spans[0] if spans else _EMPTY


def best(cells: list) -> tuple[int, str]:
    return min(cells[_AT[0, q]] for q in _ACCEPT)


# ------------------------------------------------------------------- Spark --

def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, copies: the rows after damage (copies: 0 to 2)."""
    c = conversations.select(F.col("conv_id").alias("conv"), F.col("turn"),
                             *[F.coalesce(F.col(n).cast("string"), F.lit(" ")).alias(n) for n in ("role", "text")])
    key = F.concat(*[F.coalesce(F.col(n).cast("string"), F.lit(" ")) for n in ("conv",)], F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    c = c.withColumn("harm", F.crc32(key.cast("binary")) % 20)
    return c.select(
        "conv", "turn", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 0, 0).when(F.col("harm") == 3, 2).otherwise(1).alias("copies"))


def _symbol(role: str, gone: bool, late: bool) -> str:
    if gone:
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if late else initial


class _Segment:
    """One conversation's rows as far as one task sees them."""

    def __init__(self, row):
        self.key = row
        self.n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.symbols: list[str] = []
        self.roles = [None, None]
        self.turns = [None, None, 0]       # lowest, highest, how many

    def add(self, row, first: bool) -> None:
        initial, n = row["role"][:1], row["n"]
        fault = "blank" if row["blank"] else "duplicate"
        later = n
        if not row["blank"] and first:
            later = n - 1
            self.n["truncated"] += row["late"]
            self.symbols.append(_symbol(row["role"], False, row["late"]))
        self.n[fault] += later
        self.symbols.append("x" * later)
        if self.roles[0] is None:
            self.roles[0] = initial
        else:
            self.n["illegal"] += self.roles[1] + initial not in ("su", "ua", "au")
        self.n["illegal"] += n - 1
        self.roles[1] = initial
        turn = row["turn"]
        if turn is not None:
            if self.turns[0] is None:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1] = turn
                self.turns[2] += 1

    def columns(self) -> dict:
        cells = parse("".join(self.symbols))
        k = self.key
        return {"conv": k["conv"], "turn": k["turn"], "role": k["role"], "h": k["h"], **self.n,
                "first_role": self.roles[0], "last_role": self.roles[1],
                "low": self.turns[0], "high": self.turns[1], "turns": self.turns[2],
                "costs": [None if c is None else c[0] for c in cells],
                "audits": [None if c is None else c[1] for c in cells]}


_SEGMENT = ("conv {id}, turn {turn}, role string, h string, blank long, duplicate long, truncated long, illegal long, "
            "first_role string, last_role string, low {turn}, high {turn}, turns long, costs array<long>, "
            "audits array<string>")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def segments(rows: DataFrame) -> DataFrame:
    """One row per conversation and task: counts and the cells of its rows."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    counted = materialize(
        rows.filter("copies > 0")
        .select("conv", "turn", "role", F.sha2("text", 256).alias("h"), (trimmed == "").alias("blank"),
                (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("late"), "copies")
        .groupBy("conv", "turn", "role", "h")
        .agg(F.max("blank").alias("blank"), F.max("late").alias("late"), F.sum("copies").alias("n")), "op12-rows")
    firsts = (counted.groupBy("conv", "role", "h")
              .agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn").alias("turn"))).alias("low"))
              .select("conv", F.col("low.turn").alias("turn"), "role", "h",
                      *[F.lit(None).cast(t).alias(n) for n, t in (("blank", "boolean"), ("late", "boolean"), ("n", "long"))]))
    keys = ["conv", "turn", "role", "h"]
    marked = (counted.withColumn("kind", F.lit(1)).unionByName(firsts.withColumn("kind", F.lit(0)))
              .repartitionByRange(*keys).sortWithinPartitions(*keys, "kind"))
    schema = _SEGMENT.format(id=types["conv"], turn=types["turn"])
    names = _names(schema)

    def run(batches):
        now, mark = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = (row["conv"], row["turn"], row["role"], row["h"])
                if row["kind"] == 0:
                    mark = key
                    continue
                if now is None or now.key["conv"] != row["conv"]:
                    if now is not None:
                        out.append(now.columns())
                    now = _Segment(row)
                now.add(row, key == mark)
            yield {n: [o[n] for o in out] for n in names}
        if now is not None:
            last = now.columns()
            yield {n: [last[n]] for n in names}

    return map_batches(marked, run, schema)


class _Conversation:
    def __init__(self, conv):
        self.conv, self.parts = conv, []
        self.hash, self.audit, self.at, self.state, self.items = sha256(), None, 0, 0, 0
        self.out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def settle(self) -> None:
        """Join the segments: counts, cells, the cheapest audit."""
        low = high = last = None
        turns = 0
        for s in self.parts:
            for n in self.out:
                self.out[n] += s[n]
            if last is not None:
                self.out["illegal"] += last + s["first_role"] not in ("su", "ua", "au")
            last = s["last_role"]
            if s["low"] is not None:
                turns += s["turns"] - (high == s["low"])
                low, high = s["low"] if low is None else low, s["high"]
        self.out["gaps"] = 0 if low is None else high - low + 1 - turns
        cells = combine([[None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"], strict=True)]
                         for s in self.parts])
        self.out["cost"], self.audit = best(cells) if self.parts else (0, "")
        self.parts = []

    def _item(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.items else ''}{role}:{text}".encode())
        self.items += 1
        self.state = _STEP[self.state, role[:1]]

    def _expected(self) -> str:
        return "assistant" if self.state == 2 else "user"

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._item(self._expected(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._item(role if edit == "K" else self._expected(), text)

    def columns(self) -> dict:
        self._inserts()
        return {"conv_id": self.conv, **self.out, "audit": self.audit, "repaired_sha256": self.hash.hexdigest()}


def repair(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per conversation id of `conversations`, over `rows` (those of
    damaged() by default)."""
    rows = damaged(conversations) if rows is None else rows
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    found = segments(rows)
    info = F.struct(*[F.col(n) for n in found.columns if n not in ("conv", "turn", "role", "h")]).alias("segment")
    seg_type = found.select(info).schema["segment"].dataType
    no_text, no_copies = F.lit(None).cast("string").alias("text"), F.lit(1).alias("copies")
    no_segment = F.lit(None).cast(seg_type).alias("segment")
    ids = conversations.select(F.col("conv_id").alias("conv")).distinct().select(
        "conv", F.lit(0).alias("kind"), F.lit(None).cast(types["turn"]).alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("h"), no_text, no_copies, no_segment)
    parsed = found.select("conv", F.lit(1).alias("kind"), "turn", "role", "h", no_text, no_copies, info)
    texts = rows.filter("copies > 0").select("conv", F.lit(2).alias("kind"), "turn", "role",
                                             F.sha2("text", 256).alias("h"), "text", "copies", no_segment)
    dealt = (ids.unionByName(parsed).unionByName(texts).repartition("conv")
             .sortWithinPartitions("conv", "kind", "turn", "role", "h"))
    schema = (f"conv_id {types['conv']}, gaps long, blank long, duplicate long, truncated long, illegal long, "
              "cost long, audit string, repaired_sha256 string")
    names = _names(schema)

    def run(batches):
        now = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if now is not None:
                        if now.audit is None:
                            now.settle()
                        out.append(now.columns())
                    now = _Conversation(row["conv"])
                elif row["kind"] == 1:
                    now.parts.append(row["segment"])
                else:
                    if now.audit is None:
                        now.settle()
                    for _ in range(row["copies"]):
                        now.row(row["role"], row["text"])
            yield {n: [o[n] for o in out] for n in names}
        if now is not None:
            if now.audit is None:
                now.settle()
            last = now.columns()
            yield {n: [last[n]] for n in names}

    return map_batches(dealt, run, schema)


def query(conversations: DataFrame) -> DataFrame:
    return repair(conversations)
