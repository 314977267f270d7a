"""Conversation repair against an independent search over edits."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from stratus.llm import repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """rows: (initial, must go, truncated).  Every edit string, by search."""
    best = None
    n = len(rows)

    def go(k, made, cost, audit, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == n and LEGAL.match(made):
            best = (cost, audit) if best is None else min(best, (cost, audit))
        if inserted < 2:
            for c in "ua":
                if not made or made[-1] != c:
                    go(k, made + c, cost + 2, audit + "I", inserted + 1)
        if k < n:
            initial, gone, late = rows[k]
            go(k + 1, made, cost + 3, audit + "D", 0)
            if not gone:
                go(k + 1, made + initial, cost + late, audit + "K", 0)
                for c in "ua":
                    go(k + 1, made + c, cost + 2 + late, audit + "R", 0)
    go(0, "", 0, "", 0)
    return best


def dynamic(rows):
    """The same right to left over (row, state): for longer conversations."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    after = {q: (0, "") for q in (0, 3)}
    def insert(cells):
        for _ in range(4):
            for (p, c), q in step.items():
                if c != "s" and q in cells:
                    new = (cells[q][0] + 2, "I" + cells[q][1])
                    cells[p] = min(cells.get(p, new), new)
        return cells
    after = insert(after)
    for initial, gone, late in reversed(rows):
        now = {p: (c + 3, "D" + a) for p, (c, a) in after.items()}
        if not gone:
            for (p, c), q in step.items():
                if q in after:
                    for edit, cost in ([("K", late)] if c == initial else []) + ([("R", 2 + late)] if c != "s" else []):
                        new = (after[q][0] + cost, edit + after[q][1])
                        now[p] = min(now.get(p, new), new)
        after = insert(now)
    return after[0]


def symbols(rows):
    return "".join(repair._symbol(i, g, t) for i, g, t in rows)


def test_cells_are_the_cheapest_edits():
    rnd = random.Random(5)
    for _ in range(250):
        rows = [(rnd.choice("suaox"), rnd.random() < .25, rnd.random() < .3) for _ in range(rnd.randint(0, 5))]
        assert repair.best(repair.parse(symbols(rows))) == cheapest(rows) == dynamic(rows), rows
    for n in (16, 17, 33, 100, 257):
        rows = [(rnd.choice("suuaa"), rnd.random() < .2, rnd.random() < .3) for _ in range(n)]
        assert repair.best(repair.parse(symbols(rows))) == dynamic(rows)


def test_any_split_gives_the_same_cells():
    rnd = random.Random(6)
    for _ in range(60):
        s = "".join(rnd.choice("suaoxSUA") for _ in range(12))
        k = rnd.randint(0, 12)
        assert repair.joined(repair.parse(s[:k]), repair.parse(s[k:])) == repair.parse(s)


def brute(rows):
    """rows: (conv_id, turn, role, text) -> result rows by plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        out = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(name.encode()) % 20
        if harm == 1:
            text = ""
        elif harm == 2:
            text = re.sub("[.!?]", "", text)
        elif harm == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)
    result = []
    for conv, after in convs.items():
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(r[2].encode()).hexdigest()))
        seen, marked = set(), []
        n = {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in after:
            chars = BLANK.findall(text)
            fault = ("blank" if not chars else "duplicate" if (role, text) in seen
                     else "truncated" if chars[-1] not in ".!?" else None)
            if fault:
                n[fault] += 1
            seen.add((role, text))
            marked.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, audit = dynamic([(i if i in ("s", "u", "a") else "o", g, t) for i, g, t in marked])
        turns = [t for t, *_ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        items, at = [], 0
        for edit in audit:
            want = "assistant" if items and items[-1][0] in ("user", "u") or items and items[-1][0][:1] == "u" else "user"
            if edit == "I":
                items.append((want, ""))
                continue
            _, role, text = after[at]
            at += 1
            if edit != "D":
                items.append((role if edit == "K" else want, text))
        digest = sha256("\n".join(f"{r}:{t}" for r, t in items).encode()).hexdigest()
        result.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest))
    return result


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def order(rows):
    return sorted(map(tuple, rows), key=str)


def odd_rows():
    rnd = random.Random(8)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rnd.randint(0, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, turn * 2, None]),
                         rnd.choice(["user", "assistant", "system", "u", "tool", "", None]),
                         rnd.choice(["Hi.", "What?", "no end", "", " \t\x0b", None, "é漢!", "Hi. ", "long " * 5000, "\x1c", "a\xa0"])))
    return rows + rows[::3]


@pytest.mark.parametrize("partitions", [1, 40])
def test_query_is_brute_force(spark, partitions):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)
    for name in ("conv", "kind", "h", "copies", "segment", "n", "blank"):
        df = df.withColumn(name, F.lit("clash"))
    assert order(repair.query(df).select(COLUMNS).collect()) == order(brute(rows))


def test_one_conversation_over_many_tasks(spark):
    rnd = random.Random(1)
    rows = [(7, k, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", f"b{k % 50}?", "c", f"d{k}"])) for k in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        assert repair.segments(repair.damaged(df)).count() > 3
        assert order(repair.query(df).select(COLUMNS).collect()) == order(brute(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert order(repair.query(df).select(COLUMNS).collect()) == order(brute(rows))


def test_nothing_left_and_empty(spark):
    # Conversation ids whose only turn is dropped by the damage rule.
    lost = [k for k in range(400) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    df = spark.createDataFrame([(k, 0, "user", "Hi.") for k in lost], "conv_id long, turn long, role string, text string")
    none = sha256(b"").hexdigest()
    assert order(repair.query(df).select(COLUMNS).collect()) == order([(k, 0, 0, 0, 0, 0, 0, "", none) for k in lost])
    assert repair.query(df.limit(0)).collect() == []
