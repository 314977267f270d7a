"""Secret scan with a randomness test battery, in DataFrame functions only.

Base spans come from three patterns (assignments, access keys, hex runs).  The
method adds `random` spans: tokens of 20 or more characters whose encoding can
be inferred (hex, base32, base36, base58, base62, base64, base64url) and which
pass a battery of tests for randomness:

* chi-squared of the characters against a uniform alphabet,
* Wald-Wolfowitz runs of codes in the upper and lower half of the alphabet,
* serial correlation of neighbouring codes,

each turned into a normal score; a token fails if its worst score lies beyond
`reject` (three tests, Bonferroni).  What passes is a finding only if an
ordinary token would rarely look so even.  Ordinary tokens are the corpus's own:
those that fail the battery.  They give, per stratum of encoding and length, mean
and spread of how often two characters agree (what chi-squared measures) and
of how often neighbours are of another kind (digit, small, capital letter,
other: runs), and the share of characters that fit a narrow alphabet by chance;
each starts from a prior that counts as PRIOR tokens.  The two scores are added
(Stouffer), and the chance of fitting the alphabet is charged for every second
character, since neighbours aren't independent.

Benjamini-Hochberg at level `fdr`, in each stratum, over the tokens that pass
the battery, sets the cut.  The p-values go through a histogram of 0.05-decade
bins (each counted by its upper edge), so the cut needs one aggregation of a
few thousand bins, not a global sort.

All spans are code points, end exclusive.  NULL text counts as empty; texts
without findings have zero counts and empty strings; repeated rows are each
scanned; an empty table gives no rows.  Places of n matches in one text are
summed in blocks of sqrt(n), so long texts with many matches stay cheap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import materialize, text_of

VALUE = "[A-Za-z0-9+/_.=-]+"
# Kinds in their order, pattern, and which group must have how
# many characters.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""" + VALUE, 12),
    ("access", "AKIA[A-Z0-9]+", 18),
    ("hex", "[0-9a-f]{16,}", 16),
)
RANDOM = "random"
# A token starts where no token character stands before it.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
# The alphabets, in the order in which they are tried.
_UP, _LOW, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("hex", _DIGITS + "abcdef", "0-9a-f"),
    ("HEX", _DIGITS + "ABCDEF", "0-9A-F"),
    ("base32", _UP + "234567", "A-Z2-7"),
    ("base36", _DIGITS + _LOW, "0-9a-z"),
    ("BASE36", _DIGITS + _UP, "0-9A-Z"),
    ("base58", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz", "1-9A-HJ-NP-Za-km-z"),
    ("base62", _DIGITS + _UP + _LOW, "0-9A-Za-z"),
    ("base64", _UP + _LOW + _DIGITS + "+/", "A-Za-z0-9+/"),
    ("base64url", _UP + _LOW + _DIGITS + "-_", "A-Za-z0-9_-"),
)
NARROW = 5                           # so many of them hold one case of letters only
LENGTHS = (20, 32, 64, 128)          # lower ends of the length strata
# What is held of ordinary tokens before any is seen, as so many tokens: how
# often characters agree and change their kind, the spread of both from token
# to token, and the share of characters in a narrow alphabet.
PRIOR = 20
PRIOR_AGREE, PRIOR_AGREE_SD = 0.06, 0.02
PRIOR_CHANGE, PRIOR_CHANGE_SD = 0.2, 0.1
PRIOR_SHARE = 0.5
REJECT = 3.4
FDR = 0.01
BIN = 0.05                           # decades of a p-value per bin
TOP_BIN = 400                        # beyond p = 1e-20 bins aren't told apart
_SPAN = "array<struct<start:int,end:int,kind:string>>"


def found(text: Column, pattern: str) -> tuple[Column, Column]:
    """Gaps and matches, in step: the text in front of each leftmost match and
    the match; the last gap is the rest of the text, with an empty match."""
    both = f"(?s)(.*?)({pattern}|\\z)"
    return F.regexp_extract_all(text, F.lit(both), F.lit(1)), F.regexp_extract_all(text, F.lit(both), F.lit(2))


def let(x: Column, body) -> Column:
    """body(x) with x computed once."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def spans(text: Column, pattern: str, kind: str) -> Column:
    """All matches as (start, end, kind, token) in code points."""
    gaps, hits = found(text, pattern)
    steps = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("g"), h.alias("h")))
    none = F.array().cast("array<struct<start:int,end:int,kind:string,token:string>>")

    def step(acc, x):
        begin = acc["at"] + x["g"]
        end = begin + F.length(x["h"])
        hit = F.array(F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["h"].alias("token")))
        return F.struct(end.alias("at"), F.when(x["h"] != "", F.concat(acc["out"], hit)).otherwise(acc["out"]).alias("out"))

    def placed(block, at):
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def starts(blocks):
        lengths = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["g"] + F.length(x["h"])))
        return F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                           lambda acc: acc["out"])

    def in_blocks(st):
        size = F.ceil(F.sqrt(F.size(st))).cast("int")
        blocks = F.transform(F.sequence(F.lit(1), F.size(st), size), lambda k: F.slice(st, k, size))
        return let(blocks, lambda b: F.flatten(F.zip_with(b, starts(b), placed)))

    return let(steps, lambda st: F.when(F.size(st) > 64, in_blocks(st)).otherwise(placed(st, F.lit(0))))


def _of_length(found_spans: Column, shape: str, least: int) -> Column:
    return F.filter(found_spans, lambda s: F.length(F.regexp_extract(s["token"], shape, 1)) >= least)


def base_spans(text: Column) -> Column:
    """Spans of the three kinds that meet their length, unsorted."""
    parts = []
    for kind, pattern, least in KINDS:
        # The value of an assignment is what its pattern ends in.
        shape = f"^(?:{pattern.replace(VALUE, f'({VALUE})')})$" if kind == "assign" else "^(.*)$"
        parts.append(_of_length(spans(text, pattern, kind), shape, least))
    return F.concat(*parts)


# ----------------------------------------------------------------- battery --

def _encoding(token: Column) -> Column:
    mixed = (token.rlike("[0-9]").cast("int") + token.rlike("[a-z]").cast("int") + token.rlike("[A-Z]").cast("int")) >= 2
    out = F.lit(None).cast("string")
    for name, _, letters in reversed(ENCODINGS):
        out = F.when(mixed & token.rlike(f"^[{letters}]+$"), F.lit(name)).otherwise(out)
    return out


def battery(token: Column, encoding: Column) -> Column:
    """Struct of normal scores chi, runs and serial, and of agree (how often two
    characters are equal) and change (how often neighbours differ in kind)."""
    alphabet = F.create_map(*[F.lit(x) for name, letters, _ in ENCODINGS for x in (name, letters)])[encoding]
    zero = F.lit(0.0)
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)
    tail = lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    head = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))

    def scores(codes):
        n, m = F.size(codes).cast("double"), F.length(alphabet).cast("double")
        agree = total(F.transform(F.array_distinct(codes), lambda d: F.pow(F.size(F.filter(codes, lambda c: c == d)).cast("double"), F.lit(2.0))))
        chi = m / n * agree - n
        z_chi = (chi - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n)

        upper = F.transform(codes, lambda c: (c >= m / 2).cast("double"))
        n1 = total(upper)
        n0 = n - n1
        flips = total(F.zip_with(tail(upper), head(upper), lambda a, b: F.abs(a - b)))
        expected = 2 * n0 * n1 / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, (flips + 1 - expected) / F.sqrt(spread)).otherwise(F.lit(99.0))

        mean = total(codes) / n
        var = total(F.transform(codes, lambda c: (c - mean) * (c - mean)))
        cov = total(F.zip_with(tail(codes), head(codes), lambda a, b: (a - mean) * (b - mean)))
        z_serial = F.when(var > 0, (cov / var + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(99.0))

        kinds = F.split(F.translate(token, _DIGITS + _LOW + _UP, "0" * 10 + "a" * 26 + "A" * 26), "")
        change = let(F.filter(kinds, lambda c: c != ""), lambda k: total(
            F.zip_with(tail(k), head(k), lambda a, b: (a != b).cast("double"))))
        return F.struct(z_chi.alias("chi"), z_runs.alias("runs"), z_serial.alias("serial"),
                        ((agree - n) / (n * (n - 1))).alias("agree"), (change / (n - 1)).alias("change"))

    codes = F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c).cast("double") - 1)
    return let(F.filter(codes, lambda c: c >= 0), scores)


def log10_p(z: Column) -> Column:
    """log10 of the lower normal tail at z, by the continued-fraction bound
    phi(x) / (x + 1 / (x + 2 / (x + 3 / (x + 4)))) (above 0: log10 of 0.5 or more counts as 0)."""
    x = F.greatest(-z, F.lit(0.0)) + 1e-9
    tail = x + 4
    for a in (3, 2, 1):
        tail = x + a / tail
    value = (-x * x / 2 - 0.5 * math.log(2 * math.pi) - F.log(tail)) / math.log(10)
    return F.least(value, F.lit(math.log10(0.5)))


def candidates(text: Column, reject: float = REJECT) -> Column:
    """Long tokens: (start, end, enc, stratum, agree, change, even, inside).
    enc is NULL where no encoding fits, even says that the battery is passed,
    inside counts the characters in each narrow alphabet."""
    named = F.transform(spans(text, TOKEN, RANDOM), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["token"].alias("token"), _encoding(s["token"]).alias("enc")))
    tested = F.transform(named, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["enc"].alias("enc"), F.array(*[
        F.length(F.regexp_replace(s["token"], f"[^{letters}]", "")) for _, _, letters in ENCODINGS[:NARROW]]).alias("inside"),
        F.when(s["enc"].isNotNull(), battery(s["token"], s["enc"])).alias("z")))
    stratum = lambda s: F.concat(s["enc"], F.lit(":"), sum(
        ((s["end"] - s["start"]) >= k).cast("int") for k in LENGTHS).cast("string"))
    even = lambda z: F.coalesce(F.greatest(F.abs(z["chi"]), F.abs(z["runs"]), F.abs(z["serial"])) <= reject, F.lit(False))
    return F.transform(tested, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["enc"].alias("enc"), stratum(s).alias("stratum"),
        s["z"]["agree"].alias("agree"), s["z"]["change"].alias("change"), even(s["z"]).alias("even"), s["inside"].alias("inside")))


def ordinary(found_tokens: DataFrame) -> tuple[dict, dict]:
    """What the corpus's ordinary tokens look like: (mean agree, sd, mean change,
    sd) per stratum, and the share of characters in each encoding's alphabet.
    One row per stratum and one in all come to the driver."""
    plain = found_tokens.select(F.explode("candidates").alias("c")).filter("NOT c.even").select("c.*")
    stats = [F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}{k}") for c in ("agree", "change")
             for k, f in (("1", F.sum), ("2", lambda c: F.sum(F.col(c) * F.col(c))))]]
    seen = {r.stratum: r for r in plain.filter("enc IS NOT NULL").groupBy("stratum").agg(*stats).collect()}
    out = {}
    for name, _, _ in ENCODINGS:
        for k, least in enumerate(LENGTHS):
            row = seen.get(f"{name}:{k + 1}")
            line = []
            for stat, mean, sd, trials in (("agree", PRIOR_AGREE, PRIOR_AGREE_SD, least * (least - 1) / 2),
                                           ("change", PRIOR_CHANGE, PRIOR_CHANGE_SD, least - 1)):
                var = mean * (1 - mean) / trials + sd * sd
                n, s1, s2 = (row.n, row[f"{stat}1"], row[f"{stat}2"]) if row else (0, 0.0, 0.0)
                m = (PRIOR * mean + s1) / (PRIOR + n)
                second = (PRIOR * (var + mean * mean) + s2) / (PRIOR + n)
                line += [m, math.sqrt(max(second - m * m, m * (1 - m) / trials))]
            out[f"{name}:{k + 1}"] = line
    inside = plain.agg(F.sum(F.col("end") - F.col("start")).alias("all"),
                       *[F.sum(F.get("inside", F.lit(k))).alias(f"i{k}") for k in range(NARROW)]).first()
    held, length = PRIOR * LENGTHS[0], inside["all"] or 0
    share = {name: (held * PRIOR_SHARE + (inside[f"i{k}"] or 0)) / (held + length) if k < NARROW else 1.0
             for k, (name, _, _) in enumerate(ENCODINGS)}
    return out, share


def with_bins(found_tokens: DataFrame) -> DataFrame:
    """`candidates` cut down to the tokens that pass the battery, each with the
    bin of its p-value."""
    looks, share = ordinary(found_tokens)
    look = F.create_map(*[x for k, v in looks.items() for x in (F.lit(k), F.array(*[F.lit(float(y)) for y in v]))])
    fits = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, math.log10(v))])

    def log_p(c):
        agree, agree_sd, change, change_sd = (F.get(look[c["stratum"]], F.lit(k)) for k in range(4))
        z = ((c["agree"] - agree) / agree_sd - (c["change"] - change) / change_sd) / math.sqrt(2)
        return log10_p(z) + fits[c["enc"]] * (c["end"] - c["start"]) / 2

    even = F.filter("candidates", lambda c: c["even"])
    return found_tokens.withColumn("candidates", F.transform(even, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["stratum"].alias("stratum"),
        F.least(F.floor(-log_p(c) / BIN), F.lit(TOP_BIN)).cast("int").alias("bin"))))


def cuts(found_tokens: DataFrame, fdr: float = FDR) -> dict[str, int]:
    """Smallest bin that Benjamini-Hochberg accepts, per stratum.  The bins of
    a stratum are few hundred numbers whatever the corpus holds."""
    bins = (found_tokens.select(F.explode("candidates").alias("c"))
            .groupBy("c.stratum", "c.bin").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("stratum")
    ranked = (bins.withColumn("all", F.sum("n").over(w))
              .withColumn("rank", F.sum("n").over(w.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0))))
    ok = ranked.filter(F.pow(F.lit(10.0), -F.col("bin") * BIN) <= F.lit(fdr) * F.col("rank") / F.col("all"))
    return {r.stratum: r.cut for r in ok.groupBy("stratum").agg(F.min("bin").alias("cut")).collect()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """doc_id, base and spans: arrays of (start, end, kind), by start, then kind."""
    order = F.create_map(*[F.lit(x) for k, (name, _, _) in enumerate((*KINDS, (RANDOM, "", 0))) for x in (name, k)])
    by_place = lambda a: F.transform(F.array_sort(F.transform(a, lambda s: F.struct(
        s["start"], order[s["kind"]], s["end"], s["kind"]))), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    text = F.col("text")
    bare = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    first = materialize(
        docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
        .select("doc_id", F.transform(base_spans(text), bare).cast(_SPAN).alias("base"), candidates(text).alias("candidates")),
        "op2-spans")
    first = with_bins(first)
    accepted = cuts(first, fdr)
    cut = F.create_map(*[F.lit(x) for kv in accepted.items() for x in kv]) if accepted else None
    base = F.col("base")
    if cut is None:
        added = F.array().cast(_SPAN)
    else:
        good = F.filter("candidates", lambda c: (c["bin"] >= cut[c["stratum"]])
                        & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
        added = F.transform(good, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"),
                                                     F.lit(RANDOM).alias("kind"))).cast(_SPAN)
    return first.select("doc_id", by_place(base).alias("base"), by_place(F.concat(base, added)).alias("spans"))


def text_of_spans(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(docs: DataFrame) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select("doc_id", *[n(k).alias(f"n_{k}") for k, _, _ in KINDS],
                             F.sha2(text_of_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                             text_of_spans(F.col("spans")).alias("spans"))
