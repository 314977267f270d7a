"""Cross-tokenizer alignment against the libraries on whole texts."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from stratus.llm import alignment
from stratus.llm.tokens import vocabulary

BYTE, PIECE = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
RANKS = vocabulary("byte_bpe_50k.tiktoken")
BITS = ["a", "b ", "ab.", "z,", "ing.\n", "e, ", "  ", " ", "\n", "\t", " \n", "the", " The", "漢字", "é", "🙂", "<s>", "</s>", "<0x41>",
        "<|endoftext|>", "q", "12", ".", "\x00", "\x85", "\xa0", "    ", "'s", "\x1c", " ", "ation", "====="]


def texts(n, seed, bits=BITS):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def whole():
    """text -> (ids of A, ids of B, groups as lists of ids) by whole texts and
    sets of ends, with the bytes of tokens taken from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    a_tok, b_tok = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_tok.encode_special_tokens = True
    names = {k: t for t, k in a_tok.get_vocab().items()}
    alphabet = {}
    for x in range(256):        # each byte's character, from the file's own decoder
        alphabet.update({c: x for c in names.values() if len(c) == 1 and x < 128 and
                         decoders.ByteLevel().decode([c]) == chr(x)})
    rest = sorted(c for c in {c for t in names.values() for c in t} - set(alphabet))
    shown = [c for c in rest if 0xA1 <= ord(c) < 0x100]
    alphabet.update({c: ord(c) for c in shown})
    others = [x for x in range(128, 256) if x not in {ord(c) for c in shown}]
    alphabet.update(dict(zip([c for c in rest if c not in shown], others, strict=False)))

    def run(text):
        if not text:
            return None
        a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
        a_bytes = [bytes(alphabet[c] for c in names[k]) for k in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(k) else p.replace("▁", " ").encode()
                   for k, p in ((k, b_tok.id_to_piece(k)) for k in b)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        ends = []
        for pieces in (a_bytes, b_bytes):
            at, found = 0, []
            for p in pieces:
                at += len(p)
                found.append(at)
            ends.append(found)
        groups, now = [], ([], [])
        both = set(ends[0]) & set(ends[1])
        merged = sorted([(e, 0, k) for e, k in zip(ends[0], a, strict=True)] +
                        [(e, 1, k) for e, k in zip(ends[1], b, strict=True)], key=lambda x: x[0])
        for n, (end, side, k) in enumerate(merged):
            now[side].append(k)
            if end in both and (n + 1 == len(merged) or merged[n + 1][0] > end):
                groups.append(now)
                now = ([], [])
        return a, b, groups
    return run


def brute(rows, whole):
    found = [(i, whole(t or "")) for i, t in rows]
    counts = Counter()
    for _, f in found:
        counts.update({(x, y) for a, b in (f[2] if f else []) for x in a for y in b})
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for a, b in f[2] for x in a for y in b]
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in f[2])
        out.append((i, len(f[0]), len(f[1]), len(f[2]), len(links), sum(counts[p] == highest[p[0]] for p in links),
                    sum(counts[p] for p in links), sha256(shown.encode()).hexdigest()))
    return out


def test_align_divides_at_every_cut():
    rnd = random.Random(4)
    for _ in range(500):
        last = rnd.randint(1, 40)
        a, b = (sorted({*rnd.sample(range(1, last + 1), rnd.randint(1, last)), last}) for _ in range(2))
        cuts = sorted(set(a) & set(b))
        want, before = [], (0, 0)
        for c in cuts:
            here = (a.index(c) + 1, b.index(c) + 1)
            want.append((before[0], here[0], before[1], here[1]))
            before = here
        assert alignment.align(a, b) == want
    assert alignment.align([], []) == []


def test_parts_are_whole_texts():
    tools = alignment.aligner(RANKS, PIECE)
    for text in texts(1500, 7) + texts(200, 8, BITS + ["▁"]) + ["漢字x" * 3000, "a" * 5000, " " * 300, "=" * 999]:
        parts, whole = tools.document(text), tools.document(text, False)
        assert (parts is None) == (whole is None), text
        if parts:
            assert parts[:4] == whole[:4], text
            assert parts[4].tolist() == whole[4].tolist() and parts[5].tolist() == whole[5].tolist()


def test_align_many_is_align_of_each():
    rnd, want, ends, todo, at = random.Random(5), [], ([], []), [], 0
    for _ in range(300):
        last = rnd.randint(1, 40)
        here = [sorted({*rnd.sample(range(1, last + 1), rnd.randint(1, last)), last}) for _ in range(2)]
        lo = [len(e) for e in ends]
        want += [(p + lo[0], q + lo[0], r + lo[1], s + lo[1]) for p, q, r, s in alignment.align(*here)]
        for e, h in zip(ends, here, strict=True):
            e.extend(at + x for x in h)
        todo.append((lo[0], len(ends[0]), lo[1], len(ends[1])))
        at += last
    got = alignment.align_many(*map(alignment.np.array, ends), alignment.np.array(todo).T)
    assert list(zip(*got.tolist(), strict=True)) == want


@pytest.mark.parametrize("group,block", [(1, 3), (400, 7), (1 << 20, 1 << 14)])
def test_texts_share_the_calls_of_the_tokenizers(monkeypatch, group, block):
    # A call of B's library costs as much as hundreds of parts: one a text is too many.
    monkeypatch.setattr(alignment, "_GROUP", group)
    monkeypatch.setattr(alignment, "_BLOCK", block)
    some = texts(400, 11) + ["", "one ▁ two", "▁", "漢字x" * 300, "=" * 999, "", "xyz" * 40 + " end."] + texts(100, 12, BITS + ["▁"])
    tools, calls = alignment.Aligner(RANKS, PIECE), []
    encode = tools._b.encode
    monkeypatch.setattr(tools._b, "encode", lambda parts, **how: calls.append(len(parts)) or encode(parts, **how))
    got = list(tools.documents(iter(some)))
    assert max(calls) <= block
    if group > sum(map(len, some)):
        # One for short parts, one for others, and one for each text that its parts don't spell.
        assert len(calls) <= 2 + sum("▁" in t for t in some) < len(some) / 2
    assert len(got) == len(some)
    for text, found in zip(some, got, strict=True):
        want = tools.document(text, False)
        assert (found is None) == (want is None), text
        if found:
            assert found[:4] == want[:4] and found[4].tolist() == want[4].tolist() and found[5].tolist() == want[5].tolist()


@pytest.mark.parametrize("chunk", [1, 300, alignment.CHUNK])
def test_query_is_brute_force(spark, odd, whole, chunk):
    rows = [(1000 + k, t) for k, t in enumerate(texts(120, 3) + ["▁x", "a▁b", "one ▁"])]
    df = odd.select("doc_id", "text", "score", "n").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("n", F.lit("y")))
    got = alignment.cross_align(df, chunk=chunk).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], whole)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got) == order(want)


def test_documents_against_whole_texts(spark, whole):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = alignment.query(docs).collect()
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], whole)
    assert sorted(map(tuple, got)) == sorted(want)


def test_ranks_give_the_ids_of_the_json_file():
    from tokenizers import Tokenizer
    json_tok, ranks = Tokenizer.from_file(BYTE), alignment.aligner(RANKS, PIECE)._a
    json_tok.encode_special_tokens = True
    blocks = ["".join(f" a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}!" for c in range(lo, lo + 512) if not 0xD800 <= c < 0xE000)
              for lo in range(0, 0x110000, 512)]
    for text in [b for b in blocks if b] + texts(300, 21):
        assert ranks.encode_ordinary(text) == json_tok.encode(text, add_special_tokens=False).ids


def test_long_group_keeps_distinct_pairs(monkeypatch):
    # A cutless group of many tokens costs its distinct pairs, not its links.
    tools = alignment.aligner(RANKS, PIECE)
    text = " " + "xyz" * 60
    (a, b), = tools.tokens([text])
    monkeypatch.setattr(alignment, "align", lambda ends_a, ends_b: [(0, len(ends_a), 0, len(ends_b))])
    shown, n_a, n_b, groups, pairs, often = tools._groups(text, a, b)
    assert groups == 1 and alignment.np.frombuffer(often, int).sum() == len(a) * len(b) >= 64
    assert len(pairs) // 8 == len(set(a)) * len(set(b)) < len(a) * len(b)
    narrow = alignment._narrow(alignment.np.array([1, 300, 70_000]))
    assert alignment._wide(narrow, 3).tolist() == [1, 300, 70_000]


def test_cutless_text_is_one_group(whole):
    # A text whose tokens share no cut but the last.
    tools = alignment.aligner(RANKS, PIECE)
    for text in ["漢" * 200, "\U0001f642" * 100, "ﷺ" * 60]:
        a, b, groups = whole(text)
        got = tools.document(text)
        links = [(x << 32) | y for g in groups for x in g[0] for y in g[1]]
        assert got[3] == len(groups) and int(got[5].sum()) == len(links)
        assert got[4].tolist() == sorted(set(links))


def test_empty(empty):
    assert alignment.query(empty).collect() == []
