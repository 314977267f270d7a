"""Tree reduction against tiktoken."""

import random
from hashlib import sha256

import pytest

from stratus.llm import bpe_tree
from stratus.llm.tokens import vocabulary

PATH = vocabulary("byte_bpe_multi_50k.tiktoken")
BPE = bpe_tree.tree_bpe(PATH)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=BPE._ranks, special_tokens={})


def samples(n):
    rnd = random.Random(11)
    tokens = [BPE._bytes[rnd.randrange(len(BPE._bytes))].decode("utf-8", "ignore").strip() for _ in range(5000)]
    for k in range(n):
        size = rnd.choice([2, 12, 80, 400])
        yield "".join(rnd.choice(tokens if k % 2 else "abcdefghij éß漢🙂\n '1") for _ in range(size))


@pytest.mark.parametrize("leaf", [1, 2, 7, bpe_tree.LEAF])
def test_like_the_library(library, leaf):
    bpe = bpe_tree.TreeBPE(BPE._ranks, library._pat_str, leaf)
    for text in [*samples(300), "", "a" * 3000, "ab" * 1500, "aab" * 700, "=-" * 400, "漢字" * 500, " " * 700,
                 "\x1c\x1d x\x85y\xa0z", "ÀÉ" * 400, "<|endoftext|> a", "ation" * 300]:
        ids = bpe.encode(text)
        assert ids == library.encode_ordinary(text), text[:50]
        assert bpe.decode(ids) == text.encode()


def test_join_is_associative():
    rnd = random.Random(2)
    for _ in range(300):
        a, b, c = (BPE._tree("".join(rnd.choice("abcdéationthe ") for _ in range(rnd.randint(0, 40))).encode()) for _ in range(3))
        assert BPE.join(BPE.join(a, b), c) == BPE.join(a, BPE.join(b, c)) == BPE._merge(BPE.decode(a + b + c))


def test_both_merge_loops_agree():
    rnd = random.Random(9)
    for _ in range(300):
        data = "".join(rnd.choice("aab bc") for _ in range(rnd.randint(0, 60))).encode()
        assert BPE._merge_few(data) == BPE._merge_many(data)


def test_decoding_up_the_tree(monkeypatch):
    ids = BPE.encode("the quick brown fox " * 50)
    want = BPE.decode(ids)
    monkeypatch.setattr(bpe_tree, "_FAN", 3)
    assert BPE.decode(ids) == want == b"the quick brown fox " * 50


def test_query(spark, odd, library):
    got = bpe_tree.query(odd).collect()
    want = []
    for r in odd.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     sha256((r.text or "").encode()).hexdigest()))
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got) == order(want)
    ids = {tuple(r.ids): bytes(r.decoded) for r in bpe_tree.round_trip(odd, PATH).collect()}
    assert all(BPE.decode(list(k)) == v for k, v in ids.items())


def test_empty(empty):
    assert bpe_tree.query(empty).collect() == []
