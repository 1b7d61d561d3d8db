"""Packing: ids against the tokenizer itself, pieces and sequences by exact round trip."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketry.llm import packing
from basketry.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, texts, tok):
    """texts: (doc_id, text) pairs with distinct ids."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert len(by_doc) == len(texts)
    for doc_id, text in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return sum(r.length for r in rows) / (1024 * len(by_seq))


def test_query_round_trip(spark, tok):
    from basketry.llm.queries import QUERIES
    texts = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert check(QUERIES["op10_packing"](spark, SF).collect(), texts, tok) > 0.97


def test_ids_of_odd_texts(tok):
    coder = packing.token_bytes(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    odd = ["", " ", "  ", "a  b", "a   b ", " a", "a \n b", "a\n\n b", "\t x  y", "it's we'll '", "<|endoftext|> a", "é ü 中文 😀 1234 12a", "a   b",
           *("".join(rng.choice(" \n\tab'.1é中s") for _ in range(40)) for _ in range(400))]
    for text in odd:
        got = np.frombuffer(coder.encode(text), dtype="<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_every_length_once(seed):
    rng = random.Random(seed)
    cap = rng.choice([8, 64, 1024])
    hist = {rng.randint(1, cap): rng.randint(1, 10 ** rng.randint(0, 6)) for _ in range(rng.randint(1, 60))}
    used = Counter()
    for count, lengths in packing.shortest_pack_first(hist, cap):
        assert count > 0 and 0 < sum(lengths) <= cap
        for length in lengths:
            used[length] += count
    assert used == hist


def test_one_hot_length_packs_full():
    (count, lengths), = packing.shortest_pack_first({256: 4000}, 1024)
    assert count == 1000 and lengths == [256] * 4


def test_odd_rows(spark, tok):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, "a  b"), (4, long), (5, "same text"), (6, "same text"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length long, offset string")
    check(packing.pack(df).collect(), rows, tok)
    twice = packing.pack(df.union(df)).collect()
    assert Counter((r.doc_id, r.start) for r in twice) == {k: 2 * v for k, v in Counter((r.doc_id, r.start) for r in packing.pack(df).collect()).items()}
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice)
    assert packing.pack(df.limit(0)).count() == 0
    assert sorted(map(str, twice)) == sorted(map(str, packing.pack(df.union(df)).collect()))


def test_added_tokens_as_the_tokenizer_is_loaded(spark):
    as_loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert as_loaded.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    rng = random.Random(2)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>  x", "a b<|endoftext|>", "<|endoftext| <|<|endoftext|>|>", "endoftext", "no marker here",
             "w <|endoftext|> " * 900, *("".join(rng.choice(["<|endoftext|>", " ", "\n", "a", "b's", ".", "é"]) for _ in range(30)) for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(packing.pack(df).collect(), list(enumerate(texts)), as_loaded)
