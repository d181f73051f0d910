import random

import pytest
from tokenizers import Tokenizer

from plumbline.llm.bpe import Codec, decoded, encoded, round_trip
from plumbline.llm.queries_tokens import tokenizer_path


@pytest.fixture(scope="module")
def both():
    return Codec(tokenizer_path()), Tokenizer.from_file(tokenizer_path())


def same(both, text):
    c, t = both
    want = t.encode(text, add_special_tokens=False)
    assert c.encode(text) == want.ids, text
    assert c.decode(want.ids) == t.decode(want.ids, skip_special_tokens=False) == c.encode_text(text)[1]


def test_random_texts(both):
    r = random.Random(3)
    for letters in ("abcdefghijklmnopqrstuvwxyz ", "aAbB'sdtre 019<|>end\n", "éüßñΣσςİıé́ .", "th", "日本語𝕏\U0001f600\u0558\u1c89 x"):
        for _ in range(400):
            same(both, "".join(r.choice(letters) for _ in range(r.randint(0, 40))))


def test_special_and_long(both):
    for text in ["", " \t", "<|endoftext|>", "a<|startoftext|><|endoftext|>b", "a" * 20_000, "the" * 5000, "x" * 63 + "y", "\x1c\x85\u200b", "e\u0301<|endoftext|>\u0301"]:
        same(both, text)


def test_each_byte_pair(both):
    for a in range(0, 0x600, 7):
        same(both, chr(a) + chr(a ^ 1) + "a" + chr(a))


def test_operator(spark, both):
    rows = [(1, "Hello, wörld", 5), (1, "Hello, wörld", 5), (2, None, 6), (None, "", 7), (3, "z " * 50_000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    ids = encoded(df, tokenizer_path())
    got = {(r.doc_id, tuple(r.ids)) for r in ids.collect()}
    assert got == {(i, tuple(both[1].encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows}
    assert {r.doc_id: r.text for r in decoded(ids, tokenizer_path()).collect()}[1] == "hello</w> ,</w> w Ã¶r ld</w>"
    trip = round_trip(df, tokenizer_path()).collect()
    assert sorted(r.n_tokens for r in trip) == sorted(len(both[1].encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows)
    assert encoded(df.limit(0), tokenizer_path()).count() == 0
