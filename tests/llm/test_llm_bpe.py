"""Byte-level BPE against the tokenizer library and exact round trips."""

import random

import public_tokenizers
import pytest
import tiktoken

from changelake.llm import bpe

VOCABULARY = bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=VOCABULARY.pattern, mergeable_ranks=VOCABULARY.ranks, special_tokens={})


def odd_texts():
    rng = random.Random(8)
    letters = "ab'sreLl 19é日\n\t  .,!<|end 　²Ⅷ😀‍́"
    out = [None, "", " ", "\n\n \n", "x" * 20_000, "it's we're I'll " * 500, " \n" * 4_000, "1" * 9_000, "<|endoftext|>", "日本語" * 3_000,
           "'" * 3000 + "re", "a  b   c\t\n\n d" * 900, "\x1c\x1d\x85  a"]
    return out + ["".join(rng.choices(letters, k=rng.choice([1, 3, 9, 40, 400]))) for _ in range(400)]


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (64, 12), (200, 40)])
def test_ids_and_round_trip(spark, chunk, overlap):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(4)
    rows = bpe.decode(bpe.encode(df, VOCABULARY, chunk=chunk, overlap=overlap), VOCABULARY).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.n] or ""
        assert r.ids == REFERENCE.encode_ordinary(text)
        assert bytes(r.bytes) == text.encode()


def test_every_ascii_character_in_context():
    cache = bpe._Cache(VOCABULARY)
    for c in map(chr, range(128)):
        for text in (f"a{c}1!{c} {c}  {c}b", f"{c}{c}", f"'{c}", f" {c}'s\n{c}"):
            assert list(memoryview(cache.encode(text)).cast("i")) == REFERENCE.encode_ordinary(text)


def test_long_and_short_merges_agree():
    rng = random.Random(1)
    for n in (2, 10, 47, 49, 300, 5000):
        piece = bytes(rng.choices(b"abc\xc3\xa9", k=n))
        assert bpe.merge(piece, VOCABULARY.ranks) == REFERENCE._encode_single_piece(piece)


def test_repeated_rows_clashing_columns_and_no_rows(spark):
    long = "word " * 300
    df = spark.createDataFrame([(1, long, "k"), (1, long, "k"), (2, None, "k")], "i int, text string, text_key string")
    rows = bpe.encode(df, VOCABULARY, chunk=64, overlap=16)
    assert rows.columns == ["i", "text", "text_key", "ids"]
    assert sorted(len(r.ids) for r in rows.collect()) == [0, *[len(REFERENCE.encode_ordinary(long))] * 2]
    assert bpe.decode(bpe.encode(df.limit(0), VOCABULARY), VOCABULARY).collect() == []


def test_unknown_ids_are_an_error(spark):
    df = spark.createDataFrame([([1, 999_999],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(df, VOCABULARY).collect()


def test_short_pre_tokens_are_merged_together(monkeypatch):
    def alone(piece, ranks):
        raise AssertionError("a short pre-token was merged by itself")
    rng = random.Random(5)
    rows = [" ".join("".join(rng.choices("abdeéorßt日😀ñ", k=rng.randint(1, 12))) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    expected = [REFERENCE.encode_ordinary(r) for r in rows]
    monkeypatch.setattr(bpe, "merge", alone)
    cache = bpe._Cache(VOCABULARY)
    for limit, block in ((bpe.SLICE, bpe.ROWS), (70, 3), (1, 1)):
        monkeypatch.setattr(bpe, "SLICE", limit)
        monkeypatch.setattr(bpe, "ROWS", block)
        assert cache.encode_all(map(cache.tokens, rows)).to_pylist() == expected
    assert cache.encode_all([]).to_pylist() == []
    assert cache.encode_all([[], []]).to_pylist() == [[], []]


def test_merges_of_every_length_and_repeated_bytes():
    rng = random.Random(6)
    pieces = [a * n for a in ("a", "ab", "é", "日", "x1") for n in range(1, 70)]
    pieces += ["".join(rng.choices("abcé", k=n)) for n in range(1, 70) for _ in range(5)]
    got = bpe._Cache(VOCABULARY).encode_all([p] for p in pieces)
    assert got.to_pylist() == [bpe.merge(p.encode(), VOCABULARY.ranks) for p in pieces]


def test_ranks_that_are_not_in_the_order_of_the_merges():
    # "bc" outranks "ab" only after a merge; a token that no merge reaches counts when it is whole.
    ranks = {bytes([b]): 1000 + b for b in range(256) if b != ord("z")} | {b"ab": 70, b"cd": 60, b"bcd": 3, b"abcd": 90, b"xyx": 5, b"dab": 2}
    cache = bpe._Cache(bpe.Vocabulary(ranks, VOCABULARY.pattern))
    rng = random.Random(7)
    pieces = ["xyx", "xyxx", "abcd", "dabcd", "abab"] + ["".join(rng.choices("abcdxy", k=rng.randint(1, 40))) for _ in range(500)]
    assert cache.encode_all([p] for p in pieces).to_pylist() == [bpe.merge(p.encode(), ranks) for p in pieces]
    with pytest.raises(KeyError):
        cache.encode("abz")
    with pytest.raises(ValueError, match="same rank"):
        bpe._Cache(bpe.Vocabulary(ranks | {b"ba": 70}, VOCABULARY.pattern))
