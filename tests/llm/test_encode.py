import random

import pytest

pytest.importorskip("tiktoken")
pytest.importorskip("public_tokenizers")

from helpers import with_clashes

from skyloom.llm import encode

TEXTS = [
    None, "", " ", "\n\n\n", "Hello world", "don't   stop\n\n  now\t\tx  ", "<|endoftext|> is text", "naïve café – 12345678 €", "日本語テキスト" * 40, "a" * 700, " " * 700, "x" * 150 + " " + "y" * 150 + "\n" * 90 + "z",
    "The quick brown fox, 1234.5 jumps!\n" * 60, "🙂" * 130 + " end", "\r\n".join(["line " * 9] * 30),
]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def ids(df):
    return {r["doc_id"]: list(r["ids"]) for r in df.collect()}


@pytest.mark.parametrize("chunk, overlap, spread", [(encode.CHUNK, encode.OVERLAP, encode.SPREAD), (64, 16, 64), (64, 16, 10_000), (33, 5, 200), (7, 1, 7), (7, 1, 10_000)])
def test_chunks_equal_the_whole(spark, chunk, overlap, spread):
    want = {i: encode.encode_text(t) for i, t in enumerate(TEXTS)}
    assert ids(encode.encode_corpus(documents(spark), chunk=chunk, overlap=overlap, spread=spread)) == want
    assert want[0] == want[1] == []


def test_pieces(spark):
    got = {r["doc_id"]: (r["chunks"], r["pieces"]) for r in encode.corpus_pieces(documents(spark), 64, 16).collect()}
    assert got[0] == got[1] == (0, 0) and got[4] == (1, 1)
    assert got[9] == (11, 1)  # one pre-token longer than every overlap
    assert got[12][0] == got[12][1] > 20  # every overlap has a common boundary
    for t in TEXTS:
        assert "".join(encode.pieces(t or "", 16, 5)) == (t or "")


def test_random_texts(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["a", "b", " ", "  ", "\n", "'s", "7", "é", "—", "Wort", "'", "\t"]) for _ in range(rnd.randrange(400))) for _ in range(60)]
    want = {i: encode.encode_text(t) for i, t in enumerate(texts)}
    assert ids(encode.encode_corpus(documents(spark, texts), chunk=40, overlap=9, spread=40)) == want
    for chunk, overlap in ((40, 9), (11, 3), (100, 20)):
        assert {i: encode.encode_pieces(t, chunk=chunk, overlap=overlap) for i, t in enumerate(texts)} == want


def test_round_trip_and_other_library():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for x in TEXTS:
        if x:
            assert encode.decode(encode.encode_text(x)) == x
            assert t.encode(x, add_special_tokens=False).ids == encode.encode_text(x)


def test_repeated_rows_clashes_empty(spark):
    d = documents(spark, ["a b", "c " * 50])
    assert encode.encode_corpus(d.union(d), chunk=16, overlap=4, spread=16).count() == 4
    assert ids(encode.encode_corpus(with_clashes(d), chunk=16, overlap=4, spread=16)) == {0: encode.encode_text("a b"), 1: encode.encode_text("c " * 50)}
    assert encode.encode_corpus(d.limit(0)).count() == 0
    with pytest.raises(ValueError):
        encode.encode_corpus(d, chunk=4, overlap=4)

