"""Encoding and decoding of a corpus with a public byte-level tokenizer, texts of any length in parallel."""

from __future__ import annotations

import base64
import importlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The tokenizer's file and, beside it, the package that describes it; both can be given.
TOKENIZER = "byte_bpe_50k"
#: Texts are cut into chunks of CHUNK characters that run OVERLAP characters into the next.
CHUNK, OVERLAP = 1 << 11, 1 << 8
#: Chunks of a text up to SPREAD characters are stitched where the text lies; those of a longer one are spread over tasks.
SPREAD = 1 << 16


def _place() -> tuple[str, str]:
    """The folder of the vocabulary files and the pre-tokenizer's pattern: environment ``TOKENIZERS_DIR``, else the package."""
    p = importlib.import_module("public_tokenizers")
    return os.environ.get("TOKENIZERS_DIR") or os.path.dirname(p.path(f"{TOKENIZER}.tiktoken")), p.PATTERN


@lru_cache(maxsize=2)
def encoding(name: str = TOKENIZER):
    """The tokenizer, loaded once in each worker process. It has no special tokens: their strings in a text are ordinary text."""
    import tiktoken

    folder, pattern = _place()
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _pattern() -> regex.Pattern:
    return regex.compile(_place()[1])


def boundaries(text: str, until: int | None = None) -> list[int]:
    """Ends of the pre-tokens of a text, those up to ``until``."""
    ends = []
    for m in _pattern().finditer(text):
        if until is not None and m.end() > until:
            break
        ends.append(m.end())
    return ends


def head(text: str, overlap: int) -> list[int]:
    """The boundaries of a chunk in its first overlap."""
    return boundaries(text, overlap)


def tail(text: str, chunk: int) -> list[int]:
    """The boundaries of a chunk in its last overlap, where the next chunk reads too.

    A boundary counts if it is not the chunk's own end (what follows was not seen there) and follows a character that is no white
    space: where the next chunk has it too, both read the same pre-tokens from there on, and the pieces on either side read the
    same alone.
    """
    return [e for e in boundaries(text) if chunk < e < len(text) and not text[e - 1].isspace()]


def pieces(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """The text cut where neighbouring chunks, each pre-tokenised alone, agree on a boundary: at the first of each overlap.

    Where two chunks share no boundary (a pre-token longer than the overlap) the text is not cut, so encoding the pieces always
    equals encoding the text at once.
    """
    starts = [0]
    for at in range(chunk, len(text), chunk):
        before = tail(text[at - chunk : at + overlap], chunk)
        if before:
            after = set(head(text[at : at + chunk + overlap], overlap))
            common = next((e for e in before if e - chunk in after), None)
            if common is not None:
                starts.append(at - chunk + common)
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def encode_text(text: str | None, name: str = TOKENIZER) -> list[int]:
    """The ids of one text; NULL and the empty text have none."""
    return encoding(name).encode_ordinary(text) if text else []


def encode_pieces(text: str | None, name: str = TOKENIZER, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of one text by chunks that are stitched and encoded piece by piece."""
    e = encoding(name)
    return [i for p in pieces(text, chunk, overlap) for i in e.encode_ordinary(p)] if text else []


def decode(ids: list[int], name: str = TOKENIZER) -> str:
    """The text of ids: the raw bytes of the tokens are concatenated first, so a character split over tokens is whole again."""
    return b"".join(map(encoding(name).decode_single_token_bytes, ids)).decode("utf-8", "replace")


def _edges(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Pre-tokenise chunks; of each keep the boundaries in its first and in its last overlap, as positions in the text."""
    for b in batches:
        heads, tails = [], []
        for n, text in zip(b.column("n").to_pylist(), b.column("text").to_pylist()):
            heads.append([n * chunk + e for e in head(text, overlap)])
            tails.append([n * chunk + e for e in tail(text, chunk)])
        yield pa.record_batch([*b.columns[:3], pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))], ["doc", "n", "last", "head", "tail"])


def _encode(batches: Iterator[pa.RecordBatch], how: Callable[[str | None], list[int]]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = [how(t) for t in b.column("text").to_pylist()]
        yield pa.record_batch([*b.columns[:-1], pa.array(ids, pa.list_(pa.int32()))], [*b.schema.names[:-1], "ids"])


def _pieces(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t or "" for t in b.column("text").to_pylist()]
        n = [len(pieces(t, chunk, overlap)) if t else 0 for t in texts]
        yield pa.record_batch([b.column("doc_id"), pa.array([-(-len(t) // chunk) for t in texts], pa.int64()), pa.array(n, pa.int64())], ["doc_id", "chunks", "pieces"])


def _count(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    e = encoding(name)
    for b in batches:
        n = [len(e.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()]
        yield pa.record_batch([*b.columns[:-1], pa.array(n, pa.int64())], [*b.schema.names[:-1], "tokens"])


def token_counts(documents: DataFrame, *columns: str, name: str = TOKENIZER) -> DataFrame:
    """The given columns and ``tokens``, where the rows lie."""
    kept = documents.select(*columns, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.drop("text").dtypes)
    return kept.mapInArrow(partial(_count, name=name), f"{schema}, tokens bigint")


def corpus_pieces(documents: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, the number of ``chunks`` of its text and of the ``pieces`` they are stitched to; NULL and empty texts have none."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_pieces, chunk=chunk, overlap=overlap), "doc_id bigint, chunks bigint, pieces bigint")


def encode_corpus(documents: DataFrame, name: str = TOKENIZER, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD) -> DataFrame:
    """``doc_id`` and ``ids`` of every row; NULL and empty texts give an empty list; repeated rows are encoded each.

    Overlapping chunk encoding: a text is cut into overlapping chunks, each is pre-tokenised alone; neighbours are
    stitched at the first pre-token boundary on which both agree; the pieces between the stitches are encoded and their ids
    concatenated. Where one pre-token is longer than the overlap no boundary is shared and the chunks on both sides form one
    piece, so the result always equals encoding the text at once. The chunks of a text up to ``spread`` characters are stitched
    where it lies, without a shuffle; those of a longer text are spread over tasks, by the same boundaries (``head``, ``tail``).
    """
    if overlap >= chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    short = rows.where(F.col("text").isNull() | (F.length("text") <= spread)).mapInArrow(partial(_encode, how=partial(encode_pieces, name=name, chunk=chunk, overlap=overlap)), "doc_id bigint, ids array<int>")
    # a row id keeps repeated rows apart; only the long texts are moved
    long = rows.where(F.length("text") > spread).withColumn("doc", F.struct(F.col("doc_id"), F.monotonically_increasing_id().alias("row")))
    last = F.floor((F.length("text") - 1) / chunk).cast("bigint")
    cut = long.select("doc", F.posexplode(F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda n: F.substring("text", n * chunk + 1, F.lit(chunk + overlap)))).alias("n", "text"), last.alias("last"))
    chunks = cut.select("doc", F.col("n").cast("bigint").alias("n"), "last", "text").repartition("doc", "n")
    edges = chunks.mapInArrow(partial(_edges, chunk=chunk, overlap=overlap), "doc struct<doc_id:bigint,row:bigint>, n bigint, last bigint, head array<bigint>, tail array<bigint>")
    order = Window.partitionBy("doc").orderBy("n")
    common = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    stitched = edges.select("doc", "n", "last", F.when(F.col("n") < F.col("last"), common).alias("to"))
    start = F.coalesce(F.last("to", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    piece = F.coalesce(F.sum(F.col("to").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = stitched.select("doc", "n", "to", start.alias("start"), piece.cast("bigint").alias("piece"))
    # of each chunk the part that belongs to its piece: from the stitch before, or from its own start if it continues a piece
    at = F.col("n") * chunk
    own_start = F.greatest(F.col("start"), at)
    own_end = F.when(F.col("to").isNotNull(), F.col("to")).when(F.col("n") < F.col("last"), at + chunk).otherwise(F.lit(2**60))
    # every column of the chunks is used on both ways, so that their shuffle is one
    parts = chunks.join(plan, ["doc", "n"]).select("doc", "piece", "n", F.substring("text", (own_start - at + 1).cast("int"), F.least(own_end - own_start, F.lit(chunk + overlap)).cast("int")).alias("text"))
    joined = parts.groupBy("doc", "piece").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "").alias("text"))
    encoded = joined.mapInArrow(partial(_encode, how=partial(encode_text, name=name)), "doc struct<doc_id:bigint,row:bigint>, piece bigint, ids array<int>")
    whole = encoded.groupBy("doc").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])).alias("ids"))
    return short.unionByName(whole.select(F.col("doc.doc_id").alias("doc_id"), "ids"))
