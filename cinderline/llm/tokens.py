"""Encoding of whole corpora with a public byte-level BPE vocabulary, by overlapping chunks."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Fixed value: the pattern that cuts texts into pre-tokens for this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CUT = regex.compile(PATTERN)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a vocabulary file with one 'base64 id' a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line.strip())}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def boundaries(chunk: str, first: int, low: int, high: int, ended: bool) -> list[int]:
    """Where pre-tokens of the chunk, which begins at `first` in its text, end within [low, high], behind a character that
    is no white space. A cut there changes no pre-token on either side. What touches the chunk's end is left out, unless the text ends there."""
    out = []
    for m in CUT.finditer(chunk):
        at = m.end()
        if low <= first + at <= high and (ended or at < len(chunk)) and not chunk[at - 1].isspace():
            out.append(first + at)
        if first + at > high:
            break
    return out


def chunks(documents: DataFrame, key: str, text: str, chunk_chars: int, overlap: int) -> DataFrame:
    """(key, n, first, chunk, ended): pieces of chunk_chars characters with the next `overlap` characters behind them."""
    length = F.char_length(text)
    n = F.greatest(F.lit(1), F.ceil((length - F.lit(overlap)) / F.lit(chunk_chars)).cast("int"))
    rows = documents.select(F.col(key), F.col(text).alias("__t"), length.alias("__len"), F.explode(F.sequence(F.lit(0), n - 1)).alias("n"))
    first = F.col("n") * F.lit(chunk_chars)
    piece = F.col("__t").substr(first + 1, F.lit(chunk_chars + overlap))
    return rows.select(key, "n", first.alias("first"), piece.alias("chunk"), (first + chunk_chars + overlap >= F.col("__len")).alias("ended"))


def encode_corpus(documents: DataFrame, *, key: str, text: str, vocabulary: str = VOCABULARY, chunk_chars: int = 4_096, overlap: int = 256) -> DataFrame:
    """(key, ids): the token ids of each text, ARRAY<INT>, without special tokens; their strings count as ordinary text.

    One row per row of documents. A null text gives an empty list, and so does an empty one; the text is taken as it stands.

    Only where no such place is found, as in one endless word, the chunks up to the next one are encoded in one go.

    Texts up to chunk_chars + overlap characters are one chunk and are encoded where they are read. Longer texts are cut
    into overlapping chunks, whose pre-tokens are found in parallel; two neighbouring chunks are stitched at the first place in
    their overlap where both end a pre-token, from which on they agree; chunks without such a place stay together.
    The pieces are then encoded in parallel and their ids put in order per text. The cut is only made behind a
    character that is no white space, so every piece has the pre-tokens of the whole text.
    The vocabulary file, of fixed size, is read on the driver and broadcast.
    """
    spark = documents.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoding(shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            ids = pa.array([encoder.encode_ordinary(t) if t else [] for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*batch.schema.names[:-1], "ids"])

    types = dict(documents.dtypes)
    source = documents.select(F.col(key), F.col(text).alias("__t"))
    is_long = F.char_length("__t") > chunk_chars + overlap
    short = source.where(F.coalesce(~is_long, F.lit(True))).mapInArrow(encode, f"`{key}` {types[key]}, ids array<int>")

    def zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the pre-token ends in the overlap behind the chunk (tail) and in the overlap it shares with the one before (head)."""
        for batch in batches:
            first, chunk, ended = (batch.column(c).to_pylist() for c in (2, 3, 4))
            tail = [[] if e else boundaries(c, f, f + chunk_chars, f + chunk_chars + overlap, e) for f, c, e in zip(first, chunk, ended)]
            head = [boundaries(c, f, f, f + overlap, e) if f else [] for f, c, e in zip(first, chunk, ended)]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tail, kind), pa.array(head, kind)], names=[*batch.schema.names, "tail", "head"])

    # A long text is known by a number of its own, as keys may repeat.
    long_texts = source.where(is_long).withColumn("__row", F.monotonically_increasing_id()).select(F.struct(key, "__row").alias("__id"), "__t")
    # The chunks are written once: the seams are found from numbers alone, and only then the texts are joined to them.
    cut = cut_lineage(chunks(long_texts, "__id", "__t", chunk_chars, overlap))
    marked = cut.mapInArrow(zones, f"__id struct<`{key}`:{types[key]},__row:bigint>, n int, first int, chunk string, ended boolean, tail array<int>, head array<int>")
    by_text = Window.partitionBy("__id").orderBy("n")
    seams = marked.drop("chunk").withColumn("start", F.when(F.col("n") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(by_text)))))
    seams = seams.withColumn("piece", F.count("start").over(by_text)).withColumn("stop", F.lead("start").over(by_text))
    seams = seams.select("__id", "n", "first", "ended", "start", "stop", "piece").join(cut.select("__id", "n", "chunk"), ["__id", "n"])
    # Within a piece, each chunk brings its own part up to the next chunk, the last one up to the seam.
    own = F.col("chunk").substr(
        F.when(F.col("start").isNotNull(), F.col("start") - F.col("first") + 1).otherwise(F.lit(1)),
        F.greatest(
            F.lit(0),
            F.when(F.col("ended"), F.lit(chunk_chars + overlap)).when(F.col("stop").isNotNull(), F.col("stop") - F.col("first")).otherwise(F.lit(chunk_chars))
            - F.when(F.col("start").isNotNull(), F.col("start") - F.col("first")).otherwise(F.lit(0)),
        ),
    )
    pieces = seams.groupBy("__id", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", own.alias("part")))), lambda p: p["part"]), "").alias("__t"))
    coded = pieces.repartition("__id", "piece").mapInArrow(encode, f"__id struct<`{key}`:{types[key]},__row:bigint>, piece bigint, ids array<int>")
    whole = coded.groupBy("__id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda p: p["ids"])).alias("ids"))
    return short.unionByName(whole.select(F.col("__id").getField(key).alias(key), "ids"))


def decode(ids: list[int], tokens: dict[int, bytes]) -> bytes:
    """The text's bytes: the raw bytes of its tokens, one after another."""
    return b"".join(tokens[i] for i in ids)
