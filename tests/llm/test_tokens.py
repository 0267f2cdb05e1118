import os
import random
import tempfile
from pathlib import Path

import pytest
import tiktoken

from cinderline.llm.tokens import PATTERN, VOCABULARY, decode, encode_corpus, read_ranks

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="the public vocabulary is not here")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(VOCABULARY)


def encoded(spark, texts, **more):
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>").repartition(3)
    out = encode_corpus(df, key="doc_id", text="text", **more)
    assert out.columns == ["doc_id", "ids"]
    return {r.doc_id: list(r.ids) for r in out.collect()}


def test_chunks_give_the_ids_of_the_whole_text(spark, ranks):
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\r\n", "a", "Año ", "'s", "'ll ", "é", "12", "ñandú ", "\t\n ", "...", "🔥", " я", "<|endoftext|>", "é", " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.choice([5, 60, 300]))) for _ in range(60)]
    texts += [None, "", " ", "x" * 900, " " * 900, " " * 300 + "y" * 300 + " z" * 200, "a " * 500, "\n" * 400 + "b"]
    plain = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = encoded(spark, texts, chunk_chars=64, overlap=24)
    assert got == {i: plain.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert got == encoded(spark, texts)
    back = {v: k for k, v in ranks.items()}
    assert all(decode(got[i], back).decode() == (t or "") for i, t in enumerate(texts))


def test_repeated_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, "uno " * 40), (1, "uno " * 40), (None, "dos " * 40)], "doc_id bigint, text string")
    assert encode_corpus(df, key="doc_id", text="text", chunk_chars=32, overlap=8).count() == 3
    assert encode_corpus(df.limit(0), key="doc_id", text="text").count() == 0


def test_the_vocabulary_is_a_parameter(spark, ranks):
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder, "bytes.tiktoken")
        path.write_bytes(b"\n".join(line for line in Path(VOCABULARY).read_bytes().splitlines()[:256]))
        assert len(encoded(spark, ["hola"], vocabulary=str(path))[0]) == 4
