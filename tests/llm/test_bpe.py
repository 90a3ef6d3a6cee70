from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import tiktoken
from hypothesis import given
from hypothesis import strategies as st

from tickstream.llm import bpe

PATH = public_tokenizers.path(bpe.RANKS)


def _plain():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PLAIN = _plain()


@given(st.text(st.sampled_from("aB1é  \n\t'sí_.,!\u00a0\u2003日本"), max_size=200), st.integers(1, 20))
def test_cuts_do_not_change_ids(text, limit):
    assert "".join(bpe.split_text(text, limit)) == text
    assert bpe.encode_text(text, bpe.load(PATH, public_tokenizers.PATTERN)[0], limit) == PLAIN.encode_ordinary(text)


def test_report_against_the_library(spark, make_docs):
    rng = random.Random(2)
    long = "".join(rng.choice(["word ", "née ", "\n\n", "  ", "x1 ", "'ll ", "日本 "]) for _ in range(60_000))
    texts = [None, "", " ", "<|endoftext|> text", long, "no blank" * 20_000, "same", "same"]
    rows = {r["doc_id"]: r for r in bpe.token_report(make_docs(texts)).collect()}
    for k, text in enumerate(texts, 1):
        ids = PLAIN.encode_ordinary(text or "")
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[k]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_clashing_columns_bad_bytes_and_empty_tables(spark):
    docs = spark.sql("SELECT 1L AS doc_id, 'ab' AS text, 'x' AS token_ids, 'y' AS decoded "
                     "UNION ALL SELECT 2L, cast(unhex('61FF62') AS string), 'x', 'y'")
    rows = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs)).collect()}
    assert rows[1]["decoded"] == b"ab" and rows[2]["decoded"] == "a\ufffdb".encode()
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0
    null = spark.sql("SELECT 1 AS k, cast(NULL AS array<int>) AS token_ids")
    assert bpe.decode(null).first()["decoded"] == b""


def test_stage_returns_texts_ids_and_round_trip(spark, make_docs):
    out = bpe.encode_stage(make_docs(["some text", None])).orderBy("doc_id").collect()
    assert [r["round_trip"] for r in out] == [True, True]
    assert out[0]["token_ids"] == PLAIN.encode_ordinary("some text") and out[1]["n_tokens"] == 0
