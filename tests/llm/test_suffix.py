from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tickstream.llm import suffix_dedup
from tickstream.llm.suffix_array import common_prefixes, repeated_starts, suffix_array

SEGMENTS = st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6)


@given(SEGMENTS)
def test_suffix_array_and_prefixes(segments):
    data = np.frombuffer(b"".join(segments), np.uint8)
    ends = np.cumsum([len(s) for s in segments])
    begin = [0, *ends[:-1].tolist()]
    rows = sorted((s[i:], k, begin[k] + i) for k, s in enumerate(segments) for i in range(len(s)))
    order = suffix_array(data, ends)
    assert order.tolist() == [r[2] for r in rows]
    shared = common_prefixes(data, ends, order, 5)
    for k in range(1, len(rows)):
        a, b = rows[k - 1][0], rows[k][0]
        same = next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
        assert shared[k] == min(5, same)


@given(SEGMENTS, st.integers(1, 4))
def test_repeated_starts(segments, length):
    data = np.frombuffer(b"".join(segments), np.uint8)
    ends = np.cumsum([len(s) for s in segments])
    begin = [0, *ends[:-1].tolist()]
    starts = [begin[k] + i for k, s in enumerate(segments) for i in range(len(s) - length + 1)]
    strings = [data[s:s + length].tobytes() for s in starts]
    group = repeated_starts(data, ends, np.array(starts, np.int64), length).tolist()
    assert [g >= 0 for g in group] == [strings.count(s) > 1 for s in strings]


@settings(max_examples=40)
@given(st.lists(st.binary(max_size=300).map(lambda b: bytes(97 + x % 4 for x in b)), min_size=1, max_size=5),
       st.integers(30, 50))
def test_each_window_has_one_segment(texts, length):
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    h, s1, s2, row, start, count = suffix_dedup.anchored(data, offsets, length)
    own: dict = {}
    seen = set()
    for k in range(len(h)):
        for w in range(count[k]):
            place = int(start[k]) + w
            assert (row[k], place) not in seen
            seen.add((row[k], place))
            string = texts[row[k]][place:place + length]
            assert len(string) == length
            assert own.setdefault(string, h[k]) == h[k]
    assert len(seen) == sum(max(0, len(t) - length + 1) for t in texts)


def _texts():
    rng = random.Random(3)
    def prose(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    shared, other = prose(120), prose(150)
    base = prose(400)
    words = base.split(" ")
    texts = [None, "", "short", base, base, base + " more", prose(50) + shared + prose(60), shared,
             prose(10) + shared + other + prose(5) + other, other[7:], "x" * 1000, "x" * 399, "x" * 400,
             ("ab" * 300), prose(300)]
    for _ in range(12):
        edited = words[:]
        edited[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(edited))
    return texts


@pytest.mark.parametrize("shard_bytes", [None, 4_000])
def test_repeats_against_brute_force(spark, make_docs, monkeypatch, shard_bytes):
    if shard_bytes:  # anchors are cut over shards and their runs merged
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    texts = _texts()
    rows = {r["doc_id"]: r for r in suffix_dedup.repeat_report(make_docs(texts)).collect()}
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for _, r in sorted(rows.items())]
    assert got == brute.removed_repeats(texts, 400)


def test_long_texts_are_cut_without_loss(spark, make_docs, monkeypatch):
    rng = random.Random(5)
    body = "".join(rng.choice("abcdefgh ") for _ in range(5_000_000))
    passage = body[3_999_900:4_000_600]
    rows = suffix_dedup.repeat_report(make_docs([body, "q" + passage])).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in rows] == [700, 700] and [r["n_spans"] for r in rows] == [1, 1]


def test_clashing_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, kept string, t1 long, h long, removed int"
    docs = spark.createDataFrame([(1, "y" * 900, "k", 1, 2, 3), (1, "y" * 900, "k", 1, 2, 3)], schema)
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert [r["kept"] for r in rows] == [b"", b""] and rows[0]["h"] == 2
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_cut_characters_become_replacement_characters(spark, make_docs):
    passage = "".join(chr(97 + k * k % 23) for k in range(450))
    out = suffix_dedup.cut_repeats(make_docs(["x é" + passage + "é y", "z è" + passage + "è w"]))
    assert {r["text"] for r in out.collect()} == {"x é\ufffd y", "z è\ufffd w"}


def test_stage_drops_emptied_documents(spark, make_docs):
    base = "".join(chr(97 + k * k % 26) for k in range(500)) + "é" * 10
    out = suffix_dedup.cut_repeats(make_docs([base, base, "tail " + base, "clean text", None, ""]))
    assert {r["text"] for r in out.collect()} == {"tail ", "clean text", None, ""}
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [r["n_chars"] for r in out.where("text = 'tail '").collect()] == [5]


def test_passages_of_over_50_words_against_brute_force(spark, make_docs):
    rng = random.Random(11)
    def prose(n, letters="abcdeé"):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(n))
    short, barely, most = prose(51), prose(50), prose(59)
    once = prose(60)
    texts = [None, "", prose(30), prose(40) + " " + short + " " + prose(20), short + "\n" + prose(70),
             prose(9) + "\n" + short.replace(" ", "\t\n", 7) + prose(9), "la " * 300, prose(5) + " la" * 70,
             barely + " x " + prose(10), prose(3) + " y " + barely, once + " z " + once,
             prose(80) + " " + most + " " + most + " end", most, prose(2000) + " " + short + " " + prose(900)]
    texts += [prose(20) + " " + most[k:] + " " + prose(20) for k in (0, 3, 9, 40)]
    texts += ["same " + prose(60), *_texts()]
    texts.append(texts[-len(_texts()) - 1])
    rows = suffix_dedup.remove_repeats(make_docs(texts), passage=51).orderBy("doc_id").collect()
    want = brute.cut_passages(texts, 400, 51)
    assert [bytes(r["kept"]) for r in rows] == want
    assert short.encode() not in b"|".join(want) and barely.encode() in want[8] and once.encode() in want[10]


def test_passages_of_long_texts_are_not_lost_between_pieces(spark, make_docs):
    rng = random.Random(6)
    found = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(300_000)]
    passage = " ".join(found[131_040:131_100])
    assert len(passage) < suffix_dedup.LENGTH
    docs = make_docs([" ".join(found), "q " + passage, *[" ".join(rng.sample(found, 9_000)) for _ in range(8)]])
    rows = suffix_dedup.remove_repeats(docs, passage=51).orderBy("doc_id").collect()
    at = 5 * 131_040
    assert [[tuple(x) for x in r["removed"]] for r in rows] == [
        [(at, at + len(passage))], [(2, 2 + len(passage))], *[[]] * 8]


def test_stage_removes_passages_shorter_than_its_strings(spark, make_docs):
    passage = " ".join(f"w{k}" for k in range(51))
    assert len(passage) < suffix_dedup.LENGTH
    out = suffix_dedup.cut_repeats(make_docs([f"one {passage} two", f"three {passage}", f"four {passage[:-4]} w"]))
    assert {r["text"] for r in out.collect()} == {"one  two", "three ", f"four {passage[:-4]} w"}


def test_report_counts_passages_shorter_than_its_strings(spark, make_docs):
    passage = " ".join(f"w{k}" for k in range(51))
    long = " ".join(f"{k:08d}" for k in range(51))
    assert len(passage) < suffix_dedup.LENGTH < len(long)
    texts = [f"one {passage} two", f"three {passage}", f"four {passage[:-4]} w", f"{passage}", None, "",
             f"{long} five {passage}", f"six {long}", "x" * 500, "x" * 500]
    rows = suffix_dedup.repeat_report(make_docs(texts)).orderBy("doc_id").collect()
    assert [(r["n_passages"], r["n_passage_bytes"]) for r in rows] == [
        (1, len(passage))] * 2 + [(0, 0), (1, len(passage)), (0, 0), (0, 0),
                                  (2, len(long) + len(passage)), (1, len(long)), (0, 0), (0, 0)]
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows]
    assert got == brute.removed_repeats(texts, 400)
    assert [r["n_removed"] > 0 for r in rows] == [False] * 6 + [True] * 4
