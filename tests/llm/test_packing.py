"""Packing: token ids against the tokenizers library, valid and tight sequences, and the reduction's optimality."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from ridgeway.llm import packing

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def check_places(rows, capacity):
    """Sequences are gapless from 0 and within capacity; returns their number."""
    by = {}
    for seq, offset, length in rows:
        by.setdefault(seq, []).append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_ids_and_places(spark):
    got = entry.queries()["op9_best_fit_packing"](spark, SF_SMALL).toPandas()
    tok = Tokenizer.from_file(VOCAB)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    want = {}
    for d, t in docs.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, len(ids)] if len(ids) <= 2048 else [0, *range(first, len(ids) + 1, 2048)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, i] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    n = check_places(zip(got.sequence_id, got.offset, got.length), 2048)
    assert n <= -(-got.length.sum() // 2048) + 1


def optimum(items, capacity):
    """Fewest sequences by search."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, rest + [r - items[i]])
        go(i + 1, rooms + [capacity - items[i]])

    go(0, [])
    return best[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=9))
def test_reduction_keeps_the_optimum(items):
    hist = {k: items.count(k) for k in set(items)}
    fixed, rest = packing.dominance_reduction(hist, 20)
    assert all(sum(s) <= 20 for s, _ in fixed)
    left = [k for k, n in rest.items() for _ in range(n)]
    assert sorted([k for s, n in fixed for k in s * n] + left) == sorted(items)
    assert sum(n for _, n in fixed) + optimum(left, 20) == optimum(items, 20)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_places_every_rank_once(hist):
    places, n = packing.plan(hist, 30)
    rows, ranks = [], {}
    for length, rank, items, seq, each, offset in places:
        for i in range(items):
            rows.append((seq + i // each, offset + i % each * length, length))
            ranks.setdefault(length, []).append(rank + i)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in hist.items()}
    assert check_places(rows, 30) == n


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "x"), (4, "<|endoftext|> and text"),
            (5, "word " * 200_000), (6, "a" * 100_000), (7, " \n" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = df.selectExpr("*", "1 AS length", "2 AS piece", "3 AS sequence_id", "4 AS ids")
    got = packing.pack_documents(wide, VOCAB, capacity=512).collect()
    n = check_places([(r.sequence_id, r.offset, r.length) for r in got], 512)
    assert n == len({r.sequence_id for r in got})
    assert [(r.length, bytes(r.ids)) for r in got if r.doc_id in (1, 2)] == [(1, b"\0\0\0\0")] * 2
    tok = Tokenizer.from_file(VOCAB)
    tok.encode_special_tokens = True
    for d, t in rows:
        if d in (4, 5, 6, 7):
            parts = sorted((r.piece, bytes(r.ids), r.start) for r in got if r.doc_id == d)
            ids = np.frombuffer(b"".join(p[1] for p in parts), "<u4").tolist()
            assert ids == tok.encode(t, add_special_tokens=False).ids + [0]
            assert all(len(p[1]) == 4 * 512 for p in parts[1:])
    assert packing.pack_documents(df.limit(0), VOCAB).collect() == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(9,)], "length long"), 8)


def test_special_tokens_have_their_own_ids(spark, tmp_path):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "  <|endoftext|>  <|endoftext|", None, "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = Tokenizer.from_file(VOCAB)
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275, 0]
    got = packing.pack_documents(df, VOCAB, special_tokens=True).collect()
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in got} == want
    df.write.parquet(f"{tmp_path}/documents.parquet")
    crcs = {k: zlib.crc32(np.array(v, "<u4").tobytes()) for k, v in want.items()}
    query = entry.queries()["op9_best_fit_packing"](spark, str(tmp_path)).collect()
    stage = corpus_pipeline.pack(spark, df, str(tmp_path)).collect()
    for rows in (query, stage):
        assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {k: (len(v), crcs[k]) for k, v in want.items()}


def rebuilt(rows):
    """Every sequence's ids, put together from the rows."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, np.frombuffer(bytes(r.ids), "<u4").tolist()))
    out = {}
    for seq, parts in by.items():
        out[seq] = []
        for offset, ids in sorted(parts):
            assert offset == len(out[seq])
            out[seq] += ids
    return out


def test_sequences_can_be_rebuilt(spark):
    rows = entry.queries()["op9_best_fit_packing"](spark, SF_SMALL).collect()
    tok = Tokenizer.from_file(VOCAB)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    sequences = rebuilt(rows)
    assert max(map(len, sequences.values())) <= 2048
    found = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(found.setdefault(r.doc_id, []))
        own = sequences[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        found[r.doc_id] += own
    assert found == {d: tok.encode(t or "", add_special_tokens=False).ids + [0] for d, t in docs.items()}


LONG = [" " * 2_000_000, "\n" * 2_000_000, "a" + " " * 2_000_000 + "b", " \n\t" * 500_000 + "x" + "\u3000" * 5000, "<|endoftext|>" + " " * 3000 + "<|endoftext|> " + "\n" * 400]


@pytest.mark.parametrize("text", LONG + ["x" + " " * n + "y" for n in (255, 256, 257, 1000)] + ["\x1c" * 600 + " \x1d" * 300, "\x85" * 300 + " z"])
def test_long_white_space(text):
    tok, plain = Tokenizer.from_file(VOCAB), Tokenizer.from_file(VOCAB)
    plain.encode_special_tokens = True
    enc = packing.encoder(VOCAB)
    assert packing.token_ids(enc, text, True).tolist() == tok.encode(text, add_special_tokens=False).ids
    assert packing.token_ids(enc, text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_long_white_space_in_operator_and_stage(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    tok = Tokenizer.from_file(VOCAB)
    want = {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(LONG)}
    for rows in (packing.pack_documents(df, VOCAB, special_tokens=True).collect(), corpus_pipeline.pack(spark, df, str(tmp_path)).collect()):
        got = {}
        for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
            got.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
        assert got == want
