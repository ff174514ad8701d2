"""Phrase collocations against a plain count, the SQL form, and planted hot phrases."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import SF_MID
from ridgeway.llm import phrases

UPPER = dict(zip(range(65, 91), range(97, 123)))


def brute(rows, least, longest=4, most=2000, percent=80):
    """All of it with dictionaries, phrase by phrase."""
    out = []
    for lang in {"und" if r[0] is None else r[0] for r in rows}:
        f, n = Counter(), 0
        for own, text in rows:
            if ("und" if own is None else own) != lang:
                continue
            for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
                words = re.findall("[^\x20\x09]+", piece)
                n += len(words)
                for k in range(1, longest + 1):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        cand = {p: c for p, c in f.items() if len(p) >= 2 and c >= least}
        scored = []
        for p, a in cand.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(len(q) > len(p) and 100 * c >= percent * a and inside(q) for q, c in cand.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def rows_of(spark, rows, **kw):
    df = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(df.selectExpr("*", "1 AS phrase", "2 AS n", "'x' AS `a.b`"), **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def text(rng, words):
    return "".join(rng.choice(words) + rng.choice([" "] * 12 + [".", ", ", "\t", "\n", "  ", "! "]) for _ in range(rng.randint(0, 60)))


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_counts(spark, seed, monkeypatch):
    rng = random.Random(seed)
    words = ["a", "B", "the", "The", "é", "É", "of", "x y", "日本", "\0", "q\x1cz"]
    rows = [(rng.choice(["en", "fr", None, "und", ""]), text(rng, words)) for _ in range(150)] + [("en", None), ("en", ""), (None, " \t .")]
    assert rows_of(spark, rows, least=4) == brute(rows, 4)
    assert rows_of(spark, rows, least=3, most=5, longest=3, subsumed_percent=50) == brute(rows, 3, 3, 5, 50)


def test_query_equals_sql(spark):
    got = sorted(tuple(r) for r in entry.queries()["op12_phrase_collocations"](spark, SF_MID).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_MID}/documents.parquet')")
    assert got and got == sorted(con.execute(entry.oracle_sql()["op12_phrase_collocations"]).fetchall())


def test_blocks_and_slices_lose_nothing(spark):
    """Phrases across the borders of blocks and slices: the limits are set in the operator's own module by a fresh copy."""
    rng = random.Random(9)
    words = ["a", "b", "cc", "dd", "e"]
    rows = [("en", text(rng, words)) for _ in range(60)]
    want = brute(rows, 3)
    saved = phrases.BLOCK, phrases.SLICE
    try:
        for block, slice_ in ((1, 1), (7, 5), (64, 3)):
            phrases.BLOCK, phrases.SLICE = block, slice_
            assert list_of_counts(rows, 3) == list_of_counts(rows, 3, whole=True)
    finally:
        phrases.BLOCK, phrases.SLICE = saved
    assert rows_of(spark, rows, least=3) == want


def list_of_counts(rows, n, whole=False):
    """Summed stripes of one task without a bitmap's help (every bit set)."""
    import pyarrow as pa

    class Frame:
        def mapInArrow(self, f, schema):
            batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1].encode() for r in rows])], names=["lang", "text"])
            return list(f([batch]))

    class Full:
        value = b"\xff" * 8192

    block, slice_ = phrases.BLOCK, phrases.SLICE
    if whole:
        phrases.BLOCK, phrases.SLICE = 1 << 21, 1 << 20
    total = Counter()
    for b in phrases.stripes(Frame(), n, Full, 1 << 16):
        for r in b.to_pylist():
            for w, c in zip(r["next"].split(" "), np.frombuffer(r["count"], "<u4")):
                total[r["prefix"], w] += int(c)
    phrases.BLOCK, phrases.SLICE = block, slice_
    return total


def test_saturated_bitmap_changes_no_count(spark, monkeypatch):
    rng = random.Random(4)
    rows = [("en", text(rng, ["a", "b", "cc", "dd", "e", "ff"])) for _ in range(80)]
    want = brute(rows, 5)
    assert rows_of(spark, rows, least=5) == want
    monkeypatch.setattr(phrases, "phrase_bitmap", lambda p: (b"\xff" * 8192, 1 << 16))
    assert rows_of(spark, rows, least=5) == want
    monkeypatch.setattr(phrases, "HOT_SHARE", 1)  # no phrase is hot
    assert rows_of(spark, rows, least=5) == want


def test_only_pairs(spark):
    rows = [("en", "a b c d. " * 5 + "a b")] * 4
    assert rows_of(spark, rows, least=4, longest=2) == brute(rows, 4, 2)


def test_hot_word_and_pair(spark):
    """A third of all rows are one line; every other word follows one word."""
    rows = [("en", "the one line that all share")] * 400 + [("en", f"the w{i} the w{i % 40} goes on") for i in range(800)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(13)
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == brute(rows, 30)


def test_empty_and_long(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [("en", None), (None, "one two")]) == []
    long = [("en", "so it goes on " * 200_000 + "x" * 3_000_000), (None, "a " * 100_000)]
    assert rows_of(spark, long) == brute(long, 30)


def test_products_beyond_64_bits(spark):
    big = 3 * 10**13  # 2000000 times this passes 64 bits, and so does the sum of the parts of the second row
    df = spark.createDataFrame([(big, big, 2 * big), (2**62, 2**62, 2**62)], "a long, l long, r long")
    assert [r[0] for r in df.select(phrases.strength("a", "l", "r")).collect()] == [666_666, 1_000_000]
