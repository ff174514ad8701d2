"""Homomorphic fingerprints against a plain computation, their algebra, and the likeness they give."""

import hashlib
from collections import Counter

import numpy as np
import xxhash

import __spark_entry__ as entry
from conftest import SF_MID, SF_SMALL
from ridgeway.llm import fingerprints as fp
from pyspark.sql import functions as F


def plain_vector(text):
    """(10 exact lanes, shingles, 64 likeness lanes) of a text."""
    exact, n, lanes = [0] * 10, 0, np.zeros(64, np.int64)
    for p in text.split("\n"):
        if not p.strip(" "):
            continue
        digest = hashlib.sha512(p.encode()).hexdigest()
        exact = [(e + int(digest[12 * i : 12 * i + 12], 16)) % (1 << 48) for i, e in enumerate(exact)]
        words = p.split(" ")
        for i in range(max(1, len(words) - 2)):
            h = 42
            for w in words[i : i + 3]:
                h = xxhash.xxh64_intdigest(w.encode(), h)
            n += 1
            lanes += [h >> b & 1 for b in range(64)]
    return exact, n, lanes


def plain_form(text):
    exact, n, lanes = plain_vector(text)
    return "".join(f"{e:012x}" for e in exact) + "-" + "".join(f"{int(c):08x}" for c in [n, *lanes])


def plain_likeness(a, b):
    (_, n, x), (_, m, y) = plain_vector(a), plain_vector(b)
    x, y = 2.0 * x - n, 2.0 * y - m
    if not (x @ x + y @ y):
        return 1.0
    return min(1.0, max(0.0, 2 * (x @ y) / (x @ x + y @ y)))


def plain_rows(rows):
    """The query's rows; of several rows with one id the next document is that of the smallest text hash."""
    signed = lambda t: int(np.int64(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42))))
    rows = [(-(1 << 63) if d is None else d, t or "") for d, t in rows]
    ids = sorted({d for d, _ in rows}, reverse=True)
    first = {d: min((signed(t), t) for e, t in rows if e == d)[1] for d in ids}
    out = []
    for d, t in rows:
        nxt = first[ids[(ids.index(d) + 1) % len(ids)]]
        k = len(t) // 3
        made = t[: len(t) - k] + nxt[:k]
        out.append((None if d == -(1 << 63) else d, len(t), hashlib.sha256(made.encode()).hexdigest(), plain_form(t), plain_form(made),
                    round(plain_likeness(t, made), 9), round(plain_likeness(t, nxt), 9)))
    return Counter(out)


def rows_of(df):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect())


def test_query_matches_plain_computation(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert rows_of(entry.queries()["op5_document_fingerprints"](spark, SF_SMALL)) == plain_rows(rows)


def test_likeness_tells_edits_from_other_documents(spark):
    got = entry.queries()["op5_document_fingerprints"](spark, SF_MID).toPandas()
    long = got[got.n_chars > 400]
    assert (long.near_edited > long.near_next).mean() > 0.97
    assert 0.55 < long.near_edited.median() < 0.8 and long.near_next.median() < 0.2


def test_order_insertion_and_deletion(spark):
    texts = [("x", "one two three four\nfive six\nseven"), ("y", "seven\n\none two three four\n  \nfive six"), ("z", "five six")]
    df = spark.createDataFrame(texts, "k string, text string")
    got = {r.k: r for r in fp.paragraph_sums(df, ["k"]).collect()}
    assert [got["x"][c] for c in got["x"].asDict() if c != "k"] == [got["y"][c] for c in got["y"].asDict() if c != "k"]
    rest = {r.k: r for r in fp.paragraph_sums(spark.createDataFrame([("x", "seven\none two three four")], "k string, text string"), ["k"]).collect()}["x"]
    assert all(got["x"][c] - got["z"][c] == rest[c] for c in rest.asDict() if c != "k")


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n \n"), (4, "é"), (4, "éà\nç ñ 漢字𝄞 x"), (5, "a b c d e f\n" * 30_000), (5, "a b c d e f\n" * 30_000),
            (None, "null id here"), (None, "another null id"), (9, "x" * 50_000), (-7, "a  b   c\td")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = df.selectExpr("*", "1 AS key", "2 AS nth", "3 AS kind", "4 AS sha", "5 AS e0")
    assert rows_of(fp.compare_with_edits(wide)) == plain_rows(rows)
    assert fp.compare_with_edits(df.limit(0)).collect() == []
    one = df.where(F.col("text") == "null id here")
    assert rows_of(fp.compare_with_edits(one)) == plain_rows([(None, "null id here")])


def test_very_many_paragraphs(spark):
    rows = [(1, "".join(f"p{i % 977} q\n" for i in range(200_000))), (2, "a b\n" * 200_000), (3, "c d e\n" * 70_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(fp.compare_with_edits(df)) == plain_rows(rows)
