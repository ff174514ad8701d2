"""Passage removal against brute force, with crowded names split, and its FM-index against plain search."""

import hashlib
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.llm import substring_dedup as sd
from ridgeway.llm.fmindex import FMIndex

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    """Per row (words, removed, kept text) by a table of all windows."""
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                least[k] = min(d, least.get(k, d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if least[tuple(w[i : i + window])] < d:
                    gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in entry.queries()["op3_substring_dedup"](spark, SF_SMALL).collect()]
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in plain(rows, 50)]
    assert order(got) == order(want)
    assert sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("crowd", [0, 2, 256])
def test_shared_passages_in_different_texts(spark, crowd):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choice(vocab, n))
    passages = [say(n) for n in (9, 12, 25, 40)]
    rows = [(int(i), "  ".join(say(int(rng.integers(0, 12))) + "\n" + passages[rng.integers(4)] for _ in range(3))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sd.remove_repeats(df, window=10, crowd=crowd, shard_words=300)
    assert order([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()]) == order(plain(rows, 10))


def test_layout_keeps_spacing(spark):
    rows = [(1, "a b c d"), (2, " x\n y  a b c d z \n"), (3, "  q  r ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.kept for r in sd.remove_repeats(df, window=3, layout=True).collect()}
    assert got == {1: "a b c d", 2: " x\n y  z \n", 3: "  q  r "}


def test_edge_cases(spark):
    line = "one two three four five six"
    rows = [(5, line), (5, line), (5, line + " seven"), (6, None), (7, ""), (8, " \t\n"), (None, line), (9, line + " " + line),
            (3, "zero " + line), (10, "a b c\x1cd e " + line), (11, "word " * 300_000), (12, "word " * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = df.selectExpr("*", "1 AS n", "2 AS name", "3 AS kept", "4 AS spans", "struct(1 AS x) AS row", "5 AS version")
    got = sd.remove_repeats(wide, window=5).collect()
    assert order([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got]) == order(plain(rows, 5))
    assert all(r.row.kept == 3 and r.row.row.x == 1 for r in got)
    assert sd.remove_repeats(df.limit(0)).collect() == []


def test_matching_statistics_against_plain_search():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a = int(rng.integers(2, 5))
        seqs = [rng.integers(7, 7 + a, rng.integers(0, 30)).astype(np.uint64) for _ in range(rng.integers(1, 8))]
        queries = [rng.integers(7, 8 + a, rng.integers(0, 25)).astype(np.uint64) for _ in range(4)] + [seqs[0]]
        index = FMIndex(seqs)
        texts = [s.tolist() for s in seqs]
        for q, length in zip(queries, index.matching_statistics(queries)[0]):
            q = q.tolist()
            for i in range(len(q)):
                best = 0
                for s in texts:
                    for p in range(len(s)):
                        k = 0
                        while p + k < len(s) and i + k < len(q) and s[p + k] == q[i + k]:
                            k += 1
                        best = max(best, k)
                assert length[i] == best


def test_matching_statistics_decide(spark, monkeypatch):
    """Texts indexed and texts streamed differ, and removals follow the statistics alone."""
    rng = np.random.default_rng(3)
    shared, asked = rng.integers(1, 1 << 40, 40).astype(np.uint64), []
    words = [np.r_[rng.integers(1, 1 << 40, 20).astype(np.uint64), shared] for _ in range(5)]
    args = (words, np.arange(5), np.zeros(5, int), np.zeros(5, bool), 30)
    want = [np.array([i > 0 and k >= 20 for k in range(31)]) for i in range(5)]
    real = FMIndex.matching_statistics
    assert [f.tolist() for f in sd.earlier_sources(*args)] == [w.tolist() for w in want]

    def look(index, queries):
        asked.append((index.n, sum(map(len, queries))))
        return real(index, queries)

    monkeypatch.setattr(FMIndex, "matching_statistics", look)
    sd.earlier_sources(*args)
    assert all(n < 305 for n, _ in asked)
    for constant in (0, 29, 30):
        monkeypatch.setattr(FMIndex, "matching_statistics", lambda index, qs, c=constant: ([np.full(len(q), c) for q in qs],) * 3)
        assert any(f.tolist() != w.tolist() for f, w in zip(sd.earlier_sources(*args), want))


def test_sources_against_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(40):
        k, window = int(rng.integers(1, 12)), int(rng.integers(1, 6))
        name = rng.integers(0, 2, k)  # equal windows have equal names
        words = [rng.integers(5, 8, rng.integers(0, 30)).astype(np.uint64) + np.uint64(10 * m) for m in name]
        owner, copy = rng.integers(0, 6, k), rng.random(k) < 0.2
        got = sd.earlier_sources(words, owner, name, copy, window)
        cut = lambda w: [tuple(w[i : i + window]) for i in range(len(w) - window + 1)]
        for i in range(k):
            have = {c for j in range(k) if name[j] == name[i] and owner[j] < owner[i] and not copy[j] for c in cut(words[j].tolist())}
            assert got[i].tolist() == [c in have for c in cut(words[i].tolist())]


def test_the_index_is_compressed():
    rng = np.random.default_rng(1)
    words = rng.zipf(1.3, 200_000).astype(np.uint64) % np.uint64(5000)
    index = FMIndex(np.split(words, 2000))
    assert index.nbytes < 10 * index.n


def test_long_runs_of_one_word(spark):
    rows = [(1, "word " * 1_000_000), (2, "tail " + "word " * 400_000 + "end"), (3, "word " * 49)]
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=50).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got} == {1: (1_000_000, 0), 2: (400_002, 400_000), 3: (49, 0)}
