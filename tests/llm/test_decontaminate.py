"""Decontamination against scoring every passage with every item, planted leaks, and edge cases."""

from collections import Counter

import numpy as np

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.llm import decontaminate as dc


def plain(docs, items, threshold=0.6, overlap=0.5, entry_words=64):
    parts = [(i, *dc.split_item(dc.text_words(t), None)) for i, t in items]
    sizes = [len(q + a) for _, q, a in parts]
    n, avg = len(parts), max(np.mean(sizes), 1) if sizes else 1
    df = Counter(w for _, q, a in parts for w in set(q + a))
    out = set()
    for doc, text in docs:
        words = dc.text_words(text)
        at = range(0, max(1, -(-max(0, len(words) - 2 * entry_words) // entry_words) + 1))
        passages = [words[i * entry_words : (i + 2) * entry_words] for i in at]
        for item, q, a in parts:
            if len(q + a) < 5:
                continue
            k = -(-len(q + a) // entry_words)
            cuts = [len(q + a) * i // k for i in range(k + 1)]
            hit = set()
            for lo, hi in zip(cuts, cuts[1:]):
                tf = Counter((q + a)[lo:hi])
                w = {t: np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * (hi - lo) / avg)) for t, f in tf.items()}
                for p, words_ in enumerate(passages):
                    if sum(w[t] for t in set(words_) & set(w)) >= (threshold - 1e-9) * sum(w.values()):
                        hit.add(p)
            if not hit:
                continue
            grams = lambda x, k: {tuple(x[i : i + k]) for i in range(len(x) - k + 1)}
            share = []
            for need in (q, a):
                k = min(3, len(need))
                need = grams(need, k)
                share.append(len(need & set().union(*(grams(passages[p], k) for p in hit))) / len(need))
            if min(share) >= overlap:
                out.add((doc, item))
    return out


def pairs(df):
    rows = df.collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert len(got) == len(rows)
    assert all(r.score >= 0.6 - 1e-9 and min(r.question_overlap, r.answer_overlap) >= 0.5 for r in rows)
    return got


def test_query_matches_brute_force_and_planted_items(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = pairs(entry.queries()["op4_benchmark_decontamination"](spark, SF_SMALL))
    assert got == plain(docs, items)
    assert got >= {(d, i) for d, t in docs for i, b in items if b in t}


def test_shards_long_items_and_partial_leaks(spark):
    rng = np.random.default_rng(2)
    vocab = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "ei", "ou", "ix", "un")]
    say = lambda n: " ".join(rng.choice(vocab, n))
    items = [(i, say(int(n))) for i, n in enumerate(rng.integers(5, 200, 40))]
    docs = []
    for d in range(60):
        item = items[d % 40][1].split()
        kind = d % 4
        leak = [item, item[: len(item) // 2], [w.upper() + "," for w in item], []][kind]
        docs.append((d, say(int(rng.integers(0, 150))) + " " + " ".join(leak) + " " + say(int(rng.integers(0, 150)))))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert {(x, x % 40) for x in range(60) if x % 4 in (0, 2)} <= want
    assert pairs(dc.find_leaks(d, b)) == want
    assert pairs(dc.find_leaks(d, b, shard_bytes=4000)) == want


def test_edge_cases(spark):
    item = "which river runs through the old town of springfield the blue one"
    items = [(1, item), (2, None), (3, ""), (4, "the one"), (1, item), (None, "a wholly different question about some rare minerals found here")]
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "the one " * 300), (5, "pad " * 200_000 + item), (6, " ")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS score", "'x' AS answer")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'y' AS answer", "3 AS shard")
    got = sorted((r.doc_id or -1, r.item_id) for r in dc.find_leaks(d, b).collect())
    assert got == [(-1, 1), (-1, 1), (3, 1), (3, 1), (3, 1), (3, 1), (5, 1), (5, 1)]
    assert dc.find_leaks(d.limit(0), b).collect() == [] and dc.find_leaks(d, b.limit(0)).collect() == []
    own = spark.createDataFrame([(1, "which river runs through the old town", "the blue one")], "item_id long, text string, reply string")
    assert {r.doc_id for r in dc.find_leaks(d, own, answer_col="reply").collect()} == {3, 5, None}


def test_one_edited_word_and_answers_apart(spark):
    say = lambda n, seed: [f"{seed}{chr(97 + i)}" for i in range(n)]
    filler = " ".join(f"pad{i}" for i in range(300))
    items, docs, want = [], [], set()
    for n in (5, 8, 12, 15, 17, 20, 23):
        item = say(n, f"w{n}x")
        items.append((n, " ".join(item)))
        for at in range(n):
            for kind, edited in enumerate((["changed"], [], [item[at], "added"])):
                doc = n * 1000 + at * 10 + kind
                docs.append((doc, f"{filler} {' '.join(item[:at] + edited + item[at + 1 :])} {filler}"))
                want.add((doc, n))
        docs.append((n * 1000 + 900, f"{filler} {' '.join(item[: n // 2])} {filler}"))
    apart = say(15, "apart")
    items.append((99, " ".join(apart)))
    docs += [(99_001, f"{' '.join(apart[:10])} {filler} {' '.join(apart[10:])}"), (99_002, f"{' '.join(apart[:10])} {filler}")]
    got = pairs(dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == want | {(99_001, 99)}


def test_unspaced_scripts_and_short_items(spark):
    filler = " ".join(f"pad{i}" for i in range(200))
    items = [(1, "日本で一番高い山は何ですか。それは富士山です。"), (2, "What is 2+2?"), (3, "ภูเขาที่สูงที่สุดคืออะไร"), (4, "Why?"), (5, "富士山"), (6, " ?! ")]
    docs = [(1, f"{filler} 次の問い「日本で一番高い山は何ですか、それは富士山です」と答える {filler}"), (2, f"{filler}.\nwhat is 2+2? {filler}"),
            (3, f"{filler} คำถามภูเขาที่สูงที่สุดคืออะไรครับ {filler}"), (4, f"{filler}. WHY! {filler}"), (5, f"山は「富士山」。{filler}"),
            (6, f"{filler} what is {filler} 2+2? {filler}"), (7, "why not, and 富士山頂"), (8, "?!"), (9, "x " * 600_000 + "\nwhy")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert pairs(dc.find_leaks(d, spark.createDataFrame(items, "item_id long, text string"))) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (9, 4)}
    own = spark.createDataFrame([(1, "capital of France", "Paris"), (2, "", "Paris")], "item_id long, text string, reply string")
    d = spark.createDataFrame([(1, "Paris it is. Capital of France?"), (2, "Capital of France? Rome"), (3, "Where? Paris.")], "doc_id long, text string")
    assert pairs(dc.find_leaks(d, own, answer_col="reply")) == {(1, 1), (3, 2)}
