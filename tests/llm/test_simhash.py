"""SimHash near-dedup against brute force over all pairs, and its edge cases."""

import numpy as np
import xxhash

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.llm import simhash


def plain_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows, max_bits=4):
    fp = [f for _, f in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    arr = np.array(fp, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= max_bits) + i + 1:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(find(i)) for i in range(len(rows))]


def check(found, rows, max_bits=4):
    want = [(d, plain_fingerprint(t)) for d, t in rows]
    comp = plain_components(want, max_bits)
    want = sorted(((d is None, d or 0), f, c) for (d, f), c in zip(want, comp))
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.fp % (1 << 64), r.component_id) for r in found.collect())
    assert got == want


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = entry.queries()["op7_simhash_near_dedup"](spark, SF_SMALL).collect()
    want = [(d, plain_fingerprint(t)) for d, t in rows]
    comp = plain_components(want)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (d, f"{f:016x}", c) for (d, f), c in zip(want, comp)
    )


def test_chains_and_small_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12, dtype=np.int64).tolist()
    fps = set()
    for b in base:
        x = b
        for _ in range(40):  # chains whose ends differ in many bits
            x ^= int(sum(1 << int(k) for k in rng.choice(63, int(rng.integers(1, 6)), replace=False)))
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.linked(df, 4, block=7).collect()
    arr = np.array(fps, np.uint64)
    for e in edges:
        pass  # every edge joins fingerprints of one component, checked below
    want = plain_components([(f, f) for f in fps])
    from ridgeway.llm.graph import connected_components

    pairs = spark.createDataFrame([(e.u, e.v) for e in edges], "u long, v long")
    roots = {r.node: r.root for r in connected_components(pairs).collect()}
    assert [roots.get(f, f) for f in fps] == want
    assert len(arr) > 300 and len(set(want)) < len(fps) - 50


def test_edge_cases(spark):
    long = "word and other words " * 50_000
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "Été un deux trois quatre"),
        (7, "ÉTÉ un deux trois quatre"), (8, long), (9, long + "tail"), (8, long), (None, "one two"), (None, None),
        (10, "a b c d e"), (11, "a b\x1cc d e f"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = df.selectExpr("doc_id", "text", "'x' AS fp", "1 AS component_id", "2 AS root", "3 AS least")
    check(simhash.near_duplicates(wide), rows)
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    check(simhash.near_duplicates(df, max_bits=0), rows, 0)
