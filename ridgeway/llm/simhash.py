"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints are 64-bit votes over word shingles. Two fingerprints within
``max_bits`` differing bits agree in full on at least one of
``max_bits + 1`` bit bands, so every distinct fingerprint is placed once per
band, rotated so that the band leads, and sorted by Gray rank. Runs of equal
band value are cut into blocks of bounded size; a block's summary is its
masked shared bit pattern. Pairs of blocks whose shared patterns already
differ too much are pruned before they meet; inside a pair a tree of shared
patterns accumulates differences downwards and drops whole subtrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, materialize
from .graph import connected_components

FANOUT = 16


def text_fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text (XXH64, seed 42, repeats included); 0 without words."""
    from itertools import islice

    import numpy as np
    import xxhash

    if not text:
        return 0
    words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest, ones, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while True:
        h = np.fromiter((digest(s, 42) for s in islice(shingles, 1 << 16)), np.uint64)
        if not len(h):
            break
        total += len(h)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        if len(h) < 1 << 16:
            break
    vote = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(vote.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """(doc_id, version, fp) for every row; fp holds the unsigned 64 bits, version is the text's XXH64.

    Null and word-less texts have fingerprint 0; a null text's version is that of the empty text.
    """
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for b in batches:
            fps = np.array([text_fingerprint(t.as_py(), shingle_words) for t in b.column(2)], np.uint64)
            cols = [b.column(0), b.column(1), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "version", "fp"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, version long, fp long")


def _gray_rank(c: Column) -> Column:
    """Position of a codeword in the reflected Gray sequence, as a long that sorts like the unsigned rank."""
    for s in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, s))
    return c.bitwiseXOR(F.lit(-(1 << 63)))


def _bands(max_bits: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of max_bits + 1 nearly equal bands of 64 bits."""
    n = max_bits + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def gray_blocks(fps: DataFrame, max_bits: int, block: int = 2048) -> DataFrame:
    """Blocks (band, key, first, n, pattern, mask, fps) of Gray-sorted distinct fingerprints.

    ``fps`` has one column ``fp`` of distinct longs. Rows are range-partitioned by
    (band, Gray rank), so a band value held by many fingerprints spreads over
    tasks; ``first`` is the block's first fingerprint and names it.
    """
    import numpy as np
    import pyarrow as pa

    placed = []
    for i, (at, width) in enumerate(_bands(max_bits)):
        rot = F.col("fp") if at == 0 else F.shiftleft("fp", at).bitwiseOR(F.shiftrightunsigned("fp", 64 - at))
        placed.append(
            F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(rot, 64 - width).alias("key"), _gray_rank(rot).alias("rank"))
        )
    rows = fps.select("fp", F.explode(F.array(*placed)).alias("p")).select("p.*", "fp")
    rows = rows.repartitionByRange("band", "rank").sortWithinPartitions("band", "rank")

    def pack(band, key, arr):
        first = int(arr.view(np.int64)[0])
        mask = int((~np.bitwise_or.reduce(arr ^ arr[0], keepdims=True)).view(np.int64)[0])
        return band, key, first, len(arr), first, mask, arr.tobytes()

    schema = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("first", pa.int64()), ("n", pa.int32()),
                        ("pattern", pa.int64()), ("mask", pa.int64()), ("fps", pa.binary())])

    def cut(batches):
        open_key, buf = None, []

        def rows_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        for b in batches:
            band, key = b.column("band").to_numpy(), b.column("key").to_numpy()
            fp = b.column("fp").to_numpy().view(np.uint64)
            edges = np.flatnonzero((band[1:] != band[:-1]) | (key[1:] != key[:-1])) + 1
            out = []
            for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(fp)]):
                k = (int(band[lo]), int(key[lo]))
                if open_key != k and buf:
                    out.append(pack(*open_key, np.concatenate(buf)))
                    buf = []
                open_key = k
                buf.append(fp[lo:hi])
                while sum(map(len, buf)) >= block:
                    arr = np.concatenate(buf)
                    out.append(pack(*open_key, arr[:block]))
                    buf = [arr[block:]] if len(arr) > block else []
            if out:
                yield rows_of(out)
        if buf:
            yield rows_of([pack(*open_key, np.concatenate(buf))])

    return rows.mapInArrow(
        cut, "band int, key long, first long, n int, pattern long, mask long, fps binary"
    )


def build_tree(arr):
    """Levels of a shared-pattern tree over Gray-sorted fingerprints, root first.

    A level is (pattern, residual): a node's pattern and those bits of its mask
    that its parent's mask lacks. The last level is the fingerprints themselves.
    """
    import numpy as np

    levels, pattern, varying = [], arr, np.zeros(len(arr), np.uint64)
    levels.append((pattern, ~varying))
    while len(pattern) > 1:
        at = np.arange(0, len(pattern), FANOUT)
        head = pattern[at]
        spread = pattern ^ np.repeat(head, np.diff(np.r_[at, len(pattern)]))
        varying = np.bitwise_or.reduceat(spread | varying, at)
        pattern = head
        levels.append((pattern, ~varying))
    levels.reverse()
    out = [levels[0]]
    for (_, up), (pat, mask) in zip(levels, levels[1:]):
        out.append((pat, mask & ~np.repeat(up, FANOUT)[: len(mask)]))
    return out


def search_tree(levels, queries, max_bits):
    """Index pairs (query, fingerprint) within max_bits, by descending with accumulated differences."""
    import numpy as np

    pat, res = levels[0]
    acc = np.bitwise_count((queries ^ pat[0]) & res[0]).astype(np.int64)
    q = np.flatnonzero(acc <= max_bits)
    acc, node = acc[q], np.zeros(len(q), np.int64)
    for pat, res in levels[1:]:
        first = node * FANOUT
        width = np.minimum(first + FANOUT, len(pat)) - first
        q, acc = np.repeat(q, width), np.repeat(acc, width)
        node = np.arange(len(q)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first, width)
        acc = acc + np.bitwise_count((queries[q] ^ pat[node]) & res[node])
        keep = acc <= max_bits
        q, node, acc = q[keep], node[keep], acc[keep]
    return q, node


def _forest(links, n):
    """Root of each of n nodes under the links given as chunks of index pairs."""
    import numpy as np

    root = np.arange(n)
    for u, v in links:
        pairs = np.unique(np.stack([root[u], root[v]], 1), axis=0)
        up = {}

        def find(x):
            while up.get(x, x) != x:
                up[x] = up.get(up[x], up[x])
                x = up[x]
            return x

        for a, b in pairs.tolist():
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        if up:
            moved = np.arange(n)
            for x in up:
                moved[x] = find(x)
            root = moved[root]
    return root


def linked(fps: DataFrame, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints within max_bits of each other.

    ``fps``: distinct longs in column ``fp``. A pair of blocks returns a spanning
    forest of its links, at most one edge per fingerprint, never all pairs.
    """
    import numpy as np
    import pyarrow as pa

    blocks = materialize(gray_blocks(fps, max_bits, block))
    a = blocks.select("band", "key", *(F.col(c).alias(f"a_{c}") for c in ("first", "n", "pattern", "mask", "fps")))
    b = blocks.select("band", "key", *(F.col(c).alias(f"b_{c}") for c in ("first", "n", "pattern", "mask", "fps")))
    shared = F.col("a_mask").bitwiseAND(F.col("b_mask"))
    near = F.bit_count(F.col("a_pattern").bitwiseXOR(F.col("b_pattern")).bitwiseAND(shared)) <= max_bits
    pairs = a.join(b, ["band", "key"]).where(
        near & ((F.col("a_first") < F.col("b_first")) | ((F.col("a_first") == F.col("b_first")) & (F.col("a_n") > 1)))
    )

    def search(batches):
        for batch in batches:
            us, vs = [], []
            for x, y in zip(batch.column(0), batch.column(1)):
                x, y = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                same = len(x) == len(y) and x[0] == y[0]
                tree, both = build_tree(y), x if same else np.r_[x, y]

                def links():
                    for lo in range(0, len(x), 512):
                        q, p = search_tree(tree, x[lo : lo + 512], max_bits)
                        q = q + lo
                        if same:
                            q, p = q[q < p], p[q < p]
                            yield q, p
                        else:
                            yield q, p + len(x)

                root = _forest(links(), len(both))
                moved = np.flatnonzero(root != np.arange(len(both)))
                us.append(both[moved])
                vs.append(both[root[moved]])
            u, v = (np.concatenate(z) if z else np.zeros(0, np.uint64) for z in (us, vs))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return pairs.select("a_fps", "b_fps").mapInArrow(search, "u long, v long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, max_bits: int = 4
) -> DataFrame:
    """(doc_id, version, fp, root, component_id): documents linked, over any number of hops, by fingerprints within max_bits.

    component_id is the smallest doc_id reachable; root, a fingerprint, names the component too. Exact copies share a
    fingerprint and meet as one node. Null texts and texts without words have
    fingerprint 0 and link like any other; repeated rows give repeated rows; a
    null doc_id is never a component_id unless its component has no other.
    An empty table gives no rows. Only the id and the text are read, so other
    columns' names do not matter.
    """
    if not 0 <= max_bits <= 15:
        raise ValueError("max_bits must be between 0 and 15")
    each = materialize(fingerprints(docs, id_col, text_col, shingle_words))
    nodes = materialize(each.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(linked(nodes.select("fp"), max_bits))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = named.join(least, "root").select("fp", "root", "component_id")
    return each.join(of_fp, "fp").select("doc_id", "version", "fp", "root", "component_id")


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of ``found``: the smallest non-null id, then the smallest text hash.

    Whole rows come back, repeated rows once.
    """
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "version")).alias("b"))
    best = best.select(F.coalesce("b.doc_id", F.lit(0)).alias("id"), F.col("b.no").alias("no"), F.col("b.version").alias("version"))
    own = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = ["id", "no", "version"]
    rows = carried(docs, id=F.coalesce(own, F.lit(0)), no=own.isNull(), version=F.xxhash64(text))
    return rows.join(best.distinct(), keys, "left_semi").groupBy(*keys).agg(F.first("row").alias("row")).select("row.*")
