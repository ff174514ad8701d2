"""Removal of repeated passages: compressed FM-index shards, and later documents streamed against earlier ones.

Two equal windows of words have equal smallest word-shingle hashes, so a
window's smallest shingle hash names the shard where all its copies meet.
Consecutive windows of a document with the same name form one segment. Names
seen in a single document hold no repeat; of the others, a segment's text is
carried from the smallest document that has it and, as a copy, from the
largest: those between are answered as the copy is. In a shard the texts of a
name are halved by document, again and again: the earlier half is indexed, the
later half streamed through backward search, and windows whose matching
statistic reaches the window length have an earlier source. A name under which
very many different segments meet (a common line inside different texts) is
split further, by the windows' own hashes, so no shard grows with one passage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, stored
from .fmindex import FMIndex

SHINGLE = 16
BASE = 0x9E3779B97F4A7C15
PIECE = 64  # windows searched as one query, so that steps do not follow the longest segment


def _slices(data: bytes, step: int = 1 << 22):
    """Pieces of a UTF-8 text cut at white space, so that memory does not follow the text."""
    import re

    space, at = re.compile(rb"[\x20\x09-\x0d]"), 0
    while at < len(data):
        m = space.search(data, at + step)
        end = m.start() if m else len(data)
        yield data[at:end]
        at = end


def word_hashes(text: str | None):
    """XXH64 of each word ``[^\\x20\\x09-\\x0D]+`` of a text."""
    import numpy as np
    import xxhash

    digest, out = xxhash.xxh64_intdigest, [np.zeros(0, np.uint64)]
    for piece in _slices((text or "").encode("utf-8", "replace")):
        words = piece.split()
        out.append(np.fromiter(map(digest, words), np.uint64, len(words)))
    return np.concatenate(out)


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs_hash(h, starts, ends):
    """Hash of h[start:end] for each pair, independent of its place."""
    import numpy as np

    up = np.full(len(h) + 1, BASE, np.uint64)
    up[0] = 1
    down = np.full(len(h) + 1, pow(BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    sums = np.r_[np.uint64(0), np.cumsum(_mix(h) * np.cumprod(up)[:-1], dtype=np.uint64)]
    return _mix((sums[ends] - sums[starts]) * np.cumprod(down)[starts])


def cut_segments(h, window: int, step: int = 1 << 20):
    """(name, content hash, windows, first word) of a document's segments, as arrays."""
    import numpy as np

    k = min(SHINGLE, window)
    out = []
    for at in range(0, max(0, len(h) - window + 1), step):
        part = h[at : at + step + window - 1]
        n = len(part)
        g = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            g = g * np.uint64(BASE) + part[j : n - k + 1 + j]
        low, span, wide = _mix(g), window - k + 1, 1
        while wide * 2 <= span:
            low = np.minimum(low[:-wide], low[wide:])
            wide *= 2
        if span > wide:
            low = np.minimum(low[: wide - span], low[span - wide :])
        cut = np.r_[0, np.flatnonzero(low[1:] != low[:-1]) + 1, len(low)]
        lo, hi = cut[:-1], cut[1:]
        out.append((low[lo], _runs_hash(part, lo, hi + window - 1), hi - lo, lo + at))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out))


def _segments(rows: DataFrame, window: int) -> DataFrame:
    import numpy as np
    import pyarrow as pa

    names = ["name", "content", "n", "doc_id", "version", "start"]

    def run(batches):
        for b in batches:
            found = [cut_segments(word_hashes(t.as_py()), window) for t in b.column("text")]
            times = [len(f[0]) for f in found]
            if not sum(times):
                continue
            name, content, n, start = (np.concatenate(c) for c in zip(*found))
            ids = [np.repeat(b.column(c).to_numpy(), times) for c in ("doc_id", "version")]
            cols = [name.view(np.int64), content.view(np.int64), n.astype(np.int32), *ids, start]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    return rows.mapInArrow(run, "name long, content long, n int, doc_id long, version long, start long")


def _contents(rows: DataFrame, picked: DataFrame, window: int) -> DataFrame:
    """The picked segments with their word hashes, cut out of the documents that own them."""
    import pyarrow as pa

    names = ["name", "content", "n", "copy", "doc_id", "last", "hot", "words"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def run(batches):
        for b in batches:
            out, held = [], 0
            for doc, text, parts in zip(b.column(0), b.column(1), b.column(2)):
                h, doc = word_hashes(text.as_py()), doc.as_py()
                for p in parts.as_py():
                    words = h[p["start"] : p["start"] + p["n"] + window - 1].tobytes()
                    out.append((p["name"], p["content"], p["n"], p["copy"], doc, p["last"], p["hot"], words))
                    held += len(words)
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    parts = F.collect_list(F.struct("name", "content", "n", "copy", "last", "start", "hot"))
    each = picked.groupBy("doc_id", "version").agg(parts.alias("parts"))
    joined = rows.join(each, ["doc_id", "version"]).select("doc_id", "text", "parts")
    return joined.mapInArrow(
        run, "name long, content long, n int, copy boolean, doc_id long, last long, hot boolean, words binary"
    )


def earlier_sources(words, owner, name, copy, window: int):
    """Per text and window: whether a text of the same name from a smaller document has the window.

    Equal windows must have equal names. Texts of a name are ranked by document.
    At each level blocks of ranks are halved; all earlier halves make one index,
    all later halves are its queries. Words are marked with their block's number,
    so no match leaves its block. Copies are queries only: their text is indexed
    from the smallest document.
    """
    import numpy as np
    import pandas as pd

    n = np.array([max(0, len(w) - window + 1) for w in words], np.int64)
    rank = pd.Series(owner).groupby(name).rank("dense").to_numpy(np.int64) - 1
    top = pd.Series(rank).groupby(name).transform("max").to_numpy(np.int64)
    text = np.repeat(np.arange(len(words)), -(-n // PIECE))  # the pieces of each text
    at = np.concatenate([np.arange(0, k, PIECE) for k in n]) if len(n) else n
    found = [np.zeros(k, bool) for k in n]
    for level in range(int(top.max(initial=0)).bit_length()):
        block, later = rank >> (level + 1), (rank >> level) & 1 == 1
        sources = ~later & ~copy & (top >= (2 * block + 1) << level)
        mark = _mix(block.astype(np.uint64) + np.uint64(1))

        def piece(p):
            return words[text[p]][at[p] : at[p] + PIECE + window - 1] ^ mark[text[p]]

        index = FMIndex([piece(p) for p in np.flatnonzero(sources[text])])
        asked = [p for p in np.flatnonzero(later[text]) if not found[text[p]][at[p] : at[p] + PIECE].all()]
        for p, length in zip(asked, index.matching_statistics([piece(p) for p in asked])[0]):
            part = found[text[p]][at[p] : at[p] + PIECE]
            part |= length[: len(part)] >= window
    return found


ANSWER = "name long, content long, n int, low long, own binary, later binary"


def _search(contents: DataFrame, window: int, shards: int) -> DataFrame:
    """Per segment text a byte for each window, 1 where an earlier document has it.

    ``own`` holds for ``low``, the smallest document with the text, ``later``
    for all others (null where there are none).
    """

    def run(frame):
        import numpy as np
        import pandas as pd

        words = [np.frombuffer(w, np.uint64) for w in frame["words"]]
        found = earlier_sources(words, *(frame[c].to_numpy() for c in ("doc_id", "name", "copy")), window)
        answers = frame[["name", "content", "n", "copy", "doc_id"]].assign(found=[f.tobytes() for f in found])
        low = answers[~answers["copy"]].rename(columns={"doc_id": "low", "found": "own"})
        later = answers[answers["copy"]].rename(columns={"found": "later"})
        key = ["name", "content", "n"]
        both = pd.merge(low[[*key, "low", "own"]], later[[*key, "later"]], on=key, how="left")
        return both.assign(later=both["later"].astype(object).where(both["later"].notna(), None))

    dealt = contents.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, ANSWER)


def _split_hot(hot: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Windows of hot segments under names of their own, and of each that several documents share the first and last text."""
    import numpy as np
    import pyarrow as pa

    names = ["own", "name", "content", "n", "at", "doc_id", "last"]

    def run(batches):
        for b in batches:
            out = []
            for name, content, n, doc, last, words in zip(*(b.column(i).to_pylist() for i in range(6))):
                at = np.arange(n)
                own = _runs_hash(np.frombuffer(words, np.uint64), at, at + window)
                fixed = (np.full(n, v) for v in (name, content, n))
                out.append((own.view(np.int64), *fixed, at, np.full(n, doc), np.full(n, last)))
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                cols[3], cols[4] = cols[3].astype(np.int32), cols[4].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    flat = hot.where("not copy").select("name", "content", "n", "doc_id", "last", "words")
    schema = "own long, name long, content long, n int, at int, doc_id long, last long"
    windows = stored(flat.mapInArrow(run, schema), "windows")
    ends = windows.groupBy("own").agg(
        F.min(F.struct("doc_id", "name", "content", "n", "at", F.lit(False).alias("copy"))).alias("low"),
        F.max(F.struct(F.col("last").alias("doc_id"), "name", "content", "n", "at", (F.col("last") > F.col("doc_id")).alias("copy"))).alias("high"),
    )
    ends = ends.where("low.doc_id < high.doc_id").select("own", F.posexplode(F.array("low", "high")).alias("later", "b"))
    ends = ends.select("own", (F.col("later") == 1).alias("later"), "b.name", "b.content", "b.n", "b.at", "b.copy", "b.doc_id")
    cut = F.expr(f"substring(words, at * 8 + 1, {8 * window})")
    singles = ends.join(hot.select("name", "content", "n", "copy", "words"), ["name", "content", "n", "copy"]).select(
        F.col("own").alias("name"), F.col("own").alias("content"), F.lit(1).alias("n"), F.col("later").alias("copy"), "doc_id", cut.alias("words")
    )
    return windows, singles


def repeated_spans(
    docs: DataFrame, id_col: str, text_col: str, window: int = 50, crowd: int = 256, shard_words: int = 1_000_000
) -> DataFrame:
    """(doc_id, version, spans): per document the word ranges [from, to) to remove, as packed pairs of 64-bit numbers.

    A word goes if a window of ``window`` words over it also starts in a
    document with a smaller id. ``version`` is the text's XXH64, which tells rows
    with the same id apart. ``crowd``: more different segments than this under
    one name are split by windows.
    """
    import numpy as np
    import pyarrow as pa

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("version"), "text")
    every = stored(_segments(rows, window), "segments")
    shared = every.groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("name")
    places = stored(every.join(shared, "name"), "places")
    place = F.struct("doc_id", "version", "start")
    kinds = places.groupBy("name", "content", "n").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    sizes = kinds.groupBy("name").agg((F.count("*") > crowd).alias("hot"))
    both = F.when(F.col("low.doc_id") < F.col("high.doc_id"), F.array("low", "high")).otherwise(F.array("low"))
    texts = kinds.join(sizes, "name").select(
        "name", "content", "n", "hot", F.col("high.doc_id").alias("last"), F.posexplode(both).alias("copy", "r")
    )
    picked = stored(texts.select("name", "content", "n", "hot", "last", (F.col("copy") == 1).alias("copy"), "r.*"), "picked")
    words = picked.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    contents = stored(_contents(rows, picked, window), "contents")
    windows, singles = _split_hot(contents.where("hot"), window)
    shards = max(1, -(-int(words) // shard_words))
    cold = _search(contents.where("not hot").select("name", "content", "n", "copy", "doc_id", "words"), window, shards)
    single = _search(singles, window, shards)
    source = single.where(F.col("later") == F.lit(b"\x01")).select(F.col("name").alias("own"), F.col("low").alias("least"))
    hot = windows.join(source, "own").groupBy("name", "content", "n", "doc_id", "last").agg(
        F.collect_list(F.struct("at", "least")).alias("found")
    )

    def fill(batches):
        for b in batches:
            own, later = [], []
            for n, doc, last, found in zip(*(b.column(i).to_pylist() for i in range(2, 6))):
                least = np.full(n, last)
                for f in found:
                    least[f["at"]] = f["least"]
                own.append((least < doc).tobytes())
                later.append((least < last).tobytes())
            cols = [*b.columns[:4], pa.array(own, pa.binary()), pa.array(later, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["name", "content", "n", "low", "own", "later"])

    verdict = cold.unionByName(hot.mapInArrow(fill, ANSWER))

    def spans(batches):
        for b in batches:
            docs_, versions, outs = [], [], []
            cols = (b.column(i).to_pylist() for i in range(4))
            for doc, version, start, found in zip(*cols):
                hit = np.flatnonzero(np.frombuffer(found, bool))
                if len(hit):
                    gap = np.flatnonzero(np.diff(hit) > window)
                    lo = hit[np.r_[0, gap + 1]] + start
                    hi = hit[np.r_[gap, len(hit) - 1]] + start + window
                    docs_.append(doc)
                    versions.append(version)
                    outs.append(np.stack([lo, hi], 1).astype("<i8").tobytes())
            cols = [pa.array(docs_, pa.int64()), pa.array(versions, pa.int64()), pa.array(outs, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "version", "span"])

    answer = F.when(F.col("doc_id") > F.col("low"), F.col("later")).otherwise(F.col("own")).alias("found")
    hits = places.join(verdict, ["name", "content", "n"]).select("doc_id", "version", "start", answer)
    found = hits.mapInArrow(spans, "doc_id long, version long, span binary")
    return found.groupBy("doc_id", "version").agg(F.collect_set("span").alias("spans"))


def _kept(text: str, spans, layout: bool):
    """(words, words removed, kept text): kept words joined by one space, or with the text's own spacing."""
    import re

    import numpy as np

    data = text.encode("utf-8", "replace")
    if not spans:
        n, parts = 0, []
        for piece in _slices(data):
            words = piece.split()
            n += len(words)
            if not layout and words:
                parts.append(b" ".join(words))
        return n, 0, text if layout else b" ".join(parts).decode()
    cover = np.concatenate([np.frombuffer(s, "<i8").reshape(-1, 2) for s in spans])
    parts, n, gone = [], 0, 0
    top = int(cover.max()) + 1
    edge = np.zeros(top + 1, np.int64)
    np.add.at(edge, cover[:, 0], 1)
    np.add.at(edge, cover[:, 1], -1)
    drop = np.cumsum(edge) > 0
    pattern = re.compile(rb"[^\x20\x09-\x0d]+[\x20\x09-\x0d]*" if layout else rb"[^\x20\x09-\x0d]+")
    for piece in _slices(data):
        if layout and not n and not parts:
            parts.append(piece[: len(piece) - len(piece.lstrip())])
        words = pattern.findall(piece)
        out = drop[n : n + len(words)]
        out = np.r_[out, np.zeros(len(words) - len(out), bool)]
        kept = [w for w, d in zip(words, out.tolist()) if not d]
        gone += len(words) - len(kept)
        n += len(words)
        if layout:
            parts += kept
        elif kept:
            parts.append(b" ".join(kept))
    return n, gone, (b"" if layout else b" ").join(parts).decode()


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, layout: bool = False, **sizes
) -> DataFrame:
    """(row, doc_id, n_words, n_removed, kept) for every row: the whole input row and what is left of its text.

    ``kept`` joins the kept words by one space, or with ``layout`` keeps the
    white space that follows each kept word. Windows are judged on the input,
    not on what is left. A null or empty text has no words; a row with a null
    id loses nothing and is no source; rows with the same id are never sources
    for each other; an empty table gives no rows. Very long texts are read
    whole, in slices; of equal windows the one in the smallest document stays. The input row travels as a
    struct, so its column names cannot clash.
    """
    import pyarrow as pa

    spans = repeated_spans(docs, id_col, text_col, window, **sizes)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = carried(docs, doc_id=F.col(id_col).cast("long"), version=F.xxhash64(text))  # the text moves once, in its row
    joined = rows.join(spans, ["doc_id", "version"], "left").select("row", "doc_id", "spans")

    def run(batches):
        for b in batches:
            texts = (row[text_col] for row in b.column(0))
            done = [_kept(str(t.as_py() or ""), s.as_py(), layout) for t, s in zip(texts, b.column(2))]
            n, gone, kept = zip(*done) if done else ((), (), ())
            cols = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["row", "doc_id", "n_words", "n_removed", "kept"])

    schema = T.StructType(
        [joined.schema["row"], joined.schema["doc_id"], T.StructField("n_words", T.LongType()),
         T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )
    return joined.mapInArrow(run, schema)
