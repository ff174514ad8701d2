"""Phrase collocations from stripes: each prefix keys an associative counter of the words that follow it.

One round for each phrase length counts, in every task, a stripe for each prefix
(the empty one first): how often each next word follows. Stripes of one prefix are
merged elementwise. A merged stripe
holds the phrases that extend its prefix with their counts, which are the prefixes
of the next round with their totals, and the largest count among them, which tells
whether a longer phrase takes the prefix's place; the whole sum of the empty
prefix's stripe is the number of words.

A phrase can't be more frequent than its parts. From the second round on, stripes
are kept for frequent prefixes only, and hold the next words that end a frequent
phrase of the round before. Tasks know frequent phrases from a bitmap of bounded size
with false positives: these cost work, but change no count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
BLOCK = 1 << 20  # words whose stripes a task holds at once
SLICE = 1 << 20  # bytes of a text cut into words at a time
HOT_SHARE = 4096  # a prefix with more than one of so many words of the corpus has its stripe dealt to as many keys as it has such shares
SEGMENTS = 512  # keys of the empty prefix's stripe
ROWS = 1 << 15  # stripes in an Arrow batch
BITS_EACH, MOST_BITS, BITMAP_SLICES = 16, 1 << 28, 64
SHARES = 64


class _Numbers(dict):
    """Numbers words in the order in which they come; a piece's end is 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _word_slices(text: bytes):
    """Lists of a text's words and b"." wherever one piece ends, slice by slice."""
    table = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + SEPARATORS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(SEPARATORS))
    text = text.translate(table)
    at = 0
    while at < len(text):
        stop = len(text)
        if stop - at > SLICE:
            ends = [i for i in (text.find(b" ", at + SLICE), text.find(b".", at + SLICE)) if i >= 0]
            stop = min(ends) + 1 if ends else stop
        yield text[at:stop].replace(b".", b" . ").split()
        at = stop


def _mixed(h):
    """The finalising steps of a 64-bit hash, on an array."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(words) -> "np.ndarray":  # noqa: F821
    import numpy as np
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _extended(h, word_hashes):
    """Hash of a phrase from that of its start and of its next word."""
    import numpy as np

    return _mixed(h * np.uint64(0x9E3779B97F4A7C15) + word_hashes)


def _places(h, bits: int):
    """The two bits of each hash."""
    import numpy as np

    return h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)


def _stripes_of_block(n: int, langs, lang_of, ids, words, bitmap, bits: int, hot):
    """The stripes of all prefixes of ``n`` - 1 words that start in the block, but for its last ``n`` - 1 places, in batches."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    m = len(ids) - (n - 1)
    hashes = _hashes(words)
    size = len(words)
    if n == 1:
        at = np.flatnonzero(ids)
        spread = np.full(len(at), SEGMENTS, np.uint64)
    else:
        h = _hashes([x.encode() for x in langs])[lang_of[: m + 1]]
        known = np.ones(m + 1, bool)
        for j in range(n - 1):
            part = ids[j : j + m + 1]
            h = _extended(h, hashes[part])
            known &= part != 0
        for place in _places(h, bits):
            known &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        at = np.flatnonzero(known[:m] & known[1:])  # both the prefix and the phrase that the next word ends
        spread = np.ones(len(at), np.uint64)
        if len(hot):
            near = np.minimum(np.searchsorted(hot[:, 0], h[at]), len(hot) - 1)
            spread = np.where(hot[near, 0] == h[at], hot[near, 1], spread)
    if not len(at):
        return
    code = lang_of[at].astype(np.int64)
    for j in range(n - 1):
        code = np.unique(code * size + ids[at + j], return_inverse=True)[1]
    _, first, prefix = np.unique(code, return_index=True, return_inverse=True)
    del code
    pairs, count = np.unique(prefix * size + ids[at + n - 1], return_counts=True)
    key, word = pairs // size, pairs % size
    segment = (hashes[word] % spread[first][key]).astype(np.int64)
    first = at[first]
    most = max(HOT_SHARE, SEGMENTS) + 1
    order = np.argsort(key * most + segment, kind="stable")
    key, word, count, segment = key[order], word[order], count[order], segment[order]
    starts = np.flatnonzero(np.r_[True, np.diff(key * most + segment) != 0])
    offsets = np.r_[starts, len(key)].astype(np.int32)
    names = pa.array(words, pa.binary()).cast(pa.string())
    where = first[key[starts]]
    parts = [names.take(pa.array(ids[where + j])) for j in range(n - 1)]
    prefixes = pc.binary_join_element_wise(*parts, " ") if parts else pa.array([""] * len(where), pa.string())
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()).take(pa.array(lang_of[where])),
            prefixes,
            pa.array(segment[starts], pa.int32()),
            pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(word))), " "),
            pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(4 * offsets), pa.py_buffer(count.astype("<u4"))]),
        ],
        names=["lang", "prefix", "segment", "next", "count"],
    )
    for i in range(0, batch.num_rows, ROWS):
        yield batch.slice(i, ROWS)


#: A stripe as it is shuffled: the next words, joined by spaces, and their counts in a block as unsigned 32-bit numbers.
STRIPE = "lang string, prefix string, segment int, next string, count binary"


def stripes(rows: DataFrame, n: int, bitmap=None, bits: int = 0, hot: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """Stripes of the prefixes of ``n`` - 1 words of rows (lang, text), summed within blocks of words.

    ``bitmap``: broadcast bitmap of the frequent phrases of ``n`` - 1 words;
    ``hot``: hashes of those whose stripes are dealt out, and to how many keys.
    """

    def run(batches):
        import numpy as np

        dealt = np.array(sorted(hot), np.uint64).reshape(-1, 2)

        filter_ = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        numbers, lang_numbers, parts, runs, held = _Numbers(), {}, [], [], 0

        def flush(last: bool):
            nonlocal numbers, lang_numbers, parts, runs, held
            words, langs = list(numbers), list(lang_numbers)
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            of, many = np.array(runs, np.int64).reshape(-1, 2).T
            lang_of = np.repeat(of.astype(np.int32), many)
            if last:
                ids = np.r_[ids, np.zeros(n - 1, np.int32)]
                lang_of = np.r_[lang_of, np.zeros(n - 1, np.int32)]
            if len(ids) >= n:
                yield from _stripes_of_block(n, langs, lang_of, ids, words, filter_, bits, dealt)
            # the last places start phrases that the next block ends
            numbers, lang_numbers, parts, runs, held = _Numbers(), {}, [], [], 0
            if not last:
                for i, lang in zip(ids[len(ids) - (n - 1) :], lang_of[len(ids) - (n - 1) :]):
                    parts.append(np.array([numbers[words[i]]], np.int32))
                    runs.append((lang_numbers.setdefault(langs[lang], len(lang_numbers)), 1))

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                for words in _word_slices(text.as_py()):
                    parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                    runs.append((lang_numbers.setdefault(lang, len(lang_numbers)), len(words)))
                    held += len(words)
                    if held >= BLOCK:
                        yield from flush(False)
                parts.append(np.zeros(1, np.int32))  # a text's end is a piece's end
                runs.append((lang_numbers.setdefault(lang, len(lang_numbers)), 1))
        yield from flush(True)

    return rows.mapInArrow(run, STRIPE)


def merge_stripes(parts: DataFrame, least: int) -> DataFrame:
    """Stripes of one key added up elementwise: (lang, prefix, segment, total, top, next, count).

    total is the sum of all of the stripe, top its largest count; next and count
    keep the words that follow at least ``least`` times. Rows come sorted, so a
    task holds a few stripes at a time.
    """
    import pyarrow as pa

    key = ["lang", "prefix", "segment"]

    def run(batches):
        import numpy as np
        import pyarrow.compute as pc

        def edges(t):
            """First row of every key."""
            change = np.zeros(t.num_rows, bool)
            change[0] = True
            for c in key:
                a = t.column(c).combine_chunks()
                change[1:] |= np.asarray(pc.not_equal(a.slice(1), a.slice(0, len(a) - 1)))
            return np.flatnonzero(change)

        def added(t, first):
            """(key number, word, count) of the stripes' sums."""
            row_key = np.repeat(np.arange(len(first)), np.diff(np.r_[first, t.num_rows]))
            lists, counts = t.column("next").combine_chunks(), t.column("count").combine_chunks()
            each = np.asarray(lists.value_lengths())
            flat = pa.table({"k": pa.array(np.repeat(row_key, each)), "w": lists.flatten(), "c": counts.flatten()})
            return flat.group_by(["k", "w"], use_threads=False).aggregate([("c", "sum")]).sort_by("k")

        def lists_of(flat, size):
            k = flat.column("k").to_numpy()
            offsets = pa.array(np.searchsorted(k, np.arange(size + 1)).astype(np.int32))
            word, count = flat.column("w").combine_chunks(), flat.column("c_sum").combine_chunks()
            return pa.ListArray.from_arrays(offsets, word), pa.ListArray.from_arrays(offsets, count)

        def compact(t):
            nexts, counts = lists_of(added(t, np.zeros(1, np.int64)), 1)
            return pa.table([*(t.column(c).slice(0, 1) for c in key), nexts, counts], names=t.column_names)

        def finished(t, first):
            flat = added(t, first)
            k, c = flat.column("k").to_numpy(), flat.column("c_sum").to_numpy()
            total, top = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
            np.add.at(total, k, c)
            np.maximum.at(top, k, c)
            nexts, counts = lists_of(flat.filter(pa.array(c >= least)), len(first))
            head = [t.column(x).combine_chunks().take(pa.array(first)) for x in key]
            return pa.RecordBatch.from_arrays([*head, pa.array(total), pa.array(top), nexts, counts], names=[*key, "total", "top", "next", "count"])

        def unpacked(b):
            lists = pc.split_pattern(b.column(3), " ")
            counts = np.frombuffer(b"".join(b.column(4).to_pylist()), "<u4").astype(np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(np.asarray(lists.value_lengths()))].astype(np.int32))
            return pa.table([*b.columns[:3], lists, pa.ListArray.from_arrays(offsets, pa.array(counts))], names=[*key, "next", "count"])

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(unpacked(b))
            size += b.num_rows + len(held[-1].column(3).combine_chunks().flatten())
            if size > 200_000:
                t = pa.concat_tables(held).combine_chunks()
                first = edges(t)
                if len(first) > 1:
                    yield finished(t.slice(0, first[-1]), first[:-1])
                rest = compact(t.slice(first[-1]))
                held, size = [rest], len(rest.column(3).combine_chunks().flatten()) // 2
        if held:
            t = pa.concat_tables(held).combine_chunks()
            yield finished(t, edges(t))

    dealt = parts.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "lang string, prefix string, segment int, total long, top long, next array<string>, count array<long>")


def extensions(merged: DataFrame) -> DataFrame:
    """(lang, phrase, f): the frequent phrases that the stripes hold."""
    each = merged.select("lang", "prefix", F.explode(F.arrays_zip("next", "count")).alias("e"))
    phrase = F.when(F.col("prefix") == "", F.col("e.next")).otherwise(F.concat_ws(" ", "prefix", "e.next"))
    return each.select("lang", phrase.alias("phrase"), F.col("e.count").alias("f"))


def phrase_bitmap(phrases: DataFrame) -> tuple[bytes, int]:
    """A bitmap with two bits set for every phrase (lang, phrase), and its bits: 16 a phrase, but 2**28 (32 MB) at most.

    Each slice of it is set by one task; the driver puts the slices together.
    """
    import pyarrow as pa

    bits = 1 << 16
    while bits < min(MOST_BITS, BITS_EACH * phrases.count()):
        bits *= 2
    share = bits // BITMAP_SLICES

    def placed(batches):
        import numpy as np

        for b in batches:
            langs, texts = ([x.encode() for x in b.column(i).to_pylist()] for i in (0, 1))
            words = [t.split(b" ") for t in texts]
            h = _hashes(langs)
            if len(h):
                for column in zip(*words):
                    h = _extended(h, _hashes(column))
            place = np.concatenate(_places(h, bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place // share, pa.int32()), pa.array(place % share, pa.int32())], names=["slice", "bit"])

    def gathered(batches):
        import numpy as np

        slices = {}
        for b in batches:
            part, bit = (np.asarray(c) for c in b.columns)
            for s in np.unique(part):
                own = slices.setdefault(int(s), np.zeros(share // 8, np.uint8))
                at = bit[part == s]
                np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        if slices:
            yield pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array([v.tobytes() for v in slices.values()], pa.binary())], names=["slice", "v"])

    out = bytearray(bits // 8)
    rows = phrases.select("lang", "phrase").mapInArrow(placed, "slice int, bit int").repartition(BITMAP_SLICES, "slice")
    for r in rows.mapInArrow(gathered, "slice int, v binary").collect():
        out[r.slice * share // 8 : (r.slice + 1) * share // 8] = r.v
    return bytes(out), bits


def strength(a: str, l: str, r: str) -> Column:
    """floor(2000000 a / (l + r)) of three columns, exact for any 64-bit counts."""
    return F.expr(f"cast((cast({a} AS decimal(20,0)) * 2000000) div (cast({l} AS decimal(20,0)) + cast({r} AS decimal(20,0))) AS long)")


def hot_hashes(phrases: DataFrame, words: int) -> tuple[tuple[int, int], ...]:
    """(hash, shares) of the phrases (lang, phrase, f) with more than one of ``HOT_SHARE`` of all words: fewer than ``HOT_SHARE``."""
    found = []
    for r in phrases.where(F.col("f") * HOT_SHARE > words).collect():
        h = _hashes([r.lang.encode()])
        for word in r.phrase.encode().split(b" "):
            h = _extended(h, _hashes([word]))
        found.append((int(h[0]), -(-r.f * HOT_SHARE // words)))
    return tuple(found)


def _top(rows: DataFrame, most: int) -> DataFrame:
    """Each lang's first rows with their rank: of ``SHARES`` shares first, then of what these leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    rows = rows.withColumn("share", share).withColumn("nth", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    rows = rows.where(F.col("nth") <= most)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)


def _looked_up(asked: DataFrame, known: DataFrame) -> DataFrame:
    """``asked`` with f by (lang, part): parts that more than one of ``HOT_SHARE`` rows ask for are broadcast, the rest are joined."""
    rows = asked.count()
    often = asked.groupBy("lang", "part").count().where(F.col("count") * HOT_SHARE > rows).join(known, ["lang", "part"])
    often = stored(often.select("lang", "part", F.col("f").alias("often")), "often")  # fewer than HOT_SHARE rows
    marked = asked.join(F.broadcast(often), ["lang", "part"], "left")
    hot = marked.where("often IS NOT NULL").withColumnRenamed("often", "f")
    return hot.unionByName(marked.where("often IS NULL").drop("often").join(known, ["lang", "part"]))


def collocations(
    docs: DataFrame,
    least: int = 30,
    longest: int = 4,
    most: int = 2000,
    subsumed_percent: int = 80,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``most`` strongest phrases of 2 to ``longest`` words.

    A phrase counts where its words stand together within a piece, at least
    ``least`` times. Cut after its first words, l and r are the counts of the two
    parts and the score is floor(2000000 a / (l + r)); its lowest cut counts, of
    equal ones that with the shortest first part. A phrase inside a longer
    candidate that is at least ``subsumed_percent`` percent as frequent is left
    out. n is the number of the lang's words.

    Null text counts as empty, null lang as ``und``; repeated rows count as often
    as they come; equal scores are ordered by count, then by the phrase's bytes.
    An empty table, or one without frequent phrases, gives no rows. Texts of any
    length are cut slice by slice, and other columns aren't read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
    ).where("text IS NOT NULL")
    merged: list[DataFrame] = []
    bitmap, bits, hot, n_words = None, 0, (), 0
    for n in range(1, longest + 1):
        merged.append(stored(merge_stripes(stripes(rows, n, bitmap, bits, hot), least), f"stripes{n}"))
        if bitmap is not None:
            bitmap.unpersist()
        if n == 1:
            words = merged[0].groupBy("lang").agg(F.sum("total").alias("n"))
            n_words = words.agg(F.sum("n")).head()[0] or 0
        if n < longest:
            frequent = extensions(merged[-1])
            data, bits = phrase_bitmap(frequent)
            bitmap, hot = spark.sparkContext.broadcast(data), hot_hashes(frequent, n_words)
    found = reduce(DataFrame.unionAll, (extensions(m) for m in merged[1:]))
    none = F.lit(None).cast("long")
    # of each phrase its count, and the largest counts of the phrases that it starts (its stripe's top) and that it ends
    facts = [extensions(m).select("lang", "phrase", "f", none.alias("longer")) for m in merged[:-1]]
    for m in merged[2:]:
        top = m.where(F.col("top") >= least)
        facts.append(top.select("lang", F.col("prefix").alias("phrase"), none.alias("f"), F.col("top").alias("longer")))
        end = F.expr("substring(phrase, locate(' ', phrase) + 1)")
        facts.append(extensions(m).select("lang", end.alias("phrase"), none.alias("f"), F.col("f").alias("longer")))
    parts = reduce(DataFrame.unionAll, facts).groupBy("lang", "phrase").agg(F.max("f").alias("f"), F.max("longer").alias("longer"))
    parts = stored(parts, "phrases")
    big = lambda c: F.col(c).cast("decimal(20,0)")
    kept = found.withColumnRenamed("f", "a").join(parts.select("lang", "phrase", "longer"), ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (big("longer") * 100 < big("a") * subsumed_percent)).select("lang", "phrase", "a")
    # every cut asks for the counts of its two parts
    cuts = kept.select("lang", "phrase", "a", F.size(F.split("phrase", " ")).alias("k_all")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("k_all") - 1)).alias("k")
    )
    sides = F.explode(
        F.array(
            F.struct(F.lit("l").alias("side"), F.expr("substring_index(phrase, ' ', k)").alias("part")),
            F.struct(F.lit("r").alias("side"), F.expr("substring_index(phrase, ' ', k - k_all)").alias("part")),
        )
    )
    asked = stored(cuts.select("lang", "phrase", "a", "k", sides.alias("s")).select("lang", "phrase", "a", "k", "s.side", "s.part"), "cuts")
    told = _looked_up(asked, parts.select("lang", F.col("phrase").alias("part"), "f"))
    count = lambda side, k: F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("f")))
    ks = range(1, longest)
    scored = told.groupBy("lang", "phrase", "a").agg(*(count(s, k).alias(f"{s}{k}") for k in ks for s in "lr"))

    def cut(k):
        whole = F.struct(strength("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        return F.when(F.col(f"l{k}").isNotNull() & F.col(f"r{k}").isNotNull(), whole)

    best = F.array_min(F.array_compact(F.array(*(cut(k) for k in ks))))
    scored = scored.select("lang", "phrase", "a", best.alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    return _top(scored, most).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = 30, longest: int = 4, most: int = 2000, subsumed_percent: int = 80) -> str:
    """The same rows in DuckDB SQL."""
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(words[i:i + {k - 1}], ' ') AS phrase FROM "
        f"(SELECT lang, words, unnest(range(1, len(words) - {k} + 2)) AS i FROM pieces WHERE len(words) >= {k})"
        for k in range(1, longest + 1)
    )
    return f"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs)
), counts AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM (
  {grams}) GROUP BY lang, k, phrase
), total AS (
  SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), cand AS MATERIALIZED (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k >= 2 AND f >= {least}
), inside AS (
  SELECT c.lang, array_to_string(c.words[s:s + m - 1], ' ') AS phrase, max(c.a) AS longer
  FROM cand c, (SELECT unnest(range(1, {longest})) AS s) ss, (SELECT unnest(range(2, {longest})) AS m) mm
  WHERE m < c.k AND s + m - 1 <= c.k GROUP BY ALL
), kept AS (
  SELECT c.* FROM cand c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE i.longer IS NULL OR 100 * i.longer::HUGEINT < {subsumed_percent} * c.a::HUGEINT
), cuts AS (
  SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, (2000000 * c.a::HUGEINT) // (x.f::HUGEINT + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:j], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[j + 1:], ' ')
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE nth = 1
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= {most}
"""
