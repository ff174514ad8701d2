"""Homomorphic document fingerprints, in DataFrame expressions only.

A text is a multiset of paragraphs. Each paragraph hashes to a wide vector,
and the fingerprint is the vectors' sum, lane by lane, modulo a power of two:
the order of paragraphs doesn't matter, and a paragraph is added or removed by
adding or subtracting its vector. The first ten lanes come from SHA-512 of the
paragraph, modulo 2**48, and decide equality. The other 65 lanes, modulo
2**32, count the paragraph's word shingles and the bits of their hashes; what
two fingerprints share in them estimates how alike the texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, stored

EXACT, EXACT_BITS = 10, 48
LANES, LANE_BITS = 64, 32
LEAST = -(1 << 63)


def paragraphs(text: Column) -> Column:
    """Lines that hold more than spaces."""
    return F.filter(F.split(text, "\n", -1), lambda p: F.trim(p) != "")


def shingles(paragraph: Column) -> Column:
    """Three-word shingles of the words between spaces; a paragraph of fewer words has one, with nulls."""
    words = F.split(paragraph, " ", -1)
    n = F.greatest(F.size(words) - 2, F.lit(1))
    return F.arrays_zip(
        F.slice(words, F.lit(1), n).alias("a"), F.slice(words, F.lit(2), n).alias("b"), F.slice(words, F.lit(3), n).alias("c")
    )


def paragraph_sums(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Per ``keys`` the sums of all paragraphs' vectors: n (shingles), b0.. (pairs of likeness lanes), e0.. (halves of exact lanes).

    The sums are not yet reduced, so groups may be added up further. Exact lanes
    are summed in halves of 24 bits, high half first: 2**39 paragraphs fit a sum.
    A text without a paragraph has zeros.
    """
    lines = texts.select(*keys, F.explode_outer(paragraphs(F.col(text_col))).alias("p"))
    lines = lines.select(*keys, F.sha2("p", 512).alias("digest"), F.coalesce(shingles(F.col("p")), F.array()).alias("s"))
    parts = lines.select(*keys, "digest", F.posexplode_outer("s").alias("at", "s"))
    parts = parts.select(
        *keys, "digest", "at", F.when(F.col("at").isNotNull(), F.xxhash64("s.a", "s.b", "s.c")).alias("h")
    )
    step = EXACT_BITS // 8
    lane = lambda i: F.conv(F.substring("digest", 1 + i * step, step), 16, 10).cast("long")
    pair = F.lit(1 | 1 << LANE_BITS)
    return parts.groupBy(*keys).agg(
        F.count("h").alias("n"),
        *(F.coalesce(F.sum(F.shiftrightunsigned("h", j).bitwiseAND(pair)), F.lit(0)).alias(f"b{j}") for j in range(LANES // 2)),
        *(F.sum(F.when(F.col("at") == 0, lane(i)).otherwise(0)).alias(f"e{i}") for i in range(2 * EXACT)),
    )


def exact_hex() -> Column:
    """The exact lanes as lower-case hex digits."""
    half = EXACT_BITS // 2
    digits = lambda c: F.lpad(F.hex(c.bitwiseAND(F.lit((1 << half) - 1))), half // 4, "0")
    halves = ((F.col(f"e{2 * i}") + F.shiftright(f"e{2 * i + 1}", half), F.col(f"e{2 * i + 1}")) for i in range(EXACT))
    return F.lower(F.concat(*(digits(c) for pair in halves for c in pair)))


def lane_counts() -> Column:
    """Array of the shingles' number and the 64 likeness lanes."""
    low = [F.col(f"b{j}") for j in range(LANES // 2)]
    high = [F.shiftrightunsigned(f"b{j}", LANE_BITS) for j in range(LANES // 2)]
    return F.transform(F.array(F.col("n"), *low, *high), lambda c: c.bitwiseAND(F.lit((1 << LANE_BITS) - 1)))


def text_form(exact: Column, lanes: Column) -> Column:
    """A fingerprint as hex digits: exact lanes, a dash, likeness lanes."""
    digits = F.transform(lanes, lambda c: F.lower(F.lpad(F.hex(c), LANE_BITS // 4, "0")))
    return F.concat(exact, F.lit("-"), F.array_join(digits, ""))


def _signed(lanes: Column) -> Column:
    """Each lane's ones minus zeros."""
    return F.transform(F.slice(lanes, 2, LANES), lambda c: (2 * c - F.element_at(lanes, 1)).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two arrays of ``lane_counts``: twice the shared shingles over all, as the lanes estimate them.

    Two texts without shingles are alike, one without and one with are not.
    """
    x, y = _signed(a), _signed(b)
    add = lambda v: F.aggregate(v, F.lit(0.0), lambda s, c: s + c)
    both = add(F.transform(x, lambda c: c * c)) + add(F.transform(y, lambda c: c * c))
    ratio = 2 * add(F.zip_with(x, y, lambda c, d: c * d)) / both
    return F.when(both == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio)))


def next_ids(keys: DataFrame) -> DataFrame:
    """(key, next_key): each distinct key's successor in descending order, the last one's being the first.

    Keys are range-partitioned and sorted; only each partition's largest key,
    one row a partition, is compared across partitions.
    """
    ranged = keys.distinct().repartitionByRange(F.col("key").desc()).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged)
    own = ranged.withColumn("next_key", F.lead("key").over(Window.partitionBy("part").orderBy(F.col("key").desc())))
    heads = ranged.groupBy("part").agg(F.max("key").alias("head"))
    order = Window.orderBy("part")
    around = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(order), F.first("head").over(around)).alias("other"))
    return own.join(F.broadcast(heads), "part").select("key", F.coalesce("next_key", "other").alias("next_key"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, nth, prev_key, text, edited): each row with its last third replaced from the next document, descending id.

    The last floor(length / 3) code points give way to as many from the head of
    the next document (all of it, if shorter); after the last id comes the
    first. Null text counts as empty, a null id as the smallest. Rows with one
    id share their successor; of several rows with the successor's id, that
    with the smallest text hash is taken. nth numbers the rows of one id by
    text hash, from 1; prev_key is the id that comes before.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("key"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("v", F.xxhash64("text"))  # both uses below read (key, text, v), so they share one exchange
    third = F.floor(F.length("text") / 3).cast("int")
    need = rows.groupBy("key").agg(F.max(third).alias("want"))
    ring = next_ids(rows.select("key"))
    wanted = ring.join(need, "key").select(F.col("key").alias("prev_key"), F.col("next_key").alias("key"), "want")
    heads = rows.join(wanted, "key").select("prev_key", "v", F.left("text", F.col("want")).alias("head"))
    heads = heads.groupBy("prev_key").agg(F.min_by("head", "v").alias("head")).withColumnRenamed("prev_key", "key")
    before = ring.select(F.col("key").alias("prev_key"), F.col("next_key").alias("key"))
    made = F.concat(F.left("text", F.length("text") - third), F.left("head", third))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("v"))
    return rows.withColumn("nth", nth).join(heads, "key").join(before, "key").select("key", "nth", "prev_key", "text", made.alias("edited"))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Fingerprints are hex digits of the exact lanes, a dash, and the likeness
    lanes; equal texts have equal ones whatever the order of their paragraphs.
    Repeated rows give repeated rows, null ids come back as null, an empty table
    gives none. Only the id and the text are read. Of a very long text the
    paragraphs are spread as rows and summed; no sum can overflow.
    """
    two = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))
    )
    keys = ["key", "nth", "prev_key", "n_chars", "sha"]
    both = edited(docs, id_col, text_col).select(
        "key", "nth", "prev_key", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("sha"), F.explode(two).alias("x")
    )
    each = paragraph_sums(both.select(*keys, "x.*"), [*keys, "kind"])
    each = each.select(*keys, "kind", exact_hex().alias("exact"), lane_counts().alias("lanes"))
    pick = lambda c, k: F.max(F.when(F.col("kind") == k, F.col(c)))
    done = each.groupBy(*keys).agg(
        pick("exact", 0).alias("a_exact"), pick("lanes", 0).alias("a"), pick("exact", 1).alias("b_exact"), pick("lanes", 1).alias("b")
    )
    done = stored(done, "fingerprints")
    following = done.where("nth = 1").select(F.col("prev_key").alias("key"), F.col("a").alias("c"))
    return done.join(following, "key").select(
        F.nullif("key", F.lit(LEAST)).alias("doc_id"),
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        text_form(F.col("a_exact"), F.col("a")).alias("fingerprint"),
        text_form(F.col("b_exact"), F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"),
    )
