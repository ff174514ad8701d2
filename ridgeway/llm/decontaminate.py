"""Benchmark decontamination: a BM25 index of test items queried by every training passage.

The items' inverted index is ordered by item and cut into blocks; each term
knows its largest weight over all items and in each block. A passage whose
terms' bounds don't reach the threshold is dropped at once; of the rest only
blocks whose own bounds reach it are scored (block-max WAND, rank-safe). All
passages of a batch go through these steps together. Weights are divided by the
item's score for itself, so the threshold is the share of an item's BM25 mass
that a passage must hold. What is retrieved counts only when the item's
question is found in the passages and its answer in the document: by word
shingles, or with one word edited where a part is too short for its shingles to
outlast that.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"\w+")
#: Letters and marks of scripts that don't put spaces between words: Thai, Lao, Myanmar, Khmer, Yi, kana, Bopomofo, Han and others.
UNSPACED = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ebd\u0ec0-\u0ece\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u109a-\u109d\u1780-\u17d3"
    "\u1950-\u19cf\u1a20-\u1a7c\u1b05-\u1b4b\u3005-\u3007\u3041-\u3096\u3099\u309a\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff"
    "\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua48c\ua980-\ua9c0\ua9e0-\ua9ef\uaa60-\uaa7f"
    "\uf900-\ufaff\uff66-\uff9f\U0001aff0-\U0001b16f\U00020000-\U0003ffff"
)
UNSPACED_LETTER = re.compile(f"[{UNSPACED}]")
TERMS = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
K1, B = 1.2, 0.75


def _terms_of(text: str):
    """Pattern of the text's terms: words, and single letters of scripts without spaces."""
    return WORDS if text.isascii() or not UNSPACED_LETTER.search(text) else TERMS


def text_words(text: str | None) -> list[str]:
    return _terms_of(text or "").findall((text or "").lower())


def split_item(words: list[str], answer: list[str] | None) -> tuple[list[str], list[str]]:
    """Question and answer of an item; without an answer of its own, the last third of its words is the answer."""
    if answer:
        return words, answer
    cut = len(words) - max(1, len(words) // 3)
    return words[:cut], words[cut:]


def _shingle_set(ids, k):
    k = min(k, len(ids))
    return {tuple(ids[i : i + k]) for i in range(len(ids) - k + 1)} if k else set()


def _shingles_found(need, ids):
    """Those of the shingles ``need`` that are in ``ids``."""
    k = len(next(iter(need))) if need else 0
    if not k or len(ids) < k:
        return set()
    known = np.isin(ids, list({t for s in need for t in s}))
    whole = np.lib.stride_tricks.sliding_window_view(known, k).all(axis=1)
    return need & {tuple(ids[i : i + k].tolist()) for i in np.flatnonzero(whole)}


def edited_share(part, ids):
    """Share of the part's words that ``ids`` have side by side in order but for one changed, added or missing; 0 if more differ.

    Parts of one or two words allow no edit.
    """
    if len(part) < 3 or np.isin(part, ids).sum() < len(part) - 1:
        return 0.0
    at = np.arange(len(ids) + 1)
    edits = np.zeros(len(ids) + 1, np.int64)  # the fewest that end at each word
    for word in part:
        best = edits + 1
        best[1:] = np.minimum(best[1:], edits[:-1] + (ids != word))
        edits = at + np.minimum.accumulate(best - at)
    return (len(part) - 1) / len(part) if edits.min() <= 1 else 0.0


class ItemIndex:
    """Block-max inverted index of test items.

    Items longer than ``entry_words`` are indexed in several entries, so that a
    passage of twice as many words always holds some entry whole. Items of fewer
    than ``min_words`` words can't be told from chance by shares: they are kept
    apart, to be found as exact sequences.
    """

    def __init__(self, items, doc_freq, n_items, avg_words, entry_words=64, min_words=5, block=64, shingle=3):
        self.terms: dict[str, int] = {}
        self.items, self.question, self.answer, self.parts, entries = [], [], [], [], []
        self.short: dict[tuple[int, ...], list] = {}
        for item_id, question, answer, own in sorted(items, key=lambda x: (x[0] is None, x[0] or 0)):
            words = question + answer
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words]
            q, a = ids[: len(question)], ids[len(question) :]
            if len(words) < min_words:
                if words:
                    self.short.setdefault(tuple(q if own and q else ids), []).append((item_id, a if own and q else []))
                continue
            self.question.append(_shingle_set(q, shingle))
            self.answer.append(_shingle_set(a, shingle))
            self.parts.append((q, a, own))
            parts = -(-len(ids) // entry_words)
            cuts = [len(ids) * i // parts for i in range(parts + 1)]
            entries += [(len(self.items), ids[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]
            self.items.append(item_id)
        self.shingle = shingle
        self.short_keys = {k: np.unique([_sequence_keys(np.array(s), k)[0] for s in self.short if len(s) == k]) for k in {len(s) for s in self.short}}
        df = np.array([doc_freq[w] for w in self.terms], float)
        idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
        post = []
        for e, (_, ids) in enumerate(entries):
            t, tf = np.unique(ids, return_counts=True)
            w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / avg_words))
            post.append((t, np.full(len(t), e), w / w.sum()))
        t, e, w = (np.concatenate(c) for c in zip(*post)) if post else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        order = np.lexsort((e, t))
        self.post_entry, self.post_weight, t = e[order], w[order], t[order]
        self.entry_item = np.array([i for i, _ in entries], np.int64)
        n = len(self.terms)
        self.term_bound = np.zeros(n)
        np.maximum.at(self.term_bound, t, self.post_weight)
        # runs of (term, block): bound and slice of postings
        run = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (self.post_entry[1:] // block != self.post_entry[:-1] // block)]) if len(t) else np.zeros(0, int)
        self.run_block = self.post_entry[run] // block
        self.run_from, self.run_to = run, np.r_[run[1:], len(t)] if len(run) else run
        self.run_bound = np.maximum.reduceat(self.post_weight, run) if len(run) else np.zeros(0)
        self.term_run = np.searchsorted(t[run], np.arange(n + 1)) if len(run) else np.zeros(n + 1, int)
        self.blocks = int(self.run_block.max()) + 1 if len(run) else 0

    def retrieve(self, passage, term, threshold):
        """(passage, entry, score) of all scores >= threshold, for distinct (passage, term) pairs."""
        empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if not len(passage):
            return empty
        slack = threshold - 1e-9
        bound = np.bincount(passage, self.term_bound[term])
        alive = bound[passage] >= slack  # no pivot: the passage can't reach the threshold with any item
        passage, term = passage[alive], term[alive]
        if not len(passage):
            return empty
        first, times = self.term_run[term], self.term_run[term + 1] - self.term_run[term]
        run = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        owner = np.repeat(passage, times)
        cell = owner * self.blocks + self.run_block[run]
        alive = np.bincount(cell, self.run_bound[run])[cell] >= slack  # block bounds
        run, owner = run[alive], owner[alive]
        if not len(run):
            return empty
        times = self.run_to[run] - self.run_from[run]
        post = np.repeat(self.run_from[run] - np.cumsum(times) + times, times) + np.arange(times.sum())
        owner = np.repeat(owner, times)
        cell, at = np.unique(owner * len(self.entry_item) + self.post_entry[post], return_inverse=True)
        score = np.bincount(at, self.post_weight[post], len(cell))
        hit = score >= slack
        return cell[hit] // len(self.entry_item), cell[hit] % len(self.entry_item), score[hit]


def _sequence_keys(ids, k):
    """A hash of every ``k`` terms in a row."""
    key = np.zeros(len(ids) - k + 1, np.int64)
    for i in range(k):
        key = key * np.int64(0x9E3779B97F4A7C1) + ids[i : i + len(key)]
    return key


def _breaks(text):
    """For each term and for the text's end, whether punctuation, a line's end or the text's own edge stands before it."""
    out, gap = [], ""
    for part in _slices(text):
        part, last = part.lower(), 0
        for m in _terms_of(part).finditer(part):
            gap += part[last : m.start()]
            out.append(not out or any(c in "\n\r\x0b\x0c\x85\u2028\u2029" or not (c.isspace() or unicodedata.category(c)[0] == "M") for c in gap))
            gap, last = "", m.end()
        gap += part[last:]
    return [*out, True]


def scan_short(index, ids, text):
    """The same as ``verify`` for short items: their terms as a sentence or line of their own, and an own answer anywhere."""
    first, breaks = {}, None
    for k, keys in index.short_keys.items():
        if len(ids) < k:
            continue
        key = _sequence_keys(ids, k)
        for i in np.flatnonzero(keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key).tolist():
            sequence = tuple(ids[i : i + k].tolist())
            if sequence not in index.short or sequence in first:
                continue
            breaks = breaks or _breaks(text)
            if breaks[i] and breaks[i + k]:
                first[sequence] = i
    return [
        (item_id, 1.0, 1.0, 1.0, i, i + len(sequence))
        for sequence, i in first.items()
        for item_id, answer in index.short[sequence]
        if not answer or _shingles_found({tuple(answer)}, ids)
    ]


def passage_terms(ids, words, step):
    """Distinct (passage, term) pairs of passages of ``words`` words that begin every ``step`` words."""
    at = np.flatnonzero(ids >= 0)
    n = max(1, -(-max(0, len(ids) - words) // step) + 1)
    last = np.minimum(at // step, n - 1)
    pairs = []
    for back in range(-(-words // step)):
        p = last - back
        ok = (p >= 0) & (at < p * step + words)
        pairs.append(p[ok] << 32 | ids[at[ok]])
    key = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return key >> 32, key & 0xFFFFFFFF, n


def scan_document(index, ids, threshold, overlap, words, step):
    """[(item, score, question share, answer share, from word, to word)] of one document's term ids."""
    passage, term, _ = passage_terms(ids, words, step)
    passage, entry, score = index.retrieve(passage, term, threshold)
    return verify(index, ids, passage, entry, score, overlap, words, step)


def verify(index, ids, passage, entry, score, overlap, words, step):
    out = []
    item_of = index.entry_item[entry]
    for item in np.unique(item_of).tolist():
        mine = item_of == item
        held = [(p * step, ids[p * step : p * step + words]) for p in np.unique(passage[mine]).tolist()]
        lo, hi = held[0][0], held[-1][0] + len(held[-1][1])
        need_q, need_a = index.question[item], index.answer[item]
        question, answer, own = index.parts[item]
        share = lambda need, texts: len(set().union(*(_shingles_found(need, t) for t in texts))) / len(need) if need else 1.0
        q, a = (share(need, [t for _, t in held]) for need in (need_q, need_a))
        if q < overlap:
            q = max(q, edited_share(question, ids[lo:hi]))
        if q >= overlap and a < overlap:
            # the answer may stand apart from the passages that hold the question
            a = max(share(need_a, [ids]), edited_share(answer, ids))
        if min(q, a) < overlap and not own and len(answer) < 3:
            both = edited_share(question + answer, ids)
            q, a = max(q, both), max(a, both)
        if q >= overlap and a >= overlap:
            out.append((index.items[item], float(score[mine].max()), q, a, lo, hi))
    return out


def item_words(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None) -> DataFrame:
    """(item_id, text, answer) with plain names."""
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    return benchmark.select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"), answer.alias("answer")
    )


def _item_sizes(items: DataFrame) -> tuple[int, float]:
    """Number of items and their mean number of words."""

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            n = [len(text_words(t)) + len(text_words(a)) for t, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n"])

    n, avg = items.select("text", "answer").mapInArrow(sizes, "n long").agg(F.count("*"), F.avg("n")).first()
    return n, max(avg or 1.0, 1.0)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    threshold: float = 0.6,
    overlap: float = 0.5,
    entry_words: int = 64,
    shard_bytes: int = 8 << 20,
) -> DataFrame:
    """(doc_id, version, item_id, score, question_overlap, answer_overlap, from_word, to_word) of verified leaks.

    Every passage (``2 * entry_words`` words, beginning every ``entry_words``) of
    every whole document is a query against every item. Document frequencies and
    the mean length come from all items. The index travels with the tasks, so
    it is built in shards of at most ``shard_bytes`` of item text (a single
    larger item has a shard of its own), each scanning all documents.
    One row per document row and item; null and empty items and texts match
    nothing; items of one to four terms match where a sentence or line is the
    whole item; repeated documents and items each give their rows; a
    null id is carried along; empty tables give no rows. No other columns are read.
    ``version`` is the text's XXH64, which tells rows with the same id apart;
    the words from ``from_word`` to ``to_word`` are those of the retrieved passages.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    words, step = 2 * entry_words, entry_words
    items = item_words(benchmark, item_id_col, item_text_col, answer_col)
    total = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(F.octet_length("answer"), F.lit(0)))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes) * 2 if total > shard_bytes else 1)
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    n_items, avg = _item_sizes(items)
    names = ["doc_id", "version", "item_id", "score", "question_overlap", "answer_overlap", "from_word", "to_word"]
    schema = "doc_id long, version long, item_id long, score double, question_overlap double, answer_overlap double, from_word long, to_word long"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    out = None
    for shard in range(shards):
        part = [
            (r.item_id, *split_item(text_words(r.text), own := text_words(r.answer)), bool(own))
            for r in dealt.where(F.col("shard") == shard).collect()
        ]
        if not part:
            continue
        vocab = sorted({w for _, q, a, _ in part for w in q + a})
        index = ItemIndex(part, _frequencies(spark, items, vocab, shards), n_items, avg, entry_words)

        def scan(batches, index=index):
            for b in batches:
                found, held = [], []

                def flush():
                    if not held:
                        return
                    p = np.concatenate([h[2] + h[4] for h in held])
                    t = np.concatenate([h[3] for h in held])
                    p, e, s = index.retrieve(p, t, threshold)
                    for doc, ids, _, _, start, n in held:
                        lo, hi = np.searchsorted(p, [start, start + n])
                        if hi > lo:
                            for hit in verify(index, ids, p[lo:hi] - start, e[lo:hi], s[lo:hi], overlap, words, step):
                                found.append((*doc, *hit))
                    held.clear()

                get = index.terms.get
                base = total_terms = 0
                for doc, version, text in zip(b.column(0), b.column(1), b.column(2)):
                    ids = _term_ids(text.as_py(), get)
                    if index.short:
                        found += [(doc.as_py(), version.as_py(), *hit) for hit in scan_short(index, ids, text.as_py())]
                    p, t, n = passage_terms(ids, words, step)
                    held.append(((doc.as_py(), version.as_py()), ids, p, t, base, n))
                    base += n
                    total_terms += len(p)
                    if total_terms > 1 << 18:
                        flush()
                        base = total_terms = 0
                flush()
                types = [*[pa.int64()] * 3, *[pa.float64()] * 3, pa.int64(), pa.int64()]
                cols = list(zip(*found)) if found else [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names=names)

        hits = rows.mapInArrow(scan, schema)
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else spark.createDataFrame([], schema)


def _slices(text: str):
    """The text in slices cut at white space."""
    at, step = 0, 1 << 20
    while at < len(text):
        end = len(text)
        if end - at > step:
            m = re.compile(r"\s").search(text, at + step)
            end = m.start() if m else end
        yield text[at:end]
        at = end


def _term_ids(text: str | None, get):
    """Index term of each word, -1 for others."""
    parts = [np.zeros(0, np.int64)]
    for part in _slices(text or ""):
        words = text_words(part)
        parts.append(np.fromiter((get(w, -1) for w in words), np.int64, len(words)))
    return np.concatenate(parts)


def _frequencies(spark, items: DataFrame, vocab: list[str], shards: int) -> dict[str, int]:
    """Number of items that contain each word of one shard's vocabulary."""

    def words(batches):
        import pyarrow as pa

        for b in batches:
            out = [w for t, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for w in {*text_words(t), *text_words(a)}]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["w"])

    counts = items.select("text", "answer").mapInArrow(words, "w string").groupBy("w").agg(F.count("*").alias("n"))
    if shards > 1:
        counts = counts.join(spark.createDataFrame([(w,) for w in vocab], "w string"), "w")
    return {r.w: r.n for r in counts.collect()}
