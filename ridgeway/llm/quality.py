"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded from
its byte-class bigrams and a few counts over its words; gated attention (tanh
times sigmoid) weighs the encodings, and a logistic layer scores their
weighted sum. Encoder, attention and scorer are learned together from
document labels alone. A document's passages may be scored slice by slice: the
softmax over them is accumulated, so memory doesn't follow the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out

PASSAGE_WORDS = 64
KINDS = 13
STATS = 6
FEATURES = KINDS * KINDS + STATS


def _byte_kinds() -> np.ndarray:
    table = np.full(256, 10, np.int64)  # brackets, quotes and other marks
    table[:32] = 12
    table[[9, 10, 11, 12, 13]] = 1
    table[32] = 0
    table[ord("a") : ord("z") + 1] = 2
    table[ord("A") : ord("Z") + 1] = 3
    table[ord("0") : ord("9") + 1] = 4
    for kind, chars in ((5, b"."), (6, b",;:"), (7, b"!?"), (8, b"|"), (9, b"*#$%&@~^=+<>_\\/")):
        table[list(chars)] = kind
    table[128:] = 11
    return table


def passage_features(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, piece of each passage); a piece without words has one passage of zeros."""
    data = np.frombuffer(b"\n" + b"\n".join(pieces) + b"\n", np.uint8)
    kind = _byte_kinds()[data]
    gap = kind <= 1
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    edges = np.cumsum([1] + [len(p) + 1 for p in pieces])
    piece = np.searchsorted(edges, start, side="right") - 1
    counts = np.bincount(piece, minlength=len(pieces))
    nth = np.arange(len(start)) - np.repeat(np.cumsum(counts) - counts, counts)
    passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.cumsum(passages) - passages
    total = int(passages.sum())
    of_word = first[piece] + nth // PASSAGE_WORDS
    x = np.zeros((total, FEATURES), np.float32)
    if len(start):
        word = np.cumsum(np.r_[False, gap[:-1] & ~gap[1:]]) - 1  # of each byte; white space follows its word
        inside = np.flatnonzero(word >= 0)[:-1]
        key = of_word[word[inside]] * (KINDS * KINDS) + kind[inside] * KINDS + kind[inside + 1]
        pairs = np.bincount(key, minlength=total * KINDS * KINDS).reshape(total, -1)
        x[:, : KINDS * KINDS] = np.sqrt(pairs / np.maximum(pairs.sum(1, keepdims=True), 1))
        up = np.full(len(data), 0x9E3779B97F4A7C15, np.uint64)
        up[0] = 1
        down = np.full(len(data), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
        down[0] = 1
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * np.cumprod(up), dtype=np.uint64)]
        h = (sums[end] - sums[start]) * np.cumprod(down)[start]
        h ^= h >> np.uint64(29)
        n = np.bincount(of_word, minlength=total)
        same = np.r_[False, (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])]
        mixed = np.sort((of_word.astype(np.uint64) << np.uint64(40)) | ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(24)))
        kinds = np.flatnonzero(np.r_[True, mixed[1:] != mixed[:-1]])
        distinct = np.bincount((mixed[kinds] >> np.uint64(40)).astype(np.int64), minlength=total)
        length = np.bincount(of_word, end - start, total)
        some = np.maximum(n, 1)
        stats = (n / PASSAGE_WORDS, length / some / 10, np.bincount(of_word, same, total) / some, distinct / some,
                 np.bincount(of_word, (end - start) > 20, total) / some)
        for i, s in enumerate(stats):
            x[:, KINDS * KINDS + i] = s
    x[:, -1] = x[:, KINDS * KINDS] == 0
    return x, np.repeat(np.arange(len(pieces)), passages)


@dataclass
class BagModel:
    """Weights of encoder, gated attention and scorer, over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(encodings, attention logits) of passages."""
        w = self.w
        h = np.tanh((x - self.mean) / self.scale @ w["e"] + w["e0"])
        gate = np.tanh(h @ w["v"]) / (1 + np.exp(-(h @ w["u"])))
        return h, gate @ w["a"]

    def score(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z @ self.w["s"] + self.w["s0"], -30, 30)))


def fit_bags(bags: list[np.ndarray], labels, weights, hidden=24, gate=12, epochs=40, rate=0.01, decay=1e-4, seed=7) -> BagModel:
    """Learn from bags of passage features by Adam on the weighted log loss."""
    rng = np.random.default_rng(seed)
    labels, weights = np.asarray(labels, float), np.asarray(weights, float)
    flat = np.concatenate(bags)
    model = BagModel(flat.mean(0), flat.std(0) + 0.05, {
        "e": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, hidden)), "e0": np.zeros(hidden),
        "v": rng.normal(0, 1 / np.sqrt(hidden), (hidden, gate)), "u": rng.normal(0, 1 / np.sqrt(hidden), (hidden, gate)),
        "a": np.zeros(gate), "s": np.zeros(hidden), "s0": np.zeros(()),
    })
    w, m, v = model.w, {}, {}
    bags = [(b - model.mean) / model.scale for b in bags]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            x = np.concatenate([bags[i] for i in pick])
            sizes = np.array([len(bags[i]) for i in pick])
            first, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(pick)), sizes)
            h = np.tanh(x @ w["e"] + w["e0"])
            p, q = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
            logit = (p * q) @ w["a"]
            weight = np.exp(logit - np.maximum.reduceat(logit, first)[bag])
            weight /= np.add.reduceat(weight, first)[bag]
            z = np.add.reduceat(weight[:, None] * h, first)
            d = (model.score(z) - labels[pick]) * weights[pick] / weights[pick].sum()
            g = {"s": z.T @ d, "s0": d.sum()}
            dz = (d[:, None] * w["s"])[bag]
            dw = (dz * h).sum(1)
            dlogit = weight * (dw - np.add.reduceat(weight * dw, first)[bag])
            g["a"] = (p * q).T @ dlogit
            dp, dq = dlogit[:, None] * w["a"] * q * (1 - p * p), dlogit[:, None] * w["a"] * p * q * (1 - q)
            g["v"], g["u"] = h.T @ dp, h.T @ dq
            dh = (weight[:, None] * dz + dp @ w["v"].T + dq @ w["u"].T) * (1 - h * h)
            g["e"], g["e0"] = x.T @ dh, dh.sum(0)
            step += 1
            for k in w:
                grad = g[k] + decay * w[k]
                m[k] = 0.9 * m.get(k, 0) + 0.1 * grad
                v[k] = 0.999 * v.get(k, 0) + 0.001 * grad * grad
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _pieces(text: str | None, size: int = 1 << 20):
    """A text's bytes in slices cut at white space; one empty slice for no text."""
    import re

    data = (text or "").encode("utf-8", "replace")
    at, space = 0, re.compile(rb"[\x20\x09-\x0d]")
    while True:
        m = space.search(data, at + size) if len(data) - at > size else None
        end = m.start() if m else len(data)
        yield data[at:end]
        if end == len(data):
            return
        at = end


def sample_passages(slices, most: int, seed: int) -> np.ndarray:
    """At most ``most`` rows of all the slices' features, in their order, each equally likely; holds one slice at a time."""
    rng = np.random.default_rng(seed & ((1 << 64) - 1))
    kept, rank = np.zeros((0, FEATURES), np.float32), np.zeros(0)
    for x in slices:
        kept, rank = np.concatenate([kept, x]), np.r_[rank, rng.random(len(x))]
        if len(rank) > most:
            pick = np.sort(np.argpartition(rank, most)[:most])
            kept, rank = kept[pick], rank[pick]
    return kept


def score_texts(model: BagModel, texts) -> np.ndarray:
    """Scores of whole texts, worked through in groups of about a megabyte."""
    n, hidden = len(texts), len(model.w["s"])
    top, total, z = np.full(n, -np.inf), np.zeros(n), np.zeros((n, hidden))
    group: list = []

    def work():
        x, piece = passage_features([p for _, p in group])
        doc = np.array([d for d, _ in group])[piece]
        h, logit = model.encode(x)
        new = top.copy()
        np.maximum.at(new, doc, logit)
        seen = np.unique(doc)
        shrink = np.exp(top[seen] - new[seen])
        total[seen] *= shrink
        z[seen] *= shrink[:, None]
        weight = np.exp(logit - new[doc])
        cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        total[doc[cut]] += np.add.reduceat(weight, cut)
        z[doc[cut]] += np.add.reduceat(weight[:, None] * h, cut)
        top[:] = new
        group.clear()

    held = 0
    for i, text in enumerate(texts):
        for p in _pieces(text):
            group.append((i, p))
            held += len(p) + 200
            if held > 1 << 20:
                work()
                held = 0
    if group:
        work()
    return model.score(z / np.maximum(total, 1e-300)[:, None])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    docs_per_label: int = 1500,
    passages_per_doc: int = 64,
) -> BagModel | None:
    """Learn from the labelled documents that are not held out; None without any.

    The fit takes a bounded sample, ``docs_per_label`` documents of each label on
    average and never over twice that of either, those with the smallest hash of
    the id; losses are weighted back to the labels' true shares. Only the
    sample's ids are broadcast. Of several labels of one document the smallest
    counts, of several texts of one id the one with the smallest features. Of a
    document with more than ``passages_per_doc`` passages so many are drawn,
    uniformly and by a seed of its id, from the whole text: what reaches the
    driver is bounded by both parameters, whatever the texts' lengths. Scoring
    takes every passage.
    """
    import pyarrow as pa

    known = labels.select(F.col(label_id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out("id")).groupBy("id").agg(F.min("label").alias("label"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    part = F.xxhash64("id").bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    sample = None
    for k, n in sorted(sizes.items()):
        some = known.where((F.col("label") == k) & (part < docs_per_label / n)).orderBy(part, "id").limit(2 * docs_per_label)
        sample = some if sample is None else sample.unionByName(some)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            out = []
            for id_, text, label in zip(*(b.column(c).to_pylist() for c in ("id", "text", "label"))):
                x = sample_passages((passage_features([p])[0] for p in _pieces(text)), passages_per_doc, id_)
                out.append((id_, label, x.astype("<f4").tobytes()))
            cols = list(zip(*out)) if out else [()] * 3
            types = [pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["id", "label", "x"])

    found = texts.join(F.broadcast(sample), "id").select("id", "text", "label").mapInArrow(run, "id long, label int, x binary")
    found = found.groupBy("id", "label").agg(F.min("x").alias("x"))
    found = sorted(found.collect(), key=lambda r: r.id)
    if not found:
        return None
    bags = [np.frombuffer(bytes(r.x), "<f4").reshape(-1, FEATURES).astype(float) for r in found]
    got = {k: sum(r.label == k for r in found) for k in sizes}
    return fit_bags(bags, [r.label for r in found], [sizes[r.label] / got[r.label] for r in found])


def predict(
    docs: DataFrame, model: BagModel | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row's whole text.

    Only the text enters a score. A null or empty text is scored as a bag of
    one empty passage; without a model every score is 0.5. Repeated rows give
    repeated rows, a null doc_id is held out, an empty table gives none.
    """
    import pyarrow as pa

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            score = score_texts(model, texts) if model else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType().add("doc_id", "long").add("score", "double")
    scored = rows.mapInArrow(run, schema)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
