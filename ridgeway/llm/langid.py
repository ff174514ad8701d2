"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become hashed counts of character 1- to 3-grams (letters lower-cased,
runs of anything else one space), weighted by 1 + log(count) and inverse
document frequency, scaled to unit length. Weights are learned with the
follow-the-regularised-leader update under an elastic-net penalty, which
leaves most of them exactly zero, and probabilities are tempered on rows kept
out of the fit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, held_out, sum_vectors, worker_cache

BITS = 15
SIZE = 1 << BITS
UNDETERMINED = "und"


def _letters():
    """Lookup from code point to itself where it is a letter, else a space."""
    import sys

    import numpy as np

    cache = worker_cache()
    if "letters" not in cache:
        table = np.full(sys.maxunicode + 1, 32, np.uint32)
        for cp in range(sys.maxunicode + 1):
            if chr(cp).isalpha():
                table[cp] = cp
        cache["letters"] = table
    return cache["letters"]


def ngram_counts(text: str | None, step: int = 1 << 20):
    """(bucket indices, counts) of a whole text's n-grams; None without a letter. Memory follows ``step``, not the text."""
    import numpy as np

    if not text:
        return None
    table, total, tail, seen = _letters(), np.zeros(SIZE, np.int64), np.array([32], np.uint32), False
    for at in range(0, len(text), step):
        piece = text[at : at + step].lower().encode("utf-32-le", "replace")
        codes = np.concatenate([tail, table[np.frombuffer(piece, "<u4")]])
        gap = codes == 32
        seen = seen or not gap.all()
        fresh = max(len(tail), 1)
        keep = ~(gap & np.r_[False, gap[:-1]])
        keep[:fresh] = True
        codes = codes[keep].astype(np.uint64)
        for n in (1, 2, 3):
            start = max(0, fresh - n + 1) if n > 1 else fresh
            h = codes[start : len(codes) - n + 1]
            for k in range(1, n):
                h = h * np.uint64(0x100000001B3) + codes[start + k : len(codes) - n + 1 + k]
            h = (h * np.uint64(8) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            if len(h):
                total += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=SIZE)
        tail = codes[-2:].astype(np.uint32)
    if not seen:
        return None
    at = np.flatnonzero(total)
    return at, total[at]


def _unit(at, counts, idf):
    import numpy as np

    v = (1 + np.log(counts)) * idf[at]
    return v / max(np.sqrt(v @ v), 1e-12)


@dataclass
class LanguageModel:
    """labels[k]'s weights are weights[:, k]; ``temperature`` divides the logits."""

    labels: list[str]
    idf: object = None
    weights: object = None
    bias: object = None
    temperature: float = 1.0
    stats: dict = field(default_factory=dict)

    def logits(self, at, counts):
        return _unit(at, counts, self.idf) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        import numpy as np

        got = ngram_counts(text) if self.labels else None
        if got is None:
            return UNDETERMINED, 0.0
        z = self.logits(*got) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def ftrl_fit(rows, idf, n_labels, epochs=3, alpha=0.5, beta=1.0, l1=0.02, l2=0.02):
    """Weights and bias from rows of (label index, bucket indices, counts), one pass per epoch in the order given."""
    import numpy as np

    z, n = np.zeros((SIZE + 1, n_labels)), np.zeros((SIZE + 1, n_labels))

    def weights(at):
        zz, nn = z[at], n[at]
        shrunk = np.sign(zz) * np.maximum(np.abs(zz) - l1, 0)
        return -shrunk / ((beta + np.sqrt(nn)) / alpha + l2)

    for _ in range(epochs):
        for label, at, counts in rows:
            at_b = np.append(at, SIZE)
            x = np.append(_unit(at, counts, idf), 1.0)
            w = weights(at_b)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p[None, :]
            old = n[at_b]
            sigma = (np.sqrt(old + g * g) - np.sqrt(old)) / alpha
            z[at_b] += g - sigma * w
            n[at_b] = old + g * g
    w = weights(np.arange(SIZE + 1))
    return w[:SIZE].astype(np.float32), w[SIZE]


def calibrate(logits, labels) -> float:
    """Temperature of least log loss on rows kept out of the fit (1 without rows)."""
    import numpy as np

    if not len(labels):
        return 1.0
    z, y = np.asarray(logits), np.asarray(labels)

    def loss(t):
        s = z / t
        s = s - s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]))

    grid = np.exp(np.linspace(np.log(0.05), np.log(10), 200))
    return float(min(grid, key=loss))


def fit(
    docs: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    rows_per_label: int = 1000,
    max_labels: int = 500,
    id_col: str | None = None,
) -> LanguageModel:
    """Learn from the rows of ``docs`` with a label and a letter.

    Document frequencies come from all these rows. The weights are fitted on a
    bounded sample, ``rows_per_label`` rows of each label on average and never
    over twice that of any: those with the smallest hash of text and id, so that
    copies of a text enter one by one and a rerun takes the same rows. Rows that
    are equal in label, text and id count once there. A fifth of the texts sets
    the temperature instead, copies of a text on the same side. Without any
    labelled row the model knows no label and answers ``und``.
    """
    import numpy as np
    import pyarrow as pa

    rows = docs.select(
        F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"),
        (F.col(id_col).cast("string") if id_col else F.lit(None).cast("string")).alias("id"),
    )
    rows = rows.where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).limit(max_labels + 1).collect()}
    if len(sizes) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    labels = sorted(sizes)
    if not labels:
        return LanguageModel([])

    def frequencies(batches):
        df = np.zeros(SIZE + 1)
        for b in batches:
            for t in b.column(0):
                got = ngram_counts(t.as_py())
                if got is not None:
                    df[got[0]] += 1
                    df[SIZE] += 1
        yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary())], names=["v"])

    total = sum_vectors(rows.select("text").mapInArrow(frequencies, "v binary"), SIZE + 1)
    idf = (np.log((1 + total[SIZE]) / (1 + total[:SIZE])) + 1).astype(np.float32)

    share = F.create_map(*(F.lit(x) for k in labels for x in (k, rows_per_label / sizes[k])))[F.col("label")]
    order = F.xxhash64("text", "id")
    sample = rows.withColumn("order", order).withColumn("key", F.xxhash64("text")).where((order.bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)) < share)

    def features(batches):
        for b in batches:
            out = []
            for label, text, order, key in zip(*(b.column(i).to_pylist() for i in range(4))):
                got = ngram_counts(text)
                if got is not None:
                    out.append((label, order, key, got[0].astype("<u2").tobytes(), got[1].astype("<f4").tobytes()))
            cols = list(zip(*out)) if out else [()] * 5
            types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["label", "order", "key", "at", "n"])

    found = sample.select("label", "text", "order", "key").mapInArrow(
        features, "label string, order long, key long, at binary, n binary"
    )
    found = found.groupBy("label", "order", "key").agg(F.min(F.struct("at", "n")).alias("x")).select("label", "order", "key", "x.*")
    first = F.row_number().over(Window.partitionBy("label").orderBy(F.col("order").bitwiseAND(F.lit((1 << 53) - 1)), "order", "key"))
    found = found.withColumn("nth", first).where(F.col("nth") <= 2 * rows_per_label).collect()
    found = sorted(found, key=lambda r: (r.key, r.order, r.label))
    data = [
        (labels.index(r.label), np.frombuffer(bytes(r.at), "<u2").astype(np.int64), np.frombuffer(bytes(r.n), "<f4"))
        for r in found
    ]
    kept = [d for d, r in zip(data, found) if r.key % 5 != 0] or data
    spare = [d for d, r in zip(data, found) if r.key % 5 == 0]
    weights, bias = ftrl_fit(kept, idf, len(labels))
    model = LanguageModel(labels, idf, weights, bias)
    model.temperature = calibrate([model.logits(a, n) for _, a, n in spare], [k for k, _, _ in spare])
    model.stats = {"fit_rows": len(kept), "calibration_rows": len(spare), "nonzero": int(np.count_nonzero(weights))}
    return model


def predict(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """(doc_id, lang_pred, score) for every row's whole text; ``und`` and 0 for a null text or one without a letter.

    With ``carry`` the whole input row comes along as the struct ``row``.
    """
    import pyarrow as pa

    def run(batches):
        for b in batches:
            texts = (row[text_col] for row in b.column("row")) if carry else b.column("text")
            got = [model.predict(t.as_py()) for t in texts]
            lang, score = zip(*got) if got else ((), ())
            kept = [c for c in b.schema.names if c != "text"]
            cols = [*(b.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, "lang_pred", "score"])

    doc = F.col(id_col).cast("long").alias("doc_id")
    rows = carried(docs, doc_id=doc) if carry else docs.select(doc, F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([f for f in rows.schema if f.name != "text"])
    return rows.mapInArrow(run, schema.add("lang_pred", "string").add("score", "double"))


def fit_and_predict(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    held: Column | None = None,
    rows_per_label: int = 1000,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learn from the rows not held out, predict all.

    Only the text enters a prediction. Repeated rows give repeated rows, a null
    doc_id is held out, an empty table gives none; other columns are not read.
    """
    held = held_out(id_col) if held is None else held
    model = fit(docs.where(~held), text_col, label_col, rows_per_label, id_col=id_col)
    got = predict(docs, model, id_col, text_col)
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
