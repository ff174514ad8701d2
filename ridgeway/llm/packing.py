"""Best-fit packing of tokenised documents after a dominance reduction.

Only lengths matter for packing, and they are at most the sequence length, so
the plan is made from the histogram of lengths: its size is bounded by the
capacity whatever the number of documents. First the reduction of Martello
and Toth fixes sets that provably belong to some optimal packing; then
best-fit decreasing, in whole groups of equal sequences, packs what is left.
Each piece finds its place by its rank among the pieces of its length, which
needs one prefix sum over (input task, length) counts.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, materialize, stored, worker_cache


def encoder(vocab_path: str):
    """Byte-level BPE of a ``tokenizers`` JSON file as a tiktoken encoding (the same ids, several times faster).

    The file's added tokens are its special tokens: whoever encodes says whether they are allowed.
    """
    import json

    import tiktoken

    cache = worker_cache()
    if ("bpe", vocab_path) not in cache:
        with open(vocab_path, encoding="utf-8") as fh:
            spec = json.load(fh)
        # the printable stand-ins of byte-level BPE: printable bytes stand for themselves, the rest follow from 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        stand = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(stand[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        cache["bpe", vocab_path] = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return cache["bpe", vocab_path]


#: White space as the vocabulary's pattern means it, in runs long enough to be cut out: the pattern steps back through a run
#: character by character, and gives up on very long ones.
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{256,}")


def _plain_ids(enc, text: str) -> list[np.ndarray]:
    """Ids of a text without special tokens. The pattern takes a run of white space as one word, but for its last
    character where more text follows; long runs are encoded as that word without the pattern."""
    parts, at = [], 0
    for run in _RUN.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        parts += [enc.encode_to_numpy(text[at : run.start()], disallowed_special=()), enc._encode_single_piece(text[run.start() : stop])]
        at = stop
    return [*parts, enc.encode_to_numpy(text[at:], disallowed_special=())]


def token_ids(enc, text: str, special_tokens: bool = False) -> np.ndarray:
    """Little-endian unsigned 32-bit ids of a text of any length; added tokens have their own ids if ``special_tokens``."""
    names = sorted(enc.special_tokens_set, key=len, reverse=True) if special_tokens else []
    parts: list = []
    for i, piece in enumerate(re.split(f"({'|'.join(map(re.escape, names))})", text) if names else [text]):
        parts += [[enc.encode_single_token(piece)]] if i % 2 else _plain_ids(enc, piece)
    return np.concatenate([np.asarray(p, "<u4") for p in parts])


def tokenized_pieces(
    docs: DataFrame,
    vocab_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_tokens: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids, at, nth): each text's ids and ``end_id``, cut only where longer than ``capacity``.

    ``ids`` holds little-endian unsigned 32-bit ids. Of a long document all
    pieces but the first are full. A null or empty text is the end id alone.
    With ``special_tokens`` the file's added tokens have their own ids wherever a
    text holds them, as ``tokenizers`` encodes by default; else they are ordinary
    text. ``at`` numbers the pieces (the task's number above 33 bits), ``nth``
    those of one length within a task, from 0.
    """
    import pyarrow as pa

    names = ["doc_id", "piece", "start", "length", "ids", "at", "nth"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches):
        from pyspark import TaskContext

        enc = encoder(vocab_path)
        at, seen = TaskContext.get().partitionId() << 33, [0] * (capacity + 1)
        for b in batches:
            rows, held = [], 0
            for doc, text in zip(b.column(0), b.column(1)):
                ids = np.append(token_ids(enc, text.as_py() or "", special_tokens), np.uint32(end_id))
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc.as_py(), i, lo, hi - lo, ids[lo:hi].tobytes(), at, seen[hi - lo]))
                    seen[hi - lo] += 1
                    at += 1
                held += len(ids)
                if held > 1 << 21:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, at long, nth long")


class _Counts:
    """Histogram of lengths with its sorted list of lengths in use."""

    def __init__(self, histogram: dict[int, int]):
        self.n = {k: v for k, v in histogram.items() if v > 0}
        self.keys = sorted(self.n)

    def take(self, length: int, count: int) -> None:
        self.n[length] -= count
        if not self.n[length]:
            del self.n[length]
            self.keys.pop(bisect_left(self.keys, length))

    def largest(self, room: int, but: int) -> int | None:
        """Largest length of at most ``room``, with one item of length ``but`` set aside."""
        i = bisect_left(self.keys, room + 1) - 1
        if i >= 0 and self.keys[i] == but and self.n[but] < 2:
            i -= 1
        return self.keys[i] if i >= 0 else None

    def smallest(self, many: int, but: int) -> list[int]:
        """The ``many`` smallest items, with one item of length ``but`` set aside."""
        out: list[int] = []
        for k in self.keys:
            out += [k] * min(many - len(out), self.n[k] - (k == but))
            if len(out) == many:
                break
        return out

    def best_pair(self, room: int, but: int) -> int:
        """Largest sum of two items that is at most ``room`` (0 if no two fit), with one item ``but`` set aside."""
        free = lambda k: self.n[k] - (k == but)
        lo, hi, best = 0, bisect_left(self.keys, room + 1) - 1, 0
        while lo <= hi:
            a, b = self.keys[lo], self.keys[hi]
            if not free(a):
                lo += 1
            elif not free(b):
                hi -= 1
            elif a + b > room:
                hi -= 1
            else:
                if lo < hi or free(a) > 1:
                    best = max(best, a + b)
                lo += 1
        return best


def dominance_reduction(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets that some optimal packing contains, as (lengths, how often), and the histogram that remains.

    For an item j let k be the largest other item that fits beside it. {j} is
    fixed if there is none. {j, k} is fixed if it fills the sequence, if no two
    items fit beside j, or if no three do and no two that do are together longer
    than k: any other set with j can then be exchanged for it at no loss.
    """
    c, fixed, changed = _Counts(histogram), [], True
    while changed:
        changed = False
        for j in sorted(c.n, reverse=True):
            while c.n.get(j):
                room = capacity - j
                k = c.largest(room, j)
                if k is None:
                    times = c.n[j] if 2 * j > capacity else 1
                    fixed.append(((j,), times))
                    c.take(j, times)
                else:
                    two = c.smallest(2, j)
                    three = c.smallest(3, j)
                    wins = (
                        k == room
                        or len(two) < 2
                        or sum(two) > room
                        or ((len(three) < 3 or sum(three) > room) and c.best_pair(room, j) <= k)
                    )
                    if not wins:
                        break
                    times = (c.n[j] // 2 if j == k else min(c.n[j], c.n[k])) if k == room or sum(two) > room else 1
                    fixed.append(((j, k), times))
                    c.take(j, times)
                    c.take(k, times)
                changed = True
    return fixed, c.n


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Places (length, first rank, items, first sequence, items a sequence, offset) and the number of sequences.

    Ranks from ``first rank`` on fill sequences from ``first sequence`` on, so
    many items to each, side by side from ``offset``.
    """
    places, used, sequences = [], dict.fromkeys(histogram, 0), 0

    def put(length, items, seq, each, offset):
        places.append((length, used[length], items, seq, each, offset))
        used[length] += items

    fixed, rest = dominance_reduction(histogram, capacity)
    for lengths, times in fixed:
        offset = 0
        for length in lengths:
            put(length, times, sequences, 1, offset)
            offset += length
        sequences += times
    open_groups: list[tuple[int, int, int]] = []  # (room, first sequence, sequences), sorted
    for length in sorted(rest, reverse=True):
        left = rest[length]
        at = bisect_left(open_groups, (length,))
        grown = []
        while left:
            if at < len(open_groups):
                room, seq, n = open_groups.pop(at)
            else:
                each = capacity // length
                room, seq, n = capacity, sequences, -(-left // each)
                sequences += n
            each = room // length
            full = min(n, left // each)
            if full:
                put(length, full * each, seq, each, capacity - room)
                grown.append((room - each * length, seq, full))
                left -= full * each
            if full < n:
                if 0 < left < each:
                    put(length, left, seq + full, left, capacity - room)
                    grown.append((room - left * length, seq + full, 1))
                    left, full = 0, full + 1
                if full < n:
                    grown.append((room, seq + full, n - full))
        for g in grown:
            if g[0]:
                insort(open_groups, g)
    return places, sequences


def places(rows: DataFrame, capacity: int) -> DataFrame:
    """(at, sequence_id, offset) of rows (at, length, nth): ``at`` numbers the rows, its bits above 33 the groups within which
    ``nth`` numbers those of one length.

    Per length, the groups' counts give each group's first rank. Only the
    histogram (``capacity`` numbers at most) reaches the driver, and the plan made
    of it (a few rows for each length) returns with the tasks. Every length must
    lie in 1..capacity. Rows of equal length take their places in the order of ``at``.
    """
    import pyarrow as pa

    rows = rows.select("at", "length", "nth", F.shiftright("at", 33).alias("task"))
    counts = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    if any(k is None or not 1 <= k <= capacity for k in histogram):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    planned, _ = plan(histogram, capacity)
    table = np.array(sorted(planned), np.int64).reshape(-1, 6)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    base = counts.select("task", "length", before.alias("base"))
    ranked = rows.join(base, ["task", "length"]).select("at", "length", (F.col("base") + F.col("nth")).alias("rank"))

    def run(batches):
        # places are sorted by (length, first rank); every rank lies in exactly one
        key = table[:, 0] * (1 << 45) + table[:, 1]
        for b in batches:
            length, rank = (b.column(i).to_numpy() for i in (1, 2))
            place = table[np.searchsorted(key, length * (1 << 45) + rank, side="right") - 1]
            nth = rank - place[:, 1]
            seq = place[:, 3] + nth // place[:, 4]
            offset = place[:, 5] + nth % place[:, 4] * length
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(seq), pa.array(offset)], names=["at", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "at long, sequence_id long, offset long")


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset, in as few sequences of ``capacity`` as the method finds.

    The rows are checkpointed with their input task's number and order; see
    ``places``. An empty table gives no rows.
    """
    rows = materialize(carried(pieces, length=F.col(f"`{length_col}`").cast("long"), at=F.monotonically_increasing_id()))
    local = F.row_number().over(Window.partitionBy(F.shiftright("at", 33), "length").orderBy("at")) - 1
    found = places(rows.select("at", "length", local.cast("long").alias("nth")), capacity)
    return rows.join(found, "at").select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocab_path: str, capacity: int = 2048, end_id: int = 0, special_tokens: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids) of every piece.

    The pieces are written once to the shared folder; places are found from
    their lengths alone, and the ids are joined to them at the end. Sequences are
    rebuilt by putting each sequence's ids together in the order of offset.

    Repeated rows are packed as often as they come; an empty table gives no
    rows; a null doc_id is carried along; other columns are not read. Pieces of
    equal length take their places in the order in which they were written. A
    very long text is cut into pieces; runs of white space of any length have the
    ids that the ``tokenizers`` library gives them.
    """
    pieces = stored(tokenized_pieces(docs, vocab_path, capacity, end_id, special_tokens=special_tokens), "pieces", "zstd")
    done = pieces.join(places(pieces, capacity), "at")
    crc = F.crc32("ids").alias("ids_crc32")
    return done.select("doc_id", "piece", "start", "length", crc, "sequence_id", "offset", "ids")
