"""SentencePiece BPE encoding and decoding, exact, by backtracking over longest matches.

A sequence of pieces is what merging would give if and only if each two
neighbours are what merging gives for the two of them together. So the encoder
walks the text: an Aho-Corasick automaton tells the longest piece that starts at
each place; a piece is taken if it goes with the one before (the two are merged
anew, and the answer is remembered), else its next shorter prefix is tried; where
none goes, the place is marked in a bitfield of failed positions and the walk steps
back. No place fails twice, so the work is linear in the text, whatever it holds.

Text is cut ahead of every space mark that follows another character, provided
that no piece of the vocabulary holds such a pair: no merge can then cross the cut.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_cache

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
SLICE = 1 << 20  # characters cut into segments at a time
REMEMBERED, LONGEST_REMEMBERED = 1 << 18, 64  # segments kept with their ids, and their longest


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message; groups don't occur."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, message[at : at + size]
        at += size


class Pieces:
    """The vocabulary and rules of a BPE model file, with ``encode`` and ``decode``.

    Model kinds other than BPE, character maps, user-defined and unused pieces,
    and different pieces of equal score (but for runs of one character) are refused.
    """

    def __init__(self, model_path: str):
        import struct

        with open(model_path, "rb") as fh:
            model = list(_fields(fh.read()))
        trainer = dict(_fields(next((v for f, v in model if f == 2), b"")))
        rules = dict(_fields(next((v for f, v in model if f == 3), b"")))
        entries = [dict(_fields(v)) for f, v in model if f == 1]
        kinds = [e.get(3, NORMAL) for e in entries]
        names = [e[1].decode() for e in entries]
        if trainer.get(3) != 2 or rules.get(2) or trainer.get(24) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{model_path}: only BPE models of plain, control and byte pieces without a character map are read")
        self.prefix, self.squeeze, self.escape = bool(rules.get(3, 1)), bool(rules.get(4, 1)), bool(rules.get(5, 1))
        self.bos, self.eos = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = [names.index(f"<0x{b:02X}>") for b in range(256)] if trainer.get(35) else None
        self.ids = {n: i for i, (n, k) in enumerate(zip(names, kinds)) if k == NORMAL}
        self.scores = {n: struct.unpack("<f", entries[i].get(2, b"\0\0\0\0"))[0] for n, i in self.ids.items()}
        same: dict[float, str] = {}
        for name, score in self.scores.items():
            if len(name) > 1 and set(same.setdefault(score, name)) | set(name) != {name[0]} and same[score] != name:
                raise ValueError(f"{model_path}: {same[score]!r} and {name!r} have one score")
        self.cuts = not any(SPACE in n.lstrip(SPACE) for n in self.ids)
        # what a piece reads as: control pieces as nothing, byte pieces as their byte, others with spaces
        blank = trainer.get(44, " ⁇ ".encode())
        self.surface = [
            {CONTROL: b"", UNKNOWN: blank, BYTE: bytes([int(n[3:5], 16)]) if k == BYTE else b""}.get(k, n.replace(SPACE, " ").encode())
            for n, k in zip(names, kinds)
        ]
        self.kinds = kinds
        self._index()

    def _index(self) -> None:
        """The automaton over the pieces that merging reaches; characters without a piece are numbered after the vocabulary."""
        import ahocorasick

        self.count = len(self.kinds)
        reached = {p: i for p, i in self.ids.items() if self.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p, i in reached.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.names = dict(zip(reached.values(), reached))
        self.sizes = [len(self.names.get(i, "")) for i in range(self.count)]
        self.shorter = {i: next((reached[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in reached), self.count + ord(p[0])) for p, i in reached.items() if len(p) > 1}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: the best score first, the leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def name(self, i: int) -> str:
        return self.names[i] if i < self.count else chr(i - self.count)

    def goes(self, left: int, right: int) -> bool:
        """Whether merging both together leaves exactly the two; the answer is kept in ``pairs``."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        a, b = self.name(left), self.name(right)
        answer = self.pairs[left << 32 | right] = self.merged(a + b) == [a, b]
        return answer

    def walk(self, text: str) -> list[int]:
        """The pieces of a segment of any length, by number."""
        end, count, sizes, pairs = len(text), self.count, self.sizes, self.pairs
        longest = [-1] * end if end <= LONGEST_REMEMBERED else array("i", [-1]) * end
        for last, i in self.automaton.iter(text):  # of one start, longer matches come later
            longest[last - sizes[i] + 1] = i
        failed = None  # one bit for each place, once there is any
        path: list[int] = []
        at, before, i = 0, -1, -1
        while at < end:  # as long as each longest piece is known to go with the one before
            i = longest[at]
            if i < 0 or before >= 0 and not pairs.get(before << 32 | i):
                break
            path.append(i)
            at += sizes[i]
            before = i
        i = -1
        while at < end:
            if i < 0:
                i = longest[at]
                if i < 0:
                    i = count + ord(text[at])
            stop = at + (sizes[i] if i < count else 1)
            if failed is None or not failed[stop >> 3] >> (stop & 7) & 1:
                fits = before < 0 or pairs.get(before << 32 | i)
                if fits is None:
                    fits = self.goes(before, i)
                if fits:
                    path.append(i)
                    at, before, i = stop, i, -1
                    continue
            shorter = self.shorter.get(i)
            if shorter is None:
                if failed is None:
                    failed = bytearray((end >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                i = path.pop()
                at -= sizes[i] if i < count else 1
                before = path[-1] if path else -1
            else:
                i = shorter
        return path

    def segment(self, text: str) -> bytes:
        """Ids of a segment, 32 bits each; characters without a piece become their bytes, or the unknown id."""
        ids: list[int] = []
        for i in self.walk(text):
            if i < self.count:
                ids.append(i)
            elif self.bytes:
                ids += [self.bytes[b] for b in chr(i - self.count).encode()]
            else:
                ids.append(self.unknown)
        found = array("I", ids).tobytes()
        if len(text) <= LONGEST_REMEMBERED:
            self.remember(text, found)
        return found

    def remember(self, text: str, found: bytes) -> None:
        """Half of the remembered segments are the newest ones; when those fill their half, they take the place of the others."""
        if len(self.known) >= REMEMBERED // 2:
            self.older, self.known = self.known, {}
        self.known[text] = found

    def recalled(self, text: str) -> bytes:
        """Ids of a segment that isn't among the newest remembered ones; one that was met before is among them again."""
        found = self.older.get(text)
        if found is None:
            return self.segment(text)
        self.remember(text, found)
        return found

    def normal(self, text: str) -> str:
        """The text with space marks, as the model's rules want it."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.prefix:
            text = " " + text
        return text.replace(" ", SPACE) if self.escape else text

    def encode(self, text: str, ends: bool = True) -> array:
        """Ids as unsigned 32-bit numbers, between the begin and end ids if ``ends``."""
        text = self.normal(text)
        out = array("I", [self.bos] if ends else [])
        at = 0
        while at < len(text):
            stop = len(text)
            if self.cuts and stop - at > SLICE:
                here = re.compile(f"[^{SPACE}]{SPACE}").search(text, at + SLICE)
                stop = here.start() + 1 if here else stop
            part = text[at:stop]
            segments = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", part) if self.cuts else [part]
            ids = b"".join([self.known.get(s) or self.recalled(s) for s in segments])
            if self.bytes:
                out.frombytes(ids)
            else:  # neighbouring unknown characters are one id
                for i in memoryview(ids).cast("I"):
                    if i != self.unknown or not out or out[-1] != i:
                        out.append(i)
            at = stop
        if ends:
            out.append(self.eos)
        return out

    def decode(self, ids) -> str:
        """The text of the ids: without the space that the rules put first, each byte of a broken character as U+FFFD."""
        parts = list(map(self.surface.__getitem__, ids))
        first = next((i for i, p in enumerate(parts) if p), len(parts))
        # the first piece that reads as anything loses one space of its own (all that are ahead, if spaces are squeezed)
        if (self.prefix or self.squeeze) and first < len(parts) and self.kinds[ids[first]] == NORMAL:
            if self.squeeze:
                while first < len(parts) and self.kinds[ids[first]] == NORMAL:
                    parts[first] = parts[first].lstrip(b" ")
                    if parts[first]:
                        break
                    first += 1
            elif parts[first].startswith(b" "):
                parts[first] = parts[first][1:]
        if b"" not in parts[first + 1 : -1]:  # a piece that reads as nothing would part the bytes around it
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        codecs.register_error("ridgeway.each", lambda e: ("\N{REPLACEMENT CHARACTER}", e.start + 1))  # one for each broken byte
        out, held = [], bytearray()
        for p, i in [*zip(parts, ids), (b"", self.bos)]:
            if self.kinds[i] == BYTE:
                held += p
                continue
            out.append(held.decode(errors="ridgeway.each"))
            held.clear()
            out.append(p.decode())
        return "".join(out)


def pieces_of(model_path: str) -> Pieces:
    """The model of a file, read once per worker."""
    cache = worker_cache()
    if ("pieces", model_path) not in cache:
        cache["pieces", model_path] = Pieces(model_path)
    return cache["pieces", model_path]


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", ends: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: ids as little-endian unsigned 32-bit numbers, and the text read back from them.

    A null text counts as empty and has the end ids alone. Repeated rows give
    repeated rows, a null id comes back as null, an empty table gives none;
    equal texts have equal ids. Only the id and the text are read, so other
    columns can't clash. Texts of any length are encoded whole, in linear time
    and with memory in proportion to the longest one; what can't be UTF-8
    counts as U+FFFD.
    """
    import pyarrow as pa

    names, types = ["doc_id", "n_tokens", "ids", "decoded"], [pa.int64(), pa.int64(), pa.binary(), pa.string()]

    def run(batches):
        import sys

        model = pieces_of(model_path)
        for b in batches:
            rows, held = [], 0
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1)):
                ids = model.encode((raw.as_py() or b"").decode("utf-8", "replace"), ends)
                text = model.decode(ids)
                if sys.byteorder == "big":
                    ids.byteswap()
                rows.append((doc, len(ids), ids.tobytes(), text))
                held += 4 * len(ids) + len(text)
                if held > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
