"""Chat formatting as prefix trees: turns that conversations share are emitted once, depth first.

Conversations are sorted by their turns' digests, which is the depth-first
order of the tree of their prefixes, and range-partitioned in that order, so
a first turn that very many share spreads over many shards. A shard is one
token sequence: each row adds only the turns that its predecessor lacks, with
position ids that continue its ancestors' and the token intervals of the
ancestors to attend to. A shard stands alone: the path to its first
conversation is emitted anew.

The template is ``<|turn|>role<|says|>text<|done|>``. In roles and texts every
``<|`` is written ``<\\|`` (and ``<\\|`` as ``<\\\\|``, and so on), so none of
them can hold a control string, and reading back removes one backslash.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .packing import encoder, token_ids

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>"
_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(id, no, turn, role, text, digest) with plain names; no marks a null conversation id."""
    string = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(
        F.coalesce(F.col(conv).cast("long"), F.lit(0)).alias("id"), F.col(conv).isNull().alias("no"),
        F.col(turn).cast("long").alias("turn"), string(role).alias("role"), string(text).alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def format_conversations(
    conversations: DataFrame,
    vocab_path: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """Rows of the emitted shards, to be read in the order of (shard, seq).

    A turn's row (leaf false) has depth, its tokens ``ids`` (little-endian
    unsigned 32-bit), ``start`` (place in the shard), ``position`` (position id of
    its first token), ``ancestors`` (token intervals [lo, hi) of the shard that
    its tokens attend to, besides those before them in the row), ``parent`` (seq)
    and ``loss_lo``, ``loss_hi`` (tokens of the row under the loss mask). A
    conversation's row (leaf true) has conv_id and the depth at which it ends.

    Turns are ordered by turn number, nulls first, ties by digest; repeated rows
    are turns of their own. Null roles and texts count as empty; the rows with a
    null conversation id form one conversation. An empty table gives no rows.
    """
    import numpy as np
    import pyarrow as pa

    rows = _turns(conversations, conv_col, turn_col, role_col, text_col)
    path = F.transform(F.sort_array(F.collect_list(F.struct("turn", "digest"))), lambda t: t["digest"])
    paths = rows.groupBy("id", "no").agg(path.alias("path"))
    order = paths.repartitionByRange("path", "no", "id").sortWithinPartitions("path", "no", "id")
    order = materialize(order.select("id", "no", F.monotonically_increasing_id().alias("at")))
    placed = rows.join(order, ["id", "no"]).withColumn("shard", F.shiftright("at", 33).cast("int"))
    placed = placed.repartition("shard").sortWithinPartitions("at", "turn", "digest")
    placed = placed.select("shard", "at", F.when(~F.col("no"), F.col("id")).alias("conv_id"), "role", "text", "digest")

    span = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])
    schema = pa.schema([
        ("shard", pa.int32()), ("seq", pa.int64()), ("leaf", pa.bool_()), ("conv_id", pa.int64()), ("depth", pa.int32()),
        ("parent", pa.int64()), ("start", pa.int64()), ("position", pa.int64()), ("ancestors", pa.list_(span)),
        ("loss_lo", pa.int32()), ("loss_hi", pa.int32()), ("ids", pa.binary()),
    ])

    def run(batches):
        enc = encoder(vocab_path)
        code = lambda s: token_ids(enc, s)
        says, done, turn_mark = code(SAYS), code(DONE), code(TURN)
        out: list = []
        shard = at = conv = None
        stack: list = []  # per depth: digest, seq, position after it, intervals up to and with it
        seq = offset = depth = held = 0
        along = True

        def leaf():
            nonlocal seq
            out.append((shard, seq, True, conv, depth, None, None, None, None, None, None, None))
            seq += 1

        for b in batches:
            for s, a, c, role, text, digest in zip(*(col.to_pylist() for col in b.columns)):
                if a != at:
                    if at is not None:
                        leaf()
                    if s != shard:
                        shard, stack, seq, offset = s, [], 0, 0
                    at, conv, depth, along = a, c, 0, True
                if along and depth < len(stack) and stack[depth][0] == digest:
                    depth += 1
                    continue
                along = False
                del stack[depth:]
                body = code(escape(text))
                head = np.concatenate([turn_mark, code(escape(role)), says])
                ids = np.concatenate([head, body, done])
                parent, position, before = stack[-1][1:] if stack else (None, 0, [])
                lo, hi = (len(head), len(head) + len(body)) if role in loss_roles else (0, 0)
                spans = [{"lo": x, "hi": y} for x, y in before]
                out.append((shard, seq, False, None, depth, parent, offset, position, spans, lo, hi, ids.tobytes()))
                end = offset + len(ids)
                own = [*before[:-1], (before[-1][0], end)] if before and before[-1][1] == offset else [*before, (offset, end)]
                stack.append((digest, seq, position + len(ids), own))
                seq, offset, depth, held = seq + 1, end, depth + 1, held + len(ids)
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)
                    out.clear()
                    held = 0
        if at is not None:
            leaf()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)

    return placed.mapInArrow(
        run,
        "shard int, seq long, leaf boolean, conv_id long, depth int, parent long, start long, position long, "
        "ancestors array<struct<lo: long, hi: long>>, loss_lo int, loss_hi int, ids binary",
    )


def read_back(formatted: DataFrame, vocab_path: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the emitted shards alone.

    Tokens are decoded, the template parsed and texts unescaped. Digests grow along the
    tree, so shared turns are read once. A row whose start, position, parent or
    ancestors don't fit the rows before it is an error.
    """
    import hashlib

    import numpy as np
    import pyarrow as pa

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ordered = formatted.repartition("shard").sortWithinPartitions("shard", "seq")

    def run(batches):
        enc = encoder(vocab_path)
        text_of = lambda ids: enc.decode_bytes(ids.tolist()).decode()
        shard, stack, offset = None, [], 0
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["shard"] != shard:
                    shard, stack, offset = r["shard"], [], 0
                if r["leaf"]:
                    _, _, turns, loss, lost, chars, _ = stack[r["depth"] - 1]
                    out.append((r["conv_id"], r["depth"], turns.hexdigest(), lost, loss.hexdigest(), chars))
                    continue
                del stack[r["depth"]:]
                parent, end, turns, loss, lost, chars, spans = stack[-1] if stack else (None, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, [])
                ids = np.frombuffer(r["ids"], "<u4")
                given = [(x["lo"], x["hi"]) for x in r["ancestors"]]
                if (r["parent"], r["start"], r["position"], given) != (parent, offset, end, spans):
                    raise ValueError(f"shard {shard}, row {r['seq']} doesn't follow from the rows before it")
                text = text_of(ids)
                role, says, body = text.removeprefix(TURN).removesuffix(DONE).partition(SAYS)
                if not (text.startswith(TURN) and text.endswith(DONE) and says):
                    raise ValueError(f"shard {shard}, row {r['seq']} isn't a turn of the template")
                turns, loss = turns.copy(), loss.copy()
                turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                under = unescape(text_of(ids[r["loss_lo"] : r["loss_hi"]]))
                loss.update(under.encode())
                nxt = offset + len(ids)
                own = [*spans[:-1], (spans[-1][0], nxt)] if spans and spans[-1][1] == offset else [*spans, (offset, nxt)]
                stack.append((r["seq"], end + len(ids), turns, loss, lost + len(under), chars + len(text), own))
                offset = nxt
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return ordered.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
