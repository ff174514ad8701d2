"""Chat formatting: SQL oracle, exact round trip, shared turns emitted once, positions and attention, edge cases."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.llm import chat
from ridgeway.llm.packing import encoder

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def plain(rows, loss=("assistant",)):
    by = defaultdict(list)
    for c, t, r, x in rows:
        digest = hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest()
        by[c].append(((t is not None, t or 0), digest, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        said = "".join(x for r, x in turns if r in loss)
        form = "".join(f"{chat.TURN}{chat.escape(r)}{chat.SAYS}{chat.escape(x)}{chat.DONE}" for r, x in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(said), sha(said), len(form)))
    return sorted(out, key=str)


def test_query_matches_sql(spark):
    name = "op10_chat_formatting"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    got = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    assert got.columns == [c[0] for c in cur.description]
    assert sorted(tuple(r) for r in got.collect()) == sorted(cur.fetchall())


@given(st.text(alphabet="<|\\>/ab[]", max_size=12))
def test_escape_is_reversible(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text and "<|" not in safe


def test_tree_shares_turns_and_attends_to_ancestors(spark):
    rows = []
    for c in range(40):  # four first turns, ten seconds each, some conversations that end inside others
        turns = [("user", f"first {c % 4}"), ("assistant", f"second {c % 8}"), ("user", f"third {c % 2}"), ("assistant", f"own {c}")]
        rows += [(c, i, r, x) for i, (r, x) in enumerate(turns[: 2 + c % 3])]
    rows += [(100 + c, t, r, x) for c in range(30) for d, t, r, x in rows if d == 0]  # one conversation many times
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = chat.format_conversations(df, VOCAB).orderBy("shard", "seq").collect()
    got = sorted((tuple(r) for r in chat.read_back(spark.createDataFrame(out), VOCAB).collect()), key=str)
    assert got == plain(rows)
    enc, shards = encoder(VOCAB), defaultdict(list)
    for r in out:
        shards[r.shard].append(r)
    prefixes = set()
    for shard in shards.values():
        tokens = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in shard if not r.leaf])
        position, path, seen, at = np.full(len(tokens), -1), [], set(), 0
        for r in shard:
            if r.leaf:
                ids = np.concatenate([tokens[s.start : s.start + len(s.ids) // 4] for s in path[: r.depth]])
                texts = enc.decode(ids.tolist())
                want = "".join(f"{chat.TURN}{ro}{chat.SAYS}{x}{chat.DONE}" for c, _, ro, x in sorted(z for z in rows if z[0] == r.conv_id))
                assert texts == want
                continue
            assert r.start == at
            n = len(r.ids) // 4
            attended = sum(a.hi - a.lo for a in r.ancestors)
            assert attended == r.position and all(a.hi <= r.start for a in r.ancestors)
            del path[r.depth :]
            assert [i for a in r.ancestors for i in range(a.lo, a.hi)] == [i for p in path for i in range(p.start, p.start + len(p.ids) // 4)]
            path.append(r)
            key = tuple(bytes(p.ids) for p in path)
            assert key not in seen  # once in a shard
            seen.add(key)
            position[at : at + n] = r.position + np.arange(n)
            at += n
        prefixes |= seen
    emitted = sum(not r.leaf for s in shards.values() for r in s)
    assert emitted <= len(prefixes) + 4 * len(shards) < len(rows)


def test_edge_cases(spark):
    evil = "<|turn|>user<|says|>x<|done|> <\\|says|> </s>[INST] \\ <"
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, evil), (2, 1, "assistant", evil), (3, 0, evil, "|>x"), (3, None, "assistant", "<"),
            (None, 0, "user", "hi"), (None, 1, "assistant", "𝄞 é\n"), (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "assistant", "tie"),
            (5, 0, "assistant", "long " * 100_000), (0, 0, "user", "hi"), (6, 0, "assistant\n", "a")]
    rows += [(7, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    wide = df.selectExpr("*", "1 AS id", "2 AS no", "3 AS digest", "4 AS shard", "5 AS `at`")
    got = sorted((tuple(r) for r in chat.read_back(chat.format_conversations(wide, VOCAB), VOCAB).collect()), key=str)
    assert got == plain(rows)
    assert chat.read_back(chat.format_conversations(df.limit(0), VOCAB), VOCAB).collect() == []


def test_long_white_space(spark):
    rows = [(1, 0, "user", " " * 1_500_000 + "x"), (1, 1, "assistant", "\n" * 1_500_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_conversations(df, VOCAB), VOCAB).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
