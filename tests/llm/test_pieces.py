"""SentencePiece encoding and decoding against the sentencepiece library, which the operator doesn't use."""

import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return pieces.Pieces(MODEL), SentencePieceProcessor(model_file=MODEL)


def agrees(both, text):
    ours, library = both
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert ours.encode(text).tolist() == ids
    assert ours.decode(ids) == library.decode(ids)


def test_query_whole_table(spark, both):
    got = {r.doc_id: r for r in entry.queries()["op11_sentencepiece"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = both[1].encode(d.text or "", add_bos=True, add_eos=True)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(both[1].decode(ids).encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text())
def test_any_text(both, text):
    agrees(both, text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abehinrstEN ▁\n\t\0.,0<>x日本🙂é", max_size=80))
def test_texts_of_common_letters(both, text):
    agrees(both, text)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_texts_glued_from_pieces(both, data):
    names = sorted(both[0].ids)
    agrees(both, "".join(data.draw(st.lists(st.sampled_from(names), max_size=15))))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 259, 260, 28705, 3 + 0xE2, 3 + 0x96, 3 + 0x81]), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_alike(both, ids):
    assert both[0].decode(ids) == both[1].decode(ids)


def test_backtracking_is_needed_and_taken(both):
    """Taking the longest match at each place isn't enough: on some texts the walk has to step back."""
    ours = both[0]
    named = lambda t: [ours.name(i) for i in ours.walk(t)]
    longest = lambda t: max((p for p in ours.names.values() if t.startswith(p)), key=len)
    text = next(t for t in ("▁" + a + b for a in "abcdefgh" for b in ("ther", "ing", "ation", "ouse", "ents")) if named(t)[0] != longest(t))
    assert named(text) == ours.merged(text)


@pytest.mark.parametrize("text", [" " * 300_000, "a" * 100_000, "ab" * 100_000, "\n" * 200_000, "日本" * 50_000, "the cat \n" * 200_000, "🙂" * 30_000])
def test_long_runs(both, text):
    agrees(both, text)


def test_slices_meet_where_no_merge_crosses(both, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 7)
    for text in ("one two  three   four", "▁▁ a▁b ▁ c" * 5, "nospaceatall" * 4, " " * 50 + "x" + " " * 50):
        agrees(both, text)


def test_edge_cases(spark, both):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x"), (4, " ▁ <s></s><unk> "), (5, "word " * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = df.selectExpr("*", "1 AS ids", "2 AS n_tokens", "3 AS decoded", "4 AS `a.b`")
    got = pieces.encode_and_decode(wide, MODEL).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(((d, both[1].encode(t or "", add_bos=True, add_eos=True)) for d, t in rows), key=key)
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.n_tokens) for r in sorted(got, key=key)] == [(d, i, len(i)) for d, i in want]
    assert sorted(r.decoded for r in got) == sorted(both[1].decode(i) for _, i in want)
    assert pieces.encode_and_decode(df.limit(0), MODEL).collect() == []
    bare = pieces.encode_and_decode(df.where("doc_id = 2"), MODEL, ends=False).collect()
    assert [(r.n_tokens, bytes(r.ids), r.decoded) for r in bare] == [(0, b"", "")]


def test_broken_utf8_counts_as_replacement(spark, both):
    df = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    (r,) = pieces.encode_and_decode(df, MODEL).collect()
    assert np.frombuffer(r.ids, "<u4").tolist() == both[1].encode("a�b", add_bos=True, add_eos=True)


def _message(*fields):
    """Bytes of a protocol buffer message from (number, int, float or bytes)."""

    def varint(v):
        out = b""
        while v > 127:
            out, v = out + bytes([v & 127 | 128]), v >> 7
        return out + bytes([v])

    out = b""
    for number, v in fields:
        if isinstance(v, bytes):
            out += varint(number << 3 | 2) + varint(len(v)) + v
        elif isinstance(v, float):
            out += varint(number << 3 | 5) + struct.pack("<f", v)
        else:
            out += varint(number << 3) + varint(v)
    return out


@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("squeeze", [0, 1])
def test_other_rules(tmp_path, prefix, squeeze):
    """A model without byte pieces, with pieces whose letters aren't pieces, unreachable pieces and pieces across spaces."""
    plain = ["ab", "abc", "b▁a", "▁a", "a", "b", "▁", "xy", "xyz", "bcd", "abcde"]
    entries = [_message((1, b"<unk>"), (3, 2)), _message((1, b"<s>"), (3, 3)), _message((1, b"</s>"), (3, 3))]
    entries += [_message((1, p.encode()), (2, -float(i))) for i, p in enumerate(plain)]
    path = str(tmp_path / "m.model")
    with open(path, "wb") as fh:
        fh.write(_message(*((1, e) for e in entries), (2, _message((3, 2), (4, len(entries)))), (3, _message((1, b"identity"), (3, prefix), (4, squeeze)))))
    both = pieces.Pieces(path), SentencePieceProcessor(model_file=path)
    assert not both[0].cuts
    for text in ["", "ab", "abc ab a", "  xyz  xy zz ", "abcde bcd", "b a b a", "q q", "qq", "▁▁ a", " ", "   "]:
        agrees(both, text)
    rng = np.random.default_rng(3)
    for _ in range(500):
        agrees(both, "".join(rng.choice(list("abcdexyz  q"), rng.integers(0, 14))))


def test_refuses_what_it_does_not_read(tmp_path):
    path = tmp_path / "m.model"
    path.write_bytes(_message((1, _message((1, b"<unk>"), (3, 2))), (2, _message((3, 1)))))
    with pytest.raises(ValueError):
        pieces.Pieces(str(path))


def test_frequent_segments_stay_remembered(monkeypatch):
    """Many rare segments don't push out one that keeps coming: it is encoded once."""
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    model = pieces.Pieces(MODEL)
    walked = []
    walk = model.walk
    monkeypatch.setattr(model, "walk", lambda text: walked.append(text) or walk(text))
    words = [w for k in range(200) for w in ("often", f"rare{k}")]
    whole = model.encode(" ".join(words))
    assert walked.count(pieces.SPACE + "often") == 1 and len(model.known) + len(model.older) <= 20
    assert model.decode(whole) == " ".join(words)
