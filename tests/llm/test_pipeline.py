"""Each pipeline stage against brute force on what the stage before it kept."""

import re

import pytest

import corpus_pipeline as cp
from conftest import SF_SMALL
from test_decontaminate import plain as plain_leaks
from test_packing import check_places
from test_simhash import plain_components, plain_fingerprint
from test_substring_dedup import plain as plain_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_stages_match_brute_force(spark):
    assert [n for n, _ in cp.STAGES] == [
        "language_id", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = []
    for name, stage in cp.STAGES:
        docs = cp.stored(stage(spark, docs, SF_SMALL), name)
        got.append(docs)
    given = rows_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    told = rows_of(got[0])
    assert set(told) <= set(given) and len(told) == len(given)  # every document here has a clear language
    comp = plain_components([(r[0], plain_fingerprint(r[1])) for r in told])
    single = [r for r, c in zip(told, comp) if r[0] == c]
    assert rows_of(got[1]) == single and len(single) < len(told)
    cut = plain_repeats([(r[0], r[1]) for r in single], 50)
    after = rows_of(got[2])
    assert [(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))) for r in after] == [(d, n - g) for d, n, g, _ in cut]
    assert [" ".join(r[1].split()) for r in after] == [" ".join(k.split()) for _, _, _, k in cut]
    assert all(r[1] == s[1] for r, s, c in zip(after, single, cut) if not c[2]) and all(len(r[1]) == r[4] for r in after)
    assert any(c[2] for c in cut)
    leaks = {d for d, _ in plain_leaks([(r[0], r[1]) for r in after], items)}
    clean = [r for r in after if r[0] not in leaks]
    assert leaks and rows_of(got[3]) == clean
    packed = got[4].toPandas()
    assert set(packed.doc_id) == {r[0] for r in clean}
    check_places(zip(packed.sequence_id, packed.offset, packed.length), 2048)


@pytest.mark.parametrize("extra", [False, True])
def test_edge_cases(spark, extra):
    text = " ".join(f"the word {i} and other {i * 7 % 11}" for i in range(40))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, "en", "b", 1), (3, None, "en", None, None), (4, "", None, "c", 0),
            (None, "some other words in a row here", "en", "d", 3), (5, "123", "en", "e", 3), (6, text + " " + "x y z " * 30, "en", "f", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        docs = docs.selectExpr("*", "1 AS version", "2 AS kept", "'r' AS row", "3 AS id", "4 AS score", "5 AS __doc")
    for name, stage in cp.STAGES[:4]:
        columns = docs.columns
        docs = cp.stored(stage(spark, docs, SF_SMALL), name)
        assert docs.columns == columns
        if name == "simhash_near_dedup":
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 6]
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == {None, 1, 6} and got[1].text == text and got[6].text.split() == ["x", "y", "z"] * 30
    assert {r.doc_id for r in cp.pack(spark, docs, SF_SMALL).collect()} == {None, 1, 6}
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF_SMALL).collect() == []
