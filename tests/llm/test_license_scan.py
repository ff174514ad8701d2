"""Licence scan: SQL oracle, variants of known texts, notices, and edge cases."""

from pathlib import Path

import duckdb

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.llm import license_scan as ls
from pyspark.sql import functions as F


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = entry.queries()["op1_license_scan"](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()["op1_license_scan"])
    assert got.columns == [c[0] for c in cur.description]
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == sorted(cur.fetchall(), key=str)
    assert any(r[3] for r in rows)


def test_variants_of_licences_are_found(spark):
    mit, bsd = ls.LICENSES["MIT"], ls.LICENSES["BSD-2-Clause"]
    wrapped = "\n".join("# " + w for w in mit.split(". "))
    rows = [
        (1, mit), (2, mit.upper().replace("LICENSE", "LICENCE")), (3, "Copyright (c) 2020 Some One\n\n" + mit.replace(",", " ,")),
        (4, mit.replace("MIT License\n", "MIT License\n(c) 1999 A, B\n© 2003 C\nCopyright 2001-2004 D. All rights reserved.\n")),
        (5, mit + " and more"), (6, wrapped), (7, bsd.replace("COPYRIGHT HOLDER", "copyright owner")), (8, mit[:-30]),
        (9, bsd.replace("the distribution.", "the distribution.\r\n\tAll Rights Reserved")),
    ]
    got = {r.doc_id: r.license_id for r in ls.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT", 5: None, 6: "MIT", 7: "BSD-2-Clause", 8: None, 9: "BSD-2-Clause"}


def test_notices_and_edge_cases(spark):
    rows = [
        (1, "text\nReleased under the MIT Licence.\nmore\n  This work is licensed under: CC-BY 4.0"), (2, "not released under the MIT License"),
        (3, None), (4, ""), (5, "!!! \n ---"), (6, "licence licence licence"), (6, "license  LICENSE\nlicence"), (7, "Licensed under MIT"),
        (7, "Licensed under MIT"), (None, "Licensed under MIT"), (8, "word, " * 200_000 + "\nLicensed under ISC\n"), (9, "Ünï 漢字 x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = df.selectExpr("*", "1 AS id", "2 AS digest", "3 AS license_id", "4 AS line", "5 AS notices")
    got = ls.scan(wide).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].notices for k in (1, 2, 3, 4, 7, None, 8)] == ["CC-BY-4.0,MIT", "", "", "", "MIT", "MIT", "ISC"]
    assert by[3].canonical_sha256 == by[4].canonical_sha256 == by[5].canonical_sha256 and not any(r.license_id for r in got)
    assert len({r.canonical_sha256 for r in got if r.doc_id == 6}) == 1
    assert ls.scan(df.limit(0)).collect() == []
    own = ls.scan(df, known=[("x", "UENI ünï, 漢字: X"), ("y", "Ünï 漢字 x!"), ("z", "")], known_notices=[]).where(F.col("license_id").isNotNull())
    assert [(r.doc_id, r.license_id) for r in own.collect()] == [(9, "y")]


def test_whole_licences_headings_and_holders(spark):
    body = ls.LICENSES["MIT"].split("\n", 1)[1].strip()
    texts = {f.name.removesuffix(".txt"): f.read_text() for f in (Path(ls.__file__).parent / "licenses").glob("*.txt")}
    rows = [(k.removesuffix(".spdx").removesuffix(".web").removesuffix(".regents"), t) for k, t in texts.items()]
    want = {"Apache-2.0", "BSD-3-Clause", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC0-1.0", "CC-BY-SA-4.0"}
    assert {k for k, _ in rows} == want
    rows += [(k, " ".join(t.split()).replace("Copyright (C)", "\nCopyright (C)")) for k, t in rows if k == "MPL-2.0"]
    rows += [("GPL-3.0", texts["GPL-3.0"].split("END OF TERMS")[0]), ("Apache-2.0", texts["Apache-2.0"].split("APPENDIX")[0])]
    bsd = ls.LICENSES["BSD-2-Clause"].split("\n", 1)[1].replace("1. R", "* R").replace("2. R", "* R")
    third = "* Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived\n"
    third += "from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED"
    rows += [("BSD-2-Clause", bsd), ("BSD-3-Clause", "Copyright 2020 X\n" + bsd.replace("THIS SOFTWARE IS PROVIDED", third))]
    for head in ("", "The MIT License (MIT)\n", "Copyright Jane Doe\n", "Copyright, 2020\n", "COPYRIGHT: 2020 J\n", "Copyright by the Foo Authors\n", "© Jane Doe\n"):
        rows.append(("MIT", head + body))
    rows.append((None, "Copyright Holders and others\n" + body))
    for head in ("Copyright Dyke van Buren B.V. and its contributors <a@b.org>\n", "Copyright The Foo Authors, foo@bar.org https://foo.org\r\n"):
        rows.append(("MIT", head + body))
    for head in ("Copyright Reform is debated today\n", "Copyright Tribunal hears a case\n", "Copyright " + "Big " * 30 + "\n",
                 "Copyright " + "A" * 100_000 + " b" * 50_000 + "\n"):
        rows.append((None, head + body))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    assert [r.license_id for r in ls.scan(df).orderBy("doc_id").collect()] == [k for k, _ in rows]
    header = 'x\n * Licensed under the Apache License, Version 2.0 (the "License");\n * you may not use this file except\n'
    one = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    df = spark.createDataFrame([(1, header), (2, one), (3, "own text")], "doc_id long, text string")
    assert [r.notices for r in ls.scan(df).orderBy("doc_id").collect()] == ["Apache-2.0", "Apache-2.0", ""]
    table = spark.createDataFrame([("own", "Own text!", 1)], "license_id string, text string, more long")
    assert [r.license_id for r in ls.scan(df, known=table).orderBy("doc_id").collect()] == [None, None, "own"]
