from __future__ import annotations

import random

import duckdb

from gritmill.llm.licence_texts import BSD_CONDITIONS, BSD_WARRANTY, LONG, MIT_BODY, ZLIB_BODY
from gritmill.llm.licences import LICENCES_SQL, licences
from llm_cases import DOCS, clashing, docs, odd_rows
from oracle import differences


def test_variants_are_found_and_others_not(spark):
    rows = [
        (1, MIT_BODY),
        (2, "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + MIT_BODY.upper().replace(",", " ;")),
        (3, "  MIT Licence\n\n© 1999 Nobody\n" + MIT_BODY.replace("\n", "\r\n// ")),
        (4, MIT_BODY.replace("sublicense", "sub-license").replace("NONINFRINGEMENT", "NON-INFRINGEMENT")),
        (5, ZLIB_BODY.replace("acknowledgment", "acknowledgement")),
        (6, f"Copyright 2001 by X\n{BSD_CONDITIONS}{BSD_WARRANTY}"),
        (7, MIT_BODY + " And more."),
        (8, "Intro. " + MIT_BODY),
        (9, MIT_BODY.replace("without restriction", "with restriction")),
        (10, MIT_BODY),
    ]
    found = {r["doc_id"]: r["licence"] for r in licences(docs(spark, rows)).collect()}
    assert found == {1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT", 5: "Zlib", 6: "BSD-2-Clause", 7: None, 8: None, 9: None, 10: "MIT"}


def test_copyright_lines_of_all_forms(spark):
    bsd = f"{BSD_CONDITIONS}{BSD_WARRANTY}"
    heads = [
        "Copyright (c) Microsoft Corporation.", "Copyright (c) Facebook, Inc. and its affiliates.", "Copyright © Some One", "(c) 2010 A",
        "(c) Some One, 2010-2012", "(c) A. All rights reserved.", "Copyright (c) 2010 A\nAll rights reserved.\nCopyright (c) 2012 B\nAll rights reserved.",
        "All rights reserved.\r\nAll rights reserved\n\nAll Rights Reserved.",
    ]
    rows = [(i, f"{h}\n\n{body}") for i, (h, body) in enumerate((h, body) for h in heads for body in (MIT_BODY, bsd))]
    found = {r["doc_id"]: r["licence"] for r in licences(docs(spark, rows)).collect()}
    assert found == {i: ("MIT", "BSD-2-Clause")[i % 2] for i in range(len(rows))}


def test_long_licences_and_their_clauses(spark):
    full = {p.stem: p.read_text() for p in LONG.glob("*.txt")}
    assert set(full) == {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"}
    names = sorted(full)
    rewrapped = [" ".join(full["Apache-2.0"].split("END OF TERMS")[0].split()), "\n".join(full["MPL-2.0"].split())]
    changed = [full["Apache-2.0"].replace("(c) You must retain", "(c) You must remove"), full["MPL-2.0"].replace("(c) under Patent", "(c) over Patent")]
    rows = list(enumerate([full[n] for n in names] + rewrapped + changed))
    found = {r["doc_id"]: r["licence"] for r in licences(docs(spark, rows)).collect()}
    assert [found[i] for i in range(len(rows))] == [*names, "Apache-2.0", "MPL-2.0", None, None]


def test_odd_rows(spark):
    rows = odd_rows(random.Random(1))
    found = licences(clashing(docs(spark, rows))).collect()
    assert len(found) == len(rows) and all(r["licence"] is None for r in found)
    digests = {r["doc_id"]: r["digest"] for r in found}
    assert digests[1] is None and digests[2] == digests[3] == digests[10] and digests[8] == digests[9]
    assert licences(spark.createDataFrame([], DOCS)).count() == 0


def test_the_sql_twin_knows_all_that_the_query_knows(spark, tmp_path):
    """Copyright lines of all forms, one after the other too, long licences and odd rows: the same digests and licences on both sides."""
    rng = random.Random(4)
    heads = [
        "Copyright (c) Microsoft Corporation.", "Copyright © Some One", "(c) 2010 A", "(c) Some One, 2010-2012", "(c) A. All rights reserved.", "  # Copyright: the authors",
        "All rights reserved.", "/* all rights reserved", "** All Rights Reserved. \t\r", "(c) a clause", "all rights reserved by nobody", "", " ", "© 1999", "text © in a line",
    ]
    bodies = [MIT_BODY, BSD_CONDITIONS + BSD_WARRANTY, ZLIB_BODY, "some words", ""]
    full = [p.read_text() for p in sorted(LONG.glob("*.txt"))]
    rows = [(1000 + i, "\n".join(rng.choices(heads, k=rng.randrange(6))) + rng.choice(["\n", "\n\n", " "]) + rng.choice(bodies) + rng.choice(["", "\n" + rng.choice(heads)])) for i in range(400)]
    rows += list(enumerate(full)) + [(100 + i, "Copyright (c) 2001 X\nAll rights reserved.\n" + t.upper()) for i, t in enumerate(full)] + odd_rows(rng)
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = licences(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert differences(found, con, LICENCES_SQL) == []
    known = {r["licence"] for r in found.collect()}
    assert {"MIT", "BSD-2-Clause", "Zlib", "Apache-2.0", "GPL-3.0", None} <= known
