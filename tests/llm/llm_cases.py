"""Small tables and plain versions that the operators are held against."""

from __future__ import annotations

import random
import re
import zlib


WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau ypsilon phi chi psi omega".split()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def remainder(key, k: int) -> int:
    return zlib.crc32(str(key).encode()) % k


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(NAMES) + rng.choice(["", "", ".", "\n", ","]) + str(rng.randrange(40)) for _ in range(n))


def docs(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows(rng: random.Random):
    """Null and empty texts, null ids, a long text, repeated rows, copies, and signs of all kinds."""
    long = prose(rng, 6000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "Solo"), (5, long), (6, long + " tail"), (7, "İstanbul ß ｆｕｌｌ \U0001f600 x"), (8, "a b c d"),
        (9, "A B C D"), (9, "A B C D"), (None, "a b c d e f g"), (10, "." * 50), (11, "x" * 5000), (12, "\x00 nul \x7f del"),
    ]


def clashing(df):
    """The same table with more columns, named like what operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(i) for i, c in enumerate(["row", "size", "hits", "items", "rep", "id", "trainer", "selected", "a b", "copy", "Before", "_before", "a.b"])})


def same(found, wanted):
    assert sorted(map(repr, found)) == sorted(map(repr, wanted))
