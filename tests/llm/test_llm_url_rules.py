from __future__ import annotations

import random
import re

import numpy as np

from gritmill.llm.url_rules import Automaton, judged
from llm_cases import same


def as_pattern(glob):
    return "".join({"**": ".*", "*": "[^/]*", "?": "."}.get(s, re.escape(s)) for s in re.findall(r"\*\*|.", glob, re.S))


def test_automaton_agrees_with_patterns():
    rng = random.Random(1)
    globs = ["", "*", "**", "?", "a*b", "a**b", "*.org/**", "/?x*", "é*", "a?c/**", "??", "*?é?*", "?é"] + ["".join(rng.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(rng.randrange(1, 25))) for _ in range(60)]
    texts = ["", "a", "b/a", "é", "éa", "x.org/", ".org/", "aéc/x", "a\U0001f600c/", "\U0001f600é", "éé", "aéé/é", "ac/x"] + ["".join(rng.choice("ab/é€\U0001f600") for _ in range(rng.randrange(12))) for _ in range(200)] + ["".join(rng.choice("ab/") for _ in range(rng.randrange(30))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found = Automaton.of(globs).matches(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for p, glob in enumerate(globs):
        pattern = re.compile(as_pattern(glob), re.S)
        for i, t in enumerate(texts):
            assert found[i, p] == bool(pattern.fullmatch(t)), (glob, t)


def test_rules(spark):
    urls = [
        ("http://a.org/x?q#f", "a.org", "/x", "org/", "allow"),
        ("x://EXAMPLE.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://b.example.org/en/19", "b.example.org", "/en/19", "example.org/en/1", "block"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("http://x.com/De/", "x.com", "/De/", None, "allow"),
        ("http://com/fr/", "com", "/fr/", "com/fr/", "allow"),
        ("http://x.net/com/de/", "x.net", "/com/de/", None, "allow"),
        ("http://x.net/y.com/de/", "x.net", "/y.com/de/", None, "allow"),
        ("http://a.org", "a.org", "", None, "allow"),
        ("http://a.org?/x", "a.org", "", None, "allow"),
        ("http://spam-farm.net/x", "spam-farm.net", "/x", None, "block"),
        ("http://spam-farm.org/x", "spam-farm.org", "/x", "org/", "allow"),
        ("a://b://c.org/", "b:", "//c.org/", None, "allow"),
        ("no scheme/x", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("://", "", "", None, "allow"),
        ("http://é.org/\U0001f600\n/x", "é.org", "/\U0001f600\n/x", "org/", "allow"),
        ("http://l.org/" + "a/" * 9000, "l.org", "/" + "a/" * 9000, "org/", "allow"),
    ]
    urls += urls[:2]
    pages = spark.createDataFrame([(i, u[0], 1, 2) for i, u in enumerate(urls)], "page_id long, url string, host int, rule int")
    found = judged(pages, ["page_id", "host"]).collect()
    same([(r["row"]["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found], [(i, *u[1:]) for i, u in enumerate(urls)])
    assert judged(pages.limit(0), ["page_id"]).count() == 0
