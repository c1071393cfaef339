"""URL rules by a bit-parallel wildcard automaton: all patterns advance together over a URL, one bit a state.

Globs know ``?`` (any one sign), ``*`` (any signs but a slash) and ``**`` (any signs). Every pattern has one bit for each of its
places, and all bits are packed into 64-bit words. A sign shifts the states by one under the mask of places that take it; a state
before a star also stays, under the mask of signs that the star takes (Shift-And with self-loops).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import with_fields
from gritmill.llm.words import text_bytes

#: (verdict, host and path). A rule fits its host and all hosts below it, and all paths that start like its path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: (verdict, glob over host and path) for what no rule fits; the glob with most literal signs wins, then block, and allow where none fits.
GLOBS = (
    ("block", "*spam*/**"), ("block", "*cheap-*/**"), ("block", "*pills*/**"), ("block", "*casino*/**"), ("block", "*porn*/**"),
    ("block", "**/wp-login.php"), ("block", "**/login"), ("block", "**.exe"), ("block", "**.zip"), ("allow", "docs.*/**"),
)

_ROWS = 4096


def rule_globs(rule: str) -> tuple[str, str]:
    """A rule as globs: its host itself, and hosts below it."""
    return f"{rule}**", f"*.{rule}**"


def _parsed(glob: str) -> tuple[list[str], dict[int, str]]:
    """Signs of a glob, and the stars by the number of signs before them."""
    signs, stars, i = [], {}, 0
    while i < len(glob):
        if glob[i] == "*":
            wide = glob[i : i + 2] == "**"
            stars[len(signs)] = "**" if wide or stars.get(len(signs)) == "**" else "*"
            i += 2 if wide else 1
        else:
            signs.append(glob[i])
            i += 1
    return signs, stars


@dataclass
class Automaton:
    """Masks of all patterns: ``take`` and ``stay`` by kind of sign, the states at the start, and each pattern's last state."""

    alphabet: np.ndarray  # bytes that some pattern names, each a kind of its own
    take: np.ndarray  # word, kind
    stay: np.ndarray  # word, kind
    start: np.ndarray  # word
    last: list[tuple[int, int]]  # word and bit of each pattern's last state

    @classmethod
    def of(cls, globs: list[str]) -> Automaton:
        parsed = [_parsed(g) for g in globs]
        # Signs are bytes: a pattern's sign beyond ASCII becomes several. ``?`` takes the first byte of a sign and stays over those that continue it.
        places = [[b for s in signs for b in ([-1] if s == "?" else list(s.encode()))] for signs, _ in parsed]
        named = sorted({b for p in places for b in p if b >= 0} | {0x2F, *range(0x80, 0xC0)})
        kind = {b: i + 1 for i, b in enumerate(named)}
        follows = np.array([False, *(0x80 <= b < 0xC0 for b in named)])
        states = sum(len(p) + 1 for p in places)
        words = -(-states // 64)
        take, stay = (np.zeros((words, len(named) + 1), np.uint64) for _ in range(2))
        start, last, bit = np.zeros(words, np.uint64), [], 0
        for (signs, stars), place in zip(parsed, places):
            bytes_before = np.cumsum([0, *(1 if s == "?" else len(s.encode()) for s in signs)])
            start[bit // 64] |= np.uint64(1 << bit % 64)
            for i, b in enumerate(place, bit + 1):
                take[i // 64, ~follows if b < 0 else kind[b]] |= np.uint64(1 << i % 64)
                if b < 0:
                    stay[i // 64, follows] |= np.uint64(1 << i % 64)
            for after, star in stars.items():
                i = bit + int(bytes_before[after])
                mask = np.uint64(1 << i % 64)
                stay[i // 64] |= mask
                if star == "*":
                    stay[i // 64, kind[0x2F]] &= ~mask
            bit += len(place)
            last.append((bit // 64, bit % 64))
            bit += 1
        return cls(np.array(named, np.uint8), take, stay, start, last)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which patterns match each whole text ``data[offsets[i]:offsets[i + 1]]``."""
        kinds = np.zeros(256, np.int64)
        kinds[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        n = np.diff(offsets)
        order = np.argsort(-n, kind="stable")
        states = np.repeat(self.start[:, None], len(n), axis=1)
        longest_first, begin = n[order], offsets[:-1][order]
        for t in range(int(n.max()) if len(n) else 0):
            live = int(np.searchsorted(-longest_first, -t, "left"))  # texts longer than t
            sign = kinds[data[begin[:live] + t]]
            carry = np.zeros(live, np.uint64)
            for w in range(len(states)):
                now, before = states[w, :live].copy(), carry
                carry = now >> np.uint64(63)
                states[w, :live] = (((now << np.uint64(1)) | before) & self.take[w][sign]) | (now & self.stay[w][sign])
        out = np.empty((len(n), len(self.last)), bool)
        for p, (w, b) in enumerate(self.last):
            out[order, p] = (states[w] >> np.uint64(b)) & np.uint64(1) == 1
        return out


def _judged(rules, globs):
    def literal(glob: str) -> int:
        return sum(c not in "*?" for c in glob)

    rules = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    globs = sorted(globs, key=lambda g: (-literal(g[1]), g[0] != "block", g[1]))
    automaton = Automaton.of([g for _, rule in rules for g in rule_globs(rule)] + [g for _, g in globs])
    rule_names = np.array([r for _, r in rules] + [None], object)
    verdicts = np.array([v for v, _ in rules] + [v for v, _ in globs] + ["allow"], object)

    def judge(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                data, offsets = text_bytes(part.column("place"))
                hit = automaton.matches(data, offsets)
                of_rule = hit[:, : 2 * len(rules)].reshape(len(hit), len(rules), 2).any(axis=2)
                every = np.concatenate((of_rule, hit[:, 2 * len(rules) :], np.ones((len(hit), 1), bool)), axis=1)
                first = every.argmax(axis=1)  # the longest rule, else the most literal glob, else allow
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(rule_names[np.minimum(first, len(rules))], pa.string()), pa.array(verdicts[first], pa.string())], ["row", "rule", "verdict"]
                )

    return judge


def judged(pages: DataFrame, keep: list[str], url_col: str = "url", rules=RULES, globs=GLOBS) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``host``, ``path``, ``rule`` (null: none fits) and ``verdict``.

    The host is what follows the first ``://`` up to a slash, question mark, hash or the end, A-Z in lower case; the path what
    follows up to a question mark, hash or the end. Both are empty without ``://`` and for null; such a URL is judged as an
    empty text, which is allowed unless a pattern takes it. Repeated rows are judged each by itself.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    host = F.translate(rest[0], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), host.alias("host"), rest[1].alias("path"))
    rows = rows.select(F.struct("row", "host", "path").alias("row"), F.concat("host", "path").alias("place"))
    return rows.mapInArrow(_judged(rules, globs), with_fields(rows.select("row"), "rule string, verdict string")).select("row.row", "row.host", "row.path", "rule", "verdict")
