"""Personal data by weak supervision: labelers vote on candidate spans, and a classifier trained on their joint opinion decides.

Candidates are the spans of strict patterns (``BASE``, which always stay) and of loose ones (``LOOSE``). Pattern, checksum, gazetteer,
context, shape and edge labelers vote yes, no or nothing on each. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is for each kind and how likely each pattern is real; a logistic regression on features of the spans
then learns those probabilities and decides about the loose ones. All of it is column expressions; what reaches the driver are counts
of vote patterns, at most 3^6 for each kind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import written

KINDS = ("email", "ip", "card", "phone")

# The starts of a run are tried once: a pattern that fails at its first sign fails at all others, and \\G lets one begin where a match ended.
_NAME = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+])(?:(?:\+|00)[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
#: The strict patterns without what only matters between other signs, as SQL text.
ALONE = {k: p.removeprefix(rf"(?:\G|(?<!{_NAME}))").removeprefix(r"(?:\G|(?<![0-9]))").replace("\\", "\\\\") for k, p in BASE.items()}
#: Texts without these signs hold no match, strict or loose.
NEEDS = {"email": r"@|[\[(]at[\])]", "ip": r"[0-9]|:[0-9A-Fa-f]+:", "card": "[0-9]", "phone": "[0-9]"}

VALID = {
    "email": "true",
    "ip": "forall(split(v, '[.]'), p -> length(trim(leading '0' from p)) <= 3 and coalesce(try_cast(trim(leading '0' from p) as int), 0) <= 255)",
    "card": "length(regexp_replace(v, '[ -]', '')) between 16 and 19 and luhn_check(regexp_replace(v, '[ -]', ''))",
    "phone": "length(regexp_replace(v, '[^0-9]', '')) between 8 and 15",
}

ENDINGS = "com|org|net|edu|gov|info|biz|io|co|eu|de|fr|es|it|uk|us|ca|nl|ch|at|be|pt|br|mx|jp|cn|in|au|ru|pl|se|no|fi|dk"
MAILERS = "mail|gmail|email|inbox|post|yahoo|outlook|hotmail|proton|web|icloud|example"
CALLING = "1|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]"
NEAR = {
    "email": "mail|contact|write|reach|schreib|kontakt|contacto|correo|courriel|adresse",
    "ip": "ip|host|server|address|adresse|login|client|peer|from",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|ruf|appel|llama|handy|movil",
}
AGAINST = "version|release|isbn|issn|order|invoice|ticket|page|section|chapter|price|figure|table|doi|build"

DIGITS = "regexp_replace(x.v, '[^0-9]', '')"
LABELERS = {
    "pattern": "if(x.base or CASE x.kind "
    + " ".join(f"WHEN {i} THEN x.v rlike '^{ALONE[k]}$' and {VALID[k].replace('(v,', '(x.v,')}" for i, k in enumerate(KINDS))
    + " END, 1, -1)",
    "checksum": f"""CASE x.kind WHEN 0 THEN if(lower(x.v) rlike '({ENDINGS})$', 1, -1)
        WHEN 1 THEN if(x.v rlike ':' or x.v rlike '^(0|[1-9][0-9]*)([.](0|[1-9][0-9]*)){{3}}$', 1, -1)
        WHEN 2 THEN if(luhn_check({DIGITS}), 1, -1)
        ELSE CASE WHEN length({DIGITS}) between 10 and 13 THEN 1 WHEN length({DIGITS}) between 8 and 15 THEN 0 ELSE -1 END END""",
    "gazetteer": f"""CASE x.kind WHEN 0 THEN if(lower(x.v) rlike '({MAILERS})', 1, 0)
        WHEN 1 THEN if(x.v rlike ':', 0, if(x.v rlike '^(0|22[4-9]|2[3-9][0-9])[.]', -1, 1))
        WHEN 2 THEN if({DIGITS} rlike '^[3456]', 1, 0)
        ELSE if({DIGITS} rlike '^(00)?({CALLING})', 1, 0) END""",
    "context": "CASE "
    + " ".join(f"WHEN x.kind = {i} AND x.before rlike '(?i)\\\\b({NEAR[k]})' THEN 1" for i, k in enumerate(KINDS))
    + f" WHEN x.before rlike '(?i)\\\\b({AGAINST})' THEN -1 ELSE 0 END",
    "shape": f"""CASE x.kind WHEN 0 THEN if(x.v rlike '^[^@]*[A-Za-z]', 1, -1) WHEN 1 THEN if(x.v rlike '[.:]', 1, 0)
        WHEN 2 THEN if(x.v rlike '^([0-9]+|([0-9]{{4}}[ -]){{3}}[0-9]{{4,7}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}})$', 1, -1)
        ELSE if(x.v rlike '[() .-]', 1, 0) END""",
    "edge": "if(x.before rlike '[A-Za-z0-9_]$' or x.after rlike '^[A-Za-z0-9_]', -1, 0)",
}
FEATURES = [
    "x.votes[1] > 0", "x.votes[2] > 0", "x.votes[3] > 0", "x.votes[3] < 0", "x.votes[4] > 0", "x.votes[5] < 0",
    f"length({DIGITS}) >= 10", "x.v rlike '[() -]'",
]
ITERATIONS = 40
LINE = 1_024


#: Elements that a list grows by at once: lists are built in pieces of this size, so that no step copies all that is there.
PIECE = 256
SPAN = "struct<s:int,e:int,v:string,before:string,after:string>"
BEFORE = 24  # signs of context before a span
_HALVES = ", ".join(str(1 << i) for i in reversed(range(24)))


def _pieces(items: str) -> str:
    return f"transform(sequence(0, greatest(size({items}) - 1, 0) div {PIECE}), c -> slice({items}, c * {PIECE} + 1, {PIECE}))"


def _scanned(items: str, start: dict[str, str], step: dict[str, str], kind: str, element: str) -> str:
    """A list with an ``element`` for each ``x`` of ``items``, made from the running values ``b``; they begin at ``start`` and go on by ``step``."""
    zero = ", ".join(f"'{k}', {v}" for k, v in start.items())
    on = ", ".join(f"'{k}', {v}" for k, v in step.items())
    inner = ", ".join(f"'{k}', a.{k}" for k in start)
    done = ", ".join(f"'{k}', r.{k}" for k in start)
    return f"""aggregate({_pieces(items)}, named_struct({zero}, 'out', cast(array() as array<array<{kind}>>)),
        (a, piece) -> transform(array(aggregate(piece, named_struct({inner}, 'out', cast(array() as array<{kind}>)),
            (b, x) -> named_struct({on}, 'out', concat(b.out, array({element}))))), r -> named_struct({done}, 'out', concat(a.out, array(r.out))))[0],
        a -> flatten(a.out))"""


def _matches(regex: str) -> str:
    """Matches of a pattern with the text between them and the sign that follows, from what was cut."""
    m, p = f"`{regex}_m`", f"`{regex}_p`"
    after = f"substring(coalesce(nullif(get({p}, i + 1), ''), get({m}, i + 1), ''), 1, 1)"
    return f"transform({m}, (v, i) -> named_struct('p', get({p}, i), 'v', v, 'next', {after}))"


def _spans(items: str) -> str:
    """All matches of a pattern as (start, end, text, signs before, sign after) in code points, in one walk over the text."""
    start = "b.at + length(x.p)"
    before = f"right(concat(b.tail, right(x.p, {BEFORE})), {BEFORE})"
    return _scanned(
        items,
        {"at": "0", "tail": "''"},
        {"at": f"{start} + length(x.v)", "tail": f"right(concat({before}, right(x.v, {BEFORE})), {BEFORE})"},
        SPAN,
        f"named_struct('s', {start}, 'e', {start} + length(x.v), 'v', x.v, 'before', {before}, 'after', x.next)",
    )


def _free(found: str, starts: str, ends: str) -> str:
    """Spans that overlap none of those whose sorted starts, and whose largest ends up to each start, are given; the place is found by halving."""
    upto = f"aggregate(array({_HALVES}), 0, (at, half) -> if(at + half <= size({starts}) and get({starts}, at + half - 1) < x.e, at + half, at))"
    return f"filter({found}, x -> coalesce(get({ends}, {upto} - 1) <= x.s, true))"


def candidates(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the columns ``keep``) and ``spans``: kind, s, e, v, base, votes and features of every candidate.

    Kinds count from 0 in the order of ``KINDS``; loose candidates that overlap a strict one, or an earlier loose one, are left out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text.alias("text"))
    df = df.withColumns({f"has_{k}": F.col("text").rlike(NEEDS[k]) for k in KINDS})
    cut = {}
    for level, patterns in (("base", BASE), ("loose", LOOSE)):
        for k in KINDS:
            none = F.array().cast("array<string>")
            cut[f"{level}_{k}_m"] = F.when(F.col(f"has_{k}"), F.regexp_extract_all("text", F.lit(patterns[k]), F.lit(0))).otherwise(none)
            cut[f"{level}_{k}_p"] = F.when(F.col(f"has_{k}"), F.split("text", patterns[k], -1)).otherwise(none)
    df = df.withColumns(cut)
    df = df.withColumns({f"{level}_{k}": F.expr(_matches(f"{level}_{k}")) for level in ("base", "loose") for k in KINDS})
    df = df.withColumns({f"{level}_{k}": F.expr(_spans(f"{level}_{k}")) for level in ("base", "loose") for k in KINDS})

    def made(i: int, base: bool, spans: str) -> str:
        return f"transform({spans}, x -> named_struct('kind', {i}, 's', x.s, 'e', x.e, 'v', x.v, 'base', {str(base).lower()}, 'before', x.before, 'after', x.after))"

    strict = {k: made(i, True, f"filter(base_{k}, x -> {VALID[k].replace('(v,', '(x.v,')})") for i, k in enumerate(KINDS)}
    df = df.withColumn("taken", F.expr(f"concat({', '.join(strict.values())})"))
    for i, k in enumerate(KINDS):
        df = df.withColumn("sorted", F.expr("array_sort(transform(taken, t -> struct(t.s, t.e)))"))
        largest = _scanned("sorted", {"most": "-1"}, {"most": "greatest(b.most, x.e)"}, "int", "greatest(b.most, x.e)")
        df = df.withColumns({"starts": F.expr("transform(sorted, t -> t.s)"), "ends": F.expr(largest)})
        df = df.withColumn("taken", F.expr(f"concat(taken, {made(i, False, _free(f'loose_{k}', 'starts', 'ends'))})"))
    votes = ", ".join(f"cast({v} as tinyint)" for v in LABELERS.values())
    bits = ", ".join(f"cast({f} as int)" for f in FEATURES)
    df = df.withColumn("spans", F.expr(f"transform(taken, x -> struct(x.kind, x.s, x.e, x.v, x.base, array({votes}) as votes))"))
    df = df.withColumn("spans", F.expr(f"transform(spans, x -> struct(x.kind, x.s, x.e, x.base, x.votes, array({bits}) as features))"))
    return df.select("row", "text", "spans")


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Probability that a span with each vote pattern is real, by expectation-maximisation over pattern counts.

    Labelers are taken to vote independently given the truth, and to abstain whatever the truth is. The start is the share of yes among the votes cast.
    """
    real = {v: (1 + sum(x > 0 for x in v)) / (2 + sum(x != 0 for x in v)) for v, _ in patterns}
    for _ in range(ITERATIONS):
        total = [sum(n * (real[v] if c else 1 - real[v]) for v, n in patterns) for c in (0, 1)]
        prior = [(t + 1) / (sum(total) + 2) for t in total]
        chance: list[list[dict[int, float]]] = []
        for c in (0, 1):
            by_labeler = [dict.fromkeys((-1, 0, 1), 0.5) for _ in LABELERS]
            for v, n in patterns:
                for j, x in enumerate(v):
                    by_labeler[j][x] += n * (real[v] if c else 1 - real[v])
            chance.append([{x: y / (d[-1] + d[1]) for x, y in d.items() if x} for d in by_labeler])
        for v, _ in patterns:
            like = [math.log(prior[c]) + sum(math.log(chance[c][j][x]) for j, x in enumerate(v) if x) for c in (0, 1)]
            real[v] = min(1 - 1e-6, max(1e-6, 1 / (1 + math.exp(min(700, like[0] - like[1])))))
    return real


@dataclass
class SpanModel:
    """Weight of each (kind, feature), and of each kind alone."""

    weights: list[float]

    def chance(self) -> str:
        """Probability of span ``x``."""
        size = len(FEATURES) + 1
        parts = []
        for i in range(len(KINDS)):
            own = self.weights[i * size : (i + 1) * size]
            terms = " + ".join(f"({w!r}D) * x.features[{j}]" for j, w in enumerate(own[1:]))
            parts.append(f"WHEN {i} THEN ({own[0]!r}D) + {terms}")
        return f"1 / (1 + exp(-(CASE x.kind {' '.join(parts)} END)))"


def train(found: DataFrame) -> SpanModel:
    """Fit on all candidates; ``found`` comes from :func:`candidates` and should be written. Without any, loose spans are refused."""
    size = len(FEATURES) + 1
    seen = found.select(F.explode("spans").alias("x")).groupBy("x.kind", "x.votes", "x.features").count()
    seen = written(seen, "votes")  # at most kinds x vote patterns x feature patterns rows
    counts = seen.groupBy("kind", "votes").agg(F.sum("count").alias("n")).orderBy("kind", "votes").collect()
    if not counts:
        return SpanModel([-1.0, *[0.0] * (size - 1)] * len(KINDS))
    soft = []
    for i in range(len(KINDS)):
        patterns = [(tuple(r["votes"]), r["n"]) for r in counts if r["kind"] == i]
        soft += [f"({i}, cast(array({', '.join(map(str, v))}) as array<tinyint>), {p!r}D)" for v, p in reliabilities(patterns).items()]
    real = found.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(soft)} AS t(kind, votes, real)")
    each = ", ".join(f"if(kind = {i}, 1D, 0D), {', '.join(f'if(kind = {i}, cast(features[{j}] as double), 0D)' for j in range(size - 1))}" for i in range(len(KINDS)))
    rows = seen.join(F.broadcast(real), ["kind", "votes"]).select(
        array_to_vector(F.expr(f"array({each})")).alias("features"), F.explode(F.expr("array(struct(1D as label, count * real as weight), struct(0D as label, count * (1 - real) as weight))")).alias("y")
    )
    rows = rows.select("features", "y.label", "y.weight")
    fitted = LogisticRegression(weightCol="weight", fitIntercept=False, standardization=False, regParam=1e-4, maxIter=60).fit(rows)
    return SpanModel([float(w) for w in fitted.coefficients.toArray()])


def decided(found: DataFrame, model: SpanModel) -> DataFrame:
    """The same with ``spans`` cut down to those that stay, in order of kind and place: all strict ones, loose ones with probability over one half."""
    stay = f"filter(spans, x -> x.base or {model.chance()} > 0.5)"
    return found.withColumn("spans", F.array_sort(F.expr(f"transform({stay}, x -> struct(x.kind, x.s, x.e, x.base))")))


def _listed(spans: str) -> str:
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat_ws(':', array({kinds})[x.kind], x.s, x.e)), ',')"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id``, counts of strict spans, the SHA-256 of their list, and the list of all spans.

    Null texts count as empty: no spans. Repeated rows are judged each by itself, and weigh in the training as often as they come.
    """
    found = written(candidates(docs, [id_col], text_col).drop("text"), "candidates")
    out = decided(found, train(found))
    strict = "filter(spans, x -> x.base)"
    counts = [F.expr(f"cast(size(filter(spans, x -> x.base and x.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select(F.col(f"row.`{id_col}`").alias("doc_id"), *counts, F.sha2(F.expr(_listed(strict)), 256).alias("base_sha256"), F.expr(_listed("spans")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; texts without a span stay as they are, also null ones.

    Overlapping spans are replaced together, under the kind of the one that starts first.
    """
    found = candidates(docs, docs.columns, text_col)
    model = train(written(found.select("spans"), "candidates"))
    out = decided(found, model).withColumn("ordered", F.expr("array_sort(transform(spans, x -> struct(x.s, x.e, x.kind)))"))
    # What lies between the spans, as (from, to, kind of the span that follows); a span inside an earlier one makes none.
    gap = "if(x.s >= b.at, named_struct('a', b.at, 'e', x.s, 'kind', x.kind), cast(null as struct<a:int,e:int,kind:int>))"
    gaps = _scanned("ordered", {"at": "0"}, {"at": "greatest(b.at, x.e)"}, "struct<a:int,e:int,kind:int>", gap)
    out = out.withColumns({"gaps": F.expr(f"filter({gaps}, g -> g is not null)"), "end": F.expr("array_max(transform(spans, x -> x.e))")})
    # The text in lines of fixed length, so that a part is taken without a walk from the start.
    out = out.withColumn("lines", F.when(F.size("spans") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{LINE}}}"), F.lit(0))).otherwise(F.array().cast("array<string>")))
    kinds = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    parts = f"transform(gaps, g -> concat({_between('g.a', 'g.e')}, array({kinds})[g.kind]))"
    rest = _between("end", f"size(lines) * {LINE}")
    text = F.when(F.size("spans") > 0, F.expr(f"concat(array_join({parts}, ''), {rest})")).otherwise(F.col(f"row.`{text_col}`"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _between(a: str, e: str) -> str:
    """The signs from ``a`` up to ``e`` out of the lines that hold them."""
    first, last = f"({a}) div {LINE}", f"(({e}) - 1) div {LINE}"
    held = f"array_join(slice(lines, {first} + 1, {last} - {first} + 1), '')"
    return f"if(({e}) > ({a}), substring({held}, ({a}) % {LINE} + 1, ({e}) - ({a})), '')"
