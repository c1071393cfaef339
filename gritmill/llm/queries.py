"""The dealt operators over the given tables, each next to its SQL where SQL can express it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.llm import graded as quality
from gritmill.llm import languages, packing
from gritmill.llm.backoff import backoff_scores
from gritmill.llm.leaks import contamination
from gritmill.llm.licences import LICENCES_SQL, licences
from gritmill.llm.mixing import mixed_copies
from gritmill.llm.near_copies import near_copies
from gritmill.llm.neighbours import nearest
from gritmill.llm.personal_data import personal_data
from gritmill.llm.sharded_lloyd import clustered
from gritmill.llm.shared import table
from gritmill.llm.url_rules import GLOBS, RULES, judged
from gritmill.llm.vector_codes import vector_codes
from gritmill.operators.joining import with_group_total

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return keep


def remainder(k: int):
    """crc32 of the id as text, modulo ``k``; a null id counts as empty text, so its remainder is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % k


@query("op1_languages")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = languages.train(docs.filter((remainder(4) != 2) & F.col("lang").isNotNull()))
    found = languages.identified(docs.withColumn("held_out", remainder(4) == 2), model, ["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def _url_sql() -> str:
    """Rules and globs as conditions; the patterns are fixed values without quotes."""

    def like(glob: str) -> str:
        return "^" + "".join({"**": ".*", "*": "[^/]*", "?": "."}.get(s, re.escape(s)) for s in re.findall(r"\*\*|.", glob)) + "$"

    rules, globs = sorted(RULES, key=lambda r: -len(r[1])), sorted(GLOBS, key=lambda g: (-sum(c not in "*?" for c in g[1]), g[0] != "block", g[1]))
    fits = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}')", rule, verdict))
    named = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)
    judged = " ".join([f"WHEN {c} THEN '{v}'" for c, _, v in fits] + [f"WHEN regexp_matches(host || path, '(?s){like(g)}') THEN '{v}'" for v, g in globs])
    return f"""
    WITH cut AS (
        SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
    )
    SELECT page_id, host, path, CASE {named} END AS rule, CASE {judged} ELSE 'allow' END AS verdict FROM cut"""


@query("op2_url_rules", _url_sql())
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return judged(table(spark, sf, "pages"), ["page_id"]).select("row.page_id", "host", "path", "rule", "verdict")


@query("op3_licences", LICENCES_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return licences(table(spark, sf, "documents"))


@query("op4_backoff_scores")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return backoff_scores(table(spark, sf, "documents"), remainder(7) != 2)


@query("op5_mixing")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    mix = mixed_copies(table(spark, sf, "documents"), ["doc_id"])
    return mix.select("row.doc_id", "size", "source_size", "target", "taken")


@query("op6_personal_data")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data(table(spark, sf, "documents"))


@query("op7_graded")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    ratings = table(spark, sf, "labels").select("doc_id", quality.rating_grade().alias("grade"))
    found = quality.graded(docs, quality.train(docs, ratings), ["doc_id"])
    return found.select("row.doc_id", "expected_grade", "tail", "selected")


@query("op8_neighbours")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query(
    "op9_near_copies",
    """
    WITH RECURSIVE docs AS (
        SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w
        FROM documents
    ),
    places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0),
    runs AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS run FROM places),
    sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY 1),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)
    ),
    reached AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other),
    least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM least LEFT JOIN sizes USING (doc_id)
    """,
)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return near_copies(table(spark, sf, "documents"))


# Words as lists; A-Z alone goes to lower case.
WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op10_leaks",
    f"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
    cut AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
    wins AS (SELECT DISTINCT item, least(len(w), 10) AS n, list_aggregate(w[i:i + 9], 'string_agg', ' ') AS win FROM cut),
    sizes AS (SELECT DISTINCT n FROM wins),
    docs AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
    runs AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
    found AS (
        SELECT doc_id, i, r.n, item FROM (SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win FROM runs) r
        JOIN wins USING (win) WHERE r.n = wins.n
    ),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
    named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# Plain rounds of Lloyd over a long table of numbers: x (rid, part, place, cell), c0 (part, entry, place, cell).
def _rounds_sql(rounds: int) -> str:
    out = []
    for r in range(rounds + 1):
        out.append(f"""
    d{r} AS (SELECT rid, part, entry, CAST(sum((x.cell - c.cell) * (x.cell - c.cell)) AS BIGINT) AS d FROM x JOIN c{r} c USING (part, place) GROUP BY ALL),
    a{r} AS (SELECT rid, part, entry, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid, part ORDER BY d, entry) = 1)""")
        if r < rounds:
            out.append(f"""
    s{r} AS (SELECT part, entry, place, sum(cell) AS s, count(*) AS n FROM x JOIN a{r} USING (rid, part) GROUP BY ALL),
    c{r + 1} AS (SELECT part, entry, place, CAST(coalesce((s - ((s % n) + n) % n) // n, cell) AS BIGINT) AS cell FROM c{r} LEFT JOIN s{r} USING (part, entry, place))""")
    return ",".join(out)


def _numbers_sql(scale: int, start: str, parts: int, fine: str) -> str:
    return f"""
    kept AS (
        SELECT *, row_number() OVER (ORDER BY {start} NULLS LAST, embedding) AS rid FROM embeddings
        WHERE embedding IS NOT NULL AND {fine} AND NOT exists(SELECT 1 FROM (SELECT unnest(embedding) AS e) WHERE e IS NULL OR NOT isfinite(e))
    ),
    cells AS (SELECT rid, unnest(range(len(embedding))) AS i, unnest(embedding) AS e, len(embedding) // {parts} AS w FROM kept),
    x AS (SELECT rid, CAST(i // w AS INTEGER) AS part, CAST(i % w AS INTEGER) AS place, CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT) AS cell FROM cells),
    c0 AS (SELECT part, rid - 1 AS entry, place, cell FROM x WHERE rid <= 16)"""


@query(
    "op11_sharded_lloyd",
    f"""
    WITH {_numbers_sql(64, "sha256('1:' || vec_id)", 1, "len(embedding) = 64")}, {_rounds_sql(3)},
    named AS (SELECT entry, sha256(string_agg(CAST(cell AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM c3 GROUP BY 1)
    SELECT vec_id, CAST(entry AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY entry) AS BIGINT) AS cluster_inertia,
        CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM kept JOIN a3 USING (rid) JOIN named USING (entry)
    """,
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    found, centroids = clustered(table(spark, sf, "embeddings"), ["vec_id"], order)
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    model = spark.createDataFrame(
        [(i, sums.get(i, 0), sum(sums.values()), d) for i, d in enumerate(digests)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # A row for each centroid.
    out = found.select("row.vec_id", "cluster", "distance").join(F.broadcast(model), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query(
    "op12_vector_codes",
    f"""
    WITH {_numbers_sql(4096, "vec_id", 8, "len(embedding) > 0")}, {_rounds_sql(6)},
    coded AS (
        SELECT rid, lower(string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part)) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY 1
    ),
    books AS (SELECT sha256(string_agg(CAST(cell AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM c6)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (rid), books
    """,
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    found, books = vector_codes(table(spark, sf, "embeddings"), ["vec_id", "label"], F.col("vec_id"))
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    coded = found.select("row.vec_id", "row.label", "code", "error")
    out = with_group_total(coded, ["label"], "error", "label_error")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


@query("op13_packed")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    ranks = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    cut = packing.pieces(table(spark, sf, "documents"), ["doc_id"], public_tokenizers.path("byte_bpe_50k.json"), 2, ranks=ranks)
    lean = cut.select("row", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "spot")
    found = packing.packed(packing.written(lean, "pieces"))
    return found.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
