"""Registered queries of the operators, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import langid, pii, simhash, toxicity
from tradeloom.llm.centroids import cluster
from tradeloom.llm.chat import format_conversations, read_back
from tradeloom.llm.codes import compress
from tradeloom.llm.decontam import contamination
from tradeloom.llm.minhash import near_duplicates
from tradeloom.llm.neighbours import nearest
from tradeloom.llm.packing import pack_documents
from tradeloom.llm.runtime import table
from tradeloom.llm.token_counts import count_tokens
from tradeloom.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


@query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    probe = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(table(spark, sf_dir, "conversations").select(*columns).unionByName(added)))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(written, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def held_out() -> Column:
    """The fold that no model learns from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")
    lexicon = toxicity.learn(toxicity.labelled_sample(docs, labels))
    return toxicity.score(docs, lexicon).select("doc_id", held_out().alias("held_out"), "score", "predicted", "matched")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    languages = langid.learn(docs.where(~held_out()).select("text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), languages).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.detect(docs, pii.learn(docs))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


@query
def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


SQL["op5_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS winner FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> winner THEN winner END AS refers_to
FROM w
"""

_PROBE = r"\### Assistant: </turn> ok"
# A turn holds three markers of 13 characters, 4 before the role and a colon after it, and 8 after the text.
SQL["op4_chat_formatting"] = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{_PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{_PROBE}'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
       CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(52 + length(replace(replace(replace(replace(r, '\\', '\\\\'), '<|', '<\\|'), '</', '<\\/'), ':', '\\:'))
           + length(replace(replace(replace(x, '\\', '\\\\'), '<|', '<\\|'), '</', '<\\/'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op7_decontamination"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wanted AS (
    SELECT DISTINCT item, size, array_to_string(w[k : k + size - 1], ' ') AS win
    FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM (SELECT item, w, least(len(w), 10) AS size FROM b WHERE len(w) > 0))
),
found AS (
    SELECT doc_id, k, size, item
    FROM (
        SELECT doc_id, k, size, array_to_string(w[k : k + size - 1], ' ') AS win
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM wanted) WHERE len(w) >= size)
    ) JOIN wanted USING (size, win)
),
hits AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM (SELECT DISTINCT doc_id, k, size FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op10_minhash_near_dedup"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[k : k + 3], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM pairs JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y
    WHERE 100 * c >= 80 * (p.n + q.n - c)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""


def _usable(more: str = "") -> str:
    """A vector that is there and holds finite components alone, as DuckDB has it."""
    return f"embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0{more}"


#: floor(s / n) of integers, n above 0.
_FLOOR_MEAN = "CAST((s - ((s % n) + n) % n) // n AS DOUBLE)"


def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds one after another; a vector's nearest centroid is the least of distance * k + number."""
    parts = [
        f"""v AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS y
    FROM embeddings WHERE {_usable(" AND len(embedding) = 64")}
)""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), vec_id, y) - 1 AS g, y AS c FROM v
    WHERE vec_id IS NOT NULL QUALIFY g < {k}
)""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
    SELECT row, min(CAST(list_dot_product(y, y) - 2 * list_dot_product(y, c) + list_dot_product(c, c) AS BIGINT) * {k} + g) AS m
    FROM v, c{r} GROUP BY row
)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
    SELECT g, coalesce(mean, c) AS c FROM c{r} LEFT JOIN (
        SELECT g, list({_FLOOR_MEAN} ORDER BY place) AS mean
        FROM (
            SELECT m % {k} AS g, place, sum(CAST(y[place] AS BIGINT)) AS s, count(*) AS n
            FROM a{r} JOIN v USING (row), range(1, 65) AS p(place) GROUP BY 1, 2
        ) GROUP BY g
    ) USING (g)
)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(g AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY g) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string([CAST(x AS BIGINT) for x in c], ',')) AS centroid_sha256
FROM (SELECT vec_id, m % {k} AS g, m // {k} AS distance FROM a{rounds} JOIN v USING (row)) JOIN c{rounds} USING (g)
"""


SQL["op11_centroid_clustering"] = _clustering_sql()


def _codes_sql(entries: int = 256, rounds: int = 4, parts: int = 4) -> str:
    """The rounds one after another; a part's nearest entry is the least of distance * entries + index."""
    chain = [
        f"""v AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS y
    FROM embeddings WHERE {_usable()}
)""",
        f"""p AS MATERIALIZED (
    SELECT row, part, y[part * (len(y) // {parts}) + 1 : (part + 1) * (len(y) // {parts})] AS y FROM v, range({parts}) AS t(part)
)""",
        f"""b0 AS MATERIALIZED (
    SELECT part, e, p.y AS c FROM (SELECT row, row_number() OVER (ORDER BY vec_id, y) - 1 AS e FROM v WHERE vec_id IS NOT NULL QUALIFY e < {entries}) JOIN p USING (row)
)""",
    ]
    for r in range(rounds + 1):
        chain.append(
            f"""a{r} AS MATERIALIZED (
    SELECT row, part, min(CAST(list_dot_product(y, y) - 2 * list_dot_product(y, c) + list_dot_product(c, c) AS BIGINT) * {entries} + e) AS m
    FROM p JOIN b{r} USING (part) GROUP BY row, part
)"""
        )
        if r < rounds:
            chain.append(
                f"""b{r + 1} AS MATERIALIZED (
    SELECT part, e, coalesce(mean, c) AS c FROM b{r} LEFT JOIN (
        SELECT part, e, list({_FLOOR_MEAN} ORDER BY place) AS mean
        FROM (
            SELECT part, m % {entries} AS e, place, sum(CAST(y[place] AS BIGINT)) AS s, count(*) AS n
            FROM (SELECT part, m, y, unnest(range(1, len(y) + 1)) AS place FROM a{r} JOIN p USING (row, part)) GROUP BY 1, 2, 3
        ) GROUP BY 1, 2
    ) USING (part, e)
)"""
            )
    return f"""WITH {", ".join(chain)},
coded AS (
    SELECT row, string_agg(printf('%02x', m % {entries}), '' ORDER BY part) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY row
),
books AS (SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) for x in c], ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (row), books
"""


SQL["op12_vector_codes"] = _codes_sql()
