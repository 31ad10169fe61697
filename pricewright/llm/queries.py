"""The registered queries of this package: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..queries.registry import Query
from .brown_lm import score_documents
from .common import documents, importable_in_workers
from .decontamination import WINDOW, contamination_digests
from .hard_negatives import mined_digests
from .language_id import held_out_identification
from .mixing import CLOSE, OFFERED, PASSES, SEED, mixture_digests
from .neighbours import nearest
from .secret_scan import secret_digests
from .sentencepiece_codec import encoding_digests
from .sharding import shard_digests
from .simhash import fingerprint_digests
from .token_counts import count_tokens
from .toxicity import toxicity
from .vector_codes import code_digests

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            importable_in_workers(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents),
i AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(words[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, words, least({WINDOW}, len(words)) AS n FROM i WHERE len(words) > 0) AS x, unnest(range(1, len(words) - n + 2)) AS u(p)
),
places AS (
  SELECT doc_id, n, p, array_to_string(words[p:p + n - 1], ' ') AS win
  FROM d, (SELECT DISTINCT n FROM wanted) AS sizes, unnest(range(1, len(words) - n + 2)) AS u(p)
),
hits AS (SELECT doc_id, item_id, n, p FROM places JOIN wanted USING (n, win)),
marked AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + n)) AS u(q) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination_digests(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query()
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digests(documents(spark, folder))


@query()
def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_digests(documents(spark, folder))


@query()
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_digests(documents(spark, folder))


@query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return held_out_identification(documents(spark, folder))


@query()
def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


@query()
def op8_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(documents(spark, folder))


def _mixed_sql() -> str:
    """One membership a document, so a pattern is a source and its flow is its target; passes are written out one by one."""
    passes = []
    for turn in range(PASSES):
        before, found, free = f"ranked{turn - 1}", f"ranked{turn}", "rest > 0 AND size > 0 AND copies = layers AND size <= gap AND gap * {0} > flow".format(CLOSE)
        if turn:
            passes.append(f"""open{turn} AS MATERIALIZED (SELECT r.*, gap, {free} AS free FROM {before} AS r JOIN gaps{turn - 1} USING (nr)),
{found} AS MATERIALIZED (
  SELECT doc_id, nr, size, draw, layers, rest, flow,
    copies + CASE WHEN free AND sum(CASE WHEN free THEN size ELSE 0 END) OVER (PARTITION BY nr ORDER BY draw, size ROWS UNBOUNDED PRECEDING) <= gap THEN 1 ELSE 0 END AS copies
  FROM open{turn}
)""")
        passes.append(f"gaps{turn} AS MATERIALIZED (SELECT nr, CAST(max(rest) - coalesce(sum(size) FILTER (copies > layers), 0) AS BIGINT) AS gap FROM {found} GROUP BY nr)")
    last = PASSES - 1
    return rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('{SEED}:' || doc_id), 1, 15) AS BIGINT) AS draw
  FROM documents
),
s AS MATERIALIZED (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nr,
    CAST([3, 1, 2][(nr - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * sum(size)::DOUBLE AS cap
  FROM d GROUP BY source
),
steps AS (
  SELECT coalesce(sum(cap) OVER (ORDER BY cap / weight, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(weight) OVER (ORDER BY cap / weight, nr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS light
  FROM s
),
wanted AS (
  SELECT nr, source, source_size, least(cap, weight * (SELECT max(((SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE FROM s) - filled) / light) FROM steps)) AS target
  FROM s
),
target AS MATERIALIZED (
  SELECT *, coalesce(flow // nullif(source_size, 0), 0) AS layers, coalesce(flow % nullif(source_size, 0), 0) AS rest
  FROM (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS flow FROM wanted)
),
ranked0 AS MATERIALIZED (
  SELECT doc_id, nr, size, draw, layers, rest, flow,
    layers + CASE WHEN rest > 0 AND sum(size) OVER (PARTITION BY nr ORDER BY draw, size ROWS UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS copies
  FROM d JOIN target ON d.source IS NOT DISTINCT FROM target.source
),
{", ".join(passes)},
banded AS (SELECT *, CAST(floor(log2(size)) AS INT) AS band FROM ranked{last} WHERE size > 0),
free AS MATERIALIZED (
  SELECT nr, doc_id, size, draw, row_number() OVER (PARTITION BY nr ORDER BY band DESC, size, draw) AS turn
  FROM (SELECT * FROM banded WHERE rest > 0 AND copies = layers QUALIFY row_number() OVER (PARTITION BY nr, band ORDER BY size, draw) <= {OFFERED})
),
held AS MATERIALIZED (
  SELECT nr, doc_id, size, row_number() OVER (PARTITION BY nr ORDER BY band DESC, size, draw) AS turn
  FROM (SELECT * FROM banded WHERE copies > 0 QUALIFY row_number() OVER (PARTITION BY nr, band ORDER BY size, draw) <= {OFFERED})
),
filling AS (
  SELECT nr, 0 AS turn, gap, CAST([] AS BIGINT[]) AS picks FROM gaps{last}
  UNION ALL
  SELECT a.nr, a.turn + 1, CASE WHEN f.size <= a.gap THEN a.gap - f.size ELSE a.gap END, CASE WHEN f.size <= a.gap THEN list_append(a.picks, f.doc_id) ELSE a.picks END
  FROM filling AS a JOIN free AS f ON f.nr = a.nr AND f.turn = a.turn + 1
),
filled AS MATERIALIZED (SELECT nr, gap, picks FROM filling QUALIFY row_number() OVER (PARTITION BY nr ORDER BY turn DESC) = 1),
dropping AS (
  SELECT a.nr, 0 AS turn, a.gap, f.doc_id AS more, f.size, f.draw, f.size - a.gap AS over, CAST([] AS BIGINT[]) AS drops
  FROM filled AS a JOIN free AS f ON f.nr = a.nr AND NOT list_contains(a.picks, f.doc_id) WHERE a.gap > 0
  UNION ALL
  SELECT a.nr, a.turn + 1, a.gap, a.more, a.size, a.draw, CASE WHEN h.size <= a.over THEN a.over - h.size ELSE a.over END,
    CASE WHEN h.size <= a.over THEN list_append(a.drops, h.doc_id) ELSE a.drops END
  FROM dropping AS a JOIN held AS h ON h.nr = a.nr AND h.turn = a.turn + 1
),
settled AS (
  SELECT f.nr, f.picks, d.more, d.drops
  FROM filled AS f LEFT JOIN (
    SELECT * FROM (SELECT * FROM dropping QUALIFY row_number() OVER (PARTITION BY nr, more ORDER BY turn DESC) = 1) WHERE over < gap
    QUALIFY row_number() OVER (PARTITION BY nr ORDER BY over, size, draw) = 1
  ) AS d USING (nr)
)
SELECT doc_id, size, source_size, target, source,
  CAST(size * (copies + list_contains(picks, doc_id)::INT + coalesce(doc_id = more, FALSE)::INT - list_contains(coalesce(drops, []), doc_id)::INT) AS BIGINT) AS taken
FROM ranked{last} JOIN target USING (nr) JOIN settled USING (nr)
"""


@query(_mixed_sql())
def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixture_digests(documents(spark, folder))


_KEPT = """kept AS MATERIALIZED (
  SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)"""


def _codes_sql(rounds: int = 2) -> str:
    """Each round is a pair of tables: the parts with their nearest entry, and the entries moved to the means."""
    dims = range(1, 5)
    square = " + ".join(f"(p.x{i} - b.x{i}) * (p.x{i} - b.x{i})" for i in dims)
    parts = ", ".join(f"v[(j * 4 + {i})::INT] AS x{i}" for i in dims)
    steps = [_KEPT, f"p AS MATERIALIZED (SELECT vec_id, label, j, {parts} FROM kept, range(16) AS u(j))"]
    steps.append(
        f"b0 AS MATERIALIZED (SELECT e, j, {parts} FROM (SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64), range(16) AS u(j))"
    )
    for turn in range(rounds + 1):
        steps.append(
            f"a{turn} AS MATERIALIZED (SELECT p.vec_id, p.label, p.j, min(({square}) * 64 + b.e) AS best, "
            + ", ".join(f"any_value(p.x{i}) AS x{i}" for i in dims)
            + f" FROM p JOIN b{turn} AS b USING (j) GROUP BY p.vec_id, p.label, p.j)"
        )
        if turn < rounds:
            mean = ", ".join(f"coalesce((m.s{i} - ((m.s{i} % m.n) + m.n) % m.n) // m.n, b.x{i}) AS x{i}" for i in dims)
            sums = ", ".join(f"sum(x{i}) AS s{i}" for i in dims)
            steps.append(
                f"b{turn + 1} AS MATERIALIZED (SELECT b.e, b.j, {mean} FROM b{turn} AS b LEFT JOIN "
                f"(SELECT j, best % 64 AS e, count(*) AS n, {sums} FROM a{turn} GROUP BY ALL) AS m USING (j, e))"
            )
    numbers = " || ',' || ".join(f"CAST(x{i} AS BIGINT)" for i in dims)
    return (
        "WITH " + ",\n".join(steps) + f""",
coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', CAST(best % 64 AS INT)), '' ORDER BY j) AS code, CAST(sum(best // 64) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg({numbers}, ',' ORDER BY j, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded"""
    )


@query(_codes_sql())
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return code_digests(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query(f"""
WITH {_KEPT},
r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(v AS DOUBLE[]) AS v
  FROM kept WHERE vec_id IS NOT NULL AND label IS NOT NULL
),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a, r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""")
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return mined_digests(spark.read.parquet(f"{folder}/embeddings.parquet"))
