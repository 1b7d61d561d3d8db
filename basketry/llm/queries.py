"""Queries of this folder, one per operator, and the pipeline: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, hard_negatives, langid, merkle, mixing, packing, quality, quality_rules, secret_scan, sharding, simhash, toxicity, vector_codes
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op2_simhash_neardup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, substr(md5('4:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
lines AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::DOUBLE AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
steps AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
levels AS (SELECT max(level) AS level FROM steps WHERE cap > level * w),
goal AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth, source_size >= 16 AS big,
         CASE WHEN l.level IS NULL OR cap <= l.level * w THEN cap ELSE l.level * w END AS target
  FROM steps CROSS JOIN levels l),
total AS (SELECT count(*) AS m, floor(sum(target::DECIMAL(38,6))::DOUBLE / 16 + 0.5)::BIGINT AS seats FROM goal WHERE big),
-- every seat by itself, highest quotient first
seat AS (
  SELECT nth, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, nth, k) - 1 AS seat
  FROM (SELECT nth, target, unnest(range(1, (target / 16)::BIGINT + m + 3)) AS k FROM goal, total WHERE big)),
upto AS (
  SELECT g.nth, j, CASE WHEN big THEN (SELECT count(*) FROM seat s WHERE s.nth = g.nth AND s.seat < j * seats // 8) WHEN j = 8 THEN 1 ELSE 0 END AS a
  FROM goal g, total, range(9) r(j)),
words AS (
  SELECT g.*, least(CASE WHEN big THEN 16 * u.a ELSE floor(target + 0.5)::BIGINT END, 3 * source_size) AS words, greatest(u.a, 1) AS seats
  FROM goal g JOIN upto u ON g.nth = u.nth AND u.j = 8),
plan AS (
  SELECT *, coalesce(words // nullif(source_size, 0), 0) AS rounds, words - coalesce(words // nullif(source_size, 0), 0) * source_size AS rest FROM words),
stretch AS (
  SELECT p.nth, source, rest, a0.j, (rest * a0.a) // seats AS r0, (rest * (CASE WHEN a0.j = 7 THEN seats ELSE a1.a END)) // seats AS r1, source_size
  FROM plan p JOIN upto a0 ON p.nth = a0.nth AND a0.j < 8 JOIN upto a1 ON p.nth = a1.nth AND a1.j = a0.j + 1 WHERE rest > 0),
cut AS (
  SELECT *, source_size * r0 // rest AS e0, source_size * r1 // rest - source_size * r0 // rest AS len, r1 - r0 AS take FROM stretch),
started AS (
  SELECT *, 16 * (('0x' || substr(md5('4:' || coalesce(source, '') || ':' || j), 1, 12))::BIGINT % greatest(ceil(len / 16.0)::BIGINT, 1)) AS u FROM cut),
runs AS (
  SELECT nth, e0 + u AS lo, e0 + least(u + take, len) AS hi FROM started UNION ALL SELECT nth, e0, e0 + greatest(u + take - len, 0) FROM started)
SELECT doc_id, size, source_size, target,
       (rounds * size + coalesce((SELECT sum(greatest(0, least(start + size, hi) - greatest(start, lo))) FROM runs r WHERE r.nth = plan.nth), 0))::BIGINT AS taken
FROM lines JOIN plan ON lines.source IS NOT DISTINCT FROM plan.source
"""


@register("op4_mixing", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


# The CRC table follows from the polynomial 0xEDB88320 (3988292384).
OP3_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, _: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, source, coalesce(octet_length(encode(text)), 0) + 16 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
                         lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc),
keyed AS (
  SELECT *, substr(md5('3:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_crc32), 1, 15) AS k FROM d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id, size, text_crc32) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + 0.5::DOUBLE) / n, source NULLS LAST, r) - 1 AS pos, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (pos * 40 // total)::INT AS shard,
       (pos - (pos * 40 // total * total + 39) // 40)::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
"""


@register("op3_sharding", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@register("op8_merkle_fingerprint")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


@register("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op7_quality_crf")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op1_hnsw_neighbours")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


@register("op11_quality_rules")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def _nearest(books: str) -> str:
    """Each part's nearest entry of ``books``; a distance and an entry are one number, so ties go to the lower entry."""
    return f"""
  SELECT rid, p.part, p.x, min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * 64 + b.entry) AS best
  FROM p JOIN {books} b ON p.part = b.part GROUP BY rid, p.part, p.x"""


def _means(assigned: str, books: str) -> str:
    """Floored means of the parts of each entry; unused entries stay."""
    floored = ", ".join(f"sum(x[{i}])::BIGINT AS s{i}" for i in range(1, 5))
    mean = ", ".join(f"(s{i} - ((s{i} % n) + n) % n) // n" for i in range(1, 5))
    return f"""
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
  FROM {books} b LEFT JOIN (SELECT part, entry, [{mean}] AS x
                            FROM (SELECT part, (best % 64)::INT AS entry, count(*) AS n, {floored} FROM {assigned} GROUP BY ALL)) m
  ON b.part = m.part AND b.entry = m.entry"""


OP12_SQL = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, part, v[4 * part + 1:4 * part + 4] AS x FROM k, range(16) r(part)),
b0 AS (SELECT part, (rid - 1)::INT AS entry, x FROM p WHERE rid <= 64),
a1 AS ({_nearest('b0')}),
b1 AS ({_means('a1', 'b0')}),
a2 AS ({_nearest('b1')}),
b2 AS ({_means('a2', 'b1')}),
a3 AS ({_nearest('b2')}),
coded AS (
  SELECT rid, string_agg(printf('%02x', (best % 64)::INT), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a3 GROUP BY rid),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN coded USING (rid) CROSS JOIN digest
"""


@register("op12_vector_codes", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH k AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM k a JOIN k b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@register("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(v.select("vec_id", "embedding", moved.alias("label")))
