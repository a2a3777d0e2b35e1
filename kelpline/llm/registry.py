"""The queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from kelpline.llm import decontaminate, jaccard_join, language, lattice, licenses, mixing, pii, quality, suffix_dedup, token_counts


_ROOT = Path(__file__).resolve().parents[2]
_SHIPPED: set[str] = set()
#: For the registered query and pipeline where the session sets no key; not for data that need one.
PUBLIC_KEY = "public key of the registered query"


def ship(spark: SparkSession) -> None:
    """Send the package to the workers where they would not find it by PYTHONPATH or the current folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or str(_ROOT) in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")):
        return
    archive = Path(tempfile.mkdtemp()) / "kelpline.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((_ROOT / "kelpline").rglob("*.py")):
            z.write(f, f.relative_to(_ROOT))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document: sources weigh 1, 2, 3 in turn, none above three times its size."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside ten words in a row of a benchmark item, and the items."""
    return decontaminate.contamination_report(decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between vectors of one label at a cosine of 0.98 or more."""
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, by a classifier fitted on those not held out."""
    return language.predict_languages(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document in strings of 200 bytes that also start elsewhere."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of each document, by a model of the labels not held out."""
    return quality.predict_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in each document, with the share of their shingles found."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between documents whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return jaccard_join.jaccard_links(table(spark, sf_dir, "documents"))


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under the session's key, or one that is public: without a secret key the query's pseudonyms can be undone by anybody."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, key=spark.conf.get(pii.KEY_SETTING, PUBLIC_KEY), count_col="n_replaced")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document as a byte-level tokenizer of 50,000 tokens counts them."""
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_mixing, op2_decontaminate, op3_lattice, op4_language, op5_suffix_dedup, op6_quality, op7_licenses, op8_jaccard_join, op9_pseudonyms, op10_token_counts]
    return {f.__name__: f for f in found}


MIXING_SQL = r"""
WITH slim AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM slim GROUP BY source
), named AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM sizes
), weighed AS (
  SELECT *, CAST((rk - 1) % 3 + 1 AS DOUBLE) AS w, 3.0::DOUBLE * source_size AS cap FROM named
), ratios AS (
  SELECT *, cap / w AS ratio FROM weighed
), levels AS (
  SELECT *, (CAST((SELECT sum(source_size) FROM sizes) AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(w) OVER (ORDER BY ratio, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM ratios
), final AS (
  SELECT arg_min(lvl, (ratio, rk)) AS lvl FROM levels WHERE lvl <= ratio
), targets AS (
  SELECT source, source_size, least(cap, (SELECT lvl FROM final) * w) AS target FROM ratios
), placed AS (
  SELECT s.*, t.source_size, t.target,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id ASC NULLS FIRST) AS k,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('7|' || coalesce('s' || s.source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM slim s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(floor(k * rate + u) - floor((k - 1) * rate + u) AS BIGINT) AS copies,
       CAST(floor(k * rate + u) - floor((k - 1) * rate + u) AS BIGINT) * size AS taken
FROM placed
"""

DECONTAMINATE_SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), wins AS (
  SELECT DISTINCT item, 10 AS n, array_to_string(ws[i:i + 9], ' ') AS win FROM (SELECT item, ws, unnest(range(1, len(ws) - 8)) AS i FROM items WHERE len(ws) >= 10)
  UNION
  SELECT DISTINCT item, len(ws), array_to_string(ws, ' ') FROM items WHERE len(ws) BETWEEN 1 AND 9
), lens AS (SELECT DISTINCT n FROM wins),
places AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM low, lens WHERE len(ws) >= n)
), hits AS (
  SELECT p.doc_id, p.i, p.n, w.item FROM places p JOIN wins w ON p.n = w.n AND p.win = w.win
), marked AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(l.ws) AS BIGINT) AS n_words, CAST(coalesce(m.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(d.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(d.ids, '')) AS items_sha256, coalesce(m.n_hit, 0) > 0 AS contaminated
FROM low l LEFT JOIN marked m ON l.doc_id = m.doc_id LEFT JOIN named d ON l.doc_id = d.doc_id
"""


LATTICE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
), pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= 0.98 * a.norm * b.norm
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.y FROM reach r JOIN pairs p ON p.x = r.b
)
SELECT v.vec_id, (SELECT count(*) FROM pairs p WHERE p.x = v.vec_id) AS n_links, c.m AS component_id, v.vec_id = c.m AS kept
FROM v JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = v.vec_id
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS s FROM w
), classes AS (
  SELECT s, min(doc_id) AS class_id, count(*) AS copies, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), tokens AS (
  SELECT class_id, copies, n, unnest(s) AS t FROM classes
), pairs AS (
  SELECT a.class_id AS x, b.class_id AS y, b.copies AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.class_id <> b.class_id
  GROUP BY a.class_id, b.class_id, a.n, b.n, b.copies HAVING count(*) * 5 >= 4 * (a.n + b.n - count(*))
), reach AS (
  SELECT class_id AS a, class_id AS b FROM classes UNION SELECT r.a, p.y FROM reach r JOIN pairs p ON p.x = r.b
), found AS (
  SELECT c.s, c.class_id, c.copies - 1 + coalesce((SELECT sum(p.c) FROM pairs p WHERE p.x = c.class_id), 0) AS n_links, m.m
  FROM classes c JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) m ON m.a = c.class_id
)
SELECT d.doc_id, coalesce(f.class_id, d.doc_id) AS class_id, CAST(coalesce(f.n_links, 0) AS BIGINT) AS n_links,
  coalesce(f.m, d.doc_id) AS component_id, d.doc_id = coalesce(f.m, d.doc_id) AS kept
FROM sets d LEFT JOIN found f ON f.s = d.s
"""


REPEATS_SQL = """
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), chunks AS (
  SELECT r, j * 200 AS base, substr(h, j * 400 + 1, 798) AS part FROM (SELECT r, h, unnest(range(0, (n - 200) // 200 + 1)) AS j FROM texts WHERE n >= 200)
), windows AS (
  SELECT r, base + i AS pos, sha256(substr(part, 2 * i + 1, 400)) AS w FROM (SELECT r, base, part, unnest(range(0, (len(part) - 400) // 2 + 1)) AS i FROM chunks)
), hits AS (
  SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY w) AS times FROM windows) WHERE times > 1
), runs AS (
  SELECT r, pos, sum(fresh) OVER (PARTITION BY r ORDER BY pos) AS k FROM (SELECT r, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY r ORDER BY pos) <= 200 THEN 0 ELSE 1 END AS fresh FROM hits)
), spans AS (
  SELECT r, min(pos) AS a, max(pos) + 200 AS b FROM runs GROUP BY r, k
), gaps AS (
  SELECT r, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS a, a AS b FROM spans UNION ALL SELECT s.r, max(s.b), any_value(t.n) FROM spans s JOIN texts t ON t.r = s.r GROUP BY s.r
), kept AS (
  SELECT g.r, unhex(string_agg(substr(t.h, 2 * g.a + 1, 2 * (g.b - g.a)), '' ORDER BY g.a, g.b)) AS rest FROM gaps g JOIN texts t ON t.r = g.r GROUP BY g.r
), removed AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT t.doc_id, CAST(t.n AS BIGINT) AS n_bytes, CAST(coalesce(x.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(x.n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(k.rest, unhex(t.h))) AS kept_sha256
FROM texts t LEFT JOIN removed x ON x.r = t.r LEFT JOIN kept k ON k.r = t.r
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_suffix_dedup": REPEATS_SQL, "op3_lattice": LATTICE_SQL, "op8_jaccard_join": JACCARD_SQL, "op1_mixing": MIXING_SQL, "op2_decontaminate": DECONTAMINATE_SQL}
