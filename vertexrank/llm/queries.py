"""Registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align
from .ann import neighbours
from .clustering import CLUSTERS, DIM, ROUNDS, SCALE, SEED, cluster
from .common import read_table
from .decontaminate import find_leaks
from .html_extract import extract
from .line_dedup import dedup_lines
from .mixing import mix_documents
from .ngram_join import ngram_components
from .preference import format_preferences, neighbour_pairs, shared_prompt_pairs
from .quality import quality
from .secrets import find_secrets
from .suffix_dedup import remove_repeats
from .token_count import count_tokens

# vocabulary files (see the public_tokenizers module); operators take any path
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines before, lines removed, and the text that stays."""
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), null_ids=True)


def op2_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table marks no preference; conversation 2k is taken as chosen and
    2k + 1 as rejected. These share no turn, so there is no prompt."""
    return format_preferences(neighbour_pairs(read_table(spark, sf_dir, "conversations")))


def op2_preference_shared_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that share a prompt: every conversation against itself with the last
    reply of the next one."""
    return format_preferences(shared_prompt_pairs(read_table(spark, sf_dir, "conversations")))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))


def op9_multi_index_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(read_table(spark, sf_dir, "embeddings"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read_table(spark, sf_dir, "documents"), n=4, share=85)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read_table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_preference_formatting": op2_preference_formatting,
    "op2_preference_shared_prompt": op2_preference_shared_prompt,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_html_extraction": op7_html_extraction,
    "op8_secret_scan": op8_secret_scan,
    "op9_multi_index_neighbours": op9_multi_index_neighbours,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_token_counts": op13_token_counts,
}

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


def _shingles(table: str, key: str, n: int) -> str:
    """Distinct n-word shingles of a table as (key, s)."""
    return f"""
SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {n}
    THEN list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
FROM (SELECT {key}, {_WORDS} AS w FROM {table} WHERE text IS NOT NULL)"""


def _clustering_sql() -> str:
    """Lloyd's rounds written out one after the other (x: component, d: its place)."""
    parts = [
        f"""k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {DIM}
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})""",
        f"v AS MATERIALIZED (SELECT r, unnest(range({DIM})) AS d, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM k)",
        f"""f AS (SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c FROM k WHERE vec_id IS NOT NULL),
c0 AS MATERIALIZED (SELECT c, d, x FROM f JOIN v USING (r) WHERE c < {CLUSTERS})""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, min(s * {CLUSTERS} + c) AS m FROM (
  SELECT v.r, c.c, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS s FROM v JOIN c{i} c USING (d) GROUP BY v.r, c.c) GROUP BY r)""")
        parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, d, CAST(coalesce((s - ((s % n) + n) % n) // n, x) AS BIGINT) AS x FROM c{i} LEFT JOIN (
  SELECT m % {CLUSTERS} AS c, d, sum(x) AS s, count(*) AS n FROM a{i} JOIN v USING (r) GROUP BY 1, 2) USING (c, d))""")
    return f"""WITH {", ".join(parts)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c),
o AS (SELECT vec_id, m % {CLUSTERS} AS c, m // {CLUSTERS} AS distance FROM a{ROUNDS} JOIN k USING (r))
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM o JOIN h USING (c)"""


# DuckDB SQL of the queries that SQL can express on whole tables
ORACLE_SQL: dict[str, str] = {
    "op2_preference_formatting": """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS yes, conv_id, coalesce(turn, -(1::BIGINT << 62)) AS turn,
         replace(coalesce(role, ''), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
e AS (
  SELECT pair_id, turn, coalesce(list(role || chr(0) || text ORDER BY role, text) FILTER (yes), []) AS y,
         coalesce(list(role || chr(0) || text ORDER BY role, text) FILTER (NOT yes), []) AS n
  FROM t GROUP BY pair_id, turn),
f AS (SELECT pair_id, min(turn) FILTER (y <> n) AS first FROM e GROUP BY pair_id),
p AS (
  SELECT t.pair_id, CASE WHEN first IS NULL OR turn < first THEN 'prompt' WHEN yes THEN 'chosen' ELSE 'rejected' END AS part,
         turn, role, text, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown
  FROM t JOIN f USING (pair_id) WHERE yes OR turn >= first),
q AS (
  SELECT *, row_number() OVER w AS k, coalesce(sum(length(shown)) OVER (PARTITION BY pair_id, part ORDER BY turn, role, text
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM p WINDOW w AS (PARTITION BY pair_id, part ORDER BY turn, role, text)),
g AS (
  SELECT pair_id, part, count(*) AS n, string_agg(shown, '' ORDER BY k) AS shown,
         coalesce(string_agg((pos + length(role) + 5)::BIGINT || ':' || (pos + length(shown))::BIGINT, ',' ORDER BY k) FILTER (role = 'assistant'), '') AS mask
  FROM q GROUP BY pair_id, part),
i AS (SELECT pair_id, min(conv_id) FILTER (yes) AS chosen_id, min(conv_id) FILTER (NOT yes) AS rejected_id FROM t GROUP BY pair_id)
SELECT i.pair_id, chosen_id, rejected_id, coalesce(a.n, 0) AS n_prompt, coalesce(b.n, 0) AS n_chosen, coalesce(c.n, 0) AS n_rejected,
       coalesce(a.shown, '') AS prompt,
       CASE WHEN chosen_id IS NOT NULL THEN coalesce(b.shown, '') END AS chosen,
       CASE WHEN rejected_id IS NOT NULL THEN coalesce(c.shown, '') END AS rejected,
       CASE WHEN chosen_id IS NOT NULL THEN coalesce(b.mask, '') END AS chosen_mask,
       CASE WHEN rejected_id IS NOT NULL THEN coalesce(c.mask, '') END AS rejected_mask
FROM i LEFT JOIN g a ON a.pair_id = i.pair_id AND a.part = 'prompt' LEFT JOIN g b ON b.pair_id = i.pair_id AND b.part = 'chosen'
LEFT JOIN g c ON c.pair_id = i.pair_id AND c.part = 'rejected'""",
    "op3_benchmark_decontamination": f"""
WITH d AS ({_shingles("documents", "doc_id", 5)}),
b AS ({_shingles("benchmark", "item_id", 5)}),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT d.doc_id, b.item_id, n.n_item, count(*) AS n_shared, count(*) / n.n_item AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id)
GROUP BY d.doc_id, b.item_id, n.n_item HAVING 100 * count(*) >= 80 * n.n_item""",
    "op10_ngram_jaccard_join": f"""
WITH RECURSIVE d AS MATERIALIZED ({_shingles("documents", "doc_id", 4)}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM d x JOIN d y USING (s) JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) USING (doc_id)""",
    "op11_centroid_clustering": _clustering_sql(),
}

# the pairs of the second form, formatted by the same SQL
_SHARED_PROMPT = """
WITH s AS (SELECT conv_id, coalesce(turn, -(1::BIGINT << 62)) AS turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS last FROM s WHERE role = 'assistant' GROUP BY conv_id),
o AS (SELECT conv_id, last, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS donor FROM l),
u AS (
  SELECT conv_id AS pair_id, true AS yes, conv_id, turn, role, text FROM s
  UNION ALL SELECT s.conv_id, false, donor, turn, role, text FROM s JOIN o ON o.conv_id = s.conv_id WHERE donor <> o.conv_id AND turn < last
  UNION ALL SELECT o.conv_id, false, donor, o.last, role, text FROM o JOIN l ON l.conv_id = donor JOIN s ON s.conv_id = donor AND s.turn = l.last
  WHERE donor <> o.conv_id),
t AS (
  SELECT pair_id, yes, conv_id, turn, replace(coalesce(role, ''), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM u),
e AS ("""
ORACLE_SQL["op2_preference_shared_prompt"] = _SHARED_PROMPT + ORACLE_SQL["op2_preference_formatting"].partition("e AS (")[2]
