"""The registered queries of the language-model operators and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordergrain.llm import (
    bpe, chaining, chat, hamming, infill, lattice, lines, minhash, negatives, packing, quality, scoring, substrings,
)
from ordergrain.llm.storage import ship_package

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TRAINING = "coalesce(crc32(cast(doc_id AS string)), 0) % 5 != 1"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trips(_read(spark, folder, "documents"), BYTE_BPE)


@_query
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_read(spark, folder, "documents"), BYTE_BPE)


@_query
def op10_backoff_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score(_read(spark, folder, "documents"), TRAINING)


@_query
def op1_lattice_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.similar_vectors(_read(spark, folder, "embeddings"))


@_query
def op3_hyperminhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, folder, "documents"))


@_query
def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return substrings.remove_repeated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


@_query
def op6_winnowed_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return lines.remove_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", digest)


ORACLES["op6_winnowed_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n FROM split),
counting AS (
  SELECT doc_id, n, line, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i
  FROM lines WHERE regexp_matches(line, '[^\x09-\x0D\x20]')
),
runs AS (
  SELECT doc_id, i, line AS a, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM counting
),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, i) AS turn FROM runs WHERE b IS NOT NULL
),
gone AS (
  SELECT doc_id, i FROM ranked WHERE turn > 1 UNION SELECT doc_id, i + 1 FROM ranked WHERE turn > 1
),
dead AS (SELECT doc_id, n FROM gone JOIN counting USING (doc_id, i)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY n) AS text
  FROM lines ANTI JOIN dead USING (doc_id, n) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(parts), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM split d LEFT JOIN kept k USING (doc_id)
"""


SEARCHED = 10


@_query
def op8_multi_index_hamming_search(spark: SparkSession, folder: str) -> DataFrame:
    codes = hamming.sign_codes(_read(spark, folder, "embeddings"))
    return hamming.nearest(codes, codes.where("id % 50 = 0"), SEARCHED)


ORACLES["op8_multi_index_hamming_search"] = f"""
WITH parts AS (SELECT vec_id AS id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
codes AS (SELECT id, string_agg(CASE WHEN x > 0 THEN '1' ELSE '0' END, '' ORDER BY i)::BIT AS code FROM parts GROUP BY id),
pairs AS (
  SELECT q.id AS query_id, r.id, CAST(bit_count(xor(q.code, r.code)) AS INTEGER) AS distance
  FROM codes q JOIN codes r ON q.id <> r.id WHERE q.id % 50 = 0
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, id, distance FROM ranked WHERE rank <= {SEARCHED}
"""


def good_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents: good are those of quality that are not toxic."""
    good = F.expr("CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality = 0 OR toxic = 1 THEN 0 END")
    return _read(spark, folder, "labels").select("doc_id", good.alias("good"))


@_query
def op5_empirical_bayes_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_read(spark, folder, "documents"), good_labels(spark, folder))


@_query
def op9_collinear_passages(spark: SparkSession, folder: str) -> DataFrame:
    return chaining.with_sources(chaining.repeated_passages(_read(spark, folder, "documents")))


@_query
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = infill.fill_in_middle(_read(spark, folder, "documents"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op11_fill_in_middle"] = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS digest,
         CASE WHEN coalesce(text, '') = '' THEN [] ELSE regexp_extract_all(text, '[^\n]*\n|[^\n]+') END AS units
  FROM documents
),
hashed AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || digest[1:8] AS BIGINT) AS h1, CAST('0x' || digest[9:16] AS BIGINT) AS h2,
         CAST('0x' || digest[17:24] AS BIGINT) AS h3, CAST('0x' || digest[25:32] AS BIGINT) AS h4
  FROM drawn
),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high FROM hashed),
pieces AS (
  SELECT doc_id, text, n,
         array_to_string(list_slice(units, 1, low), '') AS p,
         array_to_string(list_slice(units, low + 1, high), '') AS m,
         array_to_string(list_slice(units, high + 1, n), '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""


PROBE = "\\### Assistant: </turn> ok"  # looks like the template itself


@_query
def op12_prefix_target_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(F.lit(-7).cast("long"), "id", role, F.lit(PROBE))
    return chat.digests(chat.expand(rows.unionAll(probe)))


ORACLES["op12_prefix_target_chat"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS probe(turn, role)
),
sized AS (
  SELECT *, row_number() OVER later = 1 AS last,
         14 + length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c'))
         + length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e')) AS size
  FROM said
  WINDOW later AS (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC)
),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS chars
  FROM sized
),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         CAST(sum(chars) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
  FROM summed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""


@_query
def op13_residue_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    rows = _read(spark, folder, "embeddings").select("vec_id", "embedding", moved)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLES["op13_residue_hard_negatives"] = """
WITH numbers AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM numbers a JOIN numbers b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score,
       n.score AS negative_score
FROM positives p JOIN pairs n USING (anchor_id)
WHERE NOT n.alike AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 5
"""
