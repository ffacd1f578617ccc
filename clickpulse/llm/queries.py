"""The operators as registered queries over the ``documents`` table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.common import bucket_of_id, read_documents, stored
from clickpulse.llm.decontaminate import contaminated
from clickpulse.llm.exact_dedup import mark_copies
from clickpulse.llm.hard_negatives import mine, whole_vectors
from clickpulse.llm.language_id import identify
from clickpulse.llm.ngram_join import near_classes
from clickpulse.llm.order_minhash import fingerprint_text, with_neighbours
from clickpulse.llm.prefix_trie import digest_turns, prefix_trie, share_openings
from clickpulse.llm.quality import score_quality
from clickpulse.llm.secrets import find_secrets
from clickpulse.llm.sentencepiece_codec import decode_documents, encode_documents
from clickpulse.llm.sharding import assign_shards
from clickpulse.llm.suffix_dedup import remove_repeats
from clickpulse.llm.token_counts import count_documents


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(read_documents(spark, sf_dir))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_digest(read_documents(spark, sf_dir))


def codec_digest(docs: DataFrame) -> DataFrame:
    """Per document: number of ids, sha256 of the ids (decimal, comma-joined), and whether decoding gives the text back."""
    encoded = encode_documents(docs.select("doc_id", "text"))
    both = decode_documents(encoded)
    # U+2581 is the vocabulary's own mark for a space and reads back as one.
    text = F.translate(F.coalesce("text", F.lit("")), "\u2581", " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        (F.col("decoded") == text).alias("round_trip"),
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    held_out = bucket_of_id(F.col("doc_id"), 3) == 1
    return identify(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "class_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read_documents(spark, sf_dir), 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_documents(read_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "counts.*")


def quality_teaches():
    """The fold that labels may be learned from."""
    return bucket_of_id(F.col("doc_id"), 5) != 0


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    scores = score_quality(read_documents(spark, sf_dir), labels, quality_teaches())
    return scores.select("doc_id", (~quality_teaches()).alias("held_out"), "score", "predicted")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(find_secrets(read_documents(spark, sf_dir)))


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, all spans as text, and the best score among them (null without any)."""
    base = F.filter("spans", lambda s: s["kind"] != "format")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("top_score"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt with common openings."""
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).where("conv_id IS NOT NULL").distinct()
    ids = stored(ids, "trie-ids")
    turns = stored(digest_turns(conversations), "trie-turns")
    return prefix_trie(share_openings(turns, ids), ids)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined_negatives(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


def mined_negatives(embeddings: DataFrame) -> DataFrame:
    """Every 50th vector as an anchor, components times 256 rounded down, every 7th label moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return mine(whole_vectors(embeddings, "vec_id", label, "embedding", 256), F.col("vec_id") % 50 == 0)


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_digest(read_documents(spark, sf_dir))


def neighbour_digest(docs: DataFrame) -> DataFrame:
    near = with_neighbours(docs)
    return near.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint_text(F.col("signature")).alias("fingerprint"),
        fingerprint_text(F.col("edited_signature")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_language_id": op4_language_id,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_sharding": op6_sharding,
    "op7_token_counts": op7_token_counts,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_order_minhash": op13_order_minhash,
}

_OP1 = r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM (
  SELECT doc_id, t,
         first_value(doc_id) OVER (PARTITION BY t ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size
  FROM norm
) g
"""

# crc32 of a decimal text, bit by bit: 3988292384 is the polynomial, reflected.
_CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, x: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(a, x)),
    CAST(4294967295 AS BIGINT)))"""

_OP11 = f"""
WITH ids AS (SELECT DISTINCT CAST(conv_id AS BIGINT) AS c FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT c, c - c % 100 AS b, {_CRC32} % 6 AS h FROM ids),
orig AS (
  SELECT c, p, g, len, row_number() OVER (PARTITION BY c ORDER BY p NULLS FIRST, g) AS i
  FROM (SELECT conv_id AS c, turn AS p, length(coalesce(text, '')) AS len,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g
        FROM conversations WHERE conv_id IS NOT NULL) o
),
sizes AS (SELECT c, count(*) AS n FROM orig GROUP BY c),
rebuilt AS (
  SELECT k.c, o.i AS d, o.g, o.len FROM keyed k JOIN orig o ON o.c = k.b AND o.i <= k.h
  UNION ALL
  SELECT k.c, o.i - k.h + least(k.h, coalesce(s.n, 0)) AS d, o.g, o.len
  FROM keyed k JOIN orig o ON o.c = k.c AND o.i > k.h LEFT JOIN sizes s ON s.c = k.b
),
member AS (
  SELECT c, d, sha256(string_agg(g, ',') OVER (PARTITION BY c ORDER BY d)) AS key, len FROM rebuilt
  UNION ALL SELECT c, 0, '', 0 FROM ids
),
lasts AS (SELECT c, max(d) AS d FROM member GROUP BY c),
node AS (SELECT d, key, min(c) AS c, count(*) AS n, max(len) AS len FROM member GROUP BY d, key),
linked AS (
  SELECT n.*, m.key AS above, p.c AS parent FROM node n
  LEFT JOIN member m ON m.c = n.c AND m.d = n.d - 1 LEFT JOIN node p ON p.d = m.d AND p.key = m.key
),
kids AS (SELECT d - 1 AS d, above AS key, count(*) AS n FROM linked WHERE d > 0 GROUP BY 1, 2),
below AS (
  SELECT m.d, m.key, sum((u.n - 1) * u.len) AS saved, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM node u JOIN member m ON m.c = u.c AND m.d <= u.d LEFT JOIN kids k ON k.d = u.d AND k.key = u.key
  GROUP BY m.d, m.key
),
ends AS (
  SELECT m.d, m.key, sha256(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c)) AS hash
  FROM member m JOIN lasts l ON l.c = m.c AND l.d = m.d GROUP BY m.d, m.key
)
SELECT l.c AS conv_id, CAST(l.d AS BIGINT) AS depth, l.parent AS parent_conv_id, l.n AS n_convs,
       coalesce(k.n, 0) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       coalesce(e.hash, sha256('')) AS ends_sha256
FROM linked l JOIN below b ON b.d = l.d AND b.key = l.key
LEFT JOIN kids k ON k.d = l.d AND k.key = l.key LEFT JOIN ends e ON e.d = l.d AND e.key = l.key
"""

_OP12 = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS id,
         CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
score AS (
  SELECT a.id AS a, x.id AS x, a.label = x.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.q, x.q), lambda z: z[1] * z[2])), 0) AS s
  FROM v a JOIN v x ON x.id <> a.id AND len(x.q) = len(a.q) WHERE a.id % 50 = 0
),
positive AS (SELECT a, x, s FROM score WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, x) <= 5)
SELECT p.a AS anchor_id, p.x AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.x ORDER BY n.s DESC, n.x) AS INTEGER) AS rank,
       n.x AS negative_id, CAST(p.s AS BIGINT) AS positive_score, CAST(n.s AS BIGINT) AS negative_score
FROM positive p JOIN score n ON n.a = p.a AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
QUALIFY rank <= 3
"""

LLM_ORACLE: dict[str, str] = {"op1_exact_dedup": _OP1, "op11_prefix_trie": _OP11, "op12_hard_negatives": _OP12}
