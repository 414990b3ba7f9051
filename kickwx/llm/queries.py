"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickwx.llm.bpe import bpe_decode, bpe_encode
from kickwx.llm.exact_dedup import exact_dedup
from kickwx.llm.fingerprints import spliced_fingerprints
from kickwx.llm.hyperminhash import near_duplicates
from kickwx.llm.language_id import identify, train
from kickwx.llm.packing import pack_documents
from kickwx.llm.phrases import mine_phrases
from kickwx.llm.scratch import scratch_path
from kickwx.llm.ship import ship
from kickwx.llm.simhash import simhash_near_dups
from kickwx.llm.substring_dedup import repeated_passages
from kickwx.llm.token_files import read_token_files, write_token_files
from kickwx.llm.toxicity import toxicity_scores
from kickwx.llm.url_filter import url_filter
from kickwx.llm.whitening import whiten_embeddings

# The url rules of the task, as (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def id_remainder(divisor: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), rules)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op5_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dups(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(5) == 0
    scored = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    decoded = bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spliced_fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next", "common_prefix",
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(4) == 2
    predicted = identify(docs, train(docs.filter(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_best_fit_packing, op3_exact_dedup, op4_substring_dedup, op5_simhash_near_dups, op6_token_files, op7_toxicity, op8_bpe_round_trip, op9_document_fingerprints, op10_language_id, op11_minhash_near_dups, op12_phrase_mining, op13_embedding_whitening)}


OP1_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
numbered AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hosts AS (SELECT n, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM numbered),
parts AS (
  SELECT n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts),
fits AS (
  SELECT n, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
"""

OP3_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM texts JOIN groups USING (body)
"""


OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sizes(size) AS (VALUES (1), (2), (3), (4)),
places AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM lists CROSS JOIN sizes),
counts AS (
  SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, count(*) AS f
  FROM places GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE size > 1 AND f >= 30),
inner_sizes AS (SELECT *, unnest(range(2, size)) AS part FROM candidates),
inner_places AS (SELECT *, unnest(range(1, size - part + 2)) AS i FROM inner_sizes),
longer AS (
  SELECT lang, array_to_string(list_slice(w, i, i + part - 1), ' ') AS phrase, max(a) AS most
  FROM inner_places GROUP BY ALL),
stay AS (
  SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase)
  WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM stay),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
         CAST((2000000 * CAST(a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + CAST(y.f AS HUGEINT)) AS BIGINT) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, k + 1, c.size), ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def llm_oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op12_phrase_mining": OP12_SQL}
