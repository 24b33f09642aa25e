"""Registered queries of the training-data operators and their DuckDB oracles.

Each query is thin: it reads the whole intended table, calls its operator with
production parameters and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts to bit-plane token files and back; digests from the files."""
    from hourglass.llm.token_output import read_token_ids, write_token_ids

    out = work_dir(spark, "op1-tokens")
    write_token_ids(table(spark, sf_dir, "documents"), out,
                    tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return read_token_ids(spark, out).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded with begin and end ids, with source offsets, and decoded."""
    from hourglass.llm.sentencepiece_codec import encode_decode

    found = encode_decode(table(spark, sf_dir, "documents"),
                          tokenizer_file("piece_bpe_32k.model"))
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                        F.sha2("starts", 256).alias("starts_sha256"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern spans and random strings of whole texts."""
    from hourglass.llm import secret_scan as S

    docs = table(spark, sf_dir, "documents")
    found = S.find_secrets(docs, S.train_on(docs))
    base = F.filter("spans", lambda x: x["kind"].isin(*S.BASE_KINDS))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in S.BASE_KINDS),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        count("random").alias("n_random"))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by base rules and, where none fits, by pattern rules."""
    from hourglass.llm import url_filter as U

    found = U.judge_urls(table(spark, sf_dir, "pages"), U.BASE_RULES,
                         U.rules_frame(spark, U.PATTERN_RULES))
    return found.select("page_id", "host", "path", "rule", "verdict")


# Written against the contract and the pattern list, without the operator's index.
ORACLES["op9_url_filter"] = r"""
WITH split AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN u IS NULL THEN 'allow'
            WHEN regexp_matches(u, '(^|[^a-z0-9])adult[^a-z0-9]education([^a-z0-9]|$)')
              OR regexp_matches(u, '^[^:/?#]*://([^/?#]*\.)?spam[^a-z0-9]filter\.') THEN 'allow'
            WHEN regexp_matches(u, '(^|[^a-z0-9])(adult|casino|gambling|malware|phishing|pills|poker|spam|torrent|viagra|warez|xxx)([^a-z0-9]|$)')
              OR regexp_matches(u, '(^|[^a-z0-9])(porn|sessionid=)')
              OR regexp_matches(u, '^[^:/?#]*://([^/?#]*\.)?(ads|doubleclick)\.')
              OR suffix(u, '/wp-login.php') OR suffix(u, '.exe')
              OR regexp_matches(u, '/calendar/.*/day/', 's') THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page to WARC archives and back; rows are read from the archives."""
    from hourglass.llm.warc import read_warc, write_warc

    out = work_dir(spark, "op10-warc")
    write_warc(table(spark, sf_dir, "pages"), out)
    return read_warc(spark, out, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLES["op10_warc"] = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to, url
FROM p LEFT JOIN g USING (payload_digest)
"""


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every whole text, by base rules and a learned list."""
    from hourglass.llm import quality_rules as Q

    docs = table(spark, sf_dir, "documents")
    rules = Q.learn_from(docs, table(spark, sf_dir, "labels"))
    return Q.judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                       "n_repeat_words", "base_failed", "kept", "rule")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of whole texts, linked at 4 bits or fewer, and their components."""
    from hourglass.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), work_dir(spark, "op5-simhash"),
                           shingle=4, radius=4)


@query
def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a byte network fit to labelled rows that are not held out."""
    from hourglass.llm import quality_cnn as C

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = C.score(docs, C.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", C.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= C.THRESHOLD).cast("int").alias("predicted"))


@query
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    from hourglass.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items: every pair with its most similar window."""
    from hourglass.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded by a rank file and decoded to bytes."""
    import public_tokenizers

    from hourglass.llm.rank_bpe import decode, encode

    at = (tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    found = decode(encode(table(spark, sf_dir, "documents"), *at), *at)
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's Merkle proof; folded again from leaves some of which are tampered with."""
    from hourglass.llm import merkle as K

    c = F.col
    tampered = F.crc32(c("doc_id").cast("string").cast("binary")) % 7 == 0
    seen = F.when(tampered, c("n_chars") + 1).otherwise(c("n_chars"))
    leaf = lambda n: K.leaf_digest(c("doc_id"), c("source"), c("lang"), n, c("text"))
    proved = K.prove(table(spark, sf_dir, "documents"), c("doc_id"), c("lang"), leaf(c("n_chars")),
                     carry=[leaf(seen).alias("seen_leaf")])
    folded = K.fold(K.fold(c("seen_leaf"), c("siblings"), c("i")), c("top_siblings"), c("top_i"))
    return proved.select(c("key").alias("doc_id"), "leaf", "subroot", "root",
                         K.proof_digest(c("siblings"), c("top_siblings")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", c("folded_root") == c("root"))


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there): rows damaged by a hash of their place."""
    c = F.col
    code = F.crc32(F.concat_ws(":", *[F.coalesce(c(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
                   .cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (code != 0).alias("there"), F.when(code == 3, 2).otherwise(1).alias("copies"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


@query
def op13_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of damaged conversations and their cheapest repair."""
    from hourglass.llm.role_repair import repair

    c = F.col
    rows = damaged_conversations(table(spark, sf_dir, "conversations"))
    return repair(rows, c("conv_id"), c("turn"), c("role"), c("text"), c("there")).summary.drop("g", "edits")
