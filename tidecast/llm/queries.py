"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import (bpe, chat, decontaminate, html_wrappers, licenses, masked_lm, near_vectors, periodic_runs, pii, piece_bpe,
                          quality, simhash, turn_repair)
from tidecast.session import reach_workers

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
CHAT_PROBE = -7
PROBE_TEXT = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every embedding."""
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits on all documents and scores all: doc_id, n_tokens, log_likelihood, mean_log_likelihood."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return masked_lm.score_masked_lm(docs, masked_lm.fit_masked_lm(docs))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_licenses, license (of the best finding, else null) and dice per document, then all findings."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["dice"].alias("dice"), (-x["begin"]).alias("at"), x["license"].alias("license"))))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), best["license"].alias("license"), best["dice"].alias("dice"), "licenses")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pii and the text with pseudonyms of every document."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_pii", "text")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_wrappers.extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text of every document."""
    tokenizer = bpe.Tokenizer(path or public_tokenizers.path(BPE_FILE))
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)
    return bpe.decode(encoded, tokenizer).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word of every benchmark item found in a document."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document: 3-word shingles, 3 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    for batch in batches:
        rows = []
        for formatted, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            turns = chat.read_turns(formatted)
            masked = "".join(chat.unescape(formatted[s["begin"]:s["end"]]) for s in loss)
            rows.append((len(turns), digest("".join(f"{role}\n{text}\n" for role, text in turns)), len(masked), digest(masked), len(formatted)))
        names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], kinds[k]) for k in range(5))], ["conv_id", *names])


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted string of every conversation and of the probe conversation."""
    talks = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.createDataFrame([(CHAT_PROBE, 0, "user", PROBE_TEXT), (CHAT_PROBE, 1, "assistant", PROBE_TEXT)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(talks.unionByName(probe)).select("conv_id", "formatted", "loss")
    return formatted.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_planted_run(docs: DataFrame) -> DataFrame:
    """doc_id, text of documents; where crc32(doc_id) mod 10 is 0, the words from the a-th on
    repeat the p words there (a and p from the same hash), so that some documents hold long runs."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size("w")
    sized = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    placed = sized.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    placed = placed.withColumn("p", (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    a, p = F.col("a"), F.col("p")
    tail = F.slice("w", a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    longer = F.concat(F.slice("w", F.lit(1), a), F.slice(F.flatten(F.array_repeat(tail, times)), F.lit(1), n - a))
    return placed.select("doc_id", F.when(p.isNotNull(), F.array_join(longer, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period and exponent_milli, and
    SHA-256 of all runs and of the text without repeats of every document."""
    docs = with_planted_run(table(spark, sf_dir, "documents").select("doc_id", "text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("at"), (-r["period"]).alias("by"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    found = periodic_runs.find_runs(docs).withColumn("best", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.at")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.by")).alias("period"), F.floor(F.col("best.length") * 1000 / -F.col("best.by")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text of every document."""
    model = piece_bpe.PieceModel(path or public_tokenizers.path(PIECE_FILE))
    encoded = piece_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return piece_bpe.decode(encoded, model).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone of rows damaged by a hash of conversation and turn:
    dropped, emptied, without sentence ends, repeated or of role user."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    marked = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    return marked.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations in order to the SHA-256 of a conversation's pieces as lines."""
    conv, digest, convs, digests = None, None, [], []
    for batch in batches:
        for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if digest is not None and conv_id == conv:
                digest.update(b"\n")
            else:
                if digest is not None:
                    convs.append(conv)
                    digests.append(digest.hexdigest())
                conv, digest = conv_id, hashlib.sha256()
            digest.update(text.as_buffer())
    if digest is not None:
        convs.append(conv)
        digests.append(digest.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(digests, pa.string())], ["conv", "repaired_sha256"])


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, edits and the SHA-256 of the repaired text of every conversation after damage."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    damaged = damaged_turns(turns)
    repaired = turn_repair.RepairedTurns(damaged, gone=F.col("gone"))
    pieces = repaired.texts().repartition("conv_id").sortWithinPartitions("conv_id", "segment").select("conv_id", "text")
    digests = pieces.mapInArrow(_joined_digests, "conv long, repaired_sha256 string")
    report = repaired.report()
    return report.join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        *report.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over the documents."""
    import corpus_pipeline

    reach_workers(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_vectors, op2_masked_lm, op3_license_scan, op4_quality, op5_pseudonyms, op6_html_text, op7_bpe,
                            op8_decontamination, op9_simhash, op10_chat_format, op11_periodic_runs, op12_sentencepiece, op13_turn_repair,
                            pipeline)}

# DuckDB SQL for the operators that SQL can express.
ORACLES: dict[str, str] = {
    "op1_near_vectors": """
WITH RECURSIVE fine AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(r.b, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(r.b, e.vec_id) AS kept
FROM (SELECT DISTINCT * FROM embeddings) e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN least_id r ON r.a = e.vec_id""",
    "op10_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>')) + 14)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""",
}
