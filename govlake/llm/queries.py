"""The registered queries of this subpackage: each applies one operator to its whole table.

The query derives the digest columns of its contract; the operator itself returns texts,
spans or groups. ``ORACLES`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, quality, toxicity
from .bpe import encode_documents
from .chat_format import format_conversations, pieces, read_back, read_loss, text_part, turn_count
from .chunk_dedup import chunk_report
from .common import in_fold, staged, table
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .ftrl import labelled_sample
from .periodic_runs import periodic_runs
from .sharding import shard_rows
from .simhash import near_groups
from .suffix_dedup import suffix_dedup
from .token_alignment import align_documents, alignment_report, summarise

SHARDS = 16


VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
ACCEPT = 0.3


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where a public vocabulary file lies (driver and executors have the same installation)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 4, 2)
    pred = language_id.predict(docs, language_id.train(docs.where(~held_out)))
    return pred.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"), vocabulary_path())
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _scored(scores: DataFrame, held_out) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold("doc_id", 5, 0)
    model = quality.fit(labelled_sample(docs, labels.where(~held_out), "quality", quality.SAMPLE_ROWS))
    return _scored(quality.score(docs, model), held_out)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold("doc_id", 4, 2)
    return _scored(toxicity.score(docs, toxicity.learn(docs, labels.where(~held_out))), held_out)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).cast("long").alias("text_crc32"))
    return shard_rows(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"), k=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_report(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = vocabulary_path(), vocabulary_path(PIECES)
    aligned = align_documents(table(spark, sf_dir, "documents"), *files)
    return alignment_report(staged(summarise(aligned, *files), "aligned"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The documents of op12's contract: one in ten, by crc32 of its id, has its words from some place on repeated from there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.expr("int(g % n)")))
    docs = docs.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)")
    planted = F.array_join(F.concat(F.expr("slice(words, 1, a)"), tail), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_repeats(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), lines.alias("lines"), "collapsed")
    return rows.select(
        "doc_id", "n_runs", (-F.col("r.s")).alias("start"), F.col("r.length").alias("length"), (-F.col("r.p")).alias("period"),
        F.expr("1000 * r.length div -r.p").alias("exponent_milli"), F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    chats = format_conversations(rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    read = chats.select("conv_id", "formatted", "loss_mask", pieces(F.col("formatted")).alias("pieces"))
    read = read.select("conv_id", turn_count(F.col("pieces")).cast("long").alias("n_turns"), read_back(F.col("pieces")).alias("turns"),
                       read_loss(F.col("pieces"), F.col("loss_mask")).alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return read.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_simhash": op9_simhash,
    "op10_chunk_dedup": op10_chunk_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_chat_format": op13_chat_format,
    "pipeline": pipeline,
}

ORACLES = {
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op13_chat_format": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        escaped AS (
            SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS role_out,
                   regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS text_out FROM said),
        chats AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(length('<|turn|>' || role_out || '<|text|>' || text_out || '<|end|>')) AS chars
            FROM escaped GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               chars::BIGINT AS formatted_chars FROM chats""",
}
