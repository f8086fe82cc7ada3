"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from almanac.llm import bpe, chat, langid, licenses, minhash, mixing, pii, quality, repair, rules, simhash, topk, whitening
from almanac.llm.common import checkpointed, fold, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", added), (-1, 1, "assistant", added)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest_conversations(chat.format_conversations(turns.unionByName(extra)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trees = quality.train(docs, labels, usable=fold("doc_id", 5) != 0)
    scored = quality.score(docs, trees).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = langid.train(docs, usable=fold("doc_id", 3) != 1)
    found = langid.identify(docs, models).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("lang").alias("lang_pred"), "score")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        minhash.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        minhash.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda p: p["rank"] == pii.KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return found.select(F.col("id").alias("doc_id"), *(count(k) for k in pii.BASE), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    mixed = mixing.mix(checkpointed(mixing.measured(docs, trees)))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    words, base = F.transform("places", lambda p: p["word"]), F.transform("places", lambda p: p["label"])
    every = F.concat(base, F.transform("found", lambda f: f["label"]))
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    sure = F.coalesce(F.array_max(F.transform("found", lambda f: f["rank"])), F.lit(0)) / 100.0
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).cast("bigint").alias("first_word"),
        F.array_max(words).cast("bigint").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(every).alias("labels"),
        F.when(F.size("places") > 0, F.greatest(sure, F.lit(0.5))).otherwise(F.least(sure, F.lit(1.0))).alias("score"),
    )


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(whitening.whiten(table(spark, sf_dir, "embeddings"))).withColumnRenamed("id", "vec_id")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    found = repair.repair_conversations(repair.damaged(turns, F.crc32(named) % 20)).withColumnRenamed("conv_id", "_id")
    rows = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_chat": op2_chat,
    "op3_quality": op3_quality,
    "op4_minhash": op4_minhash,
    "op5_topk": op5_topk,
    "op6_bpe": op6_bpe,
    "op7_pii": op7_pii,
    "op8_langid": op8_langid,
    "op9_mixing": op9_mixing,
    "op10_licenses": op10_licenses,
    "op11_rules": op11_rules,
    "op12_whitening": op12_whitening,
    "op13_repair": op13_repair,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    # A control string with n backslashes after its first character gets one more: one character a place.
    "op2_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(24 + length(role) + length(text) + len(regexp_extract_all(text,
                '<\\*\|im_start\|>|<\\*\|im_end\|>|<\\*\|endoftext\|>|<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>')))::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id""",
    # Rows that repeat are numbered, so that a query leaves out one row only.
    "op5_topk": """
        WITH clean AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        row_of AS (SELECT *, row_number() OVER () AS n FROM clean),
        scored AS (
            SELECT q.vec_id AS query_id, q.n, c.vec_id, CASE WHEN len(q.v) = 0 THEN 0 ELSE list_inner_product(q.v, c.v) END::BIGINT AS score
            FROM row_of q JOIN row_of c ON q.vec_id % 20 = 0 AND q.n <> c.n AND len(q.v) = len(c.v))
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20""",
    # The table of the search row by row: per state the cheapest edits, then the least as text, with the turns they leave.
    "op13_repair": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
        dealt AS (
            SELECT *, xor(list_reduce(list_transform(range(0, length(k)), lambda i: ascii(substr(k, i + 1, 1))::BIGINT),
                lambda c, b: list_reduce(range(0, 8), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c, b)), 4294967295), 4294967295) % 20 AS d FROM keyed),
        hurt AS (
            SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM dealt, range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
        seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM hurt),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS n FROM seen),
        faulty AS (
            SELECT *, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS p,
                CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN nth > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM placed),
        -- Insertions from a state: the roles that they add, the state after; then what a row may do there.
        ins(x, added, y) AS (VALUES ('', '', ''), ('', 'u', 'u'), ('', 'ua', 'a'), ('s', '', 's'), ('s', 'u', 'u'), ('s', 'ua', 'a'), ('u', '', 'u'), ('u', 'a', 'a'), ('a', '', 'a'), ('a', 'u', 'u')),
        step(y, r, z) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
        walk AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS n, '' AS x, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS turns FROM faulty
            UNION ALL
            SELECT conv_id, n, x, best.cost, best.audit, best.turns FROM (
                SELECT conv_id, n, x, min(struct_pack(cost := cost, audit := audit, turns := turns)) AS best FROM (
                    SELECT w.conv_id, f.n, w.x, w.cost + 4 AS cost, w.audit || 'D' AS audit, w.turns FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
                    UNION ALL
                    SELECT w.conv_id, f.n, step.z, w.cost + 3 * length(ins.added) + 3 * (e.e = 'R')::INT + 3 * (f.fault = 3)::INT, w.audit || repeat('I', length(ins.added)) || e.e,
                        list_concat(w.turns, list_transform(range(0, length(ins.added)), lambda j: CASE substr(ins.added, j + 1, 1) WHEN 'u' THEN 'user:' ELSE 'assistant:' END),
                            [CASE WHEN e.e = 'K' THEN f.role WHEN step.r = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text])
                    FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1 AND f.fault NOT IN (1, 2)
                    JOIN ins ON ins.x = w.x JOIN step ON step.y = ins.y JOIN (VALUES ('K'), ('R')) e(e) ON (e.e = 'K' AND step.r = f.i) OR (e.e = 'R' AND step.r <> 's'))
                GROUP BY conv_id, n, x)),
        ended AS (
            SELECT conv_id, min(struct_pack(cost := cost, audit := audit, turns := turns)) AS best FROM (
                SELECT w.conv_id, w.cost + 3 * length(ins.added) AS cost, w.audit || repeat('I', length(ins.added)) AS audit,
                    list_concat(w.turns, list_transform(range(0, length(ins.added)), lambda j: CASE substr(ins.added, j + 1, 1) WHEN 'u' THEN 'user:' ELSE 'assistant:' END)) AS turns
                FROM walk w JOIN (SELECT conv_id, max(n) AS n FROM faulty GROUP BY conv_id) t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.n
                JOIN ins ON ins.x = w.x AND ins.y IN ('', 'a'))
            GROUP BY conv_id),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                count(*) FILTER (p IS NOT NULL AND p || i NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.turns, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id""",
}
