"""The operators of this subpackage as queries over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.block_naming import exact_duplicates
from corpusloom.llm.bpe_codec import encode_decode
from corpusloom.llm.chat_windows import Template, chat_windows
from corpusloom.llm.conversation_repair import repair_report
from corpusloom.llm.crf_extract import extract_text
from corpusloom.llm.lattice_lm import score_texts
from corpusloom.llm.merkle import folded, merkle_manifest, record_digest
from corpusloom.llm.mixing import mix_sources
from corpusloom.llm.mixture_langid import fold, learn, predict
from corpusloom.llm.projection_knn import nearest_neighbours
from corpusloom.llm.sharding import byte_shards
from corpusloom.llm.simhash import near_duplicates
from corpusloom.llm.token_counts import count_tokens


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_decode(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN, carry=["doc_id"])
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    langs, model = learn(docs.where(fold("doc_id", 3) != 1))
    found = predict(docs.withColumn("held_out", fold("doc_id", 3) == 1), langs, model, carry=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", F.map_keys("lang_shares").alias("langs"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    shards = byte_shards(_table(spark, folder, "documents"), 8)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(_table(spark, folder, "documents"))


def op6_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(_table(spark, folder, "documents"), repeats=2.0)
    return mixed.select("doc_id", "source", "n_tokens", "pass_no", "block", "block_rank")


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(_table(spark, folder, "pages"), carry=["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    docs = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op9_lattice_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", fold("doc_id", 5) == 1)
    return score_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), fold("doc_id", 5) != 1, carry=["doc_id", "held_out"], rounds=2)


def op10_projection_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


def op11_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    template, probe = Template(), "</s>[INST] ok [/INST]"
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"))
    windows = chat_windows(rows, template=template)
    fresh = F.slice(template.turns(F.col("formatted")), F.col("n_repeated") + 1, F.col("n_fresh"))
    read = windows.select(
        "conv_id", "span", F.explode(F.array(fresh)).alias("fresh"), F.length("formatted").cast("long").alias("n_chars"),
        F.array_join(template.loss_texts(F.col("formatted"), F.col("loss")), "").alias("loss_text"))
    said = F.array_join(F.transform("fresh", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    whole = read.groupBy("conv_id").agg(
        F.sum(F.size("fresh")).cast("long").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("span", said.alias("said"), "loss_text"))).alias("in_order"))  # a digest needs it all
    joined = whole.withColumn("loss_text", F.array_join("in_order.loss_text", ""))
    return joined.select(
        "conv_id", "n_turns", F.sha2(F.array_join("in_order.said", ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fate, role, text = F.col("fate"), F.coalesce("role", blank), F.coalesce("text", blank)
    damaged = rows.withColumn("fate", F.crc32(place.cast("binary")) % 20).where(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return repair_report(damaged, rows)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    tampered = record_digest(*(fields | {"n_chars": F.col("n_chars") + 1}).values())
    meant = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    manifest = merkle_manifest(docs, record_digest(*fields.values()), carry=[("tampered", F.when(meant, tampered))])
    siblings = F.transform(F.concat("path", "top_path"), lambda step: step["digest"])
    checked = manifest.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path"), F.col("top_path")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_language_mixture": op2_language_mixture,
    "op3_simhash": op3_simhash,
    "op4_sharding": op4_sharding,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_temperature_mixing": op6_temperature_mixing,
    "op7_html_extraction": op7_html_extraction,
    "op8_token_counts": op8_token_counts,
    "op9_lattice_scores": op9_lattice_scores,
    "op10_projection_search": op10_projection_search,
    "op11_chat_windows": op11_chat_windows,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

# CRC-32, byte by byte, by the table of its polynomial.
_STEPS = """steps AS MATERIALIZED (SELECT list_transform(range(0, 256), lambda i: list_reduce(list_concat([i], range(0, 8)),
        lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS t)"""
_CRC = f"""{_STEPS},
      codes AS (SELECT doc_id, list_transform(list_filter(string_split(coalesce(text, ''), ''), lambda ch: ch <> ''), lambda ch: ord(ch)::BIGINT) AS o
        FROM documents),
      bytes AS (SELECT doc_id, flatten(list_transform(o, lambda u: CASE WHEN u < 128 THEN [u] WHEN u < 2048 THEN [192 | (u >> 6), 128 | (u & 63)]
        WHEN u < 65536 THEN [224 | (u >> 12), 128 | ((u >> 6) & 63), 128 | (u & 63)]
        ELSE [240 | (u >> 18), 128 | ((u >> 12) & 63), 128 | ((u >> 6) & 63), 128 | (u & 63)] END)) AS b FROM codes),
      sized AS (SELECT doc_id, len(b) + 1 AS size, xor(list_reduce(list_concat([4294967295::BIGINT], b),
        lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM bytes, steps)"""

ORACLES = {
    "op4_sharding": f"""WITH {_CRC},
      placed AS (SELECT *, sum(size) OVER w AS up_to, sum(size) OVER () AS total, row_number() OVER w AS nth FROM sized
        WINDOW w AS (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING)),
      cut AS (SELECT *, ((2 * up_to - size) * 8 // (2 * total))::INTEGER AS shard FROM placed)
      SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, nth - min(nth) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard FROM cut""",
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op11_chat_windows": r"""WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
      sized AS (SELECT *, len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\x0b\p{L}\p{N}]')) + 4 AS tokens,
        len('<s>[INST][/INST]</s>') + list_sum(list_transform([role, text],
          lambda x: length(replace(x, '\', '\')) + len(regexp_extract_all(x, '</?s>|\[/?INST\]')))) AS chars FROM said),
      line AS (SELECT *, coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER w - 1 AS nth,
        CASE WHEN first_value(role) OVER w = 'system' THEN first_value(tokens) OVER w END AS head FROM sized
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
      started AS (SELECT *, head IS NOT NULL AND nth = 0 AS is_head, greatest(1024 - 256 - coalesce(head, 0), 1) AS cell_size,
        CASE WHEN is_head THEN 0 ELSE before - coalesce(head, 0) END AS start FROM line),
      placed AS (SELECT *, 2 * (start // cell_size) + CASE WHEN NOT is_head AND start % cell_size > 0
        AND (start + tokens - 1) // cell_size > start // cell_size THEN 1 ELSE 0 END AS span FROM started),
      spans AS (SELECT conv_id, span, min(start) AS opens, any_value(head) AS head FROM placed GROUP BY conv_id, span),
      members AS (SELECT conv_id, chars FROM placed
        UNION ALL SELECT p.conv_id, p.chars FROM placed p JOIN spans s ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND NOT is_head
          AND s.opens > p.start AND s.opens - p.start <= least(256, p.cell_size)
        UNION ALL SELECT p.conv_id, p.chars FROM placed p JOIN spans s ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND is_head AND s.span > 0),
      written AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM members GROUP BY conv_id),
      digests AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '') AS learned FROM placed GROUP BY conv_id)
      SELECT d.conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars
      FROM digests d JOIN written w ON d.conv_id IS NOT DISTINCT FROM w.conv_id""",
    "op13_merkle_manifest": f"""WITH RECURSIVE {_STEPS},
      numbered AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
        lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) % 7 = 0 AS changed FROM documents, steps),
      said AS (SELECT doc_id, lang, changed, {", ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-') AS {n}" for c, n in (
          ("doc_id", "f1"), ("source", "f2"), ("lang", "f3"), ("n_chars", "f4"), ("(n_chars + 1)", "f4t"), ("text", "f5")))} FROM numbered),
      leaves AS (SELECT doc_id, lang, sha256(f1 || f2 || f3 || f4 || f5) AS leaf,
        sha256(f1 || f2 || f3 || CASE WHEN changed THEN f4t ELSE f4 END || f5) AS given FROM said),
      placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves),
      tree AS (SELECT lang, 0 AS lvl, list(leaf ORDER BY r) AS d FROM placed GROUP BY lang
        UNION ALL SELECT lang, lvl + 1, list_transform(range(0, (len(d) + 1) // 2), lambda i: sha256(d[2 * i + 1] || coalesce(d[2 * i + 2], ''))) FROM tree WHERE len(d) > 1),
      tops AS (SELECT lang, d[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r FROM tree WHERE len(d) = 1),
      crown AS (SELECT 0 AS lvl, list(subroot ORDER BY r) AS d FROM tops
        UNION ALL SELECT lvl + 1, list_transform(range(0, (len(d) + 1) // 2), lambda i: sha256(d[2 * i + 1] || coalesce(d[2 * i + 2], ''))) FROM crown WHERE len(d) > 1),
      inner_steps AS (SELECT p.lang, p.r, list(CASE WHEN (r >> lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(d[xor(r >> lvl, 1) + 1], '') ORDER BY lvl) AS s
        FROM placed p JOIN tree t ON p.lang IS NOT DISTINCT FROM t.lang AND len(d) > 1 GROUP BY p.lang, p.r),
      top_steps AS (SELECT lang, list(CASE WHEN (r >> lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(d[xor(r >> lvl, 1) + 1], '') ORDER BY lvl) AS s
        FROM tops, crown WHERE len(d) > 1 GROUP BY lang),
      ways AS (SELECT p.*, subroot, (SELECT d[1] FROM crown WHERE len(d) = 1) AS root, list_concat(coalesce(i.s, []), coalesce(o.s, [])) AS s FROM placed p
        JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang LEFT JOIN inner_steps i ON p.lang IS NOT DISTINCT FROM i.lang AND p.r = i.r
        LEFT JOIN top_steps o ON p.lang IS NOT DISTINCT FROM o.lang)
      SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_concat([''], list_transform(s, lambda x: x[2:])), 'string_agg', '')) AS proof_sha256,
        list_reduce(list_concat([given], s), lambda a, x: CASE WHEN x[1] = 'L' THEN sha256(x[2:] || a) ELSE sha256(a || x[2:]) END) AS folded_root,
        list_reduce(list_concat([given], s), lambda a, x: CASE WHEN x[1] = 'L' THEN sha256(x[2:] || a) ELSE sha256(a || x[2:]) END) = root AS verified
      FROM ways""",
}
