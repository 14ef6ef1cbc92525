"""A training corpus from raw documents: written in a known language, once each, mixed and encoded.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and returns the rows it keeps with the
columns of ``docs``; the last returns token ids. Columns are told apart by position inside, so further ones of any name pass
through. Nulls count as empty texts, sources of their own and smallest ids, as the operators say; an empty table stays
empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrow_rows import SLICE_ROWS, small_batches
from corpusloom.llm.block_naming import exact_duplicates
from corpusloom.llm.bpe_codec import encode_decode
from corpusloom.llm.mixing import mix_sources
from corpusloom.llm.mixture_langid import learn, predict
from corpusloom.llm.simhash import near_duplicates
from corpusloom.scratch import settle

MAIN_SHARE = 0.4  # of a document's main language
REPEATS = 2.0  # most passes over a source
REMEMBERED = 50_000  # words of a memo of the encoder, whose workers also hold what earlier stages left


def _apart(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """``docs`` under names that clash with none, those names, and the ones of the columns that stages know."""
    names = [f"in_{i}" for i in range(len(docs.columns))]
    known = {}
    for column, name in zip(docs.columns, names):
        if column in ("doc_id", "text", "lang", "source"):
            known[column] = name
    for column, name in zip(docs.columns, names):  # another case, where the usual one is absent
        if column.lower() in ("doc_id", "text", "lang", "source"):
            known.setdefault(column.lower(), name)
    return docs.toDF(*names), names, known


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language: one that takes ``MAIN_SHARE`` of the text or more.

    Languages are learned from the labels of ``docs`` itself. Texts that are null or without a letter go, and texts in which
    several languages have less than that each. Without any label nothing can be told, and all with a letter stay.
    """
    rows, names, known = _apart(docs)
    langs, model = learn(rows, text_col=known["text"], lang_col=known["lang"])
    if not langs:
        return rows.where(F.col(known["text"]).rlike(r"\p{L}")).toDF(*docs.columns)
    found = predict(rows, langs, model, text_col=known["text"], carry=names)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MAIN_SHARE)).select(*names).toDF(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each set of equal texts."""
    rows, names, known = _apart(docs)
    judged = exact_duplicates(rows, id_col=known["doc_id"], text_col=known["text"], carry=names)
    return judged.where("kept").select(*names).toDF(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that SimHash links connect; among repeated ids, one row.

    Links are 4 or fewer differing bits of fingerprints over four-word shingles.
    """
    rows, names, known = _apart(docs)
    rows = settle(rows.withColumn("row_id", F.monotonically_increasing_id()))
    judged = near_duplicates(rows, id_col=known["doc_id"], text_col=known["text"], words_each=4, limit=4, carry=["row_id"])
    kept = settle(judged.groupBy("component_code").agg(F.min(F.struct("doc_id", "row_id")).alias("first")).select("first.row_id"))
    return rows.join(kept.hint("merge"), "row_id", "left_semi").select(*names).toDF(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as they are read: every source in full, small ones up to ``REPEATS`` times."""
    rows, names, known = _apart(docs)
    read = mix_sources(rows, id_col=known["doc_id"], text_col=known["text"], source_col=known["source"], repeats=REPEATS)
    return read.select(*names).toDF(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids`` and ``restored``, whether the ids decode to the text again."""
    rows, names, known = _apart(docs)
    carry = [known["doc_id"], known["source"], known["lang"], known["text"]]
    coded = encode_decode(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, text_col=known["text"], carry=carry, remembered=REMEMBERED)
    coded = coded.select(
        F.col(carry[0]).alias("doc_id"), F.col(carry[1]).alias("source"), F.col(carry[2]).alias("lang"), F.size("ids").cast("long").alias("n_tokens"),
        "ids", (F.col("decoded") == F.coalesce(F.col(carry[3]), F.lit("")).cast("binary")).alias("restored"))
    with small_batches(spark, SLICE_ROWS):  # texts go to Python twice, to be encoded and to be compared
        return settle(coded)


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: SQL has no word for the language model, the fingerprint links or the token ids; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
