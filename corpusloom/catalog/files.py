"""Readers and writers: tables written to files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.codes import ORACLES as CODE_ORACLES, java_files, python_files
from corpusloom.catalog.common import TURN_SEQS, document_sequences, documents, turn_sequences, windows_sql
from corpusloom.catalog.ngrams import K, ORDERS, ORACLES as NGRAM_ORACLES, nll_sql
from corpusloom.catalog.texts import ORACLES as TEXT_ORACLES, _evaluate
from corpusloom.operators.ngram_counts import pair_counts
from corpusloom.operators.ngram_scores import best_order
from corpusloom.operators.python_code import decode_utf8_ignore, extract_python_functions
from corpusloom.operators.sequences import load_sequences
from corpusloom.plans.from_files import sequences_from_csv
from corpusloom.plans.java_corpus import METHOD_COLUMNS
from corpusloom.plans.ngram_experiment import test_perplexity, validation_sweep
from corpusloom.scratch import scratch_path
from corpusloom.sources.escaped_csv import read_escaped_csv, write_escaped_csv
from corpusloom.sources.quoted_csv import read_quoted_csv, write_quoted_csv
from corpusloom.sources.tables import read_table
from corpusloom.sources.results import write_best_config, write_eval_csv, write_function_csv, write_metrics
from corpusloom.sources.trees import commit_files, read_repo_list, scan_source_tree, source_texts
from corpusloom.streaming.counts import read_streamed_counts, stream_pair_counts


def _awkward(spark, sf):
    """Texts with every character the escaped form must protect."""
    mixed = F.concat("text", F.lit(', "q" \\ \r\n'), "lang", F.lit("\r,\n"), "source")
    return documents(spark, sf).select("doc_id", mixed.alias("text"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("lang"))


def _escaped(spark, sf):
    path = scratch_path(spark, "escaped")
    write_escaped_csv(_awkward(spark, sf), path)
    back = read_escaped_csv(spark, path, required=["text"])
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


def _escaped_headers(spark, sf):
    """One column with records that are empty, null or equal to the header: all come back."""
    path = scratch_path(spark, "headers")
    kind = F.col("doc_id") % 5
    text = F.when(kind == 0, "text").when(kind == 1, "").when(kind == 2, None).otherwise(F.col("text"))
    write_escaped_csv(documents(spark, sf, "doc_id", "text").select(text.alias("text")), path)
    return read_escaped_csv(spark, path, required=["text"]).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def _escaped_tokens(spark, sf):
    """Token lists through the file, as training reads them."""
    path = scratch_path(spark, "tokens")
    tokens = F.regexp_replace("text", "[ \n]+", ", ")
    write_escaped_csv(documents(spark, sf, "doc_id", "text").select("doc_id", tokens.alias("code_tokens")), path)
    rows = read_escaped_csv(spark, path, required=["code_tokens"])
    seqs = load_sequences(rows.withColumn("id", F.col("doc_id").cast("bigint")), "id")
    return seqs.select("seq_id", F.array_join("tokens", "|").alias("tokens"))


def _csv_perplexity(spark, sf):
    """Training and test sequences through method CSVs, then the perplexity of the test set."""
    folders = []
    for name, table, key in (("train", documents(spark, sf, "doc_id", "text"), "doc_id"), ("test", read_table(spark, sf, "benchmark"), "item_id")):
        tokens = F.regexp_replace("text", "[ \t\r\n]+", ", ")
        blank = {c: F.lit("") for c in METHOD_COLUMNS if c not in ("code_tokens", "file_path")}
        rows = table.select(F.col(key).cast("string").alias("file_path"), tokens.alias("code_tokens")).withColumns(blank)
        folders.append(scratch_path(spark, name))
        write_escaped_csv(rows.select(*METHOD_COLUMNS), folders[-1])
    train, test = (sequences_from_csv(spark, f) for f in folders)
    found = test_perplexity(train, test, ORDERS, K)
    return found.select("n", F.round(F.ln("perplexity"), 6).alias("mean_nll"))


def _quoted(spark, sf):
    path = scratch_path(spark, "quoted")
    write_quoted_csv(_awkward(spark, sf).withColumn("text", F.replace("text", F.lit("\r"), F.lit(""))), path)
    return read_quoted_csv(spark, path, "doc_id bigint, text string, lang string")


def _tree(spark, sf):
    """Documents written as one folder of files per source, then scanned: bytes per repository."""
    path = scratch_path(spark, "tree")
    documents(spark, sf, "source", "text", "doc_id").select("source", "text").write.partitionBy("source").text(path)
    files = source_texts(scan_source_tree(spark, path, "*.txt"))
    return files.groupBy("repo").agg(F.sum(F.length("text")).alias("n_chars"))


def _decode(spark, sf):
    """Bytes that are no UTF-8 put in front, between and behind."""
    bad = F.unhex(F.lit("FFC3"))
    content = F.concat(bad, F.encode("text", "UTF-8"), bad, F.encode("lang", "UTF-8"), bad)
    return documents(spark, sf, "doc_id", "text", "lang").select("doc_id", decode_utf8_ignore(content).alias("text"))


def _repo_list(spark, sf):
    path = scratch_path(spark, "repos")
    url = F.concat(F.lit("git@host.net:"), "source", F.lit("/d"), "doc_id", F.lit(".git"))
    documents(spark, sf, "doc_id", "source").select(url.alias("value")).write.text(path)
    return read_repo_list(spark, path)


def _commit_files(spark, sf):
    files = commit_files(java_files(spark, sf).drop("repo_name"))
    return files.select("repo_name", "commit_seq", "file_path")


def _metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    write_metrics(validation_sweep(document_sequences(spark, sf), ORDERS, K), path)
    back = read_quoted_csv(spark, path, "N int, validation_perplexity double")
    return back.select("N", F.round(F.ln("validation_perplexity"), 6).alias("mean_nll"))


def _best_config(spark, sf):
    path = scratch_path(spark, "best")
    results = validation_sweep(document_sequences(spark, sf), ORDERS, K)
    write_best_config(best_order(results, ORDERS), K, path)
    return spark.read.schema("N int, k double").json(path)


def _eval_csv(spark, sf):
    path = scratch_path(spark, "evaluated")
    evaluated = _evaluate(spark, sf)
    write_eval_csv(evaluated, path)
    return read_quoted_csv(spark, path, evaluated.schema)


def _function_csv(spark, sf):
    path = scratch_path(spark, "functions")
    functions = extract_python_functions(python_files(spark, sf))
    write_function_csv(functions, path)
    return read_quoted_csv(spark, path, functions.schema)


def _stream(spark, sf):
    """Counts of turns arriving as a stream of files, equal to the batch counts."""
    folder, counts = scratch_path(spark, "arrivals"), scratch_path(spark, "counts")
    turn_sequences(spark, sf).write.parquet(folder)
    arriving = spark.readStream.schema("seq_id bigint, tokens array<string>").option("maxFilesPerTrigger", 4).parquet(folder)
    stream_pair_counts(arriving, 2, counts, scratch_path(spark, "stream")).awaitTermination()
    return read_streamed_counts(spark, counts).select(F.array_join("ctx", " ").alias("ctx"), F.col("next").alias("nxt"), "c")


QUERIES = {
    "escaped_csv_round_trip": _escaped,
    "escaped_csv_headers": _escaped_headers,
    "escaped_csv_sequences": _escaped_tokens,
    "csv_perplexity": _csv_perplexity,
    "quoted_csv_round_trip": _quoted,
    "scan_source_tree": _tree,
    "decode_utf8_ignore": _decode,
    "read_repo_list": _repo_list,
    "read_commit_files": _commit_files,
    "write_metrics": _metrics,
    "write_best_config": _best_config,
    "write_eval_csv": _eval_csv,
    "write_function_csv": _function_csv,
    "stream_pair_counts": _stream,
}

_MIXED = "text || ', \"q\" ' || chr(92) || ' ' || chr(13) || chr(10) || lang || chr(13) || ',' || chr(10) || source"
_LANG = "CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS lang"

def _csv_seqs(name: str, table: str, key: str) -> str:
    toks = r"list_filter(string_split_regex(text, '[ \t\r\n]+|,'), lambda x: x <> '')"
    return f"{name} AS (SELECT {key} AS seq_id, {toks} AS toks FROM {table} WHERE len({toks}) > 0)"


ORACLES = {
    "escaped_csv_round_trip": f"SELECT doc_id, {_MIXED} AS text, {_LANG} FROM documents",
    "escaped_csv_headers": """SELECT CASE doc_id % 5 WHEN 0 THEN 'text' WHEN 1 THEN '' WHEN 2 THEN '' ELSE text END AS text, count(*) AS n
      FROM documents GROUP BY 1""",
    "escaped_csv_sequences": r"""WITH parts AS (SELECT doc_id AS seq_id,
        list_filter(list_transform(string_split_regex(text, '[ \n]+|,'), lambda x: trim(x)), lambda x: x <> '') AS toks FROM documents)
      SELECT seq_id, array_to_string(toks, '|') AS tokens FROM parts WHERE len(toks) > 0""",
    "csv_perplexity": f"""WITH {_csv_seqs('doc_seqs', 'documents', 'doc_id')}, {_csv_seqs('bench_seqs', 'benchmark', 'item_id')},
      {", ".join(nll_sql(f"t{n}", "doc_seqs", "bench_seqs", n, K) for n in ORDERS)}
      {" UNION ALL ".join(f"SELECT n::INTEGER AS n, round(mean_nll, 6) AS mean_nll FROM t{n}" for n in ORDERS)}""",
    "quoted_csv_round_trip": f"SELECT doc_id, replace({_MIXED}, chr(13), '') AS text, {_LANG} FROM documents",
    "scan_source_tree": "SELECT 'source=' || source AS repo, sum(length(text) + 1)::BIGINT AS n_chars FROM documents GROUP BY source",
    "decode_utf8_ignore": "SELECT doc_id, text || lang AS text FROM documents",
    "read_repo_list": """SELECT 'git@host.net:' || source || '/d' || doc_id || '.git' AS repo_url, 'd' || doc_id AS repo,
      source || '/d' || doc_id AS full_name FROM documents""",
    "read_commit_files": """SELECT source AS repo_name, doc_id AS commit_seq, CASE WHEN doc_id % 17 = 0 THEN NULL
      WHEN doc_id % 19 = 0 THEN 'archetype-resources/D.java' ELSE 'src/D' || doc_id || '.java' END AS file_path FROM documents""",
    "write_metrics": f"SELECT n AS \"N\", mean_nll FROM ({NGRAM_ORACLES['ngram_perplexity']})",
    "write_best_config": f"""SELECT n AS "N", 0.1::DOUBLE AS k FROM ({NGRAM_ORACLES['ngram_perplexity']}) ORDER BY mean_nll, n LIMIT 1""",
    "write_eval_csv": TEXT_ORACLES["evaluate_predictions"],
    "write_function_csv": CODE_ORACLES["extract_python_functions"],
    "stream_pair_counts": f"""WITH {TURN_SEQS}, {windows_sql('win', 'turn_seqs', 2)}
      SELECT ctx, nxt, count(*) AS c FROM win GROUP BY ALL""",
}
