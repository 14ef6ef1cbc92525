"""The workflows from path to path, with row ids made at the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.bpe import Tokenizer
from corpusloom.operators.sequences import load_sequences
from corpusloom.plans.java_corpus import mine_java_methods
from corpusloom.plans.ngram_experiment import Selected, run_experiment
from corpusloom.plans.training_examples import finetuning_examples, function_corpus, learn_tokenizer, pretraining_examples
from corpusloom.scratch import scratch_scope, settle
from corpusloom.sources.escaped_csv import read_escaped_csv, write_escaped_csv
from corpusloom.sources.quoted_csv import read_quoted_csv
from corpusloom.sources.results import read_tokenizer_tables, write_function_csv, write_tokenizer_tables
from corpusloom.sources.trees import scan_source_tree


def sequences_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(seq_id, tokens)`` of a method CSV; ids follow the order of the files' records."""
    rows = read_escaped_csv(spark, path, required=["code_tokens"], id_col="_row")
    return load_sequences(rows, "_row")


def mine_to_csv(files: DataFrame, path: str, **options) -> None:
    """Java methods of commit files, in the escaped dialect."""
    write_escaped_csv(mine_java_methods(files, **options), path)


def experiment_from_csv(
    spark: SparkSession, train_path: str, test_path: str, out: str, n_list: Sequence[int] = (3, 5, 7, 11), **options
) -> Selected | None:
    """Sweep, selection, test metric and predictions over two method CSVs, below ``out``."""
    train, test = (settle(sequences_from_csv(spark, p)) for p in (train_path, test_path))
    return run_experiment(train, test, out, n_list, **options)


def functions_to_csv(spark: SparkSession, root: str, path: str, split_type: str = "pretrain", min_lines: int = 3) -> None:
    """Functions of the source trees below ``root``, one row each."""
    write_function_csv(function_corpus(scan_source_tree(spark, root), split_type, min_lines), path)


def functions_from_csv(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    return read_quoted_csv(spark, path, id_col=id_col)


def examples_from_csv(
    spark: SparkSession, path: str, out: str, vocab_size: int = 32_000, min_frequency: int = 2,
    n_rows: int | None = None, seed: int = 42,
) -> Tokenizer:
    """Tokenizer, pre-training and fine-tuning examples of a function CSV, as tables below ``out``."""
    functions = settle(functions_from_csv(spark, path))
    with scratch_scope(spark):
        write_tokenizer_tables(learn_tokenizer(functions, vocab_size, min_frequency), f"{out}/tokenizer")
    tokenizer = read_tokenizer_tables(spark, f"{out}/tokenizer")
    with scratch_scope(spark):
        pretraining_examples(functions, "id", tokenizer, n_rows, seed).write.parquet(f"{out}/pretraining")
        with_ifs = functions.filter("cast(num_if as int) > 0").withColumnRenamed("source", "code")
        finetuning_examples(with_ifs, "id", tokenizer, seed).write.parquet(f"{out}/finetuning")
    return tokenizer
