"""From rows of functions to encoded training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.operators.bpe import EXTRA_IDS, SPECIAL_TOKENS, Tokenizer, special_vocab, train_bpe
from corpusloom.operators.encoding import encode_bpe, model_inputs
from corpusloom.operators.masking import coalesce_text, mask_if_condition, mask_random_tokens
from corpusloom.operators.python_code import extract_python_functions
from corpusloom.operators.selection import first_n_rows, split_column, three_way_split
from corpusloom.sources.trees import source_texts


def function_corpus(files: DataFrame, split_type: str, min_lines: int = 3) -> DataFrame:
    """Functions of a scanned source tree ``(repo, file, content)``."""
    return extract_python_functions(source_texts(files), split_type, min_lines)


def learn_tokenizer(functions: DataFrame, vocab_size: int = 32_000, min_frequency: int = 2) -> Tokenizer:
    texts = coalesce_text(functions, ("source", "code", "input"), "text").select("text")
    return train_bpe(texts, vocab_size, min_frequency)


def _encoded(masked: DataFrame, tokenizer: Tokenizer, max_input: int, max_target: int, pad: bool) -> DataFrame:
    # The sentinels are tokens of their own, behind the vocabulary learned.
    widened = Tokenizer(special_vocab(tokenizer.vocab), tokenizer.merges)
    encoded = encode_bpe(masked, widened, {"input_text": "_input", "target_text": "_target"}, [*SPECIAL_TOKENS, *EXTRA_IDS])
    return model_inputs(encoded, "_input", "_target", max_input, max_target, pad).drop("_input", "_target")


def pretraining_examples(
    functions: DataFrame, id_col: str, tokenizer: Tokenizer, n_rows: int | None = None, seed: int = 42
) -> DataFrame:
    """First ``n_rows`` rows (``None``: all), split 90/10, then masked at random: ``split, input_ids, attention_mask, labels``."""
    masked = mask_random_tokens(first_n_rows(functions, [id_col], n_rows), id_col, seed=seed)
    # A row's split depends on its id alone, so it may as well be decided after masking.
    masked = split_column(masked, id_col, 0.1, seed, ("train", "test"))
    return _encoded(masked, tokenizer, 512, 256, pad=False).select(
        id_col, "split", "input_ids", "attention_mask", "labels"
    )


def finetuning_examples(functions: DataFrame, id_col: str, tokenizer: Tokenizer, seed: int = 42) -> DataFrame:
    """One masked condition per function, then split 80/10/10; texts are kept for scoring."""
    masked = three_way_split(mask_if_condition(functions, id_col, seed), id_col, seed)
    return _encoded(masked, tokenizer, 256, 64, pad=True).select(
        id_col, "split", "input_text", "target_text", "input_ids", "attention_mask", "labels"
    )
