"""Applying a learned encoding and laying out model inputs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.sliced import by_slices
from corpusloom.operators.bpe import SPECIAL_TOKENS, Tokenizer, byte_alphabet, pretokenize, symbols_to_text

PAD, BOS, EOS, UNK = SPECIAL_TOKENS[:4]
_REMEMBERED = 50_000  # words of a task


def merge_word(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge adjacent symbols, those of the lowest rank first and of these the leftmost.

    The symbols form a linked list and the pairs a heap, so a word of n symbols takes n log n steps. Entries of
    the heap whose symbols have since changed are passed over.
    """
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
    heapify(heap)
    alive = [True] * n
    while heap:
        rank, i = heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ranks.get((parts[i], parts[j])) != rank:
            continue
        parts[i] += parts[j]
        alive[j] = False
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and right < n and (new := ranks.get((parts[left], parts[right]))) is not None:
                heappush(heap, (new, left))
    return [p for p, on in zip(parts, alive) if on]


def encode_bpe(
    df: DataFrame, tokenizer: Tokenizer, columns: dict[str, str], special_tokens: list[str] = SPECIAL_TOKENS
) -> DataFrame:
    """Add columns of ids: ``columns`` maps text columns to the names of their id columns.

    A map-only job: splitting into words stays in the JVM, merges travel to the executors once
    (their number is bounded by the vocabulary size), and each task remembers the words it has
    encoded. Nothing is shuffled, so frequent words cannot skew anything. A task holds the words of one slice of
    a batch and at most 50,000 remembered ones, whatever the size of its input. Special tokens in a
    text stay whole.
    """
    ids = {r["token"]: r["id"] for r in tokenizer.vocab.collect()}
    ranks = {(r["left"], r["right"]): r["rank"] for r in tokenizer.merges.collect()}
    known = [t for t in special_tokens if t in ids]
    shared = df.sparkSession.sparkContext.broadcast((ids, ranks, set(known), byte_alphabet()))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, ranks, special, alphabet = shared.value
        unknown = ids.get("<unk>")
        seen = {}  # of the task

        def word_ids(word):
            if word in special:
                return [ids[word]]
            parts = merge_word([alphabet[b] for b in word.encode("utf-8")], ranks)
            return [i for i in (ids.get(p, unknown) for p in parts) if i is not None]

        def of(words):
            if words is None:
                return None
            out = []
            for w in words:
                if w not in seen:
                    if len(seen) >= _REMEMBERED:
                        seen.clear()
                    seen[w] = word_ids(w)
                out.extend(seen[w])
            return out

        yield from by_slices(batches, of, pa.list_(pa.int32()))

    return df.withColumns({name: encode(_pieces(F.col(text), known)) for text, name in columns.items()})


def _pieces(text: Column, special: list[str]) -> Column:
    """Words of a text with special tokens as words of their own."""
    if not special:
        return pretokenize(text)
    any_special = "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True))
    # Looking at one character first: every special token would be tried in front of and behind each character of the text.
    first, last = ("".join(sorted({re.escape(t[at]) for t in special})) for at in (0, -1))
    runs = F.array_remove(F.split(text, f"(?=[{first}])(?={any_special})|(?<=[{last}])(?<={any_special})"), "")
    words = lambda run: F.when(run.isin(special), F.array(run)).otherwise(pretokenize(run))
    return F.flatten(F.transform(runs, words))


def decode_ids(df: DataFrame, tokenizer: Tokenizer, ids: str, name: str) -> DataFrame:
    """Add the text of an id column. Special tokens are left out, and the space that encoding
    puts in front of a text stays."""
    by_id = [r["token"] for r in tokenizer.vocab.orderBy("id").collect()]
    visible = [None if t in SPECIAL_TOKENS else t for t in by_id]
    table = df.sparkSession.sparkContext.broadcast(visible)

    @F.arrow_udf("string")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = table.value
        yield from by_slices(batches, lambda row: None if row is None else "".join(tokens[i] or "" for i in row), pa.string())

    return df.withColumn(name, symbols_to_text(joined(F.col(ids))))


def frame_template(a: Column, b: Column | None = None, bos: int = 1, eos: int = 2) -> Column:
    """``<s> A </s>`` or ``<s> A </s> </s> B </s>`` on id arrays."""
    start, end = F.array(F.lit(bos)), F.array(F.lit(eos))
    return F.concat(start, a, end) if b is None else F.concat(start, a, end, end, b, end)


def truncate_frame(ids: Column, max_len: int, bos: int = 1, eos: int = 2) -> Column:
    """Cut so that the framed sequence has at most ``max_len`` ids."""
    return frame_template(F.slice(ids, 1, max_len - 2), bos=bos, eos=eos)


def pad_to(ids: Column, length: int, value: int = 0) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(F.lit(length) - F.size(ids), F.lit(0))))


def model_inputs(
    df: DataFrame, input_ids: str, target_ids: str, max_input: int, max_target: int, pad: bool, pad_id: int = 0
) -> DataFrame:
    """``input_ids, attention_mask, labels`` from two columns of ids.

    Pre-training cuts at 512/256 and leaves the lengths alone; fine-tuning cuts at 256/64 and pads
    to these lengths. Padding in the labels is the pad id itself.
    """
    inputs = truncate_frame(F.col(input_ids), max_input)
    labels = truncate_frame(F.col(target_ids), max_target)
    framed = df.withColumns({
        "input_ids": inputs,
        "attention_mask": F.array_repeat(F.lit(1), F.size(inputs)),
        "labels": labels,
    })
    if not pad:
        return framed
    return framed.withColumns({
        "input_ids": pad_to(F.col("input_ids"), max_input, pad_id),
        "attention_mask": pad_to(F.col("attention_mask"), max_input),
        "labels": pad_to(F.col("labels"), max_target, pad_id),
    })
