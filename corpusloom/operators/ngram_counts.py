"""Counting n-grams.

A corpus is a DataFrame ``(seq_id, tokens ARRAY<STRING>)``. Counts come in two forms: with the
context's tokens, for reading, and with its 128-bit key ``(a, b)``, for models of any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.hashing import level_columns, run_key, with_run_levels
from corpusloom.operators.skew import keep_probable
from corpusloom.scratch import settle

BOS = "<BOS>"
EOS = "<EOS>"
_CHUNK = 2048
_COLUMNS = 8  # tokens of a window that are columns of their own when counted


def check_order(n: int) -> None:
    if n < 2:
        raise ValueError("an n-gram model needs n of at least 2")


def ngram_windows(seqs: DataFrame, n: int) -> DataFrame:
    """One row ``(n, ctx, next)`` per token and one for the end of each sequence."""
    check_order(n)
    padded = seqs.withColumn(
        "_padded",
        F.concat(F.array_repeat(F.lit(BOS), n - 1), "tokens", F.array(F.lit(EOS))),
    )
    window = lambda i: F.struct(
        F.slice("_padded", i, n - 1).alias("ctx"),
        F.element_at("_padded", i + (n - 1)).alias("next"),
    )
    windows = F.transform(F.sequence(F.lit(1), F.size("_padded") - (n - 1)), window)
    return padded.select("seq_id", F.lit(n).alias("n"), F.inline(windows))


def pair_counts(seqs: DataFrame, n: int) -> DataFrame:
    """``(n, ctx, next, c)``: how often each token follows each context."""
    if n > _COLUMNS:
        return ngram_windows(seqs, n).groupBy("n", "ctx", "next").agg(F.count(F.lit(1)).alias("c"))
    counts = _token_columns(seqs, n).groupBy(*[f"_t{i}" for i in range(n)]).agg(F.count(F.lit(1)).alias("c"))
    return counts.select(F.lit(n).alias("n"), _context(n), F.col(f"_t{n - 1}").alias("next"), "c")


def context_counts(pairs: DataFrame) -> DataFrame:
    """``(n, ctx, c)`` or ``(n, a, b, c)`` from pair counts; no second pass over the corpus."""
    keys = [k for k in ("n", "ctx", "a", "b") if k in pairs.columns]
    return pairs.groupBy(*keys).agg(F.sum("c").alias("c"))


def window_context_counts(seqs: DataFrame, n: int) -> DataFrame:
    """``(n, ctx, c)`` straight from the windows, where pair counts are not needed: only contexts are shuffled."""
    if n > _COLUMNS:
        return ngram_windows(seqs, n).groupBy("n", "ctx").agg(F.count(F.lit(1)).alias("c"))
    counts = _token_columns(seqs, n).groupBy(*[f"_t{i}" for i in range(n - 1)]).agg(F.count(F.lit(1)).alias("c"))
    return counts.select(F.lit(n).alias("n"), _context(n), "c")


def _token_columns(seqs: DataFrame, n: int) -> DataFrame:
    """The windows of ``ngram_windows`` with a column for each token: cheaper to make and to group than arrays."""
    check_order(n)
    padded = F.concat(F.array_repeat(F.lit(BOS), n - 1), "tokens", F.array(F.lit(EOS)))
    places = seqs.select(padded.alias("_padded"), F.size("tokens").alias("_size")).select(
        "_padded", F.explode(F.sequence(F.lit(0), "_size")).alias("_at")
    )
    return places.select(*[F.get("_padded", F.col("_at") + F.lit(i)).alias(f"_t{i}") for i in range(n)])


def _context(n: int) -> Column:
    return F.array(*[f"_t{i}" for i in range(n - 1)]).alias("ctx")


def vocabulary(seqs: DataFrame) -> DataFrame:
    """Distinct tokens with the two markers, whatever the corpus holds."""
    markers = F.array(F.lit(BOS), F.lit(EOS))
    # One marker row, derived from the corpus-independent range so that an empty corpus has it too.
    always = seqs.sparkSession.range(1).select(F.explode(markers).alias("token"))
    return seqs.select(F.explode("tokens").alias("token")).union(always).distinct()


def merge_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of two corpora added up; training is additive, so this continues training."""
    keys = [c for c in left.columns if c != "c"]
    return left.unionByName(right).groupBy(*keys).agg(F.sum("c").alias("c"))


def keyed_windows(
    seqs: DataFrame, n_list: Sequence[int], keep: Sequence[str] = (), part: int = 0, parts: int = 1
) -> DataFrame:
    """Windows of every order in ``n_list`` from one scan: ``(*keep, n, a, b, next)``.

    Texts are cut into overlapping chunks first, so the arrays held per row stay small however
    long a text is. With ``parts``, only windows whose context ends with a token of that part, before keys are made.
    """
    for n in n_list:
        check_order(n)
    orders = sorted(set(n_list))
    pad = orders[-1] - 1
    padded = seqs.select(
        *keep, F.concat(F.array_repeat(F.lit(BOS), pad), "tokens", F.array(F.lit(EOS))).alias("_padded")
    )
    last = F.floor((F.size("_padded") - pad - 1) / _CHUNK).cast("int")
    chunks = padded.select(
        *keep,
        F.explode(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.slice("_padded", i * _CHUNK + 1, _CHUNK + pad),
            )
        ).alias("_chunk"),
    )
    levelled = with_run_levels(chunks, "_chunk", pad)
    # Places are rows before keys are made: what is computed on rows is compiled, what is computed inside arrays is not.
    places = levelled.select(
        *keep, "_chunk", *level_columns(pad),
        F.explode(F.sequence(F.lit(0), F.size("_chunk") - pad - 1)).alias("_at"),
    )
    if parts > 1:  # not by a key: Spark would make it again below, to see that it is not null
        places = places.filter(F.pmod(F.xxhash64(F.get("_chunk", F.col("_at") + F.lit(pad - 1))), F.lit(parts)) == part)
    at, target = F.col("_at"), F.get("_chunk", F.col("_at") + F.lit(pad))
    of_order = lambda n: [
        F.lit(n).alias("n"), *[run_key(lane, at + F.lit(pad - n + 1), n - 1).alias(lane) for lane in ("a", "b")], target.alias("next")
    ]
    if len(orders) == 1:
        return places.select(*keep, *of_order(orders[0]))
    return places.select(*keep, F.inline(F.array(*[F.struct(*of_order(n)) for n in orders])))


@dataclass(frozen=True)
class NgramModel:
    """Count tables of one order: ``pairs(a, b, next, c)``, ``contexts(a, b, c)``, ``vocab(token)``."""

    n: int
    k: float
    pairs: DataFrame
    contexts: DataFrame
    vocab: DataFrame

    def settled(self) -> NgramModel:
        """The same model with its tables written out, for use in many later jobs."""
        pairs = settle(self.pairs)
        contexts = settle(context_counts(pairs))
        return NgramModel(self.n, self.k, pairs, contexts, settle(self.vocab))


def train(seqs: DataFrame, n: int, k: float) -> NgramModel:
    windows = keyed_windows(seqs, [n])
    pairs = windows.groupBy("a", "b", "next").agg(F.count(F.lit(1)).alias("c"))
    return NgramModel(n, k, pairs, context_counts(pairs), vocabulary(seqs))


def train_for(seqs: DataFrame, n: int, k: float, wanted: DataFrame) -> NgramModel:
    """``train(...).settled()`` for a known set of contexts: only their windows are shuffled and written.

    ``wanted`` is ``(a, b)``, repeats allowed. Counts of these contexts are whole and the vocabulary is that of all
    sequences; of other contexts the model has few or none, so it serves no generation.
    """
    wanted = settle(wanted.select("a", "b").distinct())
    windows = keep_probable(keyed_windows(seqs, [n]), wanted, ["a", "b"], wanted.count())
    pairs = windows.groupBy("a", "b", "next").agg(F.count(F.lit(1)).alias("c"))
    return NgramModel(n, k, pairs, context_counts(pairs), vocabulary(seqs)).settled()


def continue_training(model: NgramModel, seqs: DataFrame) -> NgramModel:
    """The model with the counts of more sequences added."""
    more = train(seqs, model.n, model.k)
    pairs = merge_counts(model.pairs, more.pairs)
    vocab = model.vocab.union(more.vocab).distinct()
    return NgramModel(model.n, model.k, pairs, context_counts(pairs), vocab)
