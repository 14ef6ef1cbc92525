"""Scores of whole texts under a subword model that sums over all segmentations, beside a word model.

A text is its words, then an end. Pieces never reach over a word's end, so a text's probability is the
product of its words', and every distinct word is worked on once for the whole corpus. The words that occur
most, a fixed number, are looked up from a broadcast table; the others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_rows import slices, small_batches
from corpusloom.llm.columns import fresh, quoted
from corpusloom.llm.lattice import Lattice, Vocabulary
from corpusloom.scratch import settle

HEAD_WORDS = 100_000  # most words that are broadcast,
HEAD_BYTES = 48  # and the longest of them: 5 MB of text at most
WORDS_AT_ONCE = 50_000
PRIOR_USES = 0.01  # pieces that the vocabulary's own probabilities count for, for each piece of it
LOG10 = math.log(10)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def count_words(df: DataFrame, text_col: str, learns: Column) -> DataFrame:
    """``word, c`` (in texts that are learned from), ``uses`` (in all); counted in tasks before they move."""
    rows = df.select(F.coalesce(learns, F.lit(False)).alias("learns"), F.col(quoted(text_col)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, other = Counter(), Counter()

        def flush():
            for counts, known in ((learned, True), (other, False)):
                n = pa.array(counts.values(), pa.int64())
                c = n if known else pa.array(np.zeros(len(counts), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()), c, n], names=["word", "c", "uses"])
                counts.clear()

        for batch in slices(batches):
            for learn, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                (learned if learn else other).update(words_of(text.as_py()))
            if len(learned) + len(other) > WORDS_AT_ONCE:
                yield from flush()
        yield from flush()

    return rows.mapInArrow(run, "word string, c long, uses long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("uses").alias("uses"))


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def expected_uses(words: DataFrame, path: str, probability: list[float]) -> np.ndarray:
    """Expected uses of every piece in the counted words. The driver gets one number for each piece of the vocabulary."""
    sent = words.sparkSession.sparkContext.broadcast(probability)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, uses = Lattice(_vocabulary(path), sent.value), 0.0
        for batch in batches:
            uses = uses + lattice.expect_many(batch.column(0).to_pylist(), batch.column(1).to_numpy())
        some = np.flatnonzero(uses) if isinstance(uses, np.ndarray) else np.zeros(0, int)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(uses[some] if len(some) else np.zeros(0))], names=["piece", "uses"])

    found = words.where("c > 0").select("word", "c").mapInArrow(run, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
    total = np.zeros(len(probability))
    total[found["piece"].to_numpy(np.int64)] = found["uses"].to_numpy(np.float64)
    return total


def fit(words: DataFrame, n_texts: int, path: str, rounds: int) -> list[float]:
    """Probabilities of the pieces and the end: the vocabulary's, after ``rounds`` of expectation-maximisation."""
    prior = np.array(_vocabulary(path).prior)
    probability = prior
    for _ in range(rounds):
        uses = expected_uses(words, path, probability.tolist())
        uses[-1] = n_texts
        uses += PRIOR_USES * len(prior) * prior
        probability = uses / uses.sum()
    return probability.tolist()


def with_lattice(words: DataFrame, path: str, probability: list[float]) -> DataFrame:
    """``words`` and ``lattice``, the decimal logarithm of each word's probability."""
    sent = words.sparkSession.sparkContext.broadcast(probability)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(_vocabulary(path), sent.value)
        for batch in batches:
            logs = lattice.log_probabilities(batch.column(0).to_pylist()) / LOG10
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(logs, pa.float64())], names=["word", "c", "uses", "lattice"])

    return words.select("word", "c", "uses").mapInArrow(run, "word string, c long, uses long, lattice double")


def _head(words: DataFrame) -> dict[bytes, tuple[float, int, float]]:
    """The words in most use, ``HEAD_WORDS`` at most: log10(c + 0.5), whether known, lattice."""
    short = words.where(F.octet_length("word") <= HEAD_BYTES)
    step = F.floor(F.log2("uses") * 8)
    steps = sorted((r["step"], r["n"]) for r in short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect())
    least, room = math.inf, HEAD_WORDS
    for at, n in reversed(steps):  # some 500 steps for any corpus
        room -= n
        if room < 0:
            break
        least = at
    if least == math.inf:
        return {}
    found = short.where(step >= int(least)).select("word", "c", "lattice").toPandas()
    return {w.encode("utf-8", "surrogatepass"): (math.log10(c + 0.5), int(c > 0), p)
            for w, c, p in zip(found["word"], found["c"].tolist(), found["lattice"].tolist())}


def score_texts(df: DataFrame, path: str, learns: Column, *, text_col: str = "text", carry: Sequence[str] = (), rounds: int = 1) -> DataFrame:
    """The columns ``carry``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` for every row of ``df``.

    Texts have A-Z lower-cased; tokens are the words between ASCII white space, then one end. Rows where ``learns`` is
    true are learned from, whole. ``base_score`` adds ``log10((c + 0.5) / (N + 0.5 (V + 1)))`` over the tokens. ``score`` is the
    decimal logarithm of the text's probability: its words', each over all segmentations into pieces of the vocabulary at
    ``path``, and the end's. Null counts as the empty text, an end alone. With nothing to learn from, the vocabulary's own
    probabilities stand and N and V are 0. Equal texts have equal scores up to the order of sums; an empty table
    gives no rows.

    The corpus is counted in tasks and by shuffle; what the driver gets is bounded by the vocabulary and ``HEAD_WORDS``.
    Other words meet their counts in a join of written tables; words in every text are broadcast unless longer than
    ``HEAD_BYTES``, and then adaptive execution splits their partition.
    """
    spark = df.sparkSession
    with small_batches(spark):
        words = settle(count_words(df, text_col, learns))
    n_texts = df.where(learns).count()
    seen = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n, v = seen[0] + n_texts, seen[1] + (n_texts > 0)
    words = settle(with_lattice(words, path, probability := fit(words, n_texts, path, rounds)))
    head = spark.sparkContext.broadcast(_head(words))
    end = (math.log10(n_texts + 0.5), int(n_texts > 0), math.log10(probability[-1]))

    rows = df.select(*[F.col(quoted(c)) for c in carry], F.col(quoted(text_col)).cast("string").alias("__text"))
    row, n_tokens, n_known, base, score, rare = fresh(
        rows, "row_id", "n_tokens", "n_known", "base_score", "score", "rare")
    pair = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.IntegerType())])
    fields = rows.schema.fields[:-1] + [
        T.StructField(n_tokens, T.LongType()), T.StructField(n_known, T.LongType()), T.StructField(base, T.DoubleType()),
        T.StructField(score, T.DoubleType()), T.StructField(rare, T.ArrayType(pair))]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = head.value.get
        for batch in slices(batches):
            tokens, known, low, high, ends, kept, times = [], [], [], [], [0], [], []
            for text in batch.column(batch.num_columns - 1):
                b, k, s = end
                words = words_of(text.as_py())
                for word, n in Counter(words).items():
                    found = find(word)
                    if found is None:
                        kept.append(word)
                        times.append(n)
                    else:
                        b += n * found[0]
                        k += n * found[1]
                        s += n * found[2]
                tokens.append(len(words) + 1)
                known.append(k)
                low.append(b)
                high.append(s)
                ends.append(len(kept))
            pairs = pa.StructArray.from_arrays([pa.array(kept, pa.binary()).cast(pa.string()), pa.array(times, pa.int32())], ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(low, pa.float64()), pa.array(high, pa.float64()),
                                      pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], names=names)

    with small_batches(spark):
        done = settle(rows.mapInArrow(run, T.StructType(fields)).withColumn(row, F.monotonically_increasing_id()))
    rest = done.select(F.col(quoted(row)).alias("row_id"), F.explode(quoted(rare)).alias("one")).select("row_id", "one.word", "one.n")
    rest = rest.join(words.hint("merge"), "word").groupBy("row_id").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"), F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("b"),
        F.sum(F.col("n") * F.col("lattice")).alias("s"))
    renamed = rest.select(*[F.col(c).alias("__rest_" + c) for c in rest.columns])
    zero = F.lit(0.0)
    return done.join(renamed, F.col(quoted(row)) == F.col("__rest_row_id"), "left").select(
        *[quoted(c) for c in carry], F.col(quoted(n_tokens)).alias("n_tokens"),
        (F.col(quoted(n_known)) + F.coalesce("__rest_k", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col(quoted(base)) + F.coalesce("__rest_b", zero) - F.col(quoted(n_tokens)) * math.log10(n + 0.5 * (v + 1))).alias("base_score"),
        (F.col(quoted(score)) + F.coalesce("__rest_s", zero)).alias("score"))
