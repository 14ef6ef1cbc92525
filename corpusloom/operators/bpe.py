"""Learning a byte-level byte-pair encoding.

Words live in Spark as strings of one private-use character per symbol. A round takes the best pairs, cuts the words at
all others, and has hundreds or thousands of merges follow from the distinct pieces, whose number is bounded; then all words are
merged at once. The driver sees the best pairs and the pieces of each round, both bounded by parameters, and the vocabulary,
which its size parameter bounds.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.binding import bind
from corpusloom.scratch import settle

# Fixed values.
SPECIAL_TOKENS = ["<pad>", "<s>", "</s>", "<unk>", "<mask>"]
EXTRA_IDS = [f"<extra_id_{i}>" for i in range(100)]
_SPACE = r"\s\x0b\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

_FIRST_SYMBOL = 0xF0000  # start of the two private-use planes
_MAX_SYMBOLS = 0x20000
_HOT_PAIRS = 16_384  # best pairs of a round, at first
_MAX_PIECES = 200_000  # distinct pieces that the driver gets in a round; more halve the pairs
_PIECE_SYMBOLS = 4_000_000  # and symbols in them
_FEW_MERGES = 400  # up to which a batch of words is merged one pair after the other


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself if it is visible Latin-1,
    otherwise the next free one from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def pretokenize(text: Column) -> Column:
    """Words of a text, each with its leading space; a space is put in front if there is none."""
    starts_blank = text.rlike(rf"\A[{_SPACE}]")
    prefixed = F.when(starts_blank, text).otherwise(F.concat(F.lit(" "), text))
    return F.regexp_extract_all(prefixed, F.lit(WORD_PATTERN), F.lit(0))


def byte_symbols(word: Column) -> Column:
    """The word's UTF-8 bytes, one printable character each."""
    one_char_per_byte = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    moved = {chr(b): s for b, s in byte_alphabet().items() if chr(b) != s}
    return F.translate(one_char_per_byte, "".join(moved), "".join(moved.values()))


def symbols_to_text(symbols: Column) -> Column:
    """The inverse of ``byte_symbols``; bytes that are no UTF-8 become replacement characters."""
    moved = {s: chr(b) for b, s in byte_alphabet().items() if chr(b) != s}
    latin = F.translate(symbols, "".join(moved), "".join(moved.values()))
    return F.decode(F.encode(latin, "ISO-8859-1"), "UTF-8")


def pretoken_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, c)`` over all texts."""
    words = df.select(F.explode(pretokenize(F.col(text))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("c"))


def symbol_pair_counts(words: DataFrame, symbols: str = "symbols", weight: str = "c") -> DataFrame:
    """``(pair, c, longest)``: weighted count of each adjacent pair of one-character symbols, and
    the largest count of a triple that contains it."""
    chars = F.length(symbols)
    starts = words.filter(chars > 1).select(symbols, weight, F.explode(F.sequence(F.lit(1), chars - 1)).alias("i"))
    # Every position gives the pair that starts there with, except at the end, one symbol more.
    gram = F.substring(F.col(symbols), F.col("i"), F.lit(3)).alias("gram")
    counted = starts.select(gram, weight).groupBy("gram").agg(F.sum(weight).alias("c"))
    triple = F.when(F.length("gram") == 3, F.col("c")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.substring("gram", 1, 2).alias("pair"), F.col("c").alias("c"), triple.alias("t")),
        F.struct(F.substring("gram", 2, 2).alias("pair"), F.lit(0).cast("bigint").alias("c"), triple.alias("t")),
    )
    split = counted.select(F.inline(sides)).filter(F.length("pair") == 2)
    return split.groupBy("pair").agg(F.sum("c").alias("c"), F.max("t").alias("longest"))


@dataclass(frozen=True)
class Tokenizer:
    """Tables ``vocab(token, id)`` and ``merges(rank, left, right)``."""

    vocab: DataFrame
    merges: DataFrame


def _symbol(i: int) -> str:
    return chr(_FIRST_SYMBOL + i)


def adjacent_pairs(words: DataFrame, symbols: str = "symbols", weight: str = "c") -> DataFrame:
    """``(pair, c)``: weighted count of each adjacent pair of one-character symbols."""
    chars = F.length(symbols)
    starts = words.where(chars > 1).select(symbols, weight, F.explode(F.sequence(F.lit(1), chars - 1)).alias("i"))
    return starts.select(F.substring(F.col(symbols), F.col("i"), F.lit(2)).alias("pair"), weight).groupBy("pair").agg(F.sum(weight).alias("c"))


def hot_pieces(words: DataFrame, hot: Sequence[str], symbols: str = "symbols") -> DataFrame:
    """``(piece, c)``: the distinct longest runs of symbols whose adjacent pairs are all ``hot``."""
    codes = np.array([ord(a) << 21 | ord(b) for a, b in hot], dtype=np.int64)
    shared = words.sparkSession.sparkContext.broadcast(np.sort(codes))

    @F.pandas_udf("string")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield _cut(batch, shared.value)

    pieces = words.select(F.explode(F.split(cut(symbols), " ")).alias("piece"), "c").filter(F.length("piece") > 1)
    return pieces.groupBy("piece").agg(F.sum("c").alias("c"))


def _cut(words: pd.Series, hot: np.ndarray) -> pd.Series:
    """The words, which hold neither, with a space between the symbols of a pair that is not ``hot``: one array, parted by line feeds."""
    if words.empty:
        return words
    codes = np.frombuffer("\n".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    left, right = codes[:-1], codes[1:]
    pairs = left << 21 | right
    found = hot[np.minimum(np.searchsorted(hot, pairs), len(hot) - 1)] == pairs
    cold = ~found & (left != ord("\n")) & (right != ord("\n"))
    cut = np.insert(codes, np.flatnonzero(cold) + 1, ord(" "))
    return pd.Series(cut.astype("<u4").tobytes().decode("utf-32-le").split("\n"))


def with_merges(words: DataFrame, merges: dict[str, str]) -> DataFrame:
    """``words`` with the pairs ``merges`` (in order, each to one new symbol) merged, left to right."""
    shared = words.sparkSession.sparkContext.broadcast({pair: (rank, made) for rank, (pair, made) in enumerate(merges.items())})

    @F.pandas_udf("string")
    def merged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made = shared.value
        one_by_one = len(made) <= _FEW_MERGES
        for batch in batches:
            yield _replaced(batch, made) if one_by_one else batch.map(lambda word: _merged(word, made))

    return words.select(merged("symbols").alias("symbols"), "c")


def merge_round(words: DataFrame, made: dict[str, str]) -> DataFrame:
    """The words of more than one symbol after a round's merges; the last may make a symbol that earlier ones have, so it comes by itself."""
    *fresh, (pair, symbol) = made.items()
    merged = with_merges(words, dict(fresh)).select("c", F.replace("symbols", F.lit(pair), F.lit(symbol)).alias("merged"))
    return bind(merged, "symbols", F.col("merged"), lambda word: F.length(word) > 1).select("symbols", "c")


def _replaced(words: pd.Series, merges: dict[str, tuple[int, str]]) -> pd.Series:
    """What ``_merged`` gives for each word, for few merges: one after the other, in all words at once."""
    if words.empty:
        return words
    text = "\n".join(words)
    for pair, (_, made) in merges.items():
        text = text.replace(pair, made)
    return pd.Series(text.split("\n"))


def _merged(word: str, merges: dict[str, tuple[int, str]]) -> str:
    """Pairs of the lowest rank first and of these the leftmost, over a linked list of symbols and a heap of pairs."""
    heap = [(*merges[pair], i) for i in range(len(word) - 1) if (pair := word[i:i + 2]) in merges]
    if not heap:
        return word
    heapify(heap)
    n, parts = len(word), list(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        rank, made, i = heappop(heap)
        j = after[i]
        if not parts[i] or j >= n or merges.get(parts[i] + parts[j], (-1,))[0] != rank:
            continue
        parts[i], parts[j] = made, ""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and right < n and (new := merges.get(parts[left] + parts[right])) is not None:
                heappush(heap, (*new, left))
    return "".join(parts)


def merges_while_hot(
    pieces: list[tuple[str, int]], last: tuple[int, str], names: list[str], ids: dict[str, int], room: int, min_frequency: int
) -> list[str]:
    """The pairs that one-at-a-time merging takes from here while the best is no worse than ``last`` (count, pair).

    Counts of pairs only fall, and a pair with a new symbol is no more frequent than the one it grew from; among equals it
    comes after it, as new symbols have larger ids. So pairs worse than ``last``, at which the pieces were cut, neither come up nor lead to
    one that does, and all others are counted in full. Only where merged text is a token already may older pairs
    gain: there the run ends.
    """
    words = [p for p, _ in pieces]
    counts, where = defaultdict(int), defaultdict(set)
    for n, (word, c) in enumerate(pieces):
        for i in range(len(word) - 1):
            counts[word[i:i + 2]] += c
            where[word[i:i + 2]].add(n)
    heap = [(-c, pair) for pair, c in counts.items()]
    heapify(heap)
    chosen, end = [], (-last[0], last[1])
    while heap and room > 0:
        best = heappop(heap)
        pair, c = best[1], -best[0]
        if counts[pair] != c:
            if counts[pair] > 0:
                heappush(heap, (-counts[pair], pair))
            continue
        if best > end or c < max(1, min_frequency):
            break
        chosen.append(pair)
        text = names[ord(pair[0]) - _FIRST_SYMBOL] + names[ord(pair[1]) - _FIRST_SYMBOL]
        if text in ids:
            break
        made = _symbol(len(names))
        ids[text] = len(names)
        names.append(text)
        room -= 1
        grown = set()
        for n in where.pop(pair):
            old, weight = words[n], pieces[n][1]
            if pair not in old:
                continue
            words[n] = new = old.replace(pair, made)
            for i in range(len(old) - 1):
                counts[old[i:i + 2]] -= weight
            for i in range(len(new) - 1):
                two = new[i:i + 2]
                counts[two] += weight
                if made in two:
                    where[two].add(n)
                    grown.add(two)
        for two in grown:
            heappush(heap, (-counts[two], two))
    return chosen


def train_bpe(
    df: DataFrame, vocab_size: int = 32_000, min_frequency: int = 2, text: str = "text",
    special_tokens: list[str] = SPECIAL_TOKENS,
) -> Tokenizer:
    """Learn merges: always the most frequent pair, ties to the lower left, then right id.

    A round is three passes over the distinct words: count the pairs, cut the words at all but the best, merge. It takes every merge
    that the best pairs lead to, so tens of rounds learn tens of thousands of merges. Null texts have no words.
    """
    if vocab_size > _MAX_SYMBOLS:
        raise ValueError(f"vocab_size must not exceed {_MAX_SYMBOLS}")
    spark = df.sparkSession
    words = settle(pretoken_counts(df, text).select(byte_symbols(F.col("word")).alias("symbols"), "c"))
    alphabet = sorted(r[0] for r in words.select(F.explode(F.split("symbols", ""))).distinct().collect() if r[0])
    names = [*special_tokens, *alphabet]  # at most 256 symbols follow the special tokens
    ids = {name: i for i, name in enumerate(names)}
    coded = F.translate("symbols", "".join(alphabet), "".join(_symbol(ids[a]) for a in alphabet))
    # Distinct words only, so this moves little; one small file would keep one core busy.
    words = settle(words.select(coded.alias("symbols"), "c").filter(F.length("symbols") > 1).repartition("symbols"))

    merges, n_hot = [], _HOT_PAIRS
    while len(names) < vocab_size:
        best = [(r["c"], r["pair"]) for r in adjacent_pairs(words).orderBy(F.desc("c"), "pair").limit(n_hot).collect()]
        best = [b for b in best if b[0] >= max(1, min_frequency)]
        if not best:
            break
        pieces = None
        while True:  # one pair alone leaves runs of two symbols, of few lengths
            hot = [pair for _, pair in best]
            # Fewer pairs cut the pieces that more of them left, which are fewer and shorter than the words.
            pieces = settle(hot_pieces(words, hot) if pieces is None else hot_pieces(pieces, hot, "piece"))
            n, symbols = pieces.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("piece")), F.lit(0))).first()
            if len(best) == 1 or n <= _MAX_PIECES and symbols <= _PIECE_SYMBOLS:
                break
            n_hot = max(1, len(best) // 2)
            best = best[:n_hot]
        chosen = merges_while_hot([tuple(r) for r in pieces.collect()], best[-1], names, ids, vocab_size - len(names), min_frequency)
        made = {}
        for pair in chosen:
            left, right = (names[ord(ch) - _FIRST_SYMBOL] for ch in pair)
            merges.append((len(merges), left, right))
            made[pair] = _symbol(ids[left + right])
        words = settle(merge_round(words, made))
        n_hot = min(_HOT_PAIRS, 2 * n_hot)
    vocab = spark.createDataFrame(list(ids.items()), "token string, id int")
    return Tokenizer(vocab, spark.createDataFrame(merges, "rank int, left string, right string"))


def special_vocab(vocab: DataFrame, added: list[str] = EXTRA_IDS) -> DataFrame:
    """The vocabulary with more special tokens appended, numbered from its size."""
    size = vocab.agg(F.max("id") + 1).scalar()
    extra = vocab.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(t) for t in added])).alias("pos", "token")
    )
    return vocab.unionByName(extra.select("token", (F.col("pos") + size).cast("int").alias("id")))
