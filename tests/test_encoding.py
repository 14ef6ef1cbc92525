import json

import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import encodings
from corpusloom.operators import bpe, encoding
from corpusloom.operators.bpe import SPECIAL_TOKENS
from corpusloom.operators.evaluation import evaluate_predictions, summarize
from corpusloom.plans.training_examples import finetuning_examples, learn_tokenizer, pretraining_examples
from corpusloom.sources.results import read_tokenizer_tables, write_tokenizer_tables

TEXTS = [
    "def f(x):\n    if x > 10:\n        return x\n", "the then there  other\tthe\n\n", "aaaa aaa aa a baaab aaaaaaa",
    "naïve café 日本語 it's we'll 123 4567 --> !!!", "  leading", "trailing   ", "x = y\u00a0z\u3000w", "low lower lowest newer wider the the",
    "abcabc abcab bcabc cab ab bc abc",
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS * 3)), "id int, text string").repartition(3)


def library(size, frequency=2):
    tokenizers = pytest.importorskip("tokenizers")
    made = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<unk>"))
    made.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel()
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=size, min_frequency=frequency, special_tokens=SPECIAL_TOKENS, show_progress=False
    )
    made.train_from_iterator(TEXTS * 3, trainer)
    return made


@pytest.mark.parametrize("size, frequency, hot, pieces", [(130, 2, 3, 1000), (1000, 4, 10_000, 1000), (1000, 2, 40, 5)])
def test_same_as_the_library(spark, corpus, monkeypatch, size, frequency, hot, pieces):
    """The last two end because no pair is frequent enough; the last halves the pairs until few pieces are left."""
    monkeypatch.setattr(bpe, "_HOT_PAIRS", hot)
    monkeypatch.setattr(bpe, "_MAX_PIECES", pieces)
    ours, theirs = bpe.train_bpe(corpus, size, frequency), library(size, frequency)
    model = json.loads(theirs.to_str())["model"]
    assert {r.token: r.id for r in ours.vocab.collect()} == model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    assert [[r.left, r.right] for r in ours.merges.orderBy("rank").collect()] == merges
    masked = ["a <mask> the<mask> then", "<s>x</s>", *TEXTS]
    df = spark.createDataFrame([(t,) for t in masked], "text string")
    got = [r.ids for r in encoding.encode_bpe(df, ours, {"text": "ids"}).collect()]
    assert got == [theirs.encode(t).ids for t in masked]


def test_default_size_on_documents(spark, monkeypatch):
    """Every merge that the words allow, over several rounds, and the ids of all documents."""
    tokenizers = pytest.importorskip("tokenizers")
    monkeypatch.setattr(bpe, "_HOT_PAIRS", 2_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    made = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<unk>"))
    made.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel()
    made.train_from_iterator(texts.values(), tokenizers.trainers.BpeTrainer(
        vocab_size=32_000, min_frequency=2, special_tokens=SPECIAL_TOKENS, show_progress=False))
    ours = bpe.train_bpe(docs)
    merges = [m if isinstance(m, list) else m.split(" ") for m in json.loads(made.to_str())["model"]["merges"]]
    assert [[r.left, r.right] for r in ours.merges.orderBy("rank").collect()] == merges and len(merges) > 5_000
    got = {r.doc_id: r.ids for r in encoding.encode_bpe(docs, ours, {"text": "ids"}).collect()}
    assert got == {i: made.encode(t).ids for i, t in texts.items()}


def test_repeated_token_ends_a_round():
    """ab+c and a+bc spell the same token, which older pairs may gain from."""
    names, ids = list("abcd"), {t: i for i, t in enumerate("abcd")}
    word = lambda t: "".join(bpe._symbol("abcd".index(x)) for x in t)
    pieces = [(word("bc"), 9), (word("ab"), 8), (word("abc"), 3), (word("abcd"), 2)]
    chosen = bpe.merges_while_hot(pieces, (1, chr(0x10FFFF)), names, ids, 100, 1)
    assert names[4:6] == ["bc", "ab"] and names[6] == "abc" and len(chosen) <= 4


def test_merging_words_is_replacing_in_order():
    import random

    draw = random.Random(3)
    for _ in range(200):
        merges, symbols = {}, list("abc")
        for i in range(draw.randint(1, 8)):
            pair = draw.choice(symbols) + draw.choice(symbols)
            if pair not in merges:
                symbols.append(chr(0xF0000 + i))
                merges[pair] = symbols[-1]
        word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 30)))
        expected = word
        for pair, new in merges.items():
            expected = expected.replace(pair, new)
        assert bpe._merged(word, {p: (r, m) for r, (p, m) in enumerate(merges.items())}) == expected


def test_a_round_merges_each_word_once(spark):
    word = lambda t: "".join(bpe._symbol("abcdefg".index(x)) for x in t)
    words = spark.createDataFrame([(word("abcab"), 3), (word("ab"), 2), (word("ccab"), 1)], "symbols string, c bigint")
    merged = bpe.merge_round(words, {word("ab"): word("d"), word("cd"): word("e")})
    assert sorted(merged.collect()) == sorted([(word("de"), 3), (word("ce"), 1)])
    assert merged._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_pieces(spark, monkeypatch):
    import random

    draw = random.Random(5)
    texts = ["".join(bpe._symbol(draw.randrange(6)) for _ in range(draw.randint(2, 12))) for _ in range(300)] * 2
    words = spark.createDataFrame([(t, i + 1) for i, t in enumerate(texts)], "symbols string, c bigint")
    pairs = sorted({t[i:i + 2] for t in texts for i in range(len(t) - 1)})
    few = pairs[::4]

    def expected(hot):
        counts = {}
        for c, t in enumerate(texts, 1):
            cut = t[0] + "".join(("" if t[i - 1:i + 1] in hot else " ") + t[i] for i in range(1, len(t)))
            for piece in cut.split(" "):
                if len(piece) > 1:
                    counts[piece] = counts.get(piece, 0) + c
        return counts

    for hot in (few, pairs[::2], pairs):
        assert dict(bpe.hot_pieces(words, hot).collect()) == expected(set(hot))
    assert dict(bpe.hot_pieces(bpe.hot_pieces(words, pairs[::2]), few, "piece").collect()) == expected(set(few))
    merges = {few[0]: bpe._symbol(6), pairs[1]: bpe._symbol(7)}
    one_by_one = sorted(bpe.with_merges(words, merges).collect())
    monkeypatch.setattr(bpe, "_FEW_MERGES", 0)
    assert sorted(bpe.with_merges(words, merges).collect()) == one_by_one


def test_pretokens(spark):
    tokenizers = pytest.importorskip("tokenizers")
    split = tokenizers.pre_tokenizers.ByteLevel()
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    words = F.transform(bpe.pretokenize(F.col("text")), bpe.byte_symbols)
    assert [r[0] for r in df.select(words).collect()] == [[w for w, _ in split.pre_tokenize_str(t)] for t in TEXTS]


def test_bytes_come_back(spark):
    text = "".join(map(chr, range(1, 0x250))) + "\u65e5\U0001f600"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(bpe.symbols_to_text(bpe.byte_symbols(F.col("t")))).first()[0] == text


def test_round_trip_and_tables(spark, corpus, tmp_path):
    write_tokenizer_tables(bpe.train_bpe(corpus, 120), str(tmp_path / "tok"))
    tokenizer = read_tokenizer_tables(spark, str(tmp_path / "tok"))
    encoded = encoding.encode_bpe(corpus, tokenizer, {"text": "ids"})
    rows = encoding.decode_ids(encoded, tokenizer, "ids", "back").collect()
    assert all(r.back == (r.text if r.text[0].isspace() else " " + r.text) for r in rows)
    more = {r.token: r.id for r in bpe.special_vocab(tokenizer.vocab).collect()}
    assert more["<extra_id_0>"] == 120 and more["<extra_id_99>"] == 219 and len(more) == 220


@pytest.mark.parametrize("n", [2, 5, 6, 7, 20])
def test_layout(spark, n):
    df = spark.range(1).select(F.sequence(F.lit(10), F.lit(9 + n)).alias("x"), F.array(F.lit(50)).alias("y"))
    body = list(range(10, 10 + n))
    padded = encoding.model_inputs(df, "x", "y", 8, 4, pad=True).first()
    ids = [1, *body[:6], 2]
    assert padded.input_ids == ids + [0] * (8 - len(ids))
    assert padded.attention_mask == [1] * len(ids) + [0] * (8 - len(ids))
    assert padded.labels == [1, 50, 2, 0]
    assert encoding.model_inputs(df, "x", "y", 8, 4, pad=False).first().input_ids == ids
    pair = df.select(encoding.frame_template(F.col("x"), F.col("y"))).first()[0]
    assert pair == [1, *body, 2, 2, 50, 2]


def test_examples(spark):
    code = "def f{0}(x):\n    y = {0}\n    if x > {0}:\n        return y\n    return 0\n"
    df = spark.createDataFrame([(i, code.format(i)) for i in range(60)], "id int, source string")
    tokenizer = learn_tokenizer(df, 110)
    pre = pretraining_examples(df, "id", tokenizer, 50).collect()
    assert len(pre) == 50 and {r.split for r in pre} == {"train", "test"}
    assert all(4 in r.input_ids and len(r.input_ids) == len(r.attention_mask) for r in pre)
    fine = finetuning_examples(df, "id", tokenizer).collect()
    assert len(fine) == 60 and all(len(r.input_ids) == 256 and len(r.labels) == 64 for r in fine)
    assert all(r.input_text.replace("<mask>", r.target_text, 1) == code.format(r.id) for r in fine)


def test_pretraining_query_takes_all_rows(spark, corpus, monkeypatch):
    n = 150_003
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    tokenizer = bpe.train_bpe(corpus, 300)
    monkeypatch.setattr(encodings, "documents", lambda *_: docs)
    monkeypatch.setattr(encodings, "_tokenizer", lambda *_: tokenizer)
    assert encodings.QUERIES["pretraining_examples"](spark, "").count() == n


def test_evaluation(spark):
    rows = [("i", " a ", "a\n", 0.0), ("i", "a", "b", None), ("i", "a", "a", -1.0)]
    df = spark.createDataFrame(rows, "input_text string, target_text string, pred_text string, seq_log_score double")
    got = evaluate_predictions(df)
    assert [(r.correct, r.prediction_score) for r in got.collect()] == [(True, 100.0), (False, 0.0), (True, 36.79)]
    total = summarize(got).first()
    assert total.n_rows == 3 and total.accuracy_pct == pytest.approx(200 / 3) and total.mean_score == pytest.approx(136.79 / 3)
