"""Byte-level words, byte-pair encoding, and model inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import codes, texts
from corpusloom.catalog.codes import FUNCTION_ROWS_SQL, python_files, python_functions
from corpusloom.catalog.common import documents, draw32_sql
from corpusloom.functions.seeded import KEY_SPAN
from corpusloom.functions.text import split_whitespace
from corpusloom.operators.bpe import byte_symbols, pretoken_counts, special_vocab, symbol_pair_counts, train_bpe
from corpusloom.operators.encoding import decode_ids, encode_bpe, frame_template, pad_to, truncate_frame
from corpusloom.operators.python_code import extract_python_functions
from corpusloom.plans.from_files import functions_from_csv
from corpusloom.plans.training_examples import finetuning_examples, pretraining_examples
from corpusloom.scratch import scratch_path
from corpusloom.sources.results import read_tokenizer_tables, write_function_csv, write_tokenizer_tables
from corpusloom.sources.tables import read_table

VOCAB_SIZE = 1_000  # where SQL, which counts all words again for each merge, is to follow; the _full queries take the default of 32,000


def _pretokens(spark, sf):
    return pretoken_counts(documents(spark, sf, "doc_id", "text"))


def _byte_words(spark, sf):
    counts = pretoken_counts(documents(spark, sf, "doc_id", "text"))
    return counts.select(byte_symbols(F.col("word")).alias("symbols"), "c")


def _pairs(spark, sf):
    return symbol_pair_counts(_byte_words(spark, sf)).select("pair", "c", "longest")


def _train(spark, sf):
    return train_bpe(documents(spark, sf, "doc_id", "text"), VOCAB_SIZE).merges


def _tokenizer(spark, sf, **size):
    """The documents' tokenizer, learned and read back from its tables."""
    path = scratch_path(spark, "tokenizer")
    write_tokenizer_tables(train_bpe(documents(spark, sf, "doc_id", "text"), **(size or {"vocab_size": VOCAB_SIZE})), path)
    return read_tokenizer_tables(spark, path)


def _train_full(spark, sf):
    return train_bpe(documents(spark, sf, "doc_id", "text")).merges


def _tables(spark, sf):
    """The vocabulary after a round trip through its tables."""
    return _tokenizer(spark, sf).vocab


def _encoded_documents(spark, sf, tokenizer):
    """Ids, and the text decoded again; the leading space that encoding adds stays."""
    encoded = encode_bpe(documents(spark, sf, "doc_id", "text"), tokenizer, {"text": "ids"})
    decoded = decode_ids(encoded, tokenizer, "ids", "decoded")
    return decoded.select("doc_id", _spaced("ids").alias("ids"), "decoded")


def _spaced(ids):
    return F.array_join(F.col(ids).cast("array<string>"), " ")


def _encode(spark, sf):
    return _encoded_documents(spark, sf, _tokenizer(spark, sf))


def _encode_full(spark, sf):
    return _encoded_documents(spark, sf, _tokenizer(spark, sf, vocab_size=32_000))


def _encode_functions(spark, sf):
    """Functions written as CSV, read from the path and encoded."""
    path = scratch_path(spark, "functions")
    write_function_csv(extract_python_functions(python_files(spark, sf)), path)
    rows = functions_from_csv(spark, path)
    encoded = encode_bpe(rows, _tokenizer(spark, sf), {"source": "ids"})
    return encoded.select("file", "function_name", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


def _pretraining(spark, sf):
    docs = documents(spark, sf, "doc_id", "text").withColumnRenamed("text", "source")
    examples = pretraining_examples(docs, "doc_id", _tokenizer(spark, sf))
    return examples.select(
        "doc_id", "split", _spaced("input_ids").alias("input_ids"), _spaced("attention_mask").alias("attention_mask"), _spaced("labels").alias("labels"))


def _finetuning(spark, sf):
    examples = finetuning_examples(python_functions(spark, sf), "doc_id", _tokenizer(spark, sf))
    return examples.select(
        "doc_id", "split", "target_text", _spaced("input_ids").alias("input_ids"), _spaced("attention_mask").alias("attention_mask"),
        _spaced("labels").alias("labels"))


def _ids(spark, sf):
    """Word lengths as stand-ins for ids."""
    lengths = F.transform(split_whitespace(F.col("text")), lambda t: F.length(t))
    return documents(spark, sf, "doc_id", "text").select("doc_id", lengths.alias("ids"))


def _frame(spark, sf):
    ids = F.col("ids")
    return _ids(spark, sf).select(
        "doc_id",
        F.array_join(frame_template(ids).cast("array<string>"), " ").alias("single"),
        F.array_join(frame_template(ids, F.slice(ids, 1, 3)).cast("array<string>"), " ").alias("pair"),
    )


def _truncate_pad(spark, sf):
    framed = truncate_frame(F.col("ids"), 64)
    return _ids(spark, sf).select(
        "doc_id",
        F.array_join(framed.cast("array<string>"), " ").alias("cut"),
        F.array_join(pad_to(framed, 64).cast("array<string>"), " ").alias("padded"),
        F.array_join(pad_to(F.array_repeat(F.lit(1), F.size(framed)), 64).cast("array<string>"), "").alias("attention_mask"),
    )


def _special(spark, sf):
    customers = read_table(spark, sf, "customer")
    return special_vocab(customers.select(F.col("c_name").alias("token"), F.col("c_custkey").cast("int").alias("id")))


QUERIES = {
    "pretoken_counts": _pretokens,
    "byte_level_words": _byte_words,
    "symbol_pair_counts": _pairs,
    "train_bpe": _train,
    "train_bpe_full": _train_full,
    "tokenizer_tables": _tables,
    "encode_bpe": _encode,
    "encode_bpe_full": _encode_full,
    "encode_functions_from_csv": _encode_functions,
    "pretraining_examples": _pretraining,
    "finetuning_examples": _finetuning,
    "frame_template": _frame,
    "truncate_pad": _truncate_pad,
    "special_vocab": _special,
}

# DuckDB's patterns cannot look ahead. A control character put before the last blank of each run
# in front of a word gives the same words.
_SPLIT = r"""regexp_extract_all(
    regexp_replace(CASE WHEN regexp_matches(text, '^\s') THEN text ELSE ' ' || text END, '(\s+)(\s)(\S)', '\1' || chr(1) || '\2\3', 'g'),
    '''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+')"""
_WORDS = f"""words AS (
  SELECT unnest({_SPLIT}) AS word FROM documents),
  counts AS (SELECT word, count(*) AS c FROM words GROUP BY word)"""
_BYTES = """bytes AS (SELECT word, c, list_transform(range(0, length(hex(encode(word)))::BIGINT // 2),
    lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::INTEGER) AS b FROM counts),
  coded AS (SELECT c, array_to_string(list_transform(b, lambda x: chr(CASE WHEN x <= 32 THEN 256 + x
    WHEN x BETWEEN 127 AND 160 THEN 256 + x - 94 WHEN x = 173 THEN 323 ELSE x END)), '') AS symbols FROM bytes)"""
# One merge per round of the recursion, on words of private-use characters; each merge is then spelled
# out by undoing the later ones. This presumes that no two merges make the same token, as is so here.
_MERGES = f"""alphabet AS MATERIALIZED (SELECT ch, 4 + row_number() OVER (ORDER BY ch) AS id
    FROM (SELECT DISTINCT unnest(string_split(symbols, '')) AS ch FROM coded) WHERE ch <> ''),
  letters AS MATERIALIZED (SELECT string_agg(ch, '' ORDER BY id) AS old,
    string_agg(chr((983040 + id)::INTEGER), '' ORDER BY id) AS new, count(*) AS n FROM alphabet),
  start AS MATERIALIZED (SELECT translate(symbols, old, new) AS w, c FROM coded, letters WHERE length(symbols) > 1),
  rounds AS (
    SELECT 0 AS r, w, c, NULL::VARCHAR AS pair, NULL::VARCHAR AS made FROM start
    UNION ALL
    SELECT r + 1, replace(s.w, b.pair, chr((983045 + l.n + s.r)::INTEGER)), s.c, b.pair, chr((983045 + l.n + s.r)::INTEGER)
    FROM rounds s, letters l, (
      SELECT pair FROM (SELECT substr(w, i, 2) AS pair, sum(c) AS f
        FROM (SELECT w, c, unnest(range(1, length(w))) AS i FROM rounds) GROUP BY 1)
      WHERE f >= 2 ORDER BY f DESC, pair LIMIT 1) b
    WHERE s.r < {VOCAB_SIZE} - 5 - l.n),
  merges AS (SELECT r - 1 AS rank, any_value(pair) AS pair, any_value(made) AS made FROM rounds WHERE r > 0 GROUP BY r),
  undo AS (SELECT list(made || pair ORDER BY rank DESC) AS steps FROM merges),
  sides AS (SELECT rank, pair[1] AS l, pair[2] AS r FROM merges)"""


def _spelled(side: str) -> str:
    return f"translate(list_reduce(list_concat([{side}], steps), lambda a, x: replace(a, x[1], x[2:])), new, old)"


_TOKS = r"list_transform(list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda x: x <> ''), lambda x: length(x))"

def _encoded(table: str) -> str:
    """CTE ``encoded(key, ids)`` for a table ``(key, text)``: every merge in turn, on each distinct word."""
    return f"""pieces AS MATERIALIZED (SELECT key, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT key, {_SPLIT} AS w FROM {table})),
  piece_bytes AS (SELECT word, list_transform(range(0, length(hex(encode(word)))::BIGINT // 2),
    lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::INTEGER) AS b FROM (SELECT DISTINCT word FROM pieces)),
  piece_symbols AS (SELECT word, array_to_string(list_transform(b, lambda x: chr(CASE WHEN x <= 32 THEN 256 + x
    WHEN x BETWEEN 127 AND 160 THEN 256 + x - 94 WHEN x = 173 THEN 323 ELSE x END)), '') AS symbols FROM piece_bytes),
  redo AS (SELECT list(made || pair ORDER BY rank) AS steps FROM merges),
  merged AS MATERIALIZED (SELECT word, list_reduce(list_concat([list_aggregate(list_filter(list_transform(string_split(symbols, ''),
      lambda ch: CASE WHEN contains(old, ch) THEN translate(ch, old, new) ELSE chr(983043) END), lambda x: x <> ''), 'string_agg', '')], steps),
      lambda a, x: replace(a, x[2:], x[1])) AS w FROM piece_symbols, redo, letters),
  encoded AS (SELECT key, string_agg(array_to_string(list_transform(string_split(w, ''), lambda ch: (ord(ch) - 983040)::VARCHAR), ' '), ' ' ORDER BY pos) AS ids
    FROM pieces JOIN merged USING (word) GROUP BY key)"""


def _examples(max_input: int, max_target: int, pad: bool) -> str:
    """CTE ``examples(doc_id, input_ids, attention_mask, labels)`` of a table ``masked(doc_id, input_text, target_text)``.

    The runs between masks are encoded each by itself; a mask is the id 4.
    """
    def framed(side: str, size: int) -> str:
        return f"list_concat(list_concat(['1'], list_filter(string_split({side}, ' '), lambda x: x <> '')[1:{size - 2}]), ['2'])"

    def row(ids: str, size: int, fill: str) -> str:
        return f"array_to_string({ids}, ' ')" + (f" || repeat(' {fill}', {size} - len({ids})::INTEGER)" if pad else "")

    return f"""two_sides AS (SELECT doc_id, 'i' AS side, input_text AS text FROM masked UNION ALL SELECT doc_id, 't', target_text FROM masked),
  runs AS (SELECT doc_id, side, unnest(string_split(text, '<mask>')) AS text, generate_subscripts(string_split(text, '<mask>'), 1) AS run FROM two_sides),
  keyed AS (SELECT doc_id || side || run AS key, text FROM runs WHERE text <> ''), {_encoded('keyed')},
  joined AS (SELECT doc_id, string_agg(coalesce(ids, ''), ' 4 ' ORDER BY run) FILTER (side = 'i') AS i, string_agg(coalesce(ids, ''), ' 4 ' ORDER BY run) FILTER (side = 't') AS t
    FROM runs LEFT JOIN encoded ON key = doc_id || side || run GROUP BY doc_id),
  cut AS (SELECT doc_id, {framed('i', max_input)} AS i, {framed('t', max_target)} AS t FROM joined),
  examples AS (SELECT doc_id, {row('i', max_input, '0')} AS input_ids, {row("list_transform(i, lambda x: '1')", max_input, '0')} AS attention_mask,
    {row('t', max_target, '0')} AS labels FROM cut)"""


ORACLES = {
    "pretoken_counts": f"WITH {_WORDS} SELECT word, c FROM counts",
    "byte_level_words": f"WITH {_WORDS}, {_BYTES} SELECT symbols, c FROM coded",
    "symbol_pair_counts": f"""WITH {_WORDS}, {_BYTES},
      grams AS (SELECT symbols, c, unnest(range(1, length(symbols))) AS i FROM coded),
      pairs AS (SELECT substr(symbols, i, 2) AS pair, sum(c)::BIGINT AS c FROM grams GROUP BY 1),
      triples AS (SELECT substr(symbols, i, 3) AS t, sum(c)::BIGINT AS c FROM grams WHERE i + 2 <= length(symbols) GROUP BY 1)
      SELECT pair, p.c, coalesce(greatest((SELECT max(c) FROM triples WHERE substr(t, 1, 2) = pair),
        (SELECT max(c) FROM triples WHERE substr(t, 2, 2) = pair)), 0) AS longest FROM pairs p""",
    "train_bpe": f"""WITH RECURSIVE {_WORDS}, {_BYTES}, {_MERGES}
      SELECT rank::INTEGER AS rank, {_spelled('l')} AS "left", {_spelled('r')} AS "right" FROM sides, undo, letters""",
    "tokenizer_tables": f"""WITH RECURSIVE {_WORDS}, {_BYTES}, {_MERGES}
      SELECT ch AS token, id::INTEGER AS id FROM alphabet
      UNION ALL SELECT {_spelled('l || r')}, (5 + n + rank)::INTEGER FROM sides, undo, letters
      UNION ALL SELECT * FROM (VALUES ('<pad>', 0), ('<s>', 1), ('</s>', 2), ('<unk>', 3), ('<mask>', 4)) s(token, id)""",
    "encode_bpe": f"""WITH RECURSIVE {_WORDS}, {_BYTES}, {_MERGES}, keyed AS (SELECT doc_id AS key, text FROM documents), {_encoded('keyed')}
      SELECT doc_id, ids, CASE WHEN regexp_matches(text, '^\\s') THEN text ELSE ' ' || text END AS decoded FROM documents JOIN encoded ON key = doc_id""",
    "encode_functions_from_csv": f"""WITH RECURSIVE {_WORDS}, {_BYTES}, {_MERGES}, {FUNCTION_ROWS_SQL},
      keyed AS (SELECT file || ' ' || function_name AS key, source AS text FROM functions), {_encoded('keyed')}
      SELECT file, function_name, ids FROM functions JOIN encoded ON key = file || ' ' || function_name""",
    "pretraining_examples": f"""WITH RECURSIVE {_WORDS}, {_BYTES}, {_MERGES}, masked AS ({texts.ORACLES["mask_random_tokens"]}), {_examples(512, 256, False)}
      SELECT doc_id, CASE WHEN {draw32_sql(42, 'doc_id')} < {0.1 * KEY_SPAN} THEN 'test' ELSE 'train' END AS split,
        input_ids, attention_mask, labels FROM examples""",
    "finetuning_examples": f"""WITH RECURSIVE {_WORDS}, {_BYTES}, {_MERGES}, masked AS ({codes.ORACLES["mask_if_condition"]}), {_examples(256, 64, True)}
      SELECT doc_id, CASE WHEN {draw32_sql(42, 'doc_id')} >= {0.2 * KEY_SPAN} THEN 'train'
        WHEN {draw32_sql('42.held', 'doc_id')} < {0.5 * KEY_SPAN} THEN 'test' ELSE 'validation' END AS split,
        target_text, input_ids, attention_mask, labels FROM examples JOIN masked USING (doc_id)""",
    "frame_template": f"""WITH t AS (SELECT doc_id, {_TOKS} AS ids FROM documents)
      SELECT doc_id, array_to_string(list_concat(list_concat([1], ids), [2]), ' ') AS single,
        array_to_string(list_concat(list_concat(list_concat(list_concat([1], ids), [2, 2]), ids[1:3]), [2]), ' ') AS pair FROM t""",
    "truncate_pad": f"""WITH t AS (SELECT doc_id, list_concat(list_concat([1], ({_TOKS})[1:62]), [2]) AS ids FROM documents)
      SELECT doc_id, array_to_string(ids, ' ') AS cut, array_to_string(ids, ' ') || repeat(' 0', 64 - len(ids)::INTEGER) AS padded,
        repeat('1', len(ids)::INTEGER) || repeat('0', 64 - len(ids)::INTEGER) AS attention_mask FROM t""",
    "special_vocab": """SELECT c_name AS token, c_custkey::INTEGER AS id FROM customer UNION ALL
      SELECT '<extra_id_' || i || '>', (i + (SELECT max(c_custkey) + 1 FROM customer))::INTEGER FROM (SELECT unnest(range(0, 100)) AS i)""",
}
