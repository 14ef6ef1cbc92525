"""Java and Python operators on sources composed from whole documents.

The tables hold no code, so each document becomes a source file around its text. What has to come
out is known from how a file is put together, and the SQL builds that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.catalog.common import documents, draw32_sql
from corpusloom.functions.text import is_blank
from corpusloom.operators.java_code import (
    TOKEN, clean_comments, find_java_methods, has_position, java_file_filter, lexable, line_count_in_range,
    method_signature, strip_imports, tokenize_java,
)
from corpusloom.operators.masking import if_eligible, mask_if_condition
from corpusloom.operators.python_code import extract_python_functions, if_conditions
from corpusloom.plans.java_corpus import clean_files, method_rows, mine_java_methods

# The same expressions in both engines: only ||, replace and CASE.
_QUOTED = "replace(replace(replace(text, chr(92), '/'), chr(34), chr(39)), chr(10), ' ')"
JAVA_SOURCE = f"""'package p;' || chr(10) || '  import java.util.' || lang || ';' || chr(10)
  || '// ' || replace(text, chr(10), chr(10) || '// ') || chr(10)
  || '/* ' || source || ' */' || chr(10) || 'public class D' || doc_id || ' {{' || chr(10)
  || '  String s = ' || chr(34) || {_QUOTED} || CASE WHEN doc_id % 5 = 0 THEN 'http://x' ELSE '' END || chr(34) || ';' || chr(10)
  || '   ' || chr(10)
  || '  public static int size(final String text, java.util.List<Map<String, Integer>>[] more) throws E {{' || chr(10)
  || '    return ' || n_chars || ';' || chr(10) || '  }}' || chr(10)
  || '  void ' || lang || '() {{ /* ' || source || chr(10) || ' */ }}' || chr(10)
  || CASE WHEN doc_id % 7 = 0 THEN '' ELSE '}}' END || chr(10)""".replace("{{", "{").replace("}}", "}")
_CLEANED = f"""'package p;' || chr(10) || 'public class D' || doc_id || ' {{' || chr(10)
  || '  String s = ' || chr(34) || {_QUOTED} || CASE WHEN doc_id % 5 = 0 THEN 'http:' ELSE chr(34) || ';' END || chr(10)
  || '  public static int size(final String text, java.util.List<Map<String, Integer>>[] more) throws E {{' || chr(10)
  || '    return ' || n_chars || ';' || chr(10) || '  }}' || chr(10)
  || '  void ' || lang || '() {{  }}'
  || CASE WHEN doc_id % 7 = 0 THEN '' ELSE chr(10) || '}}' END""".replace("{{", "{").replace("}}", "}")

_DOCSTRING = "replace(replace(text, chr(92), '/'), chr(34), chr(39))"
PYTHON_FUNCTION = f"""'def outer_' || doc_id || '(x, lang):' || chr(10)
  || '    {'"' * 3}' || {_DOCSTRING} || ' {'"' * 3}' || chr(10)
  || '    if x > ' || n_chars || ':' || chr(10) || '        return 1' || chr(10)
  || '    elif lang == ' || chr(34) || lang || chr(34) || ':' || chr(10)
  || '        async def inner(y):' || chr(10)
  || '            if y in (' || chr(34) || source || chr(34) || ',):' || chr(10)
  || '                return y' || chr(10) || '        return inner' || chr(10) || '    return None'"""
_INNER = """'async def inner(y):' || chr(10) || '            if y in (' || chr(34) || source || chr(34) || ',):' || chr(10)
  || '                return y'"""
_CONDITIONS = """['x > ' || n_chars, 'lang == ' || chr(34) || lang || chr(34), 'y in (' || chr(34) || source || chr(34) || ',)']"""


def java_files(spark, sf) -> DataFrame:
    """One file per document; its source is the repository, its id the commit."""
    return documents(spark, sf).selectExpr(
        "source AS repo_name", "'https://host/o/' || source AS repo_url", "cast(substr(source, 4) AS int) AS repo_seq",
        "doc_id AS commit_seq", "md5(cast(doc_id AS string)) AS commit_sha", "1 AS file_seq",
        "CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'archetype-resources/D.java' ELSE 'src/D' || doc_id || '.java' END AS file_path",
        "CASE WHEN doc_id % 23 = 0 THEN 'D.txt' ELSE 'D' || doc_id || '.java' END AS file_name",
        f"{JAVA_SOURCE} AS source_code",
    )


def _code(spark, sf, code) -> DataFrame:
    return java_files(spark, sf).select(F.col("commit_seq").alias("doc_id"), code.alias("code"))


def _java_file_filter(spark, sf):
    return java_file_filter(java_files(spark, sf)).select(F.col("commit_seq").alias("doc_id"), "file_path")


def _strip_imports(spark, sf):
    return _code(spark, sf, strip_imports(F.col("source_code")))


def _clean_comments(spark, sf):
    return _code(spark, sf, clean_comments(F.col("source_code")))


def _drop_empty(spark, sf):
    """Texts as comments only, but for some: what is left after cleaning must not be blank."""
    code = F.concat(F.lit("/*"), F.replace("text", F.lit("*/"), F.lit("")), F.lit("*/ "), F.when(F.col("doc_id") % 4 == 0, "x").otherwise("\n"))
    docs = documents(spark, sf, "doc_id", "text").select("doc_id", clean_comments(code).alias("code"))
    return docs.filter(~is_blank(F.col("code")))


def _line_filter(spark, sf):
    return documents(spark, sf, "doc_id", "text").filter(line_count_in_range(F.col("text"), 3, 40))


def _lexable(spark, sf):
    return _code(spark, sf, strip_imports(clean_comments(F.col("source_code")))).filter(lexable(F.col("code"))).select("doc_id")


def _lexable_text(spark, sf):
    """Which raw texts happen to be made of tokens only."""
    return documents(spark, sf, "doc_id", "text").filter(lexable(F.col("text"))).select("doc_id")


def _tokens(spark, sf):
    tokens = tokenize_java(F.col("text"))
    return documents(spark, sf, "doc_id", "text").select(
        "doc_id", F.size(tokens).cast("bigint").alias("n_tokens"), F.md5(F.array_join(tokens, ", ")).alias("tokens")
    )


def _methods(spark, sf):
    methods = has_position(find_java_methods(java_files(spark, sf)))
    return methods.select(
        F.col("commit_seq").alias("doc_id"), "method_seq", "method_name", "start_line",
        method_signature(F.col("return_type"), F.col("method_name"), F.col("params")).alias("signature"),
    )


def _clean_files(spark, sf):
    return clean_files(java_files(spark, sf)).select(F.col("commit_seq").alias("doc_id"), "code")


def _method_rows(spark, sf):
    return method_rows(java_files(spark, sf), "train").select(
        "dataset_split", "repo_name", "repo_url", "commit_sha", "file_path", "method_name", "start_line", "end_line",
        "signature", "original_code",
    )


def _mine(spark, sf):
    return mine_java_methods(java_files(spark, sf), 160, "eval").select(
        "dataset_split", "repo_name", "repo_url", "commit_sha", "file_path", "method_name", "start_line", "end_line",
        "signature", "original_code", "code_tokens",
    )


def python_files(spark, sf) -> DataFrame:
    """One module per document; every sixth does not parse."""
    return documents(spark, sf).selectExpr(
        "source AS repo", "'m' || doc_id || '.py' AS file",
        f"CASE WHEN doc_id % 6 = 0 THEN 'def broken(:' || chr(10) ELSE '' END || 'import os' || chr(10) || '@deco' || chr(10) || {PYTHON_FUNCTION} || chr(10) AS text",
    )


def python_functions(spark, sf) -> DataFrame:
    return documents(spark, sf).selectExpr(
        "doc_id", f"CASE WHEN doc_id % 3 = 0 THEN '' ELSE {PYTHON_FUNCTION} END AS source", f"{PYTHON_FUNCTION} AS code"
    )


def _functions(spark, sf):
    return extract_python_functions(python_files(spark, sf))


def _functions_finetune(spark, sf):
    return extract_python_functions(python_files(spark, sf), "finetune", 5)


def _conditions(spark, sf):
    return python_files(spark, sf).select("file", F.array_join(if_conditions(F.col("text")), "|").alias("conditions"))


def _if_eligible(spark, sf):
    """Half of the sources are cut off before their first test."""
    cut = F.when(F.substring_index("file", ".", 1).substr(2, 20).cast("bigint") % 2 == 0, F.col("text")).otherwise(
        F.substring_index("text", "\n    if", 1)
    )
    coded = python_files(spark, sf).select("file", cut.alias("code"))
    return if_eligible(coded.withColumn("conditions", if_conditions(F.col("code")))).select("file")


def _mask_if(spark, sf):
    return mask_if_condition(python_functions(spark, sf), "doc_id").select("doc_id", "input_text", "target_text")


QUERIES = {
    "java_file_filter": _java_file_filter,
    "strip_imports": _strip_imports,
    "clean_comments": _clean_comments,
    "drop_empty_code": _drop_empty,
    "line_count_filter": _line_filter,
    "lexable_filter": _lexable,
    "lexable_text": _lexable_text,
    "tokenize_java": _tokens,
    "find_java_methods": _methods,
    "clean_files": _clean_files,
    "java_method_rows": _method_rows,
    "mine_java_methods": _mine,
    "extract_python_functions": _functions,
    "extract_python_functions_finetune": _functions_finetune,
    "extract_if_conditions": _conditions,
    "if_eligible": _if_eligible,
    "mask_if_condition": _mask_if,
}

# The SQL engine's expressions never backtrack; it neither has nor needs possessive marks.
_RE = TOKEN.replace("*+", "*").replace("'", "''")
_PATH = "CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'archetype-resources/D.java' ELSE 'src/D' || doc_id || '.java' END"
_IS_JAVA = "doc_id % 23 <> 0 AND (doc_id % 17 = 0 OR doc_id % 19 <> 0)"
_CLEAN = "doc_id % 5 <> 0 AND doc_id % 7 <> 0"
# Before it: package, import, the text, a comment, the class, the string, a blank line.
_FIRST_METHOD = "8 + length(text) - length(replace(text, chr(10), ''))"
_METHOD_ROWS = f"""method_rows AS (
  SELECT doc_id, source, substr(source, 4)::INTEGER AS repo_seq, m AS method_seq,
    source AS repo_name, 'https://host/o/' || source AS repo_url, md5(doc_id::VARCHAR) AS commit_sha, {_PATH} AS file_path,
    CASE m WHEN 0 THEN 'size' ELSE lang END AS method_name,
    (({_FIRST_METHOD}) + 3 * m)::INTEGER AS start_line, (({_FIRST_METHOD}) + 3 * m + 7)::INTEGER AS end_line,
    CASE m WHEN 0 THEN 'int size(String text, java more)' ELSE 'void ' || lang || '()' END AS signature,
    {_CLEANED} AS original_code
  FROM documents, (VALUES (0), (1)) v(m))"""
_ROW_COLUMNS = "repo_name, repo_url, commit_sha, file_path, method_name, start_line, end_line, signature, original_code"
_LINES = "length(text) - length(replace(text, chr(10), '')) + CASE WHEN text = '' OR text LIKE '%' || chr(10) THEN 0 ELSE 1 END"


def _count(code: str, ch: str) -> str:
    return f"(length({code}) - length(replace({code}, '{ch}', '')))"


FUNCTION_ROWS_SQL = f"""functions AS (
  SELECT source AS repo, 'm' || doc_id || '.py' AS file, 'outer_' || doc_id AS function_name, doc_id,
    (10 + length(text) - length(replace(text, chr(10), '')))::INTEGER AS num_lines, 3::INTEGER AS num_if,
    array_to_string({_CONDITIONS}, '; ') AS ifs, {PYTHON_FUNCTION} AS source FROM documents WHERE doc_id % 6 <> 0
  UNION ALL
  SELECT source, 'm' || doc_id || '.py', 'inner', doc_id, 3, 1, ({_CONDITIONS})[3], {_INNER} FROM documents WHERE doc_id % 6 <> 0)"""
_PICK = f"({_CONDITIONS})[{draw32_sql(42, 'doc_id')} % 3 + 1]"

ORACLES = {
    "java_file_filter": f"SELECT doc_id, {_PATH} AS file_path FROM documents WHERE {_IS_JAVA}",
    "strip_imports": f"""SELECT doc_id, replace({JAVA_SOURCE}, chr(10) || '  import java.util.' || lang || ';', '') AS code FROM documents""",
    "clean_comments": f"""SELECT doc_id, replace({_CLEANED}, 'package p;', 'package p;' || chr(10) || '  import java.util.' || lang || ';') AS code
      FROM documents""",
    "drop_empty_code": "SELECT doc_id, ' x' AS code FROM documents WHERE doc_id % 4 = 0",
    "line_count_filter": f"SELECT doc_id, text FROM documents WHERE {_LINES} > 3 AND {_LINES} < 40",
    "lexable_filter": f"SELECT doc_id FROM documents WHERE {_CLEAN}",
    "lexable_text": f"""WITH t AS (SELECT doc_id, text, regexp_replace(text, '"[^"\\\\\\n]*"|''[^''\\\\\\n]*''', '', 'g') AS bare FROM documents)
      SELECT doc_id FROM t WHERE regexp_replace(text, '{_RE}|[ \\t\\r\\n]+', '', 'g') = '' AND trim(text, ' ' || chr(10)) <> ''
        AND {_count('bare', '(')} = {_count('bare', ')')} AND {_count('bare', '[')} = {_count('bare', ']')}
        AND {_count('bare', '{')} = {_count('bare', '}')}""",
    "tokenize_java": f"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '{_RE}') AS toks FROM documents)
      SELECT doc_id, len(toks) AS n_tokens, md5(array_to_string(toks, ', ')) AS tokens FROM t""",
    "find_java_methods": f"""WITH {_METHOD_ROWS} SELECT doc_id, method_seq::INTEGER AS method_seq, method_name, start_line, signature
      FROM method_rows""",
    "clean_files": f"SELECT doc_id, {_CLEANED} AS code FROM documents WHERE {_IS_JAVA} AND {_CLEAN}",
    "java_method_rows": f"""WITH {_METHOD_ROWS} SELECT 'train' AS dataset_split, {_ROW_COLUMNS} FROM method_rows WHERE {_IS_JAVA} AND {_CLEAN}""",
    "mine_java_methods": f"""WITH {_METHOD_ROWS}, quota AS (SELECT * FROM method_rows WHERE {_IS_JAVA} AND {_CLEAN}
        QUALIFY row_number() OVER (PARTITION BY repo_name ORDER BY doc_id, method_seq) <= 40)
      SELECT 'eval' AS dataset_split, {_ROW_COLUMNS}, array_to_string(regexp_extract_all(original_code, '{_RE}'), ', ') AS code_tokens
      FROM quota ORDER BY repo_seq, doc_id, method_seq LIMIT 160""",
    "extract_python_functions": f"WITH {FUNCTION_ROWS_SQL} SELECT * EXCLUDE (doc_id) FROM functions",
    "extract_python_functions_finetune": f"WITH {FUNCTION_ROWS_SQL} SELECT * EXCLUDE (doc_id) FROM functions WHERE num_lines >= 5",
    "extract_if_conditions": f"""SELECT 'm' || doc_id || '.py' AS file,
      CASE WHEN doc_id % 6 = 0 THEN '' ELSE array_to_string({_CONDITIONS}, '|') END AS conditions FROM documents""",
    "if_eligible": "SELECT 'm' || doc_id || '.py' AS file FROM documents WHERE doc_id % 2 = 0 AND doc_id % 6 <> 0",
    "mask_if_condition": f"""WITH t AS (SELECT doc_id, {PYTHON_FUNCTION} AS code, {_PICK} AS target_text FROM documents)
      SELECT doc_id, target_text, substr(code, 1, position(target_text IN code) - 1) || '<mask>'
        || substr(code, position(target_text IN code) + length(target_text)) AS input_text FROM t""",
}
