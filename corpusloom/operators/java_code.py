"""Cleaning, checking, tokenising and listing the methods of Java sources.

There is no Java parser here: ``lexable`` (the whole text is tokens, brackets match) stands
for "parses", and method headers are found by pattern. Known misses: headers with annotations
whose arguments nest parentheses twice, and generic bounds that contain parentheses.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.sliced import by_slices
from corpusloom.functions.text import WHITESPACE, is_blank, line_count
from corpusloom.operators.skew import keep_members

# Licenses that allow use.
ALLOWED_LICENSES = ["mit", "apache-2.0", "bsd-3-clause", "bsd-2-clause", "gpl", "lgpl", "mpl-2.0"]
# A cleaned file has more lines than the first and fewer than the second.
MIN_FILE_LINES, MAX_FILE_LINES = 3, 1_000

# The lexical grammar. Neither >> nor >>> is a token, so that type arguments nest.
_TEXT_BLOCK = r'"""[\s\S]*?"""'
# Possessive: a repeated group that may give back recurses, and long literals would exhaust the stack.
_STRING = r'"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
_CHARACTER = r"'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
_NUMBER = (
    r"0[xX][0-9a-fA-F_]+[lL]?|0[bB][01_]+[lL]?"
    r"|(?:[0-9][0-9_]*\.?[0-9_]*|\.[0-9][0-9_]*)(?:[eE][+-]?[0-9_]+)?[lLfFdD]?"
)
_NAME = r"[\p{L}_$][\p{L}\p{N}_$]*"
_OPERATOR = (
    r">>>=|>>=|<<=|\.\.\.|->|::|\+\+|--|&&|\|\||==|!=|<=|>=|\+=|-=|\*=|/=|&=|\|=|\^=|%=|<<"
    r"|[-+*/%&|^!~<>=?:;,.(){}\[\]@]"
)
TOKEN = "|".join([_TEXT_BLOCK, _STRING, _CHARACTER, _NUMBER, _NAME, _OPERATOR])


def java_file_filter(files: DataFrame) -> DataFrame:
    """Non-empty ``.java`` files that are not archetype templates."""
    name = F.element_at(F.split("file_path", "/"), -1)
    name = F.coalesce(F.col("file_name"), name) if "file_name" in files.columns else name
    template = F.coalesce(F.col("file_path").contains("archetype-resources"), F.lit(False))
    return files.filter(name.endswith(".java") & (F.length("source_code") > 0) & ~template)


def license_filter(rows: DataFrame, repos: DataFrame, on: str = "repo_name") -> DataFrame:
    """Rows of repositories with an allowed license; an unknown license is not allowed."""
    allowed = repos.filter(F.col("license_key").isin(ALLOWED_LICENSES)).select(on).distinct()
    return keep_members(rows, allowed, on)


def strip_imports(code: Column) -> Column:
    keep = lambda line: ~line.rlike(rf"\A{WHITESPACE}*import ")
    return F.array_join(F.filter(F.split(code, "\n"), keep), "\n")


def clean_comments(code: Column) -> Column:
    """Without line comments, then block comments, then blank lines. String literals are not
    exempt: ``"http://x"`` loses its end."""
    code = F.regexp_replace(code, r"//[^\n]*", "")
    code = F.regexp_replace(code, r"(?s)/\*.*?\*/", "")
    return F.array_join(F.filter(F.split(code, "\n"), lambda line: ~is_blank(line)), "\n")


def line_count_in_range(code: Column, low: int = MIN_FILE_LINES, high: int = MAX_FILE_LINES) -> Column:
    n = line_count(code)
    return (n > low) & (n < high)


def tokenize_java(code: Column) -> Column:
    return F.regexp_extract_all(code, F.lit(TOKEN), F.lit(0))


def lexable(code: Column) -> Column:
    """Nothing but tokens and white space, at least one token, and matching brackets."""
    leftover = F.regexp_replace(code, f"{TOKEN}|{WHITESPACE}+", "")
    outside_literals = F.regexp_replace(code, "|".join([_TEXT_BLOCK, _STRING, _CHARACTER]), "")
    brackets = F.split(F.regexp_replace(outside_literals, r"[^(){}\[\]]", ""), "")
    closing = F.create_map(F.lit("("), F.lit(")"), F.lit("["), F.lit("]"), F.lit("{"), F.lit("}"))
    # The accumulator holds the brackets still to be closed, the innermost last; "!" is a mismatch.
    step = lambda acc, x: (
        F.when((x == "") | acc.startswith("!"), acc)
        .when(x.isin("(", "[", "{"), F.concat(acc, F.get(F.array(closing[x]), F.lit(0))))
        .when(F.substring(acc, -1, 1) == x, F.substring(acc, F.lit(1), F.length(acc) - 1))
        .otherwise(F.lit("!"))
    )
    open_at_end = F.aggregate(brackets, F.lit(""), step)
    return (leftover == "") & ~is_blank(code) & (open_at_end == "")


def method_signature(return_type: Column, name: Column, params: Column) -> Column:
    """``type name(type name, ...)`` from a return type, ``void`` if null, and ``ARRAY<STRUCT<type, name>>``."""
    listed = F.array_join(F.transform(params, lambda p: F.concat_ws(" ", p["type"], p["name"])), ", ")
    return F.concat(F.coalesce(return_type, F.lit("void")), F.lit(" "), name, F.lit("("), listed, F.lit(")"))


def provenance(rows: DataFrame, split: str) -> DataFrame:
    return rows.withColumn("dataset_split", F.lit(split))


METHODS = "array<struct<seq:int,name:string,line:int,return_type:string,params:array<struct<type:string,name:string>>>>"


def java_methods(source: Column) -> Column:
    """Methods declared in a source, in text order; types are simple names without arguments."""

    @F.arrow_udf(METHODS)
    def methods(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import re

        # Words that can stand before a call or a constructor but are no type.
        not_types = [
            "return", "new", "else", "throw", "case", "assert", "yield", "package", "import", "do", "goto", "public",
            "protected", "private", "static", "final", "abstract", "native", "synchronized", "default", "strictfp",
            "record", "class", "interface", "enum",
        ]
        # Words before a parenthesis that are no method name.
        not_names = {"if", "for", "while", "switch", "catch", "synchronized", "try", "super", "this"}
        hidden = re.compile(r'"""[\s\S]*?"""|"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|//[^\n]*|/\*[\s\S]*?\*/')
        name = r"[^\W\d][\w$]*|\$[\w$]*"
        header = re.compile(
            rf"(?<![\w$.])(?!(?:{'|'.join(not_types)})\b)(?P<type>(?:{name})(?:\.(?:{name}))*(?:\s*<[^;(){{}}=]*>)?(?:\s*\[\s*\])*)\s+"
            rf"(?P<name>{name})\s*\((?P<params>(?:[^(){{}};]|\([^()]*\))*)\)(?:\s*\[\s*\])*"
            rf"(?:\s*throws\s+[\w.$,\s]+)?\s*(?=[{{;])"
        )
        annotation = re.compile(r"@[\w.$]+(?:\s*\([^()]*\))?")

        def parameter(text):
            words = re.sub(r"\bfinal\b", " ", annotation.sub(" ", text)).replace("...", " ")
            words = re.sub(r"\[\s*\]", " ", words).split()
            return {"type": re.split(r"[.<]", words[0])[0], "name": words[-1]} if len(words) > 1 else None

        def split_params(text):
            depth, part, parts = 0, [], []
            for ch in text:
                depth += (ch in "<(") - (ch in ">)")
                if ch == "," and depth == 0:
                    parts.append("".join(part))
                    part = []
                else:
                    part.append(ch)
            parts.append("".join(part))
            return [p for p in map(parameter, parts) if p]

        def of(source):
            if source is None:
                return []
            # Literals and comments shrink to a space and their line ends, so line numbers stay true.
            text = hidden.sub(lambda m: " " + "\n" * m.group().count("\n"), source)
            found = []
            for m in header.finditer(text):
                kind = re.split(r"[.<\[\s]", m["type"])[0]
                if m["name"] in not_names:
                    continue
                found.append({
                    "seq": len(found), "name": m["name"], "line": text.count("\n", 0, m.start()) + 1,
                    "return_type": None if kind == "void" else kind, "params": split_params(m["params"]),
                })
            return found

        text, number = pa.string(), pa.int32()
        kind = pa.list_(pa.struct([
            ("seq", number), ("name", text), ("line", number), ("return_type", text),
            ("params", pa.list_(pa.struct([("type", text), ("name", text)]))),
        ]))
        yield from by_slices(batches, of, kind)

    return methods(source)


def find_java_methods(files: DataFrame) -> DataFrame:
    """One row per method: the file's columns and ``method_seq, method_name, start_line, return_type, params``."""
    kept = files.columns
    listed = files.withColumn("_methods", java_methods(F.col("source_code")))
    return listed.select(*kept, F.explode("_methods").alias("_m")).select(
        *kept,
        F.col("_m.seq").alias("method_seq"), F.col("_m.name").alias("method_name"),
        F.col("_m.line").alias("start_line"), F.col("_m.return_type").alias("return_type"),
        F.col("_m.params").alias("params"),
    )


def has_position(methods: DataFrame) -> DataFrame:
    return methods.filter(F.col("start_line").isNotNull())
