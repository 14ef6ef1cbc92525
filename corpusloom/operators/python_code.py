"""Functions and if-conditions of Python sources.

Parsing is the standard library's, run in Arrow batches; one unparsable file, or one function
whose text cannot be cut out, costs only itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.sliced import by_slices, record_slices

# The columns of function rows.
FUNCTION_SCHEMA = (
    "repo string, file string, function_name string, num_lines int, num_if int, ifs string, source string"
)


class Segments:
    """Texts of syntax nodes; the source is cut into lines once, whatever the number of nodes."""

    def __init__(self, code: str):
        self.lines = [line.encode("utf-8") for line in re.findall(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+", code)]

    def of(self, node) -> str | None:
        first, last = getattr(node, "lineno", None), getattr(node, "end_lineno", None)
        if first is None or last is None or node.end_col_offset is None:
            return None
        lines = self.lines[first - 1:last]
        if not lines:
            return None
        # Columns count bytes. The end is cut first, as start and end may share a line.
        lines[-1] = lines[-1][:node.end_col_offset]
        lines[0] = lines[0][node.col_offset:]
        return b"".join(lines).decode("utf-8")


def decode_utf8_ignore(content: Column) -> Column:
    """Text of UTF-8 bytes without the bytes that do not decode."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from by_slices(batches, lambda b: None if b is None else b.decode("utf-8", "ignore"), pa.string())

    return decode(content)


def if_conditions(code: Column) -> Column:
    """Texts of the tests of all ``if``/``elif`` in a source, breadth-first; [] if it does not parse."""

    @F.arrow_udf("array<string>")
    def conditions(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ast
        import warnings

        def of(code):
            try:
                with warnings.catch_warnings():
                    warnings.simplefilter("ignore")
                    tree = ast.parse(code)
            except (SyntaxError, ValueError, TypeError, RecursionError, MemoryError):
                return []
            segments = Segments(code)
            tests = (segments.of(n.test) for n in ast.walk(tree) if isinstance(n, ast.If))
            return [t.strip() for t in tests if t and t.strip()]

        yield from by_slices(batches, of, pa.list_(pa.string()))

    return conditions(code)


def extract_python_functions(files: DataFrame, split_type: str = "pretrain", min_lines: int = 3) -> DataFrame:
    """One row per function of the files ``(repo, file, text)``, nested and async ones included.

    ``split_type='finetune'`` keeps only functions with an ``if``.
    """

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ast
        import warnings

        text_type, count = pa.string(), pa.int32()
        schema = pa.schema([
            ("repo", text_type), ("file", text_type), ("function_name", text_type), ("num_lines", count), ("num_if", count),
            ("ifs", text_type), ("source", text_type),
        ])
        for batch in record_slices(batches):
            rows = []
            for repo, file, text in zip(*[column.to_pylist() for column in batch.columns]):
                try:
                    with warnings.catch_warnings():
                        warnings.simplefilter("ignore")
                        tree = ast.parse(text)
                except (SyntaxError, ValueError, TypeError, RecursionError, MemoryError):
                    continue
                segments = Segments(text)
                for node in ast.walk(tree):
                    if not isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
                        continue
                    segment = segments.of(node)
                    if segment is None:
                        continue
                    ifs = [n for n in ast.walk(node) if isinstance(n, ast.If)]
                    tests = [segments.of(n.test) for n in ifs]
                    rows.append((
                        repo, file, node.name, segment.count("\n") + 1, len(ifs),
                        "; ".join(t.strip() for t in tests if t), segment.strip(),
                    ))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema)

    found = files.select(*[F.col(c).cast("string") for c in ("repo", "file", "text")]).mapInArrow(functions, FUNCTION_SCHEMA)
    return has_if_filter(min_lines_filter(found, min_lines), split_type)


def min_lines_filter(functions: DataFrame, min_lines: int = 3) -> DataFrame:
    return functions.filter(F.col("num_lines") >= min_lines)


def has_if_filter(functions: DataFrame, split_type: str = "finetune") -> DataFrame:
    return functions.filter(F.col("num_if") > 0) if split_type == "finetune" else functions
