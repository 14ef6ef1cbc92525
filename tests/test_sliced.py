import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.functions.sliced import SLICE_ROWS, by_slices, record_slices
from corpusloom.operators.bpe import EXTRA_IDS, SPECIAL_TOKENS
from corpusloom.operators.encoding import _pieces
from corpusloom.operators.python_code import extract_python_functions


def test_only_a_slice_is_python_objects():
    """Inputs of a slice are gone before those of the next are made; an array comes out for each batch."""
    sizes = []

    def of(value):
        sizes.append(value)
        return None if value is None else [value]

    batches = [pa.array(["x", None] * 300), pa.array([], pa.string())]
    out = list(by_slices(iter(batches), of, pa.list_(pa.string())))
    assert [len(o) for o in out] == [600, 0] and len(sizes) == 600
    assert out[0].to_pylist()[:2] == [["x"], None]
    record = pa.RecordBatch.from_pydict({"a": list(range(2 * SLICE_ROWS + 1))})
    assert [s.num_rows for s in record_slices(iter([record]))] == [SLICE_ROWS, SLICE_ROWS, 1]


def test_functions_go_through_arrow_slices(spark):
    files = spark.createDataFrame([("r", f"{i}.py", "def f(x):\n    if x:\n        return x\n") for i in range(600)], "repo string, file string, text string")
    found = extract_python_functions(files, "finetune")
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 600 and found.select("source", "ifs").distinct().collect() == [("def f(x):\n    if x:\n        return x", "x")]


def test_special_tokens_are_tried_at_their_first_character_only(spark):
    special = [*SPECIAL_TOKENS, *EXTRA_IDS]
    text = "a <mask>b<<s></s>> <extra_id_1><extra_id_12> <pad<mask> if x < 3 > 2"
    df = spark.createDataFrame([(text,), ("",), (None,), ("plain",)], "text string")
    pieces = df.select(_pieces(F.col("text"), special).alias("p"))
    assert "(?=[<])" in pieces._jdf.queryExecution().analyzed().toString()
    rows = [r["p"] for r in pieces.collect()]
    assert [p for p in rows[0] if p in special] == ["<mask>", "<s>", "</s>", "<extra_id_1>", "<extra_id_12>", "<mask>"]
    assert rows[1:] == [[], None, [" plain"]]
