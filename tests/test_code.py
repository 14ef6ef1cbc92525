import pytest
from pyspark.sql import functions as F

from corpusloom.operators import java_code, masking, python_code
from corpusloom.plans.java_corpus import METHOD_COLUMNS, mine_java_methods

MODULE = '''\
import os

@deco
def outer(a, b):
    if a > (b and
            1):
        return 1
    elif a.b[0] == "if":
        def inner(): return 2
    x = 1 if a else 2
    return x

class C:
    async def m(self):
        if self.y: pass

        return None

def two(): \\
    pass
'''


@pytest.fixture(scope="module")
def functions(spark):
    files = spark.createDataFrame(
        [("r", "ok.py", MODULE), ("r", "bad.py", "def f(:\n"), ("r", "nul.py", "a\0b"), ("s", "none.py", None)],
        "repo string, file string, text string",
    )
    return python_code.extract_python_functions(files, min_lines=1).collect()


def test_functions(functions):
    got = {r.function_name: r for r in functions}
    assert [r.function_name for r in functions] == ["outer", "two", "m", "inner"]  # breadth-first
    assert got["outer"].ifs == 'a > (b and\n            1); a.b[0] == "if"' and got["outer"].num_if == 2
    assert got["outer"].source.startswith("def outer") and got["outer"].num_lines == 8
    assert got["m"].source.startswith("async def m") and got["m"].num_lines == 4
    assert got["inner"].num_if == 0 and got["two"].num_lines == 2


def test_function_filters(spark, functions):
    df = spark.createDataFrame(functions)
    assert {r.function_name for r in python_code.min_lines_filter(df).collect()} == {"outer", "m"}
    assert {r.function_name for r in python_code.has_if_filter(df).collect()} == {"outer", "m"}
    assert python_code.has_if_filter(df, "pretrain").count() == 4


def test_if_conditions(spark):
    df = spark.createDataFrame([(MODULE,), ("if x:",), (None,), ("if  a  :\n  pass",)], "code string")
    got = [r[0] for r in df.select(python_code.if_conditions(F.col("code"))).collect()]
    assert got == [['a > (b and\n            1)', 'a.b[0] == "if"', "self.y"], [], [], ["a"]]


def test_mask_if(spark):
    rows = [
        (1, "y = a.*\nif a.*b > $1:\n  pass", None), (2, "", "x = 1\nif x: pass"), (3, "notify = 1", None), (4, None, None),
        (5, "z = 'x == 1'\nif x == 1:\n  pass", None), (6, "if broken", None),
    ]
    df = spark.createDataFrame(rows, "id int, source string, code string")
    got = {r.id: (r.input_text, r.target_text) for r in masking.mask_if_condition(df, "id").collect()}
    assert got == {
        2: ("<mask> = 1\nif x: pass", "x"),
        5: ("z = '<mask>'\nif x == 1:\n  pass", "x == 1"),
    }


def test_mask_random(spark):
    texts = ["a b", "a b c", " ".join(f"w{i}" for i in range(20)), None, " x\ty\nz "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, source string")
    one = {r.id: r for r in masking.mask_random_tokens(df, "id").collect()}
    two = {r.id: r for r in masking.mask_random_tokens(df.repartition(5), "id").collect()}
    assert one == two and set(one) == {1, 2, 4}
    for i, n in ((1, 1), (2, 3), (4, 1)):
        masked, targets = one[i].input_text.split(" "), one[i].target_text.split(" ")
        assert masked.count("<mask>") == len(targets) == n
        hidden = [t for t, m in zip(texts[i].split(), masked) if m == "<mask>"]
        assert sorted(hidden) == sorted(targets)
        assert [t for t, m in zip(texts[i].split(), masked) if m != "<mask>"] == [m for m in masked if m != "<mask>"]


JAVA = """package p;
import a.b;
/* gone */
public class A<T> {
    // int no() { }
    private final String s = "int quoted() {";
    public A(int x) { this.x = x; }

    @Override
    public <R> List<R> both(final Map<String, List<R>> m, @Named("x") int... rest) throws E, F {
        if (rest == null) { return run(m); }
        new Foo(1) { };
        for (int i = 0; i < 3; i++) { }
        return x >> 2;
    }
    abstract void none();
    int[] more(a.b.C c, int d[])
    {
        return null;
    }
}
"""


def test_java_methods(spark):
    df = spark.createDataFrame([(JAVA,)], "source_code string")
    rows = java_code.find_java_methods(df).withColumn(
        "sig", java_code.method_signature(F.col("return_type"), F.col("method_name"), F.col("params"))
    ).collect()
    assert [(r.sig, r.start_line) for r in rows] == [
        ("List both(Map m, int rest)", 10), ("void none()", 16), ("int more(a c, int d)", 17),
    ]


def test_java_tokens(spark):
    code = 'a>>=b>>c; "q, \\" x" \'\\\'\' 0x1F_L 1.5e-3f .5 @A x::y -> ... λ_$1'
    got = spark.range(1).select(java_code.tokenize_java(F.lit(code))).first()[0]
    assert got == [
        "a", ">>=", "b", ">", ">", "c", ";", '"q, \\" x"', "'\\''", "0x1F_L", "1.5e-3f", ".5", "@", "A", "x", "::", "y", "->", "...", "λ_$1",
    ]


def test_java_cleaning(spark):
    df = spark.createDataFrame([('import x;\n  import y;\nint a; // c\n/* b\n */ int b; /* // */ s = "http://x";\n\n',)], "c string")
    got = df.select(java_code.clean_comments(java_code.strip_imports(F.col("c")))).first()[0]
    # The line comment goes first and takes the end of the second block comment along.
    assert got == 'int a; \n int b; /* '


@pytest.mark.parametrize("code, ok", [
    ("class A { int[] x = {1}; }", True), ("class A { ", False), ("class A } {", False), ("( ]", False), ("  ", False),
    ('s = "un', False), ("a # b", False), ('s = "}";', True), ("c = '{';", True),
])
def test_lexable(spark, code, ok):
    assert spark.range(1).select(java_code.lexable(F.lit(code))).first()[0] is ok


def commits(spark):
    body = lambda m: "class A {\n" + "\n".join(f"  int m{i}() {{ return {i}; }}" for i in range(m)) + "\n}\n"
    files = [
        ("r1", 0, 0, 0, "A.java", body(3)), ("r1", 0, 1, 0, "A.java", body(4)), ("r1", 0, 2, 0, "x/archetype-resources/A.java", body(4)),
        ("r2", 1, 0, 0, None, body(4)), ("r2", 1, 0, 1, "B.java", ""), ("r2", 1, 1, 0, "B.kt", body(4)),
        ("r2", 1, 2, 0, "B.java", body(5) + "}"), ("r2", 1, 3, 0, "B.java", body(997)), ("r2", 1, 4, 0, "B.java", body(2)),
        ("r2", 1, 5, 0, "B.java", body(998)), ("r2", 1, 6, 0, "B.java", body(1)), ("r3", 2, 0, 0, "C.java", body(6)),
    ]
    df = spark.createDataFrame(files, "repo_name string, repo_seq int, commit_seq long, file_seq int, file_path string, source_code string")
    return df.withColumns({
        "repo_url": F.concat(F.lit("https://h/o/"), "repo_name"), "commit_sha": F.lit("x"),
        "file_name": F.coalesce(F.element_at(F.split("file_path", "/"), -1), F.lit("A.java")),
    })


def test_mining(spark):
    rows = mine_java_methods(commits(spark), 24, "train").collect()
    assert rows[0].asDict().keys() == set(METHOD_COLUMNS)
    by_repo = {}
    for r in rows:
        by_repo.setdefault(r.repo_name, []).append(r)
    # r1: 3 + 4 methods, six allowed; r2: 4 methods, then 997 of the largest file that still fits, two
    # of them allowed; r3: 6.
    assert {k: len(v) for k, v in by_repo.items()} == {"r1": 6, "r2": 6, "r3": 6}
    capped = mine_java_methods(commits(spark), 24, "train").collect()
    assert len(capped) == 18
    r = next(r for r in by_repo["r1"] if r.method_name == "m1")
    assert (r.start_line, r.end_line, r.signature) == (3, 7, "int m1()") or (r.start_line, r.end_line) == (3, 8)
    assert r.code_tokens.startswith("class, A, {, int, m0, (, ), {, return, 0, ;")


def test_global_cap_and_licenses(spark):
    few = mine_java_methods(commits(spark), 8, "eval").collect()
    assert len(few) == 6 and {r.dataset_split for r in few} == {"eval"}
    licenses = spark.createDataFrame([("r1", "mit"), ("r2", "agpl-3.0"), ("r3", None)], "repo_name string, license_key string")
    assert {r.repo_name for r in mine_java_methods(commits(spark), 24, "train", licenses).collect()} == {"r1"}
