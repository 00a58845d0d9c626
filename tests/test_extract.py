"""Title and link rules per line, including the cases where implementations disagree."""

import pytest
from pyspark.sql import functions as F

from surfrank.functions import extract as E
from surfrank.plans.presets import MAPREDUCE

TAB = "\t"
CASES = [
    # line, regex title (None = skipped), positional (python slice), links
    ("<title>A</title>[[x]][[y|z]]", "A", "A", ["x", "y|z"]),
    ('<title a="1">A</title>[[]][[q]]', "A", ' a="1">A', ["", "q"]),
    ("<titles>x</titles><title>y</title>", "x</titles><title>y", "y", []),
    ("no heading [[Z]]", None, "ding [[Z]", ["Z"]),
    ("", None, "", []),
    ("<title>no close [[k]]", None, "no close [[k]", ["k"]),
    ("</title><title>", None, "", []),
    ("[[[n]]] <title></title>", "", "", ["[n"]),
    ("abcdefgh</title> [[x]]", None, "gh", ["x"]),
]


@pytest.fixture()
def cases(spark):
    return spark.createDataFrame([(c[0],) for c in CASES], "value string")


def test_regex_title(cases):
    got = [r.t for r in cases.select(E.title_regex("value").alias("t")).collect()]
    assert got == [c[1] for c in CASES]


def test_positional_title_python_slice(cases):
    got = [r.t for r in cases.select(E.title_positional("value", "slice").alias("t")).collect()]
    assert got == [c[2] for c in CASES]


def test_positional_title_strict_skips(cases):
    got = [r.t for r in cases.select(E.title_positional("value", "skip").alias("t")).collect()]
    assert got == ["A", ' a="1">A', "y", None, None, None, None, "", "gh"]


def test_links(cases):
    got = [list(r.l) for r in cases.select(E.outlinks("value").alias("l")).collect()]
    assert got == [c[3] for c in CASES]


def test_tabs_normalised_only_under_mr(spark):
    df = spark.createDataFrame([(f"<title>t{TAB}u</title>[[a{TAB}b]]",)], "value string")
    title, links = E.parse_line(F.col("value"), MAPREDUCE)
    r = df.select(title, links).first()
    assert r.title == "t u" and list(r.outlinks) == ["a b"]
    r = df.select(E.title_positional("value"), E.outlinks("value").alias("l")).first()
    assert r[0] == f"t{TAB}u" and list(r.l) == [f"a{TAB}b"]


def test_link_dot_rules(spark):
    df = spark.createDataFrame([("<title>u</title>[[a b]]",)], "value string")
    r = df.select(
        F.size(E.outlinks("value", "java")).alias("j"), F.size(E.outlinks("value", "newline_only")).alias("p")
    ).first()
    assert (r.j, r.p) == (0, 1)


def test_text_scope(spark):
    df = spark.createDataFrame(
        [("<title>T</title>[[out]]<text x=1>[[in1]] [[in2]]</text>",), ("<title>T</title>[[x]]",)], "value string"
    )
    got = [list(r.l) for r in df.select(E.outlinks_text_scope("value").alias("l")).collect()]
    assert got == [["in1", "in2"], []]


def test_the_two_dot_rules_differ_on_line_separators(spark):
    from surfrank import fixtures as X

    rows = X.lines(spark, "/root/testdata/sf0.001", "ws").select(E.outlinks("value", "java").alias("j"), E.outlinks("value", "newline_only").alias("p"), E.title_regex("value").alias("t")).collect()
    assert all(r.j != r.p and "b\u2028c" in r.p and "b\u2028c" not in r.j and "\x0b" in r.j for r in rows)
    assert any(r.t is None for r in rows) and any(r.t is not None for r in rows)
