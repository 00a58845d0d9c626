"""Sinks and sources: text forms, page count, graph-state records."""

import ast
import glob
import os

import pytest

from conftest import CLEAN, DIRTY
from surfrank import rank_pages
from surfrank.plans.job import resume_from_records, run_job
from surfrank.sources import sinks as SK
from surfrank.sources import state as ST
from surfrank.sources import text as TX


def read_parts(path):
    out = []
    for f in sorted(glob.glob(f"{path}/part-*")):
        with open(f, encoding="utf-8") as fh:
            out.extend(fh.read().splitlines())
    return out


def test_count_line_roundtrip(spark, lines_df, scratch):
    path = scratch()
    TX.write_count(lines_df(DIRTY), path)
    assert read_parts(path) == ["Total Pages-8"]
    assert TX.read_count(spark, path).first().n_lines == 8


def test_tsv_sink_is_globally_ordered(spark, lines_df, scratch):
    res = rank_pages(lines_df(CLEAN), 1, 0.15)
    path = scratch()
    SK.write_ranked(res.ranked(), path, "tsv")
    pairs = [(t, float(r)) for t, r in (line.split("\t") for line in read_parts(path))]
    assert [t for t, _ in pairs] == ["C", "A", "B", "E", "D"]
    assert [r for _, r in pairs] == pytest.approx([0.3275, 0.115, 0.115, 0.0725, 0.03], abs=1e-15)


def test_tuple_forms(spark, lines_df, scratch):
    weird = ["<title>it's</title>[[q\"x]]", '<title>q"x</title>[[back\\slash]]', "<title>é€😀</title>[[it's]]"]
    res = rank_pages(lines_df(weird), 2, 0.15, "rdd_py")
    expected = {r.title: r.rank for r in res.ranks().collect()}
    py, jvm = scratch(), scratch()
    SK.write_ranked(res.ranked(), py, "tuple_py")
    SK.write_ranked(res.ranked(), jvm, "tuple_jvm")
    for line in read_parts(py):
        t, r = ast.literal_eval(line)
        assert line == repr((t, r)) and expected[t] == r
    back = {r.title: r.rank for r in SK.read_ranked(spark, py, "tuple_py").collect()}
    assert back == expected
    back = {r.title: r.rank for r in SK.read_ranked(spark, jvm, "tuple_jvm").collect()}
    assert back == expected
    assert all(l.startswith("(") and l.endswith(")") for l in read_parts(jvm))


def test_state_records_roundtrip_and_resume(spark, lines_df, scratch):
    lines = lines_df(DIRTY)
    two = rank_pages(lines, 2, 0.15)
    path = scratch()
    ST.write_state(ST.layout_records(two.state, two.layout), path)
    first = read_parts(path)[0]
    title, payload = first.split("\t", 1)
    assert payload.startswith('{"pageRank":') and '"isNode":true' in payload
    resumed = resume_from_records(ST.read_state(spark, path), two.n_lines, 3, 0.15)
    direct = rank_pages(lines, 5, 0.15)
    a = {r.title: r.rank for r in resumed.ranks().collect()}
    b = {r.title: r.rank for r in direct.ranks().collect()}
    assert a == pytest.approx(b, abs=1e-15)


def test_state_records_of_large_pages_are_one_record(spark, lines_df):
    n = 100_500
    hub = "<title>H</title>" + " ".join(f"[[t{i % 7}]]" for i in range(n))
    res = rank_pages(lines_df([hub, "<title>t1</title>[[H]]"]), 0, 0.15)
    recs = ST.layout_records(res.state, res.layout)
    h = [r for r in recs.collect() if r.title == "H"]
    assert len(h) == 1 and sorted(h[0].adjacencyList) == sorted(f"t{i % 7}" for i in range(n))
    nodes, edges, ranks = ST.graph_from_records(recs)
    assert {r.id: r.outdeg for r in nodes.collect()}["H"] == n


def test_run_job_mapreduce_layout(spark, lines_df, scratch):
    src = scratch()
    TX.write_lines(lines_df(DIRTY), src)
    out = scratch()
    run_job(spark, src, out, 2, 0.15, "mapreduce", keep_state=True, state_format="text")
    assert read_parts(f"{out}/count") == ["Total Pages-8"]
    assert len(read_parts(f"{out}/parse")) == 7 and len(read_parts(f"{out}/rank-0")) == 7 and len(read_parts(f"{out}/rank-1")) == 7
    assert not os.path.exists(f"{out}/rank-2")
    parse = {line.split("\t", 1)[0]: line for line in read_parts(f"{out}/parse")}
    assert '"pageRank":0.125' in parse["A"]
    pairs = [(t, float(r)) for t, r in (line.split("\t") for line in read_parts(f"{out}/sort"))]
    assert len(pairs) == 7 and pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))


HUB = ["<title>HUB</title>" + " ".join(f"[[p{i}]]" for i in range(40)) + " [[p1]]"] + [f"<title>p{i}</title>[[HUB]] [[p{i + 1}]]" for i in range(20)]


@pytest.mark.parametrize("form", ["parquet", "text"])
@pytest.mark.parametrize("options", [{}, {"hot_floor": 1}, {"hot_floor": 1, "hot_broadcast_bytes": 0}])
def test_run_job_goes_on_from_a_kept_folder(spark, lines_df, scratch, form, options):
    src, whole, kept, other = scratch(), scratch(), scratch(), scratch()
    TX.write_lines(lines_df(DIRTY + HUB), src)
    run_job(spark, src, whole, 4, 0.15, "mapreduce")
    run_job(spark, src, kept, 1, 0.15, "mapreduce", 4, keep_state=True, state_format=form, **options)
    run_job(spark, None, other, 3, 0.15, "mapreduce", 3, keep_state=True, state_format=form, resume_from=f"{kept}/rank-0", **options)
    folders = ["count", "rank-1", "rank-2", "rank-3", "sort"]
    assert sorted(d for d in os.listdir(other) if "." not in d) == (folders if form == "text" else sorted([*folders, "edges"]))
    ranks = lambda out: {t: float(r) for t, r in (line.split("\t") for line in read_parts(f"{out}/sort"))}
    assert ranks(other) == pytest.approx(ranks(whole)) and read_parts(f"{other}/count") == read_parts(f"{whole}/count")
    if not options:
        with pytest.raises(FileExistsError):
            run_job(spark, None, kept, 1, 0.15, "mapreduce", keep_state=True, state_format=form, resume_from=f"{kept}/parse")
        with pytest.raises(ValueError):
            run_job(spark, None, scratch(), 1, 0.15, "rdd_py", resume_from=f"{kept}/rank-0")


def test_kept_state_is_tables_with_the_edges_once(spark, lines_df, scratch):
    src, kept, text = scratch(), scratch(), scratch()
    TX.write_lines(lines_df(DIRTY + HUB), src)
    res = run_job(spark, src, kept, 2, 0.15, "mapreduce", 4, keep_state=True, hot_floor=1)
    assert res.layout.n_hot > 0
    assert sorted(d for d in os.listdir(kept) if "." not in d) == ["count", "edges", "parse", "rank-0", "rank-1", "sort"]
    for folder in ("parse", "rank-0", "rank-1"):
        nodes, edges = ST.read_kept(spark, f"{kept}/{folder}")
        assert spark.read.parquet(f"{kept}/{folder}").dtypes == [("id", "string"), ("outdeg", "bigint"), ("rank", "double")]
        degrees = {r.src: r.n for r in edges.groupBy("src").agg({"mult": "sum"}).toDF("src", "n").collect()}
        assert {r.id: r.outdeg for r in nodes.collect() if r.outdeg} == degrees and degrees["HUB"] == 41
    assert spark.read.parquet(f"{kept}/edges").dtypes == [("src", "string"), ("dst", "string"), ("mult", "bigint")]
    # going on in the same folder shares its edges, and the text form is an export
    run_job(spark, None, kept, 1, 0.15, "mapreduce", 4, keep_state=True, resume_from=f"{kept}/rank-1", mode="overwrite")
    assert "rank-2" in os.listdir(kept)
    ST.export_state(spark, f"{kept}/rank-2", text)
    records = {r.title: r for r in ST.read_state(spark, text).collect()}
    assert sorted(records["HUB"].adjacencyList) == sorted([f"p{i}" for i in range(40)] + ["p1"])
    assert {t: r.pageRank for t, r in records.items()} == {r.id: r.rank for r in ST.read_kept(spark, f"{kept}/rank-2")[0].collect()}


def test_run_job_refuses_existing_output_before_any_work(spark, lines_df, scratch):
    out = scratch()
    TX.write_lines(lines_df(["x"]), f"{out}/sort")
    with pytest.raises(FileExistsError):
        run_job(spark, scratch() + "/no-such-input", out, 2, 0.15, "mapreduce")


def test_run_job_rdd_layout(spark, lines_df, scratch):
    src = scratch()
    TX.write_lines(lines_df(DIRTY), src)
    out = scratch()
    run_job(spark, src, out, 2, 0.15, "rdd_py")
    ranking = [ast.literal_eval(line) for line in read_parts(out)]
    assert len(ranking) == 9 and ranking == sorted(ranking, key=lambda p: (-p[1], p[0]))
    with pytest.raises(ValueError):
        run_job(spark, src, scratch(), 2, 0.15, "rdd_py", keep_state=True)


def test_layout_release_deletes_only_its_tables(lines_df):
    import os

    res = rank_pages(lines_df(CLEAN), 1, 0.15)
    paths = [p.replace("file:", "") for p in res.layout.written]
    spark, tables = res.state.sparkSession, res.layout.tables
    assert paths and all(os.path.exists(p) for p in paths)
    assert tables and all(spark.catalog.tableExists(t) for t in tables)
    ranks_before = {r.title: r.rank for r in res.ranks().collect()}
    res.layout.release()
    assert not any(os.path.exists(p) for p in paths) and not any(spark.catalog.tableExists(t) for t in tables)
    # the final state is its own checkpoint and stays readable
    assert {r.title: r.rank for r in res.ranks().collect()} == ranks_before


def test_command_line(scratch):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    src, out = scratch(), scratch()
    os.makedirs(src)
    with open(os.path.join(src, "in.txt"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(CLEAN) + "\n")
    env = dict(os.environ, PYTHONPATH=root)
    # five arguments: <input> <output> <iterations> <reducers> <alpha>
    subprocess.run(
        [sys.executable, "-m", "surfrank", src, out, "1", "3", "0.15"],
        check=True, env=env, cwd=root, capture_output=True, timeout=300,
    )
    ranking = [line.split("\t")[0] for line in read_parts(f"{out}/sort")]
    assert ranking == ["C", "A", "B", "E", "D"]
    assert read_parts(f"{out}/count") == ["Total Pages-5"]
    # four arguments: <input> <output> <iterations> <alpha>, Python pair form
    out2 = scratch()
    subprocess.run(
        [sys.executable, "-m", "surfrank", src, out2, "1", "0.15", "--preset", "rdd_py"],
        check=True, env=env, cwd=root, capture_output=True, timeout=300,
    )
    assert [ast.literal_eval(line)[0] for line in read_parts(out2)] == ["C", "A", "B", "E", "D"]


def test_line_source_endings_compression_and_folders(spark, scratch):
    import gzip
    import os

    folder = scratch()
    os.makedirs(folder)
    with open(os.path.join(folder, "a.txt"), "wb") as fh:
        fh.write(b"<title>A</title>[[B]]\r<title>B</title>[[A]]\r\n<title>C</title>\n\n")
    with gzip.open(os.path.join(folder, "b.txt.gz"), "wb") as fh:
        fh.write("<title>é</title>[[A]]\n".encode("utf-8"))
    lines = sorted(r.value for r in TX.read_lines(spark, folder).collect())
    assert lines == ["", "<title>A</title>[[B]]", "<title>B</title>[[A]]", "<title>C</title>", "<title>é</title>[[A]]"]
    res = rank_pages(TX.read_lines(spark, folder), 1, 0.15)
    assert res.n_lines == 5
    assert {r.title for r in res.ranks().collect()} == {"A", "B", "C", "é"}


def test_state_records_with_hot_sources(spark, lines_df):
    hub = "<title>H</title>" + " ".join(f"[[t{i}]]" for i in range(40)) + " [[t1]] [[t1]]"
    lines = [hub] + [f"<title>t{i}</title>[[H]] [[t{(i + 1) % 40}]]" for i in range(40)]
    res = rank_pages(lines_df(lines), 1, 0.15, num_partitions=4, hot_floor=1)
    assert res.layout.n_hot > 0
    recs = {r.title: r for r in ST.layout_records(res.state, res.layout).collect()}
    ranks = {r.title: r.rank for r in res.ranks().collect()}
    assert set(recs) == set(ranks)
    assert sorted(recs["H"].adjacencyList) == sorted([f"t{i}" for i in range(40)] + ["t1", "t1"])
    assert all(recs[t].pageRank == ranks[t] for t in ranks)


def test_resume_from_records_of_a_hub(spark, lines_df, scratch):
    hub = "<title>H</title>" + " ".join(f"[[t{i % 9}]]" for i in range(30))
    lines = [hub] + [f"<title>t{i}</title>[[H]] [[t{(i + 2) % 9}]]" for i in range(9)] + ["<title>lone</title>"]
    two = rank_pages(lines_df(lines), 2, 0.15)
    path = scratch()
    ST.write_state(ST.layout_records(two.state, two.layout), path)
    back = ST.read_state(spark, path)
    assert back.where("title = 'H'").count() == 1
    resumed = resume_from_records(back, two.n_lines, 3, 0.15)
    direct = rank_pages(lines_df(lines), 5, 0.15)
    a = {r.title: r.rank for r in resumed.ranks().collect()}
    b = {r.title: r.rank for r in direct.ranks().collect()}
    assert a == pytest.approx(b, abs=1e-15)


def test_state_record_with_escaped_json_parses(spark):
    line = 'A\t{"pageRank":0.2,"adjacencyList":["\\u003cb\\u003e","x\\u0026y","it\\u0027s","a\\u003db"],"isNode":true}'
    recs = ST.parse_record_lines(spark.createDataFrame([(line,)], "value string")).collect()
    assert len(recs) == 1 and recs[0].title == "A" and recs[0].pageRank == 0.2 and recs[0].isNode
    assert list(recs[0].adjacencyList) == ["<b>", "x&y", "it's", "a=b"]


def test_other_line_column_and_awkward_titles(spark, scratch):
    rows = [("<title>a,b (c)</title>[[x\ty]]",), ("<title>x\ty</title>[[a,b (c)]]",)]
    df = spark.createDataFrame(rows, "body string")
    res = rank_pages(df, 2, 0.15, "rdd_py", column="body")
    expected = {r.title: r.rank for r in res.ranks().collect()}
    assert set(expected) == {"a,b (c)", "x\ty"}
    for fmt in ("tuple_jvm", "tsv", "tuple_py"):
        path = scratch()
        SK.write_ranked(res.ranked(), path, fmt)
        back = {r.title: r.rank for r in SK.read_ranked(spark, path, fmt).collect()}
        assert back == expected, fmt


def test_parquet_ranking_sink(spark, lines_df, scratch):
    res = rank_pages(lines_df(CLEAN), 1, 0.15)
    path = scratch()
    SK.write_ranked_parquet(res.ranked(), path)
    back = {r.title: r.rank for r in spark.read.parquet(path).collect()}
    assert back == {r.title: r.rank for r in res.ranks().collect()}
    with pytest.raises(Exception, match="already exists"):
        SK.write_ranked_parquet(res.ranked(), path)


@pytest.mark.parametrize("args", [["in", "out", "1"], ["in", "out", "1", "2", "3", "4"], ["in", "out", "1", "abc"]])
def test_command_line_rejects_bad_arguments(args):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run(
        [sys.executable, "-m", "surfrank", *args], env=dict(os.environ, PYTHONPATH=root),
        cwd=root, capture_output=True, timeout=120,
    )
    assert proc.returncode != 0
