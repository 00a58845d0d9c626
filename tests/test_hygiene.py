"""Static checks on the library source: the patterns the design rules out."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1]
#: The ranking engine; the optional training-data operators have rules and tests of their own.
LIBRARY = sorted(p for p in (ROOT / "surfrank").rglob("*.py") if "llm" not in p.parts) + [ROOT / "__spark_entry__.py"]

FORBIDDEN = {
    "localCheckpoint": r"localCheckpoint",
    "RDD API": r"\.rdd\b|mapPartitions\(|parallelize\(",
    "driver collect": r"\.collect\(\)|\.toPandas\(\)",
    "row-at-a-time Python UDF": r"\bF\.udf\(|@udf\b|\budf\(",
    "cross join": r"crossJoin\(|how=\"cross\"|, \"cross\"\)",
    "single-partition funnel": r"coalesce\(1\)|repartition\(1\)",
}


def test_library_avoids_forbidden_patterns():
    hits = []
    for path in LIBRARY:
        for n, line in enumerate(path.read_text(encoding="utf-8").splitlines(), 1):
            code = line.split("#", 1)[0]
            for name, pattern in FORBIDDEN.items():
                if re.search(pattern, code):
                    hits.append(f"{path.relative_to(ROOT)}:{n}: {name}: {line.strip()}")
    assert not hits, "\n".join(hits)


def test_python_in_tasks_is_limited_to_the_output_helpers():
    pandas_udfs = []
    for path in LIBRARY:
        text = path.read_text(encoding="utf-8")
        pandas_udfs += [(path.name, m.start()) for m in re.finditer(r"pandas_udf", text)]
    assert {name for name, _ in pandas_udfs} <= {"render.py"}
