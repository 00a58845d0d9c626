"""The operators here say what bounds each table they bring to the driver, and cut no lineage locally."""

import pathlib

LLM = pathlib.Path(__file__).resolve().parents[2] / "surfrank" / "llm"


def test_collects_name_their_bound():
    lines = [(p.name, n, x) for p in LLM.glob("*.py") for n, x in enumerate(p.read_text().splitlines(), 1)]
    assert not [x for x in lines if ".collect()" in x[2] and "bounded by" not in x[2]]
    assert not [x for x in lines if "local" + "Checkpoint" in x[2] or "cross" + "Join" in x[2] or "toPandas" in x[2]]
