"""What op9 holds on disk at a time."""

from surfrank.llm import neardup, tables


def test_tables_go_when_they_are_done_with(spark, monkeypatch):
    rows = [(k, " ".join(f"w{(k // 4) * 40 + i}" for i in range(40)) + f" x{k}") for k in range(40)] + [(100, None), (101, "w1")]
    gone = []

    def deleted(session, paths):
        gone.append(({p.rsplit("/", 1)[1].split("-")[1] for p in paths}, session.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")))
        tables.deleted(session, paths)

    monkeypatch.setattr(neardup, "deleted", deleted)
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()}
    assert got == {k: k // 4 * 4 for k in range(40)} | {100: 100, 101: 101}
    early = set().union(*(names for names, _ in gone[:-1]))
    assert {"values", "pivots", "pairs", "texts"} <= early and not gone[-1][0] & {"values", "pivots", "pairs", "texts"}
    assert {setting for _, setting in gone} == {"true"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
