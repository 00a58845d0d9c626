"""Failure behaviour the presets promise."""

import pytest

from conftest import DIRTY
from surfrank import rank_pages
from surfrank.sources.sinks import write_ranked


def test_rdd_jvm_fails_on_malformed_line(lines_df):
    with pytest.raises(Exception, match="unparsable page title"):
        rank_pages(lines_df(DIRTY), 1, 0.15, "rdd_jvm")


def test_mapreduce_fails_on_empty_input(lines_df):
    with pytest.raises(ValueError, match="empty input"):
        rank_pages(lines_df([]), 1, 0.15, "mapreduce")


@pytest.mark.parametrize("preset", ["rdd_py", "rdd_jvm"])
def test_rdd_presets_give_empty_ranking_on_empty_input(lines_df, preset):
    assert rank_pages(lines_df([]), 2, 0.15, preset).ranked().count() == 0


def test_existing_sink_path_is_refused(lines_df, scratch):
    res = rank_pages(lines_df(DIRTY[:5]), 1, 0.15)
    path = scratch()
    write_ranked(res.ranked(), path)
    with pytest.raises(Exception, match="already exists"):
        write_ranked(res.ranked(), path)


def test_checkpoint_folder_required_on_a_cluster():
    from types import SimpleNamespace

    from surfrank.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_checkpoint_folder_is_read_from_the_session(spark):
    from surfrank.session import checkpoint_dir

    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_no_parsable_line_gives_empty_ranking(lines_df):
    res = rank_pages(lines_df(["no heading [[x]]", "", "still none"]), 3, 0.15, "mapreduce")
    assert res.n_lines == 3 and res.ranked().count() == 0


def test_partition_count_rules(spark):
    from surfrank.plans.job import GraphStats, _partitions
    from surfrank.session import job_conf

    floor = spark.sparkContext.defaultParallelism
    assert _partitions(spark, 5, GraphStats(1, 10**9)) == 5
    with job_conf(spark, {"spark.sql.shuffle.partitions": "64"}):
        assert _partitions(spark, None, GraphStats(1, 10)) == floor
        assert _partitions(spark, None, GraphStats(1, 10**9)) == max(floor, 500)  # the session setting is no cap
    with pytest.raises(ValueError):
        _partitions(spark, 0, GraphStats(1, 10))


def test_preset_switches_are_validated():
    from surfrank.plans.presets import MAPREDUCE

    with pytest.raises(ValueError, match="blank_links"):
        MAPREDUCE.with_options(blank_links="drop")
    assert MAPREDUCE.with_options(text_scope=True).text_scope
