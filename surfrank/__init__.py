"""surfrank: link analysis on Spark DataFrames.

Reads line-oriented wiki-style page dumps, builds a weighted link graph and
ranks every vertex with a fixed number of random-surfer steps.
"""

from surfrank.plans.job import RankResult, rank_pages, ranking_output, resume_from_records, resume_from_tables, run_job
from surfrank.sources.text import read_lines
from surfrank.plans.presets import MAPREDUCE, PRESETS, RDD_JVM, RDD_PY, Preset, get_preset

__all__ = [
    "MAPREDUCE",
    "PRESETS",
    "Preset",
    "RDD_JVM",
    "RDD_PY",
    "RankResult",
    "get_preset",
    "rank_pages",
    "ranking_output",
    "read_lines",
    "resume_from_records",
    "resume_from_tables",
    "run_job",
]
