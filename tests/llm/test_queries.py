"""Each registered query on the smallest tables: its columns, and its rows against its SQL where it has some."""

import glob
import os

import duckdb
import pytest

from surfrank.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op3_language_id": "doc_id held_out lang_pred score",
    "op4_mixing": "doc_id size source_size target taken",
    "op5_topk_search": "query_id rank vec_id score",
    "op6_toxicity": "doc_id held_out score predicted",
    "op7_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op8_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op9_minhash_near_dedup": "doc_id n_shingles component_id kept",
    "op10_html_extraction": "page_id url text n_chars",
    "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12_source_divergence": "lang source part item value rank",
    "op13_simhash_near_dedup": "doc_id fingerprint component_id",
}
TESTED_ELSEWHERE = {"op11_hard_negatives", "op12_source_divergence", "op13_simhash_near_dedup"}


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - TESTED_ELSEWHERE))
def test_query(spark, name):
    df = queries.queries()[name](spark, SF)
    assert set(COLUMNS.get(name, "doc_id").split()) <= set(df.columns)
    rows = df.collect()
    assert rows
    if name in queries.oracle_sql():
        con = duckdb.connect()
        for path in glob.glob(f"{SF}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
        want = con.sql(queries.oracle_sql()[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert sorted((tuple(r[c] for c in want.columns) for r in rows), key=repr) == sorted(want.fetchall(), key=repr)
