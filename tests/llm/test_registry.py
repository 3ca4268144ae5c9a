"""Every query of the corpus operators, over the whole small tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from millrace.llm import registry

TABLES = Path("/root/testdata/sf0.001")
#: The columns that are promised, and the table of which every row has one.
PROMISED = {
    "op1_license_dice": ({"doc_id"}, "documents"),
    "op2_role_repair": ({"conv_id", "turn", "new_role", "fragment"}, "conversations"),
    "op3_minmax_neardup": ({"doc_id", "n_shingles", "component_id", "kept"}, "documents"),
    "op4_spaced_seeds": ({"doc_id", "n_items", "item_ids", "kept"}, "documents"),
    "op5_repair_tokens": ({"doc_id", "start", "n_tokens", "ids_crc32"}, "documents"),
    "op6_toxicity": ({"doc_id", "held_out", "score", "predicted"}, "documents"),
    "op7_binary_packing": ({"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}, None),
    "op8_decision_list": ({"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"}, "documents"),
    "op9_secret_network": ({"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}, "documents"),
    "op10_warc_derivatives": (set(), None),
}


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, str(TABLES))
    columns, table = PROMISED[name]
    rows = df.collect()
    assert columns <= set(df.columns) and rows
    if table:
        key = "conv_id" if table == "conversations" else "doc_id"
        theirs = duckdb.sql(f"select {key} from '{TABLES}/{table}.parquet'").fetchall()
        assert sorted(r[key] for r in rows) == sorted(x[0] for x in theirs)
