"""The registered queries: their columns, one row a document, and their SQL where there is some."""

from pathlib import Path

import duckdb
import pytest

from joblark.llm import oracles, queries
from tools.check_oracle import rows_of

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")

COLUMNS = {
    "op1_toxicity": "doc_id held_out score predicted",
    "op2_quality_classifier": "doc_id held_out score predicted",
    "op3_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op4_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_simhash_dedup": "doc_id fingerprint component_id",
    "op6_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op7_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op10_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op11_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op12_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_source_divergence": "lang source part item value rank",
}


def test_every_query_is_known():
    assert set(queries.registry()) == set(COLUMNS)
    assert set(oracles.oracle_sql()) == {"op3_chat", "op6_decontaminate", "op7_suffix_dedup", "op10_substring_dedup", "op12_merkle", "op13_source_divergence"}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, name):
    df = queries.registry()[name](spark, str(DATA))
    rows = df.collect()
    assert df.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    if name == "op11_packing":
        assert len({r.doc_id for r in rows}) == 200
    elif name == "op13_source_divergence":
        assert {r.part for r in rows} == {"pair", "term"}
    else:
        assert len(rows) == (21 if name == "op3_chat" else 200)
    if name in oracles.oracle_sql():
        con = duckdb.connect()
        for path in DATA.glob("*.parquet"):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        result = con.execute(oracles.oracle_sql()[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, rows) == rows_of(columns, result.fetchall())
