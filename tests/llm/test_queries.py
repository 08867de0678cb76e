from __future__ import annotations

import re

import pytest

from checks.compare import differences, duck
from ledgerloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    1: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    2: "doc_id held_out lang_pred score",
    3: "doc_id held_out score predicted",
    4: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    5: "doc_id size text_crc32 law shard slot grown_shard",
    6: "vec_id n_links component_id kept",
    7: "doc_id n_words n_base first_word last_word base_labels labels score",
    8: "doc_id item_id item_shingles found containment",
    9: "doc_id text n_email n_ip n_date n_ssn n_phone n_key n_card",
    10: "doc_id n_shingles component_id kept",
    11: "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    12: "doc_id n_lines n_dropped kept_sha256",
    13: "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


def test_one_query_for_each_operator():
    numbers = sorted(int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "pipeline"])
def test_whole_tables(spark, name):
    number = int(re.match(r"op(\d+)_", name)[1])
    got = QUERIES[name](spark, SF_DIR)
    assert got.columns == COLUMNS[number].split()
    if number in (2, 3, 5, 7, 9, 10, 12):
        assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_duckdb(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], duck(SF_DIR)) == []
