"""Registered queries: their SQL, their columns, and what they read."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from grantlens.llm import queries
from tests.llm.helpers import SF
from tools import check


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    verdict, _, _ = check.compare(spark, duck, name, SF)
    assert verdict == "ok"


def test_every_operator_has_one_query():
    names = [n for n in contract.queries() if n in queries.QUERIES]
    assert sorted(n.split("_")[0] for n in names) == sorted([f"op{k}" for k in range(1, 14)] + ["pipeline"])


# The columns each result must carry.
COLUMNS = {
    "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op2_edit_embedding": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_html": "page_id url text n_chars",
    "op7_quality": "doc_id held_out score predicted",
    "op8_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11_toxicity": "doc_id held_out score predicted",
    "op12_importance": "doc_id n_features weight score rank",
    "op13_zones": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    kinds = dict(queries.QUERIES[name](spark, SF).dtypes)
    assert set(COLUMNS[name].split()) <= set(kinds)
    for column, kind in kinds.items():
        if column.startswith("n_"):
            assert kind == "bigint"
