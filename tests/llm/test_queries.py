"""The registered queries over the test tables, against SQL where there is some."""

import os

import pytest

from asterloom.llm.queries import LLM_QUERIES, ORACLE_SQL
from tests.test_queries import compare, connect

COLUMNS = {
    "op1": "doc_id held_out lang_pred score",
    "op2": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3": "page_id payload_bytes payload_digest record_type refers_to",
    "op4": "doc_id n_words n_removed kept_sha256",
    "op5": "doc_id fingerprint component_id",
    "op6": "doc_id low_quality_score toxic_score low_quality toxic",
    "op7": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op8": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op10": "page_id url text n_chars",
    "op11": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12": "query_id rank vec_id score",
    "op13": "lang rank phrase a l r n score",
}
#: Queries that give another number of rows than their table has.
OTHER_COUNTS = ("op2", "op12", "op13")



@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_operator_has_a_query():
    assert sorted(n.split("_")[0] for n in LLM_QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", LLM_QUERIES)
def test_columns_and_rows(spark, sf_dir, name):
    out = LLM_QUERIES[name](spark, sf_dir)
    short = name.split("_")[0]
    assert " ".join(out.columns) == COLUMNS[short]
    table = spark.read.parquet(f"{sf_dir}/{'pages' if short in ('op3', 'op10') else 'documents'}.parquet")
    assert out.count() == table.count() or short in OTHER_COUNTS


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert os.path.isdir(sf_dir)
    compare_names(spark, duck, sf_dir, name)


def compare_names(spark, duck, sf_dir, name):
    import __spark_entry__ as contract

    assert contract.queries()[name] is LLM_QUERIES[name]
    compare(spark, duck, sf_dir, name)
