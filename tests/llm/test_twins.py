"""The registered queries against their SQL twins, and the columns of those without."""

import __spark_entry__ as entry_module
import pytest
from check import compare, connect

from lakeops.llm import catalog

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op3": "doc_id n_bytes n_tokens over_limit",
    "op4": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5": "doc_id size source_size target taken",
    "op6": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op7": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op9": "doc_id piece start length ids_crc32 sequence_id offset",
}


@pytest.mark.parametrize("name", list(catalog.ORACLE))
def test_twin(spark, name):
    status, note = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert status == "ok", note


def test_every_operator_has_its_query():
    found = [q.split("_")[0] for q in catalog.QUERIES]
    assert sorted(found) == sorted(f"op{n}" for n in range(1, 14)) and "pipeline" in entry_module.queries()


@pytest.mark.parametrize("name", [q for q in catalog.QUERIES if q.split("_")[0] in COLUMNS])
def test_columns(spark, name):
    assert catalog.QUERIES[name](spark, SF_DIR).columns == COLUMNS[name.split("_")[0]].split()
