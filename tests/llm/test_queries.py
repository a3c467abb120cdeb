"""Registered corpus queries against their SQL, and their contracts."""

import subprocess
import sys

import pytest

from check_queries import SAME_TYPES, compare, connect
from conftest import ROOT
from driftwise.llm.queries import QUERIES, TWINS

COLUMNS = {
    "op1_extraction": "page_id url text n_chars",
    "op2_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4_near_dedup": "doc_id n_shingles component_id kept",
    "op5_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op6_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op7_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8_licenses": "doc_id license template matched_words template_words coverage start end",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op11_lexical_search": "item_id rank doc_id score",
    "op12_url_filter": "page_id host path rule verdict",
    "op13_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "pipeline": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}


def test_every_operator_is_registered():
    assert set(QUERIES) == set(COLUMNS) and set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, sf_dir, name):
    df, twin = QUERIES[name](spark, sf_dir), connect(sf_dir).sql(TWINS[name])
    assert compare((df.columns, [tuple(r) for r in df.collect()]), (twin.columns, twin.fetchall())) == ""
    types = dict(zip(twin.columns, map(str, twin.types)))
    assert {(f.dataType.simpleString(), types[f.name]) for f in df.schema.fields} <= SAME_TYPES


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_contract_columns(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns == COLUMNS[name].split()
    key = df.columns[0]
    source = {"page_id": "pages", "item_id": "benchmark", "vec_id": "embeddings"}.get(key, "documents")
    ids = {r[0] for r in spark.read.parquet(f"{sf_dir}/{source}.parquet").select(key).collect()}
    got = [r[0] for r in df.select(key).collect()]
    assert set(got) <= ids if name == "op8_licenses" else set(got) == ids
    if name not in ("op8_licenses", "op10_packing", "op11_lexical_search"):
        assert len(got) == len(ids)


def test_the_rest_of_the_library_does_not_import_this_part():
    code = (
        "import sys\nsys.modules['driftwise.llm'] = None\nsys.modules['corpus_pipeline'] = None\n"
        "from driftwise.plans import catalog\nassert catalog.load()[0]\n"
        "assert not [m for m in sys.modules if m.startswith('driftwise.llm.')]\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
