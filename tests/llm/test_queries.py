"""Every registered query of the text operators: columns and types of its contract, on odd rows with clashing columns and on empty tables."""

import pytest
from pyspark.sql import functions as F

from mastermill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "benchmark", "embeddings", "conversations")
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
CONTRACTS = {
    "op1_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op2_substrings": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op3_url_rules": "page_id bigint, host string, path string, rule string, verdict string",
    "op4_line_dedup": "doc_id bigint, text string, n_lines bigint, n_kept_lines bigint",
    "op4_line_runs": "doc_id bigint, text string, n_lines bigint, n_kept_lines bigint",
    "op5_packing": PIECES,
    "op6_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op7_benchmark": "doc_id bigint, item_id bigint, distance bigint",
    "op8_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op9_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op10_token_counts": "source string, lang string, version string, n_docs bigint, n_tokens bigint",
    "op11_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op12_conversations": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op13_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "pipeline": PIECES,
}
CLASHES = ("spans", "quality", "n_lines", "piece", "key", "digest", "part", "ids", "vector", "name", "bucket", "score", "idx", "audit", "tokens", "gone", "kept")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Folders of tables: some rows of each with a row of nulls, repeated rows and further columns; and the same without rows."""
    odd, empty = (str(tmp_path_factory.mktemp(n)) for n in ("odd", "empty"))
    for name in TABLES:
        rows = spark.read.parquet(f"{SF}/{name}.parquet").limit(80)
        taken = {c.lower() for c in rows.columns}
        nulls = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
        more = rows.unionByName(rows.limit(3)).unionByName(nulls)
        more = more.withColumns({c: F.lit("clash") for c in CLASHES if c not in taken}).coalesce(2)
        more.write.parquet(f"{odd}/{name}.parquet")
        more.limit(0).write.parquet(f"{empty}/{name}.parquet")
    return odd, empty


def test_every_query_has_a_contract():
    assert set(QUERIES) == set(CONTRACTS)


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_columns_and_types_on_odd_and_empty_tables(spark, tables, name):
    odd, empty = tables
    want = dict(c.split() for c in CONTRACTS[name].split(", "))
    for folder in (odd, empty):
        found = QUERIES[name](spark, folder)
        assert {c: t for c, t in found.dtypes if c in want} == want
        rows = found.collect()
        assert bool(rows) or folder == empty or name in ("op7_benchmark", "op11_nearest", "op13_hard_negatives")
