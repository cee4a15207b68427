"""The registered queries: SQL where there is some, result columns and types, whole tables."""

import duckdb
import pytest

from basketry.llm.queries import QUERIES, SQL
from basketry.llm.common import table

COLUMNS = {
    "op1_": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2_": "doc_id bigint, fingerprint string, component_id bigint",
    "op3_": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op5_": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op6_": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "base_failed boolean, kept boolean",
    "op11_": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12_": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13_": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op10_": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.sql(SQL[name])
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    norm = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert sorted(rel.columns) == cols
    assert sorted((norm(r) for r in df.select(*cols).collect()), key=repr) == \
        sorted((norm(r) for r in rel.select(*cols).fetchall()), key=repr)


@pytest.mark.parametrize("prefix", sorted(COLUMNS))
def test_columns_and_one_row_a_document(spark, sf, prefix):
    name = next(k for k in QUERIES if k.startswith(prefix))
    df = QUERIES[name](spark, sf)
    want = [tuple(c.split()) for c in COLUMNS[prefix].split(", ")]
    assert df.dtypes[:len(want)] == want
    if prefix not in ("op3_", "op11_", "op12_", "op13_"):
        ids = sorted(r["doc_id"] for r in df.select("doc_id").collect())
        assert ids == sorted(r["doc_id"] for r in table(spark, sf, "documents").select("doc_id").collect())


def test_shards_are_even_and_slots_gapless(spark, sf):
    rows = QUERIES["op5_feistel_shards"](spark, sf).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert set(by) == set(range(8)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
