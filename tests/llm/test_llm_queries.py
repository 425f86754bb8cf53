import hashlib

import duckdb
import pytest
import tiktoken
from oracle import assert_same
from pyspark.sql import functions as F

from assaylake.llm import queries, tokens


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, sf, name):
    assert_same(queries.QUERIES[name](spark, sf), queries.SQL[name], sf)


def sql(text: str, sf: str) -> list[tuple]:
    return duckdb.execute(text.replace("{sf}", sf)).fetchall()


def test_every_query_without_sql_is_checked_here():
    assert set(queries.QUERIES) - set(queries.SQL) == {
        "p2_found", "p2_unmatched", "p7_percentiles", "p8_ids", "p9_items", "p10_found", "p10_channels"
    }


CASES = """with long as (select condition_id, 'perturbation_id' as f, perturbation_id as v from '{sf}/conditions.parquet'
  union all select condition_id, 'control_status', control_status from '{sf}/conditions.parquet')
select condition_id, f, v from long where v is not null and lower(trim(v)) not in ('', 'nan', 'none', 'null', 'na', '<missing>')
  and not exists (select 1 from '{sf}/canonical_values.parquet' where entry_field = f and entry_name = v)"""


def test_typed_values_are_all_answered(spark, sf):
    rows = queries.QUERIES["p2_found"](spark, sf).collect()
    cases = sql(CASES, sf)
    assert {(r.condition_id, r.field_name) for r in rows} == {(c, f) for c, f, _ in cases} and len(rows) > 40
    entries = dict(sql("select entry_id, entry_field from '{sf}/canonical_values.parquet'", sf))
    assert all(r.entry_id == -1 or entries[r.entry_id] == r.field_name for r in rows)
    assert sum(r.entry_id != -1 for r in rows) > 0.8 * len(rows)
    lost = {(r.condition_id, r.field_name) for r in rows if r.entry_id == -1}
    unmatched = {(r.field_name, r.typed): r.n_rows for r in queries.QUERIES["p2_unmatched"](spark, sf).collect()}
    assert sum(unmatched.values()) == sum((c, f) in lost for c, f, _ in cases)
    assert set(unmatched) == {(f, v) for c, f, v in cases if (c, f) in lost}


def test_percentiles_have_every_group(spark, sf):
    got = queries.QUERIES["p7_percentiles"](spark, sf).collect()
    want = sql("select 'run', run_id, count(median_effect) from '{sf}/meta_summary.parquet' where not isnan(median_effect) group by run_id", sf)
    assert {(r.scope, r.scope_key, r.n) for r in got if r.metric == "median_effect" and r.scope == "run"} == set(want)
    assert all(r.p50 <= r.p90 <= r.p99 and r.rank_error <= queries.EPS * r.n for r in got)


def test_ids_equal_another_encoder(spark, sf):
    ranks = tokens.load_ranks(queries.VOCABULARY)
    public = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {d: public.encode_ordinary(t or "") for d, t in sql("select doc_id, text from '{sf}/documents.parquet'", sf)}
    assert {r.doc_id: r.ids for r in queries.QUERIES["p8_ids"](spark, sf).collect()} == want


def test_items_count_the_documents_found(spark, sf):
    found = queries.QUERIES["p9_found"](spark, sf).groupBy("item_id").agg(F.count("*").alias("n")).collect()
    items = {r.item_id: r for r in queries.QUERIES["p9_items"](spark, sf).collect()}
    assert found and all(items[r.item_id].documents == r.n for r in found)
    assert sum(r.documents for r in items.values()) == sum(r.n for r in found)


def test_garbled_texts_change_or_are_lost(spark, sf):
    texts = dict(sql("select doc_id, text from '{sf}/documents.parquet'", sf))
    rows = queries.QUERIES["p10_found"](spark, sf).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    for r in rows:
        assert not texts[r.doc_id].isascii()
        if r.restored_md5:
            assert r.restored_md5 != hashlib.md5(texts[r.doc_id].encode()).hexdigest()
        else:
            assert "�" in texts[r.doc_id]
    lost = sum(not r.restored_md5 for r in rows)
    channels = queries.QUERIES["p10_channels"](spark, sf).collect()
    assert all(r.with_losses <= r.documents <= len(rows) for r in channels) and sum(r.documents for r in channels) >= len(rows)
    assert sum(r.with_losses for r in channels) >= lost
