import duckdb
import pytest
from oracle import assert_same

from assaylake.operators.drift import ALIASES
from assaylake.plans import problems, reports, stages

SQL = {**stages.SQL, **reports.SQL, **problems.SQL}
QUERIES = {**stages.QUERIES, **reports.QUERIES, **problems.QUERIES}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf), SQL[name], sf)


def test_every_query_without_sql_is_checked_here():
    assert set(QUERIES) - set(SQL) == {"p1_profile", "p4_unified", "p4_casts", "p5_guessed"}


def test_profile_covers_every_column_and_load(spark, sf):
    """Rows, missing and distinct values of each column in each load against counts by SQL."""
    rows = QUERIES["p1_profile"](spark, sf).collect()
    for table in ("dataset_qc", "profile_index"):
        columns = [c for c in spark.read.parquet(f"{sf}/{table}.parquet").columns if c != "load_no"]
        mine = [r for r in rows if r.table_name == table]
        assert {r.column_name for r in mine} == set(columns)
        for c in ("dataset_id", "n_obs", "warnings"):
            gone = f"{c} IS NULL OR lower(trim(CAST({c} AS VARCHAR))) IN ('', 'nan', 'none', 'null', 'na', '<missing>')"
            sql = f"select load_no, count(*), count(*) filter (where {gone}), count(distinct {c}) filter (where not ({gone})) from '{sf}/{table}.parquet' group by 1"
            want = set(duckdb.execute(sql).fetchall())
            assert {(r.load_no, r.rows, r.missing, r.distinct_values) for r in mine if r.column_name == c} == want


def test_unified_table_has_every_key_of_every_file(spark, sf):
    keys = """select count(*) from (select distinct file_id, coalesce(payload->>'cell_id', payload->>'feature_id') as k
      from '{0}/raw_records.parquet' where json_valid(payload)) where k is not null"""
    rows = QUERIES["p4_unified"](spark, sf)
    assert rows.where("key is not null").count() == duckdb.execute(keys.format(sf)).fetchall()[0][0]
    names = [n for n in ALIASES["n_counts"][1]]
    given = " or ".join(f"""json_extract(payload, '$."{n.replace('.', '"."')}"') is not null and json_extract_string(payload, '$."{n.replace('.', '"."')}"') is not null""" for n in names)
    sql = f"select count(distinct (file_id, payload->>'cell_id')) from '{sf}/raw_records.parquet' where kind = 'obs' and json_valid(payload) and ({given})"
    assert rows.where("n_counts is not null").count() == duckdb.execute(sql).fetchall()[0][0] > 0


def test_casts_account_for_every_value(spark, sf):
    rows = QUERIES["p4_casts"](spark, sf).collect()
    assert rows and all(r.n_values == r.taken + r.failed + r.superseded + r.spare for r in rows)
    assert {r.canon is None for r in rows} == {True, False} and all(r.canon is None or r.spare == 0 for r in rows)


def test_guesses_are_for_silent_values_only(spark, sf):
    found = {(r.condition_id, r.quantity) for r in QUERIES["p5_found"](spark, sf).collect()}
    rows = QUERIES["p5_guessed"](spark, sf).collect()
    assert rows and not any((r.condition_id, r.quantity) in found for r in rows)
    assert all(0 < r.posterior <= 1 and r.uncertain == (r.posterior < 0.9) for r in rows if abs(r.posterior - 0.9) > 1e-3)


def test_entry_has_a_fixed_schema(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and "rank" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())
