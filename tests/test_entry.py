import inspect

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    rows = entry.queries()[name](spark, FOLDER).toPandas()
    assert compare(rows, duck.execute(entry.oracle_sql()[name]).fetchdf()) == "ok"


def test_models_have_the_rank_and_grid_of_the_reference(monkeypatch):
    def made(function):
        def recorded(*given, **named):
            call = inspect.signature(function).bind(*given, **named)
            call.apply_defaults()
            raise Made(call.arguments)

        return recorded

    class Made(Exception):
        pass

    def found(name):
        with pytest.raises(Made) as error:
            entry.queries()[name](None, FOLDER)
        return error.value.args[0]

    monkeypatch.setattr(entry.warehouse, "ratings", lambda *_: None)
    monkeypatch.setattr(entry.factors, "triples", lambda _: None)
    monkeypatch.setattr(entry.factors, "train", made(entry.factors.train))
    monkeypatch.setattr(entry, "checkpoint_folder", lambda _: "")
    monkeypatch.setattr(
        entry.factors, "stored_model", lambda rows, _, **settings: entry.factors.train(rows, **settings)
    )
    monkeypatch.setattr(entry.tuning, "grid", made(entry.tuning.grid))
    for name in ("als_user_recs", "als_unseen_recs", "als_predictions", "als_item_similar_top20"):
        model = found(name)
        assert (model["rank"], model["max_iter"], model["reg"]) == (200, 5, 0.1)
    grid = found("als_grid")
    assert (grid["ranks"], grid["regs"], grid["max_iter"]) == ((50, 100, 200, 300), (0.01, 0.1, 1.0), 5)
