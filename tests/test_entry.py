"""Driver contract smoke checks."""

import __spark_entry__ as E
from vitalis import schemas as S


def test_entry_returns_training_table(spark):
    df = E.entry(spark)
    assert tuple(df.columns) == S.TRAINING_COLUMNS
    assert df.count() > 0


def test_oracles_cover_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
