from pathlib import Path

import pytest
from compare import normal, rows_of
from brute import DATA

from ledgerloom.llm.oracles import ORACLES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_duckdb(ask, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got, want = ask(name), connection.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(normal, rows_of(got)), key=repr) == sorted(map(normal, rows_of(want)), key=repr)
