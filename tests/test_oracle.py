"""Every registered query next to its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from riskloom.session import remove_stages
from tools.check_oracle import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    diff, rows, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    remove_stages(spark)
    assert diff is None
    assert rows > 0 or name in MAY_BE_EMPTY


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.row_count == 1000 and row.gate in ("PASS", "FAIL")


@pytest.mark.parametrize("name,stops", [
    ("riskloom.llm", False), ("corpus_pipeline", False), ("tiktoken", False), ("riskloom.llm.absent", True), ("riskloom.absent", True),
])
def test_entry_without_optional_modules(monkeypatch, name, stops):
    real = entry.importlib.import_module

    def absent(module):
        if module in entry.OPTIONAL:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(module)

    monkeypatch.setattr(entry.importlib, "import_module", absent)
    if stops:
        with pytest.raises(ModuleNotFoundError):
            entry.queries()
    else:
        assert "velocity_1h" in entry.queries()
