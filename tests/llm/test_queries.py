import pytest

import __spark_entry__
from larkspur.llm import queries
from tests.oracle import duck, same


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, sf_dir, name):
    if name == "op3_substring_dedup":
        pytest.skip("minutes in DuckDB at this size; test_substrings_lines holds it against brute force")
    same(duck(sf_dir), queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name])


def test_registered():
    found = __spark_entry__.queries()
    assert all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 14)) and "pipeline" in found
