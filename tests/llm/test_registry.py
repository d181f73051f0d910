import re

import __spark_entry__ as entry


def test_each_operator_has_one_query():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
