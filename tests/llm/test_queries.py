import pytest

import __spark_entry__ as entry

NAMES = sorted(n for n in entry.queries() if n.startswith(("p3_", "p4_", "p6_", "p7_", "p8_")))
COLUMNS = {"p3_found": ["fire_id_a", "fire_id_b"], "p6_ids": ["doc_id", "ids"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id_a", "doc_id_b"]}


@pytest.mark.parametrize("name", NAMES)
def test_query_gives_distinct_rows(spark, data, name):
    df = entry.queries()[name](spark, data)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = [str(r) for r in df.collect()]
    assert rows and len(set(rows)) == len(rows)
