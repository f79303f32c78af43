import __spark_entry__


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and "latest_price_by_printing" in oracles
