import __spark_entry__


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["doc_id", "source_index", "start_char", "end_char", "text"] and df.limit(1).count() == 1


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
