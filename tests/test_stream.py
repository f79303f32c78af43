from cardloom.sources.storage import Snapshots
from cardloom.streaming.latest_prices import ingest_arrivals, keep_latest


def test_each_file_is_taken_once(spark, tmp_path):
    schema = "k int, at int, id int"
    land = lambda rows, n: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    current = Snapshots(spark, str(tmp_path / "latest"))
    seen = []
    merge = keep_latest(current, ["k"], "at", "id")

    def batch(df, number):
        seen.append(df.count())
        merge(df, number)

    land([(1, 5, 1), (2, 1, 2)], "a")
    ingest_arrivals(spark, str(tmp_path / "in/*"), schema, str(tmp_path / "c"), batch)
    land([(1, 4, 3), (2, 1, 4)], "b")
    ingest_arrivals(spark, str(tmp_path / "in/*"), schema, str(tmp_path / "c"), batch)
    ingest_arrivals(spark, str(tmp_path / "in/*"), schema, str(tmp_path / "c"), batch)
    assert seen == [2, 2]
    assert sorted(map(tuple, current.current().collect())) == [(1, 5, 1), (2, 1, 4)]
