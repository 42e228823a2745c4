"""Row-wise operators apply unchanged to a stream (by-product, not a claim)."""

from sparklab.operators.relational import clean_wide, map_values
from sparklab.streaming import read_stream


def test_rowwise_on_stream(spark, tmpdir_path):
    from tests.conftest import SF0001

    src = spark.read.parquet(f"{SF0001}/events.parquet")
    src.write.parquet(tmpdir_path + "/in")  # a stream source is a folder
    s = read_stream(spark, tmpdir_path + "/in", src.schema)
    out = clean_wide(map_values(s, "event_type", {"click": "tap"}), fill={"value": 0.0}, keep=("event_id", "value"))
    q = (out.writeStream.format("memory").queryName("rowwise_stream")
         .option("checkpointLocation", tmpdir_path + "/ck").trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.sql("select * from rowwise_stream")
    assert got.count() == src.count()
    assert got.filter("event_type = 'click'").count() == 0
