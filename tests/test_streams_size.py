"""Work of the streaming queries that must not repeat or meet in one task."""

from pyspark.sql import functions as F

from lakesync import schemas as S
from queries import feed, streams


def test_feed_lands_in_even_files(spark, sf_dir, tmp_path):
    streams.land(spark, sf_dir, str(tmp_path / "landing"), 7)
    files = spark.read.text(str(tmp_path / "landing")).groupBy(F.input_file_name()).count().collect()
    events = feed.table(spark, sf_dir, "events").count()
    assert sum(r["count"] for r in files) == events
    assert len(files) == 7 * streams.PER_BATCH
    assert max(r["count"] for r in files) <= 2 * events / len(files)


def test_increment_decodes_its_feed_once(spark, sf_dir, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    whole = feed.feed
    monkeypatch.setattr(feed, "feed", lambda *at: whole(*at).mapInArrow(counted, "value string"))
    rows = streams.typed_increment(spark, sf_dir)
    assert rows.count() > 0 and S.SYNC_TS not in rows.columns
    assert read.value == feed.table(spark, sf_dir, "events").count()
