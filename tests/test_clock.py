"""The clock that fires retraining."""

import time

from review_lens.sources.topics import clock


def test_the_clock_ticks(spark, tmp_path):
    ticks = []
    writer = clock(spark).writeStream.foreachBatch(lambda rows, number: ticks.append(number))
    query = writer.option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    deadline = time.time() + 60
    while len(ticks) < 2 and time.time() < deadline:
        time.sleep(0.2)
    query.stop()
    assert ticks[:2] == [0, 1]
