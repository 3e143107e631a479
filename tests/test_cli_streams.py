"""Commands over folders by record, folding, incremental retraining and live lists."""

from review_lens import cli
from review_lens.operators import models as M
from review_lens.sources.reviews import landed_files, read_landed, read_reviews
from review_lens.sources.topics import read_messages
from review_lens.streaming import jobs, tails
from tests.test_cli import arguments, run, write_csv


def test_a_named_feed_to_live_lists(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "reviews.csv", 40)
    feed = cli.parser().parse_args(
        ["feed", "--csv", str(tmp_path / "reviews.csv"), "--to", str(tmp_path / "train"), "--size", "15", "--name", "f", "--split"]
    )
    for _ in range(2):
        cli.start(spark, feed)
    assert read_messages(spark, str(tmp_path / "train")).count() == 40
    places = {"table": tmp_path / "t", "quarantine": tmp_path / "q"}
    run(
        spark, "ingest", topic=tmp_path / "train", checkpoint=tmp_path / "c1", every="1 second",
        per_trigger=10, fold_every=2, buckets=4, **places,
    )
    table = str(tmp_path / "t")
    assert read_reviews(spark, table).count() == 40 and (tmp_path / "t" / "_keyed").exists()
    models = jobs.retrain(spark, table, str(tmp_path / "m"), incremental=True, max_iter=3)
    assert models.training_rows == jobs.retrain(spark, table, str(tmp_path / "n"), max_iter=3).training_rows
    assert arguments("retrain", table="t", models="m", checkpoint="c").incremental is False
    run(
        spark, "score", topic=tmp_path / "train", models=tmp_path / "m", predictions=tmp_path / "p",
        metrics=tmp_path / "x", checkpoint=tmp_path / "c2", every="1 second", per_trigger=25, **places,
    )
    run(spark, "fold", table=table, buckets=4, keep=1)
    assert all("source=test" in f for f in landed_files(spark, table))
    jobs.retrain(spark, table, str(tmp_path / "m"), incremental=True, max_iter=3)
    run(spark, "fold", table=table, keep=1)
    assert landed_files(spark, table) == [] and read_landed(spark, table).count() == 40
    assert M.load(spark, str(tmp_path / "m")).version == 1
    run(spark, "watch", predictions=tmp_path / "p", shown=tmp_path / "shown", checkpoint=tmp_path / "c3")
    assert tails.recent(spark, str(tmp_path / "shown")).count() == 40
    run(spark, "watch-metrics", metrics=tmp_path / "x", shown=tmp_path / "seen", late=tmp_path / "late", checkpoint=tmp_path / "c4")
    assert sorted(r.total_records for r in tails.history(spark, str(tmp_path / "seen")).collect()) == [15, 25]
