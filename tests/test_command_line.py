"""The jobs as they are started from a shell."""

import json
import time

import pytest

from log_data import event, frame, random_rows
from stayflow import __main__ as cli
from stayflow.plans import training
from stayflow.session import new_folder
from stayflow.sources import files, lake
from stayflow.streaming import runs, zones


@pytest.fixture(scope="module")
def events(spark):
    path = new_folder(spark, "events")
    frame(spark, random_rows(40, users=80, events=2500, hot=0.1)).write.json(path)
    return path


def test_features_profile_and_train(spark, events, monkeypatch, capsys):
    users, models = new_folder(spark, "users"), new_folder(spark, "models")
    cli.main(["features", events, users, "--wide", "--files", "1"])
    assert files.read_user_table(spark, users).count() > 50
    cli.main(["profile", users])
    assert "num_active_days" in capsys.readouterr().out

    def quick():
        family = training.lr_family()
        family.grid = family.grid[:2]
        return [family, training.rf_family()]

    monkeypatch.setattr(training, "families", quick)
    cli.main(["train", users, models])
    out = capsys.readouterr().out
    assert "chosen" in out and "RandomForestClassifier" in out
    assert training.load_model(f"{models}/best").stages

    base = new_folder(spark, "lake")
    cli.main(["stream", events, base])
    cli.main(["gold", base])
    assert spark.read.parquet(zones.Lake(base).data("gold")).count() == files.read_user_table(spark, users).count()
    silver = zones.read_zone(spark, zones.Lake(base).data("silver")).count()
    cli.main(["pack", base])
    assert zones.read_zone(spark, zones.Lake(base).data("silver")).count() == silver
    cli.main(["users", base])
    assert zones.user_state(spark, zones.Lake(base)).users().count() == files.read_user_table(spark, users).count()
    cli.main(["score", base, f"{models}/best"])
    assert "prediction" in capsys.readouterr().out


def test_three_queries_running_side_by_side(spark):
    incoming, zone = new_folder(spark, "incoming"), zones.Lake(new_folder(spark, "lake"))
    lines = [(json.dumps(event(f"u{i}", "2018-10-01", hour=i)),) for i in range(6)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(incoming)
    queries = zones.ingest_forever(spark, incoming, zone, every="500 milliseconds")
    try:
        until = time.time() + 90
        rows = 0
        while rows < 6 and time.time() < until:
            time.sleep(1)
            rows = lake.read_zone(spark, zone.data("silver")).count() if lake.zone_exists(spark, zone.data("silver")) else 0
        assert rows == 6
        raw = queries[0]
        while raw.isActive and time.time() < until:
            runs.stop_when_idle(raw)
            time.sleep(0.3)
        assert not raw.isActive
    finally:
        for q in queries:
            q.stop()
