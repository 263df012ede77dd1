"""The folders of runs are fresh, below the shared one, and removed on request."""

import os

from ticketmill import session


def test_folders_of_runs_are_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", {})  # those of other tests stay
    made = [session.run_folder(spark, "x") for _ in range(2)]
    assert len(set(made)) == 2 and all(f.startswith(session.shared_folder(spark).rstrip("/") + "/x-") for f in made)
    spark.range(3).write.parquet(made[0])
    local = made[0].removeprefix("file://")
    assert os.path.isdir(local)
    assert session.clear_runs(spark) == 2 and not os.path.exists(local) and session.clear_runs(spark) == 0
