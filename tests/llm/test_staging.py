from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from eigenlake.llm import staging  # noqa: E402


def test_local_sessions_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda session: None)
    before = spark.conf.get("spark.checkpoint.dir", None)
    work = staging.Staging(spark, "test")
    kept = work.keep(spark.range(5), "five")
    assert work.root.startswith("file:///") and kept.count() == 5
    assert staging.folder(spark) == staging.folder(spark) and spark.conf.get("spark.checkpoint.dir", None) == before
    work.drop(kept)
    assert not Path(kept.staged_path.removeprefix("file://")).exists()
