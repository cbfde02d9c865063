"""Staged tables leave nothing behind."""

from __future__ import annotations

from threadwright.sources import staging


def test_release_drops_tables_and_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "staging_root", lambda s: str(tmp_path / "staged"))
    monkeypatch.setattr(staging, "_TABLES", set())
    before = {t.name for t in spark.catalog.listTables()}
    kept = staging.stage_bucketed(spark.range(10).withColumnRenamed("id", "k"), "numbers", "k", 2)
    plain = staging.stage(spark.range(5), "plain")
    assert kept.count() == 10 and plain.count() == 5
    assert len({t.name for t in spark.catalog.listTables()} - before) == 1
    staging.release_staging(spark)
    assert {t.name for t in spark.catalog.listTables()} == before and not (tmp_path / "staged").exists()
