"""Partitions for the volume that the tables give."""

from __future__ import annotations

from voxelith.sources import fixtures


def test_shuffles_grow_with_the_volume(spark, tmp_path, monkeypatch):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    monkeypatch.setattr(fixtures, "ROWS_PER_PARTITION", 100)
    spark.range(4_000).write.parquet(f"{tmp_path}/lineitem.parquet")
    try:
        n = fixtures.side(spark, str(tmp_path))
        assert int(spark.conf.get(name)) * 100 >= n**3
        fixtures.spread(spark, 1)  # never fewer
        assert int(spark.conf.get(name)) * 100 >= n**3
    finally:
        spark.conf.set(name, before)
