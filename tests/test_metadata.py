"""Metadata beside tables: written, merged field by field, read."""

from __future__ import annotations

from starfold.sources import tables


def test_updates_merge_entries(spark, tmp_path):
    path = f"{tmp_path}/features.parquet"
    assert tables.read_metadata(spark, path) == {}
    assert tables.update_metadata(spark, path, {"quadrants": {"(1, 2, 3)": {"total": 5, "minobs": 50}}}) == {"quadrants": {"(1, 2, 3)": {"total": 5, "minobs": 50}}}
    tables.update_metadata(spark, path, {"quadrants": {"(1, 2, 4)": {"total": 7}, "(1, 2, 3)": {"total": 6}}, "specific_ids": {"total": 1}})
    expected = {"quadrants": {"(1, 2, 3)": {"total": 6, "minobs": 50}, "(1, 2, 4)": {"total": 7}}, "specific_ids": {"total": 1}}
    assert tables.read_metadata(spark, path) == expected
    tables.save_table(spark.range(2), path, {"specific_ids": 3})
    assert tables.read_metadata(spark, path) == {"specific_ids": 3} and spark.read.parquet(path).count() == 2
    assert tables.update_metadata(spark, path, {"specific_ids": {"total": 2}}) == {"specific_ids": {"total": 2}}
