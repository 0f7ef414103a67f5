"""Counts that no SQL is registered for."""

from smoothway.plans import catalog


def test_unzoned_segments_are_counted(spark, sf_dir):
    assert [tuple(r) for r in catalog.QUERIES["j13_unzoned_segments"](spark, sf_dir).collect()] == [(1, 6)]
