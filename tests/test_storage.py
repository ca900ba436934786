"""Scratch tables are deleted with their scope, but for those that are kept."""

import os

import pytest

from tidemark.plans.storage import scratch_scope, settle


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scope_deletes_what_it_does_not_keep(spark):
    with scratch_scope(spark):
        with scratch_scope(spark):
            passing = settle(spark.range(10), "passing")
            kept = settle(passing.where("id > 4"), "kept", keep=True)
            gone, held = folder(passing), folder(kept)
        assert not os.path.exists(gone)
        assert sorted(r.id for r in kept.collect()) == [5, 6, 7, 8, 9]
        final = settle(kept.where("id > 7"), "final", keep=True)
    assert not os.path.exists(held)
    assert sorted(r.id for r in final.collect()) == [8, 9]


def test_scope_deletes_after_an_error_and_leaves_other_tables(spark):
    outside = settle(spark.range(3), "outside")
    with pytest.raises(ValueError):
        with scratch_scope(spark):
            gone = folder(settle(spark.range(2), "passing"))
            raise ValueError
    assert not os.path.exists(gone)
    assert outside.count() == 3


def test_empty_tables_are_settled_too(spark):
    with scratch_scope(spark):
        kept = settle(spark.range(0), "none", keep=True)
    assert kept.count() == 0
