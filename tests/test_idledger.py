import random

import pytest

from tidemark.operators import idledger, quality
from tidemark.sources import snapshots

SCHEMA = "id string, other long"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_any_appends_equal_a_look_at_the_whole_table(spark, frame, tmp_path):
    rng = random.Random(1)
    path, rows = f"{tmp_path}/ledger", []
    for size in (40, 0, 30, 1, 60):
        batch = [(rng.choice([None, "", *map(str, range(90))]), 1) for _ in range(size)]
        batch += [("hot", 2)] * (size // 3)
        rows += batch
        idledger.append_values(frame(batch, SCHEMA), "id", path, buckets=8)
        got = idledger.repeated_values(spark, path, "id")
        assert rows_of(got) == rows_of(quality.failing_unique(frame(rows, SCHEMA), "id"))
        values = [r[0] for r in rows if r[0] is not None]
        total = idledger.totals(spark, path).first()
        assert tuple(total) == (
            len(values),
            len(set(values)),
            sum(values.count(v) > 1 for v in values),
        )


def test_only_the_buckets_of_a_batch_are_rewritten(spark, frame, tmp_path):
    path = f"{tmp_path}/ledger"
    everything = frame([(str(i), 0) for i in range(200)], SCHEMA)
    assert idledger.append_values(everything, "id", path, buckets=8) == list(range(8))
    before = snapshots.current(spark, path)
    touched = idledger.append_values(frame([("7", 0)] * 3, SCHEMA), "id", path)
    after = snapshots.current(spark, path)
    assert len(touched) == 1
    assert {b for b in after.parts if after.parts[b] != before.parts[b]} == {str(touched[0])}
    assert rows_of(idledger.repeated_values(spark, path, "id")) == [("7", 4)]
    # A reader of the list before sees the ledger as it was.
    assert rows_of(idledger.repeated_values(spark, path, "id", before)) == []


def test_values_keep_their_type_and_batches_count_once(spark, frame, tmp_path):
    path = f"{tmp_path}/ledger"
    batch = frame([("a", 2**62 + 1), ("b", 2**62 + 1), ("c", None)], SCHEMA)
    idledger.append_values(batch, "other", path, batch_id="0")
    assert idledger.append_values(batch, "other", path, batch_id="0") == []
    got = idledger.repeated_values(spark, path, "other")
    assert rows_of(got) == [(2**62 + 1, 2)] and got.schema["other"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        idledger.append_values(batch, "id", path)


def test_a_crash_before_the_swap_counts_nothing(spark, frame, tmp_path, monkeypatch):
    path = f"{tmp_path}/ledger"
    batch = frame([("a", 1)], SCHEMA)
    idledger.append_values(batch, "id", path)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(idledger, "publish", crash)
        with pytest.raises(OSError):
            idledger.append_values(batch, "id", path)
    assert rows_of(idledger.repeated_values(spark, path, "id")) == []
    idledger.append_values(batch, "id", path)
    assert rows_of(idledger.repeated_values(spark, path, "id")) == [("a", 2)]


def test_an_empty_ledger(spark, tmp_path):
    assert idledger.repeated_values(spark, f"{tmp_path}/none", "id").count() == 0
    assert tuple(idledger.totals(spark, f"{tmp_path}/none").first()) == (0, 0, 0)
