import random
import time

import pytest
from test_vectors import record

from tidemark.operators import vectors, vectorstore
from tidemark.sources import snapshots
from tidemark.sources.schemas import VECTOR_RECORD


def _records(df):
    return {(r.namespace, r.id): (r["values"], r.metadata.timestamp) for r in df.collect()}


@pytest.fixture
def store(spark, frame, tmp_path):
    path = f"{tmp_path}/store"
    first = [record(f"v{i}", [float(i)]) for i in range(60)]
    assert len(vectorstore.write_updates(frame(first, VECTOR_RECORD), path, 8)) == 8
    return path


def test_any_order_of_writes_equals_a_rewrite_of_all(spark, frame, store):
    rng = random.Random(4)
    whole = vectorstore.read_store(spark, store)
    whole = frame([tuple(r) for r in whole.collect()], VECTOR_RECORD)
    for step in range(4):
        rows = [
            record(f"v{rng.randrange(90)}", [rng.random()], timestamp=f"2024-0{rng.randrange(1, 9)}")
            for _ in range(12)
        ]
        rows.append(record("v1", [float(step)], namespace="other"))
        updates = frame(rows, VECTOR_RECORD)
        vectorstore.write_updates(updates, store)
        whole = frame([tuple(r) for r in vectors.upsert_vectors(whole, updates).collect()], VECTOR_RECORD)
    got = vectorstore.read_store(spark, store)
    assert _records(got) == _records(whole) and got.count() == whole.count()


def test_one_update_touches_one_bucket(spark, frame, store):
    before = snapshots.current(spark, store)
    touched = vectorstore.write_updates(frame([record("v7", [-1.0])] * 3, VECTOR_RECORD), store)
    after = snapshots.current(spark, store)
    changed = {b for b in after.parts if after.parts[b] != before.parts[b]}
    assert changed == {str(b) for b in touched} and len(touched) == 1
    assert after.number == before.number + 1
    assert _records(vectorstore.read_store(spark, store))[vectors.NAMESPACE, "v7"][0] == [-1.0]


def test_lookups_read_their_buckets_only(spark, store):
    found = vectorstore.read_records(spark, store, ["v3", "nobody"])
    assert [r.id for r in found.collect()] == ["v3"]
    buckets = {name.split("_bucket=")[1].split("/")[0] for name in found.inputFiles()}
    assert len(buckets) <= 2
    assert vectorstore.read_records(spark, store, []).count() == 0


def test_a_crash_before_the_swap_leaves_the_old_table(spark, frame, store, monkeypatch):
    before = _records(vectorstore.read_store(spark, store))
    update = frame([record("v7", [-1.0]), record("new", [0.0])], VECTOR_RECORD)

    def die(*args):
        raise RuntimeError("gone")

    monkeypatch.setattr(vectorstore, "publish", die)
    with pytest.raises(RuntimeError, match="gone"):
        vectorstore.write_updates(update, store)
    monkeypatch.undo()
    assert _records(vectorstore.read_store(spark, store)) == before
    vectorstore.write_updates(update, store)
    assert len(_records(vectorstore.read_store(spark, store))) == len(before) + 1


def test_the_slower_of_two_writers_is_told(spark, store):
    base = snapshots.current(spark, store)
    snapshots.publish(spark, store, base, base.parts, base.notes)
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, store, base, {}, {})
    assert snapshots.current(spark, store).parts == base.parts


def test_open_readers_keep_their_list_until_its_data_is_dropped(spark, frame, store):
    opened = snapshots.current(spark, store)
    vectorstore.write_updates(frame([record(f"v{i}", [-2.0]) for i in range(60)], VECTOR_RECORD), store)
    # Within the grace nothing goes, so a reader of the old list is not disturbed.
    assert snapshots.drop_unlisted(spark, store, 0) == []
    assert _records(vectorstore.read_store(spark, store, opened))[vectors.NAMESPACE, "v5"][0] == [5.0]
    later = int(time.time() * 1000) + 60_000
    assert len(snapshots.drop_unlisted(spark, store, later)) == 1
    assert set(snapshots.names_in(spark, f"{store}/lists")) == {f"{2:012d}"}
    assert _records(vectorstore.read_store(spark, store))[vectors.NAMESPACE, "v5"][0] == [-2.0]


def test_empty_updates_and_no_store(spark, frame, tmp_path):
    path = f"{tmp_path}/none"
    assert vectorstore.read_store(spark, path).count() == 0
    assert vectorstore.write_updates(frame([], VECTOR_RECORD), path) == []
    assert vectorstore.buckets_of(spark, path) is None
