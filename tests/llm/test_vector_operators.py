"""Whitening and vector codes against plain versions, and their edge cases."""

import hashlib

import numpy as np
import pytest

from tidemark.llm import vectorcodes, whitening
from tidemark.llm.queries import QUERIES

RNG = np.random.default_rng(3)
# Further columns are named like inner ones.
SCHEMA = "vec_id long, embedding array<float>, label int, id string, x int, code string, sums int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, b, "a", 1, "c", 2) for i, v, b in rows], SCHEMA)


def _vectors(count: int, length: int):
    base = RNG.normal(size=(count, 3)) @ RNG.normal(size=(3, length))
    return (base + RNG.normal(size=(count, length)) * 0.3).astype("float32")


def _usable(rows):
    return [r for r in rows if r[1] and all(c is not None and np.isfinite(c) for c in r[1])]


@pytest.fixture(scope="module")
def rows():
    """Vectors with gaps, repeats, null and repeated ids, and labels that are null."""
    found = [(i, [float(c) for c in v], i % 4 or None) for i, v in enumerate(_vectors(400, 12))]
    bad = [None, [], [0.5, None] * 6, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [0.25] * 5]
    return (
        found
        + [(i + 500, v, 1) for i, v in enumerate(bad)]
        + [(700 + i, found[7][1], 2) for i in range(40)]
        + [(None, found[9][1], None), (3, found[11][1], 3)]
    )


def _plain_whitening(rows):
    whole = np.floor(1024 * np.array([r[1] for r in rows], float)).astype("int64") + 100_000
    n, sums = len(whole), whole.sum(axis=0)
    centred = (n * whole - sums) / n
    energy, axes = np.linalg.eigh(centred.T @ centred / n)
    energy, axes = energy[::-1], axes[:, ::-1]
    exact = [sum(int(c) ** 2 for c in row) for row in (n * whole - sums)]
    return exact, centred @ axes, energy


def _checked(got, kept, components):
    exact, turned, energy = _plain_whitening(kept)
    assert len(got) == len(kept) * components
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, int(r.deviation)), []).append(r)
    for k in range(components):
        column = [turned[i, k] / np.sqrt(energy[k]) for i in range(len(kept))]
        pairs = []
        for i, row in enumerate(kept):
            found = [r for r in by_row[row[0], exact[i]] if r.component == k + 1]
            assert found and abs(found[0].explained - energy[k] / energy.sum()) < 1e-9
            pairs.append((found[0].whitened, column[i]))
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a * sign - b) for a, b in pairs) < 1e-8
    assert {r.n for r in got} == {len(kept)} and got[0].identity_error < 1e-9


def test_whitening_against_eigenvectors(spark, rows):
    kept = [r for r in _usable(rows) if len(r[1]) == 12]
    _checked(whitening.whiten(_frame(spark, rows)).collect(), kept, 8)


def test_registered_whitening_against_eigenvectors(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    kept = [(r.vec_id, r.embedding, r.label) for r in table]
    _checked(QUERIES["op12_whitening"](spark, small).collect(), kept, 8)


def test_equal_and_missing_deviations_are_all_found(spark):
    # The corners of a block: four equal deviations and two dimensions that never change.
    corners = [(i, [float((i >> k) & 1) for k in range(4)] + [0.5, 0.5], 0) for i in range(16)]
    got = whitening.whiten(_frame(spark, corners)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and len(got) == 64
    assert all(abs(r.explained - 0.25) < 1e-12 for r in got)
    assert got[0].identity_error < 1e-9


def test_exact_deviation_beyond_64_bits(spark):
    far = [(i, [float(2**20 * (i % 2)), float(i)], 0) for i in range(60)]
    got = whitening.whiten(_frame(spark, far)).collect()
    exact, _, _ = _plain_whitening(far)
    assert {(r.vec_id, int(r.deviation)) for r in got} == {(i, e) for i, e in enumerate(exact)}
    assert max(exact) > 2**63


@pytest.mark.parametrize("some", [[], [(1, None, 1)], [(1, [0.5, 1.0], 1)], [(i, [0.5, 1.0], 1) for i in range(3)]])
def test_whitening_without_any_spread(spark, some):
    assert whitening.whiten(_frame(spark, some)).collect() == []


def _plain_codes(rows, parts=4, entries=256, rounds=4):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, np.floor(1024 * np.array(r[1])).tolist()))
    whole = {id(r): np.floor(1024 * np.array(r[1], float)).astype("int64") for r in rows}
    width = len(rows[0][1]) // parts
    books = [
        [[int(c) for c in whole[id(r)][p * width : (p + 1) * width]] for r in order[:entries]]
        for p in range(parts)
    ]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    def part(r, p):
        return [int(c) for c in whole[id(r)][p * width : (p + 1) * width]]

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for r in rows:
                members.setdefault(best(part(r, p), book)[1], []).append(part(r, p))
            for k, own in members.items():
                book[k] = [sum(column) // len(own) for column in zip(*own)]
    found = []
    for r in rows:
        each = [best(part(r, p), books[p]) for p in range(parts)]
        found.append((r[0], "".join(f"{k:02x}" for _, k in each), sum(d for d, _ in each), r[2]))
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    label = {}
    for _, _, error, b in found:
        label[b] = label.get(b, 0) + error
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, code, e, label[b], digest) for i, code, e, b in found), key=repr)


def test_codes_against_plain_ones(spark, rows):
    kept = [r for r in _usable(rows) if len(r[1]) == 12]
    got = vectorcodes.compress(_frame(spark, rows), entries=16).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _plain_codes(kept, entries=16)


def test_fewer_rows_than_entries_and_tied_rows(spark):
    few = [(i, [float(i // 2), 0.0, 1.0, -1.0], None) for i in range(6)]
    got = vectorcodes.compress(_frame(spark, few)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _plain_codes(few)
    assert {r.label_error for r in got} == {0}


def test_dictionaries_of_many_values_and_blocks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        wide = [(i, [float(np.float32(c * 3000)) for c in v], i % 3) for i, v in enumerate(_vectors(90, 8))]
        got = vectorcodes.compress(_frame(spark, wide).repartition(5), entries=8).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((tuple(r) for r in got), key=repr) == _plain_codes(wide, entries=8)


def test_codes_of_an_empty_table_and_odd_lengths(spark):
    assert vectorcodes.compress(_frame(spark, [])).collect() == []
    assert vectorcodes.compress(_frame(spark, [(1, None, 1)])).collect() == []
    odd = vectorcodes.compress(_frame(spark, [(1, [1.0, 2.0, 3.0], 1)])).collect()
    assert odd[0].code == "00000000" and odd[0].error == 0
    with pytest.raises(ValueError):
        vectorcodes.compress(_frame(spark, []), entries=257)


def test_distances_keep_the_narrowest_exact_type():
    assert [vectorcodes._exact_kind(n) for n in (2**31 - 1, 2**31, 2**63)] == ["int32", "int64", "object"]
    far = [np.array([-(2**40), 2**40])]
    entry, error = vectorcodes.nearest(far, np.array([[0, 1]]), np.array([[2**40], [2**40 - 1]]))
    assert entry.tolist() == [1, 0] and error.tolist() == [(2**41 - 1) ** 2, 0]
