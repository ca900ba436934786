"""Near-duplicate documents by minhash with tensored banding and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tokens import grouped
from tidemark.plans.storage import scratch_scope, settle

WORDS = 5
#: Two documents are linked from this percentage of their joint shingles on.
PERCENT = 75
#: Each of the two collections has HALVES half-keys of ROWS minhashes.
HALVES = 10
ROWS = 2
SEED = 20240101


class _Words(dict):
    """64-bit codes by word; a bounded cache, as codes depend on the word alone."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 2_000_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_WORDS = _Words()


def shingles(text: str):
    """Codes of the distinct shingles of a text, ascending.

    Words stand between ASCII white space, with A-Z in lower case; a text with
    fewer words than a shingle is one shingle, and one without words has none.
    """
    import numpy as np

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, "uint64")
    codes = np.fromiter(map(_WORDS.__getitem__, words), "uint64", len(words))
    size = min(WORDS, len(codes))
    count = len(codes) - size + 1
    mixed = np.full(count, size, "uint64")
    for k in range(size):
        mixed = (mixed ^ codes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    mixed.sort()
    first = np.ones(count, bool)
    np.not_equal(mixed[1:], mixed[:-1], out=first[1:])
    return mixed[first]


@lru_cache(maxsize=1)
def _functions():
    import numpy as np

    made = np.random.default_rng(SEED).integers(0, 1 << 63, (2, 2 * HALVES * ROWS), "uint64")
    return made[0] * np.uint64(2) + np.uint64(1), made[1]


def half_keys(codes):
    """The half-keys of a set: two collections of HALVES numbers."""
    import numpy as np

    factor, shift = _functions()
    least = np.full(len(factor), np.iinfo("uint64").max, "uint64")
    for start in range(0, len(codes), 4096):
        part = codes[start : start + 4096, None] * factor + shift
        least = np.minimum(least, part.min(axis=0))
    least = least.reshape(2 * HALVES, ROWS) >> np.uint64(16)
    half = np.zeros(2 * HALVES, "uint64")
    for k in range(ROWS):
        half = (half ^ least[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        half ^= half >> np.uint64(32)
    return half.reshape(2, HALVES)


def table_keys(half):
    """A key per table: every half-key of one collection with every one of the other.

    HALVES * HALVES tables of 2 * ROWS minhashes each come from 2 * HALVES * ROWS
    minhashes only.
    """
    import numpy as np

    number = np.arange(HALVES, dtype="uint64")
    left = (half[0] ^ number) * np.uint64(0x9E3779B97F4A7C15)
    right = (half[1] ^ (number + np.uint64(HALVES))) * np.uint64(0xC2B2AE3D27D4EB4F)
    keys = left[:, None] ^ (right[None, :] >> np.uint64(7)) ^ (right[None, :] << np.uint64(57))
    keys = keys * np.uint64(0x9E3779B97F4A7C15)
    return (keys ^ (keys >> np.uint64(31))).ravel().view("int64")


def _signature(codes) -> bytes:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).digest()


#: Longs in each of the two halves of a sketch; sets of fewer than EXACT shingles are
#: sketched whole, larger ones by a sample of EXACT / 2 to EXACT.
SKETCH = 8
EXACT = 1024


def sketch(codes):
    """Parity bits of a set: a bit tells whether it has an odd number of codes there.

    Two sets differ in at least as many codes as their sketches differ in bits.
    A set of EXACT codes or more is sampled by its level: of every 2 ** level codes
    one is taken, by its own bits, so that sets of one level sample alike. The first
    half holds the codes that the next level takes as well, the second the others;
    their sum is thus the sketch that the level below has as its first half.
    """
    import numpy as np

    level = max(0, len(codes).bit_length() - EXACT.bit_length() + 1)
    chosen = codes[(codes >> np.uint64(40)) & np.uint64((1 << level) - 1) == 0]
    place = ((chosen >> np.uint64(8)) & np.uint64(64 * SKETCH - 1)).astype("int64")
    further = (chosen >> np.uint64(40 + level)) & np.uint64(1) == 0
    place[~further] += 64 * SKETCH
    odd = np.bincount(place, minlength=128 * SKETCH) & 1
    return np.packbits(odd.astype("uint8")).view("int64")


#: A sampled pair is given up if it differs in more codes than a linked pair is
#: expected to by this many standard deviations (a chance of 1 in a million and less).
DEVIATIONS = 5


def may_link(one, one_sizes, other, other_sizes):
    """Which sets of one block may share 75 % of their union with which of another.

    A block is its sketches, a row each, and its sizes. Linked sets differ in
    (100 - PERCENT) / (100 + PERCENT) of their summed sizes at the most, so sets
    sketched whole are never given up wrongly.
    """
    import numpy as np

    def levels(sizes):
        bits = np.frexp(sizes.astype("float64"))[1]
        return np.maximum(0, bits - EXACT.bit_length() + 1)

    def differing(x, y):
        return np.bitwise_count(x[:, None, :] ^ y[None, :, :]).sum(axis=2, dtype="int64")

    first, second = one[:, :SKETCH], one[:, SKETCH:]
    their_first, their_second = other[:, :SKETCH], other[:, SKETCH:]
    low, high = levels(one_sizes)[:, None], levels(other_sizes)[None, :]
    found = differing(first, their_first) + differing(second, their_second)
    if (low != high).any():
        found = np.where(low < high, differing(first, their_first ^ their_second), found)
        found = np.where(low > high, differing(first ^ second, their_first), found)
    total = one_sizes[:, None] + other_sizes[None, :]
    level = np.maximum(low, high)
    mean = total * ((100 - PERCENT) / (100 + PERCENT)) / np.exp2(level)
    exact = found * (100 + PERCENT) <= total * (100 - PERCENT)
    return np.where(level == 0, exact, found <= mean + DEVIATIONS * np.sqrt(mean))


def _signed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Per row: id, size, 128-bit signature and sketch of its set, and its half-keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for texts in grouped(value.as_py() for value in batch.column(1)):
                rows = []
                for one, doc_id in zip(texts, ids):
                    codes = shingles(one)
                    if len(codes):
                        keys = half_keys(codes).ravel().view("int64")
                        rows.append((doc_id, len(codes), _signature(codes), keys, sketch(codes)))
                    else:
                        rows.append((doc_id, 0, None, None, None))
                columns = list(zip(*rows))
                longs = pa.list_(pa.int64())
                types = [pa.int64(), pa.int64(), pa.binary(), longs, longs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["doc_id", "n_shingles", "sig", "halves", "sketch"],
                )

    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_shingles long, sig binary, halves array<long>, sketch array<long>"
    return read.mapInArrow(sign, schema)


def _tables(classes: DataFrame) -> DataFrame:
    """(key, id, size): every table that a set stands in."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                halves = part.column(1).flatten().to_numpy(zero_copy_only=False)
                halves = halves.view("uint64").reshape(-1, 2, HALVES)
                keys = np.concatenate([table_keys(half) for half in halves])
                ids, sizes = (
                    pa.array(np.repeat(part.column(k).to_numpy(), HALVES * HALVES)) for k in (0, 2)
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), ids, sizes], names=["key", "id", "size"]
                )

    return classes.select("id", "halves", "size").mapInArrow(
        expand, "key long, id long, size long"
    )


def _coded(docs: DataFrame) -> DataFrame:
    """(doc_id, codes): the whole shingle sets, eight bytes a shingle, ascending."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for texts in grouped(value.as_py() for value in batch.column(1)):
                codes = [shingles(one).tobytes() for one in texts]
                own = [doc_id for _, doc_id in zip(codes, ids)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(codes, pa.binary())],
                    names=["doc_id", "codes"],
                )

    return docs.select("doc_id", "text").mapInArrow(code, "doc_id long, codes binary")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose full sets are similar enough.

    The set of every document that stands in a pair is built again from its
    text, once however many pairs it is in, and brought to them to be compared whole.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = settle(wanted, "paired")
    sets = settle(_coded(docs.join(wanted, "doc_id", "left_semi")), "paired-sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("codes").alias("codes_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("codes").alias("codes_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            kept = []
            for row in range(batch.num_rows):
                one, other = (
                    np.frombuffer(batch.column(k)[row].as_buffer(), "uint64") for k in (2, 3)
                )
                common = len(np.intersect1d(one, other, assume_unique=True))
                kept.append(100 * common >= PERCENT * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(kept, pa.bool_())],
                names=["a", "b", "linked"],
            )

    filled = pairs.join(left, "a").join(right, "b").select("a", "b", "codes_a", "codes_b")
    judged = filled.mapInArrow(compare, "a long, b long, linked boolean")
    return settle(judged.where("linked").select("a", "b").distinct(), "confirmed")


#: Members of a table compared with all of it per round grow by this factor.
SEEDS = 64
#: Members of a table are compared in blocks of about this many.
BLOCK = 128


def _centred(rows: DataFrame, centres: DataFrame) -> DataFrame:
    """(a, b): the centres of tables with the members that may be linked with them.

    Sets whose sizes differ too much cannot share 75 % of their union.
    """
    picked = centres.select("key", F.col("id").alias("seed"), F.col("size").alias("seed_size"))
    fits = (100 * F.least("size", "seed_size") >= PERCENT * F.greatest("size", "seed_size")) & (
        F.col("id") != F.col("seed")
    )
    joined = rows.join(picked, (rows["key"] == picked["key"]) & fits)
    return joined.select(
        F.least("id", "seed").alias("a"), F.greatest("id", "seed").alias("b")
    ).distinct()


def _blocks(rows: DataFrame, members, name: str) -> DataFrame:
    """(key, name): the rows of every table in blocks of about BLOCK of its ``members``."""
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.ceil(members / BLOCK))
    held = F.collect_list(F.struct("id", "size", "c", "sketch")).alias(name)
    return rows.groupBy("key", block.alias("block")).agg(held).select("key", name)


def _across(rows: DataFrame, starts: DataFrame, seeds: int) -> DataFrame:
    """(a, b): starts with the members of their tables that may be linked with them.

    Blocks are compared as arrays: sets in one component need no further link, and
    those whose sizes or sketches differ too much have none. A table meets in as
    many pairs of blocks as its starts and members fill.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def read(column: pa.ListArray):
            parts = column.flatten().flatten()
            numbers = [part.to_numpy(zero_copy_only=False) for part in parts[:3]]
            bits = parts[3].flatten().to_numpy(zero_copy_only=False).view("uint64")
            ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
            return ends, *numbers, bits.reshape(-1, 2 * SKETCH)

        for batch in batches:
            found = []
            one, other = read(batch.column(0)), read(batch.column(1))
            for row in range(batch.num_rows):
                (ids, sizes, groups, bits), (ids_, sizes_, groups_, bits_) = (
                    [values[side[0][row - 1] if row else 0 : side[0][row]] for values in side[1:]]
                    for side in (one, other)
                )
                least = np.minimum(sizes[:, None], sizes_[None, :])
                fits = 100 * least >= PERCENT * np.maximum(sizes[:, None], sizes_[None, :])
                fits &= groups[:, None] != groups_[None, :]
                at, met = fits.any(axis=1), fits.any(axis=0)
                if at.any():
                    fits = fits[at][:, met] & may_link(bits[at], sizes[at], bits_[met], sizes_[met])
                    x, y = np.nonzero(fits)
                    x, y = ids[at][x], ids_[met][y]
                    found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
            if found:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"]
                )

    joined = _blocks(starts, F.least("n", F.lit(seeds)), "one").join(
        _blocks(rows, F.col("n"), "other"), "key"
    )
    return joined.select("one", "other").mapInArrow(compare, "a long, b long").distinct()


def _links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Components of the sets' ids: (node, component) for those linked with another.

    In every table the member that meets most others (over all its tables) is
    compared with the rest: the original of a group of near copies, if it is
    there. Members that have come into one component need no further comparison.
    Tables that still hold several components go on with more and more members,
    64 times as many each round and the same ones in all tables, until all
    pairs across components have been compared: no pair of a table is given up
    but by its sketches, and the pairs within a group of near copies are never listed.
    """
    keyed = _tables(classes)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"))
    shared = settle(shared.where("n > 1"), "shared-tables")
    rows = settle(keyed.join(shared, "key"), "table-rows")
    met = rows.groupBy("id").agg(F.sum("n").alias("met"))
    centres = (
        rows.join(settle(met, "meetings"), "id")
        .groupBy("key")
        .agg(F.max_by("id", F.col("met") * 64 + F.pmod(F.xxhash64("id"), F.lit(64))).alias("id"))
    )
    centres = settle(centres.join(classes.select("id", "size"), "id"), "centres")
    tested = settle(_centred(rows, centres), "pairs")
    confirmed = _confirmed(tested, docs)
    seeds = 1
    while True:
        found = settle(components(confirmed), "components")
        most = rows.agg(F.max("n")).first()[0]
        if most is None or seeds >= most:
            return found
        seeds *= SEEDS
        now = F.coalesce("component", "id")
        placed = rows.drop("c", "sketch").join(found, rows["id"] == found["node"], "left").select(
            "key", "id", "size", "n", now.alias("c")
        )
        open_ = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"))
        open_ = settle(open_.where("low <> high").select("key"), "open-tables")
        still = placed.where("n > 2").join(open_, "key")
        rows = settle(still.join(classes.select("id", "sketch"), "id"), "open-rows")
        # The same ids have the lowest ranks in all tables they share.
        rank = F.pmod(F.xxhash64("id", F.lit(seeds)), F.lit(1 << 30))
        starts = rows.where(rank * F.col("n") < seeds * (1 << 30))
        fresh = _across(rows, starts, seeds).join(tested, ["a", "b"], "left_anti")
        fresh = settle(fresh, "pairs")
        confirmed = settle(confirmed.unionByName(_confirmed(fresh, docs)), "confirmed")
        tested = settle(tested.unionByName(fresh), "tested")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with the size of its shingle set and its group of near duplicates.

    Documents are linked if their sets of five-word shingles overlap by 75 % of
    their union or more; ``component_id`` is the smallest id that links lead to,
    and ``kept`` marks the document with that id. Equal sets count as one from
    the start. Candidates come from tensored banding: 100 tables whose keys pair
    10 half-keys with 10 others, 40 minhashes in all. A pair at exactly 75 %
    stands in no common table with a chance of 1 in 1,900, at 80 % of 1 in 14,000. Of
    pairs in one table, those whose sketches differ too much are not looked up; this
    loses no link of sets below 1,024 shingles and hardly one in a million of others.
    Every link is confirmed on the full sets, by their 64-bit codes.

    A null text and one without words have no shingles and are linked with
    nothing. Rows without an id are not linked either; their component is null
    and they are kept. Where an id is repeated, each row goes with its own text.
    An empty table gives an empty result. Only the two named columns are read.
    """
    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = settle(_signed(read, "doc_id", "text"), "signed")
    filled = "sig IS NOT NULL AND doc_id IS NOT NULL"
    with scratch_scope(docs.sparkSession):
        classes = settle(
            signed.where(filled)
            .groupBy("sig")
            .agg(
                F.min("doc_id").alias("id"),
                F.first("halves").alias("halves"),
                F.first("sketch").alias("sketch"),
                F.first("n_shingles").alias("size"),
            ),
            "sets",
        )
        linked = _links(classes, read.where("doc_id IS NOT NULL AND text IS NOT NULL"))
        group = F.coalesce("component", "id").alias("component_id")
        named = classes.join(linked, classes["id"] == linked["node"], "left").select("sig", group)
        named = settle(named, "groups", keep=True)
    alone = signed.where(f"NOT ({filled})").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    rows = (
        signed.where(filled)
        .select("doc_id", "n_shingles", "sig")
        .join(named, "sig")
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(alone)
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return rows.withColumn("kept", kept)


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of every group of near duplicates, with all columns of ``docs``.

    Documents are dropped by id: those that are in a group led by another id.
    Rows without an id stay.
    """
    with scratch_scope(docs.sparkSession):
        judged = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_again"))
        found = settle(judged.distinct(), "near-duplicates", keep=True)
    return docs.join(found, docs["doc_id"] == found["_again"], "left_anti")
