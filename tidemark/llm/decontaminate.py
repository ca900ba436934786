"""Passages of a benchmark found in documents by q-gram filtering and banded alignment."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import grouped
from tidemark.plans.storage import settle

#: Length of a q-gram in folded characters.
Q = 8
#: Edits allowed per folded character of an item.
EDIT_RATE = 0.1
#: Benchmark text that is searched in one pass over the documents.
BLOCK_CHARS = 4_000_000
TABLE_BITS = 22
#: Pairs of a document's q-gram and an item that are held at a time.
HITS = 2_000_000

MIX = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _folding():
    """Per code point: its lower case, and 0 for all but letters and digits."""
    import numpy as np

    table = np.zeros(0x110000, "uint32")
    for code in range(0x30000):
        char = chr(code)
        if char.isalnum():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def folded(text: str):
    """Letters and digits of a text in lower case, and where each stands in it."""
    import numpy as np

    codes = _folding()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    where = np.flatnonzero(codes)
    return codes[where], where


def qgrams(codes, q: int = Q):
    """A 64-bit code for every run of ``q`` characters, built up by doubling."""
    import numpy as np

    if len(codes) < q:
        return np.empty(0, "uint64")
    base = 0x100000001B3

    def power(n):
        return np.uint64(pow(base, n, 1 << 64))

    step, width, done, length = codes.astype("uint64"), 1, None, 0
    rest = q
    while rest:
        if rest & 1:
            if done is None:
                done, length = step, width
            else:
                n = len(codes) - length - width + 1
                done = done[:n] * power(width) + step[length : length + n]
                length += width
        rest >>= 1
        if rest:
            n = len(codes) - 2 * width + 1
            step = step[:n] * power(width) + step[width : width + n]
            width *= 2
    done = done * np.uint64(MIX)
    return done ^ (done >> np.uint64(29))


def budget(length: int, q: int = Q, rate: float = EDIT_RATE) -> tuple[int, int, int]:
    """Edits allowed for an item, the q-gram length it is found by, and the q-grams left.

    Short items are found by shorter q-grams, so that at least one is left
    whatever the edits; at fewer than ``q`` characters the q-gram is the item.
    """
    edits = 0 if length < q else min(int(rate * length), length - 1)
    gram = min(q, length // (1 + edits))
    return edits, gram, length - gram + 1 - gram * edits


def banded_distance(item, region, low: int, high: int, most: int):
    """Edits that turn ``item`` into the best part of ``region``, and that part.

    Row by row over the item, in the band of diagonals ``low`` to ``high``. Gives
    (edits, start, end), or None beyond ``most`` edits.
    """
    import numpy as np

    width = high - low + 1
    far = len(item) + len(region) + 1
    steps = np.arange(width)
    padded = np.full(len(region) + 2 * (width + len(item)) + 2, -1, "int64")
    shift = width + len(item)
    padded[shift : shift + len(region)] = region
    # Cell k of row i stands for i characters of the item and i + low + k of the region.
    column = low + steps
    inside = (column >= 0) & (column <= len(region))
    cost = np.where(inside, 0, far)
    start = np.where(inside, column, 0)
    for i in range(1, len(item) + 1):
        column = column + 1
        inside = (column >= 0) & (column <= len(region))
        at = column[0] - 1 + shift
        step = cost + (padded[at : at + width] != item[i - 1])
        drop = np.append(cost[1:], far) + 1
        down = drop < step
        best = np.where(down, drop, step)
        origin = np.where(down, np.append(start[1:], 0), start)
        best = np.where(inside, best, far)
        slope = best - steps
        lowest = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == lowest, steps, 0))
        cost = np.where(inside, lowest + steps, far)
        start = origin[source]
        if cost.min() > most:
            return None
    k = int(cost.argmin())
    return int(cost[k]), int(start[k]), int(column[k])


class Index:
    """The q-grams of items that are found by one length of q-gram, for lookup in a worker."""

    def __init__(self, items: list[tuple], q: int):
        """``items``: (item id, folded characters, edits allowed, q-grams that must be left)."""
        import numpy as np

        self.q = q
        self.ids, codes, edits, least = (list(part) for part in zip(*items))
        self.codes = [c.astype("int64") for c in codes]
        found = [qgrams(c, q) for c in codes]
        grams = np.concatenate(found)
        order = np.argsort(grams, kind="stable")
        self.owner = np.repeat(np.arange(len(found)), [len(g) for g in found])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in found])[order]
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.table = np.zeros(1 << TABLE_BITS, "bool")
        self.table[self.slots(self.grams)] = True
        self.edits = np.array(edits, "int64")
        self.least = np.array(least, "int64")
        self.width = self.edits + 1
        self.longest = max(len(c) for c in codes)

    @staticmethod
    def slots(grams):
        import numpy as np

        return (grams >> np.uint64(64 - TABLE_BITS)).astype("int64")

    def hits(self, codes):
        """Q-grams of ``codes`` that items hold: (position, entry of ``grams``)."""
        import numpy as np

        grams = qgrams(codes, self.q)
        at = np.flatnonzero(self.table[self.slots(grams)])
        found = np.searchsorted(self.grams, grams[at])
        found[found == len(self.grams)] = 0
        same = self.grams[found] == grams[at]
        return at[same], found[same]

    def owners(self, at, found):
        """(items, diagonals) of hits, in parts of about ``HITS``, as many items may share a q-gram."""
        import numpy as np

        many = self.count[found]
        part = (np.cumsum(many) - many) // HITS
        cuts = np.flatnonzero(np.diff(part)) + 1
        for at, found, many in zip(*(np.split(x, cuts) for x in (at, found, many))):
            shift = self.first[found] - np.cumsum(many) + many
            entry = np.repeat(shift, many) + np.arange(int(many.sum()))
            yield self.owner[entry], np.repeat(at, many) - self.place[entry]

    def bands(self, codes):
        """Items and bands of diagonals that keep enough q-grams: (item, band)."""
        import numpy as np

        at, found = self.hits(codes)
        if not len(at):
            return []
        total = np.zeros(len(self.ids), "int64")
        for item, _ in self.owners(at, found):
            total += np.bincount(item, minlength=len(self.ids))
        enough = total >= self.least
        if not enough.any():
            return []
        span = len(codes) + int(self.width.max()) + self.longest + 2
        keys, counts = np.empty(0, "int64"), np.empty(0, "int64")
        for item, diagonal in self.owners(at, found):
            item, diagonal = item[enough[item]], diagonal[enough[item]]
            band = diagonal // self.width[item]
            both = diagonal - band * self.width[item] < self.edits[item]
            item = np.concatenate([item, item[both]])
            band = np.concatenate([band, band[both] - 1])
            more, n = np.unique(item * (2 * span) + band + span, return_counts=True)
            keys, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(keys)).astype("int64")
        kept = keys[counts >= self.least[keys // (2 * span)]]
        return [(int(k // (2 * span)), int(k % (2 * span)) - span) for k in kept]

    def matches(self, codes):
        """Best place of every item in a folded text: {item id: (edits, start, end)}."""
        best: dict[int, tuple[int, int, int]] = {}
        for item, band in self.bands(codes):
            width, edits = int(self.width[item]), int(self.edits[item])
            low = band * width
            high = low + width + edits - 1
            start = max(0, low - edits)
            end = min(len(codes), high + len(self.codes[item]) + edits + 1)
            found = banded_distance(
                self.codes[item],
                codes[start:end].astype("int64"),
                low - start - edits,
                high - start + edits,
                edits,
            )
            if found is None or found[0] > edits:
                continue
            cost, first, last = found
            place = (cost, start + first, start + last)
            best[item] = min(best.get(item, place), place)
        return [(self.ids[item], *place) for item, place in best.items()]

    def words(self, codes, where):
        """First place of every item that is one q-gram and stands apart from other letters."""
        import numpy as np

        at, found = self.hits(codes)
        before, after = np.append(-2, where), np.append(where, where[-1:] + 2)
        apart = (before[at] + 1 < where[at]) & (after[at + self.q] > where[at + self.q - 1] + 1)
        found, first = np.unique(found[apart], return_index=True)
        at = at[apart][first]
        return [
            (self.ids[item], 0, int(start), int(start) + self.q)
            for entry, start in zip(found, at)
            for item in self.owner[self.first[entry] : self.first[entry] + self.count[entry]]
            if np.array_equal(self.codes[item], codes[start : start + self.q])
        ]


class Block:
    """A block of items: an index for every length of q-gram they are found by."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float):
        long: dict[int, list] = {}
        short: dict[int, list] = {}
        for item_id, text in items:
            codes, _ = folded(text)
            if len(codes):
                edits, gram, least = budget(len(codes), q, rate)
                kind = long if len(codes) >= q else short
                kind.setdefault(gram, []).append((item_id, codes, edits, least))
        self.long = [Index(part, gram) for gram, part in sorted(long.items())]
        self.short = [Index(part, gram) for gram, part in sorted(short.items())]

    def matches(self, text: str):
        """Best place of every item that the text holds: (item id, edits, start, end)."""
        codes, where = folded(text)
        found = [match for index in self.long for match in index.matches(codes)]
        found += [match for index in self.short for match in index.words(codes, where)]
        return [
            (item, edits, int(where[first]), int(where[last - 1]) + 1)
            for item, edits, first, last in sorted(found, key=lambda match: match[0] or 0)
        ]


_INDEXES: dict = {}


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    passage: str = "text",
    q: int = Q,
    rate: float = EDIT_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Benchmark items that documents hold with at most ``rate`` edits per character.

    One row per document and item: the fewest edits, and the part of the text it
    covers (code points). Texts are compared by their letters and digits in lower
    case. An item of m characters with e edits allowed shares m - q + 1 - q*e
    q-grams with any such part, all near one diagonal: hits are counted in
    overlapping bands of diagonals, and bands with that many are aligned.

    The benchmark is the stated set of queries. It is searched in blocks of at
    most ``block_chars`` characters, one scan of the documents each; a block is
    what is broadcast. Short items are found by shorter q-grams. Items with fewer
    than ``q`` letters and digits must stand in the text without an edit and apart
    from other letters and digits, as "cat" does not in "education". Null items
    and items without a letter or digit are not searched. Null texts match nothing. Repeated rows give repeated results; null ids are kept.
    Empty tables give an empty result.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits long, char_start long, char_end long"
    items = benchmark.where(F.col(passage).isNotNull()).select(
        F.col(item).cast("long").alias("item_id"), F.col(passage).alias("text")
    )
    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    results = None
    for block in _blocks(items, block_chars):
        shared = spark.sparkContext.broadcast(block)
        content = hashlib.sha256(repr(block).encode("utf-8", "replace")).hexdigest()

        def search(batches: Iterator[pa.RecordBatch], shared=shared, key=(content, q, rate)):
            if key not in _INDEXES:
                _INDEXES.clear()
                _INDEXES[key] = Block(shared.value, q, rate)
            index = _INDEXES[key]
            for batch in batches:
                ids = iter(batch.column(0).to_pylist())
                for texts in grouped(value.as_py() for value in batch.column(1)):
                    rows = [
                        (doc_id, *match)
                        for one, doc_id in zip(texts, ids)
                        for match in index.matches(one)
                    ]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*rows)],
                            names=["doc_id", "item_id", "edits", "char_start", "char_end"],
                        )

        found = read.mapInArrow(search, schema)
        results = found if results is None else results.unionByName(found)
    return spark.createDataFrame([], schema) if results is None else results


def _blocks(items: DataFrame, block_chars: int):
    """The items in lists of bounded size, read one after the other."""
    block, chars = [], 0
    for row in items.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        chars += len(row["text"])
        if chars >= block_chars:
            yield block
            block, chars = [], 0
    if block:
        yield block


def without_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Documents that hold no benchmark item, with all their columns.

    Documents are dropped by id, so rows that repeat a leaking id go with it;
    rows without an id are judged like others but kept, as nothing names them.
    """
    leaks = find_passages(docs, benchmark, **settings).select(F.col("doc_id").alias("_leak"))
    found = settle(leaks.where("_leak IS NOT NULL").distinct(), "leaks")
    return docs.join(found, docs["doc_id"] == found["_leak"], "left_anti")
