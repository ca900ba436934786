"""Similar lines across documents by an exact set-similarity join."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.once import compute_once
from tidemark.plans.storage import scratch_scope, settle

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Lines are similar if their words overlap by this share of their union.
THRESHOLD = 0.85
#: Words are counted by slots of their hash; the table of counts has this many entries.
SLOTS = 1 << 16
#: Line numbers below this; a text may have no more lines.
LINES = 1 << 31
LAST_ID = (1 << 63) - 1
HASH_BITS = 56
#: Bits of a posting's number: words of the line, place of the word in it, parity bits.
N_BITS, AT_BITS, PARITY_BITS = 15, 8, 40


def _row_key(doc: Column | str, text: Column | str) -> Column:
    """Tells rows of one id, or of none, apart by their text; copies share it."""
    return F.xxhash64(doc, text)


def _lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc_id, row_key, line_no, line): lines between ``\\n``, numbered from 0."""
    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.select(
        "doc_id", _row_key("doc_id", "text").alias("row_key"), F.posexplode(F.split("text", "\n"))
    ).select("doc_id", "row_key", F.col("pos").alias("line_no"), F.col("col").alias("line"))


def _words(line: Column | str) -> Column:
    return F.array_remove(F.split(F.lower(line), SPACE), "")


def _hashes(line: Column | str) -> Column:
    """The distinct words as 64-bit hashes, a third of the bytes of the words themselves."""
    return F.array_distinct(F.transform(_words(line), lambda w: F.xxhash64(w)))


def rarity_classes(docs: DataFrame, doc: str, text: str) -> bytearray:
    """A class per slot, ascending with the number of words in it over all documents.

    One byte per slot, a third of a binary order of magnitude each: the same
    size whatever the input. Words are summed up by slot before they are shuffled.
    """
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), SPACE)).alias("word"))
    slot = F.xxhash64("word").bitwiseAND(F.lit(SLOTS - 1)).cast("int")
    counts = words.groupBy(slot.alias("slot")).count()
    classes = bytearray(SLOTS)
    for row in counts.collect():
        classes[row["slot"]] = min(127, int(3 * math.log2(row["count"])))
    return classes


def _tokens(words: Column, classes: bytearray) -> Column:
    """The distinct words as numbers, rarest first: class in the upper bits, hash below."""
    table = F.lit(classes)

    def ordered(code: Column) -> Column:
        slot = code.bitwiseAND(F.lit(SLOTS - 1)).cast("int")
        rarity = F.ascii(F.substring(table, slot + 1, F.lit(1)).cast("string")).cast("long")
        low = code.bitwiseAND(F.lit((1 << HASH_BITS) - 1).cast("long"))
        return F.shiftleft(rarity, HASH_BITS).bitwiseOR(low)

    codes = F.transform(words, lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.transform(codes, ordered)))


def _place(doc_id: Column | str, line_no: Column | str) -> Column:
    """Order of lines over all documents; lines without a document id come last."""
    number = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(LAST_ID))
    return (number.cast("decimal(20,0)") * LINES + F.col(line_no)).cast("decimal(38,0)")


def _ratio(threshold: float) -> tuple[int, int]:
    """The threshold as a fraction, so that no rounding decides."""
    top = round(threshold * 1000)
    return top, 1000


def _signed(docs: DataFrame, doc: str, text: str, threshold: float) -> DataFrame:
    """Per line with words: place, signature of its set, prefix and parity bits."""
    top, whole = _ratio(threshold)
    classes = rarity_classes(docs, doc, text)
    tokens = (
        _lines(docs, doc, text)
        .where(F.col("line").rlike(NOT_SPACE))
        .select("doc_id", "row_key", "line_no", _tokens(_words("line"), classes).alias("t"))
    )
    # Of n words, n - ceil(threshold * n) + 1 must hold one in common with any similar line.
    prefix = F.size("t") - F.ceil(F.size("t") * top / whole).cast("int") + 1
    parity = F.aggregate(
        "t",
        F.lit(0).cast("long"),
        lambda bits, x: bits.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), (x % PARITY_BITS).cast("int"))
        ),
    )
    return tokens.select(
        "doc_id",
        "row_key",
        "line_no",
        F.size("t").alias("n"),
        F.xxhash64("t").alias("s1"),
        F.xxhash64(F.lit(17), F.col("t")).alias("s2"),
        parity.alias("parity"),
        F.slice("t", 1, prefix).alias("prefix"),
    )




def _postings(firsts: DataFrame, threshold: float) -> tuple[DataFrame, Column]:
    """Prefix words with their signatures, and what postings ``a`` and ``b`` of similar lines fulfil.

    A posting is three numbers: the word, the line's signature, and its length,
    the word's place and the parity bits in one. Lengths and places beyond their
    bits are held at the most they can say, and then filter nothing.
    """
    top, whole = _ratio(threshold)
    n_max, at_max = (1 << N_BITS) - 1, (1 << AT_BITS) - 1
    postings = firsts.select(
        F.col("s1").alias("id"), "n", "parity", F.posexplode("prefix").alias("at", "word")
    ).select(
        "word",
        "id",
        F.shiftleft(F.least("n", F.lit(n_max)).cast("long"), PARITY_BITS + AT_BITS)
        .bitwiseOR(F.shiftleft(F.least("at", F.lit(at_max)).cast("long"), PARITY_BITS))
        .bitwiseOR(F.col("parity"))
        .alias("packed"),
    )

    def part(side: str) -> tuple[Column, Column, Column]:
        packed = F.col(f"{side}.packed")
        return (
            F.shiftright(packed, PARITY_BITS + AT_BITS),
            F.shiftright(packed, PARITY_BITS).bitwiseAND(F.lit(at_max).cast("long")),
            packed.bitwiseAND(F.lit((1 << PARITY_BITS) - 1).cast("long")),
        )

    (n_a, at_a, bits_a), (n_b, at_b, bits_b) = part("a"), part("b")
    held = F.greatest(n_a, n_b) >= n_max
    near = F.least(n_a, n_b) * whole >= F.greatest(n_a, n_b) * top
    # Words from the shared one on must suffice for the overlap that is asked for.
    overlap = F.least(n_a - at_a, n_b - at_b) * (whole + top) >= (n_a + n_b) * top
    differing = F.bit_count(bits_a.bitwiseXOR(bits_b)) * (whole + top) <= (n_a + n_b) * (
        whole - top
    )
    return postings, (F.col("a.word") == F.col("b.word")) & (held | (near & overlap & differing))


def _candidates(firsts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): signatures that share a prefix word and pass all filters, each pair once."""
    postings, alike = _postings(firsts, threshold)
    return (
        postings.alias("a")
        .join(postings.alias("b"), (F.col("a.id") < F.col("b.id")) & alike)
        .select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
        .distinct()
    )


def _first_lines(
    ids: DataFrame, classes: DataFrame, docs: DataFrame, doc: str, text: str
) -> DataFrame:
    """(id, place, line): the first line of every signature in ``ids``.

    Documents are joined with the numbers of their wanted lines, so that only
    these lines leave them; of rows that repeat an id and text one is enough.
    """
    wanted = (
        classes.join(ids, "s1")
        .select(
            _doc_of("first").alias("_doc"),
            F.col("row_key").alias("_key"),
            F.struct(_line_of("first").alias("line_no"), "s1", "first").alias("w"),
        )
        .groupBy("_doc", "_key")
        .agg(F.collect_set("w").alias("wanted"))
    )
    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    of_row = (_row_key("doc_id", "text") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    split = read.join(settle(wanted, "wanted-lines"), of_row).select(
        F.split("text", "\n").alias("all"), F.explode("wanted").alias("w")
    )
    lines = split.select(
        F.col("w.s1").alias("id"), F.col("w.first").alias("place"), F.get("all", "w.line_no").alias("line")
    )
    return settle(lines.where(F.col("line").isNotNull()).dropDuplicates(["id"]), "paired-lines")


#: Parity bits that a pair is filtered by before its lines are brought together.
WIDE_BITS, WIDE = 64, 3


def _wide_bits(sets: DataFrame) -> DataFrame:
    """(id, n, p0, p1, p2): number of words and wider parity bits of each line in ``sets``."""
    narrow = compute_once(sets, {"codes": _hashes("line")})

    def parity(k: int) -> Column:
        return F.aggregate(
            "codes",
            F.lit(0).cast("long"),
            lambda bits, x: bits.bitwiseXOR(
                F.call_function(
                    "shiftleft",
                    F.lit(1).cast("long"),
                    F.shiftright(x, 16 * k).bitwiseAND(F.lit(WIDE_BITS - 1)).cast("int"),
                )
            ),
        )

    return settle(
        narrow.select(
            "id", F.size("codes").alias("n"), *[parity(k).alias(f"p{k}") for k in range(WIDE)]
        ).distinct(),
        "line-bits",
    )


#: Shares of the prefix words whose sets are compared one after the other.
PASSES = 4


def _members(close: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """A share of the prefix words, each with the whole set of its line: the widest rows here."""
    own = F.pmod(F.xxhash64("word"), F.lit(PASSES)) == share
    return close.where(own).join(sets, "id")


def _after_similar(
    classes: DataFrame, docs: DataFrame, doc: str, text: str, threshold: float
) -> DataFrame:
    """(s1, own): the classes that have a similar one before them.

    A class asks for one earlier line only, so no join makes more rows than there
    are prefix words, however many near copies a line has. Prefix words that no
    other line can be similar under are left out, first by the parity bits of the
    posting, then by wider ones. Whole sets, as hashes of their words, go with
    every prefix word that is left, a share of the words at a time.
    """
    top, whole = _ratio(threshold)
    postings, alike = _postings(classes, threshold)
    met = postings.alias("a").join(
        postings.alias("b"), (F.col("a.id") != F.col("b.id")) & alike, "left_semi"
    )
    live = settle(met.select("word", "id"), "live-words")
    ids = live.select(F.col("id").alias("s1")).distinct()
    lines = _first_lines(ids, classes, docs, doc, text)
    bits = _wide_bits(lines)
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    total = a("n") + b("n")
    near = F.least(a("n"), b("n")) * whole >= F.greatest(a("n"), b("n")) * top
    differing = sum(
        (F.bit_count(a(f"p{k}").bitwiseXOR(b(f"p{k}"))) for k in range(1, WIDE)),
        F.bit_count(a("p0").bitwiseXOR(b("p0"))),
    )
    met = (a("word") == b("word")) & near & (
        differing * (whole + top) <= F.lit(WIDE) * total * (whole - top)
    )
    wide = live.join(bits, "id")
    close = wide.alias("a").join(wide.alias("b"), met & (a("id") != b("id")), "left_semi")
    close = settle(close.select("word", "id"), "close-words")
    sets = settle(
        lines.join(close.select("id").distinct(), "id", "left_semi")
        .join(bits, "id")
        .select(*bits.columns, "place", _hashes("line").alias("words")),
        "close-sets",
    )
    earlier = (b("place") < a("place")) | ((b("place") == a("place")) & (b("id") < a("id")))
    common = F.size(F.array_intersect(a("words"), b("words")))
    found = []
    for share in range(PASSES):
        members = _members(close, sets, share)
        after = members.alias("a").join(
            members.alias("b"),
            met & earlier & (common * (whole + top) >= total * top),
            "left_semi",
        )
        after = after.select(F.col("id").alias("s1"), F.col("place").alias("own")).distinct()
        found.append(settle(after, "later-lines"))
    return reduce(DataFrame.unionByName, found).distinct()


def _verified(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, doc: str, text: str, threshold: float
) -> DataFrame:
    """The pairs whose whole sets of words are similar, with both classes' first places."""
    top, whole = _ratio(threshold)
    ids = settle(pairs.select(F.explode(F.array("a", "b")).alias("s1")).distinct(), "paired")
    sets = _first_lines(ids, classes, docs, doc, text)

    pairs = settle(_alike(pairs, sets, threshold), "alike-lines")

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("id").alias(name), F.col("place").alias(f"place_{name}"), F.col("line").alias(f"line_{name}")
        )

    def words(name: str) -> Column:
        return F.array_distinct(_words(f"line_{name}"))

    both = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", "place_a", "place_b", words("a").alias("x"), words("b").alias("y"))
        .select(
            "a",
            "b",
            "place_a",
            "place_b",
            F.size(F.array_intersect("x", "y")).alias("common"),
            (F.size("x") + F.size("y")).alias("total"),
        )
    )
    similar = compute_once(both, {"enough": F.col("common") * (whole + top) >= F.col("total") * top})
    return similar.where("enough").select("a", "b", "place_a", "place_b").distinct()


def _alike(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose wider parity bits allow them to be similar.

    A word that one line lacks turns one bit at the most, so no similar pair is
    lost, and few others are left for the comparison of whole sets.
    """
    top, whole = _ratio(threshold)
    bits = _wide_bits(sets)

    def side(name: str) -> DataFrame:
        return bits.select(*[F.col(c).alias(name if c == "id" else f"{c}_{name}") for c in bits.columns])

    differing = sum(
        (F.bit_count(F.col(f"p{k}_a").bitwiseXOR(F.col(f"p{k}_b"))) for k in range(1, WIDE)),
        F.bit_count(F.col("p0_a").bitwiseXOR(F.col("p0_b"))),
    )
    total = F.col("n_a") + F.col("n_b")
    most = F.lit(WIDE) * total * (whole - top)
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(differing * (whole + top) <= most)
        .select("a", "b")
        .distinct()
    )


def _doc_of(place: Column | str) -> Column:
    at = F.col(place) if isinstance(place, str) else place
    number = F.floor(at / LINES).cast("decimal(20,0)").cast("long")
    return F.when(number != LAST_ID, number)


def _line_of(place: Column | str) -> Column:
    return ((F.col(place) if isinstance(place, str) else place) % LINES).cast("int")


def similar_lines(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Every line that holds a word, and whether an earlier line is similar to it.

    Lines are sets of lower-case words between ASCII white space; two are similar
    if they share ``threshold`` of their union. ``removed`` marks lines with a
    similar one before them, by document id and line number. Lines of equal sets
    are one class: ``first_doc_id`` and ``first_line_no`` name its first line,
    ``n_links`` the number of other classes similar to it and ``match_doc_id``
    and ``match_line_no`` the earliest similar line before the class, if any.

    Words are ordered by rarity over all documents; classes that share a word of
    their prefixes and pass the length, positional and parity filters are
    compared on their whole sets. Copies are counted as one class before the
    join, so a line may be repeated any number of times.

    Null and blank lines are not returned. Lines without a document id come
    last, as those of one document. Ids should be unique: rows that repeat one are
    the same document. Of similar lines at the same place of it one is the later;
    those of equal sets there do not remove each other. An empty table gives an
    empty result; further columns are not read.
    """
    return _judged(docs, doc, text, threshold).drop("row_key")


def _classed(
    docs: DataFrame, doc: str, text: str, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """Lines with the signature of their set, and one row per signature with its first place."""
    lines = settle(_signed(docs, doc, text, threshold), "lines")
    classes = (
        lines.groupBy("s1", "s2")
        .agg(
            F.min(F.struct(_place("doc_id", "line_no").alias("place"), "row_key")).alias("first"),
            F.count("*").alias("copies"),
            F.first("n").alias("n"),
            F.first("parity").alias("parity"),
            F.first("prefix").alias("prefix"),
        )
        .select("s1", "s2", "first.place", "first.row_key", "copies", "n", "parity", "prefix")
        .withColumnRenamed("place", "first")
    )
    return lines, settle(classes, "line-classes")


def _judged(docs: DataFrame, doc: str, text: str, threshold: float) -> DataFrame:
    """``similar_lines`` with the key of the row each line stands in."""
    lines, classes = _classed(docs, doc, text, threshold)
    with scratch_scope(docs.sparkSession):
        pairs = settle(_candidates(classes, threshold), "line-pairs")
        linked = _verified(pairs, classes, docs, doc, text, threshold)
        linked = settle(linked, "line-links", keep=True)

    def links_of(own: str, other: str) -> DataFrame:
        return linked.select(
            F.col(own).alias("s1"),
            F.col(f"place_{own}").alias("own"),
            F.col(f"place_{other}").alias("other"),
            F.col(other).alias("s1_other"),
        )

    each = links_of("a", "b").unionByName(links_of("b", "a"))
    before = (F.col("other") < F.col("own")) | (
        (F.col("other") == F.col("own")) & (F.col("s1_other") < F.col("s1"))
    )
    earlier = F.when(before, F.col("other"))
    links = each.groupBy("s1", "own").agg(
        F.count("*").alias("n_links"), F.min(earlier).alias("match")
    )
    # A class of one line without links needs no word about it.
    known = (
        classes.join(links, (classes["s1"] == links["s1"]) & (classes["first"] == links["own"]), "left")
        .where("copies > 1 OR n_links > 0")
        .select(classes["s1"], "s2", "first", "n_links", "match")
    )
    place = _place("doc_id", "line_no")
    own = F.coalesce("first", place)
    return (
        lines.select("doc_id", "row_key", "line_no", "n", "s1", "s2")
        .join(settle(known, "known-lines"), ["s1", "s2"], "left")
        .select(
            "doc_id",
            "row_key",
            "line_no",
            F.col("n").alias("n_words"),
            _doc_of(own).alias("first_doc_id"),
            _line_of(own).alias("first_line_no"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            _doc_of(F.col("match")).alias("match_doc_id"),
            _line_of(F.col("match")).alias("match_line_no"),
            (F.col("match").isNotNull() | (place != own)).alias("removed"),
        )
    )


def _repeating(docs: DataFrame, doc: str, text: str, threshold: float) -> DataFrame:
    """(doc_id, row_key, line_no): the lines that ``similar_lines`` marks as removed."""
    lines, classes = _classed(docs, doc, text, threshold)
    after = settle(_after_similar(classes, docs, doc, text, threshold), "later-lines")
    known = (
        classes.join(after, (classes["s1"] == after["s1"]) & (classes["first"] == after["own"]), "left")
        .where("copies > 1 OR own IS NOT NULL")
        .select(classes["s1"], "s2", "first", F.col("own").isNotNull().alias("later"))
    )
    return (
        lines.select("doc_id", "row_key", "line_no", "s1", "s2")
        .join(settle(known, "known-lines"), ["s1", "s2"])
        .where(F.col("later") | (_place("doc_id", "line_no") != F.col("first")))
        .select("doc_id", "row_key", "line_no")
    )


def without_similar_lines(docs: DataFrame) -> DataFrame:
    """Documents without the lines that ``similar_lines`` removes, with their columns.

    ``n_chars``, if there is such a column, is the new number of characters.
    Documents that lose their last word are dropped; documents that had none stay
    as they are, and so do documents without an id.
    """
    with scratch_scope(docs.sparkSession):
        gone = (
            _repeating(docs, "doc_id", "text", THRESHOLD)
            .where("doc_id IS NOT NULL")
            .groupBy(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key"))
            .agg(F.collect_set("line_no").alias("_gone"))
        )
        gone = settle(gone, "removed-lines", keep=True)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    number = F.col("row.doc_id").cast("long")
    of_row = (number == F.col("_doc")) & (_row_key(number, F.col("row.text")) == F.col("_key"))
    joined = whole.join(gone, of_row, "left")
    split = compute_once(joined, {"all": F.split("row.text", "\n")})
    left = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), "_gone")
    split = compute_once(split, {"left": F.when(F.col("_gone").isNotNull(), left)})
    shorter = F.array_join(F.transform("left", lambda i: F.get("all", i)), "\n")
    cut = compute_once(split, {"cut": F.when(F.col("left").isNotNull(), shorter)}).select(
        "row", "left", F.coalesce("cut", "row.text").alias("cut")
    )
    cut = cut.where(F.col("left").isNull() | F.col("cut").rlike(NOT_SPACE))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("cut").alias("text")
        value = F.col(f"row.`{name}`")
        if name == "n_chars":
            new = F.char_length("cut").cast(docs.schema[name].dataType)
            return F.when(F.col("left").isNotNull(), new).otherwise(value).alias(name)
        return value.alias(name)

    return cut.select(*[column(name) for name in docs.columns])
