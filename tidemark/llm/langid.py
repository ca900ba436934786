"""Languages told by the nearest of several centroids of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import grouped
from tidemark.plans.skew import salted_join
from tidemark.plans.storage import settle

#: Slots that n-grams of 1 to 4 bytes are hashed into.
SLOTS = 1 << 13
GRAMS = (1, 2, 3, 4)
#: Documents learnt from: per language, and in all; at least one per language.
SAMPLE, SAMPLES = 500, 4000
CENTROIDS = 4
SEED = 11
ROUNDS = 10
#: Distance to the nearest centroid, as a quantile of the learnt documents', beyond
#: which a text counts as none of the languages.
REJECT_QUANTILE = 0.999
UNDEFINED = "und"

_LETTER = regex.compile(r"\p{L}")


def profile(text: str):
    """Hashed counts of a text's byte n-grams, in lower case, between spaces."""
    import numpy as np

    data = np.frombuffer((" " + text.lower() + " ").encode(), "uint8").astype("uint32")
    counts = np.zeros(SLOTS, "int64")
    code = np.zeros(len(data), "uint32")
    for n in range(1, max(GRAMS) + 1):
        count = len(data) - n + 1
        if count <= 0:
            break
        code = code[:count] * np.uint32(0x01000193) + data[n - 1 :] + np.uint32(n)
        if n in GRAMS:
            mixed = code * np.uint32(0x9E3779B1)
            counts += np.bincount(mixed >> np.uint32(19), minlength=SLOTS)
    return counts


def weighted(counts, idf):
    """TF-IDF vectors of length one; rows without a count stay zero."""
    import numpy as np

    vectors = np.log1p(counts) * idf
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms == 0, 1, norms)).astype("float32")


def _clusters(vectors, count: int):
    """Centroids of unit vectors by spherical k-means, started far apart."""
    import numpy as np

    centres = [vectors.mean(axis=0)]
    for _ in range(1, min(count, len(vectors))):
        nearest = np.max(vectors @ np.array(centres).T, axis=1)
        centres.append(vectors[int(nearest.argmin())])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        own = (vectors @ centres.T).argmax(axis=1)
        centres = np.array(
            [
                vectors[own == k].mean(axis=0) if (own == k).any() else centres[k]
                for k in range(len(centres))
            ]
        )
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def fit(
    docs: DataFrame,
    usable: Column,
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    samples: int = SAMPLES,
) -> dict:
    """Centroids per language, from ``sample`` usable documents of each.

    ``sample`` rows of each language are drawn at random, or all it has; fewer if all
    languages together would pass ``samples``, but never less than one of each.
    Only hashed counts (at most ``SLOTS`` numbers a document) reach the driver.
    Rows with a null language or a text without letters teach nothing. Without
    any usable row the model is empty.
    """
    import numpy as np

    known = docs.where(
        usable & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")
    ).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = settle(known.groupBy("lang").agg(F.count("*").alias("_size")), "languages")
    each = max(1, min(sample, samples // max(1, sizes.count())))
    # A few more than asked for, so that none is short of rows; the lowest draws count.
    shares = sizes.select("lang", ((3 * each + 50) / F.col("_size")).alias("_share"))
    drawn = salted_join(known.withColumn("_draw", F.rand(SEED)), shares, "lang", ("text",))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_draw"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, slots, numbers = [], [], []
            for name, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = profile(one.as_py())
                at = np.flatnonzero(found)
                names.append(name)
                slots.append(at.astype("int32"))
                numbers.append(found[at].astype("int32"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array(slots, pa.list_(pa.int32())),
                    pa.array(numbers, pa.list_(pa.int32())),
                ],
                names=["lang", "slots", "numbers"],
            )

    rows = (
        drawn.where("_draw < _share")
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= each)
        .select("lang", "text")
        .mapInArrow(count, "lang string, slots array<int>, numbers array<int>")
        .toArrow()
        .sort_by("lang")
    )
    if not rows.num_rows:
        return {"langs": [], "idf": None, "centres": None, "least": None}
    counts = np.zeros((rows.num_rows, SLOTS), "float32")
    for i, (at, n) in enumerate(zip(rows.column("slots"), rows.column("numbers"))):
        counts[i, at.values.to_numpy()] = n.values.to_numpy()
    names = np.array(rows.column("lang").to_pylist())
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
    vectors = weighted(counts, idf)
    langs, centres, least = [], [], []
    for name in sorted(set(names.tolist())):
        own = vectors[names == name]
        found = _clusters(own, CENTROIDS)
        langs += [name] * len(found)
        centres.append(found)
        nearest = (own @ found.T).max(axis=1)
        least += [float(np.quantile(nearest, 1 - REJECT_QUANTILE))] * len(found)
    return {
        "langs": langs,
        "idf": idf,
        "centres": np.concatenate(centres).astype("float32"),
        "least": np.array(least),
    }


def predict(docs: DataFrame, model: dict, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with the language of the nearest centroid.

    ``score`` is the cosine to that centroid; ``rejected`` marks texts farther
    from it than all but a thousandth of the documents learnt from. A null text,
    one without letters and any text under an empty model is ``und`` with score
    0, and rejected. Ids may be null or repeated; an empty table gives an empty
    result. Only the two named columns are read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        langs, idf = shared.value["langs"], shared.value["idf"]
        centres, least = shared.value["centres"], shared.value["least"]
        for batch in batches:
            names, scores, rejected = [], [], []
            for texts in grouped((value.as_py() for value in batch.column(1)), 1_000_000):
                letters = [bool(langs) and bool(_LETTER.search(one)) for one in texts]
                told = iter(())
                if any(letters):
                    counts = np.array([profile(t) for t, has in zip(texts, letters) if has])
                    near = weighted(counts, idf) @ centres.T
                    best = near.argmax(axis=1)
                    told = zip(best.tolist(), near.max(axis=1).tolist())
                for has in letters:
                    k, cosine = next(told) if has else (None, 0.0)
                    names.append(langs[k] if has else UNDEFINED)
                    scores.append(min(1.0, max(0.0, cosine)))
                    rejected.append(not has or cosine < least[k])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(
        judge, "doc_id long, lang_pred string, score double, rejected boolean"
    )
