"""Toxicity by compression distance between two zstandard dictionaries."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import grouped
from tidemark.plans.storage import settle

#: Labelled documents learnt from: of each label, and the longest that is drawn.
TOXIC_SAMPLE, ORDINARY_SAMPLE, LONGEST = 2000, 4000, 32_768
SEED = 7
#: Bytes of ordinary and of toxic strings in a dictionary.
ORDINARY_BYTES, TOXIC_BYTES = 40_000, 2_500
#: How much more often a string must occur in toxic documents to enter their dictionary.
CONTRAST = 6
SHORTEST, WINDOW = 4, 40
LEVEL = 3
DIFFERENCES, LENGTHS = 12, 14


def windows(text: str) -> list[bytes]:
    """A window per word: lower case, between spaces, at most 40 bytes at a time."""
    words = text.lower().encode().split()
    if any(len(w) > WINDOW for w in words):
        return [w[i : i + WINDOW] for w in words for i in range(0, len(w), WINDOW)]
    return words


def _strings(text: str) -> set[bytes]:
    """The words of a text and their beginnings."""
    words = set(windows(text))
    return words | {w[:k] for w in words for k in range(SHORTEST, min(len(w), 16))}


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes, bytes]:
    """Contents of the dictionary of toxic text, of that of ordinary text, and the frame.

    Both begin with the words most frequent in ordinary documents. The toxic one
    goes on with the strings that stand in many toxic and few ordinary documents,
    the ordinary one with as many bytes of its own. The frame is a phrase at the
    end of both; windows are compressed between two of it, so that the length
    shows what the window itself costs.
    """
    seen, common = Counter(), Counter()
    for text in toxic:
        seen.update(_strings(text))
    for text in ordinary:
        common.update(_strings(text))
    words = Counter()
    for text in ordinary:
        words.update(set(windows(text)))

    def share(count: int, of: int) -> float:
        return (count + 0.5) / (of + 1)

    scored = []
    for string, count in seen.items():
        odds = share(count, len(toxic)) / share(common[string], len(ordinary))
        if count >= 3 and odds > CONTRAST:
            scored.append((-count * math.log(odds), string))
    chosen, held = [], b" "
    for _, string in sorted(scored):
        if b" " + string not in held:
            chosen.append(string)
            held += string + b" "
        if len(held) > TOXIC_BYTES:
            break
    ranked = sorted(words.items(), key=lambda item: (-item[1], item[0]))
    frequent = [word for word, _ in ranked[:8000] if len(word) >= 3]
    base = b" ".join(reversed(frequent))[-ORDINARY_BYTES:]
    frame = b"~ " + b" ".join(frequent[:6]) + b" "
    own = b" ".join(reversed(chosen))
    return base + b" " + own + b" " + frame, base + b" " + base[: len(own)] + b" " + frame, frame


class Distance(dict):
    """By window: the bytes that the toxic dictionary saves, with the window's length."""

    def __init__(self, toxic: bytes, ordinary: bytes, frame: bytes):
        import zstandard

        super().__init__()
        self.frame = frame
        self.packers = []
        for content in (ordinary, toxic):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.packers.append(
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=held,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )

    def __missing__(self, window: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        framed = self.frame + b" " + window + b" " + self.frame
        plain, toxic = (len(packer.compress(framed)) for packer in self.packers)
        saved = min(max(plain - toxic, -1), DIFFERENCES - 2) + 1
        found = self[window] = saved + DIFFERENCES * min(len(window), LENGTHS - 1)
        return found

    def histogram(self, text: str):
        """How many windows of a text save how many bytes, by length."""
        import numpy as np

        found = list(map(self.__getitem__, windows(text)))
        return np.bincount(np.array(found, "int64"), minlength=DIFFERENCES * LENGTHS)


def _features(counts, evidence):
    """What the windows of a text say together: sums, the strongest, and their share."""
    import numpy as np

    total = counts.sum()
    strong = counts * evidence * (evidence > 0.7)
    sure = (counts * (evidence > 1.5)).sum()
    most = (evidence * (counts > 0)).max()
    raw = np.array(
        [
            strong.sum(),
            most,
            math.log(total + 1),
            sure,
            strong.sum() / math.sqrt(total + 1),
            100 * sure / max(total, 1),
        ]
    )
    return np.append(np.log1p(raw), most**2)


def _logistic(rows, marks, ridge: float = 1.0):
    """Weights of a regularised logistic regression, with mean and scale of the columns."""
    import numpy as np

    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.c_[(rows - mean) / scale, np.ones(len(rows))]
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - marks) + ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights = weights - np.linalg.solve(curve, slope)
    return mean, scale, weights


def labelled_sample(
    docs: DataFrame, labels: DataFrame, usable: Column, doc: str = "doc_id", text: str = "text"
) -> list[tuple[str, int]]:
    """Texts with their label, about as many of each label as the sample sizes say.

    ``labels`` has ``doc_id`` and ``toxic``; an id with both labels counts as
    toxic. Ids are drawn at random first, so only their documents are read out;
    documents longer than ``LONGEST`` characters are not drawn, which bounds what
    reaches the driver together with the number of rows.
    """
    named = (
        labels.where(usable & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    named = settle(named, "labels")
    sizes = {row["toxic"]: row["count"] for row in named.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, TOXIC_SAMPLE / sizes.get(1, 1)).otherwise(
        ORDINARY_SAMPLE / sizes.get(0, 1)
    )
    drawn = settle(
        named.where(F.rand(SEED) < share).limit(2 * (TOXIC_SAMPLE + ORDINARY_SAMPLE)), "drawn"
    )
    texts = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")).where(
        F.col("text").isNotNull() & (F.char_length("text") <= LONGEST)
    )
    rows = texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic")
    found = rows.limit(2 * (TOXIC_SAMPLE + ORDINARY_SAMPLE)).collect()
    found.sort(key=lambda row: (row["doc_id"], row["text"]))
    return [(row["text"], row["toxic"]) for row in found]


def fit(sample: list[tuple[str, int]]) -> dict:
    """Dictionaries from six tenths of the sample, the calibration from the rest.

    From the second part comes what a window that saves so many bytes says, by
    its length (log odds), and a logistic regression of the label on the sums
    over a document. Without both labels in both parts the model is empty.
    """
    import numpy as np

    first = [row for k, row in enumerate(sample) if k % 5 < 3]
    second = [row for k, row in enumerate(sample) if k % 5 >= 3]
    marks = np.array([toxic for _, toxic in second])
    if {t for _, t in first} != {0, 1} or set(marks.tolist()) != {0, 1}:
        return {}
    contents = train_dictionaries(
        [text for text, toxic in first if toxic], [text for text, toxic in first if not toxic]
    )
    distance = Distance(*contents)
    counts = np.array([distance.histogram(text) for text, _ in second])
    bounded = np.minimum(counts, 3)
    toxic, ordinary = bounded[marks == 1].sum(axis=0), bounded[marks == 0].sum(axis=0)
    evidence = np.log((toxic + 0.5) / (marks.sum() + 1)) - np.log(
        (ordinary + 0.5) / ((1 - marks).sum() + 1)
    )
    evidence = np.where(toxic + ordinary < 5, 0, np.maximum(evidence, 0))
    rows = np.array([_features(one, evidence) for one in counts])
    return {"contents": contents, "evidence": evidence, "weights": _logistic(rows, marks)}


_DISTANCES: dict = {}


def score(docs: DataFrame, model: dict, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with the chance that it is toxic, by its whole text.

    Each window's compressed length under the toxic dictionary is compared with
    that under the ordinary one; what the windows say is added up per document
    and calibrated to 0..1. Null texts are scored like empty ones. Under an empty
    model every score is 0. Ids may be null or repeated; an empty table gives an
    empty result. Only the two named columns are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        model = shared.value
        if model and model["contents"] not in _DISTANCES:
            _DISTANCES.clear()
            _DISTANCES[model["contents"]] = Distance(*model["contents"])
        for batch in batches:
            scores = []
            for texts in grouped(value.as_py() for value in batch.column(1)):
                if not model:
                    scores += [0.0] * len(texts)
                    continue
                distance = _DISTANCES[model["contents"]]
                mean, scale, weights = model["weights"]
                rows = np.array(
                    [_features(distance.histogram(one), model["evidence"]) for one in texts]
                )
                x = np.c_[(rows - mean) / scale, np.ones(len(rows))]
                scores += (1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(judge, "doc_id long, score double")
