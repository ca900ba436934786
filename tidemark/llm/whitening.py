"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.embeddings import matrix, whole_numbers
from tidemark.plans.storage import settle

#: Added to every whole number, as the contract of the table asks.
SHIFT = 100_000
COMPONENTS = 8
SEED = 5
#: Share of the largest singular value below which a length counts as zero.
ZERO = 1e-13
#: The steps end early once the wanted components are this exact.
EXACT = 1e-15


def _summed(rows: DataFrame, work: Callable, kind: str):
    """The sum of ``work`` (matrix -> vector) over all rows, or None without rows.

    A task sends one vector, however many rows it holds; one further task adds
    these up, so the driver gets a single vector.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for one in batch.column(0):
                part = one.values.to_numpy()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total]})

    schema = f"sums array<{kind}>"
    found = rows.select("x").mapInArrow(partial, schema).repartition(1).mapInArrow(add, schema)
    whole = found.toArrow()
    return whole.column(0)[0].values.to_numpy().copy() if whole.num_rows else None


class Centre:
    """Number of rows and exact sums per dimension, to centre rows without cancellation."""

    def __init__(self, n: int, sums):
        self.n, self.sums = n, sums

    def scaled(self, batch: pa.RecordBatch):
        """``n * x - S`` for every row, exact."""
        return matrix(batch.column("x"), len(self.sums)) * self.n - self.sums

    def rows(self, batch: pa.RecordBatch):
        """``x - S / n`` for every row."""
        return self.scaled(batch) / self.n


def centre_of(rows: DataFrame) -> Centre | None:
    """The centre of all rows; None without rows."""
    import numpy as np

    def work(batch):
        x = matrix(batch.column("x"), len(batch.column("x")[0]))
        return np.append(x.sum(axis=0), len(x))

    found = _summed(rows, work, "long")
    return None if found is None else Centre(int(found[-1]), found[:-1])


def _fresh(rng, right):
    """A random unit vector at right angles to the columns of ``right``."""
    import numpy as np

    v = rng.standard_normal(len(right))
    for _ in range(3):
        v -= right @ (right.T @ v)
        v /= np.linalg.norm(v)
    return v


def bidiagonalise(rows: DataFrame, centre: Centre, wanted: int) -> tuple:
    """(B, V): the centred rows X satisfy ``X V = U B``, B upper bidiagonal.

    A step makes two passes over the rows. The first takes ``X v`` and its parts
    along all earlier left vectors, the second takes ``X^T u`` of what is left and
    measures those parts once more, so both sides are fully reorthogonalised
    twice. A left vector is as long as the table and never stored: it is ``X w``,
    and only ``w`` is kept, so a lost executor computes it again from its rows.

    When a length vanishes, the steps go on with a fresh direction; thus repeated
    and vanishing deviations are found too. There are as many steps as dimensions,
    or fewer if the ``wanted`` components are exact to rounding before that.
    """
    import numpy as np

    d = len(centre.sums)
    rng = np.random.default_rng(SEED)
    shared = rows.sparkSession.sparkContext.broadcast(centre)
    left, back, right = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    alphas, betas, largest = [], [], 0.0
    v = _fresh(rng, right)
    while True:

        def along(batch, v=v, left=left):
            x = shared.value.rows(batch)
            return (x @ v) @ (x @ left)

        right = np.column_stack([right, v])
        parts = _summed(rows, along, "double") if left.shape[1] else np.zeros(0)
        w = v - left @ parts

        def opposite(batch, w=w, left=left):
            x = shared.value.rows(batch)
            u = x @ w
            return np.concatenate([x.T @ u, u @ (x @ left), [u @ u]])

        found = _summed(rows, opposite, "double")
        z, parts, square = found[:d], found[d:-1], found[-1]
        w, z = w - left @ parts, z - back @ parts
        alpha = float(np.sqrt(max(square - parts @ parts, 0.0)))
        largest = max(largest, alpha)
        if alpha <= ZERO * largest:
            alpha, w, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, z = w / alpha, z / alpha
        left, back = np.column_stack([left, w]), np.column_stack([back, z])
        alphas.append(alpha)
        if len(alphas) == d:
            break
        for _ in range(2):
            z = z - right @ (right.T @ z)
        beta = float(np.linalg.norm(z))
        largest = max(largest, beta)
        if beta <= ZERO * largest:
            beta, v = 0.0, _fresh(rng, right)
        else:
            v = z / beta
            v -= right @ (right.T @ v)
            v /= np.linalg.norm(v)
        if beta and len(alphas) >= wanted:
            ends, values, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if (beta * np.abs(ends[-1, :wanted]) <= EXACT * values[0]).all():
                break
        betas.append(beta)
    shared.unpersist()
    return np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1), right


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict | None:
    """Centre, components, their deviations and shares; None without rows."""
    import numpy as np

    centre = centre_of(rows)
    if centre is None:
        return None
    bidiagonal, right = bidiagonalise(rows, centre, components)
    _, values, turned = np.linalg.svd(bidiagonal)
    axes = (right @ turned.T).T
    there = values > values[0] * max(centre.n, len(axes)) * np.finfo("float64").eps
    kept = int(min(components, there.sum()))
    axes = axes[:kept] / np.linalg.norm(axes[:kept], axis=1, keepdims=True)
    energy = values[:kept] ** 2 / centre.n

    def spread(batch):
        x = centre.rows(batch)
        y = x @ (axes / np.sqrt(energy)[:, None]).T
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0), [(x * x).sum()]])

    found = _summed(rows, spread, "double")
    mean = found[kept * kept : -1] / centre.n
    covariance = found[: kept * kept].reshape(kept, kept) / centre.n - np.outer(mean, mean)
    trace = float(found[-1]) / centre.n
    return {
        "centre": centre,
        "axes": axes,
        "energy": energy,
        "explained": (energy / trace).tolist() if kept else [],
        "identity_error": float(np.abs(covariance - np.eye(kept)).max()) if kept else 0.0,
    }


def transform(rows: DataFrame, model: dict) -> DataFrame:
    """(id, deviation, whitened): every row with its exact squared deviation from the
    centre, times n squared, and its coordinates on the components."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        centre = shared.value["centre"]
        axes = shared.value["axes"] / np.sqrt(shared.value["energy"])[:, None]
        for batch in batches:
            scaled = centre.scaled(batch)
            most = int(np.abs(scaled).max(initial=0))
            wide = scaled if most * most * scaled.shape[1] < 2**63 else scaled.astype(object)
            squares = (wide * wide).sum(axis=1).tolist()
            whitened = (scaled / centre.n) @ axes.T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(map(Decimal, squares), pa.decimal128(38, 0)),
                    pa.array(list(whitened), pa.list_(pa.float64())),
                ],
                names=["id", "deviation", "whitened"],
            )

    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, deviation decimal(38,0), whitened array<double>"
    return rows.mapInArrow(judge, schema)


def whiten(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Every usable vector on every component, the strongest ``components`` at most.

    Columns: the id, ``component`` from 1, ``n``, ``deviation`` (exact, decimal),
    ``whitened``, ``explained`` and ``identity_error``. Rows whose vector is null or
    empty, holds a null or non-finite entry, or is not of the most frequent length
    are left out. Ids may be null or repeated; equal vectors get equal figures.
    There are as many components as the vectors have independent directions:
    none, and so no rows, for an empty table, a single vector or equal ones. Only
    the two named columns are read. Entries times 1024 times n must fit 64 bits.
    """
    rows = settle(whole_numbers(df, {"id": id_column}, vector, SHIFT), "vectors")
    model = fit(rows, components)
    kind = dict(rows.dtypes)["id"]
    if model is None or not len(model["axes"]):
        empty = (
            f"`{id_column}` {kind}, component int, n long, deviation decimal(38,0), "
            "whitened double, explained double, identity_error double"
        )
        return df.sparkSession.createDataFrame([], empty)
    explained = F.array(*[F.lit(share) for share in model["explained"]])
    return (
        transform(rows, model)
        .select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            F.col("id").alias(id_column),
            (F.col("at") + 1).alias("component"),
            F.lit(model["centre"].n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, "at").alias("explained"),
            F.lit(model["identity_error"]).alias("identity_error"),
        )
    )
