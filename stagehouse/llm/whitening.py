"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed.  Every product of it with a block of vectors is one Spark job over
packed blocks of rows: each task centres its rows, multiplies them twice and gives one small sum.
The driver holds the search space, (dimensions x some times the components) numbers, whatever the
number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import map_batches, written

#: Rows of a packed block; bounds what a task holds at once.
BLOCK_ROWS = 1024
#: Entries whose scaled value has no exact double are out of the range of this operator.
LARGEST = float(1 << 53)
OFFSET = 1_000_000


@dataclass(frozen=True)
class Fit:
    """Statistics of the fit list and the components found.

    ``shift`` are whole numbers near the means, ``mean`` is what is left of them: x - shift is a small
    exact integer, so centring loses nothing.  ``values`` fall; ``vectors`` has a column for each."""

    n: int
    sums: tuple[int, ...]
    shift: np.ndarray
    mean: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray


def scaled_vectors(vectors: DataFrame, column: str, id_column: str, scale: int, offset: int):
    """(id, x) of the rows that take part: the vector is not null and holds no null, no NaN and no
    infinity.  x = floor(scale * entry) + offset as long.  Rows of another length than the most common
    one (of several, the longest) take no part either, nor do rows with an entry whose scaled value
    is 2^53 or more, which no double tells from its neighbours."""
    entry = F.transform(F.col(column), lambda x: x.cast("double"))
    whole = F.transform(F.col("v"), lambda x: F.floor(x * scale))
    fine = F.forall(
        "v", lambda x: F.coalesce((F.abs(x * scale) < LARGEST) & ~F.isnan(x), F.lit(False))
    )
    kept = (
        vectors.select(F.col(id_column).alias("id"), entry.alias("v"))
        .where("v IS NOT NULL")
        .where(fine)
        .select("id", F.transform(whole, lambda x: x + F.lit(offset)).alias("x"))
    )
    lengths = kept.groupBy(F.size("x").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    dimensions = common.d if common else 0
    return kept.where(F.size("x") == dimensions), dimensions


def pack_blocks(rows: DataFrame, dimensions: int) -> DataFrame:
    """(first, ids, x): blocks of up to ``BLOCK_ROWS`` rows as binary matrices, written once, so that
    each product reads numbers and parses no lists.  No shuffle; 4 bytes an entry where they fit."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            x = batch.column(1)
            flat = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), dimensions)
            for at in range(0, len(x), BLOCK_ROWS):
                part = flat[at : at + BLOCK_ROWS]
                small = len(part) and np.abs(part).max() < 1 << 31
                numbers = part.astype("<i4" if small else "<i8").tobytes()
                held = pa.array([ids.slice(at, BLOCK_ROWS).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [held, pa.array([numbers], pa.binary())], ["ids", "x"]
                )

    return written(map_batches(rows, pack, "ids array<long>, x binary"), "vector_blocks")


def _matrices(batches: Iterator[pa.RecordBatch], dimensions: int):
    for batch in batches:
        for ids, raw in zip(batch.column("ids"), batch.column("x"), strict=True):
            numbers = raw.as_py()
            count = len(ids)
            kind = "<i4" if len(numbers) == 4 * count * dimensions else "<i8"
            yield ids, np.frombuffer(numbers, kind).astype(np.int64).reshape(count, dimensions)


def _exact_sums(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers where 64 bits might not do."""
    most = int(np.abs(x).max(initial=0))
    if most * max(len(x), 1) < 1 << 62:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def moments(blocks: DataFrame, dimensions: int) -> tuple[int, list[int], list[int]]:
    """Row count, and per dimension the exact sums of x and of (x - OFFSET)^2."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(dimensions, object), np.zeros(dimensions, object)
        for _, x in _matrices(batches, dimensions):
            y = x - OFFSET
            n += len(x)
            sums += _exact_sums(x)
            small = int(np.abs(y).max(initial=0)) < 1 << 31
            squares += _exact_sums(y * y) if small else (y.astype(object) ** 2).sum(axis=0)
        if n:
            # two halves of each number, so that sums over tasks stay exact in decimals
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array(range(-1, dimensions), pa.int32()),
                    "s": [str(n), *map(str, sums)],
                    "low": ["0", *[str(q % 10**18) for q in squares]],
                    "high": ["0", *[str(q // 10**18) for q in squares]],
                }
            )

    parts = map_batches(blocks, add, "dim int, s string, low string, high string")
    number = "decimal(38,0)"
    total = parts.groupBy("dim").agg(
        *[F.sum(F.col(c).cast(number)).alias(c) for c in ("s", "low", "high")]
    )
    found = {r.dim: r for r in total.collect()}  # one row a dimension
    if not found:
        return 0, [0] * dimensions, [0] * dimensions
    return (
        int(found[-1].s),
        [int(found[d].s) for d in range(dimensions)],
        [int(found[d].high) * 10**18 + int(found[d].low) for d in range(dimensions)],
    )


def block_product(blocks: DataFrame, fit_shift: np.ndarray, mean: np.ndarray, n: int):
    """U -> V U with V = (1/n) sum (x - m)(x - m)^T, one job a call."""
    dimensions = len(fit_shift)

    def product(u: np.ndarray) -> np.ndarray:
        columns = u.shape[1]
        model = blocks.sparkSession.sparkContext.broadcast(u)

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = model.value
            total = np.zeros((dimensions, columns))
            some = False
            for _, x in _matrices(batches, dimensions):
                centred = (x - fit_shift).astype(np.float64) - mean
                total += centred.T @ (centred @ block)
                some = True
            if some:
                yield pa.RecordBatch.from_pydict(
                    {"at": pa.array(range(total.size), pa.int32()), "v": total.ravel()}
                )

        parts = map_batches(blocks, multiply, "at int, v double")
        sums = parts.groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(total_size := dimensions * columns)
        out[sums["at"].to_numpy()] = sums["v"].to_numpy()
        model.unpersist()
        assert total_size == out.size
        return out.reshape(dimensions, columns) / n

    return product


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the given orthonormal columns."""
    for _ in range(2):  # the second pass takes away what rounding left
        for q in against:
            new = new - q @ (q.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 0] / size[size > 0]
    q, r = np.linalg.qr(new)
    q = q[:, np.abs(np.diag(r)) > 1e-10]
    for a in against:
        q = q - a @ (a.T @ q)
    return np.linalg.qr(q)[0] if q.shape[1] else q


def block_minres(operate, right: np.ndarray, steps: int, drop: float = 1e-3) -> np.ndarray:
    """Least-residual solutions of (operator_j) x_j = right_j for all columns j at once, each with a
    recurrence of its own; a step costs one product for the whole block.  Columns end at ``drop`` of
    their first residual or when their Krylov space is used up."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    first = beta.copy()
    active = beta > 0
    v_old = np.zeros_like(right)
    v = np.divide(right, beta, out=np.zeros_like(right), where=active)
    eta = beta.copy()
    c, c_old = np.ones_like(beta), np.ones_like(beta)
    s, s_old = np.zeros_like(beta), np.zeros_like(beta)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        if not active.any():
            break
        p = operate(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # two old rotations on the new column of the tridiagonal matrix, then one of its own
        delta = c * alpha - c_old * s * beta
        rho2 = s * alpha + c_old * c * beta
        rho3 = s_old * beta
        rho1 = np.hypot(delta, beta_new)
        active &= rho1 > 0
        safe = np.where(active, rho1, 1.0)
        c_new, s_new = delta / safe, beta_new / safe
        w_new = np.where(active, (v - rho3 * w_old - rho2 * w) / safe, 0.0)
        x += np.where(active, c_new * eta * w_new, 0.0)
        eta = np.where(active, -s_new * eta, eta)
        active &= (beta_new > 1e-14 * first) & (np.abs(eta) > drop * first)
        v_old, beta = v, beta_new
        v = np.divide(p, beta_new, out=np.zeros_like(p), where=active)
        w_old, w, c_old, c, s_old, s = w, w_new, c, c_new, s, s_new
    return x


def jacobi_davidson(
    product, dimensions: int, wanted: int, inner_steps: int = 6, seed: int = 1, most_rounds: int = 200
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator, falling, with unit vectors and
    residual norms.  ``product`` maps a block of columns.

    Each round takes the Ritz pairs of the search space, locks the leading ones whose residual is at
    rounding level (dimensions x machine epsilon x largest Ritz value), and widens the space by the
    solutions of the correction equations (I - QQ')(A - t)(I - QQ') z = -r of the next pairs, all
    solved side by side by a few MINRES steps; Q holds the locked vectors and the pairs' own.  A space
    of four blocks is cut back to its two blocks of best Ritz vectors.  ``RuntimeError`` if
    ``most_rounds`` do not suffice."""
    wanted = min(wanted, dimensions)
    if not wanted:
        return np.zeros(0), np.zeros((dimensions, 0)), np.zeros(0)
    block = min(wanted + 4, dimensions)
    random = np.random.default_rng(seed)
    space = _orthonormal(random.standard_normal((dimensions, block)))
    image = product(space)
    locked = np.zeros((dimensions, 0))
    values, residuals, largest = [], [], 0.0
    for _ in range(most_rounds):
        if space.shape[1]:
            theta, u = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        else:
            theta, u = np.zeros(0), np.zeros((0, 0))
        theta, u = theta[::-1], u[:, ::-1]
        space, image = space @ u, image @ u
        largest = max(largest, float(theta[0]) if len(theta) else 0.0)
        left = image - space * theta
        left -= locked @ (locked.T @ left)
        norms = np.linalg.norm(left, axis=0)
        level = max(dimensions, 64) * np.finfo(float).eps * largest
        whole = space.shape[1] + locked.shape[1] >= dimensions
        done = 0
        while done < len(theta) and len(values) + done < wanted and (
            whole or norms[done] <= level
        ):
            done += 1
        if done:
            locked = np.hstack([locked, space[:, :done]])
            values += list(theta[:done])
            residuals += list(norms[:done])
            space, image, theta = space[:, done:], image[:, done:], theta[done:]
            left = left[:, done:]
        if len(values) >= wanted:
            order = np.argsort(values, kind="stable")[::-1]
            locked = np.linalg.qr(locked[:, order])[0]
            return np.array(values)[order], locked, np.array(residuals)[order]
        if space.shape[1] > 3 * block:
            space, image = space[:, : 2 * block], image[:, : 2 * block]
            theta, left = theta[: 2 * block], left[:, : 2 * block]
        pairs = min(wanted - len(values), space.shape[1])
        t, own = theta[:pairs], space[:, :pairs]
        fixed = np.hstack([locked, own])

        def corrected(z, t=t, fixed=fixed):
            z = z - fixed @ (fixed.T @ z)
            y = product(z) - z * t
            return y - fixed @ (fixed.T @ y)

        right = -(left[:, :pairs] - fixed @ (fixed.T @ left[:, :pairs]))
        step = block_minres(corrected, right, inner_steps)
        new = _orthonormal(step, locked, space)
        room = dimensions - locked.shape[1] - space.shape[1]
        if not new.shape[1] and room:  # corrections at rounding level: a fresh direction instead
            new = _orthonormal(random.standard_normal((dimensions, min(block, room))), locked, space)
        new = new[:, :room]
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    raise RuntimeError(f"{len(values)} of {wanted} components after {most_rounds} rounds")


def fit(blocks: DataFrame, dimensions: int, components: int) -> Fit:
    """Statistics and components of the packed rows.  Components whose eigenvalue is at rounding level
    (constant dimensions, more dimensions than rows) cannot be scaled to 1 and are left out."""
    n, sums, squares = moments(blocks, dimensions)
    if not n:
        none = np.zeros(0)
        return Fit(0, (), none, none, 0.0, none, np.zeros((dimensions, 0)), none)
    shift = np.array([s // n for s in sums], np.int64)
    mean = np.array([(s - n * (s // n)) / n for s in sums])
    # trace(V) = sum of (n * sum y^2 - (sum y)^2) / n^2 in exact integers
    spread = sum(n * q - (s - n * OFFSET) ** 2 for s, q in zip(sums, squares, strict=True))
    trace = spread / (n * n)
    values, vectors, residuals = np.zeros(0), np.zeros((dimensions, 0)), np.zeros(0)
    if spread:
        product = block_product(blocks, shift, mean, n)
        values, vectors, residuals = jacobi_davidson(product, dimensions, components)
        real = values > 1e-12 * trace
        values, vectors, residuals = values[real], vectors[:, real], residuals[real]
    return Fit(n, tuple(sums), shift, mean, trace, values, vectors, residuals)


def _whitened(x: np.ndarray, model: Fit) -> np.ndarray:
    return ((x - model.shift).astype(np.float64) - model.mean) @ model.vectors / np.sqrt(model.values)


def identity_error(blocks: DataFrame, model: Fit) -> float:
    """Largest absolute entry of (covariance of the whitened rows - identity); one job."""
    k, dimensions = len(model.values), len(model.shift)
    if not k:
        return 0.0
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((k + 1, k)), False
        for _, x in _matrices(batches, dimensions):
            w = _whitened(x, shared.value)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
            some = True
        if some:
            yield pa.RecordBatch.from_pydict(
                {"at": pa.array(range(total.size), pa.int32()), "v": total.ravel()}
            )

    parts = map_batches(blocks, add, "at int, v double")
    sums = parts.groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((k + 1) * k)
    out[sums["at"].to_numpy()] = sums["v"].to_numpy()
    out = out.reshape(k + 1, k) / model.n
    covariance = out[:k] - np.outer(out[k], out[k])
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, model: Fit) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exact."""
    rest = np.array([s - model.n * int(h) for s, h in zip(model.sums, model.shift)], object)
    y = x - model.shift
    most = model.n * int(np.abs(y).max(initial=0)) + model.n
    if most * most * max(x.shape[1], 1) < 1 << 62:
        far = y * model.n - rest.astype(np.int64)
        return (far * far).sum(axis=1).tolist()
    far = y.astype(object) * model.n - rest
    return (far * far).sum(axis=1).tolist()


def whiten(
    vectors: DataFrame,
    components: int = 32,
    column: str = "embedding",
    id_column: str = "vec_id",
    scale: int = 64,
    offset: int = OFFSET,
) -> DataFrame:
    """Every row that takes part (see ``scaled_vectors``), projected on the leading ``components``
    eigenvectors of the covariance of all such rows and scaled to variance 1.

    One row per vector and component: the id, ``component`` from 1, ``n`` rows of the fit,
    ``deviation`` = sum over dimensions of (n * x - S)^2 as an exact long (null where 64 bits do not
    hold it), the same in ``deviation_digits`` as text, ``whitened``, ``explained`` = eigenvalue /
    trace, ``identity_error``, and ``residual`` of the eigenpair.

    Repeated rows count as often as they occur; ids may repeat or be null.  Equal eigenvalues share
    their space in any basis.  Fewer components come out where the rows span fewer dimensions; no rows,
    one row or equal rows give none.  Other columns, whatever their names, are not looked at."""
    rows, dimensions = scaled_vectors(vectors, column, id_column, scale, offset)
    schema = (
        f"{id_column} long, component int, n long, deviation long, deviation_digits string, "
        "whitened double, explained double, identity_error double, residual double"
    )
    blocks = pack_blocks(rows, dimensions)
    model = fit(blocks, dimensions, components)
    error = identity_error(blocks, model)
    k = len(model.values)
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for ids, x in _matrices(batches, dimensions) if k else ():
            count = len(x)
            far = _deviations(x, model)
            ids = pa.array(ids.as_py(), pa.int64())
            each = pa.array(np.repeat(np.arange(count), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, model.n)),
                    pa.array([f if f < 1 << 63 else None for f in far], pa.int64()).take(each),
                    pa.array([str(f) for f in far]).take(each),
                    pa.array(_whitened(x, model).ravel()),
                    pa.array(np.tile(model.values / model.trace, count)),
                    pa.array(np.full(count * k, error)),
                    pa.array(np.tile(model.residuals, count)),
                ],
                names=[
                    id_column, "component", "n", "deviation", "deviation_digits", "whitened",
                    "explained", "identity_error", "residual",
                ],
            )

    return map_batches(blocks, project, schema)
