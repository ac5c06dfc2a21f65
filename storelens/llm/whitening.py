"""Whitening of integer vectors with eigenvectors found by a block Jacobi-Davidson iteration over distributed products."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import stored

COMPONENTS = 16
# Directions the search starts with beyond the wanted ones, and the most it holds for each wanted one before it restarts.
SPARE = 4
MOST_DIRECTIONS = 6
# Products with the covariance an inner solution may take, and rounds of the outer iteration before it gives up.
INNER_STEPS = 8
MOST_ROUNDS = 200
# A residual of so many units of rounding of the largest eigenvalue is zero in double precision.
ROUNDING_UNITS = 32
# Entries beyond stop here, so scaling and shifting them never overflows.
MOST_ENTRY = float(1 << 52)

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Fit:
    """What whitening needs: number and sums of the distinct vectors, eigenvalues by size, eigenvectors as columns, trace, error."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def scaled(vector: Column, scale: float = 64.0, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift for each component c, as double; NULL for a vector that is NULL or holds NULL or non-finite entries.

    Products beyond 2^52 stop there.
    """
    def whole(c: Column) -> Column:
        wide = F.greatest(F.lit(-MOST_ENTRY), F.least(F.lit(MOST_ENTRY), c.cast("double") * scale))
        return F.floor(wide).cast("long") + F.lit(shift)

    def usable(c: Column) -> Column:
        return F.coalesce((F.abs(c.cast("double")) < float("inf")) & ~F.isnan(c.cast("double")), F.lit(False))

    return F.when(F.forall(vector, usable), F.transform(vector, whole))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x_").flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1)


def _packed(rows: DataFrame) -> DataFrame:
    """The vectors as blocks of bytes, 32 bits an entry where that holds them, so that a pass over them decodes no arrays."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch)
                narrow = bool(np.abs(x).max() < 2**31)
                data = x.astype("<i4" if narrow else "<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([narrow]), pa.array([data], pa.binary())], names=["narrow", "data"])

    return rows.mapInArrow(pack, "narrow boolean, data binary")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for narrow, data in zip(batch.column("narrow").to_pylist(), batch.column("data")):
            yield np.frombuffer(data.as_buffer(), "<i4" if narrow else "<i8").astype(np.int64).reshape(-1, width)


def _off_mean(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exactly; as Python integers only where long is too narrow."""
    largest = max(int(np.abs(x).max(initial=0)), 1)
    if n * largest < 2**61 and max(map(abs, sums), default=0) < 2**61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - sums / n, rounded once."""
    return _off_mean(x, n, sums).astype("f8") / n


def squared_deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Sum over dimensions of (n * x - sums)^2, exactly; beyond the range of long it stops at its end."""
    off = _off_mean(x, n, sums)
    largest = max((abs(int(v)) for v in (off.min(initial=0), off.max(initial=0))), default=0)
    if off.dtype != object and largest**2 * max(x.shape[1], 1) < 2**63:
        return (off * off).sum(1)
    exact = (off.astype(object) ** 2).sum(1)
    return np.array([min(int(v), 2**63 - 1) for v in exact], np.int64)


def _summed(fit: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of a flat result of ``of``, which takes a block of rows; tasks add with compensation, Spark adds the tasks.

    What reaches the driver has the length of the result, whatever the number of rows or tasks.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = lost = None
        for x in _blocks(batches, width):
            part = of(x)
            if total is None:
                total, lost = np.zeros_like(part), np.zeros_like(part)
            grown = total + part
            lost += np.where(np.abs(total) >= np.abs(part), (total - grown) + part, (part - grown) + total)
            total = grown
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total + lost)], names=["place", "value"])

    parts = fit.mapInArrow(partial, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    rows = parts.toArrow()
    out = np.zeros(rows.num_rows)
    out[rows.column("place").to_numpy()] = rows.column("value").to_numpy()
    return out


def _count_and_sums(fit: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """Number of rows and exact sums of each dimension."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, object)
        for x in _blocks(batches, width):
            narrow = int(np.abs(x).max()) * len(x) < 2**62
            total[:width] += (x if narrow else x.astype(object)).sum(0).astype(object)
            total[width] += len(x)
        sums = pa.array([str(v) for v in total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1, dtype=np.int32)), sums], names=["place", "value"])

    parts = fit.mapInArrow(partial, "place int, value string").groupBy("place").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {row["place"]: int(row["value"]) for row in parts.collect()}
    return found.get(width, 0), tuple(found.get(place, 0) for place in range(width))


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` at right angles to ``against``; what is left of rounding alone goes."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        block = block - against @ (against.T @ block)
        left, sizes, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, sizes > 1e-10]
    return block - against @ (against.T @ block)


def minres(product: Product, shifts: np.ndarray, inside: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """For each column the vector of its Krylov space with the least residual of P (A - shift) P t = right, P = 1 - inside inside'.

    The Lanczos vectors of the few steps are kept and made orthogonal again; one product serves all columns.
    """
    def project(block: np.ndarray) -> np.ndarray:
        return block - inside @ (inside.T @ block)

    right = project(right)
    size, columns = right.shape
    start = np.linalg.norm(right, axis=0)
    basis = [np.divide(right, start, out=np.zeros_like(right), where=start > 0)]
    diagonal, beside = [], []
    for step in range(steps):
        last = basis[-1]
        image = project(product(last) - last * shifts)
        diagonal.append((last * image).sum(0))
        for _ in range(2):
            for old in basis:
                image = image - old * (old * image).sum(0)
        sizes = np.linalg.norm(image, axis=0)
        sizes[sizes <= 1e-13 * np.abs(shifts)] = 0.0
        beside.append(sizes)
        basis.append(np.divide(image, sizes, out=np.zeros_like(image), where=sizes > 0))
        if not sizes.any():
            break
    steps = len(diagonal)
    found = np.zeros((size, columns))
    for column in range(columns):
        band = np.zeros((steps + 1, steps))
        for step in range(steps):
            band[step, step] = diagonal[step][column]
            band[step + 1, step] = beside[step][column]
            if step:
                band[step - 1, step] = beside[step - 1][column]
        goal = np.zeros(steps + 1)
        goal[0] = start[column]
        weights = np.linalg.lstsq(band, goal, rcond=1e-13)[0]
        found[:, column] = sum(basis[step][:, column] * weights[step] for step in range(steps))
    return project(found)


def jacobi_davidson(product: Product, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors.

    ``product`` multiplies the matrix with a block of columns; nothing else is known of it. Each round solves the
    projected correction equations of all pairs still open by MINRES, widens the search space by the corrections and
    takes Ritz pairs from it. A pair whose residual is down to rounding is locked when all larger ones are: it stays
    and is projected out of everything that follows.
    """
    wanted = min(wanted, size)
    most = min(size, max(MOST_DIRECTIONS * wanted, wanted + SPARE))
    draw = np.random.default_rng(13)
    locked, locked_values = np.zeros((size, 0)), []
    space = orthonormal(draw.standard_normal((size, min(size, wanted + SPARE))), locked)
    images = product(space)
    largest, best, idle = 0.0, np.inf, 0
    for _ in range(MOST_ROUNDS):
        small = space.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        open_ = wanted - len(locked_values)
        ritz, ritz_images = space @ turns, images @ turns
        residuals = ritz_images - ritz * values
        residuals -= locked @ (locked.T @ residuals)
        errors = np.linalg.norm(residuals, axis=0)
        largest = max(largest, float(np.abs(values).max(initial=0.0)), *locked_values, 0.0)
        limit = ROUNDING_UNITS * np.finfo(float).eps * largest
        # Products are rounded themselves: errors that no longer fall, far below any gap, are as small as they get.
        worst = float(errors[:open_].max(initial=0.0))
        idle = idle + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if idle >= 3 and best <= 1e-11 * largest:
            limit = max(limit, 2 * worst)
        done = 0
        while done < open_ and done < len(values) and errors[done] <= limit:
            done += 1
        if done:
            locked = np.column_stack([locked, ritz[:, :done]])
            locked_values += [float(v) for v in values[:done]]
            best, idle = np.inf, 0
        ritz, ritz_images, residuals, values = (a[..., done:] for a in (ritz, ritz_images, residuals, values))
        open_ -= done
        if not open_:
            break
        space, images = ritz, ritz_images
        if space.shape[1] + open_ > most - len(locked_values):
            keep = min(space.shape[1], max(open_ + SPARE, most - len(locked_values) - open_))
            space, images = space[:, :keep], images[:, :keep]
        near = np.column_stack([locked, ritz[:, :open_]])
        corrections = minres(product, values[:open_], near, -residuals[:, :open_], INNER_STEPS)
        fresh = orthonormal(corrections, np.column_stack([locked, space]))
        if not fresh.shape[1]:  # the space holds all that the equations give: look elsewhere
            fresh = orthonormal(draw.standard_normal((size, open_)), np.column_stack([locked, space]))
        if fresh.shape[1]:
            space, images = np.column_stack([space, fresh]), np.column_stack([images, product(fresh)])
        else:  # it is the whole space: only rounding is left, which a fresh product and another turn take away
            images = product(space)
    else:
        raise ArithmeticError("eigenvectors did not reach double precision")
    order = np.argsort(-np.array(locked_values), kind="stable")
    vectors = np.linalg.qr(locked[:, order])[0] if len(order) else locked
    vectors *= np.where((vectors * locked[:, order]).sum(0) < 0, -1.0, 1.0)
    return np.array(locked_values)[order], vectors


def fit_whitening(rows: DataFrame, width: int, components: int = COMPONENTS) -> Fit:
    """Fits to the distinct vectors ``x_`` of ``rows``, all of ``width`` entries.

    Components whose variance is nothing but rounding are left out.
    """
    fit = stored(_packed(rows.select("x_").distinct()))
    n, sums = _count_and_sums(fit, width)
    if not n:
        return Fit(0, sums, np.zeros(0), np.zeros((width, 0)), 0.0, 0.0)

    def product(block: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return (c.T @ (c @ block)).ravel()

        return _summed(fit, width, of).reshape(block.shape) / n

    trace = float(_summed(fit, width, lambda x: np.array([np.square(centred(x, n, sums)).sum()]))[0]) / n
    values, vectors = jacobi_davidson(product, width, components) if trace > 0 else (np.zeros(0), np.zeros((width, 0)))
    real = values > max(width, 64) * np.finfo(float).eps * values.max(initial=0.0)
    values, vectors = values[real], vectors[:, real]
    count = len(values)
    if not count:
        return Fit(n, sums, values, vectors, trace, 0.0)
    turn = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ turn
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    found = _summed(fit, width, moments) / n
    mean, squares = found[:count], found[count:].reshape(count, count)
    error = float(np.abs(squares - np.outer(mean, mean) - np.eye(count)).max())
    return Fit(n, sums, values, vectors, trace, error)


def whiten(
    vectors: DataFrame, vector: Column, id_col: str = "vec_id", components: int = COMPONENTS,
) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained, identity_error.

    ``vector`` is an array of long, NULL where a row takes no part (``scaled`` makes one). The fit takes each distinct
    vector once: n vectors with sums S per dimension and the covariance V of them, divisor n. ``component`` counts the unit
    eigenvectors of V by falling eigenvalue e, ``whitened`` is x - S / n on the component over sqrt(e), ``explained`` is
    e over the trace, ``deviation`` the exact sum of (n x - S)^2, which stops at the end of long, and ``identity_error``
    the largest entry of the covariance of the whitened fit minus the identity.

    Only vectors of the length that most rows have take part (of several the greatest length). Components without variance
    are left out, so equal rows alone give no rows; so does an empty table. Rows that repeat an id or a vector are
    each returned, ids may be NULL, other columns are ignored. Only matrices of dimension x components pass through the driver.
    """
    rows = vectors.select(F.col(id_col).alias("id_"), vector.alias("x_")).where("x_ is not null and size(x_) > 0")
    kind = rows.schema["id_"].dataType.simpleString()
    sizes = rows.groupBy(F.size("x_").alias("size_")).count().orderBy(F.col("count").desc(), F.col("size_").desc()).first()
    width = sizes["size_"] if sizes else 0
    rows = rows.where(F.size("x_") == width)
    fit = fit_whitening(rows, width, components) if width else Fit(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    count = len(fit.values)
    turn = fit.vectors / np.sqrt(fit.values) if count else fit.vectors
    explained = fit.values / fit.trace if count else fit.values

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            x = _rows(batch)
            whitened = centred(x, fit.n, fit.sums) @ turn
            each = pa.array(np.repeat(np.arange(len(x)), count))
            total = len(each)
            yield pa.RecordBatch.from_arrays([
                batch.column("id_").take(each),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(total, fit.n, np.int64)),
                pa.array(np.repeat(squared_deviations(x, fit.n, fit.sums), count)),
                pa.array(whitened.ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(total, fit.identity_error)),
            ], names=["id_", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    found = rows.mapInArrow(
        give, f"id_ {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return found.withColumnRenamed("id_", id_col)
