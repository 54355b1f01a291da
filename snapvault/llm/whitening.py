"""Embedding whitening: leading principal components by block Jacobi-Davidson.

Vectors become whole numbers x; the covariance V of the distinct x vectors (the
fit list) is never formed.  Spark multiplies it with a block of vectors: every
task adds (x - mean) ((x - mean) . u) over its rows, with the mean taken off
exactly in whole numbers first; the sums meet in a bounded number of groups.
The driver holds the search space only (dimensions times a few dozen columns):

* Rayleigh-Ritz on the orthonormal search space gives Ritz pairs, leading first;
* for each unfinished pair the projected correction equation
  (I - QQ')(V - theta)(I - QQ') t = -r is solved roughly by MINRES, whose steps
  take all pairs together, so one distributed product serves them all (Q: the
  locked vectors and the pair's own);
* the corrections extend the space, which restarts from its best Ritz vectors;
* a leading pair whose residual has reached double precision is locked and taken
  out of the space, until all are.

Cases: rows whose vector is null, empty or holds null, NaN or infinite entries
are dropped, as are those whose length isn't the commonest one (the longer of
equally common ones); equal rows count once in the fit list and each gets its
own result rows; null ids are ids; entries beyond 2^40 in size count as that;
fewer dimensions than components give fewer components, and directions without
variance (below 1e-12 of the whole) none; a squared deviation beyond a long is
null; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 40
GROUPS = 16            # groups in which the tasks' sums meet: what reaches the driver at once
TOLERANCE = 2.0 ** -46  # of the greatest eigenvalue: a residual of double precision after summing up
INNER, OUTER = 6, 40   # MINRES steps of one correction, and corrections at most
NEGLIGIBLE = 1e-12


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry."""
    def one(c):
        c = F.least(F.greatest(c.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))
        return F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long")
    return F.transform(vector, one)


def usable(vector: Column) -> Column:
    def fine(c):
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine), F.lit(False))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(df: DataFrame, part, size: int, kind: str = "double") -> np.ndarray:
    """Sum over all tasks of what ``part`` makes of a task's batches (arrays of ``size`` numbers).

    Tasks' sums meet in ``GROUPS`` groups, in the order of the tasks, so reruns over the same partitions agree.
    """
    numbers = np.int64 if kind == "long" else np.float64

    def local(batches):
        total = None
        for b in batches:
            if b.num_rows:
                got = part(_matrix(b.column(0)))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(numbers).tobytes()], pa.binary())], names=["total"])

    def joined(table: pa.Table) -> pa.Table:
        total = np.zeros(size, numbers)
        for t in table.sort_by("task").column("total").to_pylist():
            total += np.frombuffer(t, numbers)
        return pa.table({"total": pa.array([total.tobytes()], pa.binary())})

    sums = df.mapInArrow(local, "total binary").withColumn("task", F.spark_partition_id())
    groups = sums.groupBy(F.pmod("task", F.lit(GROUPS))).applyInArrow(joined, "total binary").toArrow()
    total = np.zeros(size, numbers)
    for t in sorted(groups.column("total").to_pylist()):
        total += np.frombuffer(t, numbers)
    return total


class Covariance:
    """The fit list's covariance as a distributed product; ``products`` counts the Spark jobs."""

    def __init__(self, fit: DataFrame, dims: int):
        self.fit, self.d, self.products = fit, dims, 0
        first = _summed(fit, lambda x: np.append(x.sum(axis=0), len(x)), dims + 1, "long")
        self.s, self.n = first[:dims], int(first[dims])

    def centred(self):
        """A function: whole numbers -> x - S/n, each from the exact difference n x - S."""
        s, n = self.s, self.n

        def take(x: np.ndarray) -> np.ndarray:
            if n * (abs(x).max(initial=0) + 1) < 2 ** 62:
                return (n * x - s) / n
            return ((n * x.astype(object) - s.astype(object)) / n).astype(np.float64)
        return take

    def trace(self) -> float:
        centred = self.centred()
        return float(_summed(self.fit, lambda x: np.array([(centred(x) ** 2).sum()]), 1)[0]) / max(self.n, 1)

    def times(self, u: np.ndarray) -> np.ndarray:
        self.products += 1
        centred, b = self.centred(), u.shape[1]

        def part(x):
            c = centred(x)
            return (c.T @ (c @ u)).ravel()
        return _summed(self.fit, part, self.d * b).reshape(self.d, b) / max(self.n, 1)


def orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of ``vectors`` without their part in ``against`` (orthonormal), each taken off twice."""
    kept = []
    for v in vectors.T:
        size = np.linalg.norm(v)
        if not size > 0 or not np.isfinite(size):
            continue
        v = v / size
        for _ in range(2):
            v = v - against @ (against.T @ v)
            for w in kept:
                v = v - w * (w @ v)
        rest = np.linalg.norm(v)
        if rest > 1e-10:
            v = v / rest
            v = v - against @ (against.T @ v)
            for w in kept:
                v = v - w * (w @ v)
            kept.append(v / np.linalg.norm(v))
    return np.array(kept).T if kept else np.zeros((len(vectors), 0))


def corrections(times, theta: np.ndarray, u: np.ndarray, residual: np.ndarray, locked: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on (I - QQ')(V - theta_j)(I - QQ') t_j = -r_j for all j together: one product of V a step."""
    def project(j_vectors):
        out = j_vectors - locked @ (locked.T @ j_vectors)
        out = out - u * np.sum(u * out, axis=0)
        return out - locked @ (locked.T @ out)

    b = theta.size
    v = project(-residual)
    beta = np.linalg.norm(v, axis=0)
    live = beta > 0
    v = np.where(live, v / np.where(live, beta, 1.0), 0.0)
    before, t = np.zeros_like(v), np.zeros_like(v)
    w, w_before = np.zeros_like(v), np.zeros_like(v)
    eta, last = beta.copy(), np.zeros(b)
    c, c_before, s, s_before = np.ones(b), np.ones(b), np.zeros(b), np.zeros(b)
    for _ in range(steps):
        p = project(times(v) - v * theta)
        alpha = np.sum(v * p, axis=0)
        p = project(p - alpha * v - last * before)
        following = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_before * s * last
        rho = np.hypot(delta, following)
        rho_2 = s * alpha + c_before * c * last
        rho_3 = s_before * last
        fine = live & (rho > 0)
        safe = np.where(fine, rho, 1.0)
        direction = np.where(fine, (v - rho_3 * w_before - rho_2 * w) / safe, 0.0)
        w_before, w = w, direction
        c_before, s_before = c, s
        c, s = np.where(fine, delta / safe, 1.0), np.where(fine, following / safe, 0.0)
        t = t + np.where(fine, c * eta, 0.0) * direction
        eta = -s * eta
        live = fine & (following > 0)
        before, v = v, np.where(live, p / np.where(live, following, 1.0), 0.0)
        last = following
    return project(t)


def jacobi_davidson(times, d: int, k: int, inner: int = INNER, outer: int = OUTER,
                    tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k greatest eigenpairs of the symmetric operator ``times``: (values, unit vectors, residual norms)."""
    k = min(k, d)
    width = min(d, k + 4)
    locked, values, residuals = np.zeros((d, 0)), [], []
    space = orthonormal(np.random.default_rng(11).standard_normal((d, width)), locked)
    image = times(space)
    scale, history = 0.0, []
    for _ in range(outer):
        h = space.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        space, image = space @ y, image @ y  # by falling Ritz value
        scale = max(scale, abs(theta[0]) if len(theta) else 0.0, 1e-300)
        want = min(k - len(values), len(theta))
        r = image[:, :want] - space[:, :want] * theta[:want]
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        history.append(float(size.max(initial=0.0)) / scale)
        # nothing gained in two corrections although nearly there: the residuals are those of the summation itself
        stalled = len(history) > 2 and history[-1] < 1e-11 and history[-1] > 0.5 * max(history[-3:-1])
        done = want if stalled else int(np.argmin(np.append(size <= tolerance * scale, False)))
        if done:
            values.extend(theta[:done].tolist())
            residuals.extend(size[:done].tolist())
            locked = np.hstack([locked, space[:, :done]])
            space, image = space[:, done:], image[:, done:]
            theta, r, want = theta[done:], r[:, done:], want - done
            history = history[-1:]
        if len(values) >= k:
            break
        keep = min(space.shape[1], 2 * width)
        space, image = space[:, :keep], image[:, :keep]
        if space.shape[1] + len(values) >= d:  # the space holds all there is: only its rounding can improve
            space = orthonormal(space, locked)
            image = times(space)
            continue
        t = corrections(times, theta[:want], space[:, :want], r, locked, inner)
        new = orthonormal(t, np.hstack([locked, space]))[:, :d - len(values) - space.shape[1]]
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(len(history)).standard_normal((d, want)), np.hstack([locked, space]))
            new = new[:, :d - len(values) - space.shape[1]]
        space, image = np.hstack([space, new]), np.hstack([image, times(new)])
    if len(values) < k:
        raise RuntimeError(f"{k - len(values)} components did not converge in {outer} corrections")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order], np.array(residuals)[order]


def whiten(table: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    arrow_limits(spark)
    rows = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("v")).where(usable(F.col("v")))
    rows = stored(rows.select("vec_id", whole_numbers(F.col("v")).alias("x")), "whitening-rows")
    kind = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, " \
           "explained double, identity_error double, eigenvalue double, residual double"
    # one row for each length of a vector
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], kind)
    d = lengths["d"]
    rows = rows.where(F.size("x") == d)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    v = Covariance(fit, d)
    trace = v.trace()
    values, vectors, residuals = jacobi_davidson(v.times, d, k)
    some = (values > NEGLIGIBLE * trace) & (values > 0)
    values, vectors, residuals = values[some], vectors[:, some], residuals[some]
    c = len(values)
    if not c:
        return spark.createDataFrame([], kind)
    vectors = vectors * np.where(vectors[abs(vectors).argmax(axis=0), np.arange(c)] < 0, -1.0, 1.0)
    centred, scaled, n, s = v.centred(), vectors / np.sqrt(values), v.n, v.s

    def gram(x):
        w = centred(x) @ scaled
        return (w.T @ w).ravel()
    identity_error = float(abs(_summed(fit, gram, c * c).reshape(c, c) / n - np.eye(c)).max())

    def deviations(x: np.ndarray) -> pa.Array:
        if n * (int(abs(x).max(initial=0)) + 1) < 2 ** 62:
            far = n * x - s
            if int(abs(far).max(initial=0)) ** 2 * d < 2 ** 63:
                return pa.array((far * far).sum(axis=1))
        far = n * x.astype(object) - s.astype(object)
        return pa.array([q if q < 2 ** 63 else None for q in (far * far).sum(axis=1).tolist()], pa.int64())

    def project(batches):
        for b in batches:
            if not b.num_rows:
                continue
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = _matrix(part.column("x"))
                m = len(x)
                every = np.repeat(np.arange(m), c)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(every)), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * c, n)), deviations(x).take(pa.array(every)), pa.array((centred(x) @ scaled).ravel()),
                     pa.array(np.tile(values / trace, m)), pa.array(np.full(m * c, identity_error)),
                     pa.array(np.tile(values, m)), pa.array(np.tile(residuals, m))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                           "eigenvalue", "residual"])

    return rows.mapInArrow(project, kind)
