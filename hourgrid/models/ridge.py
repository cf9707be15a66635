"""The numpy side of the penalised regression, run inside Spark tasks.

Columns have a normal prior (a squared penalty), slope changes a Laplace prior (an absolute
one): most of them are exactly zero, as few as the data ask for.

Spark ships this module with the tasks (``register_pickle_by_value`` below), so
the workers need numpy, pandas and pyarrow but not this package.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

SOLVER_ROUNDS = 5

PARTIAL_SCHEMA = (
    "building_id string, cross array<double>, n_obs bigint,"
    " first_hour bigint, last_hour bigint"
)
COEFFICIENT_SCHEMA = (
    "building_id string, coefficients array<double>, offsets array<double>,"
    " slopes array<double>, sigma double, drift double, n_obs bigint"
)


def cross_products(changepoints: np.ndarray):
    """The grouped function that turns a block's rows into their cross-products.

    A design row is 1, position, one bend per changepoint, the effects, the target.
    """

    def summarise(block: pa.Table) -> pa.Table:
        # Arrow keeps the cells of all rows in one buffer: a matrix without copies.
        cells = pa.concat_arrays([c.flatten() for c in block.column("_row").chunks])
        given = cells.to_numpy().reshape(block.num_rows, -1)
        at, hours = (block.column(name).to_numpy() for name in ("_at", "_hour"))
        bends = np.maximum(at[:, None] - changepoints, 0.0)
        rows = np.column_stack([np.ones(len(at)), at, bends, given])
        return pa.table(
            {
                "building_id": block.column("building_id").slice(0, 1),
                "cross": pa.array([(rows.T @ rows).ravel()], pa.list_(pa.float64())),
                "n_obs": pa.array([block.num_rows], pa.int64()),
                "first_hour": pa.array([hours.min()], pa.int64()),
                "last_hour": pa.array([hours.max()], pa.int64()),
            }
        )

    return summarise


def solver(scales: np.ndarray, hours_needed: np.ndarray, changepoints: np.ndarray):
    """The grouped function that turns a building's blocks into coefficients.

    A design column takes part when the building has ``hours_needed`` of history.
    The trend is also returned as one line per stretch between changepoints.

    ``drift`` is what future slope changes add to the variance at distance d beyond the
    training range, over d cubed. They are expected as often as there are changepoints,
    with the fitted ones' mean size b: each has variance 2 b * b, and one that comes u
    before the end has moved the trend by u times its size; d * d * d / 3 is the integral.
    """
    sparse = np.zeros(len(scales), bool)
    sparse[2 : 2 + len(changepoints)] = True

    def solve(partials: pd.DataFrame) -> pd.DataFrame:
        side = len(scales) + 1
        cross = np.sum(np.vstack(partials["cross"].to_numpy()), axis=0)
        n = int(partials["n_obs"].sum())
        hours = int(partials["last_hour"].max() - partials["first_hour"].min())
        usable = hours_needed <= hours
        beta, sigma = penalised(cross.reshape(side, side), n, scales, usable, sparse)
        bends = beta[2 : 2 + len(changepoints)]
        size = np.abs(bends).mean() if len(bends) else 0.0
        slopes = beta[1] + np.concatenate([[0.0], np.cumsum(bends)])
        offsets = beta[0] - np.concatenate([[0.0], np.cumsum(bends * changepoints)])
        return pd.DataFrame(
            {
                "building_id": partials["building_id"].iloc[:1],
                "coefficients": [beta],
                "offsets": [offsets],
                "slopes": [slopes],
                "sigma": [sigma],
                "drift": [len(bends) * 2 * size**2 / 3],
                "n_obs": [n],
            }
        )

    return solve


def penalised(
    cross: np.ndarray, n: int, scales: np.ndarray, usable: np.ndarray, sparse: np.ndarray
) -> tuple[np.ndarray, float]:
    """Coefficients and residual spread from the cross-products of [X, y].

    The penalty of a column is noise variance / prior variance, of a ``sparse`` one noise
    variance / prior scale, with the target scaled to unit size; the noise variance is
    re-estimated from the residuals. An infinite scale is no penalty.
    """
    unit = np.ones(len(cross))
    unit[-1] = np.sqrt(cross[-1, -1] / n) or 1.0
    scaled = cross / np.outer(unit, unit)
    keep = np.flatnonzero(usable)
    gram, moment, power = scaled[np.ix_(keep, keep)], scaled[keep, -1], scaled[-1, -1]
    few, plain = np.flatnonzero(sparse[keep]), np.flatnonzero(~sparse[keep])
    noise, beta = 1.0, np.zeros(len(keep))
    for _ in range(SOLVER_ROUNDS):
        penalty = np.diag(noise / scales[keep][plain] ** 2)
        # The plain columns as functions of the sparse ones, which are then solved alone.
        right = np.column_stack([gram[np.ix_(plain, few)], moment[plain]])
        solved = np.linalg.lstsq(gram[np.ix_(plain, plain)] + penalty, right, rcond=None)[0]
        if len(few):
            between = gram[np.ix_(few, plain)]
            square = gram[np.ix_(few, few)] - between @ solved[:, :-1]
            linear = moment[few] - between @ solved[:, -1]
            beta[few] = absolute(square, linear, noise / scales[keep][few])
        beta[plain] = solved[:, -1] - solved[:, :-1] @ beta[few]
        rss = power - 2 * beta @ moment + beta @ gram @ beta
        noise = max(rss / n, 1e-12)
    full = np.zeros(len(scales))
    full[keep] = beta * unit[-1]
    return full, float(np.sqrt(noise) * unit[-1])


def absolute(square: np.ndarray, linear: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The x that minimises x'Ax / 2 - b'x + sum(penalty * abs(x)), exactly.

    Signs are guessed one coefficient at a time (Lee et al., "Efficient sparse coding
    algorithms", 2007): the problem with given signs is linear, and a step stops where a
    coefficient would change its sign. Each step lowers the value, so it ends.
    """
    x = np.zeros(len(linear))
    tiny = 1e-12 * max(float(np.abs(linear).max(initial=0.0)), 1e-300)

    def value(at: np.ndarray) -> float:
        return 0.5 * at @ square @ at - linear @ at + penalty @ np.abs(at)

    for _ in range(50 * len(x) + 50):
        slope = square @ x - linear
        signs = np.sign(x)
        active = np.flatnonzero(signs)
        settled = np.abs(slope[active] + penalty[active] * signs[active]).max(initial=0.0) <= 1e3 * tiny
        if settled:
            pull = np.where(signs == 0, np.abs(slope) - penalty, -np.inf)
            if not len(pull) or pull.max() <= 1e3 * tiny:
                break
            joins = int(pull.argmax())
            signs[joins] = -np.sign(slope[joins])
            active = np.append(active, joins)
        inner = square[np.ix_(active, active)]
        aim = np.linalg.lstsq(inner, linear[active] - penalty[active] * signs[active], rcond=None)[0]
        path = aim - x[active]
        # Where the way to the aim crosses zero, and the aim itself: the lowest is taken.
        with np.errstate(divide="ignore", invalid="ignore"):
            zero = -x[active] / path
        shares = np.append(zero[(zero > 0) & (zero < 1)], 1.0)
        best, lowest = x, value(x)
        for share in shares:
            tried = x.copy()
            tried[active] = x[active] + share * path
            tried[active[np.abs(zero - share) < 1e-12]] = 0.0
            now = value(tried)
            if now < lowest:
                best, lowest = tried, now
        if best is x:
            break
        x = best
    return x


cloudpickle.register_pickle_by_value(sys.modules[__name__])
