"""Where a bar's solid begins and ends along its axis, from the box of the solid and the bar's section.

Each face of the box is linear in one end's position along the axis, so an end is the weighted least-squares solution over the axes that the bar is not square to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Least share of an axis that counts, largest residual in metres, and cardinal points that lie on the axis.
LEAST_SHARE, TOLERANCE, CENTRED = 0.05, 0.004, (5, 10, 11)
RESULT = "t0 double, t1 double, residual double, length_off double, ok boolean"


def _rows(column, n):
    return np.array([[np.nan] * n if v is None else v for v in column.to_pylist()], float).reshape(-1, n)


def _unit(v):
    with np.errstate(invalid="ignore", divide="ignore"):
        return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit(start, end, up, roll, mirror, cardinal, width, depth, box, cut):
    """Arrays over bars: t0, t1, residual, t1 - t0 less the cut length, and whether the fit holds. NaN where a bar can't be solved."""
    axis = end - start
    length = np.linalg.norm(axis, axis=1)
    a = _unit(axis)
    # The section's upward direction: the given one, or the vertical turned by the roll.
    given = _unit(up)
    usable = (np.linalg.norm(np.nan_to_num(up), axis=1) >= 0.5) & (np.abs(np.nan_to_num((given * a).sum(1))) <= 0.999)
    vertical = np.where(np.abs(a[:, 2:]) < 0.999, [[0, 0, 1.0]], [[1.0, 0, 0]])
    vertical = _unit(vertical - a * (vertical * a).sum(1, keepdims=True))
    turn = np.radians(np.nan_to_num(roll))[:, None]
    vertical = vertical * np.cos(turn) + np.cross(vertical, a) * np.sin(turn)
    above = np.where(usable[:, None], given, vertical)
    y = _unit(above - a * (above * a).sum(1, keepdims=True))
    u = np.cross(a, y) * np.where(mirror, -1.0, 1.0)[:, None]
    # The axis runs through one of nine points of the section.
    on = np.isin(cardinal, CENTRED) | (cardinal < 1) | (cardinal > 9)
    column, row = np.where(on, 1, (cardinal - 1) % 3), np.where(on, 1, (cardinal - 1) // 3)
    base = start - u * ((column - 1) * width / 2)[:, None] - y * ((row - 1) * depth / 2)[:, None]
    corners = np.stack([base + u * (p * width / 2)[:, None] + y * (q * depth / 2)[:, None] for p in (-1, 1) for q in (-1, 1)], 1)
    least, most, lo, hi = corners.min(1), corners.max(1), box[:, :3], box[:, 3:]
    weight = np.where(np.abs(a) < LEAST_SHARE, 0.0, np.abs(a))
    with np.errstate(invalid="ignore", divide="ignore"):
        near = np.where(a > 0, lo - least, hi - most) / a  # the face at the start
        far = np.where(a > 0, hi - most, lo - least) / a
        t0, t1 = (np.where(weight > 0, e * weight, 0).sum(1) / weight.sum(1) for e in (near, far))
    both = np.concatenate([corners + (a * t0[:, None])[:, None], corners + (a * t1[:, None])[:, None]], 1)
    residual = np.abs(np.concatenate([both.min(1), both.max(1)], 1) - box).max(1)
    off = t1 - t0 - np.where(np.isfinite(cut) & (cut != 0), cut, length)
    bad = ~((length >= 1e-5) & (width > 0) & (depth > 0) & np.isfinite(residual))
    t0, t1, residual, off = (np.where(bad, np.nan, v) for v in (t0, t1, residual, off))
    return t0, t1, residual, off, ~bad & (residual < TOLERANCE) & (np.abs(off) < TOLERANCE) & (t1 > t0)


def fit_extents(bars: DataFrame, ident: str) -> DataFrame:
    """(ident, t0, t1, residual, length_off, ok) per bar; values null where it can't be solved.

    Columns: start, end, up (arrays of 3; up may be null), roll (degrees), mirror, cardinal, width, depth, box (array of 6), cut_length. Arrow batches, no shuffle.
    """

    def run(batches):
        for b in batches:
            number = lambda c: b.column(c).to_numpy(zero_copy_only=False).astype(float)  # noqa: B023, E731
            mirror = np.array([bool(v) for v in b.column("mirror").to_pylist()])
            cardinal = np.nan_to_num(number("cardinal")).astype(int)
            out = fit(_rows(b.column("start"), 3), _rows(b.column("end"), 3), _rows(b.column("up"), 3), number("roll"), mirror, cardinal, number("width"), number("depth"), _rows(b.column("box"), 6), number("cut_length"))
            cols = {n: pa.array(np.round(v, 5), pa.float64(), from_pandas=True) for n, v in zip(("t0", "t1", "residual", "length_off"), out[:4], strict=True)}
            yield pa.RecordBatch.from_pydict({ident: b.column(ident), **cols, "ok": pa.array(out[4])})

    asked = [ident, "start", "end", "up", "roll", "mirror", "cardinal", "width", "depth", "box", "cut_length"]
    return bars.select(*asked).mapInArrow(run, f"`{ident}` {bars.schema[ident].dataType.simpleString()}, {RESULT}")
