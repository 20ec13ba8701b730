"""Merges of clusters as the points of a block see them; runs inside tasks.

Sent with the tasks that use it, as the other numpy helpers are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from skeinset.functions.kernels import distances, strips

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Step:
    """What one merge changes for the points: centroids gone, and the places of moved and new ones."""

    gone: list[int]
    moved: dict[int, list[float]]
    pair: tuple[int, int]
    fresh: int


def replay(x, w, owner, far, place, alive, steps: list[Step]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per step, the owners of a block's points as they should be if none but the merged ones moved, and as they
    are. ``owner``, ``far``, ``place`` and ``alive`` are brought up to date."""
    for step in steps:
        alive[step.gone] = False
        for c, at in step.moved.items():
            place[c], alive[c] = at, True
        expected = np.where(np.isin(owner, step.pair), step.fresh, owner)
        own = np.fromiter(step.moved, dtype=np.int64)
        shifted = np.flatnonzero(np.isin(owner, own))
        lost = ~alive[owner]
        if len(shifted):
            d = np.array([distances(x[p : p + 1], place[owner[p]][None])[0, 0] for p in shifted])
            lost[shifted] = d > far[shifted]
            far[shifted] = d
        stay = np.flatnonzero(~lost)
        for c in sorted(step.moved):
            d = distances(x[stay], place[c][None])[:, 0]
            nearer = (d < far[stay]) | ((d == far[stay]) & (c < owner[stay]))
            owner[stay[nearer]], far[stay[nearer]] = c, d[nearer]
        seek, there = np.flatnonzero(lost), np.flatnonzero(alive)
        for s in strips(x[seek], len(there)):
            some = seek[s]
            d = distances(x[some], place[there])
            best = d.argmin(axis=1)
            owner[some], far[some] = there[best], d[np.arange(len(d)), best]
        yield expected, owner


def one_row(*columns) -> pa.RecordBatch:
    """A block as one row of lists."""
    arrays = [pa.array(c) if isinstance(c, np.ndarray) else c for c in columns]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in arrays]
    return pa.RecordBatch.from_arrays(lists, names=["x", "n", "owner", "far"])
