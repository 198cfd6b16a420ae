"""Where a passage may repeat: content-defined anchors, the same in every copy, found without comparing passages.

A window of ``length`` units (bytes or words) has as its anchor the gram of ``gram`` units with the smallest hash in it, the
leftmost of equals. Equal windows have equal anchors at equal places, so a window can repeat only if its anchor's hash
does. Neighbouring windows with one anchor are a run: one row of a few numbers, about two for each ``length - gram`` units.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Units hashed at a time; windows are shared by no two pieces. The place of a gram must fit into PLACE bits.
PIECE = 1 << 20
PLACE = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


@lru_cache(1)
def byte_values() -> np.ndarray:
    """A fixed 64-bit number for each byte."""
    return np.random.default_rng(20).integers(0, 1 << 63, 256).astype(_U) << _U(1) | _U(1)


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, _U)
        steps[0] = 1
        made.append(np.cumprod(steps))
    return made[0], made[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Rolling:
    """Hashes of any stretch of units, from sums of their values times powers."""

    def __init__(self, values: np.ndarray):
        size = 1 << max(10, (len(values) + 1).bit_length())
        power, self.inverse = _powers(size)
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def all_of(self, length: int) -> np.ndarray:
        """Of every stretch of this length."""
        count = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:count]) * self.inverse[:count])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring keys, by running minima from both ends of blocks."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(_U).max, _U)
    padded[: len(keys)] = keys
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchor_runs(values: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of the windows of several texts laid end to end; text d has the units bounds[d] to bounds[d + 1].

    For each run: ``doc``, ``first`` (start of its first window, in the text), ``count`` of windows, the anchor's hash
    ``anchor``, and a hash of all its units, ``content``.
    """
    found = [_piece(values[lo : lo + PIECE + length - 1], bounds - lo, length, gram) for lo in range(0, max(1, len(values) - length + 1), PIECE)]
    return {k: np.concatenate([f[k] for f in found]) for k in found[0]}


def _piece(values: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    starts = np.arange(max(0, len(values) - length + 1))
    doc = np.searchsorted(bounds, starts, "right") - 1
    if not len(starts):
        return {"doc": doc, "first": starts, "count": starts, "anchor": starts, "content": starts}
    roll = Rolling(values)
    grams = roll.all_of(gram)
    keys = grams & ~PLACE | np.arange(len(grams), dtype=_U)
    at = (sliding_min(keys, length - gram + 1)[: len(starts)] & PLACE).astype(np.int64)
    whole = starts + length <= bounds[np.minimum(doc + 1, len(bounds) - 1)]
    starts, doc, at = starts[whole], doc[whole], at[whole]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    edges = np.append(np.flatnonzero(new), len(starts))
    first, count = starts[new], np.diff(edges)
    return {
        "doc": doc[new],
        "first": first - bounds[doc[new]],
        "count": count,
        "anchor": grams[at[new]].view(np.int64),
        "content": roll(first, first + count + length - 1).view(np.int64),
    }
