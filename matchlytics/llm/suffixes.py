"""Two-stage suffix sorting with common prefixes of neighbours."""

from __future__ import annotations

import numpy as np


def _rising(data: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than its successor. ``last``: each segment's last place."""
    differs = np.ones(len(data), bool)
    differs[:-1] = data[:-1] != data[1:]
    differs[last] = True
    places = np.where(differs, np.arange(len(data)), len(data))
    after = np.minimum.accumulate(places[::-1])[::-1]
    rises = np.zeros(len(data), bool)
    rises[:-1] = data[:-1] < data[1:]
    rises[last] = False
    return rises[after]


def sorted_suffixes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes that start there, each going to the end of its segment.

    Segment s is data[begin[s]:stop[s]], with one unused byte at stop[s]; asked for are its first wanted[s] places. Only
    suffixes smaller than their successors are sorted directly; the others follow from the order of their successors by a
    scan of the buckets of first bytes. So that each chain of successors ends at a directly sorted one (or at the segment's
    end), some places after the wanted ones may come along.
    """
    rising = _rising(data, stop - 1)
    rising[stop] = False
    direct = np.append(np.flatnonzero(rising), len(data))
    final = direct[np.searchsorted(direct, begin + wanted - 1)]
    open_end = final >= stop
    final = np.where(open_end, stop - 1, final)
    sizes = final - begin + 1
    places = np.repeat(begin - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
    falling = np.zeros(len(data), bool)
    falling[places] = ~rising[places]

    direct = places[rising[places]]
    ends = np.repeat(stop, sizes)[rising[places]]
    raw = data.tobytes()
    keys = [raw[a:b] for a, b in zip(direct.tolist(), ends.tolist())]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    limits = np.searchsorted(data[direct], np.arange(257))

    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(scanned: np.ndarray, bucket: int) -> np.ndarray:
        """Puts the falling predecessors of what was scanned into their buckets; returns those of this bucket."""
        before = scanned[scanned > 0] - 1
        before = before[falling[before]]
        heads = data[before]
        order = np.argsort(heads, kind="stable")
        before, heads = before[order], heads[order]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        same = before[:0]
        for group in np.split(before, cuts) if len(before) else []:
            if data[group[0]] == bucket:
                same = group
            else:
                waiting[data[group[0]]].append(group)
        return same

    induce(stop[open_end], -1)
    out = []
    for bucket in range(256):
        now = np.concatenate(waiting[bucket]) if waiting[bucket] else direct[:0]
        waiting[bucket] = []
        while len(now):
            out.append(now)
            now = induce(now, bucket)
        rest = direct[limits[bucket] : limits[bucket + 1]]
        if len(rest):
            out.append(rest)
            induce(rest, bucket)
    return np.concatenate(out) if out else direct


def share_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of the suffixes at each a and b has ``length`` bytes (8 at least)."""
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    alike = np.arange(len(a))
    for k in [*range(0, length - 8, 8), length - 8]:
        alike = alike[eight[a[alike] + k] == eight[b[alike] + k]]
    found = np.zeros(len(a), bool)
    found[alike] = True
    return found


def repeated_starts(segments: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For the first counts[s] places of each segment: whether the ``length`` bytes there start at another place too.

    Each segment must have ``counts[s] + length - 1`` bytes at least.
    """
    if not segments:
        return []
    data = np.frombuffer(b"\0".join(segments) + b"\0" * 9, np.uint8)
    sizes = np.array([len(s) for s in segments])
    wanted = np.array(counts)
    begin = np.append(0, np.cumsum(sizes + 1)[:-1])
    order = sorted_suffixes(data, begin, begin + sizes, wanted)
    asked = np.zeros(len(data) + 1, np.int8)
    np.add.at(asked, begin, 1)
    np.add.at(asked, begin + wanted, -1)
    order = order[np.cumsum(asked)[order] > 0]
    alike = share_prefix(data, order[:-1], order[1:], length)
    found = np.zeros(len(data), bool)
    found[order[1:][alike]] = True
    found[order[:-1][alike]] = True
    return [found[a : a + n] for a, n in zip(begin.tolist(), counts)]
