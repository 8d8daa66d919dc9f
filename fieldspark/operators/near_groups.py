"""Greedy grouping of observations that match by place, time, source and label, without a table of the matches.

A record is compared with what lies in the cells around it, so memory grows with the records and not with their matches,
of which a busy day has the square. The rows of one call are a set that no outside row matches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import pi, sin

import numpy as np
import pandas as pd

from fieldspark.functions.geo import EARTH_KM, KM_PER_DEGREE_LAT

#: Records of a cell that are compared at a time.
CHUNK = 128


class _Cells:
    """Growing arrays of indices by cell."""

    def __init__(self) -> None:
        self.of: dict[tuple[int, int, int], list] = {}

    def add(self, cell: tuple[int, int, int], index: int) -> None:
        held = self.of.get(cell)
        if held is None:
            held = self.of[cell] = [np.empty(8, dtype=np.int64), 0]
        if held[1] == len(held[0]):
            held[0] = np.concatenate([held[0], np.empty_like(held[0])])
        held[0][held[1]] = index
        held[1] += 1


class Records:
    """``lat, lon, at`` (microseconds), ``source, detail`` of complete rows, in the order of the rule."""

    def __init__(self, rows: pd.DataFrame, radius_km: float, minutes: float, open_labels: Sequence[str]):
        lat, lon = np.radians(rows["lat"].to_numpy(dtype=float)), np.radians(rows["lon"].to_numpy(dtype=float))
        self.x, self.y, self.z = np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)
        #: Square of the chord that spans the radius.
        self.far = 4 * sin(min(radius_km / EARTH_KM / 2, pi / 2)) ** 2
        self.at = rows["at"].to_numpy(dtype=np.int64)
        self.lag = int(minutes * 60e6)
        self.lag += (self.lag + 1) / 60e6 <= minutes
        self.source, sources = pd.factorize(rows["source"])
        self.sources = len(sources)
        code, labels = pd.factorize(rows["detail"])
        code = np.where(code < 0, len(labels) + np.arange(len(code)), code)  # a missing label equals no other
        self.detail = np.where(np.isin(code, [i for i, x in enumerate(labels) if x in open_labels]), -1, code)  # open ones fit all
        # Cells of the cube around the globe: no cell is narrower than the chord, so neighbours hold all within it.
        step = max(self.far**0.5, 1e-9) * 1.000001
        lats, lons = rows["lat"].to_numpy(dtype=float), rows["lon"].to_numpy(dtype=float)
        low, high = max(radius_km, 1e-6) / KM_PER_DEGREE_LAT * 1.01, np.abs(lats).max(initial=0.0)
        ratio = sin(min(radius_km / EARTH_KM, pi / 2)) / max(np.cos(np.radians(min(90.0, high + low))), 1e-12)
        flat = ratio < 1 and lons.max(initial=-180.0) - lons.min(initial=180.0) < 180
        if flat:  # rows and columns of degrees, away from the poles and the date line
            wide = max(np.degrees(np.arcsin(ratio)), 1e-9) * 1.01
            self.cell = list(zip(np.floor(lats / low).astype(np.int64).tolist(), np.floor(lons / wide).astype(np.int64).tolist(), strict=True))
            self.around = [(a, b) for a in (0, -1, 1) for b in (0, -1, 1)]
        else:
            self.cell = list(zip(*[np.floor(v / step).astype(np.int64).tolist() for v in (self.x, self.y, self.z)], strict=True))
            self.around = [(a, b, c) for a in (0, -1, 1) for b in (0, -1, 1) for c in (0, -1, 1)]
        self.block = (self.at // max(self.lag, 1)).tolist()
        self.lists = [v.tolist() for v in (self.x, self.y, self.z, self.at, self.source, self.detail)]

    def __len__(self) -> int:
        return len(self.at)

    def key(self, i: int) -> tuple:
        return (*self.cell[i], self.block[i])

    def near(self, i: int, cells: _Cells) -> list:
        """What the cells around the record hold, its own cell first."""
        c, b, get = self.cell[i], self.block[i], cells.of.get
        if len(c) == 2:
            keys = ((c[0] + p, c[1] + q, b + t) for p, q in self.around for t in (0, -1, 1))
        else:
            keys = ((c[0] + p, c[1] + q, c[2] + r, b + t) for p, q, r in self.around for t in (0, -1, 1))
        return [held for held in map(get, keys) if held is not None]

    def chunks(self, i: int, cells: _Cells) -> Iterator[np.ndarray]:
        """What the cells around the record hold, some of it at a time."""
        parts, size = [], 0
        for held, n in self.near(i, cells):
            while n:
                parts.append(held[max(0, n - CHUNK) : n])
                size += len(parts[-1])
                n = max(0, n - CHUNK)
                if size >= CHUNK:
                    yield np.concatenate(parts) if len(parts) > 1 else parts[0]
                    parts, size = [], 0
        if parts:
            yield np.concatenate(parts) if len(parts) > 1 else parts[0]

    def match(self, i: int, j: int) -> bool:
        x, y, z, at, source, detail = self.lists
        if source[i] == source[j] or (detail[i] != detail[j] and detail[i] >= 0 and detail[j] >= 0) or abs(at[i] - at[j]) > self.lag:
            return False
        return (x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 + (z[i] - z[j]) ** 2 <= self.far

    def matches(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of the others that match the record."""
        good = (self.source[others] != self.source[i]) & (np.abs(self.at[others] - self.at[i]) <= self.lag)
        if self.detail[i] >= 0:
            detail = self.detail[others]
            good &= (detail < 0) | (detail == self.detail[i])
        others = others[good]
        return others[(self.x[others] - self.x[i]) ** 2 + (self.y[others] - self.y[i]) ** 2 + (self.z[others] - self.z[i]) ** 2 <= self.far]


def only_whole(rows: Records) -> tuple[list[int], list[str]]:
    """First member of each record's group, and its status: a record joins the one group that it matches wholly."""
    cells, first, status = _Cells(), [0] * len(rows), [""] * len(rows)
    members: dict[int, list[int]] = {}
    for i in range(len(rows)):
        whole: list[int] = []
        tried: set[int] = set()
        for some in rows.chunks(i, cells):
            for j in rows.matches(i, some).tolist():
                g = first[j]
                if g in tried:
                    continue
                tried.add(g)
                if all(rows.match(i, k) for k in members[g]):
                    whole.append(g)
                    if len(whole) == 2:  # more do not change what becomes of it
                        break
            if len(whole) == 2:
                break
        if len(whole) == 1:
            first[i], status[i] = whole[0], "MERGED"
            members[whole[0]].append(i)
        else:
            first[i], status[i] = i, "REVIEW_REQUIRED" if tried else "ORIGINAL"
            members[i] = [i]
        cells.add(rows.key(i), i)
    return first, status


def largest_whole(rows: Records) -> list[int]:
    """First member of each record's group: it joins the largest group that it matches wholly, the earliest of equal ones.

    Groups that hold a record of each source are full and leave the cells. What the groups' members have in common is
    held in arrays and rules most of them out before members are looked at.
    """
    n = len(rows)
    cells, first = _Cells(), [0] * n
    members: dict[int, list[int]] = {}
    few = rows.sources <= 62
    bit = (np.int64(1) << rows.source.astype(np.int64)) if few else np.zeros(n, dtype=np.int64)
    full = (1 << rows.sources) - 1 if few else -1
    held_by, label, low, high, count = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64), rows.at.copy(), rows.at.copy(), np.zeros(n, dtype=np.int64)
    for i in range(n):
        at, found = rows.at[i], [held[0][: held[1]] for held in rows.near(i, cells)]
        chosen = -1
        if found:
            g = np.concatenate(found) if len(found) > 1 else found[0]
            good = ((held_by[g] & bit[i]) == 0) & (low[g] >= at - rows.lag) & (high[g] <= at + rows.lag)
            if rows.detail[i] >= 0:
                good &= (label[g] < 0) | (label[g] == rows.detail[i])
            g = g[good]
            g = g[(rows.x[g] - rows.x[i]) ** 2 + (rows.y[g] - rows.y[i]) ** 2 + (rows.z[g] - rows.z[i]) ** 2 <= rows.far]
            if len(g):
                for k in g[np.lexsort((g, -count[g]))].tolist() if len(g) > 1 else g.tolist():
                    if all(rows.match(i, m) for m in members[k]):
                        chosen = k
                        break
        if chosen < 0:
            chosen = i
            members[i] = []
            cells.add(rows.key(i), i)
        members[chosen].append(i)
        first[i] = chosen
        held_by[chosen] |= bit[i]
        count[chosen] += 1
        low[chosen], high[chosen] = min(low[chosen], at), max(high[chosen], at)
        if rows.detail[i] >= 0:
            label[chosen] = rows.detail[i]
        if held_by[chosen] == full:
            held = cells.of[rows.key(chosen)]
            k = int(np.flatnonzero(held[0][: held[1]] == chosen)[0])
            held[1] -= 1
            held[0][k] = held[0][held[1]]
            del members[chosen]
    return first
