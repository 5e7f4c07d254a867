"""Ids of repeated units of text, kept between batches.

A text is cut where no token can cross.  Of a batch's units only those not
seen before are encoded, and the ids of all are put together by one gather.
Short units are found by hash and compared by their whole bytes, packed into
words, so units are never mistaken for each other; the others are found by
their text in a dictionary.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .textio import mix, packed


class UnitIds:
    """A bounded store of units and their ids, in arrays sorted by hash.

    A unit of at most ``words`` times eight bytes is kept packed; longer ones
    in a dictionary of at most ``long_bytes`` of text.
    """

    def __init__(self, dtype, limit: int = 800_000, words: int = 2, long_bytes: int = 1 << 20):
        self.dtype, self.limit, self.words, self.long_bytes = np.dtype(dtype), limit, words, long_bytes
        self._tiers = [self._empty(), self._empty()]  # large and settled, small and recent
        self._long: dict[str, np.ndarray] = {}
        self._long_size = 0

    def _empty(self):
        """(hash, start in pool, number of ids, the unit's words and length, pool)"""
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty((0, self.words + 1), np.uint64), np.empty(0, self.dtype)

    def __len__(self) -> int:
        return sum(len(t[0]) for t in self._tiers)

    @staticmethod
    def _find(tier, h: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(tier[0]):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(tier[0], h), len(tier[0]) - 1)
        hit = tier[0][at] == h
        hit[hit] = (tier[3][at[hit]] == unit[hit]).all(axis=1)
        return hit, at

    @staticmethod
    def _merge(a, b):
        """Two tiers as one; of units of equal hash the last stays."""
        h = np.concatenate([a[0], b[0]])
        order = np.argsort(h, kind="stable")
        last = np.ones(len(h), bool)
        last[:-1] = h[order][1:] != h[order][:-1]
        order = order[last]
        start = np.concatenate([a[1], b[1] + len(a[4])])
        return h[order], start[order], np.concatenate([a[2], b[2]])[order], np.concatenate([a[3], b[3]])[order], np.concatenate([a[4], b[4]])

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spell: Callable[[np.ndarray], list[str]],
            encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], exact: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units one after the other, number of ids of each unit).

        The units are spans of ``data``; those that are not ``exact`` there are
        told apart by their text.  ``spell`` gives the texts of units at places,
        ``encode`` the ids of texts one after the other, and their numbers.
        """
        size = ends - starts
        short = size * data.itemsize <= 8 * self.words
        if exact is not None:
            short &= exact
        far = np.flatnonzero(~short)
        start, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        pool = np.empty(0, self.dtype)
        if len(far) < len(starts):
            near = np.flatnonzero(short) if len(far) else slice(None)
            pool, start[near], count[near] = self._short_ids(data, starts[near], ends[near], spell, encode, np.arange(len(starts))[near])
        if len(far):
            got = self._long_ids(spell(far), encode)
            count[far] = np.fromiter(map(len, got), np.int64, len(got))
            start[far] = len(pool) + np.cumsum(count[far]) - count[far]
            pool = np.concatenate([pool, *got])
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        return pool[np.repeat(start - (stop - count), count) + np.arange(total)], count

    def _long_ids(self, units: list[str], encode) -> list[np.ndarray]:
        new = list(dict.fromkeys(u for u in units if u not in self._long))
        if new:
            ids, count = encode(new)
            fresh = dict(zip(new, np.split(np.asarray(ids, self.dtype), np.cumsum(count)[:-1])))
            got = [fresh[u] if u in fresh else self._long[u] for u in units]
            size = sum(map(len, new))
            if self._long_size + size > self.long_bytes:
                self._long, self._long_size = {}, 0
            if size <= self.long_bytes:
                self._long.update(fresh)
                self._long_size += size
            return got
        return [self._long[u] for u in units]

    def _short_ids(self, data, starts, ends, spell, encode, place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start there, number of ids) of units that are packed whole."""
        size = (ends - starts).astype(np.uint64)
        unit = [*packed(data, starts, ends, self.words), size]
        h = mix(unit[0] ^ mix(size + np.uint64(0x9E3779B97F4A7C15)))
        for k in range(1, self.words):
            more = np.flatnonzero(size * np.uint64(data.itemsize) > 8 * k)
            h[more] = mix(h[more] ^ mix(unit[k][more] + np.uint64(k)))
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if not all(np.array_equal(column[first][inverse], column) for column in unit):
            # units of equal hash: number the distinct ones instead
            table, first, inverse = np.unique(np.stack(unit, 1), axis=0, return_index=True, return_inverse=True)
            inverse, uniq = inverse.ravel(), h[first]
        mine = np.stack([column[first] for column in unit], 1)
        found = [self._find(t, uniq, mine) for t in self._tiers]
        new = ~(found[0][0] | found[1][0])
        fresh = self._empty()
        if new.any():
            ids, count = encode(spell(place[first[new]]))
            fresh = uniq[new], np.cumsum(count, dtype=np.int64) - count, count.astype(np.int32), mine[new], np.asarray(ids, self.dtype)
        (hit0, at0), (hit1, at1) = found
        t0, t1 = self._tiers
        start, count = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
        for hit, at, t, shift in ((hit0, at0, t0, 0), (hit1, at1, t1, len(t0[4]))):
            start[hit], count[hit] = t[1][at[hit]] + shift, t[2][at[hit]]
        start[new], count[new] = fresh[1] + len(t0[4]) + len(t1[4]), fresh[2]
        pool = np.concatenate([t0[4], t1[4], fresh[4]])
        if new.any():
            self._keep(fresh, found)
        return pool, start[inverse], count[inverse]

    def _keep(self, fresh, found) -> None:
        by = np.argsort(fresh[0], kind="stable")
        fresh = *(column[by] for column in fresh[:4]), fresh[4]
        if len(self) + len(fresh[0]) > self.limit:
            # what this batch uses is likely to be used again
            kept = [self._take(t, at[hit]) for t, (hit, at) in zip(self._tiers, found)]
            self._tiers = [self._merge(*kept), self._empty()]
        self._tiers[1] = self._merge(self._tiers[1], fresh)
        if len(self._tiers[1][0]) > 50_000 + len(self._tiers[0][0]) // 8:
            self._tiers = [self._merge(*self._tiers), self._empty()]

    def _take(self, tier, at: np.ndarray):
        """Some entries of a tier, in order of hash, their pool packed."""
        if not len(at):
            return self._empty()
        at = np.unique(at)
        start, count = tier[1][at], tier[2][at]
        stop = np.cumsum(count, dtype=np.int64)
        pool = tier[4][np.repeat(start - (stop - count), count) + np.arange(int(stop[-1]))]
        return tier[0][at], stop - count, count, tier[3][at], pool
