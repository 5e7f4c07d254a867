"""SentencePiece encoding and decoding by suffix-array matching.

The distinct units of a batch are concatenated and their suffixes sorted by as
many characters as the longest piece has.  Each piece is looked up in the
sorted suffixes by binary search; the ranges give an edge for every occurrence.
The edges, sorted by position, are then relaxed from left to right.

For a unigram model an edge relaxes its end with the sum of scores.  For a BPE
model it does so if the piece may follow the one that ends at its start: a
sequence of pieces is the BPE encoding of its text exactly if every two
neighbours are the encoding of theirs.  So there is one such path, and it is
the encoding that the merges would give.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textio import released
from .unitcache import UnitIds

SPACE = "▁"
#: Distinct units that a worker remembers.
CACHE_UNITS = 300_000
#: Characters that are indexed at a time.
INDEX_CHARS = 1 << 17
_START, _UNKNOWN = -2, -1
_NORMAL, _UNK, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of one protocol buffer message."""
    at, n = 0, len(raw)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {5: 4, 1: 8}[kind]
        yield key >> 3, raw[at : at + size]
        at += size


class PieceModel:
    """A SentencePiece model file, prepared for matching.

    Unigram and BPE models without a normalisation table and without
    user-defined pieces are supported; others raise ``ValueError``.
    """

    def __init__(self, path: str):
        with open(path, "rb") as src:
            raw = src.read()
        self.pieces: list[str] = []
        scores, types = [], []
        self.bpe, self.byte_fallback, self.dummy_prefix, self.collapse = False, False, True, True
        for number, value in _fields(raw):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                types.append(f.get(3, _NORMAL))
            elif number == 2:
                f = dict(_fields(value))
                if f.get(3, 1) not in (1, 2) or f.get(24):
                    raise ValueError("only unigram and BPE models with spaces as prefixes are supported")
                self.bpe, self.byte_fallback = f.get(3, 1) == 2, bool(f.get(35))
            elif number == 3:
                f = dict(_fields(value))
                if f.get(2):
                    raise ValueError("models with a normalisation table are not supported")
                self.dummy_prefix, self.collapse = bool(f.get(3, 1)), bool(f.get(4, 1))
        if _USER in types or _UNUSED in types:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.scores, self.types = np.array(scores), np.array(types)
        self.normal = [i for i, t in enumerate(types) if t == _NORMAL]
        self.unk = types.index(_UNK)
        self.ids = {self.pieces[i]: i for i in self.normal}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that hold a space after another character are not supported")
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i, t in enumerate(types) if t == _BYTE}
        lengths = [len(p) for p in self.ids]
        self.longest = -(-max(lengths, default=1) // 4) * 4
        # lower rank merges first; equal scores have equal ranks
        self.rank = np.unique(-self.scores, return_inverse=True)[1].astype(np.int64)
        self.usable = np.zeros(len(self.pieces), bool)
        self.usable[self.normal] = True
        self.odd = np.zeros(len(self.pieces), bool)
        if self.bpe:
            self._spines()
        self.bytes_of = [p.replace(SPACE, " ").encode() if t == _NORMAL else b"" for p, t in zip(self.pieces, types)]
        for b, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([b])
        self.bytes_of[self.unk] = " ⁇ ".encode()
        chars = sorted({c for p in self.ids for c in p})
        self.code = np.full(0x110000, len(chars) + 1, np.uint16)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.unknown_code = len(chars) + 1
        # marks neighbours inside pieces; a false mark only makes units longer
        self.beside = np.zeros(1 << 20, bool)
        for p in self.ids:
            c = self.code[[ord(x) for x in p]].astype(np.int64)
            self.beside[(c[:-1] * 40_503 + c[1:]) & (len(self.beside) - 1)] = True
        self._known: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.int64), np.empty(0, bool))

    # --- BPE ---------------------------------------------------------------

    def merge(self, text: str) -> tuple[list[str], dict[str, tuple[str, str]]]:
        """The pieces that merging leaves of ``text`` (best score first, then
        leftmost), and the two parts of each piece that was merged."""
        sym, n = list(text), len(text)
        left, right, parts = list(range(-1, n - 1)), [*range(1, n), -1], {}
        heap: list = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (k := self.ids.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (self.rank[k], i, j, sym[i], sym[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or right[i] != j:
                continue
            parts[a + b] = (a, b)
            sym[i], sym[j], right[i] = a + b, "", right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [s for s in sym if s], parts

    def _spines(self) -> None:
        """For every piece the pieces that stand at its right and left edge
        while it is merged, from one character up to itself.

        A piece that merging does not give back is never in an encoding.  Odd
        pieces are those whose parts do not come strictly before them; units
        that hold one are merged directly."""
        split: dict[int, tuple[int, int] | None] = {}
        for i in self.normal:
            p = self.pieces[i]
            if len(p) == 1:
                split[i] = None
                continue
            got, parts = self.merge(p)
            if len(got) > 1:
                self.usable[i] = False
                continue
            a, b = (self.ids.get(x) for x in parts[p])
            split[i] = (a, b) if a is not None and b is not None else None
        depth = 1 + max((len(self.pieces[i]) for i in split), default=1)
        self.right, self.left = (np.full((len(self.pieces), depth), -1, np.int64) for _ in range(2))
        for side, table in ((1, self.right), (0, self.left)):
            for i in split:
                chain, at = [], i
                while at is not None:
                    chain.append(at)
                    at = split[at][side] if split.get(at) else None
                table[i, : len(chain)] = chain[::-1]
        tied = np.bincount(self.rank[[i for i in split if split[i]]], minlength=len(self.pieces)) > 1
        for i, ab in split.items():
            if ab and (tied[self.rank[i]] or any(split.get(x) and self.rank[x] >= self.rank[i] for x in ab)):
                self.odd[i] = True
        keys, made = [], []
        for i in self.normal:
            p = self.pieces[i]
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * len(self.pieces) + b)
                    made.append(i)
        order = np.argsort(keys, kind="stable") if keys else np.empty(0, np.int64)
        self.pair_key, self.pair_piece = np.array(keys, np.int64)[order], np.array(made, np.int64)[order]

    def _follows(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        """May piece ``t`` follow piece ``p``?  The merges of both sides run in
        order of rank; they may not if a merge across the border comes first."""
        v, never = len(self.pieces), np.iinfo(np.int64).max
        rank = np.append(self.rank, never)  # at -1: no such piece
        i, j = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
        ok, live = np.ones(len(p), bool), np.arange(len(p))
        while len(live):
            a, b = self.right[p[live], i[live]], self.left[t[live], j[live]]
            key = a * v + b
            at = np.minimum(np.searchsorted(self.pair_key, key), max(0, len(self.pair_key) - 1))
            across = np.where(self.pair_key[at] == key, rank[self.pair_piece[at]], never) if len(self.pair_key) else np.full(len(live), never)
            x, y = rank[self.right[p[live], i[live] + 1]], rank[self.left[t[live], j[live] + 1]]
            bad = (across < x) & (across <= y)
            ok[live[bad]] = False
            step_left = x <= y
            i[live] += step_left
            j[live] += ~step_left
            live = live[~bad & ((x != never) | (y != never))]
        return ok

    def follows(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        """:meth:`_follows`, remembered by pair; at most pieces squared pairs,
        forgotten beyond a million."""
        free = (p < 0) | (t < 0)
        key = np.where(free, 0, p * len(self.pieces) + t)
        wanted = np.unique(key[~free])
        known, value = self._known
        new = wanted[~np.isin(wanted, known, assume_unique=True)] if len(known) else wanted
        if len(new):
            got = self._follows(new // len(self.pieces), new % len(self.pieces))
            if len(known) > 1_000_000:
                known, value, new = known[:0], value[:0], wanted
                got = self._follows(new // len(self.pieces), new % len(self.pieces))
            known, value = np.concatenate([known, new]), np.concatenate([value, got])
            order = np.argsort(known, kind="stable")
            known, value = self._known = known[order], value[order]
        if not len(known):
            return free
        return free | value[np.minimum(np.searchsorted(known, key), len(known) - 1)]

    # --- matching ----------------------------------------------------------

    @cached_property
    def packed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, lengths, low, high): the usable pieces, four characters to a
        word, padded with the lowest and with the highest code."""
        ids = np.flatnonzero(self.usable)
        lengths = np.array([len(self.pieces[i]) for i in ids])
        low, high = np.zeros((len(ids), self.longest), np.uint64), np.full((len(ids), self.longest), 0xFFFF, np.uint64)
        for row, i in enumerate(ids):
            codes = self.code[[ord(c) for c in self.pieces[i]]]
            low[row, : len(codes)] = high[row, : len(codes)] = codes
        pack = lambda x: (x[:, 0::4] << np.uint64(48)) | (x[:, 1::4] << np.uint64(32)) | (x[:, 2::4] << np.uint64(16)) | x[:, 3::4]
        return ids, lengths, pack(low), pack(high)

    def match(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of every occurrence of every usable piece."""
        n, words = len(codes), self.longest // 4
        c = np.concatenate([codes, np.zeros(self.longest + 4, np.uint16)]).astype(np.uint64)
        four = (c[:-3] << np.uint64(48)) | (c[1:-2] << np.uint64(32)) | (c[2:-1] << np.uint64(16)) | c[3:]
        keys = [four[4 * k : 4 * k + n] for k in range(words)]
        suffixes = np.lexsort(keys[::-1])
        ids, lengths, low, high = self.packed
        first = keys[0][suffixes]
        lo, hi = np.searchsorted(first, low[:, 0], "left"), np.searchsorted(first, high[:, 0], "right")
        for k in range(1, words):
            # narrow the ranges of longer pieces by their next four characters
            more = np.flatnonzero((lengths > 4 * k) & (lo < hi))
            if not len(more):
                break
            column = keys[k][suffixes]
            lo[more], hi[more] = _bound(column, lo[more], hi[more], low[more, k], False), _bound(column, lo[more], hi[more], high[more, k], True)
        times = np.maximum(0, hi - lo)
        which = np.repeat(np.arange(len(ids), dtype=np.int32), times)
        first = (lo - (np.cumsum(times) - times)).astype(np.int32)
        start = suffixes.astype(np.int32)[np.arange(len(which), dtype=np.int32) + first[which]]
        return start, lengths.astype(np.int32)[which], ids.astype(np.int32)[which]

    def _unit_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.encode_units(units)
        return np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))

    def encode_units(self, units: list[str]) -> list[np.ndarray]:
        """The piece ids of each unit (no unit is empty)."""
        out: list = [None] * len(units)
        lo = 0
        while lo < len(units):
            hi, size = lo, 0
            while hi < len(units) and (hi == lo or size + len(units[hi]) < INDEX_CHARS):
                size += len(units[hi]) + 1
                hi += 1
            out[lo:hi] = self._encode_indexed(units[lo:hi])
            lo = hi
        return out

    def _encode_indexed(self, units: list[str]) -> list[np.ndarray]:
        cp = np.frombuffer(("\0".join(units) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        end = begin + lengths
        codes = self.code[cp].copy()
        codes[end] = 0
        start, size, piece = self.match(codes)
        unknown = np.flatnonzero(codes == self.unknown_code)
        if not self.bpe:  # a character without a piece of its own may be unknown
            single = np.zeros(len(codes) + 1, bool)
            single[start[size == 1]] = True
            unknown = np.flatnonzero((codes > 0) & ~single[:-1])
        none = np.full(len(unknown), _UNKNOWN, np.int32)
        start, size, piece = np.concatenate([start, unknown.astype(np.int32)]), np.concatenate([size, np.ones_like(none)]), np.concatenate([piece, none])
        unit = np.searchsorted(begin, start, side="right") - 1
        direct = np.unique(unit[(piece >= 0) & self.odd[piece]]) if self.bpe else np.empty(0, np.int64)
        # edges by the place of their end in the unit
        offset = start + size - begin[unit]
        order = np.argsort(offset, kind="stable")
        start, size, piece, offset = start[order], size[order], piece[order], offset[order]
        cuts = np.flatnonzero(np.diff(offset)) + 1
        last = np.full(len(codes) + 1, -9, np.int64)
        back = np.zeros(len(codes) + 1, np.int64)
        best = np.full(len(codes) + 1, -np.inf)
        last[begin], best[begin] = _START, 0.0
        floor = (self.scores[self.normal].min() if self.normal else 0.0) - 10.0
        for a, b in zip([0, *cuts], [*cuts, len(start)]):
            s, t, e = start[a:b], piece[a:b], start[a:b] + size[a:b]
            if self.bpe:
                ok = (last[s] != -9) & self.follows(last[s], t)
                s, t, e = s[ok], t[ok], e[ok]
            else:
                total = best[s] + np.where(t >= 0, self.scores[t], floor)
                # best total last, then the longest piece, so that it wins the assignment
                by = np.lexsort((-s, total))
                s, t, e, total = s[by], t[by], e[by], total[by]
                best[e] = total
            last[e], back[e] = t, s
        # walk back from the ends, all units side by side
        found_unit, found_piece, found_at = [], [], []
        at, live = end.copy(), np.arange(len(units))
        while len(live):
            here = at[live]
            found_unit.append(live)
            found_piece.append(last[here])
            found_at.append(back[here])
            at[live] = back[here]
            live = live[at[live] > begin[live]]
        fu, fp, fa = np.concatenate(found_unit), np.concatenate(found_piece), np.concatenate(found_at)
        order = np.lexsort((fa, fu))
        fp, fa = fp[order], fa[order]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(fu, minlength=len(units)))])
        out = [fp[bounds[i] : bounds[i + 1]] for i in range(len(units))]
        for i in np.unique(fu[order][fp == _UNKNOWN]):
            ids: list[int] = []
            for p, q in zip(out[i], fa[bounds[i] : bounds[i + 1]]):
                ids += [int(p)] if p >= 0 else self.fallback(chr(cp[q]))
            out[i] = np.array(ids)
        for i in direct:
            out[i] = np.array([x for s in self.merge(units[i])[0] for x in ([self.ids[s]] if s in self.ids else self.fallback(s))])
        return out

    def fallback(self, char: str) -> list[int]:
        """The ids of a character without a piece."""
        return [self.byte_ids[b] for b in char.encode()] if self.byte_fallback else [self.unk]

    # --- texts -------------------------------------------------------------

    def encode(self, texts: list[str], known: UnitIds) -> list[np.ndarray]:
        """The ids of each text; ``known`` remembers units between calls.

        Texts are cut between neighbours that stand side by side in no piece,
        such as before a space mark or beside a character without a piece.
        """
        if self.collapse:
            texts = [" ".join(filter(None, t.split(" "))) for t in texts]
        head = SPACE if self.dummy_prefix else ""
        marked = [head + t.replace(" ", SPACE) if t else "" for t in texts]
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))])
        joined = "".join(marked)
        if not joined:
            return [np.empty(0, np.int32) for _ in texts]
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[cp].astype(np.int64)
        begin = np.ones(len(cp) + 1, bool)
        begin[1:-1] = ~self.beside[(codes[:-1] * 40_503 + codes[1:]) & (len(self.beside) - 1)]
        begin[offsets] = True
        starts = np.flatnonzero(begin[:-1])
        ends = np.append(starts[1:], len(cp))
        far = np.concatenate([[0], np.cumsum(cp > 0xFFFF)])  # characters of more than 16 bits
        exact = None if not far[-1] else far[ends] == far[starts]
        ids, size = known.ids(cp.astype("<u2"), starts, ends, lambda at: [joined[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())], self._unit_ids, exact)
        upto = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, offsets)]
        out = [ids[i:j] for i, j in zip(upto, upto[1:])]
        if not self.byte_fallback:  # a run of unknown characters is one unknown piece
            out = [x[~((x == self.unk) & np.concatenate([[False], x[:-1] == self.unk]))] if len(x) else x for x in out]
        return out

    def expected(self, text: str) -> str:
        """What decoding gives for the ids of a text that holds no unknown character."""
        text = text.replace(SPACE, " ")
        return " ".join(filter(None, text.split(" "))) if self.collapse else text

    def decode(self, ids) -> str:
        """The text of ids; the prefixed space goes, malformed bytes are replaced."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def _bound(column: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """Binary search for each value in its own sorted range of ``column``."""
    lo, hi = lo.copy(), hi.copy()
    while (live := lo < hi).any():
        mid = (lo + hi) // 2
        probe = column[np.minimum(mid, len(column) - 1)]
        up = live & ((probe <= value) if right else (probe < value))
        lo = np.where(up, mid + 1, lo)
        hi = np.where(live & ~up, mid, hi)
    return lo


_WORKER: dict = {}


def worker_model(path: str) -> tuple[PieceModel, UnitIds]:
    """The worker's model and remembered units, loaded once per process."""
    if _WORKER.get("path") != path:
        _WORKER.update(path=path, model=PieceModel(path), known=UnitIds(np.int32, CACHE_UNITS, words=4))
    return _WORKER["model"], _WORKER["known"]


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", check: bool = False) -> DataFrame:
    """(doc_id, ids) of every row; ``ids`` is an array of ints.

    A null or empty text has no ids.  With ``check`` the ids are decoded where
    they were made, and ``round_trip`` tells whether that gives the text back
    (the mark U+2581 reads as a space).  Repeated rows and null keys stay as
    they are; other columns are not read.  The model file must be at the same
    path on every executor.
    """

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        m, known = worker_model(model)
        for batch in released(batches):
            for at in range(0, batch.num_rows, 512):
                block = batch.slice(at, 512)
                for lo, hi in _slices(block.column(1).to_pylist()):
                    part = block.slice(lo, hi - lo)
                    texts = [t or "" for t in part.column(1).to_pylist()]
                    ids = m.encode(texts, known)
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    out = [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))]
                    if check:
                        out.append(pa.array([m.decode(x.tolist()) == m.expected(t) for x, t in zip(ids, texts)], pa.bool_()))
                    yield pa.RecordBatch.from_arrays(out, names)

    names = ["doc_id", "ids", "round_trip"][: 3 if check else 2]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>" + ", round_trip boolean" * check)


def _slices(texts: list, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded): adds the text of ``ids``; null ids decode to an
    empty text."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        m, _ = worker_model(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [m.decode(x or ()) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
