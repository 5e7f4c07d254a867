"""Near-duplicate detection by ProbMinHash over weighted word shingles.

A document's shingles are runs of words, weighted by how often they occur.
Each shingle sends points of a Poisson process of its weight's rate to the
registers; the first point at a register wins it, and a document's shingles
stop once no register can change any more.  Two documents agree in a register
with the probability Jaccard similarity of their weights.  Bands of registers
give candidates, and every candidate link is verified on the texts.

Exact copies are one class from the start.  Within a bucket the members first
meet one member, drawn by hash, only; what is then linked needs no further
test.  A bucket that still holds several groups is compared whole within its
task, which sends one link for each two groups that it joins.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components, join_members
from .storage import drop, stash
from .textio import flat, mix, released, shingle_hashes, slices, word_hashes, word_spans

SHINGLE = 5
THRESHOLD = 0.8
REGISTERS = 128
BAND = 4
#: Bytes of text hashed at a time.
SLICE_BYTES = 1 << 20
#: Members of a bucket, and distinct shingles of them, compared in one task;
#: larger buckets go in pairs of blocks.
BLOCK = 512
BLOCK_SHINGLES = 2_000_000
#: Pairs go to verification if their registers agree at least this much less
#: than the threshold: five standard deviations at 128 registers.
SLACK = 0.18


def weighted_shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight, row), sorted by row and hash, of the texts of one slice.

    A text of fewer words than ``size`` has one shingle of all its words; one
    without words has none.  The weight of a shingle is its count.
    """
    starts, ends, row = word_spans(data, offsets)
    h, r = shingle_hashes(word_hashes(data, starts, ends, seed), row, size)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    if not len(h):
        return h, np.empty(0), r
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(first)
    return h[at], np.diff(np.append(at, len(h))).astype(np.float64), r[at]


def signatures(h: np.ndarray, w: np.ndarray, row: np.ndarray, n: int, m: int = REGISTERS, seed: int = 1) -> np.ndarray:
    """(n, m) uint32 registers; all ones where a text has no shingles.

    A register holds the float32 time of its first point above 32 bits of the
    shingle that sent it, so one integer minimum keeps both.
    """
    registers = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    if not len(h):
        return np.full((n, m), 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        base = mix(h ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        tag = h & np.uint64(0xFFFFFFFF)
        time, live, step, many = np.zeros(len(h)), np.arange(len(h)), 0, 1
        while len(live):
            # the next points of the shingles that may still win a register
            k = np.arange(step, step + many, dtype=np.uint64) + np.uint64(1)
            x = mix(base[live][:, None] + k[None, :] * np.uint64(0xD1342543DE82EF95))
            gap = -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            t = time[live][:, None] + np.cumsum(gap, axis=1) / w[live][:, None]
            place = (mix(x) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
            key = (t.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | tag[live][:, None]
            np.minimum.at(registers, (row[live][:, None] * m + place.astype(np.int64)).ravel(), key.ravel())
            time[live] = t[:, -1]
            # early termination: the latest first point of a text's registers
            stop = (registers.reshape(n, m).max(axis=1) >> np.uint64(32)).astype(np.uint32).view(np.float32)
            limit = np.where(np.isnan(stop), np.inf, stop)[row[live]]
            live = live[time[live] <= limit]
            step += many
            many = max(1, min(2 * many, 64, 250_000 // max(1, len(live))))
    return (registers & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(n, m)


def prob_jaccard(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    """The probability Jaccard similarity of two weighted sets (sorted hashes).

    The sum over common shingles i of 1 / sum_j max(x_j / x_i, y_j / y_i) is
    taken over the distinct pairs of weights, of which there are few.
    """
    if not len(h1) or not len(h2):
        return 0.0
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = w1[i], w2[j]
    only1, only2 = w1.sum() - x.sum(), w2.sum() - y.sum()
    pair, times = np.unique(np.stack([x, y], 1), axis=0, return_counts=True)
    px, py = pair[:, 0], pair[:, 1]
    order = np.argsort(px / py, kind="stable")
    px, py, times = px[order], py[order], times[order]
    # max(x_j / x_i, y_j / y_i) is the first where x_j / y_j >= x_i / y_i
    sx = np.cumsum((px * times)[::-1])[::-1]
    sy = np.concatenate([[0.0], np.cumsum(py * times)[:-1]])
    return float((times / ((sx + only1) / px + (sy + only2) / py)).sum())


def _bands(sig: np.ndarray, band: int) -> np.ndarray:
    """(rows, bands) 64-bit hashes, each of one band's registers and number."""
    n, m = sig.shape
    with np.errstate(over="ignore"):
        out = np.empty((n, m // band), np.uint64)
        for b in range(m // band):
            h = np.full(n, b + 1, np.uint64)
            for k in range(band):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * band + k])
            out[:, b] = h
    return out


def _weights(w: np.ndarray) -> bytes | None:
    """Weights as bytes; None if all are one, as they are for most texts."""
    return None if (w == 1).all() else w.astype("<u4").tobytes()


def sign(docs: DataFrame, key: Column, text: str = "text", size: int = SHINGLE, registers: int = REGISTERS, band: int = BAND, seed: int = 1) -> DataFrame:
    """(key, bands, size) of every row with a word; size is the number of its
    distinct shingles."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in released(batches):
            for lo, rows, h, w, row, _ in _shingled(batch, size):
                bands = _bands(signatures(h, w, row, len(rows), registers, seed), band).view(np.int64)
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * bands.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows + lo)), pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())), pa.array(np.bincount(row, minlength=len(rows)))], ["key", "bands", "size"])

    return docs.select(key.alias("key"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL").mapInArrow(run, "key binary, bands array<long>, size long")


def _shingled(batch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]]:
    """(first row, rows with a word, hash, weight, place in rows, the slice) of
    slices of a batch of (key, text)."""
    data, offsets = flat(batch.column(1))
    for lo, hi in slices(offsets, SLICE_BYTES):
        piece = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        h, w, row = weighted_shingles(*piece, size)
        keep = np.unique(row)
        if len(keep):
            yield lo, keep, h, w, np.searchsorted(keep, row), piece


def shingle_table(texts: DataFrame, size: int = SHINGLE, registers: int = REGISTERS, seed: int = 1, secret: int = 0) -> DataFrame:
    """(key, h, w, sig) of (key, text): sorted shingle hashes under ``secret``,
    weights (null if all are one) and registers, as bytes."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in released(batches):
            for lo, rows, h, w, row, piece in _shingled(batch, size):
                sig = signatures(h, w, row, len(rows), registers, seed)
                if secret:
                    h, w, row = weighted_shingles(*piece, size, secret)
                    row = np.searchsorted(rows, row)
                cut = np.searchsorted(row, np.arange(len(rows) + 1))
                spans = list(zip(cut, cut[1:]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows + lo)), pa.array([h[i:j].tobytes() for i, j in spans], pa.binary()),
                     pa.array([_weights(w[i:j]) for i, j in spans], pa.binary()), pa.array([x.tobytes() for x in sig], pa.binary())], ["key", "h", "w", "sig"])

    return texts.select("key", "text").mapInArrow(run, "key binary, h binary, w binary, sig binary")


def _unpack(h: bytes, w: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.frombuffer(h, np.uint64)
    return hashes, np.ones(len(hashes)) if w is None else np.frombuffer(w, "<u4").astype(np.float64)


def verify(pairs: DataFrame, shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``pairs`` (a, b) that reach ``threshold``.

    Both joins are by key; a hub's rows are split by adaptive execution.
    """
    side = lambda n: shingles.select(F.col("key").alias(n), F.col("h").alias(f"h{n}"), F.col("w").alias(f"w{n}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ha", "wa", "hb", "wb")

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            good = [i for i, (ha, wa, hb, wb) in enumerate(zip(*columns)) if prob_jaccard(*_unpack(ha, wa), *_unpack(hb, wb)) >= threshold]
            yield batch.select([0, 1]).take(pa.array(good, pa.int64()))

    return both.mapInArrow(run, "a binary, b binary")


def join_groups(keys: list, roots: np.ndarray, sigs: np.ndarray, hashes: list[np.ndarray], weights: list, threshold: float) -> list[tuple[int, int]]:
    """Links that join the groups of one bucket: each pair of members of
    different groups is tested unless its groups are joined by then.

    Registers rule out what is far below the threshold; the rest is compared
    on all shingles, one member against all others at a time.  With weights
    that sum to one, let m be the sum of the smaller weights: the probability
    Jaccard similarity is at most m and at least m / (2 - m), and only pairs
    that this leaves open are summed up one by one.
    """
    n = len(keys)
    codes, flat_codes = np.unique(np.concatenate(hashes), return_inverse=True)
    sizes = np.fromiter(map(len, hashes), np.int64, n)
    starts = np.cumsum(sizes) - sizes
    plain = np.fromiter((w is None for w in weights), bool, n)
    full = [_weight_array(w, s) for w, s in zip(weights, sizes)]
    share = np.concatenate([w / w.sum() for w in full])
    need = (threshold - SLACK) * sigs.shape[1]
    group, links = roots.copy(), []
    mark, part = np.zeros(len(codes), np.int32), np.zeros(len(codes))
    largest = np.bincount(roots).argmax()
    open_ = roots == largest  # members of the largest group are met by the others
    for i in np.flatnonzero(roots != largest):
        if (group == group[i]).all():
            break  # all are one group
        may = (group != group[i]) & (open_ | (np.arange(n) > i))
        may[may] = (sigs[may] == sigs[i]).sum(axis=1) >= need
        near = np.flatnonzero(may)
        if not len(near):
            continue
        here = slice(starts[i], starts[i] + sizes[i])
        mine = flat_codes[here]
        mark[mine] = 1
        common = np.add.reduceat(mark[flat_codes], starts)[near]
        mark[mine] = 0
        low = high = common / (sizes[i] + sizes[near] - common)
        if not (plain[i] and plain[near].all()):
            part[mine] = share[here]
            m = np.add.reduceat(np.minimum(part[flat_codes], share), starts)[near] + 1e-9
            part[mine] = 0
            exact = plain[near] & plain[i]
            low, high = np.where(exact, low, (m - 2e-9) / (2 - m)), np.where(exact, high, m)
        for k in np.flatnonzero(high >= threshold)[np.argsort(-low[high >= threshold], kind="stable")]:
            j = near[k]
            if group[j] != group[i] and (low[k] >= threshold or not (plain[i] and plain[j]) and prob_jaccard(hashes[i], full[i], hashes[j], full[j]) >= threshold):
                links.append((min(i, j), max(i, j)))
                group[group == group[j]] = group[i]
    return links


def _weight_array(w: bytes | None, n: int) -> np.ndarray:
    return np.ones(n) if w is None else np.frombuffer(w, "<u4").astype(np.float64)


def bucket_links(members: DataFrame, threshold: float, registers: int) -> DataFrame:
    """(a, b) that join groups of the buckets in ``members``
    (bucket, n, shingles, key, root, h, w, sig).

    A bucket of at most ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles is one
    task's group.  A larger one is dealt into blocks, and each pair of blocks is
    a group, so any bucket is compared whole, in memory that its longest texts
    bound.
    """
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(BLOCK)), F.ceil(F.col("shingles") / F.lit(BLOCK_SHINGLES))).cast("int")
    dealt = members.withColumn("_k", blocks).withColumn("_mine", F.pmod(F.xxhash64("key"), F.col("_k")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    dealt = dealt.select("bucket", F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("j"), "key", "root", "h", "w", "sig")

    def compare(pdf):
        import pandas as pd

        pdf = pdf.sort_values("key").reset_index(drop=True)
        keys, hashes = pdf["key"].tolist(), [np.frombuffer(x, np.uint64) for x in pdf["h"]]
        sigs = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), registers)
        links = join_groups(keys, pd.factorize(pdf["root"])[0], sigs, hashes, [None if w is None or w is pd.NA else w for w in pdf["w"]], threshold)
        return pd.DataFrame({"a": [keys[i] for i, _ in links], "b": [keys[j] for _, j in links]}, dtype=object)

    return dealt.groupBy("bucket", "i", "j").applyInPandas(compare, "a binary, b binary").distinct()


def text_key(text: Column) -> Column:
    """A key of a text, the first 128 bits of its SHA-256; null for a null text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def maybe_in(rows: DataFrame, keys: DataFrame, column: str, bits: int = 1 << 23, negate: bool = False) -> DataFrame:
    """The rows whose key may be among ``keys``: a filter by one bitmap; or, if
    ``negate``, all other rows, those with a null key too.

    The bitmap has ``bits`` bits however many keys there are, so the broadcast
    is bounded by bits / 64 rows.  It lets every true key pass; the join that
    follows is exact.
    """
    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(bits))

    marks = keys.select(place(column).alias("_at")).select(F.shiftright("_at", 6).alias("_word"), F.expr("shiftleft(1L, cast(_at & 63 as int))").alias("_bit"))
    marks = marks.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    names = rows.columns
    rows = rows.withColumn("_at", place(column))
    hit = F.expr("(shiftright(_bits, cast(_at & 63 as int)) & 1L) = 1L")
    if negate:
        known = F.col(column).isNotNull() & F.coalesce(hit, F.lit(False))
        return rows.join(F.broadcast(marks), F.shiftright("_at", 6) == F.col("_word"), "left").where(~known).select(*names)
    return rows.join(F.broadcast(marks), F.shiftright("_at", 6) == F.col("_word")).where(hit).select(*names)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD,
                    registers: int = REGISTERS, band: int = BAND) -> DataFrame:
    """(doc_id, class_id, n_copies, kept, key, root) for every row of ``docs``.

    Two rows are in one class if their texts are equal, reach the threshold,
    or are joined by a chain of such links.  ``class_id`` is the least
    ``doc_id`` of the class, ``n_copies`` the number of its rows, and ``kept``
    marks the rows of that least id (if rows repeat an id and a text, all).
    ``key`` stands for the row's text and ``root`` for its class.

    A null text is a class of its own under its own id.  Equal texts without
    words are one class; they link with nothing else.  Rows with a null key
    take part; a class of null keys only has a null class_id and is kept.  An
    empty table gives an empty result; other columns are not read.

    At a similarity of 0.8, 128 registers in bands of 4 miss a pair with
    probability (1 - 0.8**4)**32 = 5e-8.  Links are verified on 64-bit hashes of
    shingles under a secret drawn for each run, which nobody can write
    colliding texts for.
    """
    secret = secrets.randbits(63) | 1
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).cast("string").alias("text"))
    signed = stash(sign(rows, F.col("key"), "text", size, registers, band), "signatures")
    hashes = signed.select("key", "size", F.explode("bands").alias("bucket")).withColumn("r", F.xxhash64("key", "bucket"))
    buckets = hashes.groupBy("bucket").agg(F.min("r").alias("first"), F.max("r").alias("last")).where("first != last")
    members = stash(hashes.join(buckets.select("bucket", "first"), "bucket").groupBy("bucket", "key").agg(F.min("r").alias("r"), F.min("first").alias("first"), F.max("size").alias("size")), "members")
    # every member meets the one that the bucket draws
    drawn = members.where("r = first").select("bucket", F.col("key").alias("c"))
    stars = members.where("r != first").join(drawn, "bucket").select(F.least("c", "key").alias("a"), F.greatest("c", "key").alias("b")).distinct()
    named = members.select("key").distinct()
    some = maybe_in(rows.where("key IS NOT NULL").select("key", "text"), named, "key")
    shingles = stash(shingle_table(some.groupBy("key").agg(F.first("text").alias("text")).join(named, "key"), size, registers, secret=secret), "shingles")
    links = stash(verify(stars, shingles, threshold), "links")
    roots = connected_components(links)
    # buckets that still hold several groups
    grouped = members.join(roots, members["key"] == roots["node"], "left").select("bucket", "key", "size", F.coalesce("root", "key").alias("root"))
    grouped = stash(grouped, "grouped")
    several = grouped.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("n > 2 AND lo != hi").select("bucket", "n", "shingles")
    left = grouped.drop("size").join(several, "bucket").join(shingles, "key")
    more = stash(bucket_links(left, threshold, registers), "links")
    if not more.isEmpty():
        roots = connected_components(links.unionByName(more))
    out = classes(rows.select("doc_id", "key"), roots)
    drop(signed, members, shingles, links, grouped, more)  # the classes are written
    return out


def classes(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Class columns of the rows (doc_id, key), given each linked key's root."""
    per_key = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    per_key = per_key.join(roots, per_key["key"] == roots["node"], "left").select("key", "least", "n", F.coalesce("root", "key").alias("root"))
    per_key = stash(per_key, "classes")
    per_root = per_key.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("n_copies"), F.count("*").alias("keys"))
    per_key = stash(join_members(per_key, per_root, "keys").select("key", "root", "class_id", "n_copies"), "classes")
    out = rows.join(per_key, "key", "left")
    alone = F.col("key").isNull()
    out = out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "key", "root")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each class.

    Of rows that repeat the kept id, one stays.  Rows with a null text stay.
    """
    from pyspark.sql.window import Window

    found = near_duplicates(docs, key, text, **how)
    # a class keeps one text: the least key among those of its least id
    one = found.where("kept AND key IS NOT NULL").groupBy("root").agg(F.min("class_id").alias("_id"), F.min("key").alias("_key"))
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(key).cast("long").alias("_id"), text_key(F.col(text)).alias("_key"))
    kept = rows.where("_key IS NOT NULL").alias("r").join(one.alias("o"), F.col("r._id").eqNullSafe(F.col("o._id")) & (F.col("r._key") == F.col("o._key"))).select("r.*")
    kept = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_key").orderBy(F.xxhash64("_row")))).where("_n = 1").select("_row")
    kept = kept.unionByName(rows.where("_key IS NULL").select("_row"))
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
