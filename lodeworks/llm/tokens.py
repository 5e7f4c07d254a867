"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned by key, so shard files in order of partition
hold the documents in ascending order.  Each shard has three flat files:

* ``part-N.tok``  token ids, little-endian unsigned 16 or 32 bit
* ``part-N.off``  offsets of documents in tokens, n + 1 little-endian int64
* ``part-N.doc``  document keys, n little-endian int64

The base of a shard is the prefix sum of the token counts of those before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import map_array, scratch, write_bytes
from .textio import flat, slices
from .unitcache import UnitIds

#: Distinct units whose ids a worker remembers, and bytes of text encoded at a time.
CACHE_UNITS = 800_000
SLICE_BYTES = 1 << 20
_STATE: dict = {}


#: First bytes of the UTF-8 of white space beyond ASCII; a letter may begin with them too.
_MAYBE_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_WORD = np.array([chr(i).isalnum() for i in range(128)] + [False] * 128)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin in UTF-8 bytes of texts: places that the byte-level
    pre-tokenizer always cuts.

    These are starts of texts, spaces before what is not white space, both
    sides of a line end between others, and full stops and commas after a
    letter or digit.  Characters beyond ASCII count as letters only if they are
    sure to be (two bytes from 0xC3, without the two signs there), and as white
    space if they may be.
    """
    n = len(data)
    begin = np.zeros(n + 1, bool)
    begin[offsets] = True
    if not n:
        return np.empty(0, np.int64)
    edge = begin.copy()
    blank, word = _BLANK[data], _WORD[data]
    if n > 1:
        letter = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        word[1:] |= letter
    after = np.ones(n, bool)  # the next byte, of the same text, is surely not white space
    after[:-1] = ~blank[1:] & ~_MAYBE_SPACE[data[1:]]
    after[edge[1:]] = False
    before = np.zeros(n, bool)  # the byte before, of the same text, ends a letter or digit
    before[1:] = word[:-1]
    before[edge[:n]] = False
    plain = np.zeros(n, bool)  # the byte before is surely not white space
    plain[1:] = word[:-1] | ((data[:-1] < 128) & ~blank[:-1])
    plain[edge[:n]] = False
    begin[:n] |= (data == 32) & after
    line = (data == 10) & plain & after
    begin[:n] |= line
    begin[1:] |= line
    begin[:n] |= ((data == 46) | (data == 44)) & before
    return np.flatnonzero(begin[:n])


class Encoder:
    """Ids of texts, with a bounded memory of units."""

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        self.tok, self.known = Tokenizer.from_file(path), UnitIds(dtype, CACHE_UNITS, words=3)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each), from UTF-8 bytes."""
        starts = cuts(data, offsets)
        if not len(starts):
            return np.empty(0, self.known.dtype), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        raw = data.tobytes()

        def spell(at: np.ndarray) -> list[str]:
            return [raw[i:j].decode() for i, j in zip(starts[at].tolist(), ends[at].tolist())]

        def new(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
            parts, counts = [], []
            for lo in range(0, len(units), 20_000):
                ids = [e.ids for e in self.tok.encode_batch_fast(units[lo : lo + 20_000], add_special_tokens=False)]
                counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                parts.append(np.fromiter(chain.from_iterable(ids), self.known.dtype, int(counts[-1].sum())))
            return np.concatenate(parts), np.concatenate(counts)

        ids, size = self.known.ids(data, starts, ends, spell, new)
        upto = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(upto[np.searchsorted(starts, offsets)])


def encoder(path: str, dtype: str) -> Encoder:
    """The worker's encoder; loaded once and kept between tasks."""
    if _STATE.get("key") != (path, dtype):
        _STATE.update(key=(path, dtype), enc=Encoder(path, dtype))
    return _STATE["enc"]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text",
                      end_id: int = 0, dtype: str = "<u2", shards: int | None = None) -> DataFrame:
    """Encode every text and write the shards; returns one row per shard:
    (part, path, docs, nulls, tokens).

    ``dtype`` must hold the tokenizer's ids.  A null or empty text has only the
    end id.  Null keys come first and are counted in ``nulls``.  Rows of equal
    key stand in order of their texts.  ``shards`` defaults to Spark's number
    of shuffle partitions, which adaptive execution may lower.  The tokenizer file must be at the same path on
    every executor.
    """
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    order = F.col("k").asc_nulls_first()
    rows = (rows.repartitionByRange(shards, order) if shards else rows.repartitionByRange(order)).sortWithinPartitions(order, F.col("t").asc_nulls_first())

    def write(batches: Iterable) -> Iterator:
        import pyarrow as pa

        part, enc = TaskContext.get().partitionId(), encoder(tokenizer, dtype)
        end = np.dtype(dtype).type(end_id)
        path, keys, sizes, nulls = f"{folder}/part-{part:06d}", [], [], 0

        def chunks():
            nonlocal nulls
            for batch in batches:
                ks = batch.column(0)
                nulls += ks.null_count
                keys.append(np.array(ks.fill_null(0).to_numpy(zero_copy_only=False), "<i8"))
                data, offsets = flat(batch.column(1))
                for lo, hi in slices(offsets, SLICE_BYTES):
                    ids, size = enc.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    sizes.append(size + 1)
                    # the end id goes behind each text
                    yield np.insert(ids, np.cumsum(size), end).tobytes()

        write_bytes(f"{path}.tok", chunks())
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))] if sizes else [[0]]).astype("<i8")
        write_bytes(f"{path}.off", [offsets.tobytes()])
        write_bytes(f"{path}.doc", [np.concatenate(keys).tobytes() if keys else b""])
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "path": [path], "docs": pa.array([len(offsets) - 1], pa.int64()),
                                          "nulls": pa.array([nulls], pa.int64()), "tokens": pa.array([int(offsets[-1])], pa.int64())})

    return rows.mapInArrow(write, "part long, path string, docs long, nulls long, tokens long")


def read_token_files(shards: DataFrame, dtype: str = "<u2") -> DataFrame:
    """Per document, from the files: (doc_id, start, n_tokens, ids_crc32).

    ``shards`` has (path, base, nulls); tokens are memory-mapped.
    """

    def read(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for path, base, nulls in zip(*(batch.column(i).to_pylist() for i in range(3))):
                tok, off, doc = map_array(f"{path}.tok", dtype), map_array(f"{path}.off", "<i8"), map_array(f"{path}.doc", "<i8")
                for lo in range(0, len(doc), 10_000):
                    hi = min(len(doc), lo + 10_000)
                    crc = [zlib.crc32(np.asarray(tok[off[i] : off[i + 1]], "<u4").tobytes()) for i in range(lo, hi)]
                    ids = pa.array(np.asarray(doc[lo:hi]), pa.int64(), mask=np.arange(lo, hi) < nulls)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.asarray(off[lo:hi]) + base), pa.array(np.diff(off[lo : hi + 1])), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("path", "base", "nulls").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize_to_files(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0, dtype: str = "<u2", shards: int | None = None) -> tuple[str, DataFrame]:
    """Write the files below shared storage; (folder, shard table with bases).

    The table holds one row a shard; its prefix sums are taken on the driver.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "tokens")
    write_token_files(docs, folder, tokenizer, key, text, end_id, dtype, shards).write.parquet(f"{folder}-index")
    rows, base = [], 0
    for r in sorted(spark.read.parquet(f"{folder}-index").collect()):  # one row a shard
        rows.append((r["path"], base, r["nulls"], r["docs"], r["tokens"]))
        base += r["tokens"]
    schema = "path string, base long, nulls long, docs long, tokens long"
    table = spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), schema) if rows else spark.createDataFrame([], schema)
    return folder, table
