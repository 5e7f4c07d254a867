"""Language-model scoring by prediction by partial matching (PPM).

A byte-context trie predicts every byte of a document, read as its words with
one space between them, from up to ``DEPTH`` bytes before, across words and back
to the document's start.  A context that
has not seen the next byte escapes to the next shorter one (method C: the
escape counts as often as the context has distinct bytes), and bytes that the
longer context has seen are excluded there.  Below order 0 the bytes left are
equally likely.  The trie is trained once, on the training documents, one for
each class of documents; a text's code length is that of its class plus that of
naming the class.

The class of a text is that whose trie of orders 0 and 1, at most 65,792 nodes,
codes it best; so every text is scored by one trie.

A byte's context and class alone decide its code length, so each distinct window
(class, context and the byte after it) is scored once.  Documents are first cut
into chunks; the distinct windows of a chunk go out in parts by hash, and are
summed there over all chunks.  The sums are dealt by class and the last two bytes
of context, or three where two are very frequent: all contexts that a window
escapes to end in them but the shortest ones, which are sent to every task.  So
no count is dropped, and no task holds the whole trie.  Every chunk gets back the
scores of its own windows and adds them up along its documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import crc_mod
from .storage import stash
from .textio import mix

#: Bytes of context; a window of them and the next byte fits in 48 bits.
DEPTH = 5
#: Text that makes a part of the windows, in bytes: their number grows with the input.
PART_BYTES = 32 << 20
#: Classes of the model: the most frequent languages, and one for all other training documents.
MAX_CLASSES = 15
#: Distinct windows of a class that one task scores; more are dealt by another byte of context.
HOT_WINDOWS = 2_000_000
#: Text of a chunk, in bytes.
CHUNK_BYTES = 8 << 20
#: Text whose windows are made at a time, in bytes.
SLICE_BYTES = 1 << 20
#: Windows of slices that wait to be summed.
WAITING = 400_000
#: Scores of windows travel as whole numbers of this part of a decimal digit.
_UNIT = 2.0**-32
#: Where the class stands in a key, above the window.
_CLASS = np.uint64(52)
_WINDOW = np.uint64((1 << 52) - 1)
END = b"\n"
_ALPHABET = 257.0


def _spell(words: list[bytes]) -> list[bytes]:
    """Each word between the spaces around it; the end of a text is a symbol by itself."""
    return [b" " + w + (b"" if w == END else b" ") for w in words]


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(window, text) of every symbol of the texts but the first of each: the
    context's length in bits 48 to 50, below it the context and the symbol."""
    window = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size) - size
    data = window.copy()
    for k in range(1, DEPTH + 1):
        window[k:] |= data[:-k] << np.uint64(8 * k)
    starts = [begin[size > k] + k for k in range(1, DEPTH)]
    short = [_shorten(window[at], k) for k, at in enumerate(starts, 1)]
    window |= np.uint64(DEPTH << 48)
    for at, w in zip(starts, short):
        window[at] = w
    keep = np.ones(len(window), bool)
    keep[begin] = False
    return window[keep], np.repeat(np.arange(len(texts)), size - 1)


def _shorten(window: np.ndarray, order: int) -> np.ndarray:
    """The windows of that order (context bytes) inside longer ones."""
    return (window & np.uint64((1 << 8 * (order + 1)) - 1)) | np.uint64(order << 48)


def _merge(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and their sums by class."""
    if not len(keys):
        return keys, sums
    by = np.argsort(keys, kind="stable")
    keys = keys[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(sums[by], first, axis=0)


def all_orders(keys: np.ndarray, sums: np.ndarray, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(node, counts by class), of all orders from ``least`` on, of windows."""
    order = (keys >> np.uint64(48)).astype(np.int64)
    out = [_merge(_shorten(keys[order >= k], k), sums[order >= k]) for k in range(DEPTH, least - 1, -1)]
    return np.concatenate([k for k, _ in out]), np.concatenate([n for _, n in out])


def count_windows(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, counts by class), of all orders, summed over the words."""
    window, word = _windows(_spell(words))
    return all_orders(*_merge(window, counts[word]))


@dataclass
class Trie:
    """One class's trie: sorted nodes with counts; sorted contexts with their
    totals, distinct bytes, and what their bytes sum to in the next shorter one."""

    nodes: np.ndarray
    count: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    shorter: np.ndarray

    @classmethod
    def build(cls, nodes: np.ndarray, count: np.ndarray) -> Trie:
        by = np.argsort(nodes)
        nodes, count = nodes[by], count[by].astype(np.float64)
        order = (nodes >> np.uint64(48)).astype(np.int64)
        context = ((nodes & np.uint64((1 << 48) - 1)) >> np.uint64(8)) | (order.astype(np.uint64) << np.uint64(48))
        contexts, at = np.unique(context, return_inverse=True)
        total = np.bincount(at, count, len(contexts))
        distinct = np.bincount(at, minlength=len(contexts)).astype(np.float64)
        # every node's count one order lower; it is there, being no smaller
        below = np.zeros(len(nodes))
        for k in range(1, DEPTH + 1):
            here = order == k
            below[here] = count[np.searchsorted(nodes, _shorten(nodes[here], k - 1))]
        return cls(nodes, count, contexts, total, distinct, np.bincount(at, below, len(contexts)))

    def window_scores(self, windows: np.ndarray) -> np.ndarray:
        """log10 of the probability of each window's last byte."""
        n = len(windows)
        out = np.zeros(n)
        if not len(self.nodes):
            return np.full(n, -np.log10(_ALPHABET))
        order = (windows >> np.uint64(48)).astype(np.int64)
        live = np.arange(n)
        seen_total, seen_distinct = np.zeros(n), np.zeros(n)
        for k in range(DEPTH, -1, -1):
            here = live[order[live] >= k]
            if not len(here):
                continue
            w = _shorten(windows[here], k)
            c = ((w & np.uint64((1 << 48) - 1)) >> np.uint64(8)) | np.uint64(k << 48)
            at = np.minimum(np.searchsorted(self.contexts, c), len(self.contexts) - 1)
            known = self.contexts[at] == c
            here, w, at = here[known], w[known], at[known]
            node = np.minimum(np.searchsorted(self.nodes, w), len(self.nodes) - 1)
            hit = self.nodes[node] == w
            # what longer contexts have seen is excluded
            distinct = self.distinct[at] - seen_distinct[here]
            total = self.total[at] - seen_total[here] + distinct
            got = here[hit]
            out[got] += np.log10(self.count[node[hit]] / total[hit])
            miss = ~hit & (distinct > 0)
            out[here[miss]] += np.log10(distinct[miss] / total[miss])
            seen_total[here], seen_distinct[here] = self.shorter[at], self.distinct[at]
            live = np.setdiff1d(live, got, assume_unique=True)
        out[live] -= np.log10(_ALPHABET - seen_distinct[live])
        return out


def score_words(tries: list[Trie], words: list[bytes]) -> np.ndarray:
    """(words, classes) log10 probabilities; each distinct window is looked up once."""
    window, word = _windows(_spell(words))
    keys, inverse = np.unique(window, return_inverse=True)
    return np.stack([np.bincount(word, t.window_scores(keys)[inverse], len(words)) for t in tries], 1)


# --- documents -> chunks ---------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; words of several bytes go byte plane by plane."""
    import zstandard

    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes()
        out.append(np.array([len(a)], "<i8").tobytes() + np.dtype(a.dtype).str.encode().ljust(8) + planes)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(raw: bytes) -> list[np.ndarray]:
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(raw), 0, []
    while at < len(data):
        n, kind = int(np.frombuffer(data, "<i8", 1, at)[0]), np.dtype(data[at + 8 : at + 16].decode().strip())
        at += 16
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def _stream(text: bytes) -> bytes:
    """What the symbols of a document are read from: its words, a space around
    each, and its end in one.  Contexts go back to its start, across words."""
    return b" ".join([b"", *text.lower().split(), END])


def _slices(lengths: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``SLICE_BYTES`` each."""
    lo = hi = size = 0
    for n in lengths:
        hi, size = hi + 1, size + n
        if size >= SLICE_BYTES:
            yield lo, hi
            lo, size = hi, 0
    if hi > lo:
        yield lo, hi


def _part(window: np.ndarray, parts: int) -> np.ndarray:
    return (mix(window) % np.uint64(parts)).astype(np.int64)


def _class_of(stream: np.ndarray, pair: np.ndarray, n: int, table: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The class that codes each of ``n`` streams best by orders 0 and 1."""
    coded = np.stack([np.bincount(stream, row[pair], n) for row in table])
    return (coded + prior[:, None]).argmax(axis=0)


def _pairs(rows: DataFrame, n_classes: int) -> DataFrame:
    """(class, pair, n): how often two bytes follow each other in the streams
    of the training documents of each class, from (class, text)."""

    def count(batches: Iterable) -> Iterator:
        import pyarrow as pa

        total = np.zeros(n_classes << 16, np.int64)
        for batch in batches:
            kind, at = batch.column(0).to_numpy(), 0
            for texts in _text_slices(batch.column(1)):
                window, doc = _windows([_stream(t) for t in texts])
                total += np.bincount((kind[at + doc].astype(np.int64) << 16) | (window & np.uint64(0xFFFF)).astype(np.int64), minlength=len(total))
                at += len(texts)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"class": pa.array(seen >> 16, pa.int32()), "pair": pa.array(seen & 0xFFFF, pa.int32()), "n": pa.array(total[seen])})

    return rows.mapInArrow(count, "class int, pair int, n long").groupBy("class", "pair").agg(F.sum("n").alias("n"))


def _text_slices(column) -> Iterator[list[bytes]]:
    """The texts of an Arrow column, some at a time."""
    for i in range(0, len(column), 64):
        yield [(t or "").encode() for t in column.slice(i, 64).to_pylist()]


def _word_parts(words: list[bytes], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the words in order of their part, bounds of the parts there)."""
    of = np.fromiter((crc32(w) % parts for w in words), np.int64, len(words))
    by = np.argsort(of, kind="stable")
    return by, np.searchsorted(of[by], np.arange(parts + 1))


def _chunks(docs: DataFrame, table, prior: np.ndarray, parts: int) -> DataFrame:
    """Chunks of (doc_id, text, class, held): rows (chunk, kind, part, body).

    Kind 0 are the packed documents, kind 1 the distinct words of a part and
    their counts in training documents, kind 2 the distinct windows of a part
    and theirs.  ``table`` broadcasts the code lengths of pairs by class.
    """

    def cut(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        task, seq = TaskContext.get().partitionId(), 0

        def settle():
            """The distinct windows of the waiting documents, and their training counts."""
            if not waiting:
                return
            window, doc = _windows(waiting)
            label, train = np.array(labels[len(chosen) :]), ~np.array(held[len(chosen) :], bool)
            mine = _class_of(doc, (window & np.uint64(0xFFFF)).astype(np.int64), len(waiting), table.value, prior)
            same = train & (mine == label)
            stray = np.flatnonzero((train & ~same)[doc])  # learned under another class than scored
            keys = np.concatenate([window | (mine.astype(np.uint64)[doc] << _CLASS), window[stray] | (label.astype(np.uint64)[doc[stray]] << _CLASS)])
            coded = pc.dictionary_encode(pa.array(keys))
            weight = np.concatenate([same[doc], np.ones(len(stray), bool)])
            keys, at = coded.dictionary.to_numpy(), coded.indices.to_numpy()
            sums.append((keys, np.bincount(at[weight], minlength=len(keys))))
            chosen.extend(mine.tolist())
            waiting.clear()
            if len(sums) > 1 and sum(len(k) for k, _ in sums[1:]) > WAITING:
                sums[:] = [_merge(np.concatenate([k for k, _ in sums]), np.concatenate([n for _, n in sums]))]

        def close():
            settle()
            words = np.concatenate(idx)
            lengths = np.array(sizes, np.int32)
            counts = np.bincount(words[np.repeat(~np.array(held, bool), lengths)], minlength=len(slots))
            keys = np.array([0 if i is None else i for i in ids], np.int64)
            text = list(slots)
            slots.clear()
            spans = np.fromiter(map(len, text), np.int32, len(text))
            found = [(0, 0, _pack(keys, np.array([i is None for i in ids], np.uint8), np.array(held, np.uint8), np.array(chosen, np.uint16), lengths, words.astype(np.int32), spans, np.frombuffer(b"".join(text), np.uint8)))]
            by, ends = _word_parts(text, parts)
            for p in np.flatnonzero(np.diff(ends)).tolist():
                at = by[ends[p] : ends[p + 1]]
                found.append((1, p, _pack(spans[at], np.frombuffer(b"".join([text[i] for i in at.tolist()]), np.uint8), counts[at])))
            window, n = _merge(np.concatenate([k for k, _ in sums]), np.concatenate([n for _, n in sums]))
            sums.clear()
            of = _part(window, parts)
            by = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[by], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(ends)).tolist():
                at = by[ends[p] : ends[p + 1]]
                found.append((2, p, _pack(window[at], n[at])))
            kind, part, body = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(body), (task << 24) + seq)), pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(body, pa.binary())], ["chunk", "kind", "part", "body"])

        def numbering():
            d: defaultdict = defaultdict()
            d.default_factory = d.__len__
            return d

        slots, ids, held, labels, chosen, sizes, idx, size = numbering(), [], [], [], [], [], [], 0
        waiting, sums, waiting_size = [], [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                for doc, text, label, out in zip(*(batch.column(c).slice(i, 256).to_pylist() for c in range(4))):
                    raw = (text or "").encode()
                    words = raw.lower().split()
                    words.append(END)
                    idx.append(np.fromiter(map(slots.__getitem__, words), np.int32, len(words)))
                    waiting.append(b" ".join([b"", *words]))
                    waiting_size += len(raw)
                    ids.append(doc)
                    labels.append(label)
                    held.append(out)
                    sizes.append(len(words))
                    size += len(raw)
                    if waiting_size >= SLICE_BYTES:
                        settle()
                        waiting_size = 0
                    if size >= CHUNK_BYTES:
                        yield from close()
                        seq += 1
                        slots, ids, held, labels, chosen, sizes, idx, size, waiting_size = numbering(), [], [], [], [], [], [], 0, 0
        if ids:
            yield from close()

    return docs.mapInArrow(cut, "chunk long, kind int, part int, body binary")


def _by_part(rows: DataFrame, parts: int):
    """Rows grouped by part, in as many tasks as there are parts."""
    return rows.repartition(parts, "part").groupBy("part")


def _bodies(chunk, kind: int, part, body: list[bytes]):
    import pyarrow as pa

    return pa.table({"chunk": pa.array(chunk, pa.int64()), "kind": pa.array(np.full(len(body), kind), pa.int32()), "part": pa.array(part, pa.int32()), "body": pa.array(body, pa.binary())})


def _count_words(words: DataFrame, parts: int) -> DataFrame:
    """From (part, chunk, body) of kind 1: rows (chunk, kind 1, part, body) with
    the words' counts over all chunks, and one row of each part with chunk -1
    and (tokens, distinct words) of it."""

    def total(group):
        import pyarrow as pa
        import pyarrow.compute as pc

        spans, spelled, counts = zip(*(_unpack(raw) for raw in group["body"].to_pylist()))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(spans), dtype=np.int64)])
        every = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(spelled))])
        at = pc.dictionary_encode(every).indices.to_numpy()
        n = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        cuts = np.cumsum([len(x) for x in spans])[:-1]
        bodies = [_pack(x) for x in np.split(n[at], cuts)] + [_pack(np.array([n.sum(), (n > 0).sum()]))]
        return _bodies([*group["chunk"].to_pylist(), -1], 1, np.full(len(bodies), group["part"][0].as_py()), bodies)

    return _by_part(words, parts).applyInArrow(total, "chunk long, kind int, part int, body binary")


def _sum_parts(windows: DataFrame, parts: int) -> DataFrame:
    """(part, key, n) of the distinct keys (class and window) of (part, body)."""

    def total(group):
        import pyarrow as pa

        got = [_unpack(raw) for raw in group["body"].to_pylist()]
        keys, n = _merge(np.concatenate([k for k, _ in got]), np.concatenate([n for _, n in got]))
        return pa.table({"part": pa.array(np.full(len(keys), group["part"][0].as_py()), pa.int32()), "key": keys.view(np.int64), "n": n})

    return _by_part(windows, parts).applyInArrow(total, "part int, key long, n long")


def _score_parts(sums: DataFrame, lowest: dict[int, tuple[np.ndarray, np.ndarray]], shards: int) -> DataFrame:
    """(part, body): the keys of each part, and the log10 probabilities of
    their bytes.  ``lowest`` has the nodes of orders 0 and 1 by class."""
    # a class and two bytes of context; very frequent ones are dealt by one byte more
    context = F.shiftrightunsigned("key", 52) * F.lit(1 << 16) + F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    frequent = sums.groupBy(context.alias("context")).count().where(F.col("count") > HOT_WINDOWS)
    hot = {r["context"] for r in frequent.collect()}  # at most one for every HOT_WINDOWS rows
    here = sums.withColumn("context", context)
    order = F.shiftright("key", 48).bitwiseAND(F.lit(7))
    second: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    if hot:
        is_hot = F.col("context").isin(sorted(hot)) & (order > 1)
        rows = here.where(is_hot).groupBy("context", F.col("key").bitwiseAND(F.lit(0xFFFFFF)).alias("node")).agg(F.sum("n").alias("n")).where("n > 0").toPandas()  # 256 a context
        for k, pdf in rows.groupby(rows["context"].to_numpy() >> 16):
            second[int(k)] = pdf["node"].to_numpy(np.int64).view(np.uint64) | np.uint64(2 << 48), pdf["n"].to_numpy(np.int64)
        third = F.when(is_hot & (order > 2), F.shiftright("key", 24).bitwiseAND(F.lit(0xFF))).otherwise(F.lit(-1))
    else:
        third = F.lit(-1)
    dealt = here.select("part", "key", "n", F.pmod(F.xxhash64("context", third), F.lit(shards)).alias("shard"))
    hot_contexts = np.array(sorted(hot), np.int64)

    def rate(group):
        import pyarrow as pa

        key, n = group["key"].to_numpy().view(np.uint64), group["n"].to_numpy()
        kind, window, out = (key >> _CLASS).astype(np.int64), key & _WINDOW, np.zeros(len(key))
        for k in np.unique(kind):
            mine = kind == k
            learned = mine & (n > 0)
            nodes, count = all_orders(window[learned], n[learned], 2)
            if len(hot_contexts):
                # nodes of order 2 after a frequent context are whole in no task
                node_context = (k << 16) + ((nodes >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64)
                keep = ((nodes >> np.uint64(48)) > 2) | ~np.isin(node_context, hot_contexts)
                more = second.get(int(k), (nodes[:0], count[:0]))
                nodes, count = np.concatenate([nodes[keep], more[0]]), np.concatenate([count[keep], more[1]])
            low = lowest.get(int(k), (nodes[:0], count[:0]))
            trie = Trie.build(np.concatenate([nodes, low[0]]), np.concatenate([count, low[1]]))
            out[mine] = trie.window_scores(window[mine])
        part = group["part"].to_numpy()
        by = np.argsort(part, kind="stable")
        part, units = part[by], np.rint(out / _UNIT).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        return pa.table({"part": pa.array(part[first], pa.int32()), "body": pa.array([_pack(key[at], -units[at]) for at in np.split(by, first[1:])], pa.binary())})

    return dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(rate, "part int, body binary")


def _send_back(windows: DataFrame, scored: DataFrame, parts: int) -> DataFrame:
    """(chunk, kind 2, part, body): the scores of the keys of each chunk and part."""

    def send(group):
        chunk, body = group["chunk"].to_numpy(), group["body"]
        got = [_unpack(body[i].as_py()) for i in np.flatnonzero(chunk < 0).tolist()]
        keys = np.concatenate([k for k, _ in got])
        by = np.argsort(keys)
        keys, units = keys[by], np.concatenate([x for _, x in got])[by]
        mine, bodies = np.flatnonzero(chunk >= 0), []
        for i in mine.tolist():
            window, _ = _unpack(body[i].as_py())
            bodies.append(_pack(window, units[np.searchsorted(keys, window)]))
        return _bodies(chunk[mine], 2, group["part"].to_numpy()[mine], bodies)

    both = windows.unionByName(scored.select("part", F.lit(-1).cast("long").alias("chunk"), "body"))
    return _by_part(both, parts).applyInArrow(send, "chunk long, kind int, part int, body binary")


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang", folds: int = 10, held: int = 0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every row.

    Tokens are words, lower-cased in A to Z, and the end of the text.  The
    model learns from rows whose crc32 of the key as text (null: empty) is not
    ``held`` modulo ``folds``; a null text is empty.  ``score`` is the log10
    probability of the text's byte stream, ``base_score`` that of its tokens
    under smoothed counts.  ``lang``, if given, names the classes of training
    documents only; scoring does not read it.  Rows are scored one by one,
    repeated ones too; an empty table gives an empty result; other columns are
    not read.
    """
    spark = docs.sparkSession
    out = crc_mod(F.col(key), folds) == held
    name = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), name.alias("lang"), out.alias("held"))
    # the most frequent languages of training rows; few rows come back
    top = rows.where("NOT held AND lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_CLASSES).collect()
    n_classes = len(top) + 1
    size = rows.agg(F.count(F.when(~F.col("held"), 1)).alias("train"), F.sum(F.octet_length("text")).alias("b")).first()
    docs_of = np.array([float(r["count"]) for r in top] + [0.0])
    docs_of[-1] = size["train"] - docs_of.sum()
    prior = np.log10((docs_of + 0.5) / (docs_of.sum() + 0.5 * n_classes))
    kind = F.lit(n_classes - 1)
    for k, r in enumerate(top):
        kind = F.when(F.col("lang") == r["lang"], k).otherwise(kind)
    rows = rows.select("doc_id", "text", kind.cast("int").alias("class"), "held")
    pairs = _pairs(rows.where("NOT held").select("class", "text"), n_classes).toPandas()  # at most 65,536 rows a class
    lowest, table = {}, np.full((n_classes, 1 << 16), -np.log10(_ALPHABET))
    for k, pdf in pairs.groupby("class"):
        lowest[int(k)] = nodes = all_orders(pdf["pair"].to_numpy(np.int64).view(np.uint64) | np.uint64(1 << 48), pdf["n"].to_numpy(np.int64))
        table[k] = Trie.build(*nodes).window_scores(np.arange(1 << 16, dtype=np.uint64) | np.uint64(1 << 48))
    n_parts = max(1, -(-int(size["b"] or 0) // PART_BYTES))
    cut = stash(_chunks(rows, spark.sparkContext.broadcast(table), prior, n_parts), "chunks")
    counted = stash(_count_words(cut.where("kind = 1").select("part", "chunk", "body"), n_parts), "vocabulary")
    totals = [_unpack(bytes(r["body"]))[0] for r in counted.where("chunk < 0").select("body").toLocalIterator()]  # two numbers a part
    n_train, n_distinct = (int(x) for x in np.sum(totals, axis=0)) if totals else (0, 0)
    windows = cut.where("kind = 2").select("part", "chunk", "body")
    summed = stash(_sum_parts(windows.select("part", "body"), n_parts), "windows")
    scored = _send_back(windows, _score_parts(summed, lowest, n_parts), n_parts)
    rest = cut.where("kind = 0").unionByName(counted.where("chunk >= 0")).unionByName(scored)
    scale = float(np.log10(n_train + 0.1 * (n_distinct + 1)))

    def finish(group):
        import pyarrow as pa
        import pyarrow.compute as pc

        kind, part, body = group["kind"].to_numpy(), group["part"].to_numpy(), group["body"]
        keys, nulls, held_, chosen, lengths, idx, spans, spelled = _unpack(body[int(np.flatnonzero(kind == 0)[0])].as_py())
        at = np.cumsum(spans) - spans
        spelled = spelled.tobytes()
        text = [spelled[i : i + n] for i, n in zip(at.tolist(), spans.tolist())]
        words = np.flatnonzero(kind == 1)
        count = np.empty(len(text), np.int64)
        count[_word_parts(text, n_parts)[0]] = np.concatenate([_unpack(body[i].as_py())[0] for i in words[np.argsort(part[words])].tolist()])
        starts = np.cumsum(lengths) - lengths
        base = np.add.reduceat(np.log10(count + 0.1)[idx], starts) - lengths * scale
        known = np.add.reduceat((count > 0).astype(np.int64)[idx], starts)
        got = [_unpack(body[i].as_py()) for i in np.flatnonzero(kind == 2).tolist()]
        window = np.concatenate([w for w, _ in got])
        by = np.argsort(window)
        window, s = window[by], np.concatenate([x for _, x in got])[by] * -_UNIT
        del got, by
        coded = np.zeros(len(keys))
        for lo, hi in _slices(np.add.reduceat(spans[idx] + 1, starts).tolist()):
            streams = [b" ".join([b"", *[text[j] for j in idx[starts[i] : starts[i] + lengths[i]].tolist()]]) for i in range(lo, hi)]
            mine, doc = _windows(streams)
            seen = pc.dictionary_encode(pa.array(mine | (chosen[lo:hi].astype(np.uint64)[doc] << _CLASS)))
            found = np.searchsorted(window, seen.dictionary.to_numpy())[seen.indices.to_numpy()]
            coded[lo:hi] = np.bincount(doc, s[found], hi - lo)
        return pa.table({
            "doc_id": pa.array(keys, mask=nulls.astype(bool)), "held_out": held_.astype(bool), "n_tokens": lengths.astype(np.int64), "n_known": known,
            "train_tokens": np.full(len(keys), n_train), "base_score": base, "score": coded + prior[chosen]})

    # a bounded number of chunks a task, however many there are
    tasks = max(1, -(-int(size["b"] or 0) // (2 * CHUNK_BYTES)))
    return rest.repartition(tasks, "chunk").groupBy("chunk").applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
