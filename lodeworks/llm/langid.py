"""Language identification with Viterbi spans.

Words are scored per language by character trigrams.  The scripts of a word's
letters narrow the candidates to languages seen in that script, and a Viterbi
pass with a switching penalty labels the words, so that a mixed text falls
into spans.  The language with most letters in its spans is the prediction.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import require
from .textio import released

#: Texts that a language's model is fitted on, at most (a bounded sample, by hash).
FIT_DOCS = 3000
#: Characters of text that one task turns into counts at a time.
SLICE_CHARS = 1 << 18
BUCKETS = 1 << 16
#: Cost, in natural log units, of changing the language between two words.
SWITCH = 6.0
UNDETERMINED = "und"
#: Languages that one model can hold; more labels than that are refused.
MAX_LANGS = 2000

#: First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}
_TABLES: dict = {}


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: is it a letter, its script (0: none or other), its
    lower case, is it white space."""
    if not _TABLES:
        n = 0x110000
        letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(n)), bool, n)
        lower = np.fromiter((ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(n)), np.int32, n)
        space = np.fromiter((chr(i).isspace() for i in range(n)), bool, n)
        script = np.zeros(n, np.uint8)
        for k, ranges in enumerate(SCRIPTS.values(), 1):
            for lo, hi in ranges:
                script[lo : hi + 1] = k
        _TABLES["all"] = (letter, script, lower, space)
    return _TABLES["all"]


@dataclass
class Model:
    """Log-probabilities of trigram buckets, (BUCKETS, languages) float32;
    ``seen[s, l]``: language l was seen in script s."""

    langs: list[str]
    scores: np.ndarray
    seen: np.ndarray


@dataclass
class Words:
    """The words of a slice of texts: text row, letters, script, first and last + 1 place in the trigrams."""

    row: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    grams: np.ndarray


def split_words(texts: list[str]) -> Words:
    """Words of letters (runs without white space that hold a letter), with a
    bucket for the trigram that begins at each of their characters; a blank
    stands for the gap before and after a word."""
    letter, script, lower, space = tables()
    joined = "  ".join(texts) + "  "
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32)
    ends = np.cumsum(np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts)))
    is_letter = letter[cp]
    inside = ~space[cp]
    begin = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    stop = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    if not len(begin):
        e = np.empty(0, np.int64)
        return Words(e, e, e, e, e, np.empty(0, np.int64))
    count = np.concatenate([[0], np.cumsum(is_letter)])
    n = count[stop] - count[begin]
    keep = n > 0
    begin, stop, n = begin[keep], stop[keep], n[keep]
    # everything but letters counts as a gap in the trigrams
    c = np.where(is_letter, lower[cp], 32).astype(np.uint32)
    before = np.concatenate([[32], c[:-1]]).astype(np.uint32)
    after = np.concatenate([c[1:], [32]]).astype(np.uint32)
    h = before * np.uint32(0x9E3779B1) ^ c * np.uint32(0x85EBCA6B) ^ after * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    grams = ((h >> np.uint32(12)) & np.uint32(BUCKETS - 1)).astype(np.int64)
    grams[~is_letter] = -1
    # the script of a word is that of its first letter with one
    first = np.minimum.reduceat(np.where(is_letter, np.arange(len(cp)), len(cp) - 1), np.stack([begin, np.minimum(stop, len(cp) - 1)], 1).ravel())[::2] if len(begin) else begin
    return Words(np.searchsorted(ends, begin, side="right"), n, script[cp[first]].astype(np.int64), begin, stop, grams)


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def fit(docs: DataFrame, text: str, lang: str, key: str, max_docs: int = FIT_DOCS) -> Model:
    """Fit on at most about ``max_docs`` labelled texts a language.

    The sample is by hash of the key against a rate per language, from exact
    counts of all labelled rows.  Counts of buckets are summed on the cluster:
    at most ``BUCKETS`` rows a language come back.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().limit(MAX_LANGS + 1).collect()}  # one row a language
    require(len(sizes) <= MAX_LANGS, "the labels name more languages than a model holds")
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((256, 0), bool))
    rate = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, max_docs / n))]), F.col(lang))
    u = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(u < rate).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterable) -> Iterator:
        import pyarrow as pa

        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = (batch.column(i).to_pylist() for i in (0, 1))
            order = sorted(range(len(texts)), key=lambda i: langs[i])
            langs, texts = [langs[i] for i in order], [texts[i] for i in order]
            for lo, hi in slices(texts):
                w = split_words(texts[lo:hi])
                for name in set(langs[lo:hi]):
                    mine = np.fromiter((x == name for x in langs[lo:hi]), bool, hi - lo)[w.row]
                    if not mine.any():
                        continue
                    a, b = w.lo[mine][0], w.hi[mine][-1]
                    g = w.grams[a:b]
                    grams[name] = grams.get(name, 0) + np.bincount(g[g >= 0], minlength=BUCKETS)
                    scripts[name] = scripts.get(name, 0) + np.bincount(w.script[mine], minlength=256)
        for name in grams:
            for kind, c in ((0, grams[name]), (1, scripts[name])):
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array([kind] * len(at), pa.int32()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())], ["lang", "kind", "at", "n"])

    got = sample.mapInArrow(count, "lang string, kind int, at long, n long").groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sizes)
    scores, seen = np.zeros((BUCKETS, len(langs)), np.float32), np.zeros((256, len(langs)), bool)
    for i, name in enumerate(langs):
        mine = got[got["lang"] == name]
        c = np.full(BUCKETS, 0.5)
        g = mine[mine["kind"] == 0]
        c[g["at"].to_numpy()] += g["n"].to_numpy()
        scores[:, i] = np.log(c / c.sum())
        s = mine[mine["kind"] == 1]
        total = max(1, s["n"].sum())
        seen[s["at"].to_numpy()[s["n"].to_numpy() >= 0.002 * total], i] = True
    return Model(langs, scores, seen)


def word_scores(model: Model, w: Words) -> np.ndarray:
    """(words, languages): summed log-probabilities; a language not seen in
    the word's script is ruled out, unless none was."""
    table = np.concatenate([model.scores, np.zeros((1, model.scores.shape[1]), np.float32)])
    s = np.add.reduceat(table[w.grams], np.stack([w.lo, np.minimum(w.hi, len(w.grams) - 1)], 1).ravel(), axis=0)[::2]
    allowed = model.seen[w.script]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    return np.where(allowed, s, -1e9)


def viterbi(scores: np.ndarray, start: np.ndarray, length: np.ndarray, switch: float) -> np.ndarray:
    """The best language of every word, texts side by side.

    Text i has the rows ``start[i]`` to ``start[i] + length[i]`` of ``scores``.
    As every switch costs the same, the best predecessor is the language
    itself or the best of all; ties stay, and go to the first language.
    """
    out = np.zeros(len(scores), np.int64)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    live = int((length > 0).sum())
    if not live:
        return out
    stay = np.zeros(scores.shape, bool)
    best = np.zeros(len(scores), np.int64)
    v = scores[start[:live]].astype(np.float64)
    counts = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    for k in range(1, length[0]):
        live = counts[k]
        v = v[:live]
        top = v.argmax(axis=1)
        jump = v[np.arange(live), top] - switch
        at = start[:live] + k
        stay[at] = v >= jump[:, None]
        best[at] = top
        v = np.maximum(v, jump[:, None]) + scores[at]
        # a text that ends here is settled by its last column
        done = slice(counts[k + 1] if k + 1 < len(counts) else 0, live)
        out[at[done]] = v[done].argmax(axis=1)
    single = slice(counts[1] if len(counts) > 1 else 0, counts[0])
    out[start[single]] = scores[start[single]].argmax(axis=1)
    for k in range(length[0] - 1, 0, -1):
        at = start[: counts[k]] + k
        now = out[at]
        out[at - 1] = np.where(stay[at, now], now, best[at])
    return out


def label_texts(model: Model, texts: list[str | None], switch: float = SWITCH) -> Iterator[tuple[str, float, list[tuple[str, int]], float]]:
    """(language, share of letters in it, spans, fit) of each text; spans are
    runs of words of one language with their number of words, and ``fit`` is the
    mean log-probability of a letter's trigram above that of a uniform draw:
    below 0 a text is likelier noise than any of the languages.

    The language is ``und`` with score 0 for a null text, one without a letter,
    or an empty model.  Ties go to the first language by code point.
    """
    for lo, hi in slices(t_all := [t or "" for t in texts]):
        w = split_words(t_all[lo:hi])
        n = hi - lo
        if not len(w.row) or not model.langs:
            yield from ((UNDETERMINED, 0.0, [], 0.0) for _ in range(n))
            continue
        length = np.bincount(w.row, minlength=n)
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        scored = word_scores(model, w)
        lab = viterbi(scored, start, length, switch)
        letters = np.bincount(w.row, w.letters, n)
        fit_ = np.bincount(w.row, scored[np.arange(len(lab)), lab], n) / np.maximum(letters, 1) + np.log(BUCKETS)
        share = np.zeros((n, len(model.langs)))
        np.add.at(share, (w.row, lab), w.letters)
        for i in range(n):
            if not length[i]:
                yield UNDETERMINED, 0.0, [], 0.0
                continue
            mine = lab[start[i] : start[i] + length[i]]
            cut = np.flatnonzero(np.diff(mine)) + 1
            edges = [0, *cut.tolist(), len(mine)]
            top = int(share[i].argmax())
            yield model.langs[top], float(share[i, top] / share[i].sum()), [(model.langs[mine[a]], b - a) for a, b in zip(edges, edges[1:])], float(fit_[i])


def fresh(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores before it until no column has it."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


ADDED = ("lang_pred", "score", "spans", "fit")
_KINDS = ("string", "double", "array<struct<lang:string,words:long>>", "double")


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", switch: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score, spans, fit) of each row; one row out for each in."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return with_languages(rows, model, "text", switch, ADDED).drop("text")


def with_languages(rows: DataFrame, model: Model, text: str, switch: float, names: Sequence[str]) -> DataFrame:
    """The rows with what :func:`label_texts` finds in new columns ``names``,
    which no column may have yet (see :func:`fresh`).  The model is broadcast; its
    size is bounded by ``BUCKETS`` floats a language.  Key and language are not
    inputs of a prediction."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    columns, at = [*rows.columns, *names], rows.columns.index(text)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        spans_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
        for batch in released(batches):
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                got = list(label_texts(shared.value, part.column(at).to_pylist(), switch))
                new = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                       pa.array([[{"lang": x, "words": int(k)} for x, k in g[2]] for g in got], spans_type), pa.array([g[3] for g in got], pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], columns)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"`{n}` {k}" for n, k in zip(names, _KINDS)])
    return rows.mapInArrow(run, schema)


def crc_mod(key, mod: int):
    """crc32 of the key as text, modulo ``mod`` (a null key counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held: int = 1) -> DataFrame:
    """Fit on the rows outside fold ``held`` and label every row:
    (doc_id, held_out, lang_pred, score, spans).

    A null text, or one without a letter, is ``und`` with score 0, and so is all
    if no row has a label.  Rows with a null key count as of an empty key; equal
    texts have equal labels; other columns are not read.
    """
    fold = crc_mod(F.col(key), folds)
    model = fit(docs.where(fold != held), text, lang, key)
    return predict(docs, model, key, text).select("doc_id", (crc_mod(F.col("doc_id"), folds) == held).alias("held_out"), "lang_pred", "score", "spans")
