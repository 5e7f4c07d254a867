"""Tokens, mixing, pieces, language, media and PPM against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeworks.llm import langid, media, mixing, pieces, ppm, tokens
from lodeworks.llm.queries import tokenizer_file
from lodeworks.llm.unitcache import UnitIds

DOCS = "doc_id long, text string, lang string, source string, k int, u int, size string"
#: Null, empty, blank, long, repeated and odd texts; extra columns with clashing names.
ROWS = [(3, "the cat sat. On the mat,\nthe end", "en", "b", 1, 2, "x"), (1, None, "en", "a", 1, 2, "x"), (2, "", None, None, 1, 2, "x"), (None, "no key 漢字 é x", "en", "a", 1, 2, "x"), (5, " \n\t ", "en", "", 1, 2, "x"),
        (7, "word " * 30_000, "de", "a", 1, 2, "x"), (3, "the cat sat. On the mat,\nthe end", "en", "b", 1, 2, "x"), (-4, "It's  a test...!?\n\n 12.5, x<|endoftext|>y", "en", "c", 1, 2, "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


ODD = ["a", "the", " ", "  ", "\n", "\n\n", ".", ",", "'s", "1", "_", "é", "漢", " ", " ", "\t", "<|endoftext|>", "\x1c", "́", "²", "😀", "\x85", "\r\n", "\0", " .", "×"]


def odd_texts(n, seed=1, alphabet=ODD):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(n)]


def test_token_units_never_change_ids():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from lodeworks.llm.textio import flat

    path = tokenizer_file("byte_bpe_50k.json")
    tok, enc = Tokenizer.from_file(path), tokens.Encoder(path, "<u2")
    enc.known.limit = 500  # the store forgets and starts again
    texts = odd_texts(4000)
    for lo in range(0, len(texts), 500):
        part = texts[lo : lo + 500]
        ids, size = enc.encode(*flat(pa.array(part)))
        ends = np.cumsum(size)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, size)] == [w.ids for w in tok.encode_batch(part, add_special_tokens=False)]


def thue_morse(n):
    """Two texts of n letters that polynomial hashes modulo a power of two confuse."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]


@pytest.mark.parametrize("n", [1024, 2048])
def test_units_that_collide_by_algebra(spark, n):
    import sentencepiece
    from tokenizers import Tokenizer

    texts = thue_morse(n)
    path = tokenizer_file("byte_bpe_50k.json")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = tokens.read_token_files(tokens.tokenize_to_files(rows, path)[1]).orderBy("doc_id").collect()
    want = [[*e.ids, 0] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert want[0] != want[1] and [r["ids_crc32"] for r in got] == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]
    path = tokenizer_file("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.encode(rows, path, check=True).orderBy("doc_id").collect()
    assert [r["ids"] for r in got] == lib.encode(texts) and all(r["round_trip"] for r in got)


def test_unit_store_compares_units(monkeypatch):
    """With all hashes equal the ids are still those of the unit."""
    from lodeworks.llm import unitcache

    monkeypatch.setattr(unitcache, "mix", lambda x: x * np.uint64(0))
    r = random.Random(3)
    store = UnitIds(np.int32, limit=40)
    for _ in range(20):
        units = ["".join(r.choice("ab") for _ in range(r.randint(1, 20))) for _ in range(60)]
        ends = np.cumsum([len(u) for u in units])
        starts = ends - [len(u) for u in units]
        data = np.frombuffer("".join(units).encode(), np.uint8)
        code = lambda some: [np.array([int("1" + u.replace("a", "0").replace("b", "1"), 2)] * (len(u) % 3)) for u in some]
        flat = lambda some: (np.concatenate(code(some)), np.array([len(x) for x in code(some)]))
        ids, size = store.ids(data, starts, ends, lambda at: [units[i] for i in at], flat)
        assert ids.tolist() == [x for c in code(units) for x in c.tolist()] and size.tolist() == [len(u) % 3 for u in units]


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    folder, shards = tokens.tokenize_to_files(docs, path, shards=4)
    got = sorted((tuple(r) for r in tokens.read_token_files(shards).collect()), key=lambda r: r[1])
    want, start = [], 0
    for doc, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    _, none = tokens.tokenize_to_files(empty, path)
    assert tokens.read_token_files(none).count() == 0


def brute_targets(sizes, weights, cap):
    left, total, out = dict(sizes), sum(sizes.values()), {}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    while True:
        free = {s: w for s, w in weight.items() if s not in out}
        level = (total - sum(out.values())) / sum(free.values()) if free else 0
        over = [s for s in free if level * weight[s] > cap * left[s]]
        if not over:
            return {**out, **{s: level * w for s, w in free.items()}}
        out.update({s: cap * left[s] for s in over})


def test_mix(spark):
    r = random.Random(5)
    rows = [(i, "w " * r.randint(0, 60), "en", r.choice(["a", "b", "cc", None, "d"] + ["big"] * 5), 0, 0, "") for i in range(3000)]
    rows += [(9000, "w w", "en", "tiny", 0, 0, "")]
    docs = spark.createDataFrame(rows, DOCS)
    sized, plan = mixing.mix(docs)
    got = mixing.repeats(sized, plan).collect()
    sizes, taken, target = {}, {}, {}
    for g in got:
        sizes[g["source"]] = sizes.get(g["source"], 0) + g["size"]
        taken[g["source"]] = taken.get(g["source"], 0) + g["_times"] * g["size"]
        target[g["source"]] = g["_target"]
        assert 0 <= g["_times"] <= 3
    want = brute_targets(sizes, (1, 2, 3), 3)
    assert all(math.isclose(target[s], want[s], rel_tol=1e-9) for s in want)
    assert all(abs(taken[s] - target[s]) <= 60 for s in want)
    again = mixing.repeats(*mixing.mix(docs.repartition(7))).collect()
    assert sorted((g["doc_id"], g["_times"]) for g in got) == sorted((g["doc_id"], g["_times"]) for g in again)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(g["_times"] for g in got)


def test_mix_edges(spark, docs, empty):
    assert mixing.mix_documents(empty).count() == 0
    sized, plan = mixing.mix(docs)
    assert mixing.repeats(sized, plan).count() == len(ROWS)
    assert {r["source"] for r in plan.collect()} == {"a", "b", "c", "", None}


def test_pieces_equal_the_library():
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model, lib, known = pieces.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path), UnitIds(np.int32, 300)
    pool = [p.replace("▁", " ") for p in model.pieces[259:]]
    texts = [t for t in odd_texts(800, 2) + odd_texts(800, 3, pool) + odd_texts(500, 4, list("theinaoe  \n▁.,ABC")) if "\0" not in t] + [" " * k for k in range(30)] + ["x" * 400]
    for lo in range(0, len(texts), 200):
        part = texts[lo : lo + 200]
        got = model.encode(part, known)
        assert [g.tolist() for g in got] == lib.encode(part)
        assert [model.decode(g.tolist()) for g in got] == [t.replace("▁", " ") for t in part]


def test_unigram_relaxation(tmp_path):
    """A small unigram model: the path found has the best total of all paths."""
    def field(n, kind, body):
        return bytes([n << 3 | kind]) + body

    def message(n, body):
        return field(n, 2, bytes([len(body)]) + body)

    import struct

    scores = {"▁": -2.0, "a": -2.5, "b": -2.6, "c": -2.7, "ab": -3.1, "▁a": -3.0, "bc": -4.0, "abc": -6.5, "ca": -3.3}
    raw = b"".join(message(1, message(1, p.encode()) + field(2, 5, struct.pack("<f", s)) + (field(3, 0, bytes([2])) if p == "<unk>" else b"")) for p, s in {"<unk>": 0.0, **scores}.items())
    raw += message(2, field(3, 0, bytes([1]))) + message(3, field(3, 0, b"\1") + field(4, 0, b"\0"))
    path = tmp_path / "u.model"
    path.write_bytes(raw)
    model = pieces.PieceModel(str(path))

    def best(t):
        table = [(0.0, [])] + [(-1e9, [])] * len(t)
        for i in range(1, len(t) + 1):
            table[i] = max(((table[j][0] + scores[t[j:i]], [*table[j][1], t[j:i]]) for j in range(i) if t[j:i] in scores), key=lambda x: x[0])
        return table[-1][0]

    r = random.Random(1)
    texts = ["".join(r.choice("abc ") for _ in range(r.randint(1, 12))) for _ in range(200)]
    for t, ids in zip(texts, model.encode(texts, UnitIds(np.int32))):
        assert math.isclose(sum(scores[model.pieces[i]] for i in ids), best("▁" + t.replace(" ", "▁")), abs_tol=1e-5)


def test_pieces_frames(docs, empty):
    path = tokenizer_file("piece_bpe_32k.model")
    got = pieces.encode(docs, path, check=True)
    assert got.where("NOT round_trip").count() == 0 and got.count() == len(ROWS)
    texts = {(r["doc_id"], r["decoded"]) for r in pieces.decode(got, path).collect()}
    assert texts == {(r[0], r[1] or "") for r in ROWS}
    assert pieces.encode(empty, path).count() == 0


def test_viterbi_against_all_paths():
    from itertools import product

    r = np.random.default_rng(2)
    for _ in range(40):
        lengths = r.integers(0, 6, 4)
        scores = r.normal(0, 3, (lengths.sum(), 3))
        start = np.cumsum(lengths) - lengths
        got = langid.viterbi(scores, start, lengths, 2.0)
        for s, n in zip(start, lengths):
            value = lambda p: sum(scores[s + i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
            if n:
                assert math.isclose(value(tuple(got[s : s + n])), max(map(value, product(range(3), repeat=n))), abs_tol=1e-9)


def test_language(spark, docs, empty):
    r = random.Random(3)
    words = {"en": "the of and house river stone walking".split(), "de": "der und schön über straße gehen".split(), "ru": "дом река и камень они шли".split()}
    rows = [(i, " ".join(r.choice(words[g]) for _ in range(r.randint(3, 30))), g, "s", 0, 0, "") for i, g in enumerate(r.choices(list(words), k=600))]
    got = langid.identify(spark.createDataFrame(rows, DOCS)).collect()
    truth = {row[0]: row[2] for row in rows}
    assert all(g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 3 == 1) for g in got)
    held = [g for g in got if g["held_out"]]
    assert sum(g["lang_pred"] == truth[g["doc_id"]] for g in held) >= 0.98 * len(held)
    model = langid.fit(spark.createDataFrame(rows, DOCS), "text", "lang", "doc_id")
    mixed = list(langid.label_texts(model, [" ".join(words["en"] * 3) + " " + " ".join(words["ru"] * 3), "123 ... !", None, ""]))
    assert [s[0] for s in mixed[0][2]] == ["en", "ru"] and [m[:2] for m in mixed[1:]] == [("und", 0.0)] * 3
    odd = langid.predict(docs, model).collect()
    assert len(odd) == len(ROWS) and all(0 <= o["score"] <= 1 for o in odd)
    clash = docs.withColumn("score", F.lit("x")).withColumn("_SCORE", F.lit("y"))
    added = langid.fresh(clash.columns, *langid.ADDED)
    kept = langid.with_languages(clash, model, "text", 6.0, added)
    assert kept.columns == [*clash.columns, *added] and "__score" in added and kept.drop(*added).exceptAll(clash).isEmpty()
    assert langid.identify(empty).count() == 0


def brute_language(train, texts, switch):
    """(language, share, spans, fit) of texts by plain dictionaries and all predecessors."""
    def words(t):
        for w in (t or "").split():
            if any(c.isalpha() for c in w):
                padded = " " + "".join(c.lower() if c.isalpha() else " " for c in w) + " "
                yield [padded[i - 1 : i + 2] for i in range(1, len(padded) - 1) if padded[i] != " "]

    langs = sorted({g for _, g in train})
    counts = {g: {} for g in langs}
    for t, g in train:
        for w in words(t):
            for x in w:
                counts[g][x] = counts[g].get(x, 0) + 1
    total = {g: 0.5 * langid.BUCKETS + sum(c.values()) for g, c in counts.items()}
    out = []
    for t in texts:
        ws = list(words(t))
        if not ws:
            out.append(("und", 0.0, [], 0.0))
            continue
        s = [[sum(math.log((counts[g].get(x, 0) + 0.5) / total[g]) for x in w) for g in langs] for w in ws]
        v, back = s[0], []
        for row in s[1:]:
            step = [max(range(len(langs)), key=lambda j: (v[j] - (j != k) * switch, j == k, -j)) for k in range(len(langs))]
            back.append(step)
            v = [v[step[k]] - (step[k] != k) * switch + row[k] for k in range(len(langs))]
        path = [max(range(len(langs)), key=lambda k: (v[k], -k))]
        for step in reversed(back):
            path.append(step[path[-1]])
        path.reverse()
        letters = [0] * len(langs)
        for k, w in zip(path, ws):
            letters[k] += len(w)
        top = max(range(len(langs)), key=lambda k: (letters[k], -k))
        spans = []
        for k in path:
            if spans and spans[-1][0] == langs[k]:
                spans[-1] = (langs[k], spans[-1][1] + 1)
            else:
                spans.append((langs[k], 1))
        out.append((langs[top], letters[top] / sum(letters), spans, sum(row[k] for row, k in zip(s, path)) / sum(letters) + math.log(langid.BUCKETS)))
    return out


def test_language_equals_the_plain_version(spark):
    r = random.Random(11)
    words = {"aa": "the of and house river stone walking".split(), "bb": "der und schön über straße gehen haus".split(), "cc": "les une maison être où pierre".split()}
    train = [(" ".join(r.choice(words[g]) for _ in range(r.randint(3, 20))), g) for g in r.choices(list(words), k=90)]
    texts = [" ".join(r.choice(words[r.choice(list(words))]) if r.random() < 0.3 else r.choice(words["bb"]) for _ in range(r.randint(1, 25))) for _ in range(60)]
    texts += ["", None, "12 - 34", "the-house, (river)! 5x", "qqzx wvkj xxqz", "THE HOUSE Über", "a"]
    model = langid.fit(spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(train)], "doc_id long, text string, lang string"), "text", "lang", "doc_id")
    got, want = list(langid.label_texts(model, texts)), brute_language(train, texts, langid.SWITCH)
    for g, w in zip(got, want):
        assert g[0] == w[0] and math.isclose(g[1], w[1], abs_tol=1e-9) and g[2] == w[2] and math.isclose(g[3], w[3], abs_tol=1e-3)
    assert got[64][3] < 0 < got[63][3]  # noise, and words of the model


def brute_codes(payload):
    """Pairs of spectral peaks from sums of products, frame by frame."""
    padded = payload + b"\xff" * (-len(payload) % media.HOP)
    samples = np.frombuffer(b"\xff" * media.HOP + padded + b"\xff" * media.HOP, np.uint8).astype(np.float64)
    n = np.arange(media.FRAME)
    weight = 0.5 - 0.5 * np.cos(2 * np.pi * (n + 1) / (media.FRAME + 1))
    peaks = []
    for at in range(0, len(samples) - media.FRAME + 1, media.HOP):
        frame = (samples[at : at + media.FRAME] - samples[at : at + media.FRAME].mean()) * weight
        level = [round(math.log2(abs(sum(frame * np.exp(-2j * np.pi * k * n / media.FRAME))) + 1) * 64) for k in range(1, media.FRAME // 2 + 1)]
        tops = [k for k in range(len(level)) if level[k] > (level[k - 1] if k else 0) and level[k] >= (level[k + 1] if k + 1 < len(level) else 0)]
        peaks.append([k + 1 for k in sorted(tops, key=lambda k: (-level[k], k))[: media.PEAKS]])
    return sorted(t << 32 | a << 20 | b << 8 | dt for t in range(len(peaks)) for dt in range(1, media.AHEAD + 1) if t + dt < len(peaks) for a in peaks[t] for b in peaks[t + dt])


def test_fingerprints_equal_the_plain_version():
    r = random.Random(12)
    same = every = 0
    for text in ["", "a", "the end " * 40, "é漢字 " * 70, *(" ".join(r.choice("stone river house of the and".split()) for _ in range(r.randint(1, 200))) for _ in range(20))]:
        got, want = media.fingerprint(media.pad(text.encode())).tolist(), brute_codes(media.pad(text.encode()))
        same, every = same + len(set(got) & set(want)), every + len(set(got) | set(want))
    assert every > 1000 and same >= 0.999 * every  # levels that round differently are rare


def test_media(docs, empty):
    got = media.with_features(media.with_media(docs)).collect()
    assert len(got) == len(ROWS) and media.with_media(empty).count() == 0
    by = {}
    for g in got:
        by.setdefault(g["doc_id"], []).append(g)
    for doc, text, *_ in ROWS:
        raw = (text or "").encode()
        padded = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        g = by[doc][0]
        assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
        assert g["media_sha256"] == hashlib.sha256(media.to_wav(padded)).hexdigest() and media.from_wav(media.to_wav(padded)) == padded
    assert by[3][0]["fingerprint"] == by[3][1]["fingerprint"]


def test_fingerprint_is_local():
    """Long payloads are transformed in chunks; the codes do not depend on them."""
    r = random.Random(4)
    payload = bytes(r.randrange(256) for _ in range(576 * 40))
    whole, media.CHUNK = media.fingerprint(payload), 7
    try:
        assert (media.fingerprint(payload) == whole).all()
    finally:
        media.CHUNK = 8192
    t, f1, f2, dt = whole >> 32, whole >> 20 & 4095, whole >> 8 & 4095, whole & 255
    assert (np.diff(t) >= 0).all() and ((f1 > 0) & (f2 > 0) & (f1 < 289) & (f2 < 289) & (dt >= 1) & (dt <= media.AHEAD)).all()


def test_fingerprint_of_short_and_shifted_payloads():
    texts = ["a", "the cat sat", "the dog sat", "x" * 95, "word " * 90]
    codes = [media.fingerprint(media.pad(t.encode())) for t in texts]
    assert all(len(c) for c in codes) and len({c.tobytes() for c in codes}) == len(texts)
    r = random.Random(9)
    passage = bytes(r.randrange(97, 123) for _ in range(2000))
    pairs = lambda head: set((media.fingerprint(media.pad(head + passage)) & 0xFFFFFFFF).tolist())
    whole, moved = pairs(b""), pairs(b"#" * 96)
    assert len(whole & moved) >= 0.9 * len(whole)


def test_fingerprint_pairs_all_peaks_of_the_zone():
    payload = bytes(random.Random(10).randrange(256) for _ in range(576 * 4))
    edge = bytes([255]) * media.HOP
    peaks = media.spectrum_peaks(np.frombuffer(edge + payload + edge, np.uint8))
    want = sorted(t << 32 | int(f) << 20 | int(g) << 8 | d for t, a in enumerate(peaks) for d in range(1, media.AHEAD + 1) if t + d < len(peaks) for f in a if f > 0 for g in peaks[t + d] if g > 0)
    assert media.fingerprint(payload).tolist() == want


def brute_ppm(counts, words, depth):
    """log10 probability of each word by escaping step by step."""
    table = {}
    for w, c in counts.items():
        s = b" " + w + (b"" if w == ppm.END else b" ")
        for i in range(1, len(s)):
            for k in range(min(depth, i) + 1):
                table.setdefault(s[i - k : i], {}).setdefault(s[i], 0)
                table[s[i - k : i]][s[i]] += c

    def one(w):
        s, out = b" " + w + (b"" if w == ppm.END else b" "), 0.0
        for i in range(1, len(s)):
            seen = set()
            for k in range(min(depth, i), -1, -1):
                here = table.get(s[i - k : i])
                if here is None:
                    continue
                left = {x: c for x, c in here.items() if x not in seen}
                if left:
                    total = sum(left.values()) + len(left)
                    if s[i] in left:
                        out += math.log10(left[s[i]] / total)
                        break
                    out += math.log10(len(left) / total)
                seen |= set(here)
            else:
                out -= math.log10(257 - len(seen))
        return out

    return [one(w) for w in words]


def test_ppm_against_escapes():
    r = random.Random(6)
    counts = {bytes(r.choice(b"abcd") for _ in range(r.randint(1, 7))): r.randint(1, 9) for _ in range(60)} | {ppm.END: 20}
    nodes, n = ppm.count_windows(list(counts), np.array(list(counts.values()))[:, None])
    trie = ppm.Trie.build(nodes, n[:, 0])
    words = [*counts, *(bytes(r.choice(b"abcdeXY") for _ in range(r.randint(1, 9))) for _ in range(100))]
    got = ppm.score_words([trie], words)[:, 0]
    assert np.allclose(got, brute_ppm(counts, words, ppm.DEPTH), atol=1e-9)
    spelled = ppm.score_words([trie], [bytes([a]) for a in range(256)])
    assert (spelled < 0).all()


def test_scores(spark, docs, empty):
    rows = [(i, " ".join(random.Random(i).choices("The the cat dog ran Ran far".split(), k=i % 17)), "en", "s", 0, 0, "") for i in range(300)] + [(1000, None, "en", "s", 0, 0, ""), (None, "the zebra", None, "s", 0, 0, "")]
    got = {r["doc_id"]: r for r in ppm.score(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    toks = lambda t: [*((t or "").encode().lower().split()), ppm.END]
    counts: dict = {}
    for d, t, *_ in rows:
        for w in toks(t) if not held(d) else []:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for d, t, *_ in rows:
        g, w = got[d], toks(t)
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held(d), len(w), sum(x in counts for x in w), n)
        assert math.isclose(g["base_score"], sum(math.log10((counts.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel_tol=1e-9)
        assert g["score"] < 0
    assert ppm.score(docs).count() == len(ROWS) and ppm.score(empty).count() == 0


def best_of_classes(rows, streams):
    """PPM code length of every document by escaping step by step, under the
    class that codes it best by orders 0 and 1."""
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    langs = sorted({r[2] for r in rows}, key=lambda g: (-sum(r[2] == g and not held(r[0]) for r in rows), g))
    n, short, full = sum(not held(r[0]) for r in rows), {r[0]: [] for r in rows}, {r[0]: [] for r in rows}
    for g in [*langs, None]:
        docs = [r for r in rows if r[2] == g and not held(r[0])]
        counts: dict = {}
        for r in docs:
            for s in streams(r[1]):
                counts[s] = counts.get(s, 0) + 1
        prior = math.log10((len(docs) + 0.5) / (n + 0.5 * (len(langs) + 1)))
        wanted = [streams(r[1]) for r in rows]
        for depth, out in ((1, short), (ppm.DEPTH, full)):
            scores = iter(brute_streams(counts, [s for w in wanted for s in w], depth))
            for r, w in zip(rows, wanted):
                out[r[0]].append(prior + sum(next(scores) for _ in w))
    return {d: max(zip(short[d], s))[1] for d, s in full.items()}


def brute_streams(counts, streams, depth):
    table: dict = {}
    for s, c in counts.items():
        for i in range(1, len(s)):
            for k in range(min(depth, i) + 1):
                here = table.setdefault(s[i - k : i], {})
                here[s[i]] = here.get(s[i], 0) + c
    out = []
    for s in streams:
        total = 0.0
        for i in range(1, len(s)):
            seen: set = set()
            for k in range(min(depth, i), -1, -1):
                here = table.get(s[i - k : i], {})
                left = {x: c for x, c in here.items() if x not in seen}
                if left:
                    n = sum(left.values()) + len(left)
                    total += math.log10(left.get(s[i], len(left)) / n)
                    if s[i] in left:
                        break
                seen |= set(here)
            else:
                total -= math.log10(257 - len(seen))
        out.append(total)
    return out


def ppm_rows():
    r = random.Random(8)
    pool = {"en": "the cat sat on a mat I ran".split(), "de": "der hund lief über das feld so".split()}
    return [(i, " ".join(r.choice(pool[g]) for _ in range(r.randint(1, 12))), g, "s", 0, 0, "") for i, g in enumerate(r.choices(["en", "de"], k=120))]


def test_ppm_keeps_every_count(spark, monkeypatch):
    """Rare bytes of a context stay, however many symbols there are."""
    monkeypatch.setattr(ppm, "MAX_NODES", 50, raising=False)
    monkeypatch.setattr(ppm, "PART_BYTES", 500, raising=False)
    rows = ppm_rows()
    want = best_of_classes(rows, lambda t: [ppm._stream(t.encode())])
    for hot in (ppm.HOT_WINDOWS, 3):  # with and without contexts that are dealt by a third byte
        monkeypatch.setattr(ppm, "HOT_WINDOWS", hot)
        got = ppm.score(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
        assert len(got) == len(rows) and all(math.isclose(g["score"], want[g["doc_id"]], rel_tol=1e-9) for g in got)


def test_ppm_reads_across_words(spark, monkeypatch):
    """The code length is that of the document's byte stream, so the order of words matters."""
    monkeypatch.setattr(ppm, "SLICE_BYTES", 300, raising=False)
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 900)
    rows = ppm_rows()
    rows.append((900, "mat a on sat cat the ran I", "en", "s", 0, 0, ""))
    rows.append((901, "the cat sat on a mat I ran", "en", "s", 0, 0, ""))
    want = best_of_classes(rows, lambda t: [b" " + b"".join(w + b" " for w in t.encode().lower().split()) + ppm.END])
    got = {g["doc_id"]: g["score"] for g in ppm.score(spark.createDataFrame(rows, DOCS).repartition(2)).collect()}
    assert len(got) == len(rows) and all(math.isclose(got[d], want[d], rel_tol=1e-9) for d in want)
    assert abs(got[900] - got[901]) > 1e-3
