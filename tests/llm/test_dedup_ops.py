"""Near-duplicate texts and vectors, components, archives, pages, pipeline."""

import hashlib
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeworks.llm import minhash, pages, vectors, warc
from lodeworks.llm.components import connected_components
from lodeworks.llm.textio import shingle_hashes, word_hashes, word_spans

DOCS = "doc_id long, text string, key string, root int, bucket long"


def union(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(0, k) for k in range(200, 240)] + [(5, 5), (None, 3)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union(300, [x for x in links if None not in x])
    assert got == {k: want[k] for pair in links if None not in pair and pair[0] != pair[1] for k in pair}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_place():
    raw = " b\taa  b\n aa é b".encode()
    data = np.frombuffer(raw, np.uint8)
    s, e, row = word_spans(data, np.array([0, 4, len(raw)]))
    words = [raw[i:j].decode() for i, j in zip(s, e)]
    assert words == ["b", "a", "a", "b", "aa", "é", "b"] and row.tolist() == [0, 0, 1, 1, 1, 1, 1]
    h = word_hashes(data, s, e)
    assert len({(w, x) for w, x in zip(words, h.tolist())}) == len(set(words))
    g, r = shingle_hashes(h, row, 5)
    assert r.tolist() == [0, 1]


def test_texts_of_a_regular_make_do_not_collide(spark):
    rows = []
    for n in (1024, 2048):
        bits = [bin(i).count("1") & 1 for i in range(n)]
        rows += [(n, "".join("ab"[b] for b in bits)), (n + 1, "".join("ba"[b] for b in bits))]
        rows += [(-n, " ".join("ab"[b] for b in bits)), (-n - 1, " ".join("ba"[b] for b in bits))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    linked = {r["doc_id"] for r in got if r["n_copies"] > 1}
    # as lists of words the two share all but a few shingles of five words
    assert not linked & {1024, 1025, 2048, 2049}
    words = np.frombuffer("".join("ab"[bin(i).count("1") & 1] for i in range(4096)).encode(), np.uint8)
    at = np.arange(0, 4096, 1024)
    assert len(set(word_hashes(words, at[:2], at[:2] + 1024).tolist())) == 2  # long words
    at = np.arange(0, 4096, 128)
    texts = {words[i : i + 128].tobytes() for i in at}
    assert len(set(word_hashes(words, at, at + 128).tolist())) == len(texts)
    assert word_hashes(words, at, at + 128, 7)[0] != word_hashes(words, at, at + 128, 8)[0]


def slow_jaccard(x, y):
    total = 0.0
    for i in set(x) & set(y):
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in set(x) | set(y))
    return total


def arrays(x):
    k = sorted(x)
    return np.array(k, np.uint64), np.array([x[i] for i in k], float)


def test_similarity_and_registers():
    r = random.Random(2)
    for _ in range(30):
        x, y = ({r.randrange(40): r.randint(1, 4) for _ in range(20)} for _ in range(2))
        assert abs(minhash.prob_jaccard(*arrays(x), *arrays(y)) - slow_jaccard(x, y)) < 1e-9
    assert minhash.prob_jaccard(*arrays({}), *arrays({1: 1})) == 0.0
    hashes = np.random.default_rng(1).integers(0, 2**63, 400, dtype=np.uint64)
    x, y = {int(h): 1 + int(h) % 3 for h in hashes[:350]}, {int(h): 1 + int(h) % 3 for h in hashes[50:]}
    a, b = (minhash.signatures(*arrays(z), np.zeros(len(z), np.int64), 1, 4096) for z in (x, y))
    assert abs((a == b).mean() - slow_jaccard(x, y)) < 0.04


def corpus(seed, n=250):
    """Base texts with copies, edited copies and repeated lines."""
    r = random.Random(seed)
    out = []
    while len(out) < n:
        words = [f"w{r.randrange(400)}" for _ in range(r.choice([1, 3, 5, 40, 120]))]
        if r.random() < 0.2:
            words *= 3
        out.append(" ".join(words))
        for _ in range(r.choice([0, 0, 1, 6])):
            edited = list(words)
            for _ in range(r.randint(0, 3)):
                edited[r.randrange(len(edited))] = "x"
            out.append(" ".join(edited))
    return out


def weights(text):
    w = text.split()
    out = {}
    for i in range(max(1, len(w) - 4)) if w else []:
        out[tuple(w[i : i + 5])] = out.get(tuple(w[i : i + 5]), 0) + 1
    return out


def brute_classes(texts):
    w = [weights(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i] == texts[j] or (set(w[i]) & set(w[j]) and slow_jaccard(w[i], w[j]) >= 0.8)]
    return union(len(texts), links)


@pytest.mark.parametrize("block", [4096, 3])
def test_near_duplicates(spark, block):
    texts = corpus(7)
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in enumerate(texts)], DOCS).repartition(5)
    minhash.BLOCK, before = block, minhash.BLOCK
    try:
        got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()}
    finally:
        minhash.BLOCK = before
    assert got == dict(enumerate(brute_classes(texts)))


def test_groups_are_joined_whole():
    """A chain of near texts with no hub becomes one group; far texts stay."""
    words = [f"w{i}" for i in range(200)]
    chain = [" ".join(words[:k] + [f"y{i}" for i in range(k, 200)]) for k in (200, 185, 170, 155)] + ["a b c d e f"]
    sets = [arrays({abs(hash(s)) % 2**62: c for s, c in weights(t).items()}) for t in chain]
    sigs = np.concatenate([minhash.signatures(h, w, np.zeros(len(h), np.int64), 1) for h, w in sets])
    links = minhash.join_groups(list(range(5)), np.arange(5), sigs, [h for h, _ in sets], [None] * 5, 0.8)
    assert union(5, links) == [0, 0, 0, 0, 4]


def test_near_duplicate_edges(spark):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, " \n"), (None, "same text of six words here"), (6, "same text of six words here"), (6, "same text of six words here"), (7, "one"), (8, "one"), (None, "alone"), (9, "long " * 50_000)]
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], DOCS)
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).select("doc_id", "class_id", "n_copies", "kept").collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (2, 2, 1, True), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True), (None, 6, 3, False), (6, 6, 3, True), (6, 6, 3, True), (7, 7, 2, True), (8, 7, 2, False), (None, None, 1, True), (9, 9, 1, True)], key=str)
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], (r["text"] or "")[:5]) for r in kept.where("doc_id IS NOT NULL").collect()) == [(1, ""), (2, ""), (3, ""), (5, " \n"), (6, "same "), (7, "one"), (9, "long ")]
    assert kept.where("doc_id IS NULL").count() == 1
    assert minhash.near_duplicates(df.limit(0)).count() == 0 and minhash.keep_one(df.limit(0)).count() == 0


VECS = "vec_id long, embedding array<float>, label int, key string"


def brute_vectors(rows):
    unit = [None if v is None or lab is None or not len(v) or not all(x is not None and np.isfinite(x) for x in v) or not any(v) else np.array(v, float) / np.linalg.norm(np.array(v, float)) for _, v, lab in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.98]
    root = union(len(rows), links)
    ids: dict = {}
    for i, r in enumerate(root):
        ids[r] = min(ids.get(r, rows[i][0]), rows[i][0])
    count = [sum(i in link for link in links) for i in range(len(rows))]
    return sorted((rows[i][0], count[i], ids[root[i]], rows[i][0] == ids[root[i]]) for i in range(len(rows)))


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors(spark, block):
    g = np.random.default_rng(3)
    rows = []
    for i in range(25):
        base = g.normal(size=12)
        for _ in range(int(g.integers(1, 14))):
            rows.append((len(rows), (base + g.normal(size=12) * 0.07).astype(np.float32).tolist(), int(i % 3)))
    rows += [(900, None, 1), (901, [0.0] * 12, 1), (902, [1.0, None] + [0.0] * 10, 1), (903, [float("nan")] * 12, 1), (904, [1.0, float("inf")], 1), (905, rows[0][1], None), (906, [], 1), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0),
             (909, [1e-30, 2e-30], 0), (910, rows[0][1], rows[0][2]), (910, rows[0][1], rows[0][2])]
    vectors.BLOCK, before = block, vectors.BLOCK
    try:
        got = sorted(map(tuple, vectors.near_vectors(spark.createDataFrame([(*r, "k") for r in rows], VECS).repartition(3)).collect()))
    finally:
        vectors.BLOCK = before
    assert got == brute_vectors(rows)


def test_vector_edges(spark):
    assert vectors.near_vectors(spark.createDataFrame([], VECS)).count() == 0
    got = vectors.near_vectors(spark.createDataFrame([(1, [1.0], None, "k"), (None, [1.0], 1, "k")], VECS)).collect()
    assert {tuple(r) for r in got} == {(1, 0, 1, True), (None, 0, None, True)}


PAGES = "page_id long, url string, html string, first string, d int"


def test_archives(spark, monkeypatch):
    long_ = "<p>é " + "x" * 200
    rows = [(5, "http://a/ü b", long_), (2, "http://b", long_), (9, None, long_), (3, "http://c", None), (4, "http://d", ""), (7, "u", "short"), (8, "u", "short"), (2, "http://b", long_), (None, "v", long_), (11, "w", "y" * 3_000_000)]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], PAGES).repartition(3)
    got = warc.roundtrip(df).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(k, u, len((h or "").encode()), sha(h), "revisit" if h == long_ and k != 2 else "response", 2 if h == long_ and k != 2 else None) for k, u, h in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert {bytes(r["payload"]) for r in got if r["page_id"] == 11} == {b"y" * 3_000_000}
    assert warc.roundtrip(df.limit(0)).count() == 0
    # beyond the limit of the broadcast, by one bitmap
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    assert sorted((tuple(r)[:6] for r in warc.roundtrip(df).collect()), key=str) == sorted(want, key=str)


def test_records_are_whole(spark, tmp_path):
    rows = [(1, "http://a", "x" * 150), (1, "http://a", "x" * 150), (2, None, "x" * 150), (3, "http://b", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    paths = [r["path"] for r in warc.write_archives(df, str(tmp_path / "w")).collect()]
    heads = [h for p in paths for h, _ in warc.read_records(open(p, "rb"))]
    assert len({h["warc-record-id"] for h in heads}) == 4 and all(h["warc-date"].endswith("Z") and h["content-type"] for h in heads)
    again = next(h for h in heads if h["warc-type"] == "revisit")
    assert (again["x-page"], again["x-refers-to-page"], again["warc-refers-to-target-uri"]) == ("2", "1", "http://a")


def test_members_are_inflated_in_steps(monkeypatch):
    monkeypatch.setattr(warc, "_BUFFER", 7)
    payloads = [b"", b"a" * 100_000, bytes(range(256)) * 40]
    raw = b"".join(warc.record_bytes(i, None, p, None) for i, p in enumerate(payloads))
    assert [b for _, b in warc.read_records(io.BytesIO(raw))] == payloads


def test_damaged_archives():
    good = warc.record_bytes(1, "http://a", b"payload", None)
    assert [b for _, b in warc.read_records(io.BytesIO(good + good))] == [b"payload"] * 2
    import gzip

    raw = gzip.decompress(good)
    for bad in (good[:-9], gzip.compress(raw.replace(b"payload", b"paylord")), gzip.compress(raw.replace(b"Content-Length: 7", b"Content-Length: 6")), gzip.compress(b"no header"),
                gzip.compress(raw.replace(b"X-Payload-Length: 7", b"X-Payload-Length: 8")), gzip.compress(raw.replace(b"WARC-Date", b"WARC-Time")), gzip.compress(raw + b"more"), good + b"trash"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))


def page(body, nav="home news", title="T"):
    return f'<html><head><title>{title}</title><script>var x="</p>"</script></head><body><nav><a>{nav}</a></nav><div class="ad">BUY</div>{body}<footer>(c) x</footer></body></html>'


def test_match_is_the_best_alignment():
    a, b = (pages.parse(h) for h in ("<div><p>1</p><ul><li>a</li></ul><p>2</p></div>", "<div><p>1</p><p>3</p><ul><li>b</li><li>c</li></ul></div>"))
    assert pages.match(a, b) == 5  # root, div, one paragraph, list, item
    pairs = []
    pages.match(a, b, pairs)
    assert len(pairs) == 5 and all(x.sig == y.sig for x, y in pairs)


def test_wrapper_keeps_slots_and_drops_constants():
    site = [page(f'<div id="wrap"><div class="body"><p>Share this story now</p><p>Story {i} {"text " * 30}</p><p>more {i}</p></div></div>', nav=f"menu {i}") for i in range(6)]
    wrapper = pages.induce(site)
    assert pages.extract(site[3], wrapper) == "Story 3 " + "text " * 30 + "more 3"
    copies = [page(f"<article><p>{'same text ' * 40}</p></article>", nav=f"menu {i}") for i in range(6)]
    assert pages.extract(copies[0], pages.induce(copies)) == ("same text " * 40).strip()


@pytest.mark.parametrize("html,want", [
    ("", ""), ("plain", "plain"), ("<article><p>a&amp;b&nbsp; c\n d</p><p><b>e</b>f<br>g</p></article>", "a&b c d ef g"),
    (page('<article><header><h1>Head</h1></header><p><b>x<br><p>y<ul><li>1<li>2</ul><form>no</form><aside>no</aside><!-- no --><div class="share-bar">no</div></article><section id="comments"><p>no</p></section>'), "Head x y 1 2"),
    (page('<div class="cookie-notice">no</div><main class="with-sidebar"><p>yes</p></main><div class="sidebar">no</div>'), "yes"), ("<p>a<![foo]]>b", "a<![foo]]>b"), ("<div hidden>no</div><p>yes</p>", "yes"), ("<p>" * 3000 + "deep" + "<div>" * 3000 + "x", "deep x")])
def test_pages(html, want):
    assert pages.extract(html) == want


def test_page_frames(spark):
    rows = [(1, "http://h/a", page("<article><p>one</p></article>")), (2, None, None), (None, "no url", "<p>x</p>"), (1, "http://h/a", page("<article><p>one</p></article>")), (3, "http://h/b", page("<article><p>two &lt; three</p></article>"))]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], PAGES)
    got = sorted((tuple(r) for r in pages.main_text(df).collect()), key=str)
    assert got == sorted([(1, "http://h/a", "one", 3), (2, None, "", 0), (None, "no url", "x", 1), (1, "http://h/a", "one", 3), (3, "http://h/b", "two < three", 11)], key=str)
    assert pages.main_text(df.limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    from lodeworks.llm import langid, mixing

    r = random.Random(9)
    rows = []
    for i in range(240):
        words = [r.choice("the a of to and in river stone house cloud walking".split()) + str(r.randrange(30)) for _ in range(r.randint(6, 60))]
        rows.append((len(rows), " ".join(words), "en", f"s{i % 4}", 0))
        if i % 6 == 0:
            rows.append((len(rows), " ".join(words[:-1]) + " end" if len(words) > 55 else " ".join(words), "en", f"s{i % 4}", 0))
    rows += [(len(rows), "12 34 !!", "en", "s0", 0), (len(rows) + 1, None, None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "source_mix", "sentencepiece"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    first = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    assert {x["doc_id"] for x in first.collect()} == {x[0] for x in rows[:-2]}  # texts without a letter go
    second = corpus_pipeline.STAGES[1][1](spark, first, str(tmp_path))
    classes = brute_classes([x[1] for x in rows[:-2]])
    assert sorted(x["doc_id"] for x in second.collect()) == sorted(set(classes))
    third = corpus_pipeline.STAGES[2][1](spark, second, str(tmp_path))
    assert third.columns == docs.columns
    plan = mixing.repeats(*mixing.mix(second)).collect()
    assert third.count() == sum(x["_times"] for x in plan)
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert last.count() == third.count() and last.where("NOT round_trip").count() == 0
    assert langid.UNDETERMINED == "und"


STAGED = "doc_id long, text string, lang string, source string, n_chars long, _score string, score string, _row int, _id int, _key string, key string"


def test_pipeline_stages_keep_their_statements(spark):
    """Nulls, empty texts, ties, repeated rows, noise and clashing names, stage by stage."""
    import sentencepiece

    import corpus_pipeline
    from lodeworks.llm.queries import tokenizer_file

    r = random.Random(4)
    words = "the a of to and in river stone house cloud walking over under many people".split()
    clash = ("x", "y", 1, 2, "k", "k")
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, text(r.randint(20, 50)), "en", f"s{i % 3}", 0, *clash) for i in range(120)]
    noise = " ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(8)) for _ in range(40))
    odd = [(200, None, "en", "s0", 0, *clash), (201, "", "en", None, 0, *clash), (202, "12 34", None, "s0", None, *clash), (203, noise, None, "s1", 0, *clash), (None, text(30), "en", None, 0, *clash), (5, rows[5][1], "en", "s2", 0, *clash)]
    docs = spark.createDataFrame(rows + odd, STAGED).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language_id"](spark, docs, "")
    assert first.columns == docs.columns
    assert sorted(x["doc_id"] is None or x["doc_id"] for x in first.collect()) == sorted([*range(120), 5, True])
    second = stages["near_dedup"](spark, docs, "")
    kept = [x["doc_id"] for x in second.collect()]
    classes = brute_classes([x[1] for x in rows])
    want = sorted(set(classes)) + [200, 201, 202, 203]
    assert second.columns == docs.columns and sorted(k for k in kept if k is not None) == want and kept.count(None) == 1
    third = stages["source_mix"](spark, docs, "")
    sizes, taken = {}, {}
    for x in docs.collect():
        sizes[x["source"]] = sizes.get(x["source"], 0) + len((x["text"] or "").split())
    for x in third.collect():
        taken[x["source"]] = taken.get(x["source"], 0) + len((x["text"] or "").split())
    total, level = sum(sizes.values()), {s: w for s, w in zip(sorted(sizes, key=lambda s: (s is None, s or "")), (1, 2, 3, 1))}
    goal = {s: total * w / 7 for s, w in level.items()}
    over = {s for s in goal if goal[s] > 3 * sizes[s]}
    assert over == {None} and taken[None] == 3 * sizes[None]  # what the last source cannot take is shared again
    free = total - 3 * sizes[None]
    assert third.columns == docs.columns and all(abs(taken[s] - free * level[s] / 6) <= 60 for s in level if s is not None)
    path = tokenizer_file("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    fourth = stages["sentencepiece"](spark, docs, "").collect()
    assert sorted((str(x["doc_id"]), x["ids"], x["n_pieces"]) for x in fourth) == sorted((str(x[0]), lib.encode(x[1] or ""), len(lib.encode(x[1] or ""))) for x in rows + odd)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name
