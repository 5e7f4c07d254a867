"""Alignment of long lists of siblings."""

import random

from lodeworks.llm import pages


def page(n, seed):
    return f"<html><body>{''.join(f'<p>text {seed} {i}</p>' for i in range(n))}<div class='x'>the constant line</div></body></html>"


def test_long_pages_are_aligned():
    long = [page(n, seed) for seed, n in enumerate((250, 310, 330, 370, 405))]
    wrapper = pages.induce(long)
    assert len(wrapper["constants"]) == 1
    assert "the constant line" not in pages.extract(long[0], wrapper)


def test_long_alignment_equals_the_table(monkeypatch):
    r = random.Random(2)
    body = lambda: "".join(r.choice(["<p>a</p>", "<div>b</div>", "<ul><li>c<li>d</ul>", "<ul><li>c</ul>"]) for _ in range(r.randint(1, 25)))
    for _ in range(40):
        a, b = pages.parse(body()), pages.parse(body())
        want, pairs = pages.match(a, b), []
        monkeypatch.setattr(pages, "MAX_CELLS", 0)
        assert pages.match(a, b, pairs) == want == len(pairs)
        monkeypatch.undo()


def brute_match(a, b):
    """The best matching by trying every choice for the last children."""
    if a[0] != b[0]:
        return 0

    def lists(xs, ys):
        if not xs or not ys:
            return 0
        return max(lists(xs[:-1], ys), lists(xs, ys[:-1]), lists(xs[:-1], ys[:-1]) + brute_match(xs[-1], ys[-1]))

    return 1 + lists(a[1], b[1])


def test_matching_is_optimal(monkeypatch):
    r = random.Random(4)

    def tree(depth):
        return r.choice(["div", "section"]), [tree(depth - 1) for _ in range(r.randint(0, 3))] if depth else []

    def html(t):
        return f"<{t[0]}>{''.join(map(html, t[1]))}</{t[0]}>"

    for cells in (pages.MAX_CELLS, 0):
        monkeypatch.setattr(pages, "MAX_CELLS", cells)
        for _ in range(60):
            a, b = ("body", [tree(2) for _ in range(2)]), ("body", [tree(2) for _ in range(3)])
            pairs = []
            x, y = (pages.parse(html(t)).kids[0] for t in (a, b))
            assert pages.match(x, y, pairs) == brute_match(a, b) == len(pairs)
            # pairs keep signature, ancestry and order
            place = {id(p): id(q) for p, q in pairs}
            assert all(p.sig == q.sig and (p is x or place[id(p.parent)] == id(q.parent)) for p, q in pairs)


def site(n, seed=1, tags=False):
    """Pages of one layout: a menu, a long sidebar that is the same on all, the
    article, and a footer that varies; plain elements, or named ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    side = "".join(f"<p>{' '.join(word() for _ in range(30))}</p>" for _ in range(6))
    out = []
    for i in range(n):
        paragraphs = [" ".join(word() for _ in range(r.randint(1, 25))) for _ in range(r.randint(1, 9))]
        title, menu, foot, ad = word(), [word() for _ in range(5)], " ".join(word() for _ in range(12)), " ".join(word() for _ in range(10))
        names = ("nav", "aside", "article", "footer") if tags else ("div",) * 4
        html = (f"<html><body><{names[0]}><ul>{''.join(f'<li><a href=x>{m}</a>' for m in menu)}</ul></{names[0]}><{names[1]}>{side}</{names[1]}>"
                + (f"<div>{ad}</div>" if i % 3 else "")
                + f"<{names[2]}><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}</{names[2]}><{names[3]}>{foot}</{names[3]}></body></html>")
        out.append((html, " ".join([title, *paragraphs])))
    return out


def test_alignment_decides_where_names_do_not():
    for tags in (True, False):
        wanted = site(8, tags=tags)
        wrapper = pages.induce([h for h, _ in wanted])
        assert [pages.extract(h, wrapper) for h, _ in wanted] == [t for _, t in wanted]
    # without the wrapper the sidebar, longer than the articles, is taken for them
    assert all(pages.extract(h) != t for h, t in wanted)


def test_headings_beside_the_region():
    wanted = [f"Title {i} " + f"text of page {i} " * 20 + f"end {i}" for i in range(5)]
    htmls = [f"<body><div><h1>Title {i}</h1></div><div><p>{f'text of page {i} ' * 20}</p><p>end {i}</p></div><div>foot {i}</div></body>" for i in range(5)]
    wrapper = pages.induce(htmls)
    assert wrapper["heads"] and [pages.extract(h, wrapper) for h in htmls] == [" ".join(w.split()) for w in wanted]


def test_hosts_in_spark_equal_the_plain_version(spark):
    from hashlib import md5

    rows, wanted = [], {}
    hosts = {"a.x": [h for h, _ in site(8)], "b.x": [h for h, _ in site(7, 2, True)], "c.x": ["<p>one &amp; only</p>"], "d.x": [page(n, n) for n in (2, 5, 9, 4, 30)]}
    for host, htmls in hosts.items():
        htmls = sorted(htmls, key=lambda h: md5(h.encode()).hexdigest())
        wrapper = pages.induce(htmls)
        for h in [*htmls, htmls[0]]:  # a copy changes nothing
            wanted[len(rows)] = pages.extract(h, wrapper)
            rows.append((len(rows), f"http://{host}/{len(rows)}", h, "clash"))
    rows.append((len(rows), "http://e.x/", None, None))
    wanted[len(rows) - 1] = ""
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(4)
    got = pages.main_text(df).collect()
    assert {g["page_id"]: g["text"] for g in got} == wanted and all(g["n_chars"] == len(g["text"]) for g in got)
