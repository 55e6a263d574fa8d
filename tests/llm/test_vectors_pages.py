import itertools
import random
import re
import time

import numpy as np
import pytest

from llm import embedding_dedup, graph, html_text, trees


def truth(rows, over):
    """Links of each row and smallest id reached, by comparing all pairs; rows by their place."""
    n, links, top = len(rows), [0] * len(rows), list(range(len(rows)))
    unit = []
    for i, e, label in rows:
        x = None if e is None or label is None or any(v is None for v in e) else np.array(e, dtype=float)
        ok = x is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if ok else None)

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(n):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= over:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)), key=lambda k: (rows[k][0] is None, rows[k][0]))
                top[y] = x
    return sorted(((rows[k][0], links[k], rows[root(k)][0], rows[k][0] == rows[root(k)][0]) for k in range(n)), key=repr)


@pytest.mark.parametrize("shard", [16, 4096])
def test_embeddings(spark, shard):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 12))
    rows = []
    for i in range(260):
        x = base[rng.integers(40)] + rng.normal(size=12) * rng.choice([0, 0.1, 0.3])
        rows.append((i, np.float32(x).tolist(), int(rng.integers(3)) if i % 17 else None))
    rows += [(300, None, 1), (301, [0.0] * 12, 1), (302, [None] + [1.0] * 11, 1), (303, [float("nan")] * 12, 1), (304, [float("inf")] + [1.0] * 11, 1), (305, [1.0, 2.0], 1), (306, [2.0, 4.0], 1), (307, [], 1), (308, [1e-30] * 12, 2), (309, [1e30] * 12, 2)]
    rows += [(None, rows[1][1], rows[1][2]), (None, [1.0, -1.0], 7), (None, [2.0, -2.0], 7), rows[2], (2, rows[5][1], rows[5][2]), (310, None, None)]
    rows += [(400 + k, rows[3][1], rows[3][2]) for k in range(40)]  # a common vector
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, id int, h string")
    got = embedding_dedup.link(df, shard_rows=shard).collect()
    assert sorted((tuple(r) for r in got), key=repr) == truth(rows, 0.93)
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = embedding_dedup.Graph(x)
    a, b, _, known, found = embedding_dedup.audited(g, x, x, 0.8, 64, 64)
    assert len(set(zip(a, b))) >= 0.97 * (x @ x.T >= 0.8).sum() and 64 <= found <= known


def test_audit_queries_have_links():
    x = np.eye(30)
    assert ((embedding_dedup.planted(x, 0.93, 50) @ x.T >= 0.93).sum(1) == 1).all()


def test_shards_are_sent_as_they_are():
    rng = np.random.default_rng(6)
    raw = rng.normal(size=(300, 8)).astype(np.float32)
    x = embedding_dedup._unit(raw)
    g = embedding_dedup.Graph(x)
    ids, many, y, h = embedding_dedup._received(embedding_dedup._sent(np.arange(300), np.ones(300, int), raw, g))
    assert (x == y).all() and all((a == b).all() for a, b in zip(g.next, h.next)) and (g.entry, g.top) == (h.entry, h.top)


@pytest.mark.parametrize("small", [200_000, 0])
def test_components(spark, monkeypatch, small):
    """Chains, random links and hubs at either end of the ids, with and without dealing hubs to several tasks."""
    monkeypatch.setattr(graph, "SMALL", small)
    rng = random.Random(8)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 380)] + [(999, k) for k in range(400, 480)] + [(500, k) for k in range(501, 590)]
    top = {k: k for e in links for k in e}

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        top[y] = x
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: root(k) for k in top if root(k) != k}


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<!-- ad --><div class="ad">Buy it now.</div><article><h1>A  title &amp; more</h1><p><b>First words of it, some more of them here. And &quot;more&quot; of them.<br><p>Second
 part, with   spaces &lt;ok&gt; and a caf&eacute;. It goes on, and on.</p><p>Third part is here too, as long as others are.</p></article><footer>&copy; site</footer>"""


def test_page():
    fitted = html_text.model()
    got = html_text.extract([PAGE, None, "", "<", "<p", "no markup at all", "<div><div><table><tr><td>", "</p></b>"], fitted)
    assert got[0] == 'A title & more\nFirst words of it, some more of them here. And "more" of them.\nSecond part, with spaces <ok> and a café. It goes on, and on.\nThird part is here too, as long as others are.'
    assert got[1:3] == ["", ""] and len(got) == 8


def test_held_out_pages():
    """Characters of main text found and of other text left out, on composed pages the trees haven't seen."""
    fitted, rng, right, wrong, missed = html_text.model(), random.Random(99), 0, 0, 0
    for _ in range(120):
        s = html_text.sample_page(rng)
        page = html_text.Page(re.sub(r"(<[a-z0-9]+[^>]*?) x>", r'\1 role="xoutx">', s))
        nodes = html_text.Nodes([page])
        out = np.array(["xoutx" in m for m in nodes.marks]) | nodes.never
        for level in nodes.levels[1:]:
            out[level] |= out[nodes.parent[level]]
        want, got = page.text(~out).split("\n"), html_text.extract([re.sub(r"(<[a-z0-9]+[^>]*?) x>", r"\1>", s)], fitted)[0].split("\n")
        right += sum(len(x) for x in got if x in want)
        wrong += sum(len(x) for x in got if x not in want)
        missed += sum(len(x) for x in want if x not in got)
    assert right / (right + wrong) > 0.93 and right / (right + missed) > 0.93


def test_nothing_below_a_dropped_element_is_kept():
    nodes = html_text.Nodes([html_text.Page(PAGE)])
    rng = np.random.default_rng(1)
    for _ in range(20):
        kept = nodes.decode(rng.random(len(nodes.tag)))
        inner = nodes.parent >= 0
        assert not (kept[inner] & ~kept[nodes.parent[inner]]).any()


def test_decoding_is_the_likeliest_labelling():
    """Against all labellings of small trees under which nothing below a dropped element is kept, the root always being kept."""
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randint(1, 9)
        page = html_text.Page("".join(rng.choice(["<div>", "<b>", "</div>", "</b>", "<script>x</script>", "text"]) for _ in range(n)))
        nodes = html_text.Nodes([page])
        m = len(nodes.tag)
        chance = np.array([rng.choice([0.1, 0.3, 0.6, 0.9, 0.99]) for _ in range(m)])
        best, most = None, -np.inf
        for bits in itertools.product([False, True], repeat=m):
            if not bits[0] or any(k and (not bits[p] or nodes.never[i]) for i, (k, p) in enumerate(zip(bits, nodes.parent)) if i):
                continue
            value = sum(np.log(c if k else 1 - c) for i, (k, c) in enumerate(zip(bits, chance)) if i and not nodes.never[i])
            if value > most + 1e-9:
                best, most = bits, value
        got = nodes.decode(chance)
        assert got[0] and sum(np.log(c if k else 1 - c) for i, (k, c) in enumerate(zip(got, chance)) if i and not nodes.never[i]) == pytest.approx(most), (page.tag, best, got)


def test_first_split_is_the_best_of_all():
    """A tree of one split against every feature and bound, by Newton gain."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        x = rng.integers(0, 6, (40, 3)).astype(float)
        y = (x[:, rng.integers(3)] > rng.integers(1, 5)).astype(float)
        y[rng.integers(0, 40, 5)] = 1 - y[rng.integers(0, 40, 5)]
        p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        g, h = y - p, p * (1 - p)
        gain = lambda m: g[m].sum() ** 2 / (h * m.sum() + 1) + g[~m].sum() ** 2 / (h * (~m).sum() + 1)
        best = max(gain(x[:, j] > b) for j in range(3) for b in range(6) if 0.75 <= h * (x[:, j] > b).sum() and 0.75 <= h * (x[:, j] <= b).sum())
        (feature, bound, leaf), = trees.fit(x, y, rounds=1, depth=1, bins=64).trees
        right = x[:, feature[0]] > bound[0]
        assert gain(right) == pytest.approx(best)
        assert leaf[1] == pytest.approx(0.3 * g[right].sum() / (h * right.sum() + 1))


@pytest.mark.parametrize("unit, rest", [('<b x="', ""), ("<div>", "</x>"), ('<a ">" ', ""), ("<a", ' ">"'), ("<b>", ""), ("<!", ""), ("<span>", "<dd></dd>"), ("<", ""), ("<p>one, two.", "")])
def test_parsing_takes_linear_time(unit, rest):
    def seconds(n):
        best = 9.0
        for _ in range(3):
            began = time.process_time()
            html_text.Page("<dl><dt><dl>" + unit * n + rest * n)
            best = min(best, time.process_time() - began)
        return best

    assert seconds(32_000) < 0.05 + 9 * seconds(8_000)


def test_very_long_page():
    article = "<article>" + "".join(f"<p>Part {i} of it is here, with some words more.</p>" for i in range(20_000)) + "</article>"
    got = html_text.extract(["<nav><a href='/'>Home</a></nav>" + article + "<footer>&copy; x</footer>"], html_text.model())[0]
    assert got.count("\n") == 19_999 and got.startswith("Part 0 of it") and "Home" not in got


def test_pages_table(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, n_chars int, text string")
    got = html_text.extract_pages(frame).collect()
    assert len(got) == 4 and len(set(map(tuple, got))) == 3 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
