"""Toxicity, HTML, quality, URL, secret and mixing operators on small fixtures."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindle.llm import html, mix, quality, secrets, toxicity, urls
from tests.llm.conftest import prose

MARKS = ("vile", "rotten", "lousy")


def toxic_rows(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 10_000 + i, 40 + i % 60).split(" ")
        bad = i % 5 == 0
        for _ in range((1 + i // 5 % 6) if bad else 0):
            words[r.randrange(len(words))] = r.choice(MARKS) + r.choice(("", "ness", "er", "ish"))
        rows.append((seed * 10_000 + i, " ".join(words), int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    train, test = toxic_rows(600, 1), toxic_rows(300, 2)
    docs = spark.createDataFrame([r[:2] for r in train + test] + [(-1, None), (None, "x"), (-2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in train] + [(None, 1), (-1, None)], "doc_id long, toxic int")
    model = toxicity.fit_labelled(docs, labels)
    assert np.all(np.diff(model.thresholds) > 0)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, t, bad in test if len(re.findall("|".join(MARKS), t)) > 0 and not got[i].toxic or not bad and got[i].toxic]
    assert len(wrong) <= 6
    assert not got[-1].toxic and not got[-2].toxic
    many = np.mean([got[i].severity for i, t, b in test if len(re.findall("|".join(MARKS), t)) >= 5])
    one = np.mean([got[i].severity for i, t, b in test if len(re.findall("|".join(MARKS), t)) == 1])
    none = np.mean([got[i].severity for i, t, b in test if not b])
    assert many > one > none


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1), (2, 1)]])
def test_toxicity_without_both_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (2, "c")], "doc_id long, text string")
    model = toxicity.fit_labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len({r.p_toxic for r in toxicity.score(docs, model).collect()}) == 1


def test_ordinal_gradient_lowers_loss():
    toxic = np.arange(60) % 3 == 0
    row, bucket = np.arange(60), np.where(toxic, 7, 9)
    m = toxicity.fit(toxic, row, bucket, np.ones(60, np.float32), np.ones(60, bool))
    up = m.probabilities(m.weights[bucket])
    assert (up[toxic, 0] > 0.9).all() and (up[~toxic, 0] < 0.1).all()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def test_html_main_text(spark):
    page = ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a href=x>m</a></nav>"
            "<header>h</header><div class='ad box'>buy</div><article><h1>Head &amp; line</h1><p><b>one\n two<br>three<p>four &lt;x&gt; &copy;</p>"
            "<!-- <p>no</p> --><form>f</form><div id=comments><p>c</p></div><aside>s</aside><ul><li>i1<li>i2</ul>end</article><footer>f</footer>")
    got = html.extract(pages(spark, [(1, "http://a/1", page, "old"), (2, None, None, ""), (3, "http://a/2", "", ""), (4, "x", "a < b <em>c</em>", "")])).collect()
    text = {r.page_id: r.text for r in got}
    assert text == {1: "Head & line\n\none two three\n\nfour <x> ©\n\ni1\n\ni2\n\nend", 2: "", 3: "", 4: "a < b c"}
    assert {r.page_id: r.n_chars for r in got} == {i: len(t) for i, t in text.items()}
    assert got[0].url is None or "html" not in got[0].asDict()


@pytest.mark.parametrize("page", [
    '<html><body class="no-sidebar"><p>kept</p></body></html>', '<body class="sidebar" id=header><p>kept</p>',
    '<article class="post has-comments"><p>kept</p></article>', '<main id="comments"><p>kept</p></main>',
    '<div id="content" class="header-fixed"><p>kept</p></div>', '<div class="ad-free two_menu"><p>kept</p></div>',
    '<div data-role="form" data-id="menu"><p>kept</p></div>',
    '<div class="x sidebar">s</div><div class="cookie_banner">c</div><div id=site-footer>f</div><div role=banner>b</div><p>kept</p>'])
def test_html_drops_by_whole_names_only(page):
    assert [text for _, _, text in html.blocks(page)] == ["kept"]


def test_html_keeps_text_beside_an_article():
    got = html.blocks("<body><div><p>body one</p><p>body two</p></div><article><p>teaser</p></article><div class=ad>x</div></body>")
    assert [text for _, _, text in got] == ["body one", "body two", "teaser"]


def test_site_style_tree_cuts_template_branches(spark):
    rows = [(i, "http://s.com/%d" % i, f"<div><section><p>Always the same line</p></section><p>{prose(i, 12)}</p><p>{prose(100 + i, 5)}</p></div>", "")
            for i in range(12)]
    rows += [(99, "http://t.com/", "<div><section><p>Always the same line</p></section><p>own</p></div>", "")]
    text = {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}
    assert all("Always" not in text[i] and len(text[i].split("\n\n")) == 2 for i in range(12))
    assert text[99] == "Always the same line\n\nown"  # one page is no template


def test_site_style_tree_cuts_notices_and_keeps_copies(spark):
    table = "<article><table><tr><td>%s</td></tr></table></article>"
    notice = "<body class='page-%d'><div%s><p>Same legal notice</p></div><div%s><p>%s</p><p>%s</p></div></body>"
    rows = []
    for i in range(12):
        a, b = prose(i, 12), prose(100 + i, 9)
        rows.append((i, f"http://plain.com/{i}", notice % (i, "", "", a, b), ""))  # a notice shares its path with the article
        rows.append((100 + i, f"http://named.com/{i}", notice % (i, " class=legal", f" class='body post-{i}'", a, b), ""))
        rows.append((200 + i, f"http://mixed.com/{i}", f"<div><p>{a}</p></div>", ""))
    rows += [(300 + i, f"http://mixed.com/?copy={i}", table % "one page under many URLs", "") for i in range(7)]
    rows += [(400 + i, f"http://copies.com/?copy={i}", table % "a host of copies", "") for i in range(7)]
    rows += [(500 + i, f"http://article.com/{i}", f"<article><p>{prose(i, 9)}</p><p class=ftr>Always here</p></article>", "") for i in range(5)]
    rows += [(600 + i, f"http://often.com/{i}", f"<p>{prose(i, 9)}</p>" + "<p>On some pages</p>" * (i < 40), "") for i in range(100)]
    text = {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}
    squeeze = lambda i, n: " ".join(prose(i, n).split())
    for i in range(12):
        assert text[i] == text[100 + i] == squeeze(i, 12) + "\n\n" + squeeze(100 + i, 9)
        assert text[200 + i] == squeeze(i, 12)
    assert {text[300 + i] for i in range(7)} == {"one page under many URLs"}
    assert {text[400 + i] for i in range(7)} == {"a host of copies"}
    assert all(text[600 + i].endswith("On some pages") for i in range(40))
    assert [text[500 + i] for i in range(5)] == [squeeze(i, 9) for i in range(5)]


def test_html_is_linear_in_broken_markup():
    assert html.blocks('<a "' * 20_000) == []
    assert len(html.blocks("<div><p>x" * 5_000)) == 5_000
    assert html.blocks("<p>cut &am") == [("p", "", "cut &am")]


def test_quality_cleans_lines(spark):
    good = prose(1, 80)
    text = "Home | News | Shop | Login\n" + good + "\nAll rights reserved\nwhat $$$ now &&& ###\n\nFragment"
    r = quality.judge(spark.createDataFrame([(1, text, "extra"), (2, None, "e")], "doc_id long, text string, kept string")).collect()
    one = next(x for x in r if x.doc_id == 1)
    assert one.kept and one.n_failed_lines == 4 and one.clean_text == good + "\n"
    assert not next(x for x in r if x.doc_id == 2).kept


def test_quality_colliding_windows_take_the_exact_path(spark, monkeypatch):
    """With every window hash equal, the counts must not change."""
    rows = [(1, "a b c d a b c e a b"), (2, "x y z " * 20), (3, prose(2, 40)), (4, "q w e r")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r.doc_id: r.n_repeat_words for r in quality.judge(df).collect()}
    assert want[1] == 6 and want[2] == 60
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(0).cast("long"))
    assert {r.doc_id: r.n_repeat_words for r in quality.judge(df).collect()} == want


def test_secrets_link_complementary_parts(spark):
    rows = [(1, "user=bob and pwd=abcd"), (2, "pwd=abcd alone"), (3, "user=bob" + " x" * 200 + " pwd=abcd"), (4, "https://h.example/x only"),
            (5, "éé user: joe pass = qwer https://db.example.com/"), (6, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.scan(df).collect()}
    assert spans == {1: "id:0:8,pass:13:21", 2: "", 3: "", 4: "", 5: "id:3:12,pass:13:24,url:25:48", 6: "", 7: ""}
    clean = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert clean[1] == "[SECRET] and [SECRET]" and clean[2] == rows[1][1] and clean[6] is None and clean[5] == "éé [SECRET] [SECRET] [SECRET]"


def test_secret_positions_over_many_matches(spark):
    text = "é secret=abcdefghijkl " * 700
    r = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    want = ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer(r"secret=[a-z]+", text))
    assert r.n_assign == 700 and r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_urls_propagate_distrust_along_links(spark):
    rows = [(i, "http://farm.com/%d" % i, "<a href='http://bad.net/'>x</a>") for i in range(3)]
    rows += [(10, "http://bad.net/1", ""), (11, "http://fine.com/1", "<a href='http://ok.org/'>o</a>"), (12, "http://ok.org/fr/1", "")]
    rows += [(20, "http://unseen.com/", "<a href='http://never-crawled.net/'>x</a>")]
    rows += [(21, "http://mostly.com/", "<a href='http://bad.net/'>x</a>" + "".join(f"<a href='http://h{i}.com/'>y</a>" for i in range(9)))]
    rows += [(30 + i, f"http://c{i}.com/", f"<a href='http://c{i + 1}.com/'>n</a>" if i < 14 else "<a href='http://far.net/'>x</a>") for i in range(15)]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[10].rule == "net/" and got[10].verdict == "block" and got[12].verdict == "allow"
    assert got[0].verdict == got[20].verdict == "block" and got[0].distrust == pytest.approx(1) and got[11].verdict == "allow"
    assert got[21].verdict == "allow" and 0 < got[21].distrust < 0.5
    # Along a chain the share falls with the length, but reaches all of it.
    chain = [got[44 - i].distrust for i in range(15)]
    assert all(a > b > 0 for a, b in zip(chain, chain[1:])) and got[44].verdict == "block"


def test_url_shares_equal_dense_solution(spark):
    edges = [("a", "b", 2), ("b", "c", 1), ("c", "a", 1), ("a", "c", 1), ("d", "a", 3)]
    hosts = [("a", 4, 1, 0), ("b", 2, 0, 2), ("c", 1, 0, 0), ("d", 5, 0, 1)]
    got = {r.host: r for r in urls.propagate(spark.createDataFrame(hosts, "host string, pages long, allowed long, blocked long"),
                                             spark.createDataFrame(edges, "src string, dst string, n long")).collect()}
    names = [h[0] for h in hosts]
    w = np.zeros((4, 4))
    for a, b, n in edges:
        w[names.index(a), names.index(b)] = n

    def rank(m, seed):
        p = m / np.maximum(m.sum(1, keepdims=True), 1)
        return np.linalg.solve(np.eye(4) - urls.DAMPING * p.T, (1 - urls.DAMPING) * seed)

    base, good, bad = (np.array([h[i] for h in hosts], float) for i in (1, 2, 3))
    own = np.where(good + bad == 0, (1 - urls.DAMPING) * base, 0)
    trust, distrust = rank(w, good) / (rank(w, base) - own), rank(w.T, bad) / (rank(w.T, base) - own)
    for i, n in enumerate(names):
        assert got[n].trust == pytest.approx(trust[i], abs=0.01) and got[n].distrust == pytest.approx(distrust[i], abs=0.01)


def test_mix_reaches_targets_and_agrees_on_reruns(spark):
    rows = [(i, prose(i, 5 + i % 40), f"s{i % 5}" if i % 11 else None) for i in range(200)] + [(500, prose(1, 2000), "s0")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in mix.mix(df, keep_text=False).orderBy("doc_id").collect()]
    assert got == [tuple(r) for r in mix.mix(df.repartition(7), keep_text=False).orderBy("doc_id").collect()]
    by = {}
    for _, source, size, _, target, taken in got:
        by.setdefault(source, [target, 0])[1] += taken
        assert 0 <= taken <= 3 * size
    assert all(abs(t - n) <= 1 for t, n in by.values())
    total = sum(r[2] for r in got)
    assert sum(t for t, _ in by.values()) == pytest.approx(total)


def test_mix_blocks_do_not_change_the_selection(spark):
    df = spark.createDataFrame([(i, prose(i, 20), "a" if i % 3 else "b") for i in range(60)], "doc_id long, text string, source string")
    one, many = (sorted((r.doc_id, r.taken) for r in mix.mix(df, blocks=b).collect()) for b in (1, 64))
    assert one == many


def test_clashing_columns_are_replaced(spark):
    df = spark.createDataFrame([(1, prose(1, 60), "a", "x", 5)], "doc_id long, text string, source string, `Taken` string, `a.b` int")
    assert "a.b" in mix.mix(df).columns and [c.lower() for c in mix.mix(df).columns].count("taken") == 1


@pytest.mark.parametrize("page,want", [
    ('<article><p>the article</p></article><section class="reader-comments"><p>I say</p></section>', ["the article"]),
    ('<div><p>the article</p></div><div class="user-comments"><p>I say</p></div>', ["the article"]),
    ('<p>the article</p><div class="comment-12"><p>a comment that is longer than all of the article</p></div>', ["the article"]),
    ('<p>the article</p><div id="comments-section-12"><p>I say</p></div><div class=commentList>x</div>', ["the article"]),
    ('<p>the article</p><div class="cookiebar">We use</div><div class="site-banner">Buy</div><div class=adBox>Buy</div>', ["the article"]),
    ('<div class="entry share"><p>body</p></div>', ["body"]),
    ('<p>Notice: <span class="notice">important</span> text</p>', ["Notice: important text"]),
    ('<article><header><h1>Title</h1></header><p>text</p></article><header>site</header>', ["Title", "text"]),
    ('<article><div class="post-header"><h1>Title</h1></div><p>text of it</p></article>', ["Title", "text of it"]),
    ('<div class="share-price-table">1 2 3</div><p>text that is longer</p>', ["1 2 3", "text that is longer"]),
    ('<div class="ad">an advert that is longer than the article</div><article><p>short</p></article>', ["short"]),
    ('<article><h1>Title</h1><div class="entry share"><p>the body of it</p></div></article>', ["Title", "the body of it"]),
    ('<div class="comments"><p>nothing else</p></div>', ["nothing else"])])
def test_html_names(page, want):
    assert [text for _, _, text in html.blocks(page)] == want


def test_small_hosts_have_a_tree(spark):
    """Two different pages are enough for a branch; near copies and shared passages
    are no template."""
    line = "<div class=legal><p>Always the same line</p></div>"
    rows = [(i, f"http://two.com/{i}", f"{line}<article><p>{prose(i, 20)}</p><p>A passage in both</p></article>", "") for i in range(2)]
    near = [f"<p>{prose(50 + k, 10)}</p>" for k in range(9)]
    rows += [(10 + i, f"http://near.com/{i}", "".join(near[:i] + [f"<p>edited {i}</p>"] + near[i + 1:]), "") for i in range(2)]
    text = {r.page_id: r.text.split("\n\n") for r in html.extract(pages(spark, rows)).collect()}
    assert [len(text[i]) for i in (0, 1, 10, 11)] == [2, 2, 9, 9]
    assert "Always the same line" not in text[0] + text[1] and text[0][1] == "A passage in both"


def test_style_tree_equals_brute_force(spark):
    import math
    import random
    from collections import defaultdict

    r = random.Random(3)
    rows = []
    for host in range(3):
        for i in range(2 + 4 * host):
            parts = [f"<p>{r.choice('abc')}{r.randint(0, 4)}</p>" for _ in range(4)] + [f"<div><b>{r.choice('xy')}</b></div>"] * r.randint(0, 2)
            rows.append((len(rows), f"http://h{host}/", "".join(parts), ""))
    tree = html.style_tree(spark.createDataFrame([(u.split("/")[2], h) for _, u, h, _ in rows], "host string, html string"))
    shows, have, looks = defaultdict(set), defaultdict(set), defaultdict(lambda: defaultdict(set))
    for _, url, page, _ in rows:
        host, found = url.split("/")[2], tuple(html.blocks(page))
        for path, inline, text in found:
            shows[host, path, text].add(found)
            have[host, path].add(found)
            looks[host, path][inline].add(found)
    want = {}
    for (host, path), pages_ in have.items():
        m = len(pages_)
        if m < 2:
            continue
        n = [len(x) for x in looks[host, path].values()]
        presentation = min(1.0, -sum(x / sum(n) * math.log(x / sum(n)) for x in n) / math.log(m))
        each = {t: len(s) for (h, p, t), s in shows.items() if (h, p) == (host, path)}
        whole = lambda c: (1 - html.GAMMA) * presentation + html.GAMMA * c  # noqa: B023, E731
        branch = sum(k * whole(1 - math.log(k) / math.log(m)) for k in each.values()) / sum(each.values())
        for t, k in each.items():
            if k > 1:
                want[host, path, html._content(path, t)] = (k, m, round(whole(1 - math.log(k) / math.log(m + html.PRIOR)), 9), round(branch, 9))
    got = {(x.host, x.path, x.content): (x.shown, x.pages, round(x.importance, 9), round(x.branch, 9)) for x in tree.collect()}
    assert got == want and len(want) > 10
