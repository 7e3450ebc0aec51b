import random

from maskwright.llm.sitetree import Page, SiteRule, main_texts

from .conftest import prose


def text_of(html):
    return "\n".join(Page(html).main_text({}, SiteRule()))


def test_markup():
    cases = [
        ("<nav>menu</nav><article><h1>A &amp; B</h1><p>one <b>two</b><br>three<p>four</article><footer>f</footer>", "A & B\none two three\nfour"),
        ("<body><header>site</header><div class=content>x<div class='side-bar sidebar'>s</div> y</div><aside>z</aside>", "x\ny"),
        ("<article><header><h1>t</h1></header><p>b</p><section class='comments'><article>reader</article></section></article>", "t\nb"),
        ("<article><p>a<script>var s='</p><article>';</script>b<!-- <p> c --> d<style>p{}</style></article>", "ab d"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo\na\nb\nc"),
        ("<article><p title=\"a > b\">x</p><form><p>q</p></form><div class='ad-slot'>buy</div><p>y &lt;z&gt; &amp &#233; &nosuch;</p></article>", "x\ny <z> & é &nosuch;"),
        ("<div class=article>only<div>deep</div></div>", "only\ndeep"),
        ("plain\n text", "plain text"),
        ("<p>unclosed <b>bold <p>next</i></p></div> tail", "unclosed bold\nnext\ntail"),
        ("<article><p>cut off here <a href='x", "cut off here"),
        ("<!-- never ends <p>x</p>", ""),
        ("<article>a<p hidden>h</p><p style='display: none'>n</p><div role=navigation>r</div><span class=share>s</span>b</article>", "a\nb"),
        ("<main><p>m</p></main><article class='teaser'>t</article>", "m"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<div class='cookie-notice'>ok?</div><p>text</p>", "text"),
        ("", ""),
    ]
    for html, want in cases:
        assert text_of(html) == want, html


def test_long_and_hostile_pages():
    assert len(text_of("<article>" + "<p>word</p>" * 50_000 + "</article>").split("\n")) == 50_000
    assert text_of("<div>" * 20_000 + "deep") == "deep"
    Page("<p a=\"" * 30_000 + "x")
    Page("<a" * 100_000)
    Page("<p a=\"" * 30_000 + ">x" * 100)
    Page("<" * 100_000)
    Page("<!" * 50_000)


def pages(rng, host, n, wrap):
    slots = [prose(rng, 6) for _ in range(3)]
    out = []
    for _ in range(n):
        body = [prose(rng, rng.randint(5, 30), 5000) for _ in range(rng.randint(2, 9))]
        out.append((f"https://{host}/{len(out)}", wrap(rng.choice(slots), body), "\n".join(body)))
    return out


def test_low_importance_branches_go(spark):
    rng = random.Random(4)
    plain = lambda slot, body: f"<div class=k1><div>{slot}</div></div><div class=k2>{''.join(f'<p>{b}</p>' for b in body)}</div><div class=k3>{slot}</div>"
    article = lambda slot, body: f"<article>{''.join(f'<p>{b}</p>' for b in body)}<div class=k9>{slot}</div></article>"
    rows = pages(rng, "a.example", 60, plain) + pages(rng, "B.example:80", 60, article)
    copies = [(f"http://copies.example/{i}", article("slot", ["one and the same text", "twice"]), "one and the same text\ntwice") for i in range(50)]
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h, _) in enumerate(rows + copies)], "page_id long, url string, html string, host string, node int").repartition(5)
    for rule in (SiteRule(), SiteRule(broadcast_nodes=0)):
        got = {r.page_id: r.text for r in main_texts(frame, rule=rule).collect()}
        assert all(got[i] == want for i, (_, _, want) in enumerate(rows))
        assert all(want in got[len(rows) + i] for i, (_, _, want) in enumerate(copies))


def test_short_articles_in_long_templates_and_on_small_sites(spark):
    rng = random.Random(7)
    rows = []
    for host, n in (("large.example", 40), ("small.example", 4)):
        around = [prose(rng, 60) for _ in range(5)]
        for i in range(n):
            body = prose(rng, 12, 5000)
            rows.append((f"https://{host}/{i}", f"<div class=w>{''.join(f'<div class=b{j}>{x}</div>' for j, x in enumerate(around[:3]))}<div class=k><p>{body}</p></div>{''.join(f'<div class=c{j}>{x}</div>' for j, x in enumerate(around[3:]))}</div>", body))
    rows += [(f"https://same.example/{i}", "<div class=a>one</div><div class=b>two</div>", "one\ntwo") for i in range(20)]
    frame = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in main_texts(frame).collect()}
    assert [got[i] for i in range(len(rows))] == [want for *_, want in rows]


def test_nulls_ties_and_no_rows(spark):
    rows = [(1, None, "<p>a</p>"), (2, "http://x.example/", None), (2, "http://x.example/", ""), (None, "no url", "<p>b</p>"), (5, "http://x.example/", "<p>é</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.text, r.n_chars) for r in main_texts(frame).collect()) == [("", 0), ("", 0), ("a", 1), ("b", 1), ("é", 1)]
    assert main_texts(frame.limit(0)).count() == 0 and main_texts(frame).columns == ["page_id", "url", "text", "n_chars"]


def test_the_trees_do_it_without_markup(spark):
    """Menus, notices, adverts and footers that a site repeats go by entropy alone, with all lists of tags, classes and roles switched off; without the trees they stay."""
    rng = random.Random(11)
    rows = []
    for host in ("one.example", "two.example"):
        menu, foot, notice, adverts = prose(rng, 12), prose(rng, 9), prose(rng, 15), [prose(rng, 8) for _ in range(4)]
        for i in range(40):
            body = [prose(rng, rng.randint(8, 30), 5000) for _ in range(rng.randint(2, 6))]
            html = f"<nav><ul><li>{menu}</ul></nav><div class=cookie>{notice}</div><div class=ad>{rng.choice(adverts)}</div><article>{''.join(f'<p>{b}</p>' for b in body)}</article><footer>{foot}</footer>"
            rows.append((f"https://{host}/{i}", html, "\n".join(body)))
    frame = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], "page_id long, url string, html string").repartition(4)
    of = lambda rule: {r.page_id: r.text for r in main_texts(frame, rule=rule).collect()}
    alone, neither = of(SiteRule(markup=False)), of(SiteRule(markup=False, least=0.0))
    assert all(alone[i] == want for i, (*_, want) in enumerate(rows))
    assert not any(neither[i] == want for i, (*_, want) in enumerate(rows))
