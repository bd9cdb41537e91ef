from marquee.sources import pages

METACRITIC = """<!DOCTYPE html><html><head><script>var x = '<div data-testid="hero-metadata"><li><span>1800</span></li></div>';</script></head>
<body><!-- <div data-testid="hero-metadata"><li><span>1700</span></li></div> -->
<div class="x" data-testid="hero-metadata"><ul><li><span> 1994
</span></li><li><span>2 h</span></li></ul></div>
<div data-testid="critic-score-info"><div><div>Generally<br>Favorable</div>
<a data-testid="critic-path" href="/c?a=1&amp;b=2"><span>Based on 1,234 Critic Reviews</span></a></div>
<div class="c-siteReviewScore g-bg-green"><span>82</span></div></div>
<DIV data-testid='user-score-info'><a data-testid=user-path><span>Based on <b>1</b>,234 User Ratings</span></a>
<div class="c-siteReviewScore"><span>8.9</span></div></div></body></html>"""

TOMATOES = """<html><body><media-scorecard>
<div class="layout media-scorecard no-border">
<rt-text slot="criticsScore" size="1.375">97%</rt-text>
<rt-link slot="criticsReviews"> 77 Reviews </rt-link>
<rt-text slot="audienceScore">&nbsp;98%</rt-text>
<rt-link slot="audienceReviews">250,000+ Ratings</rt-link></div></media-scorecard>
<rt-text slot="metadataProp">R</rt-text><rt-text slot="metadataProp">Released Sep 23, 1994</rt-text>
<rt-text slot="metadataProp">Streaming 2019</rt-text></body></html>"""


def frame(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")


def test_metacritic_page(spark):
    [row] = pages.extract_metacritic(frame(spark, METACRITIC)).drop("page_id").collect()
    assert row.asDict() == {
        "year": 1994, "critic_score": 82.0, "critic_count": 1, "user_score": 8.9,
        "user_count": 1234, "data_source": "metacritic",
    }


def test_metacritic_fields_fail_alone(spark):
    no_year = METACRITIC.replace(' 1994\n', "soon")
    tbd = METACRITIC.replace("<span>82</span>", "<span>tbd</span>")
    no_box = METACRITIC.replace("c-siteReviewScore g-bg-green", "other")
    got = {r.page_id: r for r in pages.extract_metacritic(frame(spark, METACRITIC, no_year, tbd, no_box, "", None, "<p>")).collect()}
    assert set(got) == {0, 2, 3}
    assert got[2].critic_score is None and got[2].critic_count == 1
    # The score box of the users' section does not stand in for the critics'.
    assert got[3].critic_score is None and got[3].user_score == 8.9


def test_an_element_ends_at_its_own_end_tag(spark):
    scores = '<div class="c-siteReviewScore"><span>82</span></div>'
    beside = METACRITIC.replace('<div class="c-siteReviewScore g-bg-green"><span>82</span></div></div>',
                                '</div><div class="c-siteReviewScore"><span>55</span></div>')
    nested = METACRITIC.replace('<div class="c-siteReviewScore g-bg-green"><span>82</span></div></div>',
                                f"<div><div></div><br/><img src='</div>'>{scores}</div></div>")
    assert beside != METACRITIC != nested
    got = {r.page_id: r for r in pages.extract_metacritic(frame(spark, beside, nested)).collect()}
    assert [got[i].critic_score for i in (0, 1)] == [None, 82.0] and got[0].user_score == 8.9
    aside = """<div class="media-scorecard"><div><rt-text slot="audienceScore">60%</rt-text></div></div>
<aside><rt-text slot="criticsScore">12%</rt-text></aside>"""
    deep = aside.replace("</div></div>", '</div><p><rt-text slot="criticsScore">99%</rt-text></div>')
    got = pages.extract_rotten_tomatoes(frame(spark, aside, deep)).orderBy("page_id").collect()
    assert [(r.critic_score, r.user_score, r.has_scorecard) for r in got] == [(None, 60.0, True), (99.0, 60.0, True)]


def test_open_and_stray_tags(spark):
    rule = pages.Rule("text", (pages.Step("section"), pages.Step("div"), pages.Step("b")))
    assert fields(spark, "<section><div><p></section><b>x</b>", rule) is None
    assert fields(spark, "<section></div></p><div><i><b>x</section></b>", rule) == "x"
    assert fields(spark, "<section><div/><b>x</b></section>", rule) is None
    assert fields(spark, "<SECTION><Div><section></section><input><b>x<i>y</i></B></div>", rule) == "xy"


def test_first_match_is_not_retried(spark):
    html = METACRITIC.replace("<ul><li><span> 1994\n</span></li>", "<ul><li>none</li>")
    assert pages.extract_metacritic(frame(spark, html)).count() == 0


def test_rotten_tomatoes_page(spark):
    [row] = pages.extract_rotten_tomatoes(frame(spark, TOMATOES)).drop("page_id").collect()
    assert row.asDict() == {
        "years": [1994, 2019], "has_scorecard": True, "critic_score": 97.0, "critic_count": 77,
        "user_score": 98.0, "user_count": "250,000+", "data_source": "rottentomatoes",
    }


def test_rotten_tomatoes_without_scorecard(spark):
    bare = TOMATOES.replace("media-scorecard", "section")
    one = TOMATOES.replace('slot="audienceScore"', 'slot="other"')
    got = pages.extract_rotten_tomatoes(frame(spark, bare, one)).orderBy("page_id").collect()
    assert [r.has_scorecard for r in got] == [False, False]
    assert [r.critic_score for r in got] == [None, 97.0]
    assert got[1].user_score is None


def fields(spark, html, *rules):
    [row] = pages.extract(frame(spark, html), list(rules)).collect()
    return row[1:] if len(rules) > 1 else row[1]


def test_odd_markup(spark):
    first = pages.Rule("first", (pages.Step("div", "id", "a"), pages.Step("p")))
    every = pages.Rule("all", (pages.Step("i"),), every=True)
    assert fields(spark, '<div id=a><img src="x>y"><br/><p>1 &lt; 2</p></div>', first) == "1 < 2"
    assert fields(spark, '</p></div><div id="a" title="</div>"><P>x</P></div>', first) == "x"
    assert fields(spark, "<div/><div id='b'></div><p>x</p>", first) is None
    assert fields(spark, "<i>a</i><script>'<i>b</i>'</script><!-- <i>d</i> --><i>c</i>", every) == ["a", "c"]
    assert fields(spark, '<div id="a"><p>open', first, every) == ("open", [])
    assert fields(spark, "", first, every) == (None, [])
    assert fields(spark, None, first) is None
    assert fields(spark, '<div class="x"><p>no</p></div><div data-id="a"><p>no</p></div>', first) is None


def test_every_quoting_and_entities(spark):
    lang, link = pages.Rule("lang", (pages.Step("html"),), attribute="lang"), pages.Rule("link", (pages.Step("a"),), attribute="href")
    title = pages.Rule("title", (pages.Step("title"),))
    assert fields(spark, "<title>&apos;&nbsp;&NotEqualTilde;&nope;&#0;&fjlig;</title>", title) == "'\xa0\u2242\u0338&nope;\ufffdfj"
    assert fields(spark, "<html lang=en><title>A &amp; B &#233;&#x1F600; &amp;lt;</title><a href='/q'>", lang, title, link) == (
        "en", "A & B é\U0001F600 &lt;", "/q")
    assert fields(spark, '<HTML class="x" LANG = "fr"><!-- <title>no</title> <a href="/no"> --><a name="n">1</a><a href="/two">', lang, title, link) == (
        "fr", None, None)


def test_long_pages_and_many_attributes(spark):
    html = "<p " + " ".join(f'a{i}="{i}"' for i in range(300)) + ">x</p>" + "<b>y" * 50_000 + '<a href="/end">'
    assert fields(spark, html, pages.Rule("p", (pages.Step("p"),)), pages.Rule("a", (pages.Step("a"),), attribute="href")) == ("x", "/end")


def test_no_python_on_the_way(spark):
    for read in (pages.extract_metacritic, pages.extract_rotten_tomatoes):
        plan = read(frame(spark, METACRITIC))._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "EvalPython" not in plan
        assert "Contains" in plan or "contains" in plan


def test_flat_rules(spark):
    html = '<HTML lang="fr"><head>\n<title>\nA "b" c</title></head><a class="x" href="/one">1</a><a href="/two">2</a></HTML>'
    assert fields(
        spark, html, pages.Rule("lang", (pages.Step("html"),), attribute="lang"),
        pages.Rule("title", (pages.Step("title"),), pattern='"(.*)"'), pages.Rule("link", (pages.Step("a"),), attribute="href"),
        pages.Rule("number", (pages.Step("a"),), kind="int"), pages.Rule("absent", (pages.Step("h1"),)),
    ) == ("fr", "b", "/one", 1, None)


def test_slug_of_url(spark):
    urls = [("https://x/movie/the-film/?q=1",), ("https://x/movie/",), ("https://x/m/the_film",)]
    rows = spark.createDataFrame(urls, "u string").select(pages.slug_of_url("u", "movie").alias("s"))
    assert [r.s for r in rows.collect()] == ["the-film", None, None]


def test_extracted_pages_feed_a_source(spark):
    from marquee.operators import enrich

    enrich.register_source(enrich.ScoreSource(
        name="crawl", match="candidates", sep="_", fields={"critic_score": "crawl_score"},
        extractor=lambda df: pages.extract_rotten_tomatoes(df).withColumn(
            "slug", pages.slug_of_url("url", "m")
        ),
        enhanced_at="crawl_at",
    ))
    crawled = spark.createDataFrame([("https://x/m/zed/", TOMATOES)], "url string, html string")
    movies = spark.createDataFrame([(1, "Zed", 1996), (2, "Zed", 1960)], "tmdb_id int, title string, year int")
    got = enrich.enrich(movies, "now", {"crawl": crawled}).orderBy("tmdb_id").collect()
    assert [(r.crawl_score, r.crawl_at) for r in got] == [(97.0, "now"), (None, None)]


def test_rules_agree_with_the_standard_parser(spark):
    """Whole pages of the test table, read a second time with the library's event parser."""
    import os
    from html.parser import HTMLParser

    import pytest

    path = "/root/testdata/sf0.01/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")

    class Texts(HTMLParser):
        """Text inside each element that holds none of its own kind, by tag, in order."""

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.open, self.found = [], {}

        def handle_starttag(self, tag, attrs):
            if tag in ("meta", "br", "img", "hr", "input", "link"):
                return
            self.open.append((tag, []))
            self.found.setdefault(tag, []).append(self.open[-1][1])

        def handle_endtag(self, tag):
            if any(name == tag for name, _ in self.open):
                while self.open.pop()[0] != tag:
                    pass

        def handle_data(self, data):
            if not (self.open and self.open[-1][0] in ("script", "style")):
                for _, pieces in self.open:
                    pieces.append(data)

    tags = ("title", "h1", "a", "footer", "article")
    rules = [pages.Rule(tag, (pages.Step(tag),)) for tag in tags]
    rules.append(pages.Rule("links", (pages.Step("a"),), every=True))
    table = spark.read.parquet(path)
    texts = {r.page_id: r.html for r in table.collect()}
    for row in pages.extract(table, rules).collect():
        expected = Texts()
        expected.feed(texts[row.page_id])
        expected.close()
        for tag in tags:
            found = expected.found.get(tag)
            assert row[tag] == ("".join(found[0]) or None if found else None)
        assert row.links == ["".join(t) for t in expected.found.get("a", [])]


def test_no_expression_is_copied(spark):
    """The filter stays above the page's reading, and each pattern is in the plan once."""
    plan = pages.extract_metacritic(frame(spark, METACRITIC))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Filter" in line)
    assert "regexp_extract(" in "".join(lines[at + 1:]) and "regexp_extract_all" not in lines[at]
    for value in ("hero-metadata", "critic-path", "user-path"):
        assert plan.count(f'"{value}"') + plan.count(f'"{value.replace("-", chr(92) + "-")}"') == 1, value
