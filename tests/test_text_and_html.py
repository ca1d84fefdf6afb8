import pytest
from pyspark.sql import functions as F

from pressmill.functions import html as M
from pressmill.functions import text as X
from pressmill.functions import urls as U
from pressmill.functions.selectors import Sheet, parse
from pressmill.operators import extract as E
from pressmill.operators import links as L
from pressmill.plans.link_profiles import link_profiles_frame
from pressmill.plans.profiles import PROFILES, profiles_frame


def _apply(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("raw"))).collect()]


def test_space_is_unicode(spark):
    assert _apply(spark, X.clean_line, [" a  b\x1c　", None, " \t\n"]) == ["a b", "", ""]
    assert _apply(spark, X.clean_block, [" a \t b\n\n\n\nc "]) == ["a b\n\nc"]


def test_strip_markup_keeps_null_like_texts(spark):
    assert _apply(spark, X.strip_markup, ["<b>x</b>  y", "NULL", "", None, "a  <"]) == ["x y", "NULL", "", None, "a <"]


def test_clean_strict(spark):
    got = _apply(spark, X.clean_strict, [
        "<p>Hola &amp;quot; <script>x</script>\"sí\"|</p>😀??? ¿ya?", None, "a" * 30001, "1 < 2"])
    assert got[0] == "Hola quot; 'sí' ¿ya?"
    assert got[1] == ""
    assert got[2] == "a" * 30001
    assert _apply(spark, X.spreadsheet_cell, ["a" * 30001, "b"]) == ["a" * 30000 + "... [truncado]", "b"]
    assert got[3] == "1 2"


def test_entities(spark):
    assert _apply(spark, M.decode_entities, [
        "&aacute;&#233;&#x1F600;&nope; &amp;lt; &#38;quot; &#0; &lt;", "&rarr;&Agrave;&oelig;&#150;&NotEqualTilde;"]) == [
        "áé😀&nope; &lt; &quot; &#0; <", "→Àœ–≂̸"]


def test_title_case_and_slug(spark):
    assert _apply(spark, X.title_case, ["o'neil 3d-año"]) == ["O'Neil 3D-Año"]
    assert _apply(spark, lambda c: X.section_slug(c, True), ["+ Política  Única "]) == ["politica-unica"]


def test_unclosed_paragraphs_and_scripts(spark):
    page = ('<article><script>var t="</p>";</script><!-- <p>no</p> --><p><b>Uno <br>dos<p class="x">San <b>J</b>osé tres cuatro</p>'
            "<p>corto</p></article><p>fuera del todo y largo</p>")
    assert _apply(spark, lambda c: E.paragraphs(c, least=5), [page]) == [["Uno dos", "San José tres cuatro", "corto"]]


ACCEPTED = {
    "teletica": ("https://www.teletica.com/nacional/nota_1", "https://www.teletica.com/deportes/nota_1"),
    "lareaccioncr": ("https://lareaccioncr.com/2024/a/b/c/d", "https://lareaccioncr.com/2024/a/b"),
    "larevistacr": ("https://www.larevista.cr/una-nota/", "https://www.larevista.cr/2024/nota/"),
    "latejacr": ("https://www.lateja.cr/x/story/", "https://www.lateja.cr/x/"),
    "lavozdegoicoechea": ("https://lavozdegoicoechea.com/una-nota/", "https://lavozdegoicoechea.com/una-nota/?X"),
    "mundiario": ("/articulo/costa-rica/x.html", "/galeria/x.html"),
    "puroperiodismo": ("https://www.puroperiodismo.com/2024/x/", "https://www.puroperiodismo.com/opinion/x/"),
    "sinartdigital": ("https://sinartdigital.com/trecenoticias/pais/nota", "https://sinartdigital.com/trecenoticias/pais"),
    "vozdeguanacaste": ("https://vozdeguanacaste.com/nota/", "https://vozdeguanacaste.com/page2/"),
    "digital506": ("https://digital506.com/larga-nota/", "https://digital506.com/abc/"),
}


def test_article_urls(spark):
    rules = U.rules_frame(spark, 2024)
    rows = [(s, u, ok) for s, (yes, no) in ACCEPTED.items() for u, ok in ((yes, True), (no, False))]
    for source, prefix, _, least, _ in U.URL_RULES:
        if source not in ACCEPTED:
            rows += [(source, prefix + "/".join(f"p{i}" for i in range(max(least, 1))), True),
                     (source, "https://other.example.org/a/b/c", False)]
    df = spark.createDataFrame(rows, "source string, url string, want boolean")
    bad = df.join(rules, "source").where(U.is_article(F.col("url")) != F.col("want")).select("source", "url").collect()
    assert not bad


def test_section_base_is_no_article(spark):
    rules = U.rules_frame(spark, 2024).where("source = 'ticosland'")
    df = rules.select("*", F.explode(F.array(F.lit("https://ticosland.com/limon"), F.lit("https://ticosland.com/nota"))).alias("url"))
    bases = F.array(F.lit("https://ticosland.com/limon/"))
    assert [r[0] for r in df.orderBy("url").select(U.is_article(F.col("url"), section_urls=bases)).collect()] == [False, True]


def _read(spark, source, html, **change):
    profile = {**next(p for p in PROFILES if p["source"] == source), **change}
    df = spark.createDataFrame([(1, source, html)], "page_id int, source string, html string")
    return E.body_texts(df.join(profiles_frame(spark, [profile]), "source")).first()


LONG = "Este es un párrafo con bastante más de cuarenta caracteres en total."


def test_profile_container_order(spark):
    html = f'<div class="a entry-content"><p>no</p></div><article><p>{LONG}</p></article>'
    assert _read(spark, "eldelfino", html)["full_text"] == LONG
    assert _read(spark, "crhoy", '<div class="x wp-article">solo <i>te</i>xto</div>')["full_text"] == "solo texto"


def test_second_kind_of_container_is_read_whole(spark):
    html = ('<div class="td-post-content"></div><div class="tdb-block-inner"><p>primero y largo</p></div>'
            '<div class="tdb-block-inner"><p>segundo y largo</p><p>leer más de esto</p></div>')
    assert _read(spark, "elperiodicocr", html)["full_text"] == "primero y largo\n\nsegundo y largo"


def test_profile_nested_containers_and_removal(spark):
    html = (f'<div class="td-fix-index"><div><p>uno uno uno uno uno</p></div></div><div class="td-fix-index"><div><p>{LONG}</p>'
            f'<div class="related-posts"><p>{LONG} otra vez</p></div><p>{LONG}</p><p>dos dos dos dos dos</p></div></div>')
    row = _read(spark, "ticotimes", html)
    assert row["full_text"] == LONG + "\n\ndos dos dos dos dos"


def test_noise_rules_differ(spark):
    html = f'<article class="initial-load"><p>{LONG}</p><div class="share_ad"><p>{LONG} más</p></div></article>'
    assert _read(spark, "larepublica", html)["full_text"] == LONG
    assert _read(spark, "lanacion", html)["full_text"] == ""


def test_no_container_falls_back_to_long_paragraphs(spark):
    assert _read(spark, "larepublica", f"<p>{LONG}</p><p>corto</p>")["full_text"] == LONG
    assert _read(spark, "monumental", f"<p>{LONG}</p>")["full_text"] == ""


def test_selectors():
    def fits(css, *path):
        *above, (tag, given) = path
        return list(Sheet([("x", 0, css, "", "")]).matches(tag, given, above)) == [0]

    entry = ("div", {"class": "a entry-content read-details", "id": "the-post-9"})
    assert fits("div.entry-content.read-details", entry) and not fits("div.entry", entry) and fits('div[class*="entry"]', entry)
    assert fits('[id*="the-post"]', entry) and not fits("#the-post", entry) and fits('[id^="the-"]', entry) and fits('[id$="9"]', entry)
    assert fits("article div.a", ("article", {}), ("p", {}), entry) and not fits("article > div.a", ("article", {}), ("p", {}), entry)
    assert fits("article > p div", ("article", {}), ("p", {}), ("b", {}), entry) and not fits("main div", ("article", {}), entry)
    assert fits('article[class*="small single"]', ("article", {"class": "x small single"}))
    assert fits('[class*="READ" i]', entry) and not fits('[class*="READ"]', entry) and fits('[class*="read" i]', ("i", {"class": "READ"})) and fits("[noindex]", ("p", {"noindex": ""}))
    assert fits('[class%="ad"]', ("p", {"class": "my_ad-box"})) and not fits('[class%="ad"]', ("p", {"class": "load"}))
    with pytest.raises(ValueError):
        parse("div[")


def test_fields_of_outlets(spark):
    """Title, author, date and section by each outlet's own rules."""
    body = f"<p>{LONG}</p>" * 6
    cases = [
        ("crhoy", '<script id="__cr_post_meta">{"category":"Política Nacional","date":"2024-05-07 1:2"}</script><h1>T</h1><span>6 de Abr. 2024 | 1 am</span>'
                  f'<div class="wp-article">{body}</div>', ("T", "Sin autor", "2024-04-06", "politica-nacional")),
        ("crhoy", '<script id="__cr_post_meta">{"date":"2024-05-07 1:2"}</script><span class="bg-orange">Sucesos y más</span>'
                  f'<div class="wp-article">{body}</div>', (None, "Sin autor", "2024-05-07", "sucesos-y-mas")),
        ("diarioextra", '<script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","datePublished":"2024-05-01","articleSection":["A","B"]}]}</script>'
                        '<script type="application/ld+json">{"@type":"Article","datePublished":"2024-05-02"}</script><h1>no</h1>'
                        '<h1 class="single-layout__title">T</h1><a class="single-layout__author">Ana</a><div class="single-layout__article"><p>x</p></div>',
         ("T", "Ana", "2024-05-02", "A")),
        ("noticiasenlineacr", '<script type="application/ld+json">{"datePublished":"2024-05-01T06:00:00Z"}</script><meta property="article:published_time" '
                              f'content="2023-01-01T06:00:00Z"><article>{body}</article>', (None, "Sin autor", "2024-05-01 00:00:00", "Deportes")),
        ("costaricastar", '<script class="yoast-schema-graph">{"@graph":[{"@type":"WebPage","datePublished":"2024-05-01T06:00:00+00:00"}]}</script>'
                          f'<article>{body}</article>', (None, "Sin autor", "2024-05-01 06:00:00", "Deportes")),
        ("teletica", '<div class="authorDate"><span>Por Ana</span><span>25 de mayo de 2024, 18:50 PM</span></div><div class="text-editor"><h4>Nacional</h4>'
                     f'{body}</div>', (None, "Sin autor", "2024-05-25 18:50:00", "Nacional")),
        ("el_seminario", f'<article class="post category-vida-sana x"><time datetime="2024-05-01T01:00:00">ayer</time><div class="entry-content">{body}</div></article>',
         (None, "Sin autor", "2024-05-01T01:00:00", "Vida Sana")),
        ("larepublica", f'<div class="date">Jueves, 2 de mayo de 2024</div><a href="/seccion/x">mundo</a><article><a href="/autor/eva">Eva</a>{body}</article>',
         (None, "Eva", "2024-05-02", "Mundo")),
        ("telediario", f'<time class="x-datetime" datetime="21-05-2024 09:49">x</time><b data-camus-section="">País</b><span class="base__body">{body}</span>',
         (None, "Sin autor", "2024-05-21 09:49:00", "País")),
        ("el_jornal", f'<body><p>San José, 31 de octubre de 2024</p><a href="/category/pais">El País</a><article>{body}</article></body>',
         (None, "Sin autor", "2024-10-31", "el-pais")),
    ]
    for source, html, want in cases:
        got = _article_row(spark, html, source)
        assert (got["title"], got["author"], got["publication_date"], got["section"]) == want, source


def test_lead_least_text_and_own_noise(spark):
    lead = '<h2 class="single-layout__excerpt">Resumen</h2><div class="single-layout__article"><p>uno</p><blockquote><p>no</p></blockquote><p>dos</p></div>'
    assert _article(spark, lead, "diarioextra") == "Resumen uno dos"
    assert _article(spark, '<h2 class="single-layout__excerpt">Resumen</h2>', "diarioextra") == ""
    assert _article_row(spark, f'<div class="entry-content"><p>{LONG}</p></div>', "puntarenasseoye") is None
    own = '<div class="ue-l-article__body"><div class="ad"><p>bajo un anuncio</p></div><p class="paywall">no</p><p>sí</p></div>'
    assert _article(spark, own, "el_mundo") == "bajo un anuncio\n\nsí"


def test_blocks_or_whole_text_by_container(spark):
    html = ('<div class="element-textarea">Texto sin párrafos, entero.</div><div class="element-textarea"><p>Un párrafo bastante largo.</p><p>corto</p></div>'
            '<div class="element-textarea"><p>corto</p></div>')
    assert _article(spark, html, "sinartdigital") == "Texto sin párrafos, entero.\n\nUn párrafo bastante largo."


def test_pages_grow_linearly(spark):
    import time

    from pressmill.functions.outline import _Reader
    from pressmill.functions.selectors import sheet
    from pressmill.plans.profiles import profile_rows

    rules = sheet(tuple(profile_rows([p for p in PROFILES if p["source"] == "larepublica"])[0][1]))

    wide = lambda n: seconds_of("<article>" + "<div class='entry-content'><p>uno <b>dos</b></p></div>" * n + "</article>", rules)

    def seconds_of(page, rules):
        start = time.process_time()
        _Reader(rules).read(page).marks()
        return time.process_time() - start

    wide(100)
    assert min(wide(4000) for _ in range(3)) < 25 * max(min(wide(400) for _ in range(3)), 0.002)


def test_links(spark):
    html = ('<ul><li><a href="/a?x=1"><h3>1. Primera nota</h3></a></li><li><a href="/a">Repetida nota</a></li>'
            '<li><a href="http://z/b">corta</a></li><li><a href="">Sin dirección alguna</a></li></ul>')
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = L.page_links(pages, "https://s.org", 6).select("url", "title", "headed").collect()
    assert [tuple(r) for r in rows] == [("https://s.org/a", "Primera nota", True)]


def _article_row(spark, html, source="nobody"):
    pages = spark.createDataFrame([(1, source, "https://x/deportes/a", html)], "page_id long, source string, url string, html string")
    return E.articles(pages, profiles_frame(spark), "2024-06-15 12:00:00").first()


def _article(spark, html, source="nobody"):
    return _article_row(spark, html, source)["full_text"]


def test_nothing_around_the_container_is_removed(spark):
    body = "<p>Un texto que basta para el mínimo.</p><div class='share-box'><p>Comparta esto con sus amigos.</p></div>"
    assert _article(spark, f"<html><body class='social-enabled'><article>{body}</article></body></html>") == "Un texto que basta para el mínimo."


def test_open_head_ends_at_the_body(spark):
    body = "<article><p>Un texto que basta para el mínimo.</p></article>"
    for head in ("<head><title>t</title><body>", "<head><meta charset=utf-8>", "<head><style>x</style><div>"):
        assert _article(spark, head + body) == "Un texto que basta para el mínimo."


def test_teasers_belong_to_their_outlet(spark):
    page = "<{0}><p>Para leer más sobre este tema visite la página.</p></{1}>"
    assert _article(spark, page.format("article", "article")).startswith("Para leer más")
    assert _article(spark, page.format("div class='td-post-content'", "div"), "elperiodicocr") == ""


def test_unknown_outlets_are_read_by_the_plain_profile(spark):
    assert _article(spark, "<main><p>Un texto que basta para el mínimo.</p></main>", "nobody knows") == "Un texto que basta para el mínimo."


def _listed(spark, source, html):
    pages = spark.createDataFrame([(1, source, "https://x/", html)], "page_id long, source string, url string, html string")
    rows = L.listing_links(pages, link_profiles_frame(spark), 2024).collect()
    return sorted((r["seq"], r["url"], r["title"], r["publication_date"], r["section"]) for r in rows)


def test_links_of_blocks(spark):
    html = ('<a href="/2024/01/01/a/fuera">Fuera de todo bloque</a><article><h2><a href="https://lareaccioncr.com/2024/01/02/a/uno?x">Uno</a></h2>'
            '<a href="https://lareaccioncr.com/2024/01/02/a/dos">Dos</a><article><h1><a href="https://lareaccioncr.com/2024/01/03/a/tres">Tres</a></h1>'
            '<time>3 de enero de 2024</time></article><time>2 de enero de 2024</time><a class="category" href="/category/x">Salud</a></article>')
    # the inner block keeps its own date; the outer one's first time is the inner one's, as a look-up below it gives
    got = _listed(spark, "lareaccioncr", html)
    assert [(u.split("/")[-1], t, d, s) for _, u, t, d, s in got] == [("uno", "Uno", "2024-01-03", "Salud"), ("tres", "Tres", "2024-01-03", None)]
    heading = '<section><h2>Un título de quince letras o más<a href="/2024/05/x">Ver</a></h2></section><div><a href="/2024/05/y">Ver</a></div><h3>El siguiente encabezado largo</h3>'
    assert [t for _, _, t, _, _ in _listed(spark, "eldelfino", heading)] == ["Un título de quince letras o másVer", "El siguiente encabezado largo"]
    assert _listed(spark, "eldelfino", '<div><a href="/2024/05/y">Ver</a></div>') == []
    assert [t for _, _, t, _, _ in _listed(spark, "latejacr", '<a href="/a/story/b"><h3>2. Una nota numerada</h3></a><a href="/c/story/d">Corta</a>')] == ["Una nota numerada"]
    plain = _listed(spark, "nobody", '<ul><li><a href="/a">Uno</a> <a href="">x</a></li><li><a href="/a">Dos</a></li></ul>')
    assert [(u, t) for _, u, t, _, _ in plain] == [("/a", "Uno")]
    assert _listed(spark, "teletica", None) == _listed(spark, "teletica", "") == []


def test_selector_lists():
    assert [list(Sheet([("x", 0, 'h1, a[title="b, c"] , p.x', "", "")]).matches(t, g, [])) for t, g in
            (("h1", {}), ("a", {"title": "b, c"}), ("a", {}), ("p", {"class": "x"}))] == [[0], [0], [], [0]]
