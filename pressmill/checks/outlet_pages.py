"""Pages in the markup of every outlet, made from the bodies of the pages table, and what must be read from them.

``{d}`` is a day of the month that depends on the page. Each sample has: the class of the heading, markup before the
container, the opening of the container (after decoys), something inside that must go, the end, and the date, section
and author that are wanted (none: not on the page).
"""

_TEXT = "Comparta esta nota con todas sus amistades hoy mismo"
_META = '<meta property="article:published_time" content="2024-05-{d}T18:30:00Z">'
_ISO, _UTC, _DAY = "2024-05-{d} 12:30:00", "2024-05-{d} 18:30:00", "2024-05-{d}"
_RAW = "2024-05-{d}T18:30:00Z"
_DIV = "</div>"


def _time(cls):
    return f'<time class="{cls}" datetime="{_RAW}">x</time>'


def _in(cls):
    return f'<div class="{cls}"><p>{_TEXT}</p></div>'


_ASIDE = f"<aside><p>{_TEXT}</p></aside>"
_ENTRY = '<div class="entry-content">'

SAMPLES = {
    "elperiodicocr": ("", _time("entry-date"), '<div class="tdb-block-inner a">Menú</div><div class="tdb-block-inner b">',
                      "<p>Para leer más sobre esto</p>", _DIV, _ISO, None, None),
    "lareaccioncr": ("", "", '<article><time>{d} de mayo de 2024</time><a class="category">Salud</a>', _in("sidebar"), "</article>", _DAY, "Salud", None),
    "larevistacr": ("", _META, f'<article><p>{_TEXT}</p></article><article class="x page-content-single">', _in("post-share"), "</article>", _ISO, None, None),
    "latejacr": ("", _time("c-date"), f'<article><p>{_TEXT}</p></article><article class="b-ArticleBody">', _in("interstitial"), "</article>", _ISO, None, None),
    "lavozdegoicoechea": ("", _time("x"), "<main>", _in("related"), "</main>", _ISO, None, None),
    "mundiario": ("", _META, '<div class="content-data x">', _in("custom-ads"), _DIV, _ISO, None, None),
    "monumental": ("", _META, '<div class="contentPost">', _in("suscripcion"), _DIV, _ISO, None, None),
    "ncrnoticias": ("", _META, '<div class="td-post-content">', _in("heateor_box"), _DIV, _ISO, None, None),
    "noticiasenlineacr": ("", '<script type="application/ld+json">{"datePublished":"2024-05-{d}T18:30:00Z"}</script>'
                              '<meta property="article:published_time" content="2020-01-01T00:00:00Z">',
                          '<article id="the-post"><div class="entry-content">', _in("tie-related"), "</div></article>", _ISO, None, None),
    "costaricastar": ("", '<script class="yoast-schema-graph" type="application/ld+json">{"@graph":[{"@type":"Person","datePublished":"2020-01-01T00:00:00Z"},'
                          '{"@type":"WebPage","datePublished":"2024-05-{d}T18:30:00Z"}]}</script>', '<div class="pf-content">', _in("a-single"), _DIV, _UTC, None, None),
    "genteopa": ("", _time("x") + '<div class="taxonomy-category"><a href="#">Vida</a></div>', _ENTRY, _in("wpdiscuz-x"), _DIV, _ISO, "Vida", None),
    "pulsocr": ("", '<span class="posts-date">mayo {d}, 2024</span><span class="cat-links"><a href="#">Economía</a></span>',
                f'<div class="entry-content"><p>{_TEXT}</p></div><div class="entry-content read-details">', _in("entry-meta x"), _DIV, _DAY, "Economía", None),
    "puroperiodismo": ("", _META + '<a class="td-post-category">Opinión</a>', '<div class="td-post-content">', _in("sd-block"), _DIV, _ISO, "Opinión", None),
    "repretel": ("", '<div class="single-layout__meta-date">{d} de Mayo de 2024 - 15:18</div>', '<div class="single-layout__article">', _in("twitter-tweet"), _DIV,
                 "2024-05-{d} 15:18:00", None, None),
    "rumboeconomico": ("", _META, '<div class="elementor-widget-container"><p>Uno</p></div><div class="elementor-widget-container main">', _in("sharedaddy"), _DIV,
                       _ISO, None, None),
    "sinartdigital": ("", '<span class="itemcreated">Lunes, {d} de Mayo de 2024</span>',
                      '<div class="element-textarea">Texto sin párrafos, pero entero.</div><div class="element-textarea b">', _in("social-x"), _DIV, _DAY, None, None),
    "telediario": ("", '<time class="x-datetime" datetime="{d}-05-2024 09:49">x</time><i data-camus-section="1">País</i>',
                   '<span class="base__body">Menú</span><span class="base__body b">', _in("img-container"), "</span>", "2024-05-{d} 09:49:00", "País", None),
    "teletica": ("", '<div class="authorDate"><span>Ana</span><span>{d} de mayo de 2024, 18:50 PM</span></div>', '<div class="text-editor"><h4>Nacional</h4>',
                 _in("component--x"), _DIV, "2024-05-{d} 18:50:00", "Nacional", None),
    "theglobalcr": ("", _time("td-module-date"), '<div class="tdb_single_content">', _in("td-tags"), _DIV, _ISO, None, None),
    "ticotimes": ("", _time("entry-date x"), '<div class="td-fix-index"><p>Uno</p></div><div class="tdb-block-inner td-fix-index">', _in("adthrive-ad"), _DIV,
                  _ISO, None, None),
    "trivisioncr": ("", '<span class="dv25-pc-date">{d}/05/2024</span>', '<div class="elementor-widget-container">Menú</div><div class="elementor-widget-container b">',
                    _in("tags-x"), _DIV, _DAY, None, None),
    "ticosland": ("", _time("x"), '<article><div class="post-content">', _in("yarpp"), "</div></article>", _ISO, None, None),
    "vozdeguanacaste": ("", '<span class="published"><abbr>May {d}, 2024</abbr></span><b class="vdg-terms"><a href="#">Cultura</a></b>', "<main>", _in("sharer"),
                        "</main>", _DAY, "Cultura", None),
    "puntarenasseoye": ("", '<div class="post-meta"><span class="date">{d} de mayo de 2024</span></div>', _ENTRY, "", _DIV, _DAY, None, None),
    "caribeactual": ("entry-title", '<time class="entry-date published">mayo {d}, 2024</time>', _ENTRY, "", _DIV, _DAY, None, None),
    "presidencia": ("", '<time class="datetime" datetime="2024-05-{d}T01:00:00">x</time>', '<div class="field--name-body">', "", _DIV, _DAY, None, None),
    "crhoy": ("", '<script id="__cr_post_meta">{"category":"Política Nacional","date":"2020-01-01 1"}</script><span>{d} de May. 2024 | 1:35 am</span>',
              '<div class="wp-article">', _ASIDE, _DIV, _DAY, "politica-nacional", None),
    "el_observador": ("", _time("x") + '<div class="meta"><span>Todo Política</span></div>', '<div class="entry-text">', _ASIDE, _DIV, _DAY, "todo-politica", None),
    "amprensa": ("", '<div class="post-meta-date">{d} de Abril de 2024</div><div class="post-meta-author"><a href="#">Ana Ñ</a></div><a class="label-x">Sucesos</a>',
                 '<section id="main-section">', _in("Banner-x"), "</section>", "{d} de Abril de 2024", "Sucesos", "Ana Ñ"),
    "crc_89_1": ("post-title", '<span class="date">hoy {d}</span><div class="single-post-meta"><a href="#">Luis</a></div><span class="post-cat-wrap">Rock</span>',
                 _ENTRY, _in("code-block x"), _DIV, "hoy {d}", "Rock", "Luis"),
    "diarioextra": ("single-layout__title", '<script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","datePublished":"2024-05-{d}","articleSection":["Sucesos"]}]}'
                    '</script><a class="single-layout__author">Eva</a><h2 class="single-layout__excerpt">Resumen {d}</h2>',
                    '<div class="single-layout__article">', _in("ned-ad-1"), _DIV, _DAY, "Sucesos", "Eva"),
    "eldelfino": ("", _time("x") + '<a href="/autor/ana">Ana</a>', '<div class="entry-content"><p>Corto</p></div><article>', _in("my-newsletter"), "</article>",
                  _RAW, None, "Ana"),
    "lanacion": ("", '<span class="author">Luis Ñ</span><span class="date">{d} mayo</span>', '<section class="body-content">', _in("suscripcion"), "</section>",
                 "{d} mayo", None, "Luis Ñ"),
    "larepublica": ("", '<div class="date">Jueves, {d} de mayo de 2024</div><a href="/seccion/x">mundo vivo</a>', '<div class="td-post-content initial-load">',
                    _in("x_ad-y"), _DIV, _DAY, "Mundo Vivo", ""),
    "el_mundo": ("", _META + '<span class="section-x">mundo</span>', '<div class="ue-l-article__body">', f'<p class="paywall">{_TEXT}</p>', _DIV, _ISO, "Mundo", None),
    "el_seminario": ("", _time("entry-date"), '<article class="post category-vida-sana"><div class="post-content">', f'<p class="related">{_TEXT}</p>', "</div></article>",
                     _RAW, "Vida Sana", None),
    "alajuela_digital": ("title", '<span class="mg-blog-date">MAY {d}, 2024</span><div class="mg-blog-category"><a href="#">San José</a></div>',
                         '<article class="small single">', _ASIDE, "</article>", _DAY, "san-jose", None),
    "el_financiero": ("b-headline", _time("c-date") + '<a class="c-overline">Bolsa y más</a>', '<article class="article-body-wrapper">', _ASIDE, "</article>",
                      _DAY, "bolsa-y-mas", None),
    "el_jilguero": ("title", '<span class="mg-blog-date">MAY {d}, 2024</span><div class="mg-blog-category"><a href="#">+ Deportes</a></div>', _ENTRY, _ASIDE, _DIV,
                    _DAY, "deportes", None),
    "el_jornal": ("", '<p>San José, {d} de octubre de 2024</p><a href="/category/pais">El País</a>', '<div class="post-content">', _ASIDE, _DIV, "2024-10-{d}",
                  "el-pais", None),
    "eljornal": ("", '<p>San José, {d} de octubre de 2024</p><a href="/category/pais">El País</a>', "<article>", _ASIDE, "</article>", "2024-10-{d}", "el-pais", None),
    "elnortehoy": ("entry-title", '<span class="published">{d} mayo, 2024</span><span class="ast-terms-link"><a href="#">Zona Norte</a></span>', _ENTRY, _ASIDE, _DIV,
                   _DAY, "zona-norte", None),
    "el_sol_de_occidente": ("entry-title", '<span class="entry-meta-date"><a href="#">{d}/05/2024</a></span><span class="entry-meta-categories"><a href="#">Naranjo</a></span>',
                            _ENTRY, _ASIDE, _DIV, _DAY, "naranjo", None),
    "digital506": ("tdb-title-text", '<a href="/category/pais/">Nación</a>',
                   '<div class="td-main-content-wrap">' + _time("entry-date") + '<div class="td-post-content">', _ASIDE, "</div></div>", _DAY, "nacion", None),
    "noticias_la_garita_costa_rica": ("title", _META, '<article class="small single"><div class="mg-header">', _ASIDE, "</div></article>", _RAW, None, None),
    "periodico_el_mundo": ("elementor-heading-title", '<span class="elementor-post-info__item--type-date"><time>marzo {d}, 2024</time></span>',
                           '<div class="elementor-widget-theme-post-content"><div class="elementor-widget-container">', _in("code-block"), "</div></div>",
                           "marzo {d}, 2024", None, None),
    "sancarlosdigital": ("tdb-title-text", _time("entry-date"), '<div class="td-post-content">', _ASIDE, _DIV, _DAY, None, None),
    "seminario": ("", "<time>{d} mayo, 2024</time>", '<div class="entry-content"><div class="contenido-textual">', "<figure><p>" + _TEXT + "</p></figure>", "</div></div>",
                  _DAY, None, None),
}


def literal(text):
    """SQL (both engines) of a text with the day of the page in place of ``{d}``."""
    if text is None:
        return "cast(null as string)"
    quoted = ["'" + t.replace("'", "''") + "'" for t in text.split("{d}")]
    day = "lpad(cast(1 + page_id % 28 as string), 2, '0')"
    return quoted[0] if len(quoted) == 1 else f"concat({f', {day}, '.join(quoted)})"


def page_sql(source):
    """SQL of a page's markup in the outlet's layout."""
    heading, before, opening, junk, end = SAMPLES[source][:5]
    h1 = f'<h1 class="{heading}">' if heading else "<h1>"
    return (f"replace(replace(replace(html, '<h1>', {literal(h1)}), '<article>', {literal(before + opening + junk)}), '</article>', {literal(end)})")
