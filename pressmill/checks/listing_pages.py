"""Listing pages in the markup of every outlet, and the links that must be read from them.

A card's markup has ``{u}`` for the address, ``{t}`` for the title and ``{d}`` for a day. Each sample: the markup, the
address below the outlet's base, and the date and section that are wanted (none: not on the page).
"""

from pressmill.checks.outlet_pages import literal

_RAW = "2024-05-{d}T18:30:00Z"
_TIME = f'<time class="entry-date published" datetime="{_RAW}">x</time>'
_ISO, _DAY = "2024-05-{d} 12:30:00", "2024-05-{d}"
_A = '<a href="{u}">{t}</a>'
_H2, _H3, _H4 = f"<h2>{_A}</h2>", f'<h3 class="entry-title">{_A}</h3>', f'<h4 class="title">{_A}</h4>'
_SHORT = '<a href="{u}">Vea</a>'

LISTINGS = {
    "teletica": ('<div class="nota x"><a class="nota-link" href="{u}"><i>Foto</i><h2>{t}</h2></a><h2>Más</h2></div>', "/nacional/nota-{p}", None, None),
    "lareaccioncr": (f'<article>{_H2}<a href="/category/x">Salud</a><time>{{d}} de mayo de 2024</time></article>', "/2024/05/02/pais/nota-{p}", _DAY, "Salud"),
    "larevistacr": (f'<article><div class="mg-blog-category"><a href="/c">Arte</a></div>{_H4}<span class="mg-blog-date"><a href="/f">{{d}} de mayo de 2024</a></span></article>',
                    "/nota-{p}", _DAY, "Arte"),
    "latejacr": ('<a href="{u}"><img src="x"><h3>3. {t}</h3><p>resumen</p></a>', "/pais/story/nota-{p}/", None, None),
    "lavozdegoicoechea": (_H3, "/una-nota-{p}/", None, None),
    "mundiario": ('<div class="article-data"><a href="/seccion">S</a><h2 class="title"><a href="{u}" title="{t}">corto</a></h2>'
                  '<div class="content-info"><span class="date-container">{d}/05/24</span></div></div>', "/articulo/nota-{p}", _DAY, None),
    "monumental": (f'<div class="data">{_H2}<span class="date">{{d}} mayo 2024</span></div>', "/pais/nota-{p}", _DAY, None),
    "ncrnoticias": (f'<div class="td-module-x">{_H3}{_TIME}</div>', "/nota-{p}", _ISO, None),
    "noticiasenlineacr": (f'<article><h2 class="entry-title">{_A}</h2><span class="date">05/{{d}}/2024</span></article>', "/nota-{p}", _DAY, None),
    "costaricastar": ('<div class="category-post-item"><a class="post-title" title="{t}" href="{u}">corto</a></div>', "/pais/nota-{p}", None, None),
    "genteopa": (f'<li><h5 class="wp-block-post-title">{_A}</h5>{_TIME}</li>', "/central/nota-{p}", _ISO, None),
    "pulsocr": (f'<div class="read-title">{_H3}</div>', "/pais/nota-{p}", None, None),
    "puroperiodismo": (f'<div class="td-module-x"><a href="{{u}}" title="{{t}}">f</a>{_TIME}</div>', "/pais/nota-{p}", _ISO, None),
    "repretel": ('<a class="feed__item x" href="{u}" title="{t}"><div class="feed__time">{d} de Mayo de 2024 - 15:18</div></a>', "/nota-{p}", "2024-05-{d} 15:18:00", None),
    "rumboeconomico": (f'<article class="elementor-post"><h3 class="elementor-post__title">{_A}</h3><span class="elementor-post-date">{{d}} May, 2024</span></article>',
                       "/pais/nota-{p}", _DAY, None),
    "sinartdigital": (f'<div class="pos-item"><h2 class="pos-subtitle">{_A}</h2><div class="element-itemcreated">Lunes, {{d}} Mayo 2024</div></div>',
                      "/trecenoticias/pais/nota-{p}", _DAY, None),
    "telediario": (f'<article class="lr-list-row-row-news__article"><a class="board-module__a" href="/foto/x/y">f</a>{_H2}<span class="news__date">{{d}}-05-2024</span></article>',
                   "/pais/nota-{p}", _DAY, None),
    "theglobalcr": (f'<div class="td-module-meta-info">{_H3}{_TIME}</div>', "/el-pais/nota-{p}", _ISO, None),
    "ticosland": (f'<div class="blog-bottom-content-holder"><h3>{_A}</h3><ul><li>May {{d}}, 2024</li></ul></div>', "/nota-{p}", _DAY, None),
    "ticotimes": (f'<div class="td-module-meta-info">{_H3}{_TIME}</div>', "/pais/nota-{p}", _ISO, None),
    "trivisioncr": ('<div class="dv25-pc-wrap"><h2 class="dv25-pc-title">{t}</h2><span class="dv25-pc-date">{d}/05/2024</span><a class="dv25-pc-btn" href="{u}">Ver</a></div>',
                    "/pais/nota-{p}", _DAY, None),
    "vozdeguanacaste": (f'<article>{_H3}<span class="published"><abbr>May {{d}}, 2024</abbr></span></article>', "/nota-{p}", _DAY, None),
    "elperiodicocr": (f'<div class="td-module-container"><h2 class="entry-title">{_A}</h2><a class="td-post-category" href="/c">País</a></div>', "/nota-{p}", None, "País"),
    "crhoy": ('<a href="{u}"><span>x</span><h2>{t}</h2></a>', "/nacionales/nota-{p}", None, None),
    "el_observador": (f'<div class="list"><div class="promo"><h3 class="title">{_A}</h3></div></div>', "/pais/nota-{p}", None, None),
    "amprensa": (_A, "/2024/05/nota-{p}", None, None),
    "crc_89_1": (f"<article>{_H2}<a href='/x'>más</a></article>", "/nota-{p}", None, None),
    "diarioextra": (_A, "/noticia/nota-{p}", None, None),
    "digital506": (_A, "/larga-nota-{p}/", None, None),
    "eldelfino": (f'<article><h2>{{t}}<a href="{{u}}"></a></h2><a href="/cultura">arte y letras</a><time datetime="{_RAW}">x</time></article>', "/2024/05/nota-{p}", _RAW, "Arte Y Letras"),
    "lanacion": (f'<section>{_SHORT}<h3>{{t}}</h3><span class="date">{{d}} mayo</span></section>', "/pais/story/nota-{p}", "{d} mayo", None),
    "larepublica": (f'<div>{_A}<a href="/seccion/x">mundo vivo</a><time>{{d}} mayo</time></div>', "/noticia/nota-{p}", "{d} mayo", "Mundo Vivo"),
    "el_mundo": (f'<article><a href="/foto">f</a><h2 class="ue-headline">{_A}</h2><span class="section-x">mundo</span><time>{{d}} mayo</time></article>', "/nota-{p}", "{d} mayo", "Mundo"),
    "el_seminario": (f'<article class="post category-vida-sana">{_H3}{_TIME}</article>', "/nota-{p}", _RAW, "Vida Sana"),
    "puntarenasseoye": (f'<h2 class="post-title">{_A}</h2>', "/nota-{p}", None, None),
    "caribeactual": (_H3, "/nota-{p}", None, None),
    "presidencia": (f'<div class="item-news views-row"><span class="title">{_A}</span><time class="datetime" datetime="{_RAW}">x</time></div>', "/nota-{p}", _DAY, None),
    "alajuela_digital": (_H4, "/nota-{p}", None, None),
    "el_jilguero": (f'<div id="content">{_H4}</div>', "/nota-{p}", None, None),
    "el_jornal": (f"<h3>{_A}</h3>", "/nota-{p}", None, None),
    "eljornal": (f"<h3>{_A}</h3>", "/nota-{p}", None, None),
    "elnortehoy": (f'<h2 class="entry-title">{_A}</h2>', "/nota-{p}", None, None),
    "el_sol_de_occidente": (_H3, "/nota-{p}", None, None),
    "noticias_la_garita_costa_rica": (_H4, "/nota-{p}", None, None),
    "periodico_el_mundo": (f'<h3 class="elementor-post__title">{_A}</h3>', "/nota-{p}", None, None),
    "sancarlosdigital": (_H3, "/nota-{p}", None, None),
}

RELATIVE = {"crhoy", "presidencia", "ncrnoticias"}
PLAIN = RELATIVE | {"lavozdegoicoechea"}  # these take no address with a query
TITLES = ("Primera nota número {p} de la portada", "Segunda nota número {p} de la portada", "Ya")


def numbered(text):
    """SQL of a text with the page's number in place of ``{p}`` and its day in place of ``{d}``."""
    pieces = [literal(t) for t in text.split("{p}")]
    return pieces[0] if len(pieces) == 1 else f"concat({', cast(page_id as string), '.join(pieces)})"


def listing_sql(source, base):
    """SQL of a listing page: two cards, the first one's address again below another title, an empty address, a title that
    is too short for most outlets, and the page itself with its own anchors."""
    markup, path = LISTINGS[source][:2]
    card = lambda address, title: markup.replace("{u}", address).replace("{t}", title)
    base = "" if source in RELATIVE else base
    first, second = base + path + ("" if source in PLAIN else "?a=1"), base + path.replace("nota", "nota-otra")
    cards = card(first, TITLES[0]) + card(second, TITLES[1]) + card(base + path + "?b=2", "Otro título número {p} para lo mismo") + card("", TITLES[1])
    rest = "replace(html, '<a ', '<i ')" if source == "digital506" else "html"
    return f"concat({numbered(cards)}, {rest})"
