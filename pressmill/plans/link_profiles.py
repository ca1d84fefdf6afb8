"""Link profiles: what the listing pages of each outlet look like, one row per outlet.

Rules are selectors as in the extraction profiles. ``cards`` are the blocks around a link (the nearest one counts), ``links``
the anchors, most trusted first. Fields are read in the card; ``own:`` below the anchor, ``above:`` off the nearest
enclosing element that fits, ``next:`` off the first one behind the anchor. ``one``: a card gives its first link only.
``least``: a title shorter than that gives way to the next source, and a link without a title is none.
``patterns``: what an address must match, ``never``: what it must not hold; outlets with an address rule (URL_RULES)
are judged by that as well.
"""

from pressmill.functions.urls import RELATIVE_EXCLUDED
from pressmill.plans.profiles import rule

_FIELDS = ["source", "base", "cards", "links", "title", "date", "section", "one", "least", "patterns", "never"]
TIME = "time[datetime]@datetime|iso"
OWN = ["own:a"]
TITLED = ["own:a@title", "own:a"]


def _row(source, base, links, title=OWN, cards=(), date=(), section=(), one=False, least=1, patterns=(), never=()):
    return dict(zip(_FIELDS, (source, base, cards, links, title, date, section, one, least, patterns, never)))


_HEADINGS = ["h1 a", "h2 a", "h3 a", "h4 a"]

# What the listing pages of each outlet look like.
LINK_PROFILES = [
    _row("teletica", "https://www.teletica.com", ["a.nota-link"], ["h2", *OWN, "own:a@title"],
         [".nota", ".component", ".block", '[class*="nota"]', "article", '[class*="component"]'], least=5),
    _row("lareaccioncr", "https://lareaccioncr.com", ["h2 a", "h1 a", 'a[href*="/"]'], OWN, ["article"], ["time|es_long"],
         ["a.category", 'a[href*="/category/"]'], one=True),
    _row("larevistacr", "https://www.larevista.cr", ["h4.entry-title a", "h4.title a", "h3.entry-title a", "h4 a", "h3 a"], OWN, ["article"],
         ["span.mg-blog-date a|es_long"], ["div.mg-blog-category a"], one=True),
    _row("latejacr", "https://www.lateja.cr", ['a[href*="/story/"]'],
         ["own:h2", "own:h3", "own:h4", 'own:[class*="title"]', 'own:[class*="headline"]', *OWN], least=10),
    _row("lavozdegoicoechea", "https://lavozdegoicoechea.com", _HEADINGS, least=20),
    _row("mundiario", "https://www.mundiario.com", ["h2.title a", 'h2[class*="title"] a', "h3.title a", 'a[href*="/articulo/"]'], TITLED,
         ['div[class*="article-data"]'], ['div[class*="content-info"] span[class*="date"]|day_first'], one=True),
    _row("monumental", "https://www.monumental.co.cr", ["h2 a"], OWN, ["div.data"], ["span.date|es_plain"], one=True),
    _row("ncrnoticias", "https://ncrnoticias.com", ['h3[class*="entry-title"] a', 'h3[class*="td-module-title"] a', 'h2[class*="entry-title"] a'],
         TITLED, ['[class*="td-module"]', '[class*="td-block"]', "article", '[class*="post"]'], [TIME]),
    _row("noticiasenlineacr", "https://noticiasenlineacr.com", ['h2[class*="entry-title"] a'], TITLED,
         ["article", '[class*="post"]', '[class*="loop-item"]', '[class*="container-wrapper"]'], ['span[class*="date"]|month_first']),
    _row("costaricastar", "https://news.co.cr", ["div.category-post-item a.post-title"], TITLED),
    _row("genteopa", "https://genteopa.com", ['h5[class*="wp-block-post-title"] a'], OWN, ["li", "article"], [TIME]),
    _row("pulsocr", "https://www.pulsocr.com", ["h3 a", "h2 a", "a"], OWN, ['div[class*="read-title"]'], one=True),
    _row("puroperiodismo", "https://www.puroperiodismo.com", ["a[title]"], ["own:a@title"],
         ['[class*="td-module"]', "article", '[class*="post"]', '[class*="loop"]', '[class*="card"]'], [TIME], least=5),
    _row("repretel", "https://www.repretel.com", ['a[class*="feed__item"]'], ["own:a@title"],
         date=["own:time[datetime]@datetime|iso", 'own:[class*="feed__time"]|es_dash_time']),
    _row("rumboeconomico", "https://rumboeconomico.net", ['h2[class*="elementor-post__title"] a', 'h3[class*="elementor-post__title"] a'], OWN,
         ['article[class*="elementor-post"]'], ['span[class*="elementor-post-date"]|mixed_day_first', '[class*="post-date"]|mixed_day_first'], one=True),
    _row("sinartdigital", "https://sinartdigital.com", ['h2[class*="pos-subtitle"] a'], TITLED,
         ['[class*="pos-item"]', "article", ".row", "li"], ['[class*="itemcreated"]|es_weekday']),
    _row("telediario", "https://www.telediario.cr", ['h2 a[class*="board-module__a"]', "h2 a", 'a[class*="board-module__a"]'], OWN,
         ['article[class*="lr-list-row-row-news__article"]'], ['[class*="__date"]|dashed', "time[datetime]@datetime|dashed"], one=True),
    _row("theglobalcr", "https://theglobalcr.com", ['h3[class*="entry-title"] a', 'h2[class*="entry-title"] a'], TITLED,
         ['div[class*="module-meta-info"]'], [TIME], one=True),
    _row("ticosland", "https://ticosland.com", ["h3 a"], OWN, ["div.blog-bottom-content-holder"], ["ul li|english_long"], one=True),
    _row("ticotimes", "https://ticotimes.net", ['h3[class*="entry-title"] a', 'h2[class*="entry-title"] a'], TITLED,
         ['div[class*="td-module-meta-info"]'], [TIME], one=True),
    _row("trivisioncr", "https://trivisioncr.com", ["a.dv25-pc-btn", 'a[class*="dv25"]'], ["h2.dv25-pc-title", 'h2[class*="dv25"]'],
         ["div.dv25-pc-wrap"], ['span[class*="dv25"][class*="date"]|any_numeric'], one=True),
    _row("vozdeguanacaste", "https://vozdeguanacaste.com", ['h3[class*="entry-title"] a'], TITLED,
         ["article", '[class*="vdg-posts-item"]', '[class*="archive"]', "li"],
         ["span.published abbr|mixed_short", '[class*="published"] abbr|mixed_short', ".vdg-entry-meta abbr|mixed_short", TIME]),
    _row("elperiodicocr", "https://www.elperiodicocr.com", ["h2.entry-title a"], OWN, ["div.td-module-container"], section=["a.td-post-category"], one=True),
    _row("crhoy", "https://www.crhoy.com", ["a"], ["own:h2", "own:h3", 'own:[class*="text-body"]'], patterns=[r"^/.{10,}"], never=RELATIVE_EXCLUDED),
    _row("el_observador", "https://observador.cr", ["div.list div.promo h3.title a"], OWN, ["div.promo"], one=True, patterns=[r"observador\.cr"]),
    _row("amprensa", "https://www.amprensa.com", ["a"], patterns=[r"/20\d{2}/\d{2}/"]),
    _row("crc_89_1", "https://crc891.com", ["article a", "h2.post-title a"], OWN, ["article", "h2.post-title"], one=True),
    _row("diarioextra", "https://www.diarioextra.com", ["a"], patterns=[r"(?i)/noticia/"]),
    _row("digital506", "https://digital506.com", ["a"]),
    _row("eldelfino", "https://delfino.cr", ["a"], [*OWN, "above:h2, h3", "next:h2, h3"], ["article", "div", "section"],
         ["time@datetime", "time"], ['a[href*="/hoy"]|title', 'a[href*="/cultura"]|title', 'a[href*="/opinion"]|title', 'a[href*="/reporte"]|title'],
         least=15, patterns=[r"^(https://delfino\.cr)?/\d{4}/\d{2}/.+"]),
    _row("lanacion", "https://www.nacion.com", ["a"], [*OWN, "above:h1, h2, h3", "next:h1, h2, h3"],
         ["article", "div", "section"], ["time[datetime]@datetime", 'span[class*="date"]', "time"], least=15,
         patterns=[r"^(https://www\.nacion\.com)?/[^?#]+/story/"], never=["/videos/", "/podcast/", "/brandvoice/", "/todobusco/"]),
    _row("larepublica", "https://www.larepublica.net", ["a"], [*OWN, "above:h1, h2, h3, h4", "next:h1, h2, h3"],
         ["article", "div"], ["time[datetime]@datetime", 'span[class*="date"]', "time"], ['a[href*="/seccion/"]|title'], least=15,
         patterns=[r"^(https://www\.larepublica\.net)?/noticia/.+"]),
    _row("el_mundo", "https://www.elmundo.es", ['h2[class*="headline"] a', 'h3[class*="headline"] a', "a"], OWN,
         ["article", "li.ue-c-cover-content"], ["time[datetime]@datetime", "time"], ['span[class*="section"]|title', 'a[class*="section"]|title'], one=True),
    _row("el_seminario", "https://semanariouniversidad.com", ["h3.entry-title a", "h2.entry-title a", "h2 a", "h3 a", "h4 a", "a"], OWN, ["article"],
         ["time.entry-date@datetime", "time.published@datetime", "time[datetime]@datetime"], ['above:article[class*="category-"]@class|class_category'],
         one=True),
    _row("puntarenasseoye", "https://www.puntarenasseoye.com", ["h2.post-title a"]),
    _row("caribeactual", "https://caribeactual.com", ["h2.entry-title a", "h3.entry-title a"]),
    _row("presidencia", "https://www.presidencia.go.cr", ["span.title a"], OWN, ["div.item-news.views-row"], ["time.datetime@datetime|ten"], one=True),
    _row("alajuela_digital", "https://alajueladigital.net", ["h4 a"]),
    _row("el_jilguero", "https://jilgueromedia.com", ["#content h4 a", "h4 a"], patterns=[r"jilgueromedia\.c"]),
    _row("el_jornal", "https://eljornalcr.com", ["h3 a"], patterns=[r"eljornalcr\.com"]),
    _row("eljornal", "https://eljornalcr.com", ["h3 a"], patterns=[r"eljornalcr\.com"]),
    _row("elnortehoy", "https://elnortehoycr.com", ['h2[class*="entry-title"] a'], patterns=[r"elnortehoycr\.com"]),
    _row("el_sol_de_occidente", "https://elsoldeoccidente.com", ['h3[class*="entry-title"] a'], patterns=[r"elsoldeoccidente\.com"]),
    _row("noticias_la_garita_costa_rica", "https://noticiaslagarita.com", ["h4.title a"]),
    _row("periodico_el_mundo", "https://elmundo.cr", ["h3.elementor-post__title a"]),
    _row("sancarlosdigital", "https://sancarlosdigital.com", ['h3[class*="entry-title"] a', 'h3[class*="td-module-title"] a'], patterns=[r"sancarlosdigital\.com"]),
]
# A plain profile for listing pages of unknown outlets: every anchor, its own text.
ANY_LINK = _row("*", "", ["a"], TITLED[1:], ["article", "li"], [TIME])

_RULE = "struct<kind:string,n:int,css:string,attribute:string,how:string>"
SCHEMA = (f"source string, base string, link_rules array<{_RULE}>, one boolean, least int, patterns array<string>, never array<string>")


def _field(kind, n, text):
    """A field rule; ``own:a`` stands for the anchor itself."""
    scope, mark, rest = text.partition(":") if text.split(":")[0] in ("own", "above", "next") else ("", "", text)
    return rule(f"{kind} {scope}".strip(), n, rest if mark else text)


def link_profile_rows(profiles=None):
    rows = []
    for p in LINK_PROFILES if profiles is None else profiles:
        rules = [rule("card", n, css) for n, css in enumerate(p["cards"])]
        rules += [rule("anchor", n, css + "[href]@href") for n, css in enumerate(p["links"])]
        rules += [_field(kind, n, text) for kind in ("title", "date", "section") for n, text in enumerate(p[kind])]
        rows.append((p["source"], p["base"], rules, p["one"], p["least"], list(p["patterns"]), list(p["never"])))
    return rows


def link_profiles_frame(spark, profiles=None):
    return spark.createDataFrame(link_profile_rows(profiles), SCHEMA)
