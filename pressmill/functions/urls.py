"""URL scalars and the article-URL rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions.text import strip, title_case


def absolute(href: Column, base: str, bare: str = "keep") -> Column:
    """Absolute address. ``bare`` says what happens to relative paths without a slash:
    ``keep`` them, ``join`` them with a slash, or ``append`` anything not absolute."""
    base_lit = F.lit(base)
    out = F.when(href.startswith("http"), href)
    if bare == "append":
        return out.otherwise(F.concat(base_lit, href))
    out = out.when(href.startswith("/"), F.concat(base_lit, href))
    return out.otherwise(F.concat(base_lit, F.lit("/"), href) if bare == "join" else href)


def canonical(url: Column) -> Column:
    return F.regexp_replace(strip(url), r"[?#].*", "")


def path_of(url: Column) -> Column:
    return F.regexp_replace(canonical(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def slug(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(canonical(url), r"/+$", ""), "/"), -1)


# Ordered (text in lower-cased URL -> section) rules of two outlets.
AMPRENSA_SECTIONS = [
    ("nacionales", "nacionales"),
    ("/categorias/internacionales", "internacionales"),
    ("deportes", "deportes"),
    ("/categorias/sucesos", "sucesos"),
    ("/categorias/espectaculos", "espectaculos"),
    ("cartago", "cartago"),
    ("/categorias/tecnologia", "tecnologia"),
    ("/categorias/viral", "viral"),
    ("/categorias/ultima-hora", "ultima-hora"),
]
CRC_SECTIONS = [
    ("/nacionales/", "nacionales"),
    ("/mundo/", "mundo"),
    ("/tecnologia/", "tecnologia"),
    ("/deportes/", "deportes"),
    ("/entretenimiento/", "entretenimiento"),
    ("/seguridad/", "seguridad"),
]


def section_by_rules(url: Column, rules, default="general") -> Column:
    out = None
    for part, name in rules:
        out = (F.when if out is None else out.when)(url.contains(part), F.lit(name))
    return out.otherwise(F.lit(default))


def section_by_path(url: Column, default="Noticias", skip_numbers=False) -> Column:
    """First path segment as a heading; segments made of digits can be passed over."""
    parts = segments(path_of(url))
    if skip_numbers:
        parts = F.filter(parts, lambda s: ~s.rlike(r"^\d+$"))
    first = F.try_element_at(parts, F.lit(1))
    return F.coalesce(title_case(F.replace(first, F.lit("-"), F.lit(" "))), F.lit(default))


# Article-URL rules. An address counts as an article when it starts with
# ``prefix``, holds none of ``excluded``, and has at least ``min_segments`` path segments
# below the prefix. ``check`` names one further test.
_COMMON = ["/category/", "/author/", "/tag/", "/page/", "/?", "/#", "/wp-", "/feed"]
URL_RULES = [
    # source, prefix, excluded, min_segments, check
    ("teletica", "https://www.teletica.com/",
     ["/noticias/", "/autor/", "/tag/", "/buscar", "/?", "/#", "/wp-", "/feed", "/videos/",
      "/programas/", "/series/", "/deportes/"], 2, ""),
    ("lareaccioncr", "https://lareaccioncr.com/{year}/", _COMMON, 4, ""),
    ("larevistacr", "https://www.larevista.cr/",
     _COMMON + ["/actualidad-nacional", "/actualidad-mundial", "/entrevista", "/squid",
                "/portada", "/boletin"], 1, "first_not_digits"),
    ("latejacr", "https://www.lateja.cr/", [], 0, "has_story"),
    ("lavozdegoicoechea", "https://lavozdegoicoechea.com/",
     ["/category/", "/tag/", "/author/", "/page/", "/feed/", "/wp-", "/contact", "/contacto",
      "/about", "/acerca", "/privacy", "/politica", "/terminos", "/terms", "/anunciese",
      "/anuncie", "/publicidad", "/facebook", "/instagram", "/twitter", "/youtube", "#", "?"],
     1, "hyphenated"),
    ("monumental", "https://www.monumental.co.cr/", _COMMON, 2, ""),
    ("mundiario", "https://www.mundiario.com/articulo/", [], 0, "or_relative"),
    ("ncrnoticias", "https://ncrnoticias.com/", _COMMON, 1, ""),
    ("noticiasenlineacr", "https://noticiasenlineacr.com/", _COMMON, 1, ""),
    ("costaricastar", "https://news.co.cr/", _COMMON + ["/search"], 2, ""),
    ("genteopa", "https://genteopa.com/",
     ["/categoria/", "/author/", "/tag/", "/pagina/", "/?", "/#", "/wp-", "/feed"], 2, "not_section"),
    ("pulsocr", "https://www.pulsocr.com/", _COMMON, 2, ""),
    ("puroperiodismo", "https://www.puroperiodismo.com/",
     _COMMON + ["puroperiodismo.com/nacionales/", "puroperiodismo.com/opinion/",
                "puroperiodismo.com/internacional/", "puroperiodismo.com/titulares/",
                "puroperiodismo.com/inseguridad/"], 2, ""),
    ("repretel", "https://www.repretel.com/", _COMMON, 1, ""),
    ("rumboeconomico", "https://rumboeconomico.net/", _COMMON, 2, ""),
    ("sinartdigital", "https://sinartdigital.com/",
     ["/category/", "/author/", "/tag/", "/?", "/#", "/wp-", "/feed"], 2, ""),
    ("telediario", "https://www.telediario.cr/",
     ["/page/", "/?", "/#", "/wp-", "/feed", "/television/", "/radio/", "/tag/", "/author/"], 2, ""),
    ("theglobalcr", "https://theglobalcr.com/", _COMMON, 2, "not_section"),
    ("ticosland", "https://ticosland.com/", _COMMON, 1, "not_section"),
    ("ticotimes", "https://ticotimes.net/",
     ["/categories/", "/topics/", "/author/", "/tag/", "/page/", "/?", "/#", "/wp-", "/feed"], 2, ""),
    ("trivisioncr", "https://trivisioncr.com/", _COMMON, 2, "not_section"),
    ("vozdeguanacaste", "https://vozdeguanacaste.com/", _COMMON + ["/en/"], 1, "first_not_page"),
    ("digital506", "https://digital506.com/",
     ["/category/", "/author/", "/page/", "/tag/", "/privacy", "/wp-content/", "#", "mailto:",
      "javascript:"], 1, "long_slug"),
]
# Addresses of the sections of outlets whose rule excludes them.
SECTION_BASES = {
    "genteopa": [f"https://genteopa.com/central/categoria/{s}/" for s in ("nacionales", "sucesos", "politica", "tecnologia", "economia")],
    "theglobalcr": [f"https://theglobalcr.com/{s}/" for s in ("el-pais", "el-mundo", "economia", "politica", "tecnologia", "negocios")],
    "ticosland": [f"https://ticosland.com/{s}/" for s in (
        "san-jose", "alajuela", "cartago", "heredia", "guanacaste", "puntarenas", "limon")],
    "trivisioncr": [f"https://trivisioncr.com/{s}/" for s in (
        "noticias-nacionales", "noticias-de-politica", "noticias-de-economia", "noticias-guanacastecas", "noticias-de-tecnologia",
        "noticias-del-clima", "noticias-de-salud", "noticias-de-educacion")],
    "vozdeguanacaste": ["https://vozdeguanacaste.com/gentrificacion/"] + [f"https://vozdeguanacaste.com/category/{s}/" for s in (
        "noticias", "cultura", "especiales", "naturaleza", "derechos-humanos", "publirreportaje")],
}
RULE_SCHEMA = "source string, prefix string, excluded array<string>, min_segments int, check string, bases array<string>"


def rules_frame(spark, year, rules=URL_RULES):
    """The rules as a table; one outlet's prefix carries the current year."""
    rows = [(s, p.replace("{year}", str(year)), e, n, c, SECTION_BASES.get(s, [])) for s, p, e, n, c in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def is_article(url: Column, rule=lambda name: F.col(name), section_urls: Column = None) -> Column:
    """Whether ``url`` satisfies the rule in the columns prefix/excluded/min_segments/check and is no section's own
    address (column bases, or ``section_urls`` in its place)."""
    path = F.replace(url, rule("prefix"), F.lit(""))
    path = F.when(rule("source") == "sinartdigital",
                  F.replace(url, F.lit("https://sinartdigital.com/trecenoticias/"), F.lit(""))).otherwise(path)
    parts = segments(path)
    first = F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))
    lowered = F.when(rule("check") == "hyphenated", F.lower(strip(url))).otherwise(url)
    extra = (
        F.when(rule("check") == "first_not_digits", ~first.rlike(r"^\d+$"))
        .when(rule("check") == "has_story", url.contains("/story/"))
        .when(rule("check") == "hyphenated", path.contains("-"))
        .when(rule("check") == "first_not_page", ~first.startswith("page"))
        .when(rule("check") == "long_slug", F.length(F.btrim(path, F.lit("/"))) >= 5)
        .otherwise(F.lit(True))
    )
    relative = (rule("check") == "or_relative") & url.startswith("/articulo/")
    ok = (
        (url.startswith(rule("prefix")) | relative)
        & ~F.exists(rule("excluded"), lambda e: lowered.contains(e))
        & (F.size(parts) >= rule("min_segments")) & extra
    )
    base = F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/"))
    bases = rule("bases") if section_urls is None else section_urls
    return F.coalesce(ok & ~F.coalesce(F.array_contains(bases, base), F.lit(False)), F.lit(False))


# Single patterns used by outlets without a prefix rule.
URL_PATTERNS = {
    "year_month": r"/\d{4}/\d{2}/",
    "noticia": r"(?i)/noticia/",
    "story": r"/story/",
    "numbered_slug": r"/\d{3,}-",
}
# Relative links that never lead to an article.
RELATIVE_EXCLUDED = [
    "/busqueda", "/pro", "/autor", "/categoria", "/gusto/guias", "/gusto/recomendaciones",
    "/programa", "/membresia", "/nosotros", "/contacto", "/enterese", "/caricatura", "#",
]


def is_relative_article(href: Column) -> Column:
    bad = F.exists(F.array(*[F.lit(x) for x in RELATIVE_EXCLUDED]), lambda e: href.contains(e))
    return href.startswith("/") & (F.length(href) > 10) & ~bad
