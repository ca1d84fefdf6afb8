"""Pages to articles: profile-driven choice of container, blocks, title, author, date and section."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions import dates as D
from pressmill.functions import html as M
from pressmill.functions.outline import marked, outline
from pressmill.functions.text import collapse, once, section_slug, title_case
from pressmill.functions.urls import section_by_path
from pressmill.plans.profiles import GENERIC, profiles_frame


def drop_teasers(texts, teasers):
    """Block texts without those that hold one of ``teasers`` (an array column)."""
    return F.filter(texts, lambda t: ~F.exists(teasers, lambda b: F.lower(t).contains(b)))


def paragraphs(page, least=15, distinct=True, container="article"):
    """Paragraph texts of the first container, without Python: for flat page layouts."""
    body = M.drop_silent(page)
    texts = M.block_texts(F.coalesce(M.first_element(body, container), F.lit("")))
    texts = F.filter(texts, lambda t: F.length(t) >= least)
    return F.array_distinct(texts) if distinct else texts


def outlined(pages: DataFrame) -> DataFrame:
    """Pages with ``texts`` and ``elements`` (node, parent, last, tag, cls, ident, t0, t1, kids, pars).

    ``kids`` counts the paragraphs among an element's children, ``pars`` those anywhere below it: one subtraction of
    running counts."""
    out = pages.withColumn("_o", outline(F.col("html")))
    zipped = F.arrays_zip("_o.tag", "_o.cls", "_o.ident", "_o.parent", "_o.last", "_o.t0", "_o.t1", "_o.kids")
    before = lambda i: F.element_at("_o.pars", i + 1)
    elements = F.transform(zipped, lambda e, i: F.struct(
        i.alias("node"), e["parent"].alias("parent"), e["last"].alias("last"), e["tag"].alias("tag"), e["cls"].alias("cls"),
        e["ident"].alias("ident"), e["t0"].alias("t0"), e["t1"].alias("t1"), e["kids"].alias("kids"),
        (before(e["last"] + 1) - before(i + 1)).alias("pars")))
    return out.withColumns({"texts": F.col("_o.texts"), "elements": elements}).drop("_o")


def _span(texts, x):
    return F.slice(texts, x["t0"] + 1, x["t1"] - x["t0"])


def body_texts(pages: DataFrame) -> DataFrame:
    """Add ``blocks`` (kept block texts), ``full_text`` and ``fields`` (kind, n, how, text: what the rules of the other
    fields found, in order) by the profile columns of each row.

    The selectors' pass has numbered blocks and paragraphs and given every container the places of its own, so a
    container's share is one slice. Nothing around a container is removed; noise words count all the way up."""
    read = lambda x: collapse(F.array_join(F.zip_with(
        _span("_o.texts", x), _span("_o.gone", x), lambda t, g: F.when(g, F.lit("")).otherwise(t)), ""))
    whole_text = lambda x: collapse(F.array_join(_span("_o.texts", x), ""))
    step1 = pages.withColumn("_o", marked(F.col("html"), F.col("rules")))
    step2 = step1.withColumns({
        "_blocks": F.transform("_o.blocks", read), "_pars": F.transform("_o.pars", read),
        "fields": F.transform("_o.fields", lambda f: F.struct(
            f["kind"].alias("kind"), f["n"].alias("n"), f["how"].alias("how"), F.coalesce(f["value"], whole_text(f)).alias("text")))})
    candidates, least, need = F.col("_o.containers"), F.col("least"), F.col("need")
    blocks_of = lambda c: F.slice("_blocks", c["b0"] + 1, c["b1"] - c["b0"])
    pars_of = lambda c: F.slice("_pars", c["p0"] + 1, c["p1"] - c["p0"])
    firsts = F.filter(candidates, lambda c, i: (i == 0) | (F.element_at(candidates, F.greatest(i, F.lit(1)))["n"] != c["n"]))
    filled = F.filter(candidates, lambda c: F.exists(blocks_of(c), lambda t: F.length(t) >= least))
    same_kind = F.filter(filled, lambda c: c["n"] == F.element_at(filled, 1)["n"])
    scan = F.filter(firsts, lambda c: F.exists(pars_of(c), lambda t: F.length(t) > need))
    ranked = F.array_sort(F.transform(candidates, lambda c, i: F.struct(
        (-F.size(F.filter(pars_of(c), lambda t: t != ""))).alias("n"), i.alias("i"), c.alias("c"))))
    most = F.transform(F.filter(ranked, lambda r: -r["n"] >= F.greatest(need, F.lit(1))), lambda r: r["c"])
    one = lambda a: F.slice(a, 1, 1)
    choose = F.col("choose")
    chosen = F.when(choose == "most", one(most)).when(choose == "scan", one(scan)).when(choose == "all", candidates) \
        .when(choose == "filled", same_kind).otherwise(one(firsts))
    step3 = step2.withColumn("_chosen", F.filter(chosen, lambda c: ~c["nested"] | (choose == "most")))
    # a container without any block gives its own text where the profile says so
    inner = F.flatten(F.transform("_chosen", lambda c: F.when(F.col("else_text") & (c["b0"] == c["b1"]), F.array(read(c))).otherwise(blocks_of(c))))
    inner = F.filter(inner, lambda t: (F.length(t) >= least) & (t != ""))
    fallback = F.filter("_pars", lambda t: F.length(t) > F.col("fallback"))
    found = F.when((choose == "scan") & (F.size("_chosen") == 0), fallback) \
        .when(F.col("whole"), F.transform("_chosen", read)).otherwise(drop_teasers(inner, F.col("teasers")))
    step4 = step3.withColumn("_found", found)
    step5 = step4.withColumn("blocks", F.when(F.col("distinct"), F.array_distinct("_found")).otherwise(F.col("_found")))
    lead = F.try_element_at(F.filter("fields", lambda f: (f["kind"] == "lead") & (f["text"] != "")), F.lit(1))["text"]
    joined = F.call_function("array_join", F.col("blocks"), F.col("joiner"))
    # an excerpt goes before a body that is there
    full = F.when(lead.isNotNull() & (joined != ""), F.concat(lead, F.col("joiner"), joined)).otherwise(joined)
    return step5.withColumn("full_text", full).drop("_o", "_blocks", "_pars", "_chosen", "_found")


def container_counts(pages: DataFrame, tags, part="", direct=False) -> DataFrame:
    """One row per matching container of every page: place, class, paragraphs, text length.

    ``direct`` counts paragraphs that are children of the container, not deeper ones."""
    e = F.col("elements")
    found = F.filter(e, lambda x: F.array_contains(F.array(*[F.lit(t) for t in tags]), x["tag"]) & x["cls"].contains(part))
    rows = F.transform(found, lambda c: F.struct(
        c["node"].alias("node"), c["tag"].alias("tag"), c["cls"].alias("cls"),
        c["kids" if direct else "pars"].alias("paragraphs"),
        F.length(collapse(F.array_join(_span("texts", c), ""))).alias("length")))
    return outlined(pages).select("page_id", F.explode(rows).alias("c")).select("page_id", "c.*")


def best_container(counts: DataFrame, least=1) -> DataFrame:
    """Container with most paragraphs per page; the earlier one wins ties."""
    best = F.max_by(F.struct("node", "tag", "cls", "paragraphs"), F.struct("paragraphs", (-F.col("node")).alias("n")))
    return counts.groupBy("page_id").agg(best.alias("b")).where(F.col("b.paragraphs") >= least).select("page_id", "b.*")


def selector_coverage(pages: DataFrame, by, selectors) -> DataFrame:
    """Matches of each start-tag pattern and pages holding it, per value of ``by``."""
    hits = {n: F.size(F.regexp_extract_all(F.col("html"), F.lit(p), F.lit(0))) for n, p in selectors.items()}
    out = [F.count("*").alias("pages")]
    for n, h in hits.items():
        out += [F.sum(h).alias(f"{n}_hits"), F.count_if(h > 0).alias(f"{n}_pages")]
    return pages.groupBy(by).agg(*out)


def title(page, parts=("entry-title", "headline", "title")):
    """Heading by class priority, else the first heading, else the page title."""
    tries = [M.first_with_class(page, "h1", p) for p in parts]
    picked = F.coalesce(*tries, M.first_element(page, "h1"), M.first_element(page, "title"))
    return F.nullif(M.element_text(picked), F.lit(""))


def author(page, default="Sin autor"):
    named = F.coalesce(M.first_with_class(page, "a", "author"), M.first_with_class(page, "span", "author"),
                       M.first_with_class(page, "div", "author"), M.attribute(page, "meta", 'name="author"', "content"))
    return F.coalesce(F.nullif(M.element_text(named), F.lit("")), F.lit(default))


def scripts(page, kind=r"application/ld\+json"):
    """Texts of all script elements of a type, in order."""
    return F.regexp_extract_all(
        page, F.lit(rf'(?is)<script\s[^>]*type=["\']{kind}["\'][^>]*>(.*?)</script\s*>'), F.lit(1))


_NODE = "struct<`@type`:string,datePublished:string,articleSection:string>"


def graph_nodes(script):
    """Nodes of a JSON-LD text: its ``@graph``, a bare list, or the object itself."""
    graph = F.from_json(script, f"struct<`@graph`:array<{_NODE}>>")["@graph"]
    listed = F.when(script.rlike(r"^\s*\["), F.from_json(script, f"array<{_NODE}>"))
    return F.coalesce(graph, listed, F.array(F.from_json(script, _NODE)))


def graph_date(script, parse):
    """Publication date of the first ``WebPage`` node whose date parses, else of any node."""
    nodes = F.transform(graph_nodes(script), lambda n: F.struct(
        n["@type"].alias("kind"), parse(n["datePublished"]).alias("date")))
    dated = F.filter(nodes, lambda n: F.coalesce(n["date"], F.lit("")) != "")
    web = F.filter(dated, lambda n: n["kind"] == "WebPage")
    return F.coalesce(F.try_element_at(web, F.lit(1))["date"], F.try_element_at(dated, F.lit(1))["date"])


def graph_article(page_scripts):
    """Date and first section of the article node; over several scripts the last found wins."""
    is_article = lambda n: n["@type"].isin("NewsArticle", "Article")
    picked = F.transform(page_scripts, lambda s: F.try_element_at(F.filter(graph_nodes(s), is_article), F.lit(1)))

    def last(field):
        values = F.filter(F.transform(picked, field), lambda v: v.isNotNull() & (v != ""))
        return F.try_element_at(values, F.lit(-1))

    # a section list arrives as its JSON text
    section = lambda n: F.when(n["articleSection"].startswith("["), F.get_json_object(n["articleSection"], "$[0]")) \
        .otherwise(n["articleSection"])
    return F.struct(last(lambda n: n["datePublished"]).alias("date"), last(section).alias("section"))


def meta_date(page):
    return M.attribute(page, "meta", 'property="article:published_time"', "content")


def time_date(page):
    return M.attribute(page, "time", "datetime=", "datetime")


# Orders in which date sources are trusted.
DATE_ORDERS = {
    "jsonld_meta_listing": ["jsonld", "meta", "listing"],
    "meta_listing_time": ["meta", "listing", "time"],
    "listing_article": ["listing", "text", "meta"],
    "text_meta": ["text", "meta"],
    "time_meta": ["time", "meta"],
}


def by_precedence(order, **sources):
    """First non-empty date along the named order."""
    return F.coalesce(*[F.nullif(sources[name], F.lit("")) for name in DATE_ORDERS[order]])


def embedded_meta(page, marker="post_meta"):
    """Category and date of the JSON text in the script whose id holds ``marker``."""
    text = F.regexp_extract(page, rf'(?is)<script\s[^>]*id="[^"]*{marker}[^"]*"[^>]*>(.*?)</script\s*>', 1)
    return F.struct(F.get_json_object(text, "$.category").alias("category"),
                    F.substring(F.get_json_object(text, "$.date"), 1, 10).alias("date"))


# How a field's text is read, by the parser's name in a rule. Dates that no form fits are passed over.
DATE_PARSERS = {
    "": lambda c: c,
    "iso": D.iso_local, "iso_utc": D.iso_utc, "ten": lambda c: F.substring(c, 1, 10),
    "es_long": D.es_long, "es_long_time": D.es_long_time, "es_dash_time": D.es_dash_time, "es_month_first": D.es_month_first,
    "es_month_first_strict": D.es_month_first_strict, "es_weekday": D.es_weekday, "es_tokens": D.es_tokens,
    "es_short_month_only": lambda c: F.when(c.rlike(r"(?i)\d{1,2}\s+de\s+\w+"), F.nullif(D.es_short_month(c), F.lit("Sin fecha"))),
    "es_plain": D.es_plain, "mixed_day_first": D.mixed_day_first, "english_long": D.english_long, "day_first": D.day_first,
    "month_first": D.month_first, "dashed": D.dashed, "mixed_short": D.mixed_short, "english_short": D.english_short, "any_numeric": D.any_numeric, "dashed_time": D.dashed_time,
    "slashed_strict": D.slashed_strict, "post_date": lambda c: F.substring(F.get_json_object(c, "$.date"), 1, 10),
    "ld_top": lambda c: D.iso_local(F.get_json_object(c, "$.datePublished")), "ld_graph": lambda c: graph_date(c, D.iso_utc),
    "ld_graph_local": lambda c: graph_date(c, D.iso_local), "ld_article": lambda c: graph_article(c)["date"],
}
SECTION_PARSERS = {
    "": lambda c: c, "slug": section_slug, "slug_plus": lambda c: section_slug(c, drop_plus=True), "title": title_case,
    "short": lambda c: F.when(F.length(c) < 50, c), "post_category": lambda c: section_slug(F.get_json_object(c, "$.category")),
    "class_category": lambda c: title_case(F.replace(F.regexp_extract(c, r"(?:^|\s)category-(\S+)", 1), F.lit("-"), F.lit(" "))),
    "ld_section": lambda c: graph_article(c)["section"],
}
# These look at all texts of their rules together (the last article node holds).
_TOGETHER = {"ld_article", "ld_section"}


def field(kind, parsers=None, fields="fields", keep=None):
    """The first text that the rules of a kind found, that their parsers could read and that ``keep`` holds for; null
    without one."""
    def read(f):
        if parsers is None:
            return F.nullif(f["text"], F.lit(""))
        out = F.lit(None).cast("string")
        alike = lambda name: F.transform(
            F.filter(fields, lambda g: (g["kind"] == kind) & (g["how"] == name)), lambda g: g["text"])
        for name, parse in parsers.items():
            out = F.when(f["how"] == name, parse(alike(name) if name in _TOGETHER else f["text"])).otherwise(out)
        return F.nullif(out, F.lit(""))

    texts = F.transform(F.filter(fields, lambda f: (f["kind"] == kind) & (f["text"] != "")), read)
    return F.try_element_at(F.filter(texts, lambda t: t.isNotNull() & (F.lit(True) if keep is None else keep(t))), F.lit(1))


def articles(pages: DataFrame, profiles: DataFrame, scraping_date: str) -> DataFrame:
    """Article records of landed pages (page_id, source, url, html).

    Pages of outlets without a profile are read by the plain one; bodies below an outlet's least length are no articles.
    Profiles are a package table of a few dozen rows, so they are sent to every task. Python runs once per page,
    and pages are never shuffled.
    """
    named = profiles.unionByName(profiles_frame(pages.sparkSession, [GENERIC]))
    known = [r["source"] for r in profiles.select("source").collect()]
    kind = F.when(F.col("source").isin(known), F.col("source")).otherwise(F.lit(GENERIC["source"]))
    fields_of = named.withColumnRenamed("source", "_profile")
    with_profile = pages.withColumn("_profile", kind).join(F.broadcast(fields_of), "_profile").drop("_profile")
    read = body_texts(with_profile).select(
        "page_id", "source", "url", "no_author", "least_text",
        F.nullif(F.lower(F.regexp_extract("html", r'(?i)<html[^>]*\slang="([A-Za-z]{2})', 1)), F.lit("")).alias("language"),
        once(fields=F.col("fields"), full_text=F.col("full_text")))
    return read.where(F.length("full_text") >= F.col("least_text")).select(
        "page_id", "source", "url", field("title").alias("title"), F.coalesce(field("author"), "no_author").alias("author"),
        F.lit(scraping_date).alias("scraping_date"),
        F.coalesce(field("section", SECTION_PARSERS), section_by_path(F.col("url"))).alias("section"),
        "language", field("date", DATE_PARSERS).alias("publication_date"), "full_text")
