"""Extraction profiles: one row per outlet instead of one program per outlet."""

# Rules are selectors (pressmill.functions.selectors): ``css@attribute|parser``. Without an attribute the text
# of the element counts, for scripts and the page title their content; without a parser the text is taken as it
# is. Fields list their rules in the order in which they are trusted; the first that gives something holds.
#
# choose: first (first container there is), filled (all of the first kind with blocks), most (most paragraphs),
#         all (every container), scan (first container with a paragraph over ``need`` characters, else all page
#         paragraphs over ``fallback`` characters).
# else_text: whether a container without any block gives its whole text.
# noise: substring or token (class words on the block or anything around it), own (substring, the block itself only).
# teasers: blocks that hold one of these texts are advertising or teasers.
# lead: rules for a text that goes before the body. least_text: shorter bodies are no articles.
# No blocks at all: the whole text of the container.
PARAGRAPHS = ["p"]
RICH = ["p", "h2", "h3", "h4", "li"]
HEADED = ["p", "h2", "h3", "h4", "blockquote"]
LISTED = ["p", "li"]

# Class words that mark noise.
NOISE_WORDS = [
    "ad", "ads", "advert", "advertisement", "paywall", "suscri", "subscribe", "newsletter",
    "related", "promo", "banner", "publicidad", "compartir", "share", "sidebar", "widget",
    "tag", "etiqueta", "author-bio", "bio", "comment", "footer", "header", "nav",
    "redes", "social", "popup",
]
# The class words of the outlet that looks at the block alone.
OWN_NOISE_WORDS = ["ad", "paywall", "suscri", "related"]


def parts(*texts):
    """Selectors of elements whose class holds one of the texts."""
    return [f'[class*="{t}"]' for t in texts]


def marked(*texts):
    """Selectors of elements whose id holds one of the texts."""
    return [f'[id*="{t}"]' for t in texts]


# Rules that many outlets share.
META = 'meta[property="article:published_time"]@content|iso'
TIME = "time[datetime]@datetime|iso"
META_TIME = [META, TIME]
H1 = ["h1"]
ENTRY = 'div[class*="entry-content"]'
BARE = ["script", "style", "iframe", "aside"]
FIGURED = ["script", "style", "iframe", "figure", "aside"]
MEDIA = ["script", "style", "iframe", "figure", "figcaption"]
QUIET = ["script", "style", "iframe", "aside", "figure", "noscript"]
ADSENSE = ["ins.adsbygoogle", ".adsbygoogle"]
NEWS_CATEGORY = 'a[href*="/category/"]|slug'
ADS = ["adsbygoogle"]
# What is removed where an outlet has no list of its own.
PLAIN_DROP = [*MEDIA, "nav", "aside", "ins", *parts(
    "sharedaddy", "adsbygoogle", "share", "social", "related", "comment", "newsletter", "td-a-ad", "ad-slot",
    "post-navigation", "author-box", "tags-links", "jp-relatedposts")]

_FIELDS = ["source", "containers", "choose", "blocks", "least", "distinct", "joiner", "noise", "need", "fallback",
           "else_text", "teasers", "drop", "title", "author", "no_author", "date", "section", "lead", "least_text"]
_BREAK, _BLANK = "\n\n", " "


def _row(source, containers, blocks=PARAGRAPHS, least=15, distinct=False, choose="first", joiner=_BREAK,
         noise="", need=0, fallback=0, else_text=False, teasers=ADS, drop=PLAIN_DROP, title=H1, author=(), no_author="Sin autor",
         date=META_TIME, section=(), lead=(), least_text=0):
    return dict(zip(_FIELDS, (source, containers, choose, blocks, least, distinct, joiner, noise, need, fallback,
                              else_text, teasers, drop, title, author, no_author, date, section, lead, least_text)))


def _whole(source, containers, drop=BARE, **rest):
    """A profile that reads the whole text of the container."""
    return _row(source, containers, [], 0, joiner=_BLANK, drop=drop, **rest)


# What the pages of each outlet look like.
PROFILES = [
    _row("elperiodicocr", ["div.td-post-content", "div.tdb-block-inner"], least=10, distinct=True, choose="filled",
         teasers=["adsbygoogle", "leer más"], drop=[], date=["time.entry-date@datetime|iso", META]),
    _row("lareaccioncr", ["article"], ["p", "li", "blockquote"], 11,
         drop=[".wp-block-embed", ".sharedaddy", "#jp-post-flair", ".comment", ".comments-area", ".post-navigation", ".related",
               ".sidebar", "nav", "script", "style", "iframe"],
         date=["article time|es_long"], section=["article a.category", 'article a[href*="/category/"]'], least_text=50),
    _row("larevistacr", ['article[class*="page-content-single"]', "article.single", "article.post", "article"], least=16,
         drop=[".sharedaddy", ".sd-sharing-enabled", ".jp-relatedposts", ".post-share", ".navigation", ".nav-links", ".sd-block",
               "script", "style", "iframe", "figure", "nav", ".wp-block-embed", "#jp-post-flair", ".post-likes-widget-placeholder"]),
    _row("latejacr", ['article[class*="ArticleBody"]', 'article[class*="article-body"]', 'div[class*="ArticleBody"]',
                      'div[class*="article-body"]', "article"],
         ["h1", "h2", "h3", "h4", "p", "li", "blockquote"], 16,
         drop=[*marked("gnad", "mgid-slot", "piano-inline", "fusion-static", "jp-relatedposts"),
               *parts("AdUnit", "dfp-container", "ad-", "mgid", "sharedaddy", "post-share", "related", "navigation", "interstitial"),
               '[data-test-id*="adslot"]', '[data-type="_mgwidget"]', "nav", *MEDIA],
         date=['time[class*="c-date"]@datetime|iso', 'time[class*="b-date"]@datetime|iso', TIME, META]),
    _row("lavozdegoicoechea", ["article", "main", 'div[class*="content"]', 'div[class*="post"]'], ["p", "h2", "h3", "li"], 21,
         drop=["script", "style", "iframe", "nav", "figure", "figcaption", ".sharedaddy", ".comments", ".related", ".ads", ".ad"], date=[TIME]),
    _row("mundiario", ['div[class*="content-data"]', 'div[class*="content-body"]', "article"],
         drop=[*parts("ad-slot", "oat", "advertisement", "related", "share", "metadata", "author", "meta-tags", "comment"), *marked("ad"),
               ".sharrre-tools", ".custom-ads", "#comentarios", *MEDIA, "nav", ".navigation"], date=[META]),
    _row("monumental", ['div[class*="contentPost"]', 'div[class*="content-post"]', 'div[class*="content-body"]', "article"],
         drop=[*MEDIA, *parts("ad", "share", "social", "related", "widget", "newsletter", "suscri"), *marked("ad"), "nav", ".navigation"],
         date=[META]),
    _row("ncrnoticias", ['div[class*="td-post-content"]', 'div[class*="td-fix-index"]', 'div[class*="tdb-block-inner"]', ENTRY, "article"],
         drop=[*parts("td-a-ad", "ad-slot", "dfp", "googletag", "heateor", "share", "social", "related", "td-related", "td-next", "td-prev",
                      "td-tags", "td-post-source"), *marked("_ad"), ".fb-comments", "#fb-root", ".fb_iframe_widget", "nav", ".navigation", *MEDIA,
               "#comments", ".comments-area"], date=[META]),
    _row("noticiasenlineacr", ['article[id*="the-post"] div[class*="entry-content"]', "article div.entry", "article"],
         drop=[*marked("share-buttons", "_ad", "post-extra-info"), *parts("share-buttons", "share-links", "ad-", "heateor", "post-meta",
                                                                          "single-post-meta", "related", "tie-related"),
               "#fb-root", ".fb-comments", "#comments", ".comments-area", ".comment-respond", "nav", "#breadcrumb", "figure", "figcaption",
               ".wp-video", ".mejs-container", "script", "style", "iframe"],
         date=['script#tie-schema-json|ld_top', 'script[type="application/ld+json"]|ld_top', META]),
    _row("costaricastar", ['div[class*="pf-content"]', ENTRY, 'div[class*="post-content"]', "article"], distinct=True,
         drop=[*parts("adsensemedio", "a-single", "printfriendly", "pf-button", "related", "share", "social"), *ADSENSE,
               *marked("google_ads", "related"), *MEDIA, "nav", "#comments", ".comments-area", 'a[href*="whatsapp"]'],
         date=["script.yoast-schema-graph|ld_graph", 'script[class*="yoast"]|ld_graph', 'meta[property="article:published_time"]@content|iso_utc']),
    _row("genteopa", [ENTRY, "div.wp-block-post-content", "article main", "main article", "main"], RICH, distinct=True,
         drop=["figure", "figcaption", *parts("wp-block-image", "addtoany", "a2a_", "wpdiscuz", "wpd-", "post-navigation", "related", "social"),
               *marked("wpdiscuz", "wpd-", "related"), "#comments", ".comments-area", "nav", "script", "style", "iframe", "button"],
         date=[TIME, META], section=['[class*="taxonomy-category"] a', 'a[rel="tag"][class*="category"]']),
    _row("pulsocr", ["div.entry-content.read-details", "div.read-details", "div.entry-content", "article"],
         drop=[*parts("author-bio", "author-box", "author-info", "tags-links", "post-item-metadata", "entry-meta", "post-navigation", "nav-links",
                      "share", "social-share", "social-buttons", "social-icons", "ad-", "related"), *marked("ad"), "nav", ".navigation", *MEDIA,
               "#comments", ".comments-area"],
         date=['span[class*="posts-date"]|es_month_first', 'div[class*="item-metadata"] span[class*="date"]|es_month_first', META],
         section=['span[class*="cat-links"] a', 'a[rel="category tag"]', '[class*="category"] a']),
    _row("puroperiodismo", ['div[class*="td-post-content"]', ENTRY, "article"], LISTED, distinct=True,
         drop=[*parts("code-block", "td-a-rec", "td-a-ad", "featured-image", "sharedaddy", "sd-sharing", "sd-block", "sd-like", "jetpack-likes",
                      "related", "post-navigation", "author", "tags"), *ADSENSE, *marked("google_ads", "jp-relatedposts"), "nav", ".navigation",
               *MEDIA, "#comments", ".comments-area"],
         date=[META], section=["a.td-post-category", '[class*="td-post-cat"] a', 'a[rel="category tag"]']),
    _row("repretel", ['div[class*="single-layout__article"]', 'div[class*="content"]', "article"], distinct=True,
         drop=["figure", "figcaption", *parts("wp-block-image", "ad-", "adsbygoogle", "share", "social", "sharedaddy", "wp-block-embed",
                                              "twitter-tweet", "related", "navigation", "comments"), *marked("ad"), "ins", "iframe", ".fb-post", "nav",
               "#comments", "script", "style"],
         date=['div[class*="single-layout__meta-date"]|es_dash_time', 'div[class*="meta-date"]|es_dash_time', META]),
    _row("rumboeconomico", ['div[class*="elementor-widget-container"]'], LISTED, distinct=True, choose="most", need=2,
         drop=["figure", "figcaption", *parts("sharedaddy", "sd-block", "jetpack", "navigation", "comments", "related", "ad-"), *marked("ad"), "nav",
               "#comments", "script", "style", "iframe", 'a[href*="/category/"]'], date=[META]),
    _row("sinartdigital", ['div[class*="element-textarea"]'], LISTED, distinct=True, choose="all", else_text=True,
         drop=[*MEDIA, *parts("share", "social", "ad-")], date=[META, '[class*="itemcreated"]|es_weekday']),
    _row("telediario", ['span[class*="base__body"]', 'div[class*="base__body"]'], ["p", "h3"], 10, True, choose="most", need=1,
         drop=[*parts("nd-text-highlights-detail-bold", "nd-related-news", "related", "img-container", "ad-"), *marked("ad"), "[data-mrf-recirculation]",
               "[camus-noembed-id]", "iframe", ".twitter-tweet", "figure", "figcaption", "script", "style", "nav"],
         date=['time[datetime][class*="datetime"]@datetime|dashed_time', 'time[datetime][class*="date"]@datetime|dashed_time', META],
         section=["[data-camus-section]"]),
    _row("teletica", ['div[class*="text-editor"]', '[class*="article-body"]', '[class*="article-content"]', "article main", "main article"], distinct=True,
         drop=[*parts("banner-holder", "ndg_inject", "related", "nota-image", "authorDate", "social", "component--"), *marked("gpt_unit", "google_ads"),
               "#relatedNews", "figure", "figcaption", ".image", ".top", 'a[href*="whatsapp"]', "script", "style", "iframe", ".component"],
         date=['div[class*="authorDate"] span|es_long_time', META], section=['div[class*="text-editor"] h4|short']),
    _row("theglobalcr", ['div[class*="tdb_single_content"]', 'div[class*="td-post-content"]', 'div[class*="tagdiv-type"]', ENTRY, "article"],
         ["p", "li"], distinct=True,
         drop=[*parts("td-a-ad", "id_ad_content", "tdc-a-ad", "featured_image", "share", "social", "sharedaddy", "related", "post-navigation", "comment",
                      "author", "td-tags", "tags-links"), *ADSENSE, ".id_top_ad", ".id_bottom_ad", *marked("related"), *MEDIA, "nav", "#comments"],
         date=['time[class*="td-module-date"][datetime]@datetime|iso', 'time[class*="entry-date"][datetime]@datetime|iso', META]),
    _row("ticotimes", ['div.tdb-block-inner[class*="td-fix-index"]', 'div[class*="td-fix-index"]'], distinct=True, choose="most", need=2,
         drop=[*parts("adthrive", "td-a-ad", "related", "td-related", "featured_image", "tdb_single_featured", "share", "sharedaddy", "jetpack",
                      "post-navigation", "comment", "tdb_single_date", "tdb_single_author", "td-tags"), *ADSENSE,
               *marked("AdThrive", "google_ads", "related"), "nav", "#comments", *MEDIA],
         date=['time[class*="td-module-date"][datetime]@datetime|iso', 'time[class*="entry-date"][datetime]@datetime|iso', META]),
    _row("trivisioncr", ["div.elementor-widget-container"], distinct=True, choose="most", need=1,
         drop=[*parts("ad-", "wp-block-image", "share", "social", "sharedaddy", "related", "comment", "dv25-pc-btn", "tags", "category"), *ADSENSE,
               *marked("ad", "google_ads", "related"), *MEDIA, "nav", "#comments", "button"],
         date=[META, '[class*="dv25"][class*="date"]|any_numeric', '[class*="entry-date"]|any_numeric', TIME]),
    _row("ticosland", [ENTRY, "article .post-content", ".post-body", "article"], distinct=True,
         drop=["figure", "figcaption", *parts("wp-caption", "wp-block-image", "ezmob", "ezad", "google-ad", "advertisement", "sharedaddy", "addtoany",
                                              "social", "share", "related", "yarpp", "comment", "post-navigation"), *ADSENSE,
               *marked("ezmob", "ezad", "advertisement", "related"), "#comments", ".comments-area", "nav", "script", "style", "iframe", "noscript",
               "button"]),
    _row("vozdeguanacaste", [ENTRY, 'div[class*="post-content"]', "main"], RICH, distinct=True,
         drop=[".sticky-wrapper", *marked("postShares", "related", "scroll-limit"), *parts(
             "postShares", "sharer", "wpml", "wp-caption", "wp-block-image", "related", "comment", "post-navigation", "social", "addtoany"),
               "[noindex]", "figure", "figcaption", "#comments", "nav", "script", "style", "iframe"],
         date=[META, "span.published abbr|mixed_short", TIME], section=['[class*="vdg-terms"] a', 'a[rel="category tag"]']),
    _row("puntarenasseoye", [ENTRY], least=1, joiner=_BLANK, drop=[], date=[".post-meta span.date|es_long"], least_text=300),
    _row("caribeactual", [ENTRY], least=1, joiner=_BLANK, drop=[], title=["h1.entry-title"],
         date=["time.entry-date.published|es_month_first_strict"], least_text=300),
    _row("presidencia", ['div[class*="field--name-body"]'], least=1, joiner=_BLANK, drop=[], date=["time.datetime@datetime|ten"], least_text=300),
    _row("crhoy", ['div[class*="wp-article"]', "article"], least=1, joiner=_BLANK, else_text=True, drop=QUIET,
         date=["span|es_short_month_only", "script#__cr_post_meta|post_date"],
         section=["script#__cr_post_meta|post_category", 'span[class*="orange-label"]|slug', 'span[class*="bg-orange"]|slug']),
    _row("el_observador", ["div.entry-text"], least=1, joiner=_BLANK, else_text=True, drop=QUIET, date=["time[datetime]@datetime|ten"],
         section=["div.meta span|slug"]),
    _row("amprensa", ["div.entry-content", "article", "div.post-content", "section#main-section"], least=21, joiner=_BLANK, else_text=True,
         drop=["script", "style", "iframe", "ins", "figure", "nav", "header", "footer", 'div[class*="ad" i]', 'div[class*="banner" i]'],
         title=["h1", "div.title-left h3"], author=["div.post-meta-author a", "div.post-meta-author"],
         date=["div.post-meta-date", "small.day"], section=['a[class*="label-"]']),
    _row("crc_89_1", ["div.entry-content"], least=1, joiner=_BLANK, else_text=True,
         drop=["script", "style", "iframe", "ins", "figure", 'div[class*="code-block"]'], title=["h1.post-title"],
         author=["a.author-name", "div.single-post-meta a"], date=["span.date", "time"], section=["span.post-cat-wrap"]),
    _row("diarioextra", ["div.single-layout__article"], least=1, joiner=_BLANK, else_text=True,
         drop=["script", "style", "iframe", "ins", "figure", "blockquote", 'div[class*="ned-ad"]'], title=["h1.single-layout__title", "h1"],
         author=["a.single-layout__author"], date=['script[type="application/ld+json"]|ld_article', "div.single-layout__meta-date"],
         section=['script[type="application/ld+json"]|ld_section', "div.single-layout__meta-taxonomy"], lead=["h2.single-layout__excerpt"]),
    _row("eldelfino", ["div.entry-content", 'article div[class*="content"]', 'div[class*="post-content"]', 'div[class*="article-content"]', "article"],
         HEADED, 26, choose="scan", noise="substring", need=40, fallback=60, drop=["script", "style"], author=['a[href*="/autor/"]'], no_author="",
         date=["time[datetime]@datetime", "time"]),
    _row("lanacion", ["div.paragraph-body", 'div[class*="paragraph-body"]', "section.body-content", 'div[class*="body-content"]',
                      'div[class*="story-body"]', 'div[class*="article-body"]', "div.entry-content", "article"],
         HEADED, 26, choose="scan", noise="substring", need=40, fallback=60, drop=["script", "style"], no_author="",
         author=['span[class*="author"]', 'a[class*="author"]', 'a[href*="/autor/"]'], date=["time[datetime]@datetime", 'span[class*="date"]', "time"]),
    _row("larepublica", ["div.entry-content", "div.td-post-content", 'div[class*="post-content"]', 'div[class*="article-body"]',
                         'article div[class*="content"]', "article"],
         HEADED, 26, choose="scan", noise="token", need=40, fallback=60, drop=["script", "style"], no_author="",
         author=['a[href*="/autor/"]', 'span[class*="author"]'], date=["div.date|es_weekday", "time[datetime]@datetime"],
         section=['a[href*="/seccion/"]|title']),
    _row("el_mundo", ["div.ue-l-article__body", 'div[class*="article__body"]', 'div[class*="article-body"]', 'div[class*="article__content"]',
                      'div[class*="cuerpo-noticia"]', 'section[class*="article"]'], HEADED, 1, noise="own", drop=["script", "style"],
         section=['span.ue-c-cover-content__section|title', 'a[class*="section"]|title', 'span[class*="section"]|title']),
    _row("el_seminario", ["div.entry-content", "div.post-content", "div.article-content", "div.td-post-content", '[class*="entry-content"]',
                          '[class*="post-content"]', "article"], HEADED, 1, noise="own", drop=["script", "style"],
         date=["time.entry-date@datetime", "time.published@datetime", "time[datetime]@datetime"],
         section=['article[class*="category-"]@class|class_category']),
    _whole("alajuela_digital", ['article[class*="small single"]'], FIGURED, title=["h1.title"], date=["span.mg-blog-date|english_short"],
           section=["div.mg-blog-category a|slug"]),
    _whole("el_financiero", ['article[class*="article-body"]', "article"], FIGURED, title=["h1.b-headline"],
           date=["time.c-date@datetime|ten", "time.c-date"], section=["a.c-overline|slug"]),
    _whole("el_jilguero", ['article[class*="small single"]', ENTRY], FIGURED, title=["h1.title"], date=["span.mg-blog-date|english_short"],
           section=["div.mg-blog-category a|slug_plus"]),
    _whole("el_jornal", [".entry-content", ".post-content", "article"], date=["body|es_long"], section=[NEWS_CATEGORY], least_text=300),
    _whole("eljornal", [".entry-content", ".post-content", "article"], date=["body|es_long"], section=[NEWS_CATEGORY], least_text=300),
    _whole("elnortehoy", [ENTRY], title=["h1.entry-title"], date=["span.published|es_tokens"], section=["span.ast-terms-link a|slug"]),
    _whole("el_sol_de_occidente", [ENTRY], title=["h1.entry-title"], date=["span.entry-meta-date a|slashed_strict", "span.entry-meta-date|slashed_strict"],
           section=["span.entry-meta-categories a|slug"]),
    _whole("digital506", ['div[class*="td-post-content"]'], [*BARE, "nav", "figure"], title=["h1.tdb-title-text"],
           date=['div[class*="td-main-content-wrap"] time[class*="entry-date"]@datetime|ten', 'time[class*="entry-date"]@datetime|ten'],
           section=[NEWS_CATEGORY], least_text=300),
    _whole("noticias_la_garita_costa_rica", ['article[class="small single"]'],
           [*FIGURED, "nav", 'div[class*="post-share"]', 'div[class*="gallery"]'], title=["div.mg-header h1.title"],
           date=['meta[property="article:published_time"]@content']),
    _whole("periodico_el_mundo", ["div.elementor-widget-theme-post-content div.elementor-widget-container", "div.elementor-widget-theme-post-content"],
           ["script", "style", "iframe", "figure", "div.code-block"], title=["h1.elementor-heading-title"],
           date=["span.elementor-post-info__item--type-date time", "span.elementor-post-info__item--type-date"]),
    _whole("sancarlosdigital", ['div[class*="td-post-content"]'], title=["h1.tdb-title-text"],
           date=['time[class*="entry-date"]@datetime|ten', 'time[class*="entry-date"]']),
    _whole("seminario", ["div.entry-content div.contenido-textual", "div.entry-content"], ["script", "style", "iframe", "figure"],
           date=["time|es_tokens"]),
]
# A plain profile for pages of unknown outlets: the article element and its paragraphs.
GENERIC = _row("*", ["article", "main", "body"], distinct=True, title=["h1.entry-title", "h1.headline", "h1", "title"],
               author=['a[class*="author"]', 'span[class*="author"]', 'meta[name="author"]@content'],
               date=['script[type="application/ld+json"]|ld_graph_local', META, TIME])

_RULE = "struct<kind:string,n:int,css:string,attribute:string,how:string>"
SCHEMA = (f"source string, rules array<{_RULE}>, choose string, whole boolean, least int, distinct boolean, joiner string, need int, "
          "fallback int, else_text boolean, teasers array<string>, no_author string, least_text int")


def rule(kind, n, text):
    """``css@attribute|parser`` as (kind, n, css, attribute, parser)."""
    css, _, how = text.partition("|")
    css, _, attribute = css.partition("@")
    return kind, n, css, attribute, how


def noise_rules(noise):
    """Noise words as rules; the words of tokens stand between blanks, hyphens and underscores."""
    if noise == "own":
        return [rule("own_noise", n, f'[class*="{w}"]') for n, w in enumerate(OWN_NOISE_WORDS)]
    sign = {"substring": "*=", "token": "%="}.get(noise)
    return [rule("noise", n, f'[class{sign}"{w}" i]') for n, w in enumerate(NOISE_WORDS)] if sign else []


def profile_rows(profiles=None):
    rows = []
    for p in PROFILES if profiles is None else profiles:
        rules = [rule(kind, n, text) for kind, texts in (
            ("container", p["containers"]), ("block", p["blocks"]), ("drop", p["drop"]), ("title", p["title"]), ("author", p["author"]),
            ("date", p["date"]), ("section", p["section"]), ("lead", p["lead"])) for n, text in enumerate(texts)]
        rows.append((p["source"], rules + noise_rules(p["noise"]), p["choose"], not p["blocks"], p["least"], p["distinct"], p["joiner"],
                     p["need"], p["fallback"], p["else_text"], list(p["teasers"]), p["no_author"], p["least_text"]))
    return rows


def profiles_frame(spark, profiles=None):
    return spark.createDataFrame(profile_rows(profiles), SCHEMA)
