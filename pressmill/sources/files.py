"""Finding landed files: listings are tables, rules are filters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of intermediate files that never count as output.
DISCARDED, BACKUP = "_discarded", "_backup"
# Seconds by which a file may be older than the run that wrote it.
FRESHNESS_TOLERANCE_S = 10

# Outlets whose files do not carry their own name (glob patterns).
FILE_ALIASES = {
    "acontecer_cr": ["acontecercr_*.csv", "acontecerCR_*.csv"],
    "alajuela_digital": ["alajueladigital.csv"],
    "crc_89_1": ["crc891.csv"],
    "digital506": ["DIGITAL506.csv", "digital506.csv"],
    "el_jilguero": ["jilgueromedia.csv"],
    "el_jornal": ["eljornalcr.csv"],
    "el_observador": ["observadorcr_*.csv"],
    "el_sol_de_occidente": ["elsoldeoccidente.csv"],
    "el_financiero": ["elfinancierocr.csv"],
    "el_mundo": ["noticias_elmundo_*.csv"],
    "el_seminario": ["noticias_semanario_*.csv"],
    "eldelfino": ["noticias_delfino_*.csv"],
    "elnortehoy": ["elnortehoycr.csv"],
    "lanacion": ["noticias_nacion_*.csv"],
    "larepublica": ["noticias_larepublica_*.csv"],
    "noticias_la_garita_costa_rica": ["noticiaslagarita_*.csv"],
    "periodico_el_mundo": ["elmundocr.csv"],
    "periodico_mi_tierra": ["mitierra_*.csv"],
    "seminario": ["semanariouniversidad.csv"],
}


def plain_path(path):
    """A path as written: metadata columns give it percent-encoded (a plus sign is not)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path that readers take as it is, whatever glob characters it holds."""
    return "".join("\\" + c if c in "\\*?[]{}," else c for c in path)


def file_name(path):
    """Logical file of a path: the value of a ``file=`` folder, else the last component."""
    plain = plain_path(path)
    return F.coalesce(F.nullif(F.regexp_extract(plain, r"/file=([^/]+)/", 1), F.lit("")),
                      F.element_at(F.split(plain, "/"), -1))


def listing(spark, folder, pattern="*.csv") -> DataFrame:
    """Files below ``folder``: path, file, bytes, modified. Contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern) \
        .option("recursiveFileLookup", True).load(folder)
    return found.select("path", file_name(F.col("path")).alias("file"), F.col("length").alias("bytes"),
                        F.col("modificationTime").alias("modified"))


def expanded(spark, path, pattern="*.csv") -> DataFrame:
    """What a path stands for: the file itself, or the article files of a folder in order of their names."""
    return listing(spark, path, pattern).orderBy("path")


def outputs(files: DataFrame, backups=True) -> DataFrame:
    """Article files only: no discard logs, and no backups where ``backups`` is off."""
    kept = files.where(~F.col("file").contains(DISCARDED))
    return kept if backups else kept.where(~F.col("file").contains(BACKUP))


def of_day(files: DataFrame, day: str) -> DataFrame:
    """Files of one day by their name ending (``*_yyyymmdd.csv``)."""
    return outputs(files, backups=False).where(F.col("file").endswith(f"_{day}.csv"))


def alias_frame(spark, sources, aliases=FILE_ALIASES) -> DataFrame:
    """Glob patterns per source as (source, pattern): own name first, then aliases."""
    rows = [(s, p) for s in sources for p in [f"{s}_*.csv", f"{s}.csv", *aliases.get(s, [])]]
    return spark.createDataFrame(rows, "source string, pattern string")


def _like(pattern):
    escaped = F.regexp_replace(pattern, r"([.\\^$|()\[\]{}+])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("$"))


def latest_by_alias(files: DataFrame, patterns: DataFrame, since=None) -> DataFrame:
    """Newest matching file per source, at most slightly older than ``since``.

    A pattern's text before its first ``*`` is how a name must begin. Names and patterns meet on the length and text of
    that beginning, for the few lengths in use, so no file is held against every pattern."""
    found = outputs(files, backups=False)
    if since is not None:
        found = found.where(F.col("modified") >= since - F.make_dt_interval(secs=F.lit(FRESHNESS_TOLERANCE_S)))
    begun = patterns.withColumn("_start", F.substring_index("pattern", "*", 1)).withColumn("_n", F.length("_start"))
    lengths = F.array(*[F.lit(r[0]) for r in begun.select("_n").distinct().collect()]).cast("array<int>")  # a few dozen
    starts = found.withColumn("_n", F.explode(lengths)).withColumn("_start", F.expr("substring(file, 1, _n)"))
    hits = starts.join(begun, ["_n", "_start"]).where(F.regexp_like("file", _like(F.col("pattern"))))
    return hits.groupBy("source").agg(
        F.max_by(F.struct("path", "file"), F.struct("modified", "path")).alias("f")).select("source", "f.*")
