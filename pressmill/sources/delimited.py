"""Delimited article files: strict, tolerant and sniffing readers.

Quoted fields hold line ends, so one file is read by one task; convert landed files to
Parquet once (see ``sinks``) and build on that.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.plans.corpus import union_by_name
from pressmill.schema import ARTICLE_COLUMNS, MINIMUM_COLUMNS, NULL_TEXT, TOLERANT_NULLS
from pressmill.sources.files import BACKUP, file_name, literal_path
from pressmill.sources.status import file_status
from pressmill.sources.status import readable as ok_files

_NO_NULL = "\x00"
_BROKEN = "_broken"


def _reader(spark, columns, sep):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BROKEN]])
    # with pruned columns the parser would no longer see rows of a wrong length
    return spark.read.schema(schema).options(
        sep=sep, header=True, quote='"', escape='"', multiLine=True, nullValue=_NO_NULL, emptyValue="",
        mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, columnPruning=False, enforceSchema=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxCharsPerColumn=-1)


def _cell(name):
    return F.col("`" + name.replace("`", "``") + "`")


def _with_place(df):
    """Add ``file`` and ``seq``: ids rise along a file because one task reads it whole."""
    return df.withColumns({"file": file_name(F.col("_metadata.file_path")), "seq": F.monotonically_increasing_id()})


def _fields(record, sep):
    """Number of fields of a raw record."""
    # doubled quotes first: what is left needs no group, which the regex engine would recurse into
    bare = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def read_strict(spark, paths, columns=ARTICLE_COLUMNS, sep="|") -> DataFrame:
    """Only the text ``NULL`` is null; empty fields stay empty; cells missing at the end of a
    short row are null. Overlong rows are an error in the source and raise."""
    raw = _with_place(_reader(spark, columns, sep).csv(paths))
    n = F.coalesce(_fields(F.col(_BROKEN), sep), F.lit(len(columns)))
    checked = F.when(n > len(columns), F.raise_error(F.concat(F.lit("too many fields in "), "file")).cast("string"))
    cells = []
    for i, c in enumerate(columns):
        text = F.when(n > i, F.coalesce(_cell(c), F.lit("")))
        cells.append(F.coalesce(checked, F.when(text != NULL_TEXT, text)).alias(c))
    return raw.select(*cells, "file", "seq")


def read_tolerant(spark, paths, columns=ARTICLE_COLUMNS, sep="|", nulls=TOLERANT_NULLS) -> DataFrame:
    """Usual null spellings become null, overlong rows are left out, short rows are padded."""
    raw = _with_place(_reader(spark, columns, sep).csv(paths))
    # the reader refuses to give the raw record without any data column, as when rows are counted:
    # behind a generator the first column is always asked for beside it
    fits = F.when(F.col(_BROKEN).isNull() | (_fields(F.col(_BROKEN), sep) <= len(columns)), F.struct(_cell(columns[0]).alias("_head")))
    whole = raw.withColumn("_fit", F.explode(F.filter(F.array(fits), lambda x: x.isNotNull())))
    cells = [F.when(~_cell(c).isin(list(nulls)), _cell(c)).alias(c) for c in columns]
    return whole.select(*cells, "file", "seq")


def headers(spark, paths) -> DataFrame:
    """Separator and columns of every file that can be read to its end: file, path, sep, columns."""
    return file_status(spark, paths, []).where("columns is not null").select("file", "path", "sep", "columns")


def readable(header_frame: DataFrame, required=MINIMUM_COLUMNS) -> DataFrame:
    """Headers with ``readable``: whether all required columns are there."""
    need = F.array(*[F.lit(c) for c in required])
    return header_frame.withColumn("readable", F.size(F.array_except(need, F.col("columns"))) == 0)


def read_listed(spark, files: DataFrame, strict=False) -> DataFrame:
    """The rows of listed files (path, sep, columns) of differing separators and headers, united by column name.

    A reader matches columns by position, so files of one (separator, header) - a handful of kinds - are read
    together, with their own schema."""
    kinds = {}
    for row in files.select("path", "sep", "columns").orderBy("path").toLocalIterator():
        kinds.setdefault((row["sep"], tuple(row["columns"])), []).append(literal_path(row["path"]))
    if not kinds:
        raise ValueError("no readable file")
    read = read_strict if strict else read_tolerant
    return union_by_name([read(spark, paths, list(columns), sep) for (sep, columns), paths in kinds.items()])


def read_sniffed(spark, paths, required=MINIMUM_COLUMNS, strict=False) -> DataFrame:
    """Files of differing separators and headers, united by column name; files that cannot be read or that lack a
    required column are left out (``file_status`` tells which)."""
    return read_listed(spark, ok_files(file_status(spark, paths, required)), strict)


def row_totals(spark, paths) -> DataFrame:
    """Rows per file, whatever its separator and header; null for files that cannot be read. Backups do not count."""
    found = file_status(spark, paths, []).where(~F.col("file").contains(BACKUP))
    known = found.select("file", "path", "problem", "sep", "columns")
    try:
        rows = read_listed(spark, ok_files(known)).groupBy("file").agg(F.count("*").alias("rows"))
    except ValueError:  # no file to read
        return known.select("file", F.lit(None).cast("long").alias("rows")).distinct()
    files = known.groupBy("file").agg(F.min("problem").alias("problem"))
    return files.join(rows, "file", "left").select("file", F.when(F.col("problem").isNull(), F.coalesce("rows", F.lit(0))).cast("long").alias("rows"))
