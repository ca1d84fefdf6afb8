"""What state landed files are in: one row per file, decided before any reader opens it.

A reader fails as a whole on a broken archive or a wrong encoding. Here every file is read once as lines of bytes, which
are checked where they are read: a file is valid UTF-8 if every line is, as no character holds the byte of a line end. Big
files are split over tasks, and no task holds more of a file than a line, or a batch of lines of an archive whose name does not say
that it is one. What reads files afterwards joins or filters by this table.
"""

import codecs
import zlib
from itertools import chain, groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import SPACE_CHARS
from pressmill.schema import MINIMUM_COLUMNS
from pressmill.session import shared_folder
from pressmill.sources.files import file_name, literal_path, plain_path

STEP = 1 << 20
BROKEN, ENCODING, EMPTY, COLUMNS = "broken archive", "encoding", "empty", "columns"
# Endings of names by which Spark's readers unpack what they read.
PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"
GZIP = b"\x1f\x8b"


def _unpacked(pieces):
    """The bytes of a file that comes in pieces; gzip members one after the other, in steps. Raises zlib.error where an archive is
    damaged."""
    first = next(pieces, b"")
    if first[:2] != GZIP:
        yield first
        yield from pieces
        return
    member, step, size = zlib.decompressobj(31), [], 0
    for data in chain([first], pieces):
        while data:
            if member.eof:
                yield b"".join(step)
                member, step, size = zlib.decompressobj(31), [], 0
            step.append(member.decompress(data, STEP - size))
            size += len(step[-1])
            data = member.unused_data if member.eof else member.unconsumed_tail
            if size == STEP:
                yield b"".join(step)
                step, size = [], 0
    yield b"".join(step)
    if not member.eof:
        yield member.flush()
    if not member.eof:
        raise zlib.error("ends early")


def _examine(pieces):
    decoder, head, ended = codecs.getincrementaldecoder("utf-8-sig")(), [], False
    try:
        for step in _unpacked(pieces):
            text = decoder.decode(step)
            if not ended:
                line, end, _ = text.partition("\n")
                head.append(line)
                ended = bool(end)
        head.append("" if ended else decoder.decode(b"", True))
        decoder.decode(b"", True)
    except zlib.error:
        return BROKEN, None
    except UnicodeDecodeError:
        return ENCODING, None
    line = "".join(head).removesuffix("\r")
    return (None, line) if line.strip() else (EMPTY, None)


def examine(content):
    """(problem or None, first line) of a file's bytes."""
    content = content or b""
    return _examine(content[at:at + STEP] for at in range(0, len(content), STEP))


def _lines(spark, paths, where=None, **options):
    """path, problem, line of the files that hold a line; ``line`` is the first one. Raises where an archive is damaged."""
    read = spark.read.options(lineSep="\n", **options).text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), F.col("value").alias("_line"))
    # ids rise along a file, so the least one of its first split is that of its first line
    place = F.when(F.col("_start") == 0, F.monotonically_increasing_id())
    read = (read if where is None else read.where(where)).withColumn("_place", place)
    # a set of one value: aggregates of strings are then kept per file instead of sorting all lines
    found = read.groupBy("path").agg(F.collect_set(F.when(~F.is_valid_utf8("_line"), F.lit(True))).alias("_bad"),
                                     F.min_by("_line", "_place").alias("line"))
    return found.select("path", F.when(F.size("_bad") > 0, F.lit(ENCODING)).alias("problem"), "line")


def _settle(df, folder):
    """``df`` written and read back; None where a file could not be read."""
    try:
        df.write.mode("overwrite").parquet(folder)
    except Exception as e:
        if "FAILED_READ_FILE" not in str(e):
            raise
        return None
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _archives(spark, paths, folder):
    """What is found in the archives ``paths``. Halves of a list are looked at again until the damaged ones are alone: these
    are broken, or of another encoding if the lines before the damage are."""
    todo, found = [paths], []
    while todo:
        some = todo.pop()
        names = [literal_path(p) for p in some]
        seen = _settle(_lines(spark, names), f"{folder}/{len(found)}")
        if seen is not None:
            found.append(seen)
        elif len(some) > 1:
            todo += [some[:len(some) // 2], some[len(some) // 2:]]
        else:
            upto = _lines(spark, names, ignoreCorruptFiles=True).select("path", F.coalesce("problem", F.lit(BROKEN)).alias("problem"), "line")
            # damaged before its first line: no row, so the one there is
            here = spark.read.format("binaryFile").load(names).select(F.col("_metadata.file_path").alias("path")).join(upto, "path", "left")
            found.append(_settle(here.select("path", F.coalesce("problem", F.lit(BROKEN)).alias("problem"), "line"), f"{folder}/{len(found)}"))
    return found


def _seen(spark, paths, listed):
    folder = shared_folder(spark)
    whole = _settle(_lines(spark, paths), f"{folder}/all")
    if whole is not None:
        return whole
    packed = F.col("path").rlike(PACKED)
    archives = [r["path"] for r in listed.where(packed).select(plain_path(F.col("path")).alias("path")).orderBy("path").toLocalIterator()]
    if not archives:
        return _lines(spark, paths)  # an error of the store
    out = _lines(spark, paths, ~F.col("path").rlike(PACKED))
    for part in _archives(spark, archives, f"{folder}/packed"):
        out = out.unionByName(part)
    return out


def _pieces(lines, size):
    """The ``size`` bytes of a file from its lines."""
    seen = -1
    for line in lines:
        if seen >= 0:
            yield b"\n"
        yield line
        seen += len(line) + 1
    if seen < size:
        yield b"\n"


def _by_bytes(spark, paths):
    """``examine`` on archives whose names do not say so. An archive is unpacked in one go, so the lines of its bytes come to
    one task, in order; no task holds more of it than a batch of lines."""
    def look(batches):
        rows = (row for b in batches for row in zip(b["path"], b["size"], b["line"]))
        for (path, size), some in groupby(rows, lambda row: row[:2]):
            yield pd.DataFrame([(path, *_examine(_pieces((row[2] for row in some), size)))], columns=["path", "problem", "line"])

    read = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"),
        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_place"))
    ordered = read.repartition("path").sortWithinPartitions("path", "_start", "_place")
    return ordered.select("path", "size", "line").mapInPandas(look, "path string, problem string, line string")


def file_status(spark, paths, required=MINIMUM_COLUMNS) -> DataFrame:
    """Files below ``paths``: path, file, bytes, sep, columns, problem. Columns and separator are null where the header could
    not be read; a file without problem holds all ``required`` columns. Files without a byte do not come up, as no reader
    of Spark's sees them. The files are read by the call, what is found lies below the shared folder."""
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path"), "length")
    seen = _seen(spark, paths, listed)
    unnamed = (F.col("problem") == ENCODING) & (F.substring(F.col("line").cast("binary"), 1, 2) == F.lit(GZIP))
    others = [r["path"] for r in seen.where(unnamed).select(plain_path(F.col("path")).alias("path")).toLocalIterator()]
    if others:
        seen = seen.where(~F.coalesce(unnamed, F.lit(False))).unionByName(_by_bytes(spark, others))
    found = listed.join(seen, "path", "left")
    head = F.when(F.col("problem").isNull(), F.regexp_replace("line", r"\r\z", ""))
    line = F.when(F.btrim(head, F.lit(SPACE_CHARS)) != "", head)
    rows = found.select("path", "length", line.alias("line"), F.coalesce("problem", F.when(line.isNull(), F.lit(EMPTY))).alias("problem"))
    line = F.col("line")
    sep = F.when(line.contains("|"), F.lit("|")).when(line.isNotNull(), F.lit(","))
    names = F.when(line.contains("|"), F.split(line, r"\|")).when(line.isNotNull(), F.split(line, ","))
    rows = rows.select(plain_path(F.col("path")).alias("path"), file_name(F.col("path")).alias("file"), F.col("length").alias("bytes"),
                       sep.alias("sep"), F.transform(names, lambda n: F.btrim(n, F.lit('" '))).alias("columns"), "problem")
    need = F.array(*[F.lit(c) for c in required]).cast("array<string>")
    lacking = F.when(F.size(F.array_except(need, "columns")) > 0, F.lit(COLUMNS))
    return rows.withColumn("problem", F.coalesce("problem", lacking))


def readable(status: DataFrame) -> DataFrame:
    return status.where("problem is null")


def skipped(status: DataFrame) -> DataFrame:
    """Files left out, by reason."""
    return status.where("problem is not null").groupBy("problem").agg(F.count("*").alias("files"))


def counts(status: DataFrame) -> DataFrame:
    return status.agg(F.count_if(F.col("problem").isNull()).alias("files_ok"), F.count_if(F.col("problem").isNotNull()).alias("files_error"))
