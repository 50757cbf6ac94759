"""Headered CSV of ride records, read as text lines.

``spark.read.csv`` is not used: it drops blank lines and pads short rows, and both must be counted
as rejected records here. A line is split at every comma, without quoting rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions import text as X
from tripwright.functions.once import select_once
from tripwright.operators.split import in_first
from tripwright.schemas import CSV_FIELD_COUNT, RAW_TRIP, REQUIRED_COLUMNS
from tripwright.session import written

LINE_ORDER = ["file_path", "file_block_start", "line_id"]


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every line of the given files, with its place.

    ``(file_path, file_block_start, line_id)`` is the order of the lines in their files: ids grow
    within one block, and blocks are told apart by where they start.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    return numbered(lines.select("value", "_metadata.file_path", "_metadata.file_block_start"))


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with their ids, and without the carriage return of their end."""
    return lines.select(
        F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)"))
        .otherwise(F.col("value"))
        .alias("value"),
        "file_path",
        "file_block_start",
        F.monotonically_increasing_id().alias("line_id"),
    )


def header_lines(lines: DataFrame) -> DataFrame:
    """``file_path`` and ``header``, the first line, of each file that has any line."""
    first = lines.where("file_block_start = 0").groupBy("file_path")
    return first.agg(F.min_by("value", "line_id").alias("header"))


def header_positions(header: str) -> dict[str, int]:
    """Typed column name -> position in the line.

    Names are compared lower-cased and trimmed, in any order; other columns may stand between, and
    of two columns with one name the later counts.
    """
    place = {name.strip().lower(): i for i, name in enumerate(header.split(","))}
    missing = [name for name in REQUIRED_COLUMNS if name not in place]
    if missing:
        raise ValueError(f"required column not found: {', '.join(missing)}")
    return {column: place[name] for name, column in REQUIRED_COLUMNS.items()}


def parse_lines(lines: DataFrame, header: str, header_in_lines: bool = True) -> DataFrame:
    """Lines -> the nine typed columns, all columns of ``lines`` kept.

    A field that does not parse is null, and so are all nine where the field count is wrong; rule 1
    rejects both. ``is_header`` marks lines equal to the header: the first of a file is its header,
    any later one is a rejected record (see ``operators.rules``). Without ``header_in_lines`` the
    lines are data only.
    """
    place = header_positions(header)
    types = {f.name: f.dataType.simpleString() for f in RAW_TRIP.fields}
    line = X.canonical_line(
        F.col("value"), {place[n]: kind for n, kind in types.items()}, CSV_FIELD_COUNT
    )
    kept = list(lines.columns)
    if header_in_lines:
        lines = lines.withColumn("is_header", F.col("value") == F.lit(header))
        kept.append("is_header")
    texts = (
        lines.withColumn("line", line)
        .withColumn("fields", F.split("line", ",", -1))
        .selectExpr(*kept, *[f"get(fields, {place[name]}) as {name}_text" for name in types])
    )
    doubles = [name for name, kind in types.items() if kind == "double"]
    values = select_once(
        texts,
        [*kept, *[f"{name}_text" for name in doubles]],
        {name: X.parsed(f"{name}_text", kind) for name, kind in types.items()},
    )
    checked = [
        f"{X.without_overflow(name, f'{name}_text')} as {name}" if name in doubles else name
        for name in types
    ]
    return values.selectExpr(*kept, *checked)


def parse_files(lines: DataFrame) -> DataFrame:
    """``parse_lines`` with each file's own header.

    There are few layouts, so each is parsed by one plan over the files that have it. A file whose
    header lacks a required column is an error that names it.
    """
    headers = header_lines(lines)
    layouts = [r.header for r in headers.select("header").distinct().orderBy("header").collect()]
    if not layouts:
        raise ValueError("empty CSV: no header line")
    for header in layouts:
        try:
            header_positions(header)
        except ValueError as error:
            at = headers.where(F.col("header") == header).agg(F.min("file_path")).head()[0]
            raise ValueError(f"{at}: {error}") from error
    if len(layouts) == 1:
        return parse_lines(lines, layouts[0])
    parts = []
    for header in layouts:
        own = headers.where(F.col("header") == header).select("file_path")
        parts.append(parse_lines(lines.join(own, "file_path", "left_semi"), header))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_trips_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Unvalidated trip records of CSV files, each read by the header it has."""
    return parse_files(read_lines(spark, paths))


def first_lines(spark: SparkSession, paths: str | Sequence[str], n: int) -> DataFrame:
    """Trip records of the first ``n`` data lines in (path, position) order; 0 means all.

    Lines are counted per file in path order, more files each round, until they hold n; later files
    are never opened. Counts do not depend on how files are split. Files before the one with the
    n-th line are taken whole; that one's lines are stored once, and the cut is made in what is
    stored, so reading it with other splits later changes nothing.
    """
    files = sorted(spark.read.text(paths).inputFiles())
    if not files:
        raise ValueError("empty CSV: no header line")
    if n <= 0:
        return read_trips_csv(spark, files)
    take = 1
    while True:
        lines = read_lines(spark, files[:take])
        # One row per listed file; the listing itself is on the driver.
        counts = sorted(map(tuple, lines.groupBy("file_path").count().collect()))
        before, boundary = 0, None
        for path, rows in counts:
            if before + rows - 1 >= n:
                boundary = path
                break
            before += rows - 1
        if boundary is not None or take >= len(files):
            break
        take = min(take * 8, len(files))
    if boundary is None:
        return parse_files(lines)
    cut = _first_of_file(lines.where(F.col("file_path") == boundary), n - before + 1)
    whole = lines.where(F.col("file_path") < boundary)
    if boundary == counts[0][0]:
        return parse_files(cut)
    return parse_files(whole).unionByName(parse_files(cut))


def _first_of_file(lines: DataFrame, n: int) -> DataFrame:
    """The first n lines of one file, from a stored copy."""
    kept = written(lines, "csv-boundary")
    blocks = kept.groupBy("file_block_start").agg(F.count("*").alias("n"))
    # One row per block of one file.
    left, last = n, None
    for start, rows in sorted(map(tuple, blocks.collect())):
        last = start
        if left <= rows:
            break
        left -= rows
    block = kept.where(F.col("file_block_start") == last)
    cut = in_first(block, ["line_id"], left)
    earlier = F.col("file_block_start") < last
    return kept.where(earlier | ((F.col("file_block_start") == last) & cut))
