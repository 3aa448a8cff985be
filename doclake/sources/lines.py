"""Line files: work lists, logs, endpoint lists, raw lists.

Every parser takes a DataFrame with a string column ``value`` (one row per
line, as ``spark.read.text`` gives) so that it works the same on files and on
lines Spark derives from tables. Bad lines never fail a run: parsers return
good rows, and ``*_rejects`` functions return the others with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclake.functions.values import typed
from doclake.session import scratch_path

# Message formats of the run logs (fixed values).
SUCCESS_RE = r"^wine \[(\d+)\] HANDLED with (\d+) review pages$"
SUCCESS_FMT = "wine [%d] HANDLED with %d review pages"
NOT_FOUND_RE = r"^.*Bad response\(404 Not Found\) wineryId=\[(\d+)\].*$"
INT_RE = r"^[+-]?\d+$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files (any size: split by the file source), with the
    bare file name."""
    return (spark.read.text(path)
            .select("value", F.col("_metadata.file_name").alias("file_name")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their 0-based position in their file and the file's line
    count: ``(file_name, line_no, n_lines, value)``.

    The text is scanned once, into a stored copy that carries each line's
    split and place; how another scan would cut the files does not matter. On
    the copy, lines per split are counted (one small row per split), prefix
    sums over those rows give each split's first line number, and a join adds
    them back: no single-task window over the lines."""
    rows = (spark.read.text(path)
            .select("value",
                    F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_name").alias("file_name"),
                    F.col("_metadata.file_block_start").alias("blk"),
                    F.monotonically_increasing_id().alias("mid")))
    stored = scratch_path(spark, "numbered-lines")
    rows.write.parquet(stored)
    base = spark.read.schema(rows.schema).parquet(stored)
    per_split = base.groupBy("file_path", "blk").agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("m0"))
    w = Window.partitionBy("file_path").orderBy("blk")
    offsets = (per_split
               .withColumn("off", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)))
               .withColumn("n_lines", F.sum("n").over(Window.partitionBy("file_path"))))
    return (base.join(offsets, ["file_path", "blk"])
            .select("file_name", (F.col("off") + F.col("mid") - F.col("m0")).alias("line_no"),
                    "n_lines", "value"))


# --------------------------------------------------------------------------- work list

# Shape of a work-list line, checked without a repeated group (Java's regex
# engine recurses once per repetition of a group, which overflows the stack
# on very long lines): an id, "=", then signs, digits and commas only, with
# no empty element and no sign that is not in front of a number.
WORK_ID_RE = r"^[+-]?[0-9]+="
WORK_IDS_RE = r"^[+-]?[0-9][0-9+,-]*$"
WORK_IDS_BAD_RE = r",,|[+-][^0-9]|[0-9][+-]|[+-]$"


def materialized(df: DataFrame, *cols) -> DataFrame:
    """Project ``cols`` through a one-element explode. A filter placed on the
    result cannot be pushed below the generator, so the projected
    expressions are computed once instead of once more inside the filter.
    They are computed in a projection of their own: within the generator each
    row would prepare its regexes anew."""
    named = df.select(*cols)
    return named.select(F.explode(F.array(F.struct(*named.columns))).alias("_m")).select("_m.*")


def id_of(digits: Column) -> Column:
    """Digits as int; NULL for an empty text or a number beyond 32 bits. By way
    of long, so that ids out of range do not raise and catch errors."""
    n = F.when(digits != "", digits).try_cast("bigint")
    return F.when(n.between(-2**31, 2**31 - 1), n).cast("int")


def _work_list_ids(lines: DataFrame) -> DataFrame:
    """Shape check by flat regexes (no per-element lambdas, no recursion),
    then the split and the int conversion; out-of-range numbers give NULL
    elements."""
    v = F.col("value")
    at = F.instr(v, F.lit("="))
    cut = materialized(lines, v, F.substring_index(v, "=", 1).alias("_id"),
                       F.when(at > 0, F.rtrim(F.substr(v, at + 1), F.lit(","))).alias("_ids"))
    text = F.col("_ids")
    shape = F.coalesce(v.rlike(WORK_ID_RE) & text.rlike(WORK_IDS_RE) & ~text.rlike(WORK_IDS_BAD_RE), F.lit(False))
    return materialized(cut, v, "_id", "_ids", shape.alias("_shape")).select(
        "value", "_shape", typed("_id", "int").alias("wine_id"),
        F.when(F.col("_shape"), F.split("_ids", ",", -1).try_cast("array<int>")).alias("vintage_ids"))


def parse_work_list(lines: DataFrame) -> DataFrame:
    """``<wine_id>=<v1>,<v2>,...`` -> ``(wine_id int, vintage_ids array<int>)``.
    Trailing commas are allowed; anything else malformed is left out (see
    :func:`work_list_rejects`)."""
    p = _work_list_ids(lines)
    ok = (F.col("_shape") & F.col("wine_id").isNotNull()
          & F.forall("vintage_ids", lambda x: x.isNotNull()))
    return p.filter(ok).select("wine_id", "vintage_ids")


def work_list_rejects(lines: DataFrame) -> DataFrame:
    """Malformed lines with the first reason found."""
    v = F.col("value")
    parts = F.split(v, "=", -1)
    ids_text = F.regexp_replace(F.get(parts, 1), ",+$", "")
    p = _work_list_ids(lines)
    reason = (F.when(F.size(parts) != 2, F.lit("not_one_equals"))
              .when(~F.get(parts, 0).rlike(INT_RE), F.lit("bad_id"))
              .when(ids_text == "", F.lit("no_vintages"))
              .when(~F.col("_shape"), F.lit("bad_vintage_id"))
              .when(F.col("wine_id").isNull() | F.exists("vintage_ids", lambda x: x.isNull()),
                    F.lit("out_of_range")))
    return p.select("value", reason.alias("reason")).filter(F.col("reason").isNotNull())


def format_work_list(df: DataFrame, id_col: str = "wine_id", ids_col: str = "vintage_ids") -> DataFrame:
    """Inverse of :func:`parse_work_list`: one ``value`` line per row."""
    return df.select(F.concat(F.col(id_col).cast("string"), F.lit("="),
                              F.array_join(F.transform(ids_col, lambda x: x.cast("string")), ",")).alias("value"))


# --------------------------------------------------------------------------- logs

def success_messages(df: DataFrame, id_col: str, pages_col: str) -> DataFrame:
    return df.select(F.format_string(SUCCESS_FMT, F.col(id_col), F.col(pages_col)).alias("value"))


def parse_success_log(lines: DataFrame) -> DataFrame:
    """Finished wines from the run log: ``(wine_id, n_pages)``. Lines of
    other messages are skipped; ids beyond 32 bits are skipped."""
    v = F.col("value")
    # an empty capture means no match: no separate rlike pass
    wid = id_of(F.regexp_extract(v, SUCCESS_RE, 1))
    pages = id_of(F.regexp_extract(v, SUCCESS_RE, 2))
    return (materialized(lines, wid.alias("wine_id"), pages.alias("n_pages"))
            .filter(F.col("wine_id").isNotNull() & F.col("n_pages").isNotNull()))


def parse_not_found_log(lines: DataFrame) -> DataFrame:
    """Distinct winery ids answered with 404 in the fetch log."""
    v = F.col("value")
    return (materialized(lines.filter(v.rlike(NOT_FOUND_RE)),
                         F.regexp_extract(v, NOT_FOUND_RE, 1).try_cast("int").alias("winery_id"))
            .filter(F.col("winery_id").isNotNull())
            .distinct())


def keep_matching(lines: DataFrame, regex: str = SUCCESS_RE) -> DataFrame:
    """Lines that match ``regex`` in full (the log filter)."""
    return lines.filter(F.col("value").rlike(regex))


# --------------------------------------------------------------------------- endpoint lists

def parse_endpoints(lines: DataFrame) -> DataFrame:
    """``host<TAB>port`` (or ``host:port``) lines -> distinct ``(host, port)``;
    lines without a numeric port are dropped."""
    cols = F.split(F.col("value"), r"[\t:]", -1)
    return (lines.select(F.get(cols, 0).alias("host"), F.get(cols, 1).try_cast("int").alias("port"))
            .filter(F.col("port").isNotNull() & (F.col("host") != ""))
            .distinct())


def trim_raw_list(numbered: DataFrame, head: int = 3, tail: int = 1) -> DataFrame:
    """Raw downloaded list: drop the first ``head`` and last ``tail`` lines of
    each file, cut every line at its first whitespace, drop empty lines."""
    cut = F.regexp_replace("value", r"\s.*$", "")
    return (numbered.filter((F.col("line_no") >= head) & (F.col("line_no") < F.col("n_lines") - tail))
            .select("file_name", "line_no", cut.alias("value"))
            .filter(F.col("value") != ""))


def stamped_lines(df: DataFrame, host: str, port: str, ts: str | None = None) -> DataFrame:
    """``host<TAB>port<TAB>yyyy-MM-dd HH:mm:ss`` lines, stamped with the
    ``ts`` column or, when None, with the query's current time."""
    stamp = F.col(ts) if ts else F.current_timestamp()
    return df.select(F.concat_ws("\t", F.col(host), F.col(port).cast("string"),
                                 F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")).alias("value"))
