"""TSV sink of the flat tables: tab separated, header line, one quoting rule
for write and read (a field holding a tab or a quote is quoted, quotes
doubled), NULL written as an empty field, LF line ends, edge blanks kept. Line
breaks in fields become spaces, so that the files can be split when they are
read; ``line_breaks="keep"`` quotes them instead, and such files are read with
``multiline=True``. Read back with :func:`doclake.sources.tsv.read_tsv`.

Each task writes its own part file; no single writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

TSV_OPTIONS = {
    "sep": "\t",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}


def write_tsv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists",
              line_breaks: str = "space") -> int:
    """Write ``df`` as TSV part files under ``path``; returns the number of
    rows written (counted by an observation during the write job itself, no
    second pass). Non-string columns are written as their string form (dates
    ISO, booleans true/false)."""
    if line_breaks not in ("space", "keep"):
        raise ValueError(line_breaks)
    text = {c: F.col(f"`{c}`").cast("string") for c in df.columns}
    if line_breaks == "space":
        text = {c: F.translate(x, "\r\n", "  ") for c, x in text.items()}
    cols = [x.alias(c) for c, x in text.items()]
    obs = Observation("tsv_rows")
    (df.select(*cols).observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode(mode).options(**TSV_OPTIONS).option("header", str(header).lower()).csv(path))
    return int(obs.get["rows"])


def write_lines(df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists") -> None:
    """Plain text lines (work lists, logs, stamped lists); to a new path."""
    df.select(col).write.mode(mode).text(path)
