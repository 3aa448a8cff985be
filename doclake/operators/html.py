"""HTML field extraction as a ``mapInPandas`` operator.

This is the one place where Python runs per document: there is no HTML
parser among Spark's built-ins. Documents stay in their partitions; Arrow
batches carry them to the Python worker and back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.functions.html import extract, parse_selector

# Winery page fields (fixed values: CSS classes of the catalogue's pages).
WINEMAKER_SELECTOR = ".winery-page__header__winemaker"
CONTACT_SELECTOR = "div.winery-page__contact__content__column"
WINEMAKER_PREFIX = "Winemaker:"


def extract_fields(df: DataFrame, html_col: str, fields: dict[str, tuple[str, int]],
                   keep: list[str]) -> DataFrame:
    """Add one string column per field: ``name -> (selector, n)`` is the text
    of the n-th match (0-based) of the selector, or NULL when there are fewer
    matches; with n None, all matches as an array. ``keep`` columns are
    carried through. A page that cannot be read has NULL fields and
    ``html_error`` says why; the run goes on."""
    selectors = sorted({sel for sel, _ in fields.values()})
    index = {s: i for i, s in enumerate(selectors)}
    parsed = [parse_selector(s) for s in selectors]
    names = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = {k: b[k] for k in keep}
            cols: dict[str, list] = {n: [] for n in [*names, "html_error"]}
            for html in b[html_col]:
                try:
                    found, error = extract(html, parsed), None
                except ValueError as e:
                    found, error = None, str(e)
                cols["html_error"].append(error)
                for n in names:
                    sel, k = fields[n]
                    hits = found[index[sel]] if found else []
                    if k is None:
                        cols[n].append(hits if found else None)
                    else:
                        cols[n].append(hits[k] if k < len(hits) else None)
            out.update(cols)
            yield pd.DataFrame(out)

    kept_schema = [f for f in df.schema.fields if f.name in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept_schema]
                       + [f"`{n}` {'string' if fields[n][1] is not None else 'array<string>'}" for n in names]
                       + ["html_error string"])
    return df.select(*keep, html_col).mapInPandas(run, schema)


def _address_fields(pages: DataFrame, id_col: str, seo_col: str, html_col: str) -> DataFrame:
    return extract_fields(pages, html_col, {
        "winemaker": (WINEMAKER_SELECTOR, 0),
        "address": (CONTACT_SELECTOR, 0),
        "web": (CONTACT_SELECTOR, 1),
        "email": (CONTACT_SELECTOR, 2),
    }, [id_col, seo_col])


def winery_addresses(pages: DataFrame, id_col: str = "winery_id", seo_col: str = "seo_name",
                     html_col: str = "html") -> DataFrame:
    """Winery pages -> ``(winery_id, seo_name, winemaker, address, web, email)``:
    the winemaker line without its prefix, then the first three contact
    columns (empty text when a column is missing). A page that cannot be read
    gives no row, see :func:`html_quarantine`."""
    out = _address_fields(pages, id_col, seo_col, html_col).filter(F.col("html_error").isNull())
    wm = F.trim(F.regexp_replace(F.coalesce("winemaker", F.lit("")), "^" + WINEMAKER_PREFIX, ""))
    return out.select(F.col(id_col).alias("winery_id"), F.col(seo_col).alias("seo_name"), wm.alias("winemaker"),
                      *[F.coalesce(c, F.lit("")).alias(c) for c in ("address", "web", "email")])


def html_quarantine(docs: DataFrame) -> DataFrame:
    """Every document of a folder of winery pages with the rule it breaks:
    ``(file_name, reason)``, reason NULL for good pages."""
    from doclake.operators.flatten import HTML_FILE_RE
    n = F.col("file_name")
    named = docs.select("file_name", n.rlike(HTML_FILE_RE).alias("named"), F.col("body").alias("html"))
    out = extract_fields(named, "html", {"winemaker": (WINEMAKER_SELECTOR, 0)}, ["file_name", "named"])
    return out.select("file_name", F.when(~F.col("named"), F.lit("bad_file_name"))
                      .when(F.col("html_error").isNotNull(), F.lit("not_html")).alias("reason"))


def winery_pages(docs: DataFrame) -> DataFrame:
    """Raw documents of winery pages -> ``(winery_id, seo_name, html)`` with
    the id and name taken from ``winary-<id>-<seo_name>.html``."""
    from doclake.operators.flatten import HTML_FILE_RE
    n = F.col("file_name")
    return (docs.filter(n.rlike(HTML_FILE_RE))
            .select(F.regexp_extract(n, HTML_FILE_RE, 1).try_cast("int").alias("winery_id"),
                    F.regexp_extract(n, HTML_FILE_RE, 2).alias("seo_name"),
                    F.col("body").alias("html")))
