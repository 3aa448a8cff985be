"""Captured responses of a fetcher: classification, timings, page runs.

A captured response row: ``wine_id, page_no, url, status, location, error,
requested_at, received_at, body``. Everything here is built-in expressions,
partial aggregates and equi-joins; no per-group collection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK, REDIRECT, NO_REDIRECTION_HEADER, BAD_RESPONSE, ERROR = (
    "OK", "REDIRECT", "NO_REDIRECTION_HEADER", "BAD_RESPONSE", "ERROR")


def outcome(status: Column, location: Column, error: Column) -> Column:
    """200 -> OK; 3xx with a location -> REDIRECT; 3xx without -> NO_REDIRECTION_HEADER;
    any other status -> BAD_RESPONSE; an exception (``error`` set) -> ERROR."""
    redirect = status.between(300, 399)
    return (F.when(error.isNotNull(), F.lit(ERROR))
            .when(status == 200, F.lit(OK))
            .when(redirect & location.isNotNull(), F.lit(REDIRECT))
            .when(redirect, F.lit(NO_REDIRECTION_HEADER))
            .otherwise(F.lit(BAD_RESPONSE)))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps (truncated)."""
    return F.timestamp_diff("SECOND", start, end)


def classify(responses: DataFrame) -> DataFrame:
    return responses.withColumn("outcome", outcome(F.col("status"), F.col("location"), F.col("error"))) \
                    .withColumn("elapsed_s", elapsed_seconds(F.col("requested_at"), F.col("received_at")))


def outcome_counts(responses: DataFrame) -> DataFrame:
    c = classify(responses)
    return c.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_responses"),
                                    F.sum("elapsed_s").cast("bigint").alias("sum_elapsed_s"),
                                    F.max("elapsed_s").cast("bigint").alias("max_elapsed_s"))


def page_runs(pages: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Contiguous page runs per wine.

    ``pages``: ``(wine_id, page_no, state)`` with state ``ok`` (a non-empty
    page), ``empty`` (a valid page without items) or anything else (failed).
    A page captured several times (retries) counts by its best capture.
    ``starts``: ``(wine_id, start_page)``; default 1 for every wine.

    From its start page a wine's run takes pages while they are ``ok``; it
    stops at the first page that is empty, failed or missing. The run is
    *finished* only when it stops on an empty page. Output per wine:
    ``kept_pages`` (run length), ``finished`` and ``n_pages`` = run length +
    start - 1 (the page count of the success message).

    Plan: one aggregate per (wine, block of 32 page numbers) folds the captures
    into two bit masks (ok, empty) before anything is exchanged, so repeated
    captures need no exchange of their own and one wine with very many pages is
    spread over many tasks. An ok capture of a block's last page also names the
    next block, so a block that is missing there shows as one without pages.
    Each block gives its first page that is not ok by one bit count; the least
    of these is where a wine's run stops. No window over a wine's pages."""
    page = F.col("page_no").cast("long")
    own, at = F.shiftright(page, 5), page.bitwiseAND(F.lit(31)).cast("int")
    bit, none = _shiftleft(F.lit(1).cast("long"), at), F.lit(0).cast("long")
    is_ok = F.coalesce(F.col("state") == "ok", F.lit(False))
    named = pages.filter(page.isNotNull()).select(
        "wine_id", own.alias("_own"), F.when(is_ok, bit).otherwise(none).alias("_ok"),
        F.when(F.col("state") == "empty", bit).otherwise(none).alias("_empty"),
        F.explode_outer(F.when((at == 31) & is_ok, F.array(own, own + 1)).otherwise(F.array(own))).alias("block"))
    here = F.col("block") == F.col("_own")
    masks = named.groupBy("wine_id", "block").agg(F.bit_or(F.when(here, F.col("_ok")).otherwise(none)).alias("ok"),
                                                  F.bit_or(F.when(here, F.col("_empty")).otherwise(none)).alias("empty"))
    if starts is None:
        starts = pages.select("wine_id").distinct().withColumn("start_page", F.lit(1))
    else:  # a wine planned more than once starts at its first start page
        starts = starts.groupBy("wine_id").agg(F.min("start_page").alias("start_page"))
    start = F.col("start_page").cast("long")
    first = F.shiftright(start, 5)
    begin = F.when(F.col("block") == first, start.bitwiseAND(F.lit(31)).cast("int")).otherwise(F.lit(0))
    not_ok = F.bitwise_not("ok").bitwiseAND(_shiftleft(F.lit(BLOCK_BITS), begin)).bitwiseAND(F.lit(BLOCK_BITS))
    b = (masks.join(starts, "wine_id").filter(F.col("block") >= first)
         .select("wine_id", "block", "empty", first.alias("first"), not_ok.alias("not_ok")))
    lowest = F.col("not_ok").bitwiseAND(-F.col("not_ok"))
    stop = F.when(F.col("not_ok") != 0, F.col("block") * 32 + F.bit_count(lowest - 1))  # NULL: ok to the block's end
    per_wine = b.groupBy("wine_id").agg(
        F.min(stop).alias("stop"), F.min(F.when(F.col("empty").bitwiseAND(lowest) != 0, stop)).alias("stop_empty"),
        F.max(F.col("block") == F.col("first")).alias("has_first"))
    s = starts.join(per_wine, "wine_id", "left")
    has_first = F.coalesce("has_first", F.lit(False))
    kept = (F.when(has_first, F.col("stop")).otherwise(F.col("start_page")) - F.col("start_page")).cast("int")
    finished = F.coalesce(has_first & (F.col("stop_empty") == F.col("stop")), F.lit(False))
    return s.select("wine_id", kept.alias("kept_pages"), finished.alias("finished"),
                    (kept + F.col("start_page") - 1).cast("int").alias("n_pages"))


BLOCK_BITS = 0xFFFFFFFF


def _shiftleft(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)
