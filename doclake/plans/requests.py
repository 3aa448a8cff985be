"""Request strings for planned work rows (the hand-off to a fetcher).

Templates are parameters; the defaults use a placeholder base address. The
price form lists every vintage id as ``vintage_ids[]=<id>`` joined by ``&``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_URL = "https://catalogue.example.org"
WINES_PATH = "/api/wineries/%d/wines?start_from=%d&limit=%d"
REVIEWS_PATH = "/api/wines/%d/reviews?page=%d"
PRICES_PATH = "/api/prices?%s"
WINERY_PATH = "/wineries/%s"


def wines_request(winery_id, offset, count, base: str = BASE_URL) -> Column:
    return F.format_string(base + WINES_PATH, winery_id, offset, count)


def reviews_request(wine_id, page, base: str = BASE_URL) -> Column:
    return F.format_string(base + REVIEWS_PATH, wine_id, page)


def prices_request(vintage_ids, base: str = BASE_URL) -> Column:
    ids = F.col(vintage_ids) if isinstance(vintage_ids, str) else vintage_ids
    query = F.array_join(F.transform(ids, lambda x: F.concat(F.lit("vintage_ids[]="), x.cast("string"))), "&")
    return F.format_string(base + PRICES_PATH, query)


def winery_request(seo_name, base: str = BASE_URL) -> Column:
    return F.format_string(base + WINERY_PATH, seo_name)
