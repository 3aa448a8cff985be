"""Parse schemas of the catalogue's JSON documents and the flat output schemas.

Numeric leaves are parsed as ``string`` on purpose: the JSON mapper of the
catalogue accepts quoted numbers ("12") and fractions (1.7) for integer
fields, which a typed ``from_json`` would turn into NULL. They are converted
by the helpers of :mod:`doclake.functions.values`.
Fields of the documents that no output uses are left out of the schemas, so
the parser skips them (unknown fields are ignored, as by the catalogue).
"""

from __future__ import annotations

STATS = "struct<ratings_count: string, ratings_average: string, labels_count: string>"

REVIEWS_SCHEMA = f"""
reviews array<struct<
  id: string, rating: string, note: string, language: string, created_at: string,
  user: struct<id: string, seo_name: string, alias: string, visibility: string,
               followers_count: string, following_count: string, ratings_count: string>,
  vintage: struct<id: string, seo_name: string, year: string, name: string,
    statistics: {STATS},
    wine: struct<id: string, name: string,
      region: struct<id: string, name: string, country: struct<code: string, name: string>>>>,
  activity: struct<id: string, statistics: struct<likes_count: string, comments_count: string>>>>
"""

WINERY = ("struct<id: string, name: string, seo_name: string, "
          "statistics: struct<ratings_count: string, ratings_average: string, wines_count: string>>")

WINES_SCHEMA = f"""
wines array<struct<
  id: string, name: string, type_id: string,
  region: struct<id: string, name: string, seo_name: string,
    country: struct<code: string, name: string, regions_count: string, users_count: string,
                    wines_count: string, wineries_count: string>>,
  winery: {WINERY},
  statistics: {STATS},
  hidden: boolean,
  vintages: array<struct<id: string, seo_name: string, year: string, name: string,
                         statistics: {STATS}>>>>
"""

PRICES_SCHEMA = """
prices struct<
  market: struct<currency: struct<prefix: string, name: string>>,
  vintages: map<string, struct<median: struct<amount: string, type: string>,
                               price: struct<amount: string, discounted_from: string, type: string>>>>
"""

# Flat tables: column names in output order with their types (fixed values:
# the catalogue's headers).
REVIEWS_DDL = (
    "review_id int, rating float, note string, language string, created_at date, user_id int, "
    "user_seo_name string, user_alias string, user_visblty boolean, user_followers_count int, "
    "user_following_count int, user_ratings_count int, vintage_id int, vintage_seo_name string, "
    "vintage_year string, vintage_name string, vintge_stats_ratings_count int, "
    "vintge_stats_ratings_average float, vintge_stats_labels_count int, vintge_wine_id int, "
    "vintge_wine_name string, vintge_wine_region_id int, vintge_wine_rgn_name string, "
    "vintge_wine_rgn_cntry_code string, vintge_wine_rgn_cntry_name string, activity_id int, "
    "activity_stats_likes_count int, activity_stats_comments_count int")

VINTAGES_DDL = (
    "wine_id int, wine_name string, wine_type_id int, rgn__id int, rgn__name string, rgn__seo_name string, "
    "rgn__cntry__code string, rgn__cntry__name string, rgn__cntry__regions_count int, "
    "rgn__cntry__users_count int, rgn__cntry__wines_count int, rgn__cntry__wineries_count int, "
    "winery__id int, winery__name string, winery__seo_name string, winery__stats__ratings_count int, "
    "winery__stats__ratings_average float, winery__stats__wines_count int, stats__ratings_count int, "
    "stats__ratings_average float, stats__labels_count int, hidden boolean, vintages__id int, "
    "vintages__seo_name string, vintages__year string, vintages__name string, "
    "vintages__stats__ratings_count int, vintages__stats__ratings_average float, "
    "vintages__stats__labels_count int, wine_file string")

PRICES_DDL = (
    "wine_id int, vintage_id int, currency string, currency_name string, median__amount float, "
    "median__type string, price__amount string, price__discounted_from string, price__type string")

ADDRESSES_DDL = "winery_id int, seo_name string, winemaker string, address string, web string, email string"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


REVIEWS_COLUMNS, VINTAGES_COLUMNS, PRICES_COLUMNS, ADDRESSES_COLUMNS = map(
    _names, (REVIEWS_DDL, VINTAGES_DDL, PRICES_DDL, ADDRESSES_DDL))
