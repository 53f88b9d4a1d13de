"""Everything landed for a request or a source, as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.pages import page_counters
from .advertisers import advertiser_items
from .fetchlog import collect_pages, collected_bodies
from .normalize import normalize_ads
from .search import find_ads


def get_all(
    pages: DataFrame, platform: str, operation: str = "search_ads", max_pages: int | None = None, **request
) -> DataFrame:
    """Ads (or advertisers) of all collected pages of a source: of each request the pages up to the first empty one,
    at most ``max_pages`` where that is given. ``request`` narrows the ads as in `find_ads`.
    """
    if operation not in ("search_ads", "advertisers"):
        raise ValueError("operation must be search_ads or advertisers")
    landed = pages.filter((F.col("platform") == platform) & (F.col("operation") == operation))
    kept = collected_bodies(landed, collect_pages(page_counters(landed, [platform]), max_pages))
    if operation == "advertisers":
        return advertiser_items(kept, platform)
    ads = normalize_ads(kept, platforms=[platform])
    return find_ads(ads, platform, **request) if request else ads
