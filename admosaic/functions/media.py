"""Media types and asset URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import present_strings

# Media types of the common schema.
MEDIA_TYPES = ("image", "video", "multi", "text", "carousel", "unknown")


def media_type_from_assets(asset_types: Column) -> Column:
    """image when any asset type names an image, else video when any names a video, case-blind, else unknown."""
    return (
        F.when(F.exists(asset_types, lambda t: F.upper(t).contains("IMAGE")), F.lit("image"))
        .when(F.exists(asset_types, lambda t: F.upper(t).contains("VIDEO")), F.lit("video"))
        .otherwise(F.lit("unknown"))
    )


def media_type_from_format(ad_format: Column) -> Column:
    """video or image by the name of an ad format, case-blind, else unknown."""
    name = F.upper(ad_format)
    return (
        F.when(name.contains("VIDEO"), F.lit("video")).when(name.contains("IMAGE"), F.lit("image")).otherwise(F.lit("unknown"))
    )


def media_type_from_media(kinds: Column) -> Column:
    """video when any medium is a video, else image when any is a photo, else text."""
    return (
        F.when(F.array_contains(kinds, "video"), F.lit("video"))
        .when(F.array_contains(kinds, "photo"), F.lit("image"))
        .otherwise(F.lit("text"))
    )


def media_type_from_urls(video_urls: Column, image_urls: Column) -> Column:
    """video when there are video URLs, else image when there are image URLs, else unknown."""
    return (
        F.when(F.size(present_strings(video_urls)) > 0, F.lit("video"))
        .when(F.size(present_strings(image_urls)) > 0, F.lit("image"))
        .otherwise(F.lit("unknown"))
    )


def media_type_by_name(*names: Column) -> Column:
    """First name that is present, when it is an allowed media type (case-blind), else unknown."""
    name = F.lower(F.trim(F.coalesce(*names)))
    return F.when(name.isin(*MEDIA_TYPES), name).otherwise(F.lit("unknown"))


def collect_urls(*url_lists: Column) -> Column:
    """The non-empty URLs of several lists, one after the other."""
    empty = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(present_strings(urls), empty) for urls in url_lists])
