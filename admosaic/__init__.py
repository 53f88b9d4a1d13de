"""Ad transparency data on Spark: one ad table from many sources, searched and reported on as DataFrames."""

from .operators.advertisers import advertiser_items, advertiser_pages
from .operators.analytics import (
    ads_by_platform,
    advertiser_samples,
    clean_long,
    clean_wide,
    country_impressions,
    country_impressions_top,
    delivery_breakdown,
    targeting_breakdown,
    targeting_facets,
    total_ads,
    unnest_impressions,
    unnest_targeting,
)
from .operators.bulk import get_all
from .operators.fetchlog import (
    classify_errors,
    collect_pages,
    collected_bodies,
    fetch_errors,
    page_audit,
    page_chains,
    page_totals,
    quota_usage,
    quota_windows,
    usage_tier,
)
from .operators.normalize import (
    conform_ads,
    fill_missing_ids,
    latest_ads,
    linkedin_flat,
    normalize_ads,
    normalize_creatives,
    normalize_items,
    select_fields,
    stamp_fetched,
    union_ads,
)
from .operators.quality import check_ads, violation_summary
from .operators.reports import add_to_reports, platform_report, report_of_partials, report_partials, stored_report
from .operators.requests import detail_requests, native_params, request_manifest, valid_requests, validate_requests
from .operators.search import (
    ad_details,
    find_ads,
    match_counts,
    matching_pairs,
    missing_ids,
    page_after,
    page_of_results,
    search_ads,
    search_ads_batch,
    search_advertisers,
)
from .schema import ADS, empty_ads
from .sources.pages import page_counters, page_errors, read_raw_pages, unwrap_pages
from .sources.registry import (
    ads_with_limits,
    field_coverage,
    platform_capabilities,
    platform_coverage,
    platform_endpoints,
    platform_limits,
    platform_params,
    platforms,
    source_index,
    supports,
)
from .sources.tables import read_creatives, save_ads_by_id, write_ads
from .streaming.ingest import ingest_pages_stream, stream_ads, stream_pages, stream_quota
from .streaming.quota import ingest_quota_stream, read_late, read_quota
from .streaming.upsert import merge_batch, read_upserted, upsert_pages_stream

__all__ = [name for name in dir() if not name.startswith("_")]
