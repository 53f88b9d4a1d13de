"""What each source offers, as published by the sources themselves."""

# Endpoints, native parameter names, paging, limits and coverage by source.
PLATFORMS = {
    "amazon": {
        "name": "Amazon Store Ad Library (EU)",
        "version": "v1",
        "endpoints": {"search_ads": "adlib/search", "details": "adlib/ads/{adId}", "advertisers": "adlib/advertisers"},
        "params": {
            "keyword": "search_term", "advertisers": "advertiser_id", "countries": "country_codes",
            "date_from": "start_date", "date_to": "end_date", "types": "ad_type", "languages": "languages",
            "media": "media_type", "limit": "limit", "page_token": "next_token", "fields": "fields",
        },
        "paging": "token",
        "auth": "oauth_amazon_ads",
        "rate_limits": {"requests_per_hour": 100, "requests_per_day": 1000},
        "geographic": ["EU"],
        "temporal": "TBD",
    },
    "apple": {
        "name": "Apple App Store Ad Repository",
        "version": "v1",
        "endpoints": {
            "search_ads": "ad-repository-ads", "details": "ad-repository-ads", "advertisers": "ad-repository-entities",
        },
        "params": {
            "keyword": None, "advertisers": "id", "countries": "countryOrRegion", "date_from": None, "date_to": None,
            "types": "type", "languages": None, "media": None, "limit": "limit", "page_token": "offset", "fields": None,
        },
        "paging": "offset",
        "auth": "public_https",
        "rate_limits": {"requests_per_hour": 60, "requests_per_day": 1000},
        "geographic": ["Global"],
        "temporal": "90 days, 180 days, 1 year presets",
    },
    "booking": {
        "name": "Booking.com Ads Repository",
        "version": "v1",
        "endpoints": {"search_ads": "graphql", "details": "graphql", "advertisers": "graphql"},
        "params": {
            "keyword": "searchText", "advertisers": "advertiserName", "countries": "countryCode",
            "date_from": "dateFrom", "date_to": "dateTo", "types": "adType", "languages": "language",
            "media": "mediaType", "limit": "limit", "page_token": "offset", "fields": "fields",
        },
        "paging": "offset",
        "auth": "graphql_public",
        "rate_limits": {"requests_per_hour": 50, "requests_per_day": 500},
        "geographic": ["EU (DSA compliance)"],
        "temporal": "TBD",
    },
    "google": {
        "name": "Google Ads Transparency (BigQuery)",
        "version": "v1",
        "endpoints": {"search_ads": "query", "details": "query", "advertisers": "query"},
        "params": {
            "keyword": "creative_text_filter", "advertisers": "advertiser_name", "countries": "country_code",
            "date_from": "date_range_start", "date_to": "date_range_end", "types": "ad_type", "languages": "language",
            "media": "creative_format", "limit": "LIMIT", "page_token": "OFFSET", "fields": "SELECT",
        },
        "paging": "sql_offset",
        "auth": "gcp_service_account",
        "rate_limits": {"requests_per_hour": 100, "requests_per_day": 1000},
        "geographic": ["Global (political)", "Various (transparency)"],
        "temporal": "Historical political ad data",
    },
    "linkedin": {
        "name": "LinkedIn Ad Library",
        "version": "202405",
        "endpoints": {"search_ads": "", "details": None, "advertisers": "advertisers"},
        "params": {
            "keyword": "keyword", "advertisers": "advertiser", "countries": "countries", "date_from": "start_date",
            "date_to": "end_date", "limit": "count", "page_token": "start",
        },
        "paging": "offset",
        "auth": "oauth2_bearer",
        "rate_limits": {"requests_per_minute": 60, "requests_per_hour": 600},
        "geographic": ["Global"],
        "temporal": "Variable",
    },
    "meta": {
        "name": "Meta (Facebook & Instagram)",
        "version": "v19.0",
        "endpoints": {"search_ads": "ads_archive", "details": "ads_archive", "advertisers": None},
        "params": {
            "keyword": "search_terms", "advertisers": "page_ids", "countries": "ad_reached_countries",
            "date_from": "ad_delivery_date_min", "date_to": "ad_delivery_date_max", "types": "ad_type",
            "languages": "languages", "media": "media_type", "limit": "limit", "page_token": "after", "fields": "fields",
        },
        "paging": "cursor",
        "auth": "bearer_graph_token",
        "rate_limits": {"requests_per_hour": 200, "requests_per_day": 25000},
        "geographic": ["EU", "UK", "Global (political)"],
        "temporal": "1 year (EU/UK), 7 years (political)",
    },
    "microsoft": {
        "name": "Microsoft (Bing) Ad Library",
        "version": "v1",
        "endpoints": {"search_ads": "Ads", "details": "Ads/{AdId}", "advertisers": "Advertisers"},
        "params": {
            "keyword": "searchText", "advertisers": "advertiserId", "countries": "countryCodes",
            "date_from": "startDate", "date_to": "endDate", "types": None, "languages": None, "media": None,
            "limit": "top", "page_token": "skip", "fields": None,
        },
        "paging": "offset",
        "auth": "optional_developer_token",
        "rate_limits": {"requests_per_hour": 100, "requests_per_day": 1000},
        "geographic": ["EU", "EEA"],
        "temporal": "Available ad history",
    },
    "pinterest": {
        "name": "Pinterest Ads Repository",
        "version": "v1",
        "endpoints": {"search_ads": "ads", "details": "ads/{adId}", "advertisers": "advertisers"},
        "params": {
            "keyword": "search_term", "advertisers": "advertiser_id", "countries": "country_codes",
            "date_from": "start_date", "date_to": "end_date", "types": "ad_type", "languages": "languages",
            "media": "media_type", "limit": "limit", "page_token": "next_token", "fields": "fields",
        },
        "paging": "token",
        "auth": "api_key",
        "rate_limits": {"requests_per_hour": 60, "requests_per_day": 1000},
        "geographic": ["EU (DSA compliance)"],
        "temporal": "TBD",
    },
    "snapchat": {
        "name": "Snapchat Ads Library",
        "version": "v1",
        "endpoints": {"search_ads": "ads/search", "details": "ads/{ad_id}", "advertisers": None},
        "params": {
            "keyword": None, "advertisers": "paying_advertiser_name", "countries": "countries",
            "date_from": "start_date", "date_to": "end_date", "types": None, "languages": None, "media": None,
            "limit": None, "page_token": "cursor", "fields": None,
        },
        "paging": "cursor",
        "auth": "public",
        "rate_limits": {"requests_per_hour": 5, "requests_per_day": 20},
        "geographic": ["EU"],
        "temporal": "User-specified date ranges",
    },
    "tiktok": {
        "name": "TikTok Commercial Content Library",
        "version": "v2",
        "endpoints": {"search_ads": "ad/query", "details": "ad/detail", "advertisers": "advertiser/query"},
        "params": {
            "keyword": "search_term", "advertisers": "advertiser_business_ids", "countries": "country_code",
            "date_from": "ad_published_date_range.min", "date_to": "ad_published_date_range.max", "types": None,
            "languages": None, "media": None, "limit": "max_count", "page_token": "search_id", "fields": "fields",
        },
        "paging": "token",
        "auth": "oauth_client_credentials",
        "rate_limits": {"requests_per_hour": 100, "requests_per_day": 1000},
        "geographic": ["EU", "Global (expanding)"],
        "temporal": "Available ad history",
    },
    "x": {
        "name": "X (Twitter) Ads Repository",
        "version": "v1",
        "endpoints": {"search_ads": "ads", "details": "ads/{adId}", "advertisers": "advertisers"},
        "params": {
            "keyword": "search_term", "advertisers": "advertiser_id", "countries": "country_codes",
            "date_from": "start_date", "date_to": "end_date", "types": "ad_type", "languages": "languages",
            "media": "media_type", "limit": "limit", "page_token": "next_token", "fields": "fields",
        },
        "paging": "token",
        "auth": "bearer_token",
        "rate_limits": {"requests_per_hour": 50, "requests_per_day": 500},
        "geographic": ["Limited/Non-compliant"],
        "temporal": "TBD",
    },
}

# Settings that hold for every source which does not set its own.
GLOBAL = {
    "default_limit": 100,
    "max_limit": 1000,
    "default_timeout": 30,
    "max_retries": 3,
    "backoff_factor": 2,
    "cache_ttl": 300,
}

# Limits assumed where a source states none.
DEFAULT_RATE_LIMITS = {"requests_per_hour": 100, "requests_per_day": 1000, "retry_after_default": 60}

# Documented path(s) in the source's payload by field of the ad table.
FIELD_PATHS = {
    "meta": {
        "ad_id": ["id"], "advertiser_id": ["page_id"], "advertiser_name": ["page_name"],
        "first_seen": ["ad_delivery_start_time"], "last_seen": ["ad_delivery_stop_time"],
        "ad_text": ["ad_creative_bodies"], "media_type": ["media_type"], "media_urls": ["ad_snapshot_url"],
        "spend_range": ["spend"], "impressions_range": ["impressions"], "eu_reach": ["eu_total_reach"],
        "payer": ["beneficiary_payers.payer"], "beneficiary": ["beneficiary_payers.beneficiary"],
        "targeting_age": ["target_ages"], "targeting_gender": ["target_gender"],
        "targeting_locations": ["target_locations"], "countries": ["impressions_by_country"],
    },
    "tiktok": {
        "ad_id": ["ad.id"], "advertiser_id": ["advertiser.business_id"],
        "advertiser_name": ["advertiser.business_name"], "first_seen": ["ad.first_shown_date"],
        "last_seen": ["ad.last_shown_date"], "status": ["ad.status"],
        "media_urls": ["ad.videos.url", "ad.image_urls"], "impressions_range": ["reach.unique_users_seen"],
        "targeting_age": ["ad_group.targeting_info.age"], "targeting_gender": ["ad_group.targeting_info.gender"],
        "targeting_locations": ["ad_group.targeting_info.country"],
    },
    "microsoft": {
        "ad_id": ["AdId"], "advertiser_id": ["AdvertiserId"], "advertiser_name": ["AdvertiserName"],
        "first_seen": ["AdDetails.StartDate"], "last_seen": ["AdDetails.EndDate"],
        "impressions_range": ["AdDetails.TotalImpressionsRange"], "countries": ["ImpressionsByCountry.Country"],
        "targeting_other": ["TargetTypes"],
    },
    "apple": {
        "ad_id": ["adId"], "advertiser_id": ["developerId"], "advertiser_name": ["developerName"],
        "ad_text": ["shortDescription", "promotionalText"],
        "media_urls": ["adAssets.pictureUrl", "adAssets.videoUrl"], "countries": ["countryOrRegion"],
        "first_seen": ["firstImpressionDate"], "last_seen": ["lastImpressionDate"],
        "targeting_age": ["audienceRefinement.ageTarget"], "targeting_gender": ["audienceRefinement.genderTarget"],
        "targeting_locations": ["audienceRefinement.locationTarget"],
    },
    "google": {
        "ad_id": ["ad_id"], "advertiser_id": ["advertiser_id"], "advertiser_name": ["advertiser_name"],
        "first_seen": ["date_range_start"], "last_seen": ["date_range_end"], "ad_text": ["ad_text"],
        "spend_range": ["spend_range_min_usd"], "impressions_range": ["impressions"],
        "countries": ["country_code"], "targeting_age": ["age_targeting"], "targeting_gender": ["gender_targeting"],
    },
}
