"""Names, word lists and patterns that results depend on.

They describe the export format, the public default channel rules and the wall
policy, so they must be exactly these. No logic lives here.
"""

# Fields of the nested records of the event export.
PRIVACY_FIELDS = ("analytics_storage", "ads_storage", "uses_transient_token")
USER_LTV_FIELDS = ("revenue", "currency")
DEVICE_TEXT_FIELDS = (
    "category",
    "mobile_brand_name",
    "mobile_model_name",
    "mobile_marketing_name",
    "mobile_os_hardware_model",
    "operating_system",
    "operating_system_version",
    "vendor_id",
    "advertising_id",
    "language",
    "browser",
    "browser_version",
)
DEVICE_WEB_FIELDS = ("browser", "browser_version", "hostname")
GEO_FIELDS = ("continent", "country", "region", "city", "sub_continent", "metro")
APP_FIELDS = ("id", "version", "install_source", "firebase_app_id")
COLLECTED_SOURCE_FIELDS = (
    "manual_campaign_id",
    "manual_campaign_name",
    "manual_source",
    "manual_medium",
    "manual_term",
    "manual_content",
    "manual_source_platform",
    "manual_creative_format",
    "manual_marketing_tactic",
    "gclid",
    "dclid",
    "srsltid",
)

# Event names with a meaning of their own.
SESSION_OPENERS = ("session_start", "first_visit")
ARTICLE_EVENTS = (
    "page_view",
    "scroll",
    "share",
    "bookmark",
    "comment",
    "newsletter_signup",
    "user_engagement",
    "video_start",
    "video_complete",
)
ARTICLE_ID_EVENTS = ("page_view", "scroll", "bookmark", "comment")
WALL_EVENTS = ("paywall_impression", "paywall_click")

# Parameters each staged event type carries as columns: (key, kind[, column]).
EVENT_TYPE_PARAMETERS = {
    "page_view": (("entrances", "int"), ("value", "float")),
    "session_start": (("entrances", "int"), ("value", "float")),
    "first_visit": (("page_location", "string", "landing_page"),),
    "user_engagement": (),
    "scroll": (("percent_scrolled", "int"),),
    "click": (
        ("entrances", "int"),
        ("outbound", "string"),
        ("link_classes", "string"),
        ("link_domain", "string"),
        ("link_url", "string"),
        ("click_element", "string"),
        ("link_id", "string"),
        ("click_region", "string"),
        ("click_tag_name", "string"),
        ("click_url", "string"),
        ("file_name", "string"),
    ),
    "file_download": (
        ("entrances", "int"),
        ("value", "float"),
        ("file_extension", "string"),
        ("file_name", "string"),
        ("link_classes", "string"),
        ("link_domain", "string"),
        ("link_id", "string"),
        ("link_text", "string"),
        ("link_url", "string"),
    ),
    "video_start": (
        ("video_current_time", "int"),
        ("video_duration", "int"),
        ("video_percent", "int"),
        ("video_url", "string"),
        ("video_provider", "string"),
        ("video_title", "string"),
        ("visible", "string"),
    ),
    "video_progress": (
        ("video_current_time", "int"),
        ("video_duration", "int"),
        ("video_percent", "int"),
        ("video_url", "string"),
        ("video_provider", "string"),
        ("video_title", "string"),
        ("visible", "string"),
    ),
    "video_complete": (
        ("video_current_time", "int"),
        ("video_duration", "int"),
        ("video_percent", "int"),
        ("video_url", "string"),
        ("video_provider", "string"),
        ("video_title", "string"),
        ("visible", "string"),
    ),
    "view_search_results": (
        ("entrances", "int"),
        ("search_term", "string"),
        ("unique_search_term", "string"),
    ),
    "search": (("search_term", "string"),),
    "share": (("method", "string"), ("content_type", "string"), ("item_id", "string")),
    "bookmark": (),
    "comment": (),
    "newsletter_signup": (),
    "paywall_impression": (),
    "paywall_click": (),
}

# Default channel rules.
DIRECT_SOURCE = "(direct)"
NO_MEDIUM = "(none)"
DIRECT_MEDIA = ("(none)", "(not set)")
CATEGORY_SEARCH = "SOURCE_CATEGORY_SEARCH"
CATEGORY_SHOPPING = "SOURCE_CATEGORY_SHOPPING"
CATEGORY_SOCIAL = "SOURCE_CATEGORY_SOCIAL"
CATEGORY_VIDEO = "SOURCE_CATEGORY_VIDEO"
PAID_MEDIUM_PATTERN = r"^(.*cp.*|ppc|retargeting|paid.*)$"
SHOPPING_CAMPAIGN_PATTERN = r"^(.*(([^a-df-z]|^)shop|shopping).*)$"
CROSS_NETWORK_PATTERN = r"cross-network"
VIDEO_MEDIUM_PATTERN = r"^(.*video.*)$"
EMAIL_PATTERN = r"email|e-mail|e_mail|e mail"
PUSH_MEDIUM_PATTERN = r"push$"
MOBILE_MEDIUM_PATTERN = r"mobile|notification"
DISPLAY_MEDIA = ("display", "banner", "expandable", "interstitial", "cpm")
SOCIAL_MEDIA = (
    "social",
    "social-network",
    "social-media",
    "sm",
    "social network",
    "social media",
)
REFERRAL_MEDIA = ("referral", "app", "link")

# URL patterns.
HOST_PATTERN = r"(?:https?://)?(?:www\.)?([^/:?#]+)"
QUERY_STRING_PATTERN = r"(?s)\?(.+)"
PATH_PATTERN = r"(?:\w+://)?//[^/]+([^?#]+)"
ARTICLE_URL_PATTERN = r"article-([0-9]+)"

# Wall policy: reads per calendar month before metered sections are walled.
FREE_READS_PER_MONTH = 3
READ_WINDOW_DAYS = 7

# Accepted values checked on the marts.
READER_TYPES = ("subscriber", "registered", "anonymous")
READER_STATES = ("registered", "anonymous")
SUBSCRIPTION_SOURCES = ("subscribe_event", "crm_only")
WALL_TYPES = ("hard", "metered")
BUNDLE_OFFERS = ("digital-only", "basic", "premium")
