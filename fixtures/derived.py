"""The event export, articles and accounts derived from the generic test tables.

The rules are those of FIXTURES.md section 3, except that all documents become
articles. Everything is integer arithmetic, so the same rules written in SQL give the
same rows. Hits are first a flat relation, then nested into the export's records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.functions.params import param
from inkwell.operators.joins import lookup
from inkwell.operators.ordered import sessionise
from inkwell.sources import schemas

GAP_MICROS = 12 * 60 * 60 * 1_000_000
HOME_PAGE = "https://www.example.com/"
ARTICLE_PAGE = "https://www.example.com/news/article-"
STREAM = "web-1"
# Source, medium, campaign, content and term of the page views that have them: all channels occur.
CAMPAIGNS = (
    ("google", "organic", None, None, "news"),
    ("Facebook", "social", None, "top-story", None),
    ("mailchimp", "email", "weekly-digest", None, None),
    ("(direct)", "(none)", None, None, None),
    ("google", "CPC", "brand-awareness", "ad-variant-a", "headlines"),
    ("google", "cpc", "cross-network-1", None, None),
    ("amazon", "cpc", None, None, None),
    ("facebook", "cpc", None, "ad-variant-b", None),
    ("youtube", "cpc", None, None, None),
    ("news-site", "banner", "spring", None, None),
    ("partner", "cpc", None, None, None),
    ("amazon", "referral", None, None, None),
    ("youtube", "referral", None, None, None),
    ("blog", "referral", None, None, None),
    ("partner", "affiliate", "spring", None, None),
    ("podcast", "audio", None, None, None),
    ("sms", "sms", None, None, None),
    ("app", "push", None, None, None),
    ("elsewhere", "other", None, None, None),
    ("blog", "link", None, None, None),
)


# Categories of the campaign sources that have one.
CATEGORIES = {
    "google": fixed.CATEGORY_SEARCH,
    "facebook": fixed.CATEGORY_SOCIAL,
    "youtube": fixed.CATEGORY_VIDEO,
    "amazon": fixed.CATEGORY_SHOPPING,
}


def source_categories(export: DataFrame) -> DataFrame:
    """Category of each source that occurs in the export and has one."""
    source = F.lower(param(F.col("event_params"), "source"))
    category = F.coalesce(*[F.when(F.col("source") == s, c) for s, c in CATEGORIES.items()])
    return (
        export.select(source.alias("source"))
        .distinct()
        .withColumn("source_category", category)
        .where(F.col("source_category").isNotNull())
    )


def _cut(k: Column, *steps: tuple[int, str], rest: str) -> Column:
    """The name of the first step whose bound ``k`` stays below."""
    bound, name = steps[0]
    choice = F.when(k < bound, name)
    for bound, name in steps[1:]:
        choice = choice.when(k < bound, name)
    return choice.otherwise(rest)


def _event_name(event_type: Column, k: Column) -> Column:
    return (
        F.when(event_type == "view", "page_view")
        .when(event_type == "error", "user_engagement")
        .when(
            event_type == "click",
            _cut(
                k,
                (40, "paywall_impression"),
                (55, "paywall_click"),
                (75, "scroll"),
                (85, "share"),
                (93, "bookmark"),
                rest="comment",
            ),
        )
        .when(
            event_type == "signup",
            _cut(
                k,
                (60, "newsletter_signup"),
                (64, "subscribe"),
                (82, "video_start"),
                rest="video_complete",
            ),
        )
        .otherwise(
            _cut(
                k,
                (60, "search"),
                (80, "video_progress"),
                (90, "click"),
                (95, "file_download"),
                rest="view_search_results",
            )
        )
    )


def driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "user_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    ).filter(F.col("user_id").isNotNull())


def user_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per driver event: its name, article, page before and place in its session.

    Pages go through the shuffles as article and ``k``; see :func:`_location`.
    """
    k = F.col("k")
    hits = driver_events(spark, sf_dir)
    article = ((F.col("event_id") * 7 + k) % _article_numbers(spark, sf_dir)).cast("int")
    # Only what is read below: rows and states then come from the same exchange.
    hits = hits.select(
        "event_id", "user_id", "micros", "k", _event_name(F.col("event_type"), k).alias("name"), article.alias("article")
    )
    buys = (F.col("name") == "subscribe") & (F.col("user_id") % 3 == 0)
    viewed = F.when(F.col("name") == "page_view", F.col("micros"))
    hits = sessionise(
        hits,
        "user_id",
        "micros",
        gap_micros=GAP_MICROS,
        tie_breakers=["event_id"],
        latest_before={"last_view": viewed, "last_page": F.when(F.col("article").isNotNull(), F.struct("article", "k"))},
        total={"buys": buys.cast("bigint")},
    )
    first_buy = buys & (F.col("buys") == 1)
    no_view_yet = F.col("last_view").isNull() | (F.col("last_view") < F.col("session_first_micros"))
    return hits.select(
        "event_id",
        "user_id",
        "micros",
        "k",
        "article",
        "session_number",
        "session_first_micros",
        "opens_session",
        F.when((F.col("name") == "subscribe") & ~first_buy, "newsletter_signup")
        .otherwise(F.col("name"))
        .alias("name"),
        F.when(~F.col("opens_session"), F.col("last_page")).alias("page_before"),
        ((F.col("name") == "page_view") & no_view_yet).alias("entrance"),
    )


def _location(article: Column, k: Column) -> Column:
    """The page of a hit; null without an article."""
    suffix = (
        F.when(k % 10 == 0, F.concat(F.lit("?gclid=g"), k.cast("string")))
        .when(k % 10 == 1, "?utm_source=x&id=7#top")
        .otherwise("")
    )
    return F.concat(F.lit(ARTICLE_PAGE), article.cast("string"), suffix)


def _article_numbers(spark: SparkSession, sf_dir: str) -> Column:
    """Numbers that hits refer to: those of all documents, and two that the CMS lacks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.agg((F.max("doc_id") + 3).alias("numbers")).scalar()


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of the users whose number is a multiple of three."""
    id_ = F.col("user_id")
    subscribes = _event_name(F.col("event_type"), F.col("k")) == "subscribe"
    first = F.min(F.when(subscribes, F.col("micros")))
    bought = F.to_date(F.timestamp_micros(first))
    users = driver_events(spark, sf_dir).filter(id_ % 3 == 0)
    users = users.groupBy("user_id").agg(bought.alias("bought"))
    late = F.date_add(F.lit("2024-01-10").cast("date"), (id_ % 15).cast("int"))
    subscribed = F.coalesce(F.col("bought"), F.when(id_ % 12 == 0, late))
    tier = F.when(id_ % 9 == 0, "digital-only").when(id_ % 9 == 3, "basic").otherwise("premium")
    users = users.withColumn("subscription_date", subscribed)
    has = F.col("subscription_date").isNotNull()
    churned = F.when(id_ % 5 == 0, F.date_add("subscription_date", 7))
    return users.select(
        id_.cast("string").alias("user_id"),
        F.concat(F.lit("u"), id_.cast("string")).alias("user_pseudo_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (id_ % 10).cast("int")).alias("registration_date"),
        _country(id_).alias("country"),
        (has & churned.isNull()).alias("is_subscriber"),
        F.when(has, tier).alias("subscription_tier"),
        "subscription_date",
        churned.alias("churn_date"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as articles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    id_ = F.col("doc_id")
    sections = F.array(*[F.lit(s) for s in ("politics", "sports", "culture", "lifestyle")])
    first = F.lit("2023-12-25 08:00:00").cast("timestamp")
    return docs.select(
        id_.cast("int").alias("article_id"),
        F.concat(F.lit("Document "), id_.cast("string")).alias("title"),
        F.get(sections, (id_ % 4).cast("int")).alias("section"),
        F.concat(F.lit("author-"), (id_ % 12).cast("string")).alias("author"),
        F.timestamp_micros(F.unix_micros(first) + (id_ % 1000) * 12 * 3_600_000_000).alias("published_at"),
        F.floor(F.col("n_chars") / 6).cast("int").alias("word_count"),
        (id_ % 10 == 0).alias("is_breaking"),
        (id_ % 5 == 0).alias("has_video"),
    )


def _numbered(name: str, number: Column) -> Column:
    return F.concat(F.lit(f"{name}-"), number.cast("string"))


def _country(id_: Column) -> Column:
    names = ("US", "United Kingdom", "Canada", "Germany", "India")
    return F.get(F.array(*[F.lit(n) for n in names]), (id_ % 5).cast("int"))


def _pair(
    key: str,
    *,
    text: Column | None = None,
    whole: Column | None = None,
    real: Column | None = None,
    stamp: Column | None = None,
) -> Column:
    """A list with one key/value entry, or an empty one when the value is null."""
    none = F.lit(None)
    fields = [
        (text if text is not None else none).cast("string").alias("string_value"),
        (whole if whole is not None else none).cast("bigint").alias("int_value"),
        (real if real is not None else none).cast("double").alias("float_value"),
        none.cast("double").alias("double_value"),
    ]
    pairs = schemas.PARAMS
    if stamp is not None:
        fields.append(stamp.alias("set_timestamp_micros"))
        pairs = schemas.USER_PROPERTIES
    given = next(v for v in (text, whole, real) if v is not None)
    entry = F.array(F.struct(F.lit(key).alias("key"), F.struct(*fields).alias("value")))
    return F.when(given.isNotNull(), entry.cast(pairs)).otherwise(F.array().cast(pairs))


def _params() -> Column:
    """The event parameters of a flat hit."""
    k, name, article = F.col("k"), F.col("name"), F.col("article")

    def on(*names: str) -> Column:
        return name.isin(*names)

    hit = k >= 0
    session = F.floor(F.col("session_first_micros") / 1_000_000).cast("bigint")
    odd = k % 2 == 1
    slot = F.floor(k / 5).cast("int") % len(CAMPAIGNS)
    tagged = on("page_view") & (k % 5 == 0)

    def campaign(*values: str | None) -> Column:
        choices = F.array(*[F.lit(v).cast("string") for v in values])
        return F.when(tagged, F.get(choices, slot))

    about = F.when(
        on("page_view", "scroll", "bookmark", "comment", "paywall_impression", "paywall_click", "subscribe"),
        article.cast("string"),
    )
    walled = on("paywall_impression", "paywall_click", "subscribe")
    offer = F.get(F.array(F.lit("digital-only"), F.lit("basic"), F.lit("premium")), article % 3)
    video = on("video_start", "video_progress", "video_complete")
    percent = (
        F.when(on("video_start"), 0)
        .when(on("video_complete"), 100)
        .when(on("video_progress"), (k % 3 + 1) * 25)
    )
    search = on("search", "view_search_results")
    share_method = F.when(k % 3 == 0, "copy").when(k % 3 == 1, "email").otherwise("x")
    method = F.when(on("share"), share_method).when(
        on("newsletter_signup"), F.when(odd, "popup").otherwise("footer")
    )
    kth = k.cast("string")
    download = on("file_download")
    entries = [
        _pair("ga_session_id", whole=F.when(~odd, session)),
        _pair("ga_session_id", text=F.when(odd, F.concat(F.lit("s"), session.cast("string"), F.lit("$x")))),
        _pair("ga_session_number", whole=F.col("session_number")),
        _pair("page_location", text=F.col("location")),
        _pair("page_title", text=F.when(on("page_view"), F.concat(F.lit("Article "), article.cast("string")))),
        _pair("page_referrer", text=F.col("referrer")),
        _pair("entrances", whole=F.when(F.col("entrance"), 1)),
        _pair("value", real=F.when(on("page_view"), k * 0.5)),
        _pair("article_id", text=about),
        _pair("item_id", text=F.when(on("share"), article.cast("string"))),
        _pair("content_type", text=F.when(on("share"), "article")),
        _pair("method", text=method),
        _pair("section", text=F.when(on("page_view"), F.concat(F.lit("section-"), (article % 4).cast("string")))),
        _pair("engagement_time_msec", whole=F.when(on("user_engagement"), k * 100 + 50)),
        _pair("session_engaged", whole=F.when(on("user_engagement") & ~odd, 1)),
        _pair("session_engaged", text=F.when(on("user_engagement") & odd, "1")),
        _pair("percent_scrolled", whole=F.when(on("scroll"), (k % 4 + 1) * 25)),
        *[
            _pair(field, text=campaign(*values))
            for field, values in zip(
                ("source", "medium", "campaign", "content", "term"), zip(*CAMPAIGNS, strict=True), strict=True
            )
        ],
        _pair("paywall_type", text=F.when(walled, F.when(article % 2 == 0, "hard").otherwise("metered"))),
        _pair("bundle_offer", text=F.when(walled, offer)),
        _pair("video_percent", whole=percent),
        _pair("video_duration", whole=F.when(video, 120)),
        _pair("video_current_time", whole=F.floor(percent * 120 / 100)),
        _pair("video_url", text=F.when(video, F.concat(F.lit("https://video.example/"), article.cast("string")))),
        _pair("video_provider", text=F.when(video, "youtube")),
        _pair("video_title", text=F.when(video, F.concat(F.lit("Clip "), article.cast("string")))),
        _pair("visible", text=F.when(video, "1")),
        _pair("search_term", text=F.when(search, F.concat(F.lit("term-"), (k % 20).cast("string")))),
        _pair("unique_search_term", text=F.when(on("view_search_results"), "1")),
        _pair("outbound", text=F.when(on("click"), "true")),
        _pair("link_url", text=F.when(on("click") | download, F.concat(F.lit("https://partner.example/"), kth))),
        _pair("link_domain", text=F.when(on("click") | download, "partner.example")),
        _pair(
            "file_name",
            text=F.when(download, F.concat(F.lit("report-"), kth, F.lit(".pdf"))).when(
                on("click"), _numbered("file_name", k % 3)
            ),
        ),
        *[_pair(n, text=F.when(on("click") | download, _numbered(n, k % 3))) for n in ("link_classes", "link_id")],
        *[
            _pair(n, text=F.when(on("click"), _numbered(n, k % 3)))
            for n in ("click_element", "click_region", "click_tag_name", "click_url")
        ],
        _pair("file_extension", text=F.when(download, "pdf")),
        _pair("link_text", text=F.when(download & hit, "Download")),
    ]
    return F.flatten(F.array(*entries))


def _properties(micros: Column) -> Column:
    """User properties of a logged-in hit, from the account row on it."""
    day = F.to_date(F.timestamp_micros(micros))
    active = (
        F.col("subscription_date").isNotNull()
        & (F.col("subscription_date") <= day)
        & (F.col("churn_date").isNull() | (F.col("churn_date") > day))
    )
    login = F.col("login").isNotNull()
    status = F.when(login, F.when(active, "subscriber").otherwise("registered"))
    return F.flatten(
        F.array(
            _pair("subscriber_status", text=status, stamp=micros),
            _pair(
                "subscription_tier", text=F.when(login & active, F.col("subscription_tier")), stamp=micros
            ),
        )
    )


def _record(schema, **values: Column) -> Column:
    """A struct of the given schema; fields not named are null."""
    return F.struct(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event export: hits, the added session openers, and some hits twice."""
    base = user_hits(spark, sf_dir)
    opens = F.col("opens_session")
    roles = F.array_compact(
        F.array(
            F.lit("hit"),
            F.when(opens, "session_start"),
            F.when(opens & (F.col("session_number") == 1), "first_visit"),
        )
    )
    rows = base.withColumn("role", F.explode(roles))
    hit = F.col("role") == "hit"
    offset = F.when(hit, 5).when(F.col("role") == "session_start", 1).otherwise(2)
    rows = rows.select(
        "user_id",
        "micros",
        "session_number",
        "session_first_micros",
        (F.col("event_id") * 10 + offset).alias("row_id"),
        F.when(hit, F.col("name")).otherwise(F.col("role")).alias("name"),
        F.when(hit, F.col("k")).otherwise(F.lit(-1)).alias("k"),
        F.when(hit, F.col("article")).alias("article"),
        F.when(hit, F.col("page_before")).alias("page_before"),
        (hit & F.col("entrance")).alias("entrance"),
    )
    user = F.col("user_id")
    logged_in = (user % 3 == 0) & ((F.col("name") == "subscribe") | (F.pmod(F.col("k"), F.lit(4)) != 0))
    rows = rows.withColumn("login", F.when(logged_in, user.cast("string")))
    people = accounts(spark, sf_dir).select(
        F.col("user_id").alias("login"), "subscription_tier", "subscription_date", "churn_date"
    )
    rows = lookup(rows, people, "login", ["row_id"])

    # Dealt out by day while the rows are narrow; their records are made after that.
    rows = rows.withColumn("day", F.date_format(F.timestamp_micros("micros"), "yyyyMMdd")).hint("rebalance", "day")
    opener = F.col("name").isin("session_start", "first_visit")
    page = _location(F.col("article"), F.col("k"))
    rows = rows.withColumn("location", F.when(opener, HOME_PAGE).otherwise(page))
    rows = rows.withColumn("referrer", _location(F.col("page_before.article"), F.col("page_before.k")))
    copies = F.when(F.col("row_id") % 970 == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("params", _params()).withColumn("copy", F.explode(copies))
    name, k = F.col("name"), F.col("k")
    denied = user % 50 == 49
    paid_hit = name.isin("subscribe", "newsletter_signup")
    clicked = (name == "page_view") & F.col("location").contains("gclid")

    def pick(number: Column, *values: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), number.cast("int"))

    browser = pick((k + 1) % 4, "Chrome", "Safari", "Firefox", "Edge")
    source = pick(user % 4, "google", "facebook", "mailchimp", "(direct)")
    columns = {
        "event_date": F.col("day"),
        "event_timestamp": F.col("micros"),
        "event_name": name,
        "event_params": F.when(F.col("copy") == 1, F.reverse("params")).otherwise(F.col("params")),
        "event_value_in_usd": F.when(paid_hit, k * 0.25),
        "event_bundle_sequence_id": F.col("row_id"),
        "event_server_timestamp_offset": k,
        "batch_event_index": F.col("copy"),
        "batch_ordering_id": F.col("row_id"),
        "batch_page_id": F.col("session_number"),
        "is_active_user": F.lit(True),
        "user_id": F.col("login"),
        "user_pseudo_id": F.when(~denied, F.concat(F.lit("u"), user.cast("string"))),
        "privacy_info": _record(
            schemas.PRIVACY,
            analytics_storage=F.when(denied, "No").otherwise("Yes"),
            ads_storage=F.lit("Yes"),
            uses_transient_token=F.lit("No"),
        ),
        "user_properties": _properties(F.col("micros")),
        "user_ltv": _record(schemas.USER_LTV, revenue=F.lit("0"), currency=F.lit("USD")),
        "device": _record(
            schemas.DEVICE,
            category=pick(user % 3, "desktop", "mobile", "tablet"),
            operating_system=pick(user % 4, "Windows", "Android", "iOS", "Macintosh"),
            language=F.lit("en-us"),
            browser=browser,
            is_limited_ad_tracking=(user % 2 == 0),
            time_zone_offset_seconds=(user % 5) * 3600,
            web_info=_record(
                schemas.DEVICE["web_info"].dataType, browser=browser, hostname=F.lit("www.example.com")
            ),
        ),
        "geo": _record(
            schemas.GEO,
            country=_country(user),
            region=F.concat(F.lit("region-"), (user % 7).cast("string")),
            city=F.concat(F.lit("city-"), ((k + 1) % 7).cast("string")),
        ),
        "app_info": F.when(
            opener,
            _record(schemas.APP, **{f: _numbered(f, user % 3) for f in fixed.APP_FIELDS}),
        ),
        "traffic_source": F.when(
            opener,
            _record(
                schemas.TRAFFIC_SOURCE,
                name=F.lit("launch"),
                medium=pick(user % 4, "organic", "social", "email", "(none)"),
                source=source,
            ),
        ),
        "stream_id": F.lit(STREAM),
        "platform": F.lit("web"),
        "collected_traffic_source": F.when(
            clicked,
            _record(
                schemas.COLLECTED_SOURCE,
                **{f: _numbered(f, k % 3) for f in fixed.COLLECTED_SOURCE_FIELDS if f != "gclid"},
                gclid=F.concat(F.lit("g"), k.cast("string")),
            ),
        ),
    }
    return rows.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.EVENTS.fields]
    )
