"""The checks that go with the relations, and their run: one scan per relation and unique key."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell import fixed_values as fixed
from inkwell.plans.warehouse import STORED, Warehouse


@dataclass(frozen=True)
class Checks:
    """Columns without nulls, keys without repeats (null keys are left out) and values allowed."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


DECLARED: dict[str, Checks] = {
    "articles": Checks(unique=(("article_id",),)),
    "accounts": Checks(unique=(("user_id",),)),
    "staged_events": Checks(unique=(("event_key",),)),
    "client_dimension": Checks(unique=(("client_key",),)),
    "client_facts": Checks(unique=(("client_key",),)),
    "articles_daily": Checks(("event_date_dt", "article_id", "page_views")),
    "articles_by_reader_type": Checks(
        ("event_date_dt", "article_id", "reader_type", "subscription_tier", "page_views"),
        (("event_date_dt", "article_id", "reader_type", "subscription_tier"),),
        {"reader_type": fixed.READER_TYPES},
    ),
    "traffic_sources_daily": Checks(("session_partition_date", "sessions")),
    "subscription_last_touch": Checks(
        ("user_id", "subscription_date", "subscription_tier"),
        (("user_id",),),
        {
            "subscription_source": fixed.SUBSCRIPTION_SOURCES,
            "last_article_reader_state": fixed.READER_STATES,
        },
    ),
    "paywall_daily": Checks(
        ("event_date_dt", "article_id", "paywall_type", "bundle_offer", "paywall_impressions", "paywall_clicks"),
        (),
        {"paywall_type": fixed.WALL_TYPES, "bundle_offer": fixed.BUNDLE_OFFERS},
    ),
    "paywall_sessions_daily": Checks(
        ("event_date_dt", "session_partition_key", "paywall_impressions"),
        (("event_date_dt", "session_partition_key"),),
    ),
}


def checked(df: DataFrame, relation: str, checks: Checks) -> DataFrame:
    """A row per check: relation, check, failures, passed."""
    in_rows = {f"not_null {c}": F.col(c).isNull() for c in checks.not_null}
    in_rows |= {
        f"accepted_values {c}": F.col(c).isNotNull() & ~F.col(c).isin(*values)
        for c, values in checks.accepted.items()
    }
    parts = []
    if in_rows:
        counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in in_rows.items()])
        named = F.array(
            *[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failures")) for n in in_rows]
        )
        parts.append(counts.select(F.explode(named).alias("c")).select("c.*"))
    for key in checks.unique:
        keyed = df.select(*key).dropna(how="all").groupBy(*key).count()
        parts.append(
            keyed.agg(F.count_if(F.col("count") > 1).alias("failures")).select(
                F.lit(f"unique {', '.join(key)}").alias("check"), "failures"
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(
        F.lit(relation).alias("relation"), "check", "failures", (F.col("failures") == 0).alias("passed")
    )


def run_checks(w: Warehouse, declared: Mapping[str, Checks] = DECLARED) -> DataFrame:
    """All declared checks over a warehouse: of the tables as they are stored, and of the views on them."""

    def rows(name: str) -> DataFrame:
        return w.table(name) if name in w.inputs or name in STORED else w.relation(name)

    return reduce(DataFrame.unionByName, [checked(rows(n), n, c) for n, c in declared.items()])
