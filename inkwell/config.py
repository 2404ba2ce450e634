"""Settings that decide which columns and rows the relations have."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Parameter:
    """One key of a key/value array that becomes a column of its own."""

    key: str
    kind: str = "string"
    rename: str | None = None

    @property
    def column(self) -> str:
        return self.rename or self.key


def _default_event_parameters() -> dict[str, tuple[Parameter, ...]]:
    return {
        "page_view": (Parameter("article_id"), Parameter("section")),
        "scroll": (Parameter("article_id"),),
        "bookmark": (Parameter("article_id"),),
        "comment": (Parameter("article_id"),),
        "newsletter_signup": (Parameter("method"),),
    }


@dataclass(frozen=True)
class EngineConfig:
    """All settings of a build. Dates are explicit; nothing reads the clock."""

    property_id: int = 1
    start_date: str = "20000101"
    late_days: int = 3
    lookback_days: int = 30
    # Most days a session goes on after its first; engaged time is read that far back.
    session_span_days: int = 1
    conversion_events: tuple[str, ...] = ("newsletter_signup",)
    user_properties: tuple[Parameter, ...] = (
        Parameter("subscriber_status"),
        Parameter("subscription_tier"),
    )
    default_parameters: tuple[Parameter, ...] = ()
    event_parameters: Mapping[str, tuple[Parameter, ...]] = field(
        default_factory=_default_event_parameters
    )
    query_parameter_exclusions: tuple[str, ...] = ()

    @property
    def lookback_micros(self) -> int:
        return self.lookback_days * 24 * 60 * 60 * 1_000_000
