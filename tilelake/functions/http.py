"""Classification of logged requests, redirects, transfers and waits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the service's protocol and retry policy.
LOGIN_PATH = "/auth/login"
THROTTLE_STATUSES = (429, 503)
HTTP_RETRYABLE = (429, 500, 502, 503, 504)
EXPIRY_PATTERN = "accessdenied|request has expired|expired"
TRANSFER_BACKOFF = {"first": 0.5, "cap": 30.0, "waits": 5}
HTTP_BACKOFF = {"first": 2.0, "cap": 120.0, "waits": 5}

_HTTP_DATE = (
    r"^(?:[A-Za-z]{3,9},\s*)?(\d{1,2})[\s-]([A-Za-z]{3})[\s-](\d{4})\s+"
    r"(\d{2}:\d{2}:\d{2})(?:\s+(GMT|UTC|UT|Z|[+-]\d{4}))?$"
)


def _http_date(value: Column) -> Column:
    part = lambda i: F.regexp_extract(value, _HTTP_DATE, i)
    zone = F.when(part(5).rlike(r"^[+-]\d{4}$"), part(5)).otherwise(F.lit("+0000"))
    text = F.concat_ws(" ", part(1), F.initcap(part(2)), part(3), part(4), zone)
    return F.when(
        value.rlike(_HTTP_DATE), F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss xx"))
    )


def parse_retry_after(value: Column, at: Column) -> Column:
    """Seconds to wait: a whole number as given, or an HTTP date minus ``at`` floored at 0.

    ``at`` is the row's own time, so a log gives the same answer whenever it is read.
    """
    text = F.trim(value)
    wait_us = F.unix_micros(_http_date(text)) - F.unix_micros(at)
    return F.when(text.rlike(r"^\d+$"), text.try_cast("double")).otherwise(
        F.when(wait_us.isNotNull(), F.greatest(F.lit(0.0), wait_us / F.lit(1_000_000.0)))
    )


def log_safe_url(url: Column) -> Column:
    """Scheme, host and path only: queries of pre-signed URLs carry the credential."""
    return F.regexp_replace(url, r"(?s)[?#].*$", "")


def is_throttled(status: Column) -> Column:
    return status.isin(*THROTTLE_STATUSES)


def is_login_redirect(status: Column, location: Column) -> Column:
    """A 3xx whose target path, trailing slashes aside, is the login page."""
    path = F.regexp_replace(
        F.regexp_replace(log_safe_url(location), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?", ""),
        r"/+$", "",
    )
    return F.coalesce(status.between(300, 399) & (path == LOGIN_PATH), F.lit(False))


def exchange_action(status: Column, location: Column) -> Column:
    """What a token exchange response leads to."""
    return (
        F.when(is_login_redirect(status, location), "reauth")
        .when(status.between(300, 399) & (F.coalesce(location, F.lit("")) == ""), "fail")
        .when(status.between(300, 399), "presigned")
        .when(status == 403, "remint")
        .otherwise("fail")
    )


def transfer_action(
    status: Column, content_range: Column, start: Column, declared: Column, body: Column
) -> Column:
    """How a ranged transfer response continues the partial file."""
    given = F.coalesce(content_range, F.lit(""))
    at_start = given.startswith(F.concat(F.lit("bytes "), start.cast("string"), F.lit("-")))
    return (
        F.when((status == 416) & F.coalesce(start >= declared, F.lit(False)), "complete")
        .when((status == 403) & F.lower(F.coalesce(body, F.lit(""))).rlike(EXPIRY_PATTERN), "remint")
        .when((status == 206) & at_start, "append")
        .when((status == 206) & given.startswith("bytes 0-"), "restart")
        .when(status == 206, "discard")
        .when((status == 200) & (start > 0), "restart")
        .when(status == 200, "fresh")
        .otherwise("fail")
    )


def retry_backoff(attempt: Column, kind: str = "transfer") -> Column:
    """Seconds to wait after failed attempt ``n``; NULL once the attempts are used up.

    A transfer may be tried six times, so five waits. An HTTP request is retried five times,
    the first time at once.
    """
    policy = {"transfer": TRANSFER_BACKOFF, "http": HTTP_BACKOFF}[kind]
    wait = F.least(F.lit(policy["cap"]), F.lit(policy["first"]) * F.pow(F.lit(2.0), attempt - 1))
    if kind == "http":
        wait = F.when(attempt == 1, F.lit(0.0)).otherwise(wait)
    return F.when(attempt.between(1, policy["waits"]), wait)


def is_retryable(status: Column) -> Column:
    return status.isin(*HTTP_RETRYABLE)
