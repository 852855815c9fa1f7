"""Column -> Column helpers; everything here stays inside the JVM."""

from resultlake.functions.dates import parse_clean_date, parse_post_date, post_date_text
from resultlake.functions.text import normalize_text, nullif_empty, strip_text
from resultlake.functions.urls import (
    absolute_url,
    canonical_url,
    finish_more_url,
    form_encode,
    is_malformed_url,
    is_unfetchable_url,
    lb_trigger_url,
    percent_decode,
    percent_encode,
    resolve_url,
    usable_href,
)

__all__ = [
    "absolute_url",
    "canonical_url",
    "finish_more_url",
    "form_encode",
    "is_malformed_url",
    "is_unfetchable_url",
    "lb_trigger_url",
    "normalize_text",
    "nullif_empty",
    "parse_clean_date",
    "parse_post_date",
    "percent_decode",
    "percent_encode",
    "post_date_text",
    "resolve_url",
    "strip_text",
    "usable_href",
]
