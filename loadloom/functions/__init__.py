"""Column functions: everything here is a native expression."""

from loadloom.functions.scalars import (
    absolute_error,
    digest_parity,
    fill,
    indicators,
    product,
    scaled,
    standardise,
    text_digest,
    whole,
)
from loadloom.functions.timeparts import (
    calendar_parts,
    epoch_key,
    load_stamp,
    parse_time,
    step_after,
    utc_now,
)

__all__ = [
    "absolute_error",
    "calendar_parts",
    "digest_parity",
    "epoch_key",
    "fill",
    "indicators",
    "load_stamp",
    "parse_time",
    "product",
    "scaled",
    "standardise",
    "step_after",
    "text_digest",
    "utc_now",
    "whole",
]
