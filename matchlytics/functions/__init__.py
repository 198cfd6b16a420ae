from matchlytics.functions.clean import (
    classify_in,
    classify_like,
    clock_seconds,
    date_key,
    null_outside,
    short_name,
    to_decimal,
    year_bucket,
)
from matchlytics.functions.metrics import match_result, padj, per90, rate, safe_sum
from matchlytics.functions.nested import coalesce_leaf, field, first_point, has_field, hash_key, id_from_path, optional_col
from matchlytics.functions.pitch import in_rect, pitch_zone

__all__ = [
    "classify_in",
    "classify_like",
    "clock_seconds",
    "coalesce_leaf",
    "date_key",
    "field",
    "first_point",
    "has_field",
    "hash_key",
    "id_from_path",
    "in_rect",
    "match_result",
    "null_outside",
    "optional_col",
    "padj",
    "per90",
    "pitch_zone",
    "rate",
    "safe_sum",
    "short_name",
    "to_decimal",
    "year_bucket",
]
