from tripsense.functions.features import (
    FEATURE_COLUMNS,
    fill_missing,
    feature_aggregates,
    trip_features,
    with_magnitudes,
)
from tripsense.functions.scalars import normalise_columns, round_doubles, split_bucket, trip_status

__all__ = [
    "FEATURE_COLUMNS",
    "feature_aggregates",
    "fill_missing",
    "normalise_columns",
    "round_doubles",
    "split_bucket",
    "trip_features",
    "trip_status",
    "with_magnitudes",
]
