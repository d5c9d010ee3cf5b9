"""Scalar column expressions (built-in Spark SQL only, no Python UDFs)."""

from postcluster.functions.geometry import squared_distance, squared_distance_py, with_nearest_center
from postcluster.functions.language import (
    first_language_index,
    int_div,
    language_array,
    language_label,
)
from postcluster.functions.parsing import (
    empty_to_null,
    field,
    is_optional_int,
    is_strict_int,
    split_fields,
    tags_field,
)

__all__ = [
    "empty_to_null",
    "field",
    "first_language_index",
    "int_div",
    "is_optional_int",
    "is_strict_int",
    "language_array",
    "language_label",
    "split_fields",
    "squared_distance",
    "squared_distance_py",
    "tags_field",
    "with_nearest_center",
]
