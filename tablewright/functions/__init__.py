"""Column expressions shared by the operators."""

from tablewright.functions.scalar import (
    hash_bucket,
    parse_number,
    rounded,
    sigmoid,
    strip_dots,
    stable_id,
    tokens,
    vector_element,
)

__all__ = [
    "hash_bucket",
    "parse_number",
    "rounded",
    "sigmoid",
    "stable_id",
    "strip_dots",
    "tokens",
    "vector_element",
]
