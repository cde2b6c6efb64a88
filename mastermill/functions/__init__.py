"""Scalar expressions."""

from .keys import (
    business_key,
    canonical_text,
    category_ladder,
    checksum,
    code_prefix,
    file_code,
    file_date,
    key_text,
    row_fingerprint,
    row_text,
    with_fingerprint,
)

__all__ = [
    "business_key",
    "canonical_text",
    "category_ladder",
    "checksum",
    "code_prefix",
    "file_code",
    "file_date",
    "key_text",
    "row_fingerprint",
    "row_text",
    "with_fingerprint",
]
