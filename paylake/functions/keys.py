"""Surrogate keys: MD5 digests, or deterministic 60-bit numbers taken from them.

Any engine with MD5 can recompute them.  Sixty bits make clashes among a few
hundred million merchants unlikely but not among 10^11 transactions; these have
the whole digest.  Tables are merged on their natural keys in any case.
"""

from __future__ import annotations

SEPARATOR = "|"
DIGEST_DIGITS = 15


def row_digest(*parts: str) -> str:
    """128 bits as hex; NULL parts count as empty text, parts are kept apart by a separator."""
    texts = ", ".join(f"coalesce(cast({part} AS string), '')" for part in parts)
    return f"md5(concat_ws('{SEPARATOR}', {texts}))"


def surrogate_key(*parts: str) -> str:
    """The first 60 bits of the digest as a number."""
    return f"cast(conv(substring({row_digest(*parts)}, 1, {DIGEST_DIGITS}), 16, 10) AS bigint)"


def merchant_fingerprint() -> str:
    """Changes whenever any described attribute of a silver merchant changes."""
    return surrogate_key(
        "merchant_id", "acquirer_id", "merchant_name", "state", "created_at", "updated_at"
    )
