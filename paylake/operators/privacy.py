"""Pseudonyms for the limited views, as SQL text.  They curate what is shown; they
are no access control."""

from __future__ import annotations

# Pseudonyms, and the upper bounds of the volume classes.
METHOD_PSEUDONYMS = {"Visa": "Payment_Method_A", "Mastercard": "Payment_Method_B"}
OTHER_METHOD = "Other_Method"
PROVIDER_PREFIX = "Provider_"
PROVIDER_DIGITS = 6
VOLUME_CLASSES = [(10, "Low_Volume"), (100, "Medium_Volume")]
LARGEST_VOLUME = "High_Volume"


def masked_method(name: str) -> str:
    cases = " ".join(f"WHEN '{known}' THEN '{mask}'" for known, mask in METHOD_PSEUDONYMS.items())
    return f"CASE {name} {cases} ELSE '{OTHER_METHOD}' END"


def masked_provider(name: str) -> str:
    """Prefix and six hex digits of the name's hash; NULL for a NULL name.

    Six digits are 24 bits, so with thousands of merchants some share a pseudonym
    and are then reported as one.
    """
    return f"concat('{PROVIDER_PREFIX}', upper(substring(sha2({name}, 256), 1, {PROVIDER_DIGITS})))"


def volume_class(count: str) -> str:
    cases = " ".join(f"WHEN {count} < {bound} THEN '{name}'" for bound, name in VOLUME_CLASSES)
    return f"CASE {cases} ELSE '{LARGEST_VOLUME}' END"
