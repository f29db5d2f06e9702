"""Column expressions as SQL text, built from Spark's own functions.

Each function takes SQL expressions (usually column names) and gives one back, to
be used in ``selectExpr``, ``F.expr`` or inside another.  A plan is then put
together with few calls from Python to the JVM, however long its expressions are.
"""

from paylake.functions.documents import document_text, json_string
from paylake.functions.keys import merchant_fingerprint, row_digest, surrogate_key
from paylake.functions.measures import percentage, seconds_between
from paylake.functions.parsing import blank_to_null, iso_seconds, parse_timestamp, parse_uint

__all__ = [
    "blank_to_null",
    "document_text",
    "iso_seconds",
    "json_string",
    "merchant_fingerprint",
    "parse_timestamp",
    "parse_uint",
    "percentage",
    "row_digest",
    "seconds_between",
    "surrogate_key",
]
