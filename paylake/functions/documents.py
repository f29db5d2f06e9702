"""JSON held in text columns, read through Spark's variant type."""

from __future__ import annotations


def json_string(document: str, key: str) -> str:
    """The value of ``key`` if it is a JSON string, else NULL.

    ``document`` is a variant, so a text is parsed once however many keys are
    read.  Numbers, booleans, objects and JSON null all give NULL.
    """
    return (
        f"CASE WHEN schema_of_variant(try_variant_get({document}, '$.{key}', 'variant')) = 'STRING' "
        f"THEN try_variant_get({document}, '$.{key}', 'string') END"
    )


def document_text(document: str) -> str:
    """A parsed document as the text a document store hands back.

    Unreadable text (a NULL document) and JSON null give NULL, objects and arrays
    come back as JSON with non-ASCII characters kept, scalars as plain text.
    """
    return (
        f"CASE schema_of_variant({document}) "
        "WHEN 'VOID' THEN NULL "
        f"WHEN 'STRING' THEN try_variant_get({document}, '$', 'string') "
        f"WHEN 'BOOLEAN' THEN initcap(to_json({document})) "
        f"ELSE to_json({document}) END"
    )
