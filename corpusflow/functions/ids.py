"""F1 doc_id (UUID v5, URL namespace) and F2 point_id (unsigned 64-bit), native expressions.

Both are deterministic functions of their inputs, so re-running an ingest
produces the same keys and the sinks upsert instead of duplicating (T5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import NAMESPACE_URL_HEX


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doc_id(source: Column | str) -> Column:
    """UUID v5 of ``source`` in the URL namespace, as lower-case text.

    sha1(namespace bytes || utf-8 name); the 13th hex digit becomes the
    version ``5`` and the 17th gets the RFC 4122 variant bits (8, 9, a or b).
    """
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL_HEX)), F.encode(_c(source), "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-"),
        F.lit("5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def point_id(doc: Column | str, chunk: Column | str) -> Column:
    """First 16 hex digits of sha256("doc_id:chunk_id") as an unsigned integer.

    Values go up to 2^64-1, past ``LongType``; ``conv`` reads the hex digits as
    unsigned and the result is kept as ``decimal(20,0)``.
    """
    digest = F.sha2(F.concat(_c(doc), F.lit(":"), _c(chunk).cast("string")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
