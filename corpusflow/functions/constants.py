"""Fixed values that must equal the behaviour being reproduced.

Everything here is data, stated plainly; the logic that uses it lives in the
other modules.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay exactly as they are for matching results)
# ---------------------------------------------------------------------------

# Supported file suffixes, compared lower-cased.
TEXT_SUFFIXES = (".md", ".txt", ".adoc", ".rst")
HTML_SUFFIXES = (".html", ".htm")
BINARY_SUFFIXES = (".pdf", ".docx", ".pptx", ".xlsx")
ALL_SUFFIXES = TEXT_SUFFIXES + HTML_SUFFIXES + BINARY_SUFFIXES

# Cloud-native document types -> (export MIME type, file extension).
EXPORT_MAP = (
    ("application/vnd.google-apps.document", "application/pdf", ".pdf"),
    (
        "application/vnd.google-apps.spreadsheet",
        "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
        ".xlsx",
    ),
    (
        "application/vnd.google-apps.presentation",
        "application/vnd.openxmlformats-officedocument.presentationml.presentation",
        ".pptx",
    ),
)

# HTML tags whose text is skipped (non-nested flag, see functions/html.py).
HTML_SKIP_TAGS = ("script", "style", "nav", "header", "footer")

# Recursive splitter: separators in priority order, default size and overlap.
CHUNK_SEPARATORS = ("\n\n", "\n", ". ", " ", "")
CHUNK_SIZE = 1024
CHUNK_OVERLAP = 128

# UUID v5 namespace for URLs (RFC 4122, appendix C), as hex.
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"

# Characters Python's str.strip()/str.isspace() treat as whitespace.
PY_WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Ingest-duration histogram upper bounds in seconds (+Inf is implicit).
DURATION_BUCKETS = (1, 5, 10, 30, 60, 120, 300, 600)

# Metric names.
METRIC_DOCUMENTS = "documents_ingested_total"
METRIC_CHUNKS = "chunks_created_total"
METRIC_DURATION = "ingest_duration_seconds"
METRIC_EMBED_REQUESTS = "embed_requests_total"
METRIC_EMBED_ERRORS = "embed_errors_total"
METRIC_LAST_INGEST = "last_ingest_timestamp_seconds"
METRIC_SKIPPED = "documents_skipped_total"

# Defaults of the ingest job.
DEFAULT_COLLECTION = "documents"
EMBED_BATCH = 64
UPSERT_BATCH = 100
DEFAULT_GLOB = "**/*"

# ---------------------------------------------------------------------------
# Derived (not fixed): regex character class for the whitespace above, in a
# form both Java regex and RE2 accept.
# ---------------------------------------------------------------------------


def _regex_class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


WS_CLASS = _regex_class(PY_WHITESPACE)
