"""Access-log format.

FIXED VALUES: these must equal the behaviour being matched, so they are
stated here plainly and in their natural order.
"""

# --- fixed values -----------------------------------------------------------
# Combined access-log line: address (IPv4 or IPv6), user, [time], "method
# uri version", status, bytes, "referer", "user agent", optional gzip ratio.
LOG_PATTERN = (
    r'^((?:\d{1,3}\.){3}\d{1,3}|[0-9a-fA-F:]+) - (-|[^\s]+) \[([^\]]+)\] '
    r'\"([A-Z]+) ([^ ]+) (HTTP/\d\.\d)\" (\d{3}) (\d+) \"([^\"]*)\" '
    r'\"([^\"]*)\"(?:\s+(\d+))?'
)

# Names of the pattern's eleven groups, in group order.
LOG_FIELDS = [
    "remote_addr",
    "remote_usr",
    "date_time",
    "req_method",
    "req_uri",
    "http_ver",
    "status",
    "body_bytes_sent",
    "http_referer",
    "user_agent",
    "gzip_ratio",
]

# Time layout of the bracketed field, e.g. 10/Oct/2024:13:55:36 +0000.
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Default list of registered (known) referer domains.
REGISTERED_DOMAINS = ["a.com", "b.com", "c.com"]

# Referer host reported when the referer is missing, blank or "-".
UNKNOWN_DOMAIN = "Unknown"
# ---------------------------------------------------------------------------
