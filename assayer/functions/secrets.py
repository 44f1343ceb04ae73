"""Credentials, private hosts and endpoints in texts, as columns. No pattern looks around, so other engines read the same ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public shapes of credentials.
TOKENS = (
    ("aws_key", r"\bAKIA[0-9A-Z]{16}\b"),
    ("github_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack_token", r"\bxox[baprs]-[A-Za-z0-9-]{10,}"),
    ("secret_key", r"\bsk-[A-Za-z0-9]{20,}"),
    ("hub_token", r"\bhf_[A-Za-z0-9]{30,}"),
    ("private_key", r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----"),
    ("authorization", r"(?i)\bauthorization:\s*(bearer|basic)\s+\S{8,}"),
    ("url_login", r"[A-Za-z][A-Za-z0-9+.-]*://[^\s:/@]+:[^\s@/]+@"),
)
ASSIGNED = r"(?i)\b(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|token|password|passwd|pwd)[\"']?\s*[:=]\s*[\"']?([^\s\"'`,;)\]}]{20,})"
NO_VALUE = r"(?i)^(\$|secrets\.|<)|(^|[-_.])(changeme|your|example|redacted|dummy|fake|placeholder|sample|todo)([-_.]|$)|x{8,}|0{8,}"
ADDRESS = r"\b(?:10(?:\.\d{1,3}){3}|192\.168(?:\.\d{1,3}){2}|172\.(?:1[6-9]|2\d|3[01])(?:\.\d{1,3}){2}|100\.(?:6[4-9]|[7-9]\d|1[01]\d|12[0-7])(?:\.\d{1,3}){2}|169\.254(?:\.\d{1,3}){2}|198\.1[89](?:\.\d{1,3}){2})\b"
NAME = r"(?i)\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:local|lan|internal|home)\b"
ENDPOINT = r"(?i)\"(?:base[_-]?url|endpoint|url|host)\"\s*:\s*\"https?://([^/\":]+)"
OPEN_HOSTS = ("localhost", "127.0.0.1", "0.0.0.0", "::1")
KEY_BLOCK = r"(?s)-----BEGIN ([A-Z]+ )?PRIVATE KEY-----.*?-----END ([A-Z]+ )?PRIVATE KEY-----"
FIELD = r"(?i)\"(api_?key|token|secret|password)\"\s*:\s*\"[^\"]{8,}\""
FLAG = r"--(api-key|token)(=|\s+)\S{8,}"
# In this order; each rule sees what the earlier ones left.
REDACTED = (("key_block", KEY_BLOCK), ("secret_field", FIELD), ("flag", FLAG), *TOKENS)


def assigned_secrets(t: Column) -> Column:
    """Values of 20 or more characters given to a secret-like name, placeholders left out."""
    return F.filter(F.regexp_extract_all(t, F.lit(ASSIGNED), F.lit(1)), lambda v: ~v.rlike(NO_VALUE))


def credentials(t: Column) -> Column:
    """Names of the shapes found, in order."""
    named = [F.when(t.rlike(p), F.lit(name)) for name, p in TOKENS]
    return F.array_compact(F.array(*named, F.when(F.size(assigned_secrets(t)) > 0, F.lit("assignment"))))


def private_hosts(t: Column) -> Column:
    """Private and carrier addresses (loopback and documentation nets are none) and names of private suffixes."""
    return F.concat(F.regexp_extract_all(t, F.lit(ADDRESS), F.lit(0)), F.regexp_extract_all(t, F.lit(NAME), F.lit(0)))


def endpoints(t: Column) -> Column:
    """Hosts of http addresses under url-like keys that are not this machine."""
    return F.filter(F.regexp_extract_all(t, F.lit(ENDPOINT), F.lit(1)), lambda h: ~h.isin(*OPEN_HOSTS))


def redact_secrets(t: Column) -> Column:
    for name, p in REDACTED:
        t = F.regexp_replace(t, p, f"<{name}>")
    return t
