"""Patterns of secrets and personal data, in Java's syntax.

They must equal those of the pipeline whose results are matched. ``(?U)`` makes classes and word boundaries Unicode-aware.
"""

REDACTED = "[REDACTED]"

# name, pattern
SECRETS = (
    ("private_key_block", r"(?s)-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----.*?-----END [A-Z0-9 ]*PRIVATE KEY-----"),
    ("jwt", r"(?U)\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\b"),
    ("openai_key", r"(?U)\bsk-[A-Za-z0-9-]{10,}\b"),
    ("slack_token", r"(?U)\bxox[baprs]-[A-Za-z0-9-]{10,}\b"),
    ("aws_access_key_id", r"(?U)\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("github_token", r"(?U)\b(?:ghp_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{20,})\b"),
    ("google_api_key", r"(?U)\bAIza[0-9A-Za-z_-]{35}\b"),
)
BEARER = r"(?Ui)\bAuthorization\s*:\s*Bearer\s+([A-Za-z0-9\-._~+/]+=*)"
BEARER_SCAN = r"(?Ui)\bAuthorization\s*:\s*Bearer\s+(?!\[REDACTED\])[A-Za-z0-9\-._~+/]+=*"
KEY_VALUE = r"(?Ui)\b(api[-_]?key|access[-_]?token|refresh[-_]?token|token|secret|password|passwd|pwd)\b(\s*[:=]\s*)([^\s'\"\\]+)"
EMAIL = r"(?Ui)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PHONE = r"(?U)(?<!\w)(\+?\d[\d \-()]{8,}\d)(?!\w)"
HIGH_ENTROPY = r"\A[A-Za-z0-9+/_\-=]{20,}\z"
#: Python's blanks.
BLANKS = r"(?U)[\s\u001c-\u001f]"
