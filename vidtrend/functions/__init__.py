"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from vidtrend.functions.text import java_trim, parse_int, parse_long, text_or_empty
from vidtrend.functions.identity import (
    identity, is_placeholder, payload_token, report_id, report_title,
)

__all__ = [
    "java_trim", "parse_int", "parse_long", "text_or_empty",
    "identity", "is_placeholder", "payload_token", "report_id", "report_title",
]
