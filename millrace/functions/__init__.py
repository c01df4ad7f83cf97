"""Column-level building blocks (built-in expressions only)."""

from millrace.functions.codes import lookup
from millrace.functions.text import bytes_to_text, strip_whitespace

__all__ = ["bytes_to_text", "lookup", "strip_whitespace"]
