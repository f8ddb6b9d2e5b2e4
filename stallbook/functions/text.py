"""Text expressions for reports and encoding checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"


def utf8_hex(text: Column | str) -> Column:
    """Lower-case hex of the UTF-8 bytes."""
    return F.lower(F.hex(F.encode(text, "UTF-8")))


def has_byte_order_mark(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return text.startswith(BYTE_ORDER_MARK)


def report_line(check: Column | str, subject: Column | str,
                expected: Column | str, actual: Column | str) -> Column:
    """One readable line per check, shorter subjects padded to a common width."""
    subject = F.col(subject) if isinstance(subject, str) else subject
    width = F.greatest(F.length(subject), F.lit(48))  # rpad would cut a longer one
    return F.format_string("%s %s expected %s, got %d",
                           check, F.rpad(subject, width, F.lit(" ")), expected, actual)
