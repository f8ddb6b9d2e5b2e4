"""Would this text survive a cast? Asked without raising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A bare year is a timestamp to Spark but not to a strict reader, so dates and
# timestamps must also look like one.
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_SHAPES = {
    "date": rf"^\s*{_DAY}([ T].*)?\s*$",
    "timestamp_ntz": rf"^\s*{_DAY}([ T]\d{{1,2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?)?\s*$",
}


def is_valid(text: Column | str, type_name: str) -> Column:
    """True when ``text`` casts to ``type_name``; NULL for NULL text."""
    text = F.col(text) if isinstance(text, str) else text
    parses = text.try_cast(type_name).isNotNull()
    if type_name in _SHAPES:
        parses = parses & text.rlike(_SHAPES[type_name])
    return F.when(text.isNotNull(), parses)
