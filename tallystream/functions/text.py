"""Text expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystream import fixed_values as fixed


def strip_part(text: Column) -> Column:
    """Remove white space at both ends, Unicode spaces and the separators 0x1c-0x1f included."""
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def strip(text: Column) -> Column:
    """The same for texts that may be long.

    Spark finds the end of a text by measuring each of its characters, which costs more than all other
    steps of a clean-up; looking at the last character first saves that for texts without such an end.
    """
    ends = reduce(or_, [F.endswith(text, F.lit(space)) for space in fixed.WHITESPACE])
    return F.when(ends, strip_part(text)).otherwise(F.ltrim(text, F.lit(fixed.WHITESPACE)))


def replace_literal(text: Column, search: str, replacement: str) -> Column:
    """Replace every occurrence of a plain string; case counts, and no pattern syntax applies."""
    return F.replace(text, F.lit(search), F.lit(replacement))


def truncated_cell(value: Column, width: int = fixed.PREVIEW_WIDTH) -> Column:
    """The text a table preview shows for a value: control characters spelled out, long text cut."""
    text = F.coalesce(value.cast("string"), F.lit("NULL"))
    for raw, shown in [("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\f", "\\f"),
                       ("\b", "\\b"), ("\x0b", "\\v"), ("\x07", "\\a")]:
        text = replace_literal(text, raw, shown)
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(text)


#: Characters that take two places in a shell.
_WIDE = "[\u1100-\u115f\u2e80-\ua4cf\uac00-\ud7a3\uf900-\ufaff\ufe30-\ufe4f\uff00-\uff60\uffe0-\uffe6]"


def shown_width(value: Column) -> Column:
    """How many places a text takes in a shell."""
    return F.length(value) + F.regexp_count(value, F.lit(_WIDE))


def short_id(key: Column, prefix: str = fixed.VEHICLE_PREFIX, digits: int = fixed.VEHICLE_DIGITS) -> Column:
    """A short readable identifier derived from a key.

    Two keys can share one, so it is a label to show and not a key to join or group on.
    """
    return F.concat(F.lit(prefix), F.substring(F.md5(key.cast("string")), 1, digits))
