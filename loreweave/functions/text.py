"""Small string helpers shared by the text jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the input format defines it: Unicode space plus the four
# ASCII separators that Java's class leaves out; as a pattern and as a list.
SPACE = r"[\s\x1c-\x1f]"
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends; looks at the ends only."""
    return F.btrim(c, F.lit(_SPACES))


def last_position(text: Column, marker: str) -> Column:
    """1-based start of the last occurrence of ``marker``, 0 if there is none."""
    back = F.instr(F.reverse(text), marker[::-1])
    return F.when(back > 0, F.length(text) - back - len(marker) + 2).otherwise(0)
