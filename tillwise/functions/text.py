"""Text normalisation with built-in expressions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise.model import PROVINCES

# Fixed value: the characters Unicode counts as white space.
_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_WORD_OR_GAP = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE))


def title_case(c: Column) -> Column:
    """A capital after every non-letter: ``o'brien mary-ann`` -> ``O'Brien Mary-Ann``."""
    runs = F.regexp_extract_all(c, F.lit(_WORD_OR_GAP), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def normalize_text(c: Column | str, title: bool = False, upper: bool = False) -> Column:
    """Strip, change case, and turn blank or stringified-missing text into NULL."""
    out = strip((F.col(c) if isinstance(c, str) else c).cast("string"))
    if title:
        out = title_case(out)
    if upper:
        out = F.upper(out)
    return F.when(out.isin("", "Nan", "NAN"), None).otherwise(out)


def normalize_province(c: Column | str, names: Mapping[str, str] = PROVINCES) -> Column:
    """Province code or name to its full name; anything else is NULL."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    key = F.lower(strip((F.col(c) if isinstance(c, str) else c).cast("string")))
    return F.try_element_at(lookup, key)


def full_match(c: Column | str, pattern: str) -> Column:
    """Whole-string match; ``$`` would also accept a trailing newline."""
    return F.regexp_like(F.col(c) if isinstance(c, str) else c, F.lit(rf"\A(?:{pattern})\z"))
