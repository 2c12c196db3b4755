"""Text helpers: missing-value tokens, stripping, title case, spelling maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskmart.schemas import NA_TOKENS, PRIORITY_SPELLINGS, STATUS_SPELLINGS

# Every character that counts as white space at the ends of a text cell.
WHITESPACE = "".join(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

_CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"
# A letter that starts a word inside a blank-separated one: after a quote, digit, slash, tab ...
_INNER_START = rf"(?<=[^ \p{{Lu}}\p{{Ll}}\p{{Lt}}])(?={_CASED})"
# Fixed value: a Unicode noncharacter and a blank; marks an inner word start for ``initcap``.
_BREAK = "\ufdd0 "


def quoted(values: Iterable[str]) -> str:
    """SQL list of string literals. Long literal lists are cheaper to build as one SQL text than
    as one driver call per literal."""
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


_NA_LIST = quoted(NA_TOKENS)


def present(column: str) -> Column:
    """A1: true unless the cell spells "missing" (compared before any trimming)."""
    return F.expr(f"`{column}` not in ({_NA_LIST})")


def strip(value: Column) -> Column:
    """Cut white space of any kind at both ends.

    Cells that begin and end with a visible ASCII character (byte order tells) are left alone
    without searching the character list.
    """
    begins = (value >= "!") & (value < "\x7f")
    ends = F.right(value, F.lit(1)).between("!", "~")
    return F.when(begins & ends, value).otherwise(F.btrim(value, F.lit(WHITESPACE)))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def title_case(value: Column) -> Column:
    """Capital after every non-letter, lower case elsewhere (``o'neil p1x`` -> ``O'Neil P1X``).

    ``initcap`` breaks words at blanks only, so inner word starts get a temporary blank.
    """
    broken = F.regexp_replace(value, _INNER_START, _BREAK)
    return F.replace(F.initcap(broken), F.lit(_BREAK), F.lit(""))


def tidy_label(value: Column) -> Column:
    """Title case of stripped text; blank means missing."""
    return title_case(blank_to_null(value))


def _canonical_spelling(value: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    pairs = quoted(x for name, variants in spellings.items() for s in variants for x in (s, name))
    lookup = F.expr(f"map({pairs})")
    known = F.try_element_at(lookup, F.lower(value))
    return F.coalesce(known, tidy_label(value))


def tidy_priority(value: Column) -> Column:
    """Known spellings become one of four levels; others pass through title-cased."""
    return _canonical_spelling(value, PRIORITY_SPELLINGS)


def tidy_status(value: Column) -> Column:
    """Known spellings become one of four states; others pass through title-cased."""
    return _canonical_spelling(value, STATUS_SPELLINGS)
