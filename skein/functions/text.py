"""Text cleaning as native Column expressions.

Every function takes and returns a Column; null in gives null out. All of them
compile to ``regexp_replace`` / ``split`` / higher-order array functions, so a
whole cleaning chain stays in one whole-stage-codegen projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein import fixed
from skein.functions.tokens import let


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_links(c) -> Column:
    """URLs, ``www`` runs, ``@`` runs and single-line tags removed."""
    return F.regexp_replace(_c(c), fixed.LINK_PATTERN, "")


def strip_emails(c) -> Column:
    """E-mail addresses removed (standalone form)."""
    return F.regexp_replace(_c(c), fixed.EMAIL_PATTERN, "")


def strip_mentions(c) -> Column:
    """``@user`` removed (standalone form)."""
    return F.regexp_replace(_c(c), fixed.MENTION_PATTERN, "")


def strip_user_refs(c) -> Column:
    """C4: ``u/user`` removed."""
    return F.regexp_replace(_c(c), fixed.USER_REF_PATTERN, "")


def strip_parens(c) -> Column:
    """Each parenthesis with its surrounding whitespace becomes one space."""
    c = F.regexp_replace(_c(c), fixed.OPEN_PAREN_PATTERN, " ")
    return F.regexp_replace(c, fixed.CLOSE_PAREN_PATTERN, " ")


def squeeze(c) -> Column:
    """Whitespace runs collapse to one space; ends trimmed."""
    return F.trim(F.regexp_replace(_c(c), fixed.SPACE_RUN_PATTERN, " "))


def clean_text(c) -> Column:
    """C1, C4, C5, C6 in order. The e-mail and ``@user`` steps are omitted
    inside the chain: after C1 no ``@`` followed by a non-space is left, so
    they cannot match (use C2/C3 standalone when they must run first)."""
    return squeeze(strip_parens(strip_user_refs(strip_links(c))))


def slang_pattern(mapping: Mapping[str, str]) -> str:
    """Whole-word alternation of the keys, in dictionary order (first listed
    alternative wins at a position, as in a backtracking regex engine)."""
    return r"(?U)\b(" + "|".join(re.escape(k) for k in mapping) + r")\b"


def slang_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def expand_slang(c, mapping: Mapping[str, str] = fixed.SLANG) -> Column:
    """Single left-to-right pass replacing whole-word slang keys.

    ``regexp_replace`` sets a mark before and after each hit, so that every
    second piece between marks is a hit; the pattern runs over the text once.
    A text that holds the mark itself is cut by ``split`` and its hits come
    from ``regexp_extract_all`` (the one extra piece pairs with a null hit)."""
    pat = slang_pattern(mapping)
    m = slang_map(mapping)
    mark = "\u0001"

    def expansion(hit):
        return F.coalesce(F.try_element_at(m, hit), F.lit(""))

    def expanded(s):
        marked = F.split(F.regexp_replace(s["text"], pat, f"{mark}$1{mark}"), mark, -1)
        by_mark = F.transform(marked, lambda piece, i: F.when(i % 2 == 0, piece).otherwise(expansion(piece)))
        by_split = F.zip_with(F.split(s["text"], pat, -1), F.regexp_extract_all(s["text"], F.lit(pat), 1),
                              lambda piece, hit: F.concat(F.coalesce(piece, F.lit("")), expansion(hit)))
        joined = F.when(F.contains(s["text"], F.lit(mark)), F.array_join(by_split, "")).otherwise(F.array_join(by_mark, ""))
        return F.when(s["text"].isNull(), F.lit(None).cast("string")).otherwise(joined)

    return let(expanded, text=_c(c))   # what ``c`` does (the whole cleaning) is done once a row


def slang_hits(c, mapping: Mapping[str, str] = fixed.SLANG) -> Column:
    """Array of the slang keys found in ``c`` (in text order)."""
    return F.regexp_extract_all(_c(c), F.lit(slang_pattern(mapping)), 1)


def normalise_col(c, mapping: Mapping[str, str] = fixed.SLANG, lower: bool = True) -> Column:
    """C10 (batch order: clean, lower, slang) or C11 (app order, no lower)."""
    x = clean_text(c)
    if lower:
        x = F.lower(x)
    return expand_slang(x, mapping)
