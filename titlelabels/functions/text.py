"""SQL expressions over titles.

The large expressions of this package are built as SQL text and handed to Spark
as a whole: one call instead of thousands of single Column calls, which took
seconds per query. Arguments and results named ``title``, ``rules`` and so on
are SQL expressions, mostly column names.
"""

from __future__ import annotations

# Fixed value: white space in the sense of a Unicode strip, the separators U+001C to U+001F included.
NON_BLANK = r"(?U)[^\s\x1c-\x1f]"

# The only upper-case characters that equal an ASCII letter when case is ignored:
# the Kelvin sign and the dotted capital I.
FOLD_FROM, FOLD_TO = "Kİ", "KI"


def literal(value: str) -> str:
    """SQL literal of a string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pattern_literal(pattern: str) -> str:
    """SQL literal of a pattern, as a raw string."""
    return "r'" + pattern.replace("\\'", "\\x27").replace("'", "\\x27") + "'"


def is_blank(title: str) -> str:
    """True for null, empty and white-space-only titles; never null."""
    return f"(NOT coalesce({title} RLIKE {pattern_literal(NON_BLANK)}, false))"


def upper_title(title: str) -> str:
    return f"upper({title})"


def fold_title(title: str) -> str:
    """Upper-cased title on which a case-sensitive search equals a case-insensitive one."""
    return f"translate(upper({title}), '{FOLD_FROM}', '{FOLD_TO}')"


def let(name: str, value: str, body: str) -> str:
    """Bind ``value`` to a name once and use it several times in ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"
