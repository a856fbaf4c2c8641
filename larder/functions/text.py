"""String expressions: keys, list-in-text parsing, step formatting, search tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.constants import NO_STEPS

# The characters Unicode text processing counts as white space, the four ASCII
# separators U+001C..U+001F included (a bare \s in a Java pattern knows only six of these).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as ranges of a Java character class.
WHITESPACE_CLASS = (
    r" \t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)

STRINGS = "array<string>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_strings() -> Column:
    return F.array().cast(STRINGS)


def strip(c: Column | str) -> Column:
    """Remove white space of every kind from both ends (``trim`` removes blanks only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def title_key(c: Column | str) -> Column:
    """Join key of a title: ASCII letters, digits and inner white space, lower-cased; null gives ''.

    It joins the runs to keep instead of replacing a negated class: the JDK matches negated classes
    several times slower, and the threads of one executor slow each other down on them.
    """
    kept = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(f"[a-zA-Z0-9{WHITESPACE_CLASS}]+"), F.lit(0))
    return strip(F.lower(F.array_join(kept, "")))


def field_texts(records: Column | str, field: str = "text") -> Column:
    """One string field out of an array of structs; a missing field is '' and a missing array is []."""
    texts = F.transform(_col(records), lambda r: F.coalesce(r[field], F.lit("")))
    return F.coalesce(texts, no_strings())


def joined_texts(records: Column | str, field: str = "text", sep: str = " | ") -> Column:
    """The texts of an array of structs as one string; missing texts stay as empty segments."""
    return F.array_join(field_texts(records, field), sep)


def listed_items(c: Column | str) -> Column:
    """Items of a list printed as text, such as ``"['a', 'b']"``. Brackets and quotes go before the split."""
    bare = F.translate(F.coalesce(_col(c), F.lit("")), "[]'\"", "")
    return F.filter(F.transform(F.split(bare, ","), strip), lambda item: item != "")


def json_strings(c: Column | str) -> Column:
    """A JSON array held in a string column; malformed or empty text gives null."""
    return F.from_json(_col(c), STRINGS)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def clean_item(c: Column | str) -> Column:
    """Index form of an item: blanks trimmed, lower case."""
    return F.lower(F.trim(_col(c)))


def numbered_steps(c: Column | str, empty: str = NO_STEPS) -> Column:
    """Numbered steps of a text delimited by ``|``, or by line when it holds no ``|``."""
    c = _col(c)
    parts = F.when(c.contains("|"), F.split(c, "[|]")).otherwise(F.split(c, "\n"))
    steps = F.filter(F.transform(parts, strip), lambda s: s != "")
    numbered = F.transform(steps, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s))
    return F.when(F.size(steps) > 0, numbered).otherwise(F.array(F.lit(empty)))


# Accented Latin-1 letters and their plain forms, position by position.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def fold(c: Column | str) -> Column:
    """Lower case without Latin-1 accents."""
    return F.translate(F.lower(_col(c)), ACCENTED, PLAIN)


def words(c: Column | str, pattern: str = "[a-z0-9]+") -> Column:
    """Search tokens of a text, in order; null text has none.

    ``pattern='[a-z]+'`` leaves digits out.
    """
    return F.coalesce(F.regexp_extract_all(fold(c), F.lit(pattern), F.lit(0)), no_strings())


def plural_stem(c: Column | str) -> Column:
    """English S-stemmer after Harman (1991): ies -> y, other s -> nothing; us, ss and short words stay."""
    c = _col(c)
    stays = ~c.endswith("s") | c.endswith("us") | c.endswith("ss") | (F.length(c) < 3)
    to_y = c.endswith("ies") & ~(c.endswith("aies") | c.endswith("eies")) & (F.length(c) > 3)
    return (
        F.when(stays, c)
        .when(to_y, F.concat(F.substring(c, F.lit(1), F.length(c) - 3), F.lit("y")))
        .otherwise(F.substring(c, F.lit(1), F.length(c) - 1))
    )


STEMMERS: dict[str, Callable[[Column], Column]] = {"english": plural_stem, "none": lambda c: c}
