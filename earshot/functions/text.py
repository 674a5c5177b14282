"""Text expressions whose rules differ from Spark's built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separators Python's str.strip also removes.
SPACE = r"[\s\x1c-\x1f]"


# The same characters one by one.
SPACE_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode white space (``trim`` removes blanks only).

    The pattern runs only where the first or last character calls for it.
    """
    spaces = F.lit(SPACE_CHARS)
    at_edge = (F.instr(spaces, F.substring(col, 1, 1)) > 0) | (F.instr(spaces, F.substring(col, -1, 1)) > 0)
    stripped = F.regexp_replace(col, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")
    return F.when(at_edge, stripped).otherwise(col)


def is_blank(col: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(strip(col) == "", F.lit(True))


def is_missing(col: Column) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(col == "", F.lit(True))


def title_words(col: Column) -> Column:
    """Upper-case the first character of each alphanumeric run, lower-case the rest."""
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    capitalised = F.transform(
        runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substr(run, F.lit(2)))
    )
    return F.array_join(capitalised, "")


def count_words_by_space(col: Column) -> Column:
    """Number of blanks plus one: the empty string counts one, double blanks count twice."""
    return (F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit(""))) + 1).cast("int")


def sentence_start(col: Column, window: int = 100) -> Column:
    """Drop a leading half sentence.

    Only where the text begins in lower case: cut behind the last sentence end
    within the first ``window`` characters, unless nothing would be left.
    """
    head = F.substring(col, 1, window)
    lead = F.regexp_extract(head, rf"(?Us)\A(.*[.!?]{SPACE}+)", 1)
    rest = strip(F.substr(col, F.length(lead) + 1))
    cut = col.rlike(r"\A\p{IsLowercase}") & (lead != "") & (rest != "")
    return F.when(cut, rest).otherwise(col)
