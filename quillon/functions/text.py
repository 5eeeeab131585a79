"""Scalar text functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_PLAIN = "".join(chr(0x21 + i) for i in range(94)) + " "
HAN = "㐀-鿿"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def narrow(text: Column) -> Column:
    """Full-width ASCII forms and the wide space in their usual form."""
    return F.translate(text, _WIDE, _PLAIN)


def fold_lower(text: Column) -> Column:
    """Narrow, lower case, trimmed: the folding of the lexical channel."""
    return F.trim(F.lower(narrow(text)))


def fold_case(text: Column) -> Column:
    """Narrow, case-folded (sharp s as ss), trimmed: the folding of names."""
    return F.trim(F.replace(F.lower(narrow(text)), F.lit("ß"), F.lit("ss")))


def distinct_tokens(text: Column) -> Column:
    """Sorted distinct Latin-digit words and maximal runs of ideographs."""
    return F.array_sort(F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0)), F.regexp_extract_all(text, F.lit(f"[{HAN}]+"), F.lit(0)))))


def query_terms(query: str) -> list[str]:
    """Sorted distinct search terms of a query: words, and pairs of neighbouring ideographs over all of them."""
    low = query.lower()
    han = "".join(re.findall(f"[{HAN}]", low))
    pairs = [han] if len(han) == 1 else [han[i : i + 2] for i in range(len(han) - 1)]
    return sorted({*re.findall("[a-z0-9]+", low), *pairs})


def grams(text: Column, low: int, high: int) -> Column:
    """All character n-grams of ``low`` to ``high`` with some non-blank character, blanks collapsed first."""

    def of(t: Column, n: int) -> Column:
        places = F.sequence(F.lit(1), F.length(t) - n + 1)
        return F.when(F.length(t) >= n, F.transform(places, lambda i: F.substring(t, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    every = lambda t: F.filter(F.concat(*[of(t, n) for n in range(low, high + 1)]), lambda g: F.trim(g) != "")
    return F.when(text.isNotNull(), let(F.regexp_replace(text, r"\s+", " "), every))


def match_key(text: Column) -> Column:
    """A key that ignores blanks, escapes and mark-up signs."""
    return F.regexp_replace(narrow(text), r"[\\\s(){}\[\]_$^`~]", "")


def unit_key(text: Column) -> Column:
    """A unit in lower case without blanks, the micro sign as u."""
    return F.translate(F.regexp_replace(F.lower(narrow(text)), r"\s", ""), "μµ", "uu")


def normalized_newlines(text: Column) -> Column:
    """LF only, exactly one at the end."""
    return F.concat(F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), "\n+$", ""), F.lit("\n"))


def line_at(text: Column, offset: Column) -> Column:
    """Number of the line in which an offset (from 0) lies, from 1."""
    head = F.substring(text, F.lit(1), offset)
    return 1 + F.length(head) - F.length(F.replace(head, F.lit("\n")))


def first_sentence(text: Column) -> Column:
    """The text up to and with its first sentence end."""
    return F.trim(F.element_at(F.split(F.trim(text), r"(?<=[。！？.!?])\s*", 2), 1))


def padded_numbers(text: Column) -> Column:
    """A key whose order is natural: digits are padded to 12 places, the rest is in lower case."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "([0-9]+)", "000000000000$1"), "0*([0-9]{12})(?![0-9])", "$1")


def overlapping_count(text: Column, part: Column) -> Column:
    """Number of places at which ``part`` stands, overlapping ones too; 0 for an empty part."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.length(part)) == part)
    return F.when(F.length(part) > 0, F.size(places)).otherwise(0)


def disjoint_count(text: Column, part: Column) -> Column:
    """Number of places at which ``part`` stands without overlap."""
    return F.when(F.length(part) > 0, ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")).otherwise(0)
