"""Suffix-stripping stemmer (Porter, 1980) as tables of rules, with the vowel classes the vocabulary files were made with."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Letter classes, and suffixes with what replaces them.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_SOME = re.compile(f"^({_C})?{_V}{_C}")  # a vowel-consonant sequence
_ONE = re.compile(f"^({_C})?{_V}{_C}({_V})?$")
_TWO = re.compile(f"^({_C})?{_V}{_C}{_V}{_C}")
_VOWEL = re.compile(f"^({_C})?[aeiouy]")
_SHORT = re.compile(f"^{_C}[aeiouy][^aeiouwxy]$")
_DERIVED = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
_FORMED = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_DROPPED = dict.fromkeys(("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize"), "")


def _longest(word: str, table: dict[str, str]) -> tuple[str, str] | None:
    """(what is before, suffix) for the longest suffix of the table that leaves something."""
    for n in range(min(7, len(word) - 1), 0, -1):
        if word[-n:] in table:
            return word[:-n], word[-n:]
    return None


def _swap(word: str, table: dict[str, str], condition: re.Pattern) -> str:
    hit = _longest(word, table)
    return hit[0] + table[hit[1]] if hit and condition.search(hit[0]) else word


def _plural(word: str) -> str:
    if word.endswith(("sses", "ies")) and len(word) > (4 if word.endswith("sses") else 3):
        return word[:-2]
    return word[:-1] if len(word) > 2 and word[-1] == "s" and word[-2] != "s" else word


def _past(word: str) -> str:
    hit = _longest(word, {"eed": "", "ed": "", "ing": ""})
    if not hit:
        return word
    before, suffix = hit
    if suffix == "eed":
        return word[:-1] if _SOME.search(before) else word
    if not _VOWEL.search(before):
        return word
    if before.endswith(("at", "bl", "iz")) or (_SHORT.search(before) and not re.search(r"([^aeiouylsz])\1$", before)):
        return before + "e"
    return before[:-1] if re.search(r"([^aeiouylsz])\1$", before) else before


def stem_word(word: str) -> str:
    """Stem of one lower-case word; words under three letters stay."""
    if len(word) < 3:
        return word
    initial_y = word[0] == "y"
    w = _past(_plural("Y" + word[1:] if initial_y else word))
    if len(w) > 1 and w[-1] == "y" and _VOWEL.search(w[:-1]):
        w = w[:-1] + "i"
    w = _swap(_swap(w, _DERIVED, _SOME), _FORMED, _SOME)
    if hit := _longest(w, _DROPPED):
        w = hit[0] if _TWO.search(hit[0]) else w
    elif re.search(".[st]ion$", w) and _TWO.search(w[:-3]):
        w = w[:-3]
    if len(w) > 1 and w[-1] == "e":
        before = w[:-1]
        if _TWO.search(before) or (_ONE.search(before) and not _SHORT.search(before)):
            w = before
    if w.endswith("ll") and _TWO.search(w):
        w = w[:-1]
    return "y" + w[1:] if initial_y else w


def stem_term(term: str) -> str:
    """Stem of a normalised term: each part of a hyphenated one by itself."""
    t = re.sub("-+", "-", re.sub("[^a-z0-9-]", "", term.strip().lower()))
    return "-".join(stem_word(p) for p in re.sub("^-|-$", "", t).split("-"))


@pandas_udf(StringType())
def stem(term: pd.Series) -> pd.Series:
    """Stem of each term; null stays null."""
    return term.map(stem_term, na_action="ignore")


def stemmed(terms: DataFrame, column: str) -> DataFrame:
    """`column`, stem of the distinct terms: Python sees each term once, rows are joined back by the caller."""
    return terms.select(column).where(F.col(column).isNotNull()).distinct().select(column, stem(F.col(column)).alias("stem"))
