"""Unicode and notation normal forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _compose(text: Column, compatible: bool) -> Column:
    # ICU ships with Spark; reflect() reaches its static method and keeps the work in the JVM.
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(text, F.lit("")), F.lit(compatible))


def nfc(text: Column) -> Column:
    """NFC of `text`; null stays null. Plain ASCII skips the call. Use in a projection, not inside a lambda."""
    return F.when(text.rlike(r"[^\x00-\x7f]"), _compose(text, False)).otherwise(text)


def nfkc(text: Column) -> Column:
    """NFKC of `text`; null stays null."""
    return F.when(text.rlike(r"[^\x00-\x7f]"), _compose(text, True)).otherwise(text)


def hyphenate(text: Column) -> Column:
    """Lower case, each run of blanks, underscores and hyphens one hyphen, none at either end."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[\s_\-]+", "-"), r"^-+|-+$", "")


def plain_keyword(text: Column) -> Column:
    """Plain form of a keyword; null for null or blank."""
    p = hyphenate(nfc(text))
    return F.when(p != "", p)


def plain_tag(text: Column) -> Column:
    """Plain form of a tag: that of a keyword without leading `#`; null for null or blank."""
    p = hyphenate(F.regexp_replace(nfc(text), r"(?U)^[\s#]+", ""))
    p = F.regexp_replace(p, r"^[#\-]+", "")
    return F.when(p != "", p)


def path_key(path: Column) -> Column:
    """One notation of a path: NFC, forward slashes, no `./`, no doubled slash, no blanks around."""
    p = F.regexp_replace(F.trim(nfc(path)), r"\\", "/")
    p = F.regexp_replace(p, r"/(\./)+", "/")
    return F.regexp_replace(F.regexp_replace(p, r"/{2,}", "/"), r"^(\./)+", "")


def sha_key(sha: Column) -> Column:
    """One notation of a hex digest: lower case, no `sha256:` prefix, no blanks around; null for blank."""
    s = F.regexp_replace(F.lower(F.trim(sha)), r"^sha-?256[:=]\s*", "")
    return F.when(s != "", s)
