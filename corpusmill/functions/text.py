"""Tokens, n-grams, slugs, hashtags, summaries, readability and other scalar text functions; all JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: White space as ECMAScript defines it; the engine's \s is ASCII only.
BLANK = r"[ \t\n\r\f\x0B\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

# The short stop list used where no vocabulary directory is given.
STOP_WORDS = tuple(
    "the a an and or but in on at to for of with by from as is was are been be have has had do does did will would should could may might must can this that these those "
    "i you he she it we they what which who when where why how all each every both few more most other some such no nor not only own same so than too very s t just don now use using used".split()
)
HEADING_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6")


def trim(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def exploded(df: DataFrame, keep: Sequence[str], array: Column, name: str, pos: str | None = None) -> DataFrame:
    """The columns `keep` and a row per element (no nulls) of a computed array, with its place as `pos` if asked for.

    explode() of a computed array makes the optimiser filter on its size first, which computes it twice or thrice;
    explode_outer() does not.
    """
    g = F.posexplode_outer(array).alias(pos, name) if pos else F.explode_outer(array).alias(name)
    return df.select(*keep, g).where(F.col(name).isNotNull())


def tokens(text: Column, keep: str = "_", least: int = 3, stop: Sequence[str] = ()) -> Column:
    """Lower-case runs of ASCII letters, digits and the characters `keep`, of at least `least` characters, without stop words."""
    # One predicate: stop words cost a hash lookup in InSet, no join and no second pass.
    ok = (lambda w: (F.length(w) >= least) & ~w.isin(*stop)) if stop else (lambda w: F.length(w) >= least)
    return F.filter(F.split(F.lower(text), rf"[^a-z0-9{keep}]+"), ok)


def ngrams(words: Column, n: int, sep: str = " ") -> Column:
    """Runs of n neighbouring words, joined by `sep`; empty for fewer words."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), sep))).otherwise(F.array().cast("array<string>"))


def normal_term(term: Column) -> Column:
    """Lower case, only letters, digits and single hyphens, none at either end."""
    t = F.regexp_replace(F.regexp_replace(F.lower(term), "[^a-z0-9-]", ""), "-+", "-")
    return F.regexp_replace(t, "^-|-$", "")


def slug(text: Column, limit: int = 50) -> Column:
    """Word characters, blanks and hyphens only; blanks and underscores to one hyphen; at most `limit` characters."""
    t = F.regexp_replace(F.lower(text), r"[^a-z0-9_\-" + BLANK[1:-1] + "]", "")
    t = F.regexp_replace(t, "(?:" + BLANK + "|_)+", "-")
    return F.substring(F.regexp_replace(t, "^-+|-+$", ""), 1, limit)


def template_slug(title: Column) -> Column:
    return F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-")


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 1 << 30))


def name_title(path: Column) -> Column:
    """Title from a file name: no extension, hyphens and underscores as blanks, a capital at each word."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.array_join(F.transform(F.split(F.regexp_replace(name, "[-_]", " "), " "), _capital), " ")


def segment_title(path: Column, root: str = "Overview") -> Column:
    """`a/b-c` to `A / B C`; the root gets a fixed label."""
    part = lambda s: F.array_join(F.transform(F.split(s, "[-_]+"), _capital), " ")
    return F.when(F.coalesce(path, F.lit("")) == "", F.lit(root)).otherwise(F.array_join(F.transform(F.split(path, "/"), part), " / "))


def weave(path: Column) -> Column:
    """Second segment of a path."""
    return F.get(F.split(path, "/"), 1)


def loom(path: Column) -> Column:
    """Segments between the second and the last, '' if there are none."""
    s = F.split(path, "/")
    return F.when(F.size(s) > 3, F.array_join(F.slice(s, 3, F.greatest(F.size(s) - 3, F.lit(0))), "/")).otherwise("")


def hashtags(text: Column) -> Column:
    """Inline tags in order of first occurrence, lower case, no heading marks."""
    t = F.transform(F.regexp_extract_all(text, F.lit(r"#([a-zA-Z][a-zA-Z0-9_/-]*)"), F.lit(1)), F.lower)
    return F.array_distinct(F.filter(t, lambda x: ~x.isin(*HEADING_TAGS)))


def clean_markdown(text: Column) -> Column:
    """Without fenced code, inline code and heading marks."""
    t = F.regexp_replace(text, r"(?s)```.*?```", "")
    t = F.regexp_replace(t, r"`[^`]+`", "")
    return trim(F.regexp_replace(t, "#{1,6}" + BLANK, ""))


def split_sentences(text: Column, above: int) -> Column:
    return F.filter(F.split(text, "[.!?]+" + BLANK + "+"), lambda s: F.length(s) > above)


def with_summary(df: DataFrame, text: str = "text", out: str = "summary", stop: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Adds the sentence (of the cleaned text) with most words among the first 20 tokens, the earliest of equals; at most 300 characters.

    The intermediate columns stand in projections of their own: each is used in a lambda, where it would be computed
    anew for every element.
    """
    d = df.withColumn("_clean", clean_markdown(F.col(text))).withColumn("_key", F.slice(tokens(F.col("_clean"), stop=stop), 1, 20)).withColumn("_sentences", split_sentences(F.col("_clean"), 20))
    score = lambda s: F.size(F.filter(tokens(s, stop=stop), lambda w: F.array_contains(F.col("_key"), w)))
    d = d.withColumn("_best", F.array_min(F.transform("_sentences", lambda s, i: F.struct((-score(s)).alias("n"), i.alias("i"), s.alias("s")))))
    best = F.col("_best.s")
    short = F.when(F.length(best) > 300, F.concat(F.substring(best, 1, 297), F.lit("..."))).otherwise(best)
    d = d.withColumn(out, F.when(F.size("_sentences") == 0, F.concat(F.substring("_clean", 1, 200), F.lit("..."))).otherwise(short))
    return d.drop("_clean", "_key", "_sentences", "_best")


def syllables(word: Column) -> Column:
    """Vowel groups without a silent final e, at least one."""
    n = F.regexp_count(word, F.lit("[aeiouy]+")) - F.when(word.rlike("[^aeiouy]e$"), 1).otherwise(0)
    return F.greatest(F.lit(1), n)


def with_readability(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds grade, ease, sentences, words, syllables: Flesch-Kincaid grade and reading ease; zeros where nothing counts."""
    d = df.withColumn("_clean", clean_markdown(F.col(text)))
    d = d.withColumn("_words", F.filter(F.split("_clean", BLANK + "+"), lambda w: w != "")).withColumn("_s", F.size(split_sentences(F.col("_clean"), 10)))
    d = d.withColumn("_bare", F.filter(F.transform("_words", lambda x: F.lower(F.regexp_replace(x, r"\W", ""))), lambda x: x != ""))
    d = d.withColumn("_y", F.aggregate("_bare", F.lit(0), lambda n, x: n + syllables(x))).withColumn("_w", F.size("_words"))
    some = (F.col("_s") > 0) & (F.col("_w") > 0)
    wps, spw = F.col("_w") / F.col("_s"), F.col("_y") / F.col("_w")
    grade = F.greatest(F.lit(0.0), 0.39 * wps + 11.8 * spw - 15.59)
    ease = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 206.835 - 1.015 * wps - 84.6 * spw))
    d = d.withColumn("grade", F.when(some, F.floor(grade * 10 + 0.5) / 10).otherwise(F.lit(0.0))).withColumn("ease", F.when(some, F.floor(ease + 0.5).cast("double")).otherwise(F.lit(0.0)))
    d = d.withColumns({n: F.when(some, F.col(c)).otherwise(0).cast("bigint") for n, c in (("sentences", "_s"), ("words", "_w"), ("syllables", "_y"))})
    return d.drop("_clean", "_words", "_bare", "_s", "_w", "_y")


def round3(x: Column) -> Column:
    """Half up at the third decimal, in double arithmetic."""
    return F.floor(x * 1000 + 0.5) / 1000


def entity_density(text: Column) -> Column:
    """Share of capitalised, technical and code-like words, at most 1."""
    words = F.filter(F.split(text, BLANK + "+"), lambda w: w != "")
    count = lambda p: F.size(F.filter(words, lambda w: w.rlike(p)))
    n = count("^[A-Z][a-z]") + count("[a-z][A-Z]|_|^[A-Z]{2,}$") + 0.5 * count(r"[.:\[\]()<>{}]")
    return F.when(F.size(words) == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), n / F.size(words)))


def entities(text: Column) -> Column:
    """Runs of two or more capitalised words, distinct, the first ten; a heuristic stand-in for a named-entity model."""
    return F.slice(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b([A-Z][a-z]+(?: [A-Z][a-z]+)+)\b"), F.lit(1))), 1, 10)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def commit(message: Column) -> Column:
    """struct(type, scope, description) of a conventional commit; `other` and the whole message where it is none."""
    p = r"^(\w+)(?:\(([^)]+)\))?:\s*(.+)$"
    ok = message.rlike(p)
    part = lambda i: F.regexp_extract(message, p, i)
    return F.struct(F.when(ok, F.lower(part(1))).otherwise("other").alias("type"), F.when(ok & (part(2) != ""), part(2)).alias("scope"), F.when(ok, part(3)).otherwise(message).alias("description"))


def first_json(text: Column) -> Column:
    """The JSON of a model's answer: that of a fenced block, else the outermost braces or brackets; null if none parses."""
    fenced = trim(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1))
    raw = F.regexp_extract(text, r"(?s)(\{.*\}|\[.*\])", 1)
    pick = F.when(fenced != "", fenced).when(raw != "", raw)
    return F.when(F.try_parse_json(pick).isNotNull(), pick)


def coverage_colour(percent: Column) -> Column:
    return F.when(percent >= 80, "brightgreen").when(percent >= 60, "green").when(percent >= 40, "yellow").when(percent >= 20, "orange").otherwise("red")


def short_number(n: Column) -> Column:
    """1234 as 1.2K, 1234567 as 1.2M."""
    one = lambda x: F.format_string("%.1f", F.floor(x * 10 + 0.5) / 10)
    return F.when(n >= 1_000_000, F.concat(one(n / 1_000_000), F.lit("M"))).when(n >= 1000, F.concat(one(n / 1000), F.lit("K"))).otherwise(n.cast("string"))


def code_lines(text: Column) -> Column:
    """Lines that are neither blank nor comments."""
    return F.size(F.filter(F.split(text, "\n"), lambda s: ~(trim(s) == "") & ~trim(s).rlike(r"^(//|#|\*|/\*)")))


def uuid_ok(v: Column) -> Column:
    return v.rlike("(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")


def semver_ok(v: Column) -> Column:
    return v.rlike(r"^\d+\.\d+\.\d+$")


def slug_ok(v: Column) -> Column:
    return v.rlike("^[a-z0-9-]+$")
