"""Problem 1: mapping freely typed values to the entries of a reference list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.session import bounded, materialise, wide

#: Reference strings up to which their segment table is broadcast (five rows each at most).
BROADCAST_REFS = 20_000
#: Typing slips allowed for a reference string of at least so many letters: (letters, slips), longest first.
SLIPS = ((9, 2), (5, 1))
#: Words that add nothing to a tag, at its start and at its end.
LEADING = ("the", "a", "an", "my", "about", "on", "re", "topic", "tag", "subject")
TRAILING = ("notes", "note", "stuff", "misc", "etc", "topic", "topics", "tag", "related", "things")

# Cyrillic and Greek letters that look like Latin ones, and letters without a decomposition.
_LOOKALIKE = ("аеорсухіјѕԁһԛԝктмвнгοαεικνρτυχßøłđæœ", "aeopcyxijsdhqwktmbhroaeikvptuxsoldao")
_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def folded(text: Column) -> Column:
    """Lower-case Latin form: compatibility decomposition without marks, look-alike letters replaced."""
    d = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), F.coalesce(text, F.lit("")), F.lit(True))
    plain = F.when(text.rlike(r"[^\x00-\x7f]"), F.regexp_replace(d, r"\p{M}+", "")).otherwise(text)
    return F.translate(F.lower(plain), *_LOOKALIKE)


def _tokens(f: Column) -> Column:
    return F.filter(F.split(f, r"[^a-z0-9]+"), lambda w: w != "")


def _sorted_key(tokens: Column) -> Column:
    return F.array_join(F.array_sort(tokens), "")


def _bare(tokens: Column) -> Column:
    """The tokens, and those without a filler word at the start, at the end, at both; at least one word stays."""
    n = F.size(tokens)
    lead, trail = (n > 1) & tokens[0].isin(*LEADING), (n > 1) & F.element_at(tokens, -1).isin(*TRAILING)
    front = F.when(lead, F.slice(tokens, 2, n - 1))
    back = F.when(trail, F.slice(tokens, 1, n - 1))
    both = F.when(lead & trail & (n > 2), F.slice(tokens, 2, F.greatest(n - 2, F.lit(1))))
    return F.filter(F.array(tokens, front, back, both), lambda x: x.isNotNull() & (F.size(x) > 0))


def references(canonical: DataFrame) -> DataFrame:
    """key, skey, tag, alias of each entry and alias: the letters in order, the letters of the sorted words, the entry meant.

    Of several entries with one key an entry goes before an alias, then the first in binary order.
    """
    c = canonical.select("tag", "aliases").where("tag is not null and trim(tag) <> ''")
    r = c.select("tag", F.col("tag").alias("name"), F.lit(0).alias("alias")).unionByName(c.select("tag", F.explode("aliases").alias("name"), F.lit(1).alias("alias")))
    r = r.select("tag", "alias", folded(F.col("name")).alias("f")).select("tag", "alias", _tokens(F.col("f")).alias("w"))
    r = r.select("tag", "alias", F.array_join("w", "").alias("key"), _sorted_key(F.col("w")).alias("skey")).where("key <> ''")
    return r.groupBy("key", "skey").agg(F.min(F.struct("alias", "tag")).alias("x")).select("key", "skey", "x.tag", "x.alias")


def _slips(length: Column) -> Column:
    s = None
    for least, n in SLIPS:
        s = F.when(length >= least, n) if s is None else s.when(length >= least, n)
    return s.otherwise(0)


def _bag(a: Column, b: Column) -> Column:
    """Letters that one string has more of than the other, the greater of both directions."""
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    letters = F.split(F.lit(_LETTERS), "")
    over = lambda s, t: F.aggregate(letters, F.lit(0), lambda n, c: n + F.greatest(F.lit(0), count(s, c) - count(t, c)))
    return F.greatest(over(a, b), over(b, a))


#: Begins a key that is made of sorted words; such keys allow no slips.
_WORDS = "\u0001"


def _cut(length: Column, slips: Column, i: Column) -> tuple[Column, Column]:
    """Start and size of segment i of a reference of some length: 2 * slips + 1 segments as even as can be."""
    n = 2 * slips + 1
    start = (i * length / n).cast("int")
    return start, ((i + 1) * length / n).cast("int") - start


def segments(refs: DataFrame) -> DataFrame:
    """key, tag, alias, slips, n, i, part from key, tag, alias, slips: each reference of n letters cut into 2 * slips + 1 segments, one row each.

    d changes (a letter dropped, added or changed) spoil d segments at most, so where d <= 2 * slips one survives. A
    reference that allows no slip is one segment, itself.
    """
    r = refs.withColumn("n", F.length("key"))
    r = r.select("*", F.explode(F.sequence(F.lit(0), 2 * F.col("slips"))).alias("i"))
    start, size = _cut(F.col("n"), F.col("slips"), F.col("i"))
    return r.select("key", "tag", "alias", "slips", "n", "i", F.substring(F.col("key"), start + 1, size).alias("part"))


def probes(values: DataFrame) -> DataFrame:
    """value, n, i, part: the substrings of each value that can be segment i of a reference of n letters.

    A reference is `slips` letters longer or shorter at most. With D the letters the value has more and m those that a
    surviving segment is moved by, |m| and |D - m| letters are added or dropped before and after it, and |D| letters
    are not in common, so only moves with |m| + |D - m| + |D| <= 2 * slips are tried: 95 substrings at most, however
    many references there are and however long they are.
    """
    most = max(s for _, s in SLIPS)
    v = values.select("value", F.explode(F.sequence(F.length("value") - most, F.length("value") + most)).alias("n")).where("n > 0")
    v = v.withColumn("slips", F.when(F.startswith("value", F.lit(_WORDS)), 0).otherwise(_slips(F.col("n")))).withColumn("more", F.length("value") - F.col("n")).where(F.abs("more") <= F.col("slips"))
    move = F.filter(F.sequence(-2 * F.col("slips"), 2 * F.col("slips")), lambda m: F.abs(m) + F.abs(F.col("more") - m) + F.abs("more") <= 2 * F.col("slips"))
    v = v.select("value", "n", "slips", F.explode(move).alias("move"), F.sequence(F.lit(0), 2 * F.col("slips")).alias("i")).select("value", "n", "slips", "move", F.explode("i").alias("i"))
    start, size = _cut(F.col("n"), F.col("slips"), F.col("i"))
    v = v.withColumn("start", start + F.col("move")).withColumn("size", size).where("start >= 0 and start + size <= length(value)")
    return v.select("value", "n", "i", F.substring(F.col("value"), F.col("start") + 1, F.col("size")).alias("part"))


def closest(values: DataFrame, refs: DataFrame) -> DataFrame:
    """key, score, d, alias, tag of each distinct string `key` of values that is within the allowed slips of a reference, or equal to it.

    refs: key, tag, alias, and slips where they are not those of its length. Partition-based pigeonhole join: the
    references' segments and the values' substrings meet by equality on (length, place, segment); pairs are verified
    by the built-in levenshtein and the letters in common. With d the distance and b the letters not in common,
    d + b <= 2 * slips holds for that many dropped, added, changed (1 + 1) or swapped (2 + 0) letters. The closest
    reference wins, an entry before an alias, then binary order.
    """
    seg = segments(refs if "slips" in refs.columns else refs.withColumn("slips", _slips(F.length("key"))))
    q = probes(wide(values.select(F.col("key").alias("value")).where("value <> ''").distinct()))
    side = F.broadcast(seg) if bounded(refs, BROADCAST_REFS) else seg
    j = q.join(side, ["n", "i", "part"]).select("value", "key", "tag", "alias", "slips").distinct()
    same = F.col("value") == F.col("key")
    j = j.withColumn("d", F.when(same, 0).otherwise(F.levenshtein("value", "key", 2 * max(s for _, s in SLIPS)))).where((F.col("d") >= 0) & (F.col("d") <= 2 * F.col("slips")))
    j = j.withColumn("score", F.when(same, 0).otherwise(F.col("d") + _bag(F.col("value"), F.col("key")))).where(F.col("score") <= 2 * F.col("slips"))
    best = j.groupBy("value").agg(F.min(F.struct("score", "d", "alias", "tag")).alias("x"))
    return best.select(F.col("value").alias("key"), "x.score", "x.d", "x.alias", "x.tag")


def canonical_values(values: DataFrame, canonical: DataFrame) -> DataFrame:
    """raw_tag, tag of each distinct non-blank value of the column raw_tag; tag is `none` where no entry is meant.

    A value has up to five forms: as it is, without a `scheme:` or `path/` before it, and of that without filler
    words around. Every form goes through the pigeonhole join twice: by its letters in order, with the slips that the
    reference's length allows, and by its sorted words, without slips. Equal letters win, earlier forms first, then equal
    words, then the fewest slips. What is left is reported through an anti-join as `none`. Null and blank values are
    left out; an empty reference list gives `none` throughout.
    """
    v = values.select("raw_tag").where("raw_tag is not null").distinct().withColumn("f", folded(F.col("raw_tag")))
    v = v.where(F.col("raw_tag").rlike(r"(?U)[^\s\p{C}]"))
    tail = F.regexp_replace("f", r"^.*[:/](?=.*[a-z0-9])", "")
    forms = F.array_distinct(F.concat(F.array(_tokens(F.col("f"))), _bare(_tokens(tail))))
    v = v.select("raw_tag", F.posexplode_outer(forms).alias("form", "w"))
    v = v.select("raw_tag", "form", F.explode(F.array(F.array_join("w", ""), F.concat(F.lit(_WORDS), _sorted_key(F.col("w"))))).alias("key"))
    v = materialise(v, "forms")
    r = references(canonical)
    least = lambda df, c: df.groupBy(c).agg(F.min(F.struct("alias", "tag")).alias("x")).select(F.col(c).alias("key"), "x.tag", "x.alias")
    letters = r.select("key", "tag", "alias").distinct().withColumn("slips", _slips(F.length("key")))
    words = least(r, "skey").select(F.concat(F.lit(_WORDS), "key").alias("key"), "tag", "alias", F.lit(0).alias("slips"))
    near = materialise(closest(v, letters.unionByName(words)), "nearest")  # read for the found and for the missing
    kind = F.when(F.startswith("key", F.lit(_WORDS)), 1).when(F.col("score") == 0, 0).otherwise(2)
    x = v.join(near, "key").withColumn("kind", kind)
    found = x.groupBy("raw_tag").agg(F.min(F.struct("kind", F.when(F.col("kind") == 2, F.col("score")).otherwise(F.col("form")).alias("s"), "d", "alias", "tag")).alias("x")).select("raw_tag", "x.tag")
    missing = v.select("raw_tag").distinct().join(found, "raw_tag", "left_anti").withColumn("tag", F.lit("none"))
    return found.unionByName(missing)


def map_tags(strands: DataFrame, canonical: DataFrame) -> DataFrame:
    """path, raw_tag, tag: each distinct tag of a strand, as written, that is no canonical entry, with the entry meant or `none`.

    Values are mapped once each, however many strands hold them, and joined back on the value. Rows without path are
    left out; cases as in canonical_values.
    """
    t = strands.select("path", F.explode("tags").alias("raw_tag")).where("path is not null and raw_tag is not null").distinct()
    known = canonical.select(F.col("tag").alias("raw_tag")).where("raw_tag is not null").distinct()
    side = F.broadcast if bounded(known, BROADCAST_REFS) else (lambda df: df)
    t = t.join(side(known), "raw_tag", "left_anti")
    return t.join(canonical_values(t, canonical), "raw_tag").select("path", "raw_tag", "tag")
