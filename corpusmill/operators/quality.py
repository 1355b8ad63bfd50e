"""Data quality: rule sets that yield errors, warnings and suggestions; duplicates; reports; JSON schemas."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions import text as T
from corpusmill.operators.skew import lookup
from corpusmill.sources import corpus as R

# What the two dialects allow.
CONTENT_TYPES = {"code": ("markdown", "code", "data", "media"), "schema": ("lesson", "reference", "exercise", "assessment", "project", "discussion", "resource")}
LEVELS = ("beginner", "intermediate", "advanced", "expert")
FORBIDDEN = (("lorem ipsum", "Contains placeholder text"), ("TODO:", "Contains TODO comments"), ("FIXME:", "Contains FIXME comments"), ("test test test", "Contains test placeholder"))


def said(*rules: tuple[Column, str]) -> Column:
    """Messages of the rules that hold, in order."""
    return F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in rules]), lambda m: m.isNotNull())


def _missing(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def _length(c: str) -> Column:
    return F.when(~_missing(c), F.length(c))


def content_rules(d: DataFrame) -> DataFrame:
    """Adds errors and warnings from path, title, summary, content (null counts as empty). Guides may hold forbidden text."""
    guide = F.coalesce(F.col("path"), F.lit("")).rlike("/docs/|/wiki/|README|GUIDE|CONTRIBUTING")
    content = F.coalesce("content", F.lit(""))
    errors = said(
        (_missing("title"), "Missing required field: title"), (_missing("summary"), "Missing required field: summary"), (_length("title") < 3, "Title too short (< 3 chars)"), (_length("title") > 100, "Title too long (> 100 chars)"),
        *((~guide & content.rlike(f"(?i){p}"), m) for p, m in FORBIDDEN),
    )
    warnings = said((_length("summary") < 20, "Summary too short (< 20 chars)"), (_length("summary") > 300, "Summary too long (> 300 chars)"), (F.length(content) < 100, "Content very short (< 100 chars)"))
    return d.withColumn("errors", errors).withColumn("warnings", warnings)


def improvements(d: DataFrame) -> DataFrame:
    """Adds suggestions from id, version, tags, relationships, difficulty and, where the columns are there, from what an analysis
    found: keywords (five are named), subjects, topics, level, phrases (three are named). An absent column says nothing."""
    has = lambda c: c in d.columns
    named = lambda what, c, most: F.concat(F.lit(what), F.lit(": "), F.array_join(F.slice(c, 1, most), ", ")) if has(c) else F.lit(what)
    none = F.array().cast("array<string>")
    tagless = F.size(F.coalesce("tags", none)) == 0
    rules = [(_missing("id"), F.lit("Add unique ID")), (_missing("version"), F.lit("Add version number")), (tagless, named("Consider adding tags", "keywords", 5)), (_missing("relationships"), F.lit("Consider adding relationships"))]
    rules += [(F.lit(True), named(what, c, 10**6)) for what, c in (("Auto-detected subjects", "subjects"), ("Auto-detected topics", "topics")) if has(c)]
    rules.append((_missing("difficulty"), F.concat(F.lit("Suggested difficulty: "), "level") if has("level") else F.lit("Suggest difficulty")))
    if has("phrases"):
        rules.append((F.size("phrases") > 0, named("Key phrases found", "phrases", 3)))
    return d.withColumn("suggestions", F.filter(F.array(*[F.when(c, m) for c, m in rules]), lambda m: m.isNotNull()))


def _json_type(c: Column, path: str) -> Column:
    """First character of a JSON field, null if it is absent: tells arrays from strings and objects."""
    return F.substring(F.get_json_object(c, path), 1, 1)


def strand_rules(d: DataFrame, dialect: str = "code") -> DataFrame:
    """Adds errors and warnings from id, slug, title, content_type, difficulty, relationships, version of strands in one dialect.

    code: difficulty is one word and relationships an object of lists; schema: difficulty may be an object with
    `overall`, relationships an array of edges.
    """
    r = F.coalesce("relationships", F.lit(""))
    wrong_list = lambda f: _json_type(r, f"$.{f}").isNotNull() & (_json_type(r, f"$.{f}") != "[")
    level = F.lower(F.trim("difficulty")) if dialect == "code" else F.lower(F.coalesce(F.get_json_object("difficulty", "$.overall"), F.trim("difficulty")))
    rel = [(wrong_list("requires"), "Relationships.requires must be an array"), (wrong_list("references"), "Relationships.references must be an array")] if dialect == "code" else [(~_missing("relationships") & ~r.startswith("["), "Relationships must be an array")]
    errors = said(
        *((_missing(c), f"Missing required field '{c}'") for c in ("id", "slug", "title")), (~_missing("id") & ~T.uuid_ok(F.col("id")), "ID must be a valid UUID"),
        (~_missing("content_type") & ~F.col("content_type").isin(*CONTENT_TYPES[dialect]), "Invalid content type"), (~_missing("difficulty") & ~level.isin(*LEVELS), "Invalid difficulty level"), *rel,
    )
    warnings = said((~_missing("version") & ~T.semver_ok(F.col("version")), "Version should follow semver format (x.y.z)"))
    return d.withColumn("errors", errors).withColumn("warnings", warnings)


def folder_rules(d: DataFrame, required: Sequence[str]) -> DataFrame:
    """Adds errors of weave or loom rows: required fields, and the form of the slug."""
    return d.withColumn("errors", said(*((_missing(c), f"Missing required field '{c}'") for c in required), (~_missing("slug") & ~T.slug_ok(F.col("slug")), "Slug must be lowercase alphanumeric with hyphens")))


def file_messages(files: DataFrame, dialect: str = "schema") -> DataFrame:
    """path, kind (error or warning), message of files (path, text), by what each is.

    Markdown files are strands: their header by strand_rules(), their body by its length and by open marks. Files named
    weave.yaml and loom.yaml need their fields; other YAML files need only be well-formed. A header or file that is no
    YAML mapping gives one error and no other messages of its fields. Other files and null paths give none.
    """
    name, body = F.regexp_extract("path", "[^/]*$", 0), R.body(F.col("text"))
    f = files.where("path is not null").select("path", F.coalesce("text", F.lit("")).alias("text")).withColumn("name", name)
    md, yaml = F.col("name").endswith(".md"), F.col("name").rlike(r"\.ya?ml$")
    f = f.where(md | yaml).withColumn("source", F.when(md, R.front_matter(F.col("text"))).when(F.trim("text") != "", F.col("text"))).withColumn("metadata", R.yaml_json("source"))
    broken = F.col("source").isNotNull() & (F.col("metadata").isNull() | ~F.coalesce("metadata", F.lit("")).rlike(r"^(\{|null)"))
    get = lambda p: F.get_json_object("metadata", f"$.{p}")
    f = f.select("path", "name", "text", broken.alias("broken"), *(get(p).alias(c) for c, p in (("id", "id"), ("slug", "slug"), ("title", "title"), ("summary", "summary"), ("content_type", "contentType"), ("difficulty", "difficulty"), ("relationships", "relationships"), ("version", "version"))))
    f = strand_rules(f, dialect).withColumnsRenamed({"errors": "strand_errors", "warnings": "strand_warnings"})
    f = folder_rules(f, ("slug", "title")).withColumnRenamed("errors", "weave_errors")
    f = folder_rules(f, ("slug", "title", "summary")).withColumnRenamed("errors", "loom_errors")
    none = F.array().cast("array<string>")
    errors = F.when(F.col("broken"), F.array(F.lit("Cannot be parsed"))).when(md, F.col("strand_errors")).when(F.col("name") == "weave.yaml", F.col("weave_errors")).when(F.col("name") == "loom.yaml", F.col("loom_errors")).otherwise(none)
    marks = said((F.length(F.trim(body)) < 100, "Content is very short (< 100 characters)"), (body.rlike("(?i)TODO:|FIXME:"), "Contains TODO/FIXME comments"))
    warnings = F.when(md, F.concat(F.when(F.col("broken"), none).otherwise(F.col("strand_warnings")), marks)).otherwise(none)
    said_of = lambda kind, c: F.transform(c, lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("message")))
    f = f.select("path", F.concat(said_of("error", errors), said_of("warning", warnings)).alias("m"))
    return f.select("path", F.explode("m").alias("m")).select("path", "m.kind", "m.message")


# Allowed words and ranges of the educational fields.
WORDS = {
    "learningDesign.objectives[*].bloomsLevel": ("remember", "understand", "apply", "analyze", "evaluate", "create"),
    "learningDesign.pedagogicalApproach[*]": ("direct_instruction", "discovery_learning", "problem_based", "collaborative", "experiential", "inquiry_based"),
    "interactiveElements[*].type": ("quiz", "poll", "simulation", "code_exercise", "discussion_prompt", "reflection", "peer_review"),
    "accessibility.wcagLevel": ("A", "AA", "AAA"),
    "quality.peerReview.status": ("pending", "reviewed", "approved"),
    "quality.evidenceBased[*].strength": ("strong", "moderate", "emerging"),
    "quality.updateFrequency": ("static", "annual", "biannual", "quarterly", "dynamic"),
}
ADVISED = {"accessibility.features[*]": ("alt_text", "captions", "transcripts", "audio_description", "sign_language", "easy_read", "high_contrast", "keyboard_navigation")}
RANGES = {
    "assessments.formative[*].weight": (0, 1), "assessments.summative[*].weight": (0, 1), "assessments.summative[*].passingScore": (0, 100), "accessibility.readingLevel": (1, 20), "quality.peerReview.score": (0, 5),
}
NEEDED = {
    "learningDesign.objectives": ("description",), "interactiveElements": ("id", "type"), "assessments.formative": ("id", "type"), "assessments.summative": ("id", "type"), "culturalAdaptations": ("culture",),
    "quality.evidenceBased": ("claim", "evidence", "citation"),
}
NUMBERS = ("timeEstimates.reading", "timeEstimates.exercises", "timeEstimates.projects", "timeEstimates.total", "modalities.visual.diagrams", "modalities.visual.images", "modalities.visual.charts")
FLAGS = ("modalities.text", "modalities.audio.narration", "interactiveElements[*].required")
LISTS = ("learningDesign.objectives", "learningDesign.pedagogicalApproach", "interactiveElements", "assessments.formative", "assessments.summative", "accessibility.features", "culturalAdaptations", "quality.evidenceBased")


def education_rules(d: DataFrame, column: str = "metadata") -> DataFrame:
    """Adds errors, warnings and suggestions of the educational fields of a JSON column; one message per field, however many of its elements are wrong.

    The rules are tables of paths: lists, needed fields, allowed words, ranges, numbers, flags. A null or malformed
    column has none but the suggestion.
    """
    v = F.try_parse_json(column)

    def every(path: str) -> Column:
        """The values at a path as JSON texts; `[*]` stands for all elements of a list."""
        if "[*]" not in path:
            return F.array(F.to_json(F.try_variant_get(v, f"$.{path}", "variant")))
        before, after = path.split("[*]")
        items = F.coalesce(F.try_variant_get(v, f"$.{before}", "array<variant>"), F.array().cast("array<variant>"))
        return F.transform(items, lambda x: F.to_json(F.try_variant_get(x, "$" + after, "variant") if after else x))

    some = lambda path, bad: F.exists(every(path), lambda x: F.coalesce(x.isNotNull() & bad(x), F.lit(False)))
    outside = lambda low, high: lambda x: ~x.rlike(r"^-?\d") | F.coalesce((x.try_cast("double") < low) | (x.try_cast("double") > high), F.lit(True))
    among = lambda words: lambda x: ~x.isin(*[json.dumps(w) for w in words])
    lacks = lambda field: lambda x: F.coalesce(F.get_json_object(x, f"$.{field}"), F.lit("")) == ""
    errors = (
        [(some(p, lambda x: ~x.startswith("[")), f"{p} must be an array") for p in LISTS]
        + [(some(f"{p}[*]", lacks(f)), f"{p}: missing {f}") for p, fs in NEEDED.items() for f in fs]
        + [(some(p, among(ws)), f"{p}: not allowed") for p, ws in WORDS.items()]
        + [(some(p, outside(*r)), f"{p} must be between {r[0]} and {r[1]}") for p, r in RANGES.items()]
        + [(some(p, lambda x: ~x.rlike(r"^-?\d")), f"{p} must be a number") for p in NUMBERS]
        + [(some(p, lambda x: ~x.isin("true", "false")), f"{p} must be boolean") for p in FLAGS]
    )
    t = {k: F.try_variant_get(v, f"$.timeEstimates.{k}", "double") for k in ("reading", "exercises", "projects", "total")}
    off = (t["total"] > 0) & (t["reading"] > 0) & (t["exercises"] > 0) & (F.abs(t["reading"] + t["exercises"] + F.coalesce(t["projects"], F.lit(0.0)) - t["total"]) > 1)
    warnings = [(off, "timeEstimates.total does not match its parts")] + [(some(p, among(ws)), f"{p}: unknown") for p, ws in ADVISED.items()] + [(some("culturalAdaptations[*].culture", lambda x: ~x.rlike('^"[A-Z]{2}"$')), "culturalAdaptations: culture should be two capitals")]
    none = [F.to_json(F.try_variant_get(v, f"$.{k}", "variant")).isNull() for k in ("learningDesign", "timeEstimates", "modalities")]
    return d.withColumn("errors", said(*errors)).withColumn("warnings", said(*warnings)).withColumn("suggestions", said((none[0] & none[1] & none[2], "Consider adding educational fields")))


def repeats(d: DataFrame, key: Column, path: str = "path") -> DataFrame:
    """path, key, first: each row whose key an earlier path (in binary order) has too, with that first path. Null and empty keys do not count."""
    rows = d.select(path, key.alias("key")).where((F.col(path).isNotNull()) & (F.coalesce("key", F.lit("")) != "")).distinct()
    first = rows.groupBy("key").agg(F.min(path).alias("first"), F.count("*").alias("_n"))
    j = lookup(rows, first, "key", "_n", max(1, rows.count()), F.col(path))
    return j.where(F.col(path) > F.col("first")).select(path, "key", "first")


def title_key(c: str = "title") -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def report(d: DataFrame) -> DataFrame:
    """One row: rows, valid rows, errors, warnings."""
    return d.agg(F.count("*").alias("rows"), F.count_if(F.size("errors") == 0).alias("valid"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("bigint").alias("errors"), F.coalesce(F.sum(F.size("warnings")), F.lit(0)).cast("bigint").alias("warnings"))


def common_messages(d: DataFrame, column: str, k: int = 10) -> DataFrame:
    """message, n of the k most frequent messages."""
    return T.exploded(d, [], F.col(column), "message").groupBy("message").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "message").limit(k)


_TYPES = {"string": '^"', "number": r"^-?\d", "integer": r"^-?\d+$", "boolean": "^(true|false)$", "array": r"^\[", "object": r"^\{"}


def schema_errors(column: Column, schema: dict) -> Column:
    """Errors of a JSON text against a schema: type, required, and of each property its type, enum, minimum and maximum."""
    v = F.try_parse_json(column)
    kind = F.when(v.isNull(), None).otherwise(F.to_json(v))
    rules: list[tuple[Column, str]] = [(column.isNull() | v.isNull(), "not JSON")]
    if schema.get("type") in ("array", "object"):
        rules.append((v.isNotNull() & ~kind.rlike(_TYPES[schema["type"]]), f"expected {schema['type']}"))
    for f in schema.get("required", ()):
        rules.append((v.isNotNull() & F.try_variant_get(v, f"$.{f}", "variant").isNull(), f"missing {f}"))
    for f, s in schema.get("properties", {}).items():
        x = F.to_json(F.try_variant_get(v, f"$.{f}", "variant"))
        if s.get("type") in _TYPES:
            rules.append((x.isNotNull() & ~x.rlike(_TYPES[s["type"]]), f"{f}: expected {s['type']}"))
        if "enum" in s:
            rules.append((x.isNotNull() & ~x.isin(*[json.dumps(e) for e in s["enum"]]), f"{f}: not allowed"))
        n = F.try_variant_get(v, f"$.{f}", "double")
        if "minimum" in s:
            rules.append((n < s["minimum"], f"{f}: below {s['minimum']}"))
        if "maximum" in s:
            rules.append((n > s["maximum"], f"{f}: above {s['maximum']}"))
    return said(*rules)
