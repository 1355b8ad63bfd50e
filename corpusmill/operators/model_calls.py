"""Calls of a language model as a pluggable operator: any callable from prompts to answers, a deterministic stub by default."""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# Limits of retries, and what may be kept or added.
RETRIES, FIRST_WAIT, LONGEST_WAIT = 3, 1.0, 16.0
GATE, KEEP = 0.4, 0.7
_LEVEL = {"type": "string", "enum": ["beginner", "intermediate", "advanced", "expert"]}
_PERCENT = {"type": "number", "minimum": 0, "maximum": 100}
SCHEMAS = {
    "tags": {"type": "object", "required": ["tags"], "properties": {"tags": {"type": "array"}, "suggestedDifficulty": _LEVEL, "suggestedTopics": {"type": "array"}}},
    "analysis": {
        "type": "object", "required": ["qualityScore", "completeness", "suggestions"],
        "properties": {"qualityScore": _PERCENT, "completeness": _PERCENT, "readability": {"type": "string", "enum": ["easy", "moderate", "difficult"]}, "seoScore": _PERCENT, "estimatedReadingTime": {"type": "number"}, "suggestions": {"type": "array"}, "suggestedDifficulty": _LEVEL},
    },
    "summary": {"type": "object", "required": ["summary"], "properties": {"summary": {"type": "string"}, "keyPoints": {"type": "array"}, "targetAudience": {"type": "string"}}},
    "questions": {"type": "object", "required": ["questions"], "properties": {"questions": {"type": "array"}}},
}


def wait(attempt: int, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT, rng: Callable[[], float] = random.random) -> float:
    """Seconds before the next attempt: doubled each time up to `longest`, times 0.5 to 1."""
    return min(first * 2**attempt, longest) * (0.5 + 0.5 * rng())


def json_of(answer: str) -> str:
    """The JSON part of an answer: that of a fenced block, else the outermost braces or brackets, else all of it."""
    m = re.search(r"```(?:json)?\s*(.*?)```", answer, re.S) or re.search(r"(\{.*\}|\[.*\])", answer, re.S)
    return (m.group(1) if m else answer).strip()


def problems(value: object, schema: dict) -> list[str]:
    """What a value has against a schema: type, required fields, and types, enums and ranges of its properties."""
    kinds = {"string": str, "number": (int, float), "integer": int, "boolean": bool, "array": list, "object": dict}
    ok = lambda x, t: isinstance(x, kinds[t]) and not (isinstance(x, bool) and t in ("number", "integer"))
    if schema.get("type") in kinds and not ok(value, schema["type"]):
        return [f"expected {schema['type']}"]
    out = [f"missing {f}" for f in schema.get("required", ()) if not isinstance(value, dict) or f not in value]
    for f, s in schema.get("properties", {}).items():
        if isinstance(value, dict) and f in value:
            x = value[f]
            if "type" in s and not ok(x, s["type"]):
                out.append(f"{f}: expected {s['type']}")
            if "enum" in s and x not in s["enum"]:
                out.append(f"{f}: not allowed")
            if isinstance(x, (int, float)) and (x < s.get("minimum", x) or x > s.get("maximum", x)):
                out.append(f"{f}: out of range")
    return out


def stub(prompt: str) -> str:
    """Deterministic answer for tests: the three most frequent long words as tags."""
    words = re.findall(r"[a-z]{5,}", prompt.lower())
    best = sorted(set(words), key=lambda w: (-words.count(w), w))[:3]
    return json.dumps({"tags": [{"value": w, "confidence": 0.8} for w in best]})


def ask(prompt: str, call: Callable[[str], str] = stub, schema: dict | None = None, retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, int]:
    """(JSON, error, attempts): repeats a call that fails, or whose answer is no JSON of the schema, telling it what was wrong."""
    error, text = None, prompt
    for n in range(retries):
        try:
            value = json.loads(json_of(call(text)))
            wrong = problems(value, schema or {})
            if not wrong:
                return json.dumps(value), None, n + 1
            error = "; ".join(wrong)
        except ValueError:
            error = "answer is not JSON"
        except Exception as e:  # noqa: BLE001 - one bad call is a row, not a failed job
            error = str(e) or type(e).__name__
        text = f"{prompt}\n\nThe last answer was refused: {error}. Answer with JSON only."
        if n + 1 < retries:
            sleep(wait(n))
    return None, error, retries


def answers(prompts: DataFrame, call: Callable[[str], str] = stub, schema: dict | None = None) -> DataFrame:
    """id, answer (JSON), error, attempts of each row (id, prompt); a null prompt gives a null answer. A narrow map."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *(ask(p, call, schema) if isinstance(p, str) else (None, "no prompt", 0))) for i, p in zip(b["id"], b["prompt"])]
            yield pd.DataFrame(rows, columns=["id", "answer", "error", "attempts"])

    kind = prompts.schema["id"].dataType.simpleString()
    return prompts.select("id", "prompt").mapInPandas(run, f"id {kind}, answer string, error string, attempts int")


def within_budget(blocks: DataFrame, cost: Column, most: float, chunk: int = 10_000) -> DataFrame:
    """Blocks (doc_id, place, ...) in order up to the one with which the cost spent reaches `most`.

    A running sum in two levels: chunks of doc_ids first, whose sums are few, then within each chunk.
    """
    b = blocks.withColumn("_cost", cost).withColumn("_chunk", F.floor(F.col("doc_id") / chunk))
    sums = b.groupBy("_chunk").agg(F.sum("_cost").alias("_sum"))
    before = sums.select("_chunk", (F.sum("_sum").over(Window.orderBy("_chunk")) - F.col("_sum")).alias("_before"))
    w = Window.partitionBy("_chunk").orderBy("doc_id", "place").rowsBetween(Window.unboundedPreceding, -1)
    spent = F.col("_before") + F.coalesce(F.sum("_cost").over(w), F.lit(0.0))
    return b.join(F.broadcast(before), "_chunk").withColumn("_spent", spent).where(F.col("_spent") < most).drop("_cost", "_chunk", "_before", "_spent")


def enhanced(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """doc_id, place, tags: suggestions of at least KEEP that the reply does not remove, then those it adds; first of equal tags.

    blocks: doc_id, place, score, tags; replies: doc_id, place, added (array of tag, confidence), removed (array of
    tag). Blocks under the gate or without a reply keep what they have.
    """
    j = blocks.join(replies, ["doc_id", "place"], "left")
    own = F.filter("tags", lambda t: (t["confidence"] >= KEEP) & ~F.array_contains(F.coalesce("removed", F.array().cast("array<string>")), t["tag"]))
    new = F.transform(F.coalesce("added", F.array().cast("array<struct<tag: string, confidence: double>>")), lambda t: F.struct(t["tag"].alias("tag"), t["confidence"].alias("confidence"), F.lit("llm").alias("source"), F.lit(None).cast("int").alias("line")))
    every = F.concat(own, new)
    low = F.transform(every, lambda t: F.lower(t["tag"]))
    j = j.withColumn("_all", every).withColumn("_low", low)
    first = F.filter("_all", lambda t, i: F.array_position(F.col("_low"), F.lower(t["tag"])) == i + 1)
    return j.select("doc_id", "place", F.when((F.col("score") >= GATE) & F.col("added").isNotNull(), first).otherwise(F.col("tags")).alias("tags"))


def cost(usage_tokens: Column, price_per_1000: Column) -> Column:
    return usage_tokens / 1000.0 * price_per_1000


def filled(metadata: DataFrame, found: DataFrame, key: str, fields: tuple[str, ...], tags: int = 10) -> DataFrame:
    """Metadata whose empty fields are filled from `found` where its confidence is `high`; tags are joined, ten at most."""
    f = found.where("confidence = 'high'").select(key, *(F.col(c).alias(f"_{c}") for c in (*fields, "tags")))
    j = metadata.join(f, key, "left")
    for c in fields:
        j = j.withColumn(c, F.when(F.coalesce(F.col(c), F.lit("")) == "", F.col(f"_{c}")).otherwise(F.col(c)))
    none = F.array().cast("array<string>")
    j = j.withColumn("tags", F.slice(F.array_distinct(F.concat(F.coalesce("tags", none), F.coalesce("_tags", none))), 1, tags))
    return j.select(*metadata.columns)


def quality_summary(a: DataFrame) -> DataFrame:
    """One row: mean quality, completeness and findability (missing as 0), distinct tags, minutes of reading."""
    mean = lambda c: F.round(F.avg(F.coalesce(c, F.lit(0.0)))).cast("bigint").alias(c)
    tags = a.select(F.explode("autoTags").alias("t")).agg(F.count_distinct("t").alias("tags"))
    return a.agg(mean("qualityScore"), mean("completeness"), mean("seoScore"), F.coalesce(F.sum("estimatedReadingTime"), F.lit(0.0)).alias("minutes")).join(F.broadcast(tags))
