"""Markdown blocks of a corpus with scores and tags, and the indexes made of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusmill.functions import markdown as M
from corpusmill.functions.vocabulary import tag_terms

_SUGGESTIONS = "array<struct<tag: string, confidence: double, source: string, line: int>>"
_SCHEMA = (
    "doc_id bigint, place int, id string, line int, end_line int, type string, level int, heading string, topic_shift double, entity_density double, novelty double, structural double, "
    f"score double, summary string, tags {_SUGGESTIONS}, text string"
)


def _first_sentence(text: str) -> str | None:
    return next((s.strip(M._WS)[:200] for s in M.re.split("[.!?]+", text) if len(s.strip(M._WS)) > 10), None)


def blocks(docs: DataFrame, tagger: str = "unified", vocabulary: Sequence[tuple[str, str, str]] | None = None, compat: bool = False, synonyms: dict[str, str] | None = None) -> DataFrame:
    """One row per block of each document; docs has doc_id, text and tags (array<string>, may be null).

    Segmentation, scores and tags depend on one document only, so they are one narrow map: no shuffle, no state
    between documents. `tagger`: unified (gate 0.5, ten tags), rich (gate 0.3, five tags, with the tags of the last
    blocks), none. A null or empty text has no blocks.
    """
    terms = list(tag_terms() if vocabulary is None else vocabulary)
    exact = {t.lower(): t for _, t, _ in terms}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.strip().split(" ")[0] for c in _SCHEMA.replace(_SUGGESTIONS, "x").split(",")]
        for batch in batches:
            rows = []
            for doc, text, tags in zip(batch["doc_id"], batch["text"], batch["tags"]):
                if not text:
                    continue
                tags = [t for t in (tags if tags is not None else []) if t and t.strip()]
                found = M.segment(text)
                history: list[str] = []
                for i, (b, s) in enumerate(zip(found, M.scores(found, text, compat))):
                    t: list[M.Suggestion] = []
                    if tagger == "unified" and s["score"] >= M.UNIFIED["gate"]:
                        t = M.suggest_unified(b.text, terms, tags)
                    elif tagger == "rich" and s["score"] >= M.RICH["gate"]:
                        t = M.suggest_rich(b.text, b.kind, exact, tags, history, synonyms)
                        history = history[-M.RICH["history"] :] + [x[0] for x in t]
                    head = M.slug(b.heading) if b.heading else ""
                    brief = _first_sentence(b.text) if s["score"] >= M.WORTHY and b.kind == "paragraph" else None
                    rows.append((doc, i, head or f"block-{b.line}", b.line, b.end, b.kind, b.level, b.heading, s["topic_shift"], s["entity_density"], s["novelty"], s["structural"], s["score"], brief, t, b.text))
            out = pd.DataFrame(rows, columns=names)
            out["level"] = out["level"].astype("Int32")
            yield out

    return docs.select("doc_id", "text", "tags").mapInPandas(run, _SCHEMA)


def block_tags(b: DataFrame) -> DataFrame:
    """doc_id, place, id, tag, confidence, source, confirmed: suggestions exploded; those of 0.5 and more become tags."""
    t = b.select("doc_id", "place", "id", F.explode("tags").alias("t"))
    return t.select("doc_id", "place", "id", "t.tag", "t.confidence", "t.source", (F.col("t.confidence") >= M.CONFIRMED).alias("confirmed"))


def tag_index(tags: DataFrame, chunk: int = 100_000) -> DataFrame:
    """tag, chunk, refs: where each confirmed tag stands; a tag's list is split by ranges of `chunk` doc_ids."""
    c = tags.where("confirmed").select("tag", "doc_id", "place", "id")
    return c.groupBy("tag", F.floor(F.col("doc_id") / chunk).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "place", "id"))).alias("refs"))


def block_stats(b: DataFrame, tags: DataFrame) -> DataFrame:
    """One row: documents, blocks, worthy blocks, tags, distinct tags, blocks with pending suggestions, suggestions by source."""
    s = b.agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("blocks"), F.count_if(F.col("score") >= M.WORTHY).alias("worthy"))
    t = tags.agg(
        F.count_if("confirmed").alias("confirmed"), F.count_distinct(F.when(F.col("confirmed"), F.col("tag"))).alias("distinct_tags"),
        F.count_distinct(F.when(~F.col("confirmed"), F.struct("doc_id", "place"))).alias("pending"), *(F.count_if(F.col("source") == x).alias(f"from_{x}") for x in ("inline", "nlp", "existing")),
    )
    return s.join(F.broadcast(t))
