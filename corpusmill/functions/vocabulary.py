"""Controlled vocabularies: a small built-in one, and a loader for directories of term files."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from corpusmill.functions.stem import stem_term
from corpusmill.functions.text import STOP_WORDS

#: Term files of the package.
SHIPPED = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "vocab")
# The vocabulary used where no directory is given or it cannot be read.
FALLBACK = {
    "subjects": {
        "technology": ("api", "code", "software", "programming", "development"),
        "science": ("research", "study", "experiment", "hypothesis", "theory"),
        "philosophy": ("ethics", "morality", "existence", "consciousness"),
        "ai": ("artificial intelligence", "machine learning", "neural", "model"),
        "knowledge": ("information", "data", "wisdom", "learning", "documentation"),
    },
    "topics": {
        "getting-started": ("tutorial", "guide", "introduction", "beginner"),
        "architecture": ("design", "structure", "pattern", "system"),
        "troubleshooting": ("error", "issue", "problem", "fix", "debug"),
    },
    "difficulty": {
        "beginner": ("basic", "simple", "intro", "fundamental", "easy"),
        "intermediate": ("moderate", "practical", "hands-on", "implement"),
        "advanced": ("complex", "expert", "optimization", "performance"),
    },
    "skills": {},
}
# Words near a term that make its technical sense less or more likely.
NEGATIVE = {
    "library": ("physical", "book", "public", "municipal", "lending", "card"),
    "learning": ("curve", "disability", "difficulties", "disorder"),
    "framework": ("legal", "regulatory", "policy", "theoretical"),
    "model": ("fashion", "role", "scale", "3d", "clay"),
    "platform": ("train", "station", "political", "diving"),
    "cloud": ("weather", "rain", "storm", "sky"),
    "node": ("lymph", "musical"),
    "tree": ("oak", "pine", "forest", "christmas"),
    "branch": ("bank", "tree", "office"),
    "shell": ("sea", "beach", "turtle", "egg"),
    "root": ("plant", "tree", "vegetable", "carrot"),
}
POSITIVE = {
    "library": ("code", "import", "npm", "package", "install", "dependency", "software"),
    "learning": ("machine", "deep", "model", "neural", "ai", "training"),
    "framework": ("web", "software", "javascript", "python", "backend", "frontend"),
    "model": ("machine", "learning", "neural", "language", "ai", "trained"),
    "platform": ("cloud", "software", "development", "api", "saas"),
}
TAGS = {
    "subjects": ("computing", "knowledge-systems", "education", "ai", "design"),
    "topics": ("architecture", "ingestion", "schema", "rag", "graph"),
    "subtopics": ("api", "pipelines", "metadata", "search", "embeddings", "indexing"),
}


def read_terms(path: str, stems_last: bool = False) -> list[str]:
    """Normalised terms of a file, each with its stem or all stems last, in order, without repeats; # starts a comment line, a BOM is skipped."""
    out: dict[str, None] = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            if line.strip() and not line.lstrip().startswith("#"):
                for raw in line.split():
                    term = re.sub("^-|-$", "", re.sub("-+", "-", re.sub("[^a-z0-9-]", "", raw.lower())))
                    if term:
                        out[term] = None
    pairs = [(t, stem_term(t)) for t in out]
    return list(dict.fromkeys([*out, *(s for _, s in pairs)] if stems_last else [x for p in pairs for x in p]))


@dataclass
class Vocabulary:
    """category -> name -> terms, and the stop words. Small by nature: it is written by hand."""

    categories: dict[str, dict[str, tuple[str, ...]]] = field(default_factory=lambda: FALLBACK)
    stop_words: tuple[str, ...] = STOP_WORDS

    @classmethod
    def load(cls, directory: str | None, stems_last: bool = False) -> Vocabulary:
        """`<directory>/<category>/<name>.txt` and `stopwords.txt`; the built-in vocabulary if that fails."""
        try:
            cats = {c.name: {f.name[:-4]: tuple(read_terms(f.path, stems_last)) for f in sorted(os.scandir(c.path), key=lambda e: e.name) if f.name.endswith(".txt")} for c in sorted(os.scandir(directory or ""), key=lambda e: e.name) if c.is_dir()}
            stop = os.path.join(directory or "", "stopwords.txt")
            return cls(cats, tuple(read_terms(stop)) if os.path.exists(stop) else STOP_WORDS) if any(cats.values()) else cls()
        except OSError:
            return cls()

    @classmethod
    def shipped(cls) -> Vocabulary:
        """The term files of the package; an error, not the built-in vocabulary, if they cannot be read."""
        v = cls.load(SHIPPED, stems_last=True)
        if v.categories is FALLBACK:
            raise FileNotFoundError(f"no term files in {SHIPPED}")
        return v

    def stats(self) -> dict[str, dict[str, int]]:
        return {c: {n: len(t) for n, t in names.items()} for c, names in self.categories.items()}

    def rows(self) -> list[tuple[str, str, int, str]]:
        return [(c, n, i, t) for c, names in self.categories.items() for n, terms in names.items() for i, t in enumerate(terms)]

    def table(self, spark: SparkSession) -> DataFrame:
        """category, name, ord, term."""
        return spark.createDataFrame(self.rows(), "category string, name string, ord int, term string")


def tag_terms(tags: dict | None = None) -> list[tuple[str, str, str]]:
    """(key, term, category) of a tag taxonomy of lists or of nested objects; the keys of the taxonomy are terms too."""
    out: dict[str, tuple[str, str]] = {}

    def walk(node: dict, parent: str) -> None:
        for key, value in node.items():
            out["-".join(str(key).lower().split())] = (str(key), parent)
            if isinstance(value, dict):
                walk(value, str(key))
            elif isinstance(value, (list, tuple)):
                out.update({"-".join(v.lower().split()): (v, str(key)) for v in value if isinstance(v, str)})

    walk(TAGS if tags is None else tags, "")
    return [(k, t, c) for k, (t, c) in out.items()]
