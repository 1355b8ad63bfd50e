"""Markdown blocks: segmentation, scoring and tag suggestions of one document; plain Python, run inside Arrow batches."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

_WS = " \t\n\r\f\x0b\xa0                　﻿"
_S = f"[{_WS}]"
_HEADING = re.compile(rf"(#{{1,6}}){_S}+([^\n\r  ]+)\Z")
_ITEM = re.compile(rf"^[-*+]|[0-9]+\.{_S}")
_RULE = re.compile(rf"\|?[{_WS}\-:|]+\|?\Z")
_CLOSED_TAG = re.compile(r"<[^>]+/>")
_HASHTAG = re.compile(r"#([a-zA-Z][a-zA-Z0-9_/-]*)")
_SPLIT = re.compile(r"[^a-z0-9_]+")
_BLANKS = re.compile(f"{_S}+")

# Shares of the signals in a block's score, structural scores, limits of the two taggers.
SHARES = {"topic_shift": 0.2, "entity_density": 0.25, "novelty": 0.2, "structural": 0.35}
STRUCTURE = {"code": 0.7, "table": 0.65, "blockquote": 0.5}
WORTHY, CONFIRMED = 0.5, 0.5
UNIFIED = {"gate": 0.5, "most": 10, "vocabulary": 0.7, "document": 0.5}
RICH = {"gate": 0.3, "most": 5, "least": 0.3, "vocabulary": 0.85, "history": 10, "synonym": 0.7}
# Patterns that name a code block's language, the first that matches wins.
LANGUAGES = (
    ("python", r"\b(def|import|from|class|self)\b"), ("javascript", r"\b(const|let|var|function|=>|async|await)\b"), ("typescript", r"\b(interface|type|enum|as|implements)\b"),
    ("rust", r"\b(fn|let|mut|impl|pub|mod)\b"), ("go", r"\b(func|package|import|defer|go|chan)\b"), ("sql", r"(?i)\b(SELECT|FROM|WHERE|JOIN|INSERT|UPDATE)\b"), ("bash", r"\b(echo|cd|ls|grep|awk|sed)\b"),
)
_LANGUAGES = tuple((name, re.compile(p, re.ASCII)) for name, p in LANGUAGES)


@dataclass
class Block:
    kind: str
    line: int
    end: int = 0
    level: int | None = None
    heading: str | None = None
    content: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return "\n".join(self.content)


def _kind(line: str, bare: str) -> str:
    """What a line outside code is, by itself."""
    if _HEADING.match(line):
        return "heading"
    if bare.startswith(">"):
        return "blockquote"
    if _ITEM.search(bare):
        return "list"
    if bare.startswith("|") or ("|" in bare and _RULE.match(bare)):
        return "table"
    if bare.startswith("<") and not bare.startswith("<!--"):
        return "html"
    return "paragraph" if bare else "blank"


#: Blocks that go on over further lines of their own kind.
_RUNS = {"blockquote", "list", "table"}


def segment(text: str) -> list[Block]:
    """Blocks of a text in order; lines count from 1.

    Fences are literal, headings and one-line tags stand alone, quotes, lists and tables are runs of their lines, and
    a paragraph goes on over blank lines. The first line after a table's start that is none of the run kinds ends
    whatever block is open then, even if the table itself has ended before.
    """
    blocks: list[Block] = []
    current: Block | None = None
    fenced = table_open = False

    def end(at: int) -> None:
        nonlocal current
        if current:
            current.end = at
            blocks.append(current)
            current = None

    lines = text.split("\n")
    for n, line in enumerate(lines, 1):
        bare = line.strip(_WS)
        if bare.startswith("```"):
            fenced = not fenced
            if fenced:
                end(n - 1)
                current = Block("code", n)
            else:
                current.content.append(line)
                end(n)
            continue
        if fenced:
            current.content.append(line)
            continue
        kind = _kind(line, bare)
        if kind not in _RUNS and kind != "heading" and table_open and current:
            end(n - 1)
            table_open = False
        if kind == "blank":
            if current and current.kind != "paragraph":
                end(n - 1)
            continue
        if kind in ("heading", "html") or not current or current.kind != kind:
            end(n - 1)
            current = Block(kind, n)
            table_open |= kind == "table"
        current.content.append(line)
        if kind == "heading":
            marks, title = _HEADING.match(line).groups()
            current.level, current.heading = len(marks), title.strip(_WS)
        if kind == "heading" or (kind == "html" and (bare.endswith(">") or _CLOSED_TAG.search(bare))):
            end(n)
    end(len(lines))
    return blocks


def words(text: str) -> list[str]:
    return [w for w in _SPLIT.split(text.lower()) if len(w) > 2]


def weights(tokens: Sequence[str], compat: bool = False) -> dict[str, float]:
    """Counts over the greatest count. `compat`: a token list that holds the word `constructor` weighs nothing, as in stored results of old."""
    n = Counter(tokens)
    top = max(n.values(), default=1)
    return dict.fromkeys(n, 0.0) if compat and "constructor" in n else {w: c / top for w, c in n.items()}


def similarity(a: dict[str, float], b: dict[str, float]) -> float:
    size = math.sqrt(math.fsum(x * x for x in a.values())) * math.sqrt(math.fsum(x * x for x in b.values()))
    return math.fsum(x * b[w] for w, x in a.items() if w in b) / size if size else 0.0


def density(text: str) -> float:
    w = [x for x in _BLANKS.split(text) if x]
    n = sum(bool(re.match("[A-Z][a-z]", x)) + bool(re.search("[a-z][A-Z]|_|^[A-Z]{2,}$", x)) + 0.5 * bool(re.search(r"[.:\[\]()<>{}]", x)) for x in w)
    return min(1.0, n / len(w)) if w else 0.0


def structure(b: Block, place: int, total: int) -> float:
    if b.kind == "heading":
        s = 1 - (b.level - 1) * 0.15
    elif b.kind == "list":
        s = min(0.6, 0.3 + len(b.content) * 0.05)
    else:
        s = STRUCTURE.get(b.kind) or min(0.5, 0.2 + len(_BLANKS.split(" ".join(b.content))) * 0.005)
    return min(1.0, max(0.0, s + 0.1 * (place < 3) + 0.05 * (place >= total - 2)))


def thousandth(x: float) -> float:
    """x to three decimals, halves up; what is half is decided at the ninth, below which sums depend on their order."""
    return math.floor(round(x, 9) * 1000 + 0.5) / 1000


def slug(text: str) -> str:
    return _BLANKS.sub("-", re.sub(f"[^a-z0-9_\\-{_WS}]", "", text.lower()).replace("_", " ")).strip("-")[:50]


def scores(blocks: list[Block], text: str, compat: bool = False) -> list[dict[str, float]]:
    """Signals and score of each block: change against the block before, entities, difference from the document, structure."""
    whole = weights(words(text), compat)
    out, before = [], None
    for i, b in enumerate(blocks):
        own = weights(words(b.text), compat)
        s = {
            "topic_shift": 1 - similarity(own, before) if before else 0.5,
            "entity_density": density(b.text),
            "novelty": 1 - similarity(own, whole) if whole else 0.5,
            "structural": structure(b, i, len(blocks)),
        }
        total = math.fsum(s[k] * share for k, share in SHARES.items())
        out.append({k: thousandth(v) for k, v in s.items()} | {"score": thousandth(total)})
        before = own
    return out


def inline_tags(text: str) -> list[tuple[str, int]]:
    """(tag, line of its first occurrence) of the hashtags of a block."""
    seen: dict[str, int] = {}
    for n, line in enumerate(text.split("\n"), 1):
        for t in _HASHTAG.findall(line):
            t = t.lower()
            if not re.fullmatch("h[1-6]", t):
                seen.setdefault(t, n)
    return list(seen.items())


Suggestion = tuple[str, float, str, int | None]


def suggest_unified(text: str, vocabulary: Sequence[tuple[str, str, str]], document_tags: Sequence[str]) -> list[Suggestion]:
    """(tag, confidence, source, line): inline tags, then vocabulary terms the text contains, then the document's tags; first of equal tags, ten at most."""
    low, tokens = text.lower(), set(words(text))
    found: dict[str, Suggestion] = {}
    for key, term, _ in vocabulary:
        if any(t in low or "".join(t.split()) in tokens for t in (key, term.lower())):
            found.setdefault(key, (key, UNIFIED["vocabulary"], "nlp", None))
    for t in document_tags:
        key = _BLANKS.sub("-", t.lower())
        found.setdefault(key, (key, UNIFIED["document"], "existing", None))
    out: dict[str, Suggestion] = {t: (t, 1.0, "inline", n) for t, n in inline_tags(text)}
    for s in list(found.values())[: UNIFIED["most"]]:
        out.setdefault(s[0], s)
    return list(out.values())[: UNIFIED["most"]]


def distance(a: str, b: str, most: int) -> int:
    """Edit distance, or most + 1 if it is greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def suggest_rich(text: str, kind: str, vocabulary: dict[str, str], document_tags: Sequence[str], history: Sequence[str], synonyms: dict[str, str] | None = None) -> list[Suggestion]:
    """(tag, confidence, source, line) from six sources in order: inline tags, vocabulary n-grams, related document tags, related
    tags of blocks before, salient words, code language. Of equal tags the first counts; the five most confident are returned."""
    if not text.strip(_WS):
        return []
    tokens = [w for w in re.split("[^a-z0-9_-]+", text.lower()) if len(w) > 2]
    grams = [" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)]
    out: list[Suggestion] = [(t, 1.0, "inline", n) for t, n in inline_tags(text)]
    other = synonyms or {}  # other names of a term, less sure than the term
    out += [(vocabulary[g], RICH["vocabulary"], "nlp", None) if g in vocabulary else (other[g], RICH["synonym"], "nlp", None) for g in grams if g in vocabulary or g in other]
    for tags, fuzzy, top, base in ((document_tags, True, 0.75, 0.4), (history, False, 0.7, 0.35)):
        for t in tags:
            low = t.lower()
            n = sum(low in w or w in low or (fuzzy and distance(w, low, 2) <= 2) for w in tokens)
            if n:
                out.append((t, min(top, base + n * 0.1), "existing", None))
    counts = Counter(tokens)
    most = max(counts.values(), default=1)
    salient = sorted(((w, 1.5 * n / (1.5 * most)) for w, n in counts.items() if len(w) > 3), key=lambda x: -x[1])
    out += [(w, min(0.6, 0.5 * s), "nlp", None) for w, s in [x for x in salient if x[1] > 0.3][:3] if w not in vocabulary]
    if kind == "code":
        out += [(name, 0.8, "nlp", None) for name, p in _LANGUAGES if p.search(text)][:1]
    first: dict[str, Suggestion] = {}
    for s in out:
        if s[1] >= RICH["least"]:
            first.setdefault(s[0].lower(), s)
    return sorted(first.values(), key=lambda s: (-s[1], s[2] != "inline"))[: RICH["most"]]
