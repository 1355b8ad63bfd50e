"""Skills named by code fences, imports, text patterns and word lists; JVM-side expressions."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, functions as F

from corpusmill.functions.markdown import LANGUAGES

# Fence language to skill.
FENCES = {
    "javascript": "javascript", "js": "javascript", "typescript": "typescript", "ts": "typescript", "python": "python", "py": "python", "rust": "rust", "rs": "rust", "go": "go", "golang": "go",
    "java": "java", "csharp": "csharp", "cs": "csharp", "cpp": "cpp", "c": "c", "ruby": "ruby", "rb": "ruby", "php": "php", "swift": "swift", "kotlin": "kotlin", "kt": "kotlin", "scala": "scala",
    "sql": "sql", "bash": "shell", "sh": "shell", "zsh": "shell", "shell": "shell", "powershell": "powershell", "ps1": "powershell", "html": "html", "css": "css", "scss": "css", "sass": "css", "less": "css",
    "yaml": "yaml", "yml": "yaml", "json": "json", "xml": "xml", "graphql": "graphql", "gql": "graphql", "dockerfile": "docker", "terraform": "terraform", "tf": "terraform", "hcl": "terraform",
    "jsx": "react", "tsx": "react", "vue": "vue", "svelte": "svelte",
}
# Package to skill; the first key in this order that the package equals or begins with counts.
PACKAGES = {
    "react": "react", "react-dom": "react", "react-router": "react", "next": "nextjs", "next/": "nextjs", "gatsby": "gatsby", "@tanstack/react-query": "react-query", "react-query": "react-query",
    "redux": "redux", "@reduxjs/toolkit": "redux", "react-redux": "redux", "zustand": "zustand", "jotai": "jotai", "recoil": "recoil", "mobx": "mobx",
    "vue": "vue", "@vue/": "vue", "nuxt": "nuxt", "@nuxt/": "nuxt", "pinia": "pinia", "vuex": "vuex",
    "express": "express", "fastify": "fastify", "koa": "koa", "nestjs": "nestjs", "@nestjs/": "nestjs", "hapi": "hapi", "@hapi/": "hapi",
    "mongoose": "mongodb", "mongodb": "mongodb", "pg": "postgresql", "postgres": "postgresql", "mysql": "mysql", "mysql2": "mysql", "prisma": "prisma", "@prisma/client": "prisma",
    "typeorm": "typeorm", "sequelize": "sequelize", "drizzle-orm": "drizzle", "redis": "redis", "ioredis": "redis",
    "jest": "jest", "@jest/": "jest", "vitest": "vitest", "mocha": "mocha", "chai": "mocha", "cypress": "cypress", "playwright": "playwright", "@playwright/": "playwright",
    "testing-library": "testing-library", "@testing-library/": "testing-library", "webpack": "webpack", "vite": "vite", "rollup": "rollup", "esbuild": "esbuild", "parcel": "parcel",
    "aws-sdk": "aws", "@aws-sdk/": "aws", "@azure/": "azure", "@google-cloud/": "gcp", "docker": "docker", "kubernetes": "kubernetes", "@kubernetes/": "kubernetes",
    "graphql": "graphql", "@graphql/": "graphql", "apollo": "apollo", "@apollo/": "apollo", "urql": "urql",
    "passport": "authentication", "jsonwebtoken": "jwt", "next-auth": "authentication", "@auth/": "authentication", "oauth": "oauth",
    "django": "django", "flask": "flask", "fastapi": "fastapi", "pandas": "pandas", "numpy": "numpy", "tensorflow": "tensorflow", "torch": "pytorch", "pytorch": "pytorch",
    "sklearn": "scikit-learn", "scikit-learn": "scikit-learn",
}
# Import statements; the group is the package.
IMPORTS = (
    r"import\s+(?:[\w{},\s*]+\s+from\s+)?['\"]([^'\"]+)['\"]",
    r"require\s*\(\s*['\"]([^'\"]+)['\"]\s*\)",
    r"from\s+(\w+)",
    r"(?m)^import\s+(\w+)",
    r"use\s+([\w:]+)",
)
# Pattern (without case) to skill.
PATTERNS = (
    (r"git\s+(clone|commit|push|pull|merge|rebase|branch)", "git"), (r"\.git(hub|lab|ignore)", "git"), (r"docker\s+(build|run|compose|image|container)", "docker"), (r"Dockerfile|docker-compose", "docker"),
    (r"kubectl|k8s|kubernetes", "kubernetes"), (r"\.ya?ml.*kind:\s*(Deployment|Service|Pod|ConfigMap)", "kubernetes"), (r"github\s*actions?|\.github/workflows", "github-actions"),
    (r"gitlab-ci|\.gitlab-ci\.yml", "gitlab-ci"), (r"jenkins(file)?", "jenkins"), (r"REST\s*API|RESTful", "rest-api"), (r"GraphQL\s*(query|mutation|subscription)", "graphql"),
    (r"WebSocket|Socket\.io|ws:", "websockets"), (r"useState|useReducer|useContext", "react-hooks"), (r"createStore|configureStore|createSlice", "redux"),
    (r"describe\s*\(|it\s*\(|test\s*\(|expect\s*\(", "testing"), (r"mock|stub|spy|fixture", "testing"), (r"SELECT\s+.*\s+FROM|INSERT\s+INTO|UPDATE\s+.*\s+SET", "sql"),
    (r"CREATE\s+TABLE|ALTER\s+TABLE|DROP\s+TABLE", "sql"), (r"MongoDB|\.find\(|\.aggregate\(|\.insertOne\(", "mongodb"), (r"bcrypt|argon2|scrypt|hash.*password", "security"),
    (r"JWT|Bearer\s+token|OAuth|OIDC", "authentication"), (r"XSS|CSRF|SQL\s*injection|sanitize", "security"), (r"async\s+function|await\s+|Promise\.|\.then\(", "async-programming"),
    (r"Observable|RxJS|subscribe\(", "reactive-programming"),
)
# Two words of a list make the skill.
SOFT = {
    "collaboration": ("team", "collaborate", "together", "pair", "mob", "review", "feedback"), "communication": ("communicate", "document", "explain", "present", "write", "read"),
    "problem-solving": ("solve", "debug", "fix", "troubleshoot", "investigate", "analyze"), "continuous-learning": ("learn", "understand", "study", "research", "explore", "discover"),
}


def code_language(code: Column) -> Column:
    """Language of a piece of code by the first pattern that matches, null if none does."""
    c = None
    for name, pattern in LANGUAGES:
        c = F.when(code.rlike(pattern), name) if c is None else c.when(code.rlike(pattern), name)
    return c


def fence_languages(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"```(\w+)"), F.lit(1)), F.lower)


def fence_skills(text: Column) -> Column:
    """Distinct skills of the code fences: a literal map, no join."""
    table = F.create_map(*[F.lit(x) for kv in FENCES.items() for x in kv])
    return F.array_sort(F.array_distinct(F.filter(F.transform(fence_languages(text), lambda w: F.try_element_at(table, w)), lambda s: s.isNotNull())))


def guards(pattern: str) -> list[str]:
    """For each top-level alternative of a pattern a literal that every match holds (lower case, the longest); empty if one has none."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(pattern):
        if c in "([" and pattern[i - 1 : i] != "\\":
            depth += 1
        elif c in ")]" and pattern[i - 1 : i] != "\\":
            depth -= 1
        elif c == "|" and not depth:
            parts.append(pattern[start:i])
            start = i + 1
    parts.append(pattern[start:])
    out = []
    for p in parts:
        while p != (q := re.sub(r"(?<!\\)\([^()]*\)\??|(?<!\\)\[[^\]]*\][?*+]?", " ", p)):
            p = q
        p = re.sub(r"\\([.(/])", r"\1", re.sub(r"\\[swb][*+?]?|\.[*+?]|.\?", " ", p.replace("\\.", "\0"))).replace("\0", ".")
        best = max(p.split(), key=len, default="")
        if not best:
            return []
        out.append(best.lower())
    return out


def guarded(text: Column, low: Column, pattern: str, flags: str = "(?i)") -> Column:
    """Whether the text matches; a search for the pattern's literals, which is far cheaper, comes first."""
    hit = None
    for g in guards(pattern):
        hit = F.contains(low, F.lit(g)) if hit is None else hit | F.contains(low, F.lit(g))
    match = text.rlike(flags + pattern)
    return match if hit is None else hit & match


def imported(text: Column) -> Column:
    """Distinct packages of all import statements, lower case."""
    none = F.array().cast("array<string>")
    found = [F.when(F.contains(text, F.lit(word)), F.regexp_extract_all(text, F.lit(p), F.lit(1))).otherwise(none) for word, p in zip(("import", "require", "from", "import", "use"), IMPORTS)]
    return F.array_distinct(F.transform(F.concat(*found), F.lower))


def package_skill(package: Column) -> Column:
    """Skill of the first key that the package begins with; null if there is none."""
    c = None
    for key, skill in PACKAGES.items():
        c = F.when(package.startswith(key), skill) if c is None else c.when(package.startswith(key), skill)
    return c


def pattern_skills(text: Column) -> Column:
    """Distinct skills of which a pattern matches the text."""
    low = F.lower(text)
    by: dict[str, Column] = {}
    for p, s in PATTERNS:
        by[s] = by[s] | guarded(text, low, p) if s in by else guarded(text, low, p)
    return F.array_sort(F.filter(F.array(*[F.when(c, s) for s, c in by.items()]), lambda x: x.isNotNull()))


def soft_skills(text: Column) -> Column:
    """Skills of which at least two words occur, whole words only; inflected forms do not count."""
    low = F.lower(text)
    some = lambda ws: functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in ws])
    hits = [F.when(some(ws) & (F.regexp_count(low, F.lit(r"\b(" + "|".join(ws) + r")\b")) >= 2), s) for s, ws in SOFT.items()]
    return F.array_sort(F.filter(F.array(*hits), lambda x: x.isNotNull()))
