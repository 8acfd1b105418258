"""Code blocks of Markdown documents with the text and headings around them.

Each line of a document is tagged once (fence, code, heading, prose). A heading's path is made of the headings before it,
and a section is what lies between two headings; so a section's number is the number of headings before it that close one.
"""

from __future__ import annotations

import hashlib
import re
import textwrap
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Languages of the code that is kept, patterns of lines, words of a doc text.
CODE_LANGUAGES = ("javascript", "typescript", "js", "ts", "arkts")
FENCE = re.compile(r"^\s*```([^\s`]+)?\s*$")
HEADING = re.compile(r"^(#{1,6})\s+(.*)$")
PROPERTY = re.compile(r"^\s*-\s*\[(\w+)\]\((.*?)\):\s*(.*)$")
BULLET = re.compile(r"^\s*-\s*(.*)$")
EVENT_WORDS = ("onClick", "onTouch")
RECORD = "id string, project_name string, path string, text string, section int, code int, kind string"


def tagged(lines: list[str]) -> Iterator[tuple[str, str, str]]:
    """(kind, fence's language, line): a fence line toggles, headings within a fence are code."""
    language: str | None = None
    for line in lines:
        fence = FENCE.match(line)
        if fence:
            yield ("close" if language is not None else "open"), (language or ""), line
            language = None if language is not None else (fence.group(1) or "").lower()
        elif language is not None:
            yield "code", language, line
        else:
            yield ("heading" if HEADING.match(line) else "prose"), "", line


def heading_paths(headings: list[str]) -> list[str]:
    """Of each heading its own and the titles above it, joined by `` / ``. A heading of level n leaves at most n - 1 of
    the titles before it, whatever levels those had."""
    above: list[str] = []
    out = []
    for h in headings:
        marks, title = HEADING.match(h).groups()
        above = [*above[: len(marks) - 1], title.strip()]
        out.append(" / ".join(above))
    return out


def sections(text: str) -> list[dict]:
    """title, doc text and code blocks (language, code) of each section. A section without a title counts if it holds a
    line or a block, one with a title always. A fence that is not closed gives no code."""
    tags = list(tagged((text or "").splitlines()))
    titles = ["", *heading_paths([line for kind, _, line in tags if kind == "heading"])]
    number, parts = 0, [[] for _ in titles]
    for tag in tags:
        number += tag[0] == "heading"
        if tag[0] != "heading":
            parts[number].append(tag)
    found = []
    for title, own in zip(titles, parts):
        codes, held, language = [], [], ""
        for kind, _, line in own:
            if kind == "open":
                held, language = [], (FENCE.match(line).group(1) or "").lower()
            elif kind == "code":
                held.append(line)
            elif kind == "close":
                codes.append((language, "\n".join(held)))
        prose = [line for kind, _, line in own if kind == "prose"]
        if title or prose or codes:
            found.append({"title": title, "doc": "\n".join(prose).strip(), "codes": codes})
    return found


def plain(text: str) -> str:
    linked = re.sub(r"\[([^\]]+)\]\([^)]+\)", r"\1", text)
    return re.sub(r"!\[[^\]]*\]\([^)]+\)", "", linked).strip()


def properties_and_events(docs: list[str]) -> tuple[list[str], list[str]]:
    """Described properties, and bullets that name a click or touch handler: each once, in order of the alphabet."""
    lines = [line for d in docs for line in d.splitlines()]
    described = {f"- {m.group(1)}: {m.group(3)}" for line in lines if (m := PROPERTY.match(line))}
    events = {f"- {m.group(1)}" for line in lines if not PROPERTY.match(line) and any(w in line for w in EVENT_WORDS) and (m := BULLET.match(line))}
    return sorted(described), sorted(events)


def doc_text(title: str, summary: str, described: list[str], events: list[str]) -> str:
    """The section, its summary, and the document's properties and events; what is empty is left out."""
    blocks = (("Summary:", [summary] if summary.strip() else []), ("Props:", described), ("Events:", events))
    told = [f"Section: {title}"] * bool(title)
    return "\n".join(told + [x for name, lines in blocks if lines for x in (name, *map(plain, lines))])


def doc_records(path: str, text: str, project: str = "docs") -> list[tuple]:
    """Two records a code block in a kept language: the doc text with the code, and the code alone. Their ids hold the
    path's hash, the section, the block and the code's hash."""
    sha1 = lambda s: hashlib.sha1(s.encode()).hexdigest()
    found = sections(text)
    described, events = properties_and_events([s["doc"] for s in found if s["doc"]])
    out = []
    for s, section in enumerate(found):
        for c, (language, code) in enumerate(section["codes"]):
            if language not in CODE_LANGUAGES or not code.strip():
                continue
            code = textwrap.dedent(code).strip()
            key = f"{sha1(path or '')}_{s}_{c}_{sha1(code)[:8]}"
            told = doc_text(section["title"], plain(section["doc"]), described, events)
            out.append((f"doc_inject:{key}", project, path, f"<DOC>\n{told}\n</DOC>\n<CODE>\n{code}\n</CODE>", s, c, "doc_inject"))
            out.append((f"pure_code:{key}", project, path, code, s, c, "pure_code"))
    return out


def extract(pages: DataFrame, *, path_col: str = "path", text_col: str = "text", project: str = "docs") -> DataFrame:
    """The records of all pages, ``kind`` doc_inject or pure_code. Release notes are skipped; null texts have no records."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([r for p, t in zip(f["path"], f["text"]) for r in doc_records(p, t, project)], columns=["id", "project_name", "path", "text", "section", "code", "kind"])

    kept = pages.where(~F.lower(F.coalesce(F.col(path_col), F.lit(""))).contains("release-notes"))
    return kept.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")).mapInPandas(run, RECORD)


def html_to_text(html):
    """Tags, scripts and styles go; white space runs become one space."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))
