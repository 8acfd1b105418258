"""Record shaping (P1 to P17) and named scalars."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamworks.functions.text import strip
from loamworks.operators import ordering

# Sections of a completion prompt.
ABOVE = r"(?s)The context above the method is:\n```arkts\n(.*?)```\n\nAnd here is the code snippet you are asked to complete"
SNIPPET = r"(?s)And here is the code snippet you are asked to complete:\n```arkts\n(.*?)```\n\nEnsure that only missing codes"
BELOW = r"(?s)The context below the method is:\n```arkts\n(.*?)```\n\nThe context above the method is"
IMPORTED = r"(?s)Below are some information from external classes imported by current file:\n```arkts\n(.*?)\n```"
RESPONSE = r"(?s)```arkts\n(.*?)\n```"
TAG = "<unused98>"

# File endings and their languages in order of precedence; of an ending that comes twice the first place and
# the last language count.
LANGUAGES = dict(
    line.split(" ", 1)
    for line in """
.py Python
.js JavaScript
.ts TypeScript
.jsx React JSX
.tsx React TSX
.rb Ruby
.java Java
.cpp C++
.c C
.cs C#
.php PHP
.go Go
.rs Rust
.zig Zig
.swift Swift
.kt Kotlin
.scala Scala
.r R
.m Objective-C
.mm Objective-C++
.pl Perl
.sh Shell
.bash Bash
.zsh Zsh
.fish Fish
.ps1 PowerShell
.bat Batch
.cmd Command
.sql SQL
.html HTML
.htm HTML
.css CSS
.scss SCSS
.sass Sass
.less Less
.xml XML
.yaml YAML
.yml YAML
.json JSON
.toml TOML
.ini INI
.cfg Config
.conf Config
.md Markdown
.txt Text
.log Log
.lock Lock
.gitignore Git
.dockerfile Docker
.dockerignore Docker
.env Environment
.properties Properties
.gradle Gradle
.pom.xml Maven
.sbt SBT
.cabal Cabal
.cargo Cargo
.composer.json Composer
.package.json NPM
.requirements.txt Python
.setup.py Python
.pyproject.toml Python
.poetry.lock Python
.Pipfile Python
.Pipfile.lock Python
.gemfile Ruby
.gemfile.lock Ruby
.go.mod Go
.go.sum Go
.Cargo.toml Rust
.Cargo.lock Rust
.mix.exs Elixir
.mix.lock Elixir
.deps.edn Clojure
.project.clj Leiningen
.build.sbt Scala
.build.sc Scala
.build.gradle Gradle
.build.gradle.kts Gradle
.settings.gradle Gradle
.settings.gradle.kts Gradle
.gradle.properties Gradle
.gradle-wrapper.properties Gradle
.gradle-wrapper.jar Gradle
.mvn Maven
.mvn/wrapper/maven-wrapper.properties Maven
.mvn/wrapper/maven-wrapper.jar Maven
.npmrc NPM
.yarnrc Yarn
.yarn.lock Yarn
.pnpm-lock.yaml PNPM
.bowerrc Bower
.bower.json Bower
.composer.lock Composer
.nuget.config NuGet
.packages.config NuGet
.paket.dependencies Paket
.paket.lock Paket
.stack.yaml Stack
.stack.yaml.lock Stack
.cabal.project Cabal
.cabal.project.local Cabal
.cabal.project.local~ Cabal
.cabal.project.local.bak Cabal
.cabal.project.local.old Cabal
.cabal.project.local.new Cabal
.cabal.project.local.tmp Cabal
.cabal.project.local.temp Cabal
.cabal.project.local.swp Cabal
.cabal.project.local.swo Cabal
.cabal.project.local.bak~ Cabal
.cabal.project.local.old~ Cabal
.cabal.project.local.new~ Cabal
.cabal.project.local.tmp~ Cabal
.cabal.project.local.temp~ Cabal
.cabal.project.local.swp~ Cabal
.cabal.project.local.swo~ Cabal
.vue Vue
.dart Dart
.asm Assembly
.s Assembly
.graphql GraphQL
.gql GraphQL
.sol Solidity
.hs Haskell
.lhs Haskell
.elm Elm
.clj ClojureScript
.edn Clojure
.ex Elixir
.exs Elixir
.erl Erlang
.hrl Erlang
.fs F#
.fsx F#
.fsi F#
.ml OCaml
.mli OCaml
.re Reason
.rei Reason
.nim Nim
.cr Crystal
.jl Julia
.lua Lua
.tcl Tcl
.v Verilog
.sv SystemVerilog
.vhd VHDL
.vhdl VHDL
.coffee CoffeeScript
.litcoffee CoffeeScript
.iced IcedCoffeeScript
.ls LiveScript
.cljs ClojureScript
.cljc ClojureScript
.cljx ClojureScript
.cljs.edn ClojureScript
.boot Boot
.lein Leiningen
.profiles.clj Leiningen
.user.clj Leiningen
.user.clj.bak Leiningen
.user.clj.old Leiningen
.user.clj.new Leiningen
.user.clj.tmp Leiningen
.user.clj.temp Leiningen
.user.clj.swp Leiningen
.user.clj.swo Leiningen
.user.clj.bak~ Leiningen
.user.clj.old~ Leiningen
.user.clj.new~ Leiningen
.user.clj.tmp~ Leiningen
.user.clj.temp~ Leiningen
.user.clj.swp~ Leiningen
.user.clj.swo~ Leiningen
""".strip().splitlines()
)


def stable_id(path: Column) -> Column:
    """SHA-256 of the path; a random id for an empty one."""
    return F.when(F.coalesce(path, F.lit("")) != "", F.sha2(path, 256)).otherwise(F.uuid())


def raw_sample(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("relative_path", "path").withColumn("id", F.sha2("path", 256))


def starcoder_records(df: DataFrame) -> DataFrame:
    """path, project_name, text, id; blank content goes. The id is a hash of project, path and text, so it is stable."""
    name = F.col("max_stars_repo_name")
    project = F.when(name.contains("/"), F.element_at(F.split(name, "/", 2), 2)).otherwise(name)
    kept = df.where(strip(F.coalesce("content", F.lit(""))) != "")
    return kept.select(F.col("max_stars_repo_path").alias("path"), project.alias("project_name"), F.col("content").alias("text")).withColumn(
        "id", F.concat_ws(":", F.coalesce("project_name", F.lit("")), F.coalesce("path", F.lit("")), F.substring(F.sha2("text", 256), 1, 32))
    )


def field_text(value: Column, kind: str = "string") -> Column:
    """One of the three fields of a completion record as text: a list's items that aren't empty, line by line."""
    if kind.startswith("array"):
        return F.coalesce(F.array_join(F.filter(value, lambda x: x != ""), "\n"), F.lit(""))
    if kind.startswith(("struct", "map")):
        return F.coalesce(F.regexp_replace(F.to_json(value), r"^\{|\}$", ""), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))


def fields_records(df: DataFrame, fields: tuple[str, str, str] = ("above_functions", "source_method_code", "below_functions")) -> DataFrame:
    """id, path, project_name, text: the fields joined without a separator; a record that lacks one has an empty text."""
    kinds = dict(df.dtypes)
    joined = F.concat(*[field_text(F.col(f), kinds[f]) for f in fields]) if all(f in kinds for f in fields) else F.lit("")
    whole = F.when(F.expr(" or ".join(f"`{f}` is null" for f in fields if f in kinds) or "false"), F.lit("")).otherwise(joined)
    return df.select(stable_id(F.col("filePath")).alias("id"), F.col("filePath").alias("path"), F.col("projectName").alias("project_name"), whole.alias("text"))


def prompt_text(prompt: Column) -> Column:
    """What comes above, the snippet, what comes below; closing line feeds go."""
    parts = [F.nullif(F.regexp_extract(prompt, p, 1), F.lit("")) for p in (ABOVE, SNIPPET, BELOW)]
    return F.regexp_replace(F.concat_ws("\n\n", *parts), r"\n+\z", "")


def imported_code(prompt: Column) -> Column:
    return F.regexp_extract(prompt, IMPORTED, 1)


def response_code(response: Column) -> Column:
    return F.regexp_extract(response, RESPONSE, 1)


def project_of(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.regexp_replace(url, "/+$", ""), r"\.git$", ""), "/"), -1)


def prompt_records(df: DataFrame) -> DataFrame:
    """id, path, project_name, text; a row whose tag can't be filled in, or without text, goes."""
    text, code = prompt_text(F.col("prompt")), response_code(F.col("response"))
    has = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    out = df.withColumn("__t", text).withColumn("__c", code)
    filled = F.when(F.col("__t").contains(TAG), F.when(F.col("__c") != "", F.replace(F.col("__t"), F.lit(TAG), F.col("__c")))).otherwise(F.col("__t"))
    out = out.select(F.coalesce(has("relativePath"), project_of(F.col("repoUrl"))).alias("path"), F.coalesce(has("projectName"), project_of(F.col("repoUrl"))).alias("project_name"), filled.alias("text"))
    return out.where((F.coalesce("text", F.lit("")) != "") & ~F.col("text").contains(TAG)).select(stable_id(F.col("path")).alias("id"), "path", "project_name", "text")


def record_kind(columns: list[str]) -> str:
    if not {"above_functions", "source_method_code", "below_functions"} - set(columns):
        return "fields"
    return "prompt" if "prompt" in columns else "fields"


def text_field(columns: list[str]) -> str | None:
    """Which column holds the text."""
    return next((c for c in ("text", "content", "code") if c in columns), None)


def with_text(df: DataFrame) -> DataFrame:
    """The table with a column ``text``: its own, else ``content``, else ``code``; a table with none of them has no rows to
    go on with and comes back empty."""
    found = text_field(df.columns)
    if found is None:
        return df.limit(0).withColumn("text", F.lit(None).cast("string"))
    return df if found == "text" else df.withColumn("text", F.col(found))


def parsed(line: Column, ddl: str) -> Column:
    """A line's JSON object as a struct; null for anything else, blank lines included."""
    return F.when(line.rlike(r"^\s*\{"), F.from_json(line, ddl, {"mode": "PERMISSIVE"}))


def concat_statistics(df: DataFrame, kind: str | None = None) -> DataFrame:
    """One row of counters over raw completion records: how many, processed by kind, skipped, with missing fields, tags
    replaced or not (and the paths of the latter, sorted), ids made from a path, fields renamed, imported code found."""
    kind = kind or record_kind(df.columns)
    has = lambda c: F.col(c) if c in df.columns else F.lit(None)
    some = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""
    zero = F.lit(0).cast("long")
    fields, prompts = kind == "fields", kind == "prompt"
    lacks = F.lit(False)
    for f in ("above_functions", "source_method_code", "below_functions"):
        lacks = lacks | has(f).isNull()
    tagged = F.coalesce(prompt_text(has("prompt").cast("string")).contains(TAG), F.lit(False))
    filled = tagged & (F.coalesce(response_code(has("response").cast("string")), F.lit("")) != "")
    path = has("filePath") if fields else F.coalesce(has("relativePath").cast("string"), project_of(has("repoUrl").cast("string")))
    renamed = [F.count_if(has(c).isNotNull()) for c in (("projectName", "filePath") if fields else ("projectName", "relativePath"))]
    count = lambda on, c: (F.count_if(c) if on else zero)
    return df.agg(
        F.count("*").alias("total"),
        count(fields, ~lacks).alias("fields_processed"),
        count(prompts, some(prompt_text(has("prompt").cast("string"))) & (~tagged | filled)).alias("prompt_processed"),
        count(not (fields or prompts), F.lit(True)).alias("skipped"),
        count(fields, lacks).alias("missing_fields"),
        count(prompts, filled).alias("tags_replaced"),
        count(prompts, tagged & ~filled).alias("tags_left"),
        F.array_sort(F.collect_set(F.when(F.lit(prompts) & tagged & ~filled, path.cast("string")))).alias("left_paths"),
        F.count_if(some(path)).alias("ids_from_path"),
        (renamed[0] + renamed[1]).alias("fields_renamed"),
        count(prompts, some(imported_code(has("prompt").cast("string")))).alias("imported_found"),
    )


def repo_rollup(status: DataFrame) -> DataFrame:
    """status, n, percent of (repo, status): scans, repairs or downloads."""
    from loamworks.operators.tokens import distribution

    return distribution(status, "status")


def _in_order(df: DataFrame, order: list[Column | str], place: str | None) -> DataFrame:
    return df.orderBy(*order) if place is None else ordering.ranked(df, *order).withColumnRenamed("position", place)


def in_split_order(df: DataFrame, column: str = "split", *order: str, place: str | None = None) -> DataFrame:
    """Training, validation, test and unused rows, then the rest, each by ``order``. With ``place``, the rows are not
    sorted but have that column: their places in this order, from 0."""
    rank = F.when(F.col(column) == "train", 0).when(F.col(column) == "valid", 1).when(F.col(column) == "test", 2).when(F.col(column) == "unused", 3).otherwise(4)
    return _in_order(df, [rank, *order], place)


def by_project(df: DataFrame, *order: str, place: str | None = None) -> DataFrame:
    """By project, rows without one first, then by ``order``. ``place`` as for ``in_split_order``."""
    return _in_order(df, [F.coalesce("project_name", F.lit("")), *order], place)


def head_for(main: DataFrame, other: DataFrame, ratio: float, *order: str) -> DataFrame:
    """As many of the main corpus's first rows as ``ratio`` times the other's rows."""
    return main.orderBy(*order).limit(int(other.count() * ratio))


def language_of(path: Column, table: dict[str, str] = LANGUAGES) -> Column:
    """Of a path that starts with a dot the whole, else by the last ending, all endings, then the first entry that the path
    contains; ``Unknown`` for any other. A null path is unknown."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    bare = F.lower(F.regexp_replace(name, r"^\.+", ""))
    last = F.regexp_extract(bare, r"(\.[^.]+)$", 1)
    inner = F.when(~bare.endswith("."), F.regexp_extract(bare, r"^[^.]*(\..*)$", 1))
    known = F.from_json(F.lit(json.dumps(table)), "map<string, string>")  # one literal: so many would outgrow a compiled method
    low = F.lower(path)
    pairs = F.from_json(F.lit(json.dumps([[k.lower(), v] for k, v in table.items()])), "array<array<string>>")
    contained = F.get(F.get(F.filter(pairs, lambda e: low.contains(e[0])), F.lit(0)), F.lit(1))
    look = lambda c: F.try_element_at(known, c)
    return F.coalesce(F.when(path.startswith("."), look(path)), look(last), look(inner), contained, F.lit("Unknown"))


def edited_file(text: Column) -> Column:
    first = F.nullif(F.regexp_extract(text, 'User edited "([^"]+)"', 1), F.lit(""))
    return F.coalesce(first, F.nullif(F.regexp_extract(text, 'User edited file: "([^"]+)"', 1), F.lit("")))


def labels_in(text: Column) -> Column:
    body = F.regexp_extract(text, r"<labels>\s*([^<]+)\s*</labels>", 1)
    return F.filter(F.transform(F.split(body, ","), strip), lambda x: x != "")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r'[<>:"/\\|?*]', "_")


def repo_status(files: DataFrame) -> DataFrame:
    """repo, status from a listing (repo, path within it or null): empty, invalid, incomplete or complete."""
    git = F.coalesce(F.bool_or(F.col("path").startswith(".git/") | (F.col("path") == ".git")), F.lit(False))
    other = F.coalesce(F.bool_or(~(F.col("path").startswith(".git/") | (F.col("path") == ".git"))), F.lit(False))
    status = F.when(~git & ~other, "empty").when(~git, "invalid").when(~other, "incomplete").otherwise("complete")
    return files.groupBy("repo").agg(status.alias("status"))


def matches(line: Column, query: str, mode: str = "substring", ignore_case: bool = False) -> Column:
    """Whether a line matches: as a substring, as a whole word, or as a regular expression."""
    import re

    if mode == "substring":
        return F.lower(line).contains(query.lower()) if ignore_case else line.contains(query)
    pattern = rf"\b{re.escape(query)}\b" if mode == "word" else query
    return line.rlike(("(?iu)" if ignore_case else "") + pattern)


def match_preview(line: Column, query: str, width: int = 88) -> Column:
    """The part of the line around the first match."""
    at = F.locate(query, line)
    start = F.greatest(F.lit(1), at - (width - len(query)) // 2)
    return F.when(at > 0, line.substr(start.cast("int"), F.lit(width)))


def search(lines: DataFrame, query: str, mode: str = "substring", ignore_case: bool = False) -> DataFrame:
    """(file, line_number, content) of the lines that match."""
    return lines.where(matches(F.col("content"), query, mode, ignore_case)).select("file", "line_number", "content")


def word_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit("([A-Za-z0-9_]+)"), 1))
