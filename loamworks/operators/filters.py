"""Quality filters (F1 to F29). A filter is a Column that is true where a row stays; the first that is false names the
rejection. Line arrays are computed once a row and shared by all filters of a profile."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamworks.functions.text import blank, count_of, newline_parts, strip, text_lines

# Fixed values of the rule filters.
TRIVIAL_NAMES = ("a", "b", "c", "d", "e", "x", "y", "z", "i", "j", "k")
GENERATED_SIGNS = (
    "auto-generated", "autogenerated", "do not edit", "generated by",
    "this file was automatically generated", "code generator", "scaffold", "boilerplate",
)
TEST_SIGNS = ("describe(", "it(", "test(", "expect(", "assert", "beforeEach", "afterEach", "jest", "mocha")
CONFIG_PATTERNS = (r"\"[a-zA-Z_]+\"\s*:\s*\"[^\"]*\"", r"[a-zA-Z_]+\s*=\s*[\"'][^\"'][\"']", r"module\.exports\s*=\s*\{")
TEMPLATE_PATTERNS = (
    r"\{%-?\s*[^%]+?-?%\}",
    r"<%[\s\S]*?%>",
    r"\{\{\s*[#/\^>]\s*[^}]+\}\}",
    r"\{\{\{[^}]+\}\}\}",
    r"/\*\s*---[\s\S]+?---\s*\*/",
)
TEMPLATE_EXPRESSION = r"\{\{-?\s*[^}]+?-?\}\}"


@dataclass
class Text:
    """A text and its lines: all, those with more than white space, those that aren't comments either; and the
    stripped parts between line feeds."""

    text: Column
    lines: Column
    filled: Column
    content: Column
    parts: Column


def prepared(df: DataFrame, text_col: str) -> tuple[DataFrame, Text]:
    """The table with one more column, ``__text``, and what reads from it."""
    t = F.coalesce(df[text_col], F.lit(""))
    stripped = F.filter(F.transform(text_lines(t), strip), lambda x: x != "")
    parts = F.filter(F.transform(newline_parts(t), strip), lambda x: x != "")
    made = F.struct(t.alias("text"), text_lines(t).alias("lines"), stripped.alias("filled"), parts.alias("parts"))
    # one-element explode: a barrier that keeps the optimiser from computing the lines anew in each filter
    out = df.withColumn("__text", F.explode(F.array(made)))
    at = lambda k: F.col("__text").getField(k)
    return out, Text(at("text"), at("lines"), at("filled"), F.filter(at("filled"), lambda x: ~x.startswith("//")), at("parts"))


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _many(xs: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(xs, test))


def not_empty(t: Text) -> Column:
    return F.length(t.text) > 0


def not_generated(t: Text, signs: tuple[str, ...] = ("auto-generated",)) -> Column:
    low = F.lower(t.text)
    found = F.lit(False)
    for sign in signs:
        found = found | low.contains(sign)
    return ~found & (F.length(t.text) > 0)


def average_line_length(t: Text, most: float = 100) -> Column:
    total = F.aggregate(t.lines, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    return (F.size(t.lines) > 0) & (total <= F.lit(most) * F.size(t.lines))


def longest_line(t: Text, most: int = 1000) -> Column:
    return F.coalesce(F.array_max(F.transform(t.lines, F.length)) <= most, F.lit(False))


def enough_lines(t: Text, least: int = 5) -> Column:
    return F.size(t.content) >= least


def blank_share(t: Text, most: float = 0.8, least_blank: int = 14) -> Column:
    filled = F.size(t.filled)
    empty = F.size(t.lines) - filled
    return ~((empty > filled) | ((filled > 0) & (empty > F.lit(most) * filled) & (empty >= least_blank)))


def colon_share(t: Text, most: float = 0.45, least_lines: int = 80) -> Column:
    return (F.size(t.filled) < least_lines) | (_many(t.filled, lambda x: x.contains(":")) <= F.lit(most) * F.size(t.filled))


def no_trivial_assignment(t: Text, names: tuple[str, ...] = ("a", "b", "c")) -> Column:
    return ~t.text.rlike(rf"(?U)\b({'|'.join(names)})\s*=")


def prefix_repetition(t: Text, chars: int = 16, most: float = 0.4) -> Column:
    heads = F.transform(F.filter(t.content, lambda x: F.length(x) > chars), lambda x: F.substring(x, 1, chars))
    # sorted, the longest run of equals is the largest count
    runs = F.aggregate(
        F.array_sort(heads),
        F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda a, x: F.struct(
            x.alias("last"),
            F.when(x == a["last"], a["run"] + 1).otherwise(1).alias("run"),
            F.greatest(a["best"], F.when(x == a["last"], a["run"] + 1).otherwise(1)).alias("best"),
        ),
    )
    return (F.size(t.content) > 0) & (runs["best"] <= F.lit(most) * F.size(t.content))


def han_share(t: Text, most: float = 0.3) -> Column:
    joined = F.array_join(t.content, "")
    chars = F.length(F.translate(joined, " \t", ""))
    return (chars == 0) | (F.regexp_count(joined, F.lit("[一-鿿]")) <= F.lit(most) * chars)


def token_limits(t: Text, limits: dict[str, int] | None = None) -> Column:
    ok = F.lit(True)
    for token, most in (limits or {"public": 6, "private": 6}).items():
        ok = ok & (count_of(t.text, token) <= most)
    return ok


def number_share(t: Text, most: float = 0.3) -> Column:
    numbers = F.regexp_count(t.text, F.lit(r"(?U)\b-?\d+(\.\d+)?\b"))
    words = F.regexp_count(t.text, F.lit(r"(?U)\b\w+\b"))
    return (words > 0) & (numbers <= F.lit(most) * words)


def short_number_arrays(t: Text, most: int = 10) -> Column:
    bodies = F.regexp_extract_all(t.text, F.lit(r"\[([^\]]+)\]"), 1)
    items = lambda b: F.filter(F.transform(F.split(b, ","), strip), lambda e: e != "")
    return ~F.exists(bodies, lambda b: (F.size(items(b)) > most) & F.forall(items(b), lambda e: e.rlike(r"(?U)^-?\d+(\.\d+)?$")))


def total_length(t: Text, most: int = 30_696) -> Column:
    return F.length(t.text) <= most


def is_template(t: Text) -> Column:
    """True for text that looks like a page template: the opposite sense of the other filters."""
    found = F.lit(False)
    for pattern in TEMPLATE_PATTERNS:
        found = found | t.text.rlike(pattern)
    return found | (F.regexp_count(t.text, F.lit(TEMPLATE_EXPRESSION)) >= 2) | (t.text.contains("{%") & t.text.contains("%}"))


def not_template(t: Text) -> Column:
    return ~is_template(t)


def _line_share(t: Text, test: Callable[[Column], Column], most: float, least_lines: int) -> Column:
    return (F.size(t.parts) < least_lines) | (_many(t.parts, test) <= F.lit(most) * F.size(t.parts))


def import_share(t: Text, most: float = 0.5, least_lines: int = 10) -> Column:
    return _line_share(t, lambda x: x.startswith("import ") | x.startswith("from ") | (x.startswith("const ") & x.contains("require(")), most, least_lines)


def comment_share(t: Text, most: float = 0.6, least_lines: int = 10) -> Column:
    return _line_share(t, lambda x: x.startswith("//") | x.startswith("/*") | x.startswith("*") | x.startswith("#"), most, least_lines)


def trivial_variables(t: Text, most: float = 0.4, least: int = 3, names: tuple[str, ...] = TRIVIAL_NAMES) -> Column:
    declared = F.regexp_extract_all(t.text, F.lit(r"(?U)\b(?:let|const|var)\s+([a-zA-Z_][a-zA-Z0-9_]*)\s*[=:]"), 1)
    return (F.size(declared) < least) | (_many(declared, lambda x: x.isin(*names)) <= F.lit(most) * F.size(declared))


def line_repetition(t: Text, most: float = 0.3, least_lines: int = 10, least_chars: int = 10) -> Column:
    long = F.filter(t.parts, lambda x: F.length(x) > least_chars)
    return (F.size(t.parts) < least_lines) | (F.size(long) - F.size(F.array_distinct(long)) <= F.lit(most) * F.size(t.parts))


def not_generated_by_rule(t: Text) -> Column:
    low = F.lower(t.text)
    found = F.lit(False)
    for sign in GENERATED_SIGNS:
        found = found | low.contains(sign)
    return ~found


def test_share(t: Text, most: float = 0.3) -> Column:
    parts = newline_parts(t.text)

    def test(x: Column) -> Column:
        found = F.lit(False)
        for sign in TEST_SIGNS:
            found = found | x.contains(sign)
        return found

    return _many(parts, test) <= F.lit(most) * F.size(parts)


def config_share(t: Text, most: float = 0.5, least_lines: int = 5) -> Column:
    return _line_share(t, lambda x: x.rlike("|".join(CONFIG_PATTERNS)), most, least_lines)


Filter = Callable[..., Column]
FILTERS: dict[str, Filter] = {
    "empty_content": not_empty,
    "auto_generated": not_generated,
    "avg_line_length": average_line_length,
    "max_line_length": longest_line,
    "min_line_count": enough_lines,
    "blank_vs_content": blank_share,
    "colon_density": colon_share,
    "trivial_assignment": no_trivial_assignment,
    "prefix_repetition": prefix_repetition,
    "chinese_char_threshold": han_share,
    "forbidden_token_frequency": token_limits,
    "numeric_literal_density": number_share,
    "numeric_array_length": short_number_arrays,
    "total_length": total_length,
    "jinja_template": not_template,
    "import_ratio": import_share,
    "comment_ratio": comment_share,
    "trivial_variable": trivial_variables,
    "line_repetition": line_repetition,
    "rule_auto_generated": not_generated_by_rule,
    "test_file": test_share,
    "config_file": config_share,
}
#: Order matters: the first failure is the reason. The parser's filters follow in syntax.py, on survivors only.
ARKTS = tuple(FILTERS)[:14]
TS = tuple(n for n in ARKTS if n not in ("trivial_assignment", "forbidden_token_frequency"))
RULES = tuple(FILTERS)[15:]


def register_filter(name: str, keep: Filter) -> None:
    """Add a filter of one's own: a function from ``Text`` to a boolean Column (a pandas UDF of ``t.text`` will do)."""
    FILTERS[name] = keep


def with_reject_reason(df: DataFrame, names: tuple[str, ...] = ARKTS, text_col: str = "text", params: dict[str, dict] | None = None) -> DataFrame:
    """``reject_reason``: the first filter that a row fails, null where it stays. A null text counts as empty."""
    out, t = prepared(df, text_col)
    reason = F.coalesce(*[F.when(~FILTERS[n](t, **(params or {}).get(n, {})), F.lit(n)) for n in names])
    return out.withColumn("reject_reason", reason).drop("__text")


def funnel(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def filter_statistics(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """For each filter the rows that reached it (applied), those that it rejected (filtered) and the rate."""
    counts = df.groupBy("reject_reason").agg(F.count("*").alias("n"))
    places = F.explode(F.array(*[F.struct(F.lit(n).alias("filter"), F.lit(i).alias("place")) for i, n in enumerate(names)])).alias("f")
    place = F.coalesce(*[F.when(F.col("reject_reason") == n, F.lit(i)) for i, n in enumerate(names)], F.lit(len(names)))
    return (
        counts.withColumn("at", place)
        .select("at", "n", places)
        .groupBy("f.filter", "f.place")
        .agg(F.sum(F.when(F.col("at") >= F.col("f.place"), F.col("n")).otherwise(0)).alias("applied"), F.sum(F.when(F.col("at") == F.col("f.place"), F.col("n")).otherwise(0)).alias("filtered"))
        .select("filter", "applied", "filtered", F.round(F.coalesce(share(F.col("filtered"), F.col("applied")), F.lit(0.0)), 6).alias("rate"))
    )


def rule_for(name: str, implementation: str = "") -> str | None:
    """Which rule filter a described rule stands for; None if it stands for none."""
    both = f"{name} {implementation}".lower()
    for sign, rule in (("import", "import_ratio"), ("comment", "comment_ratio"), ("trivial", "trivial_variable"), ("repet", "line_repetition")):
        if sign in both:
            return rule
    for sign, rule in (("auto", "rule_auto_generated"), ("test", "test_file"), ("config", "config_file")):
        if sign in name.lower():
            return rule
    return None
