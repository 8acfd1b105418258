"""Hand-derived cases for cleaners, filters and scalars."""

import pytest
from pyspark.sql import functions as F

from loamworks.operators import augment, clean, dedup, filters, joins, judge, markdown, sample, shape, syntax
from loamworks.sources import files


def one(spark, text, change, path=None):
    return spark.createDataFrame([(text, path)], "text string, path string").select(change(F.col("text"), F.col("path")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "change, text, path, want",
    [
        (lambda t, p: clean.drop_tag_header(t), "<repo>x\n\n<file>a.ets\n\nlet a;", None, "\nlet a;"),
        (lambda t, p: clean.drop_tag_header(t), "\n\ncode", None, "\n\ncode"),
        (lambda t, p: clean.drop_licence_comments(t), "/* Copyright 2024 X */\n\nlet a;", None, "let a;"),
        (lambda t, p: clean.drop_licence_comments(t), "/* a */ f(); /* Copyright X */ rest", None, "rest"),
        (lambda t, p: clean.drop_licence_comments(t, strict=True), "/* a */ f(); /* Copyright X */ rest", None, "/* a */ f(); rest"),
        (lambda t, p: clean.drop_licence_comments(t), "/* plain */ f();", None, "/* plain */ f();"),
        (clean.ensure_header, "let a", "p/src/A.ets", "// A.ets\nlet a"),
        (clean.ensure_header, "// src/A.ets\nlet a", "p/B.ets", "// src/A.ets\nlet a"),
        (clean.ensure_header, "let a", None, "let a"),
        (lambda t, p: clean.unescaped(t), "a\\nb", None, "anb"),
        (lambda t, p: clean.unescaped(t), "a\\\\nb", None, "a\nb"),
        (lambda t, p: clean.markdown_text(t), "see ![alt](u.png) and ![](v.png) [t](x)", None, "see !alt and  t"),
        (lambda t, p: clean.drop_leading_blank_lines(t), " \n\t\n  a\n", None, "  a\n"),
        (lambda t, p: clean.drop_leading_blank_lines(t), " \n ", None, ""),
        (lambda t, p: clean.dedented(t), "  a\n    b\n", None, "a\n  b"),
        (clean.clean_code, "\n/* Copyright */\n\nlet a", "x/y.ets", "// y.ets\nlet a"),
        (clean.clean_code, "", "x/y.ets", "// y.ets\n"),
    ],
)
def test_cleaners(spark, change, text, path, want):
    assert one(spark, text, change, path) == want


@pytest.mark.parametrize(
    "name, text, stays",
    [
        ("blank_vs_content", "a\n\nb\n", True),
        ("blank_vs_content", "a\n\n\n", False),
        ("trivial_assignment", "xs.map(a => 1)", False),
        ("prefix_repetition", "\n".join(f"static readonly entry_{c} = 1" for c in "abc"), False),
        ("prefix_repetition", "\n".join([*(f"static readonly entry_{c} = 1" for c in "ab"), "x", "y", "z"]), True),
        ("prefix_repetition", "// only", False),
        ("numeric_literal_density", "a = 1; b = 2", False),
        ("numeric_literal_density", "let total = 3 + other", True),
        ("numeric_literal_density", "-- !!", False),
        ("numeric_array_length", f"[{', '.join('1' * 11)}]", False),
        ("numeric_array_length", f"[{', '.join('1' * 10)}]", True),
        ("numeric_array_length", f"[{', '.join('1' * 10)}, x]", True),
        ("line_repetition", "\n".join(["a long line here"] * 5 + list("abcde")), False),
        ("line_repetition", "\n".join(["a long line here"] * 4 + list("abcdef")), True),
        ("empty_content", None, False),
        ("jinja_template", "{% if x %}", False),
        ("jinja_template", "`${x}`", True),
        ("chinese_char_threshold", "汉字汉字a", False),
        ("forbidden_token_frequency", "public " * 7, False),
        ("total_length", "x" * 30697, False),
        ("avg_line_length", "x" * 101, False),
        ("config_file", "module.exports = {\n" * 6, False),
        ("test_file", "it('x')\nexpect(1)\na", False),
    ],
)
def test_filters(spark, name, text, stays):
    df, t = filters.prepared(spark.createDataFrame([(text,)], "text string"), "text")
    assert df.select(filters.FILTERS[name](t)).first()[0] is stays


def test_reasons_add_up_and_keep_columns(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "b"), (3, "let a = 1\n" * 9, "c")], "id int, text string, lines string")
    out = filters.with_reject_reason(df)
    assert out.columns == ["id", "text", "lines", "reject_reason"]
    assert {r["reason"]: r["n"] for r in filters.funnel(out).collect()} == {"empty_content": 2, "trivial_assignment": 1}
    assert filters.with_reject_reason(df.limit(0)).count() == 0


def test_custom_filter(spark):
    filters.register_filter("short", lambda t: F.length(t.text) < 3)
    df = spark.createDataFrame([("ab",), ("abc",)], "text string")
    assert [r["reject_reason"] for r in filters.with_reject_reason(df, ("short",)).orderBy("text").collect()] == [None, "short"]
    del filters.FILTERS["short"]
    assert filters.rule_for("Import check") == "import_ratio" and filters.rule_for("x", "looks at test") is None


@pytest.mark.parametrize("path, leaked", [("org/multi-nav-bar/entry/x.ets", True), ("multi-nav-bar/x.ets", False), ("a/b/c/multi-nav-bar/x.ets", False), (None, False)])
def test_leaks(spark, path, leaked):
    out = joins.tag_leaks(spark.createDataFrame([(path,)], "path string"), spark.createDataFrame([("Multi_Nav_Bar",)], "pattern string"))
    assert out.first()["leaked"] is leaked


def test_consensus(spark):
    rows = [("x", 1, "KEEP", ["A"], 4.0, 3.0, 0.9, "one"), ("x", 0, "REMOVE", ["B", "A"], 1.0, 1.0, 0.8, "two"), ("y", 0, "KEEP", None, 4.0, 4.0, 0.9, None), ("y", 1, "KEEP", ["B"], 3.0, 3.0, 0.6, "b"), ("y", 2, "REMOVE", ["C"], 1.0, 1.0, 0.3, "c")]
    j = spark.createDataFrame(rows, "item_id string, replica int, decision string, labels array<string>, arkts_score double, quality_score double, confidence double, rationale string")
    x, y = judge.consensus(j).orderBy("item_id").collect()
    assert (x["final_decision"], x["final_labels"], x["final_arkts_score"], x["final_quality_score"], x["final_confidence"], x["rationale_sample"]) == ("REMOVE", ["A", "B"], 2.5, 2.0, 0.85, "two; one")
    assert (y["final_decision"], y["final_labels"], y["final_arkts_score"], y["final_confidence"]) == ("KEEP", ["B", "C"], 2.667, 0.6)
    none = judge.with_consensus(spark.createDataFrame([("z",)], "item_id string"), j).first()
    assert (none["final_decision"], none["final_labels"], none["final_arkts_score"], none["final_confidence"], none["replicas"]) == ("KEEP_WITH_TAG", [], 3.0, 0.3, 0)


def test_judgements(spark):
    assert judge.json_object('x {"a": "}"} y }') == '{"a": "}"}' and judge.json_object("none") is None
    df = spark.createDataFrame([('{"decision":" keep ","arkts_score":9,"confidence":-1}',), ('{"decision":"DROP"}',)], "t string")
    a, b = (r[0] for r in df.select(judge.validated(F.col("t"))).collect())
    assert (a["decision"], a["labels"], a["arkts_score"], a["quality_score"], a["confidence"]) == ("KEEP", [], 5.0, 0.0, 0.0) and b is None

    def call(prompt, heat):
        if prompt == "bad":
            raise ConnectionError("down")
        return "no json"

    got = judge.judge(spark.createDataFrame([("1", "bad"), ("2", "x")], "item_id string, text string"), call, "{code}", replicas=2)
    assert {(r["item_id"], r["labels"][0], r["confidence"]) for r in got.collect()} == {("1", "API_ERROR", 0.2), ("2", "PARSE_ERROR", 0.3)}


def test_prompt(spark):
    fence = "```arkts\n"
    prompt = f"The context below the method is:\n{fence}BELOW\n```\n\nThe context above the method is:\n{fence}ABOVE\n```\n\nAnd here is the code snippet you are asked to complete:\n{fence}S <unused98>\n```\n\nEnsure that only missing codes"
    assert one(spark, prompt, lambda t, p: shape.prompt_text(t)) == "ABOVE\n\n\nS <unused98>\n\n\nBELOW"
    assert one(spark, f"{fence}R\n```", lambda t, p: shape.response_code(t)) == "R"
    assert one(spark, "https://h/o/p.git", lambda t, p: shape.project_of(t)) == "p"


def test_url_variants(spark):
    assert one(spark, "a-b-c", lambda t, p: joins.url_variants(t)) == ["a-b-c", "a/b-c", "a-b/c"]


def test_allocation_and_blocks(spark):
    assert sample.allocation({("a",): 60, ("b",): 30, ("c",): 9, ("d",): 1}, 11) == {("a",): 6, ("b",): 3, ("c",): 1, ("d",): 1}
    assert sum(sample.allocation({("a",): 60, ("b",): 30}, 50).values()) == 50
    rows = sample.blocks(spark.range(10), 4, "id").groupBy("block").count().orderBy("block").collect()
    assert [r["count"] for r in rows] == [3, 3, 2, 2]
    split = sample.ratio_split(spark.range(7), 7).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"train": 5, "test": 2}
    order = sample.interleave(spark.range(2).selectExpr("id", "'F' || id as n"), spark.range(5).selectExpr("id", "'o' || id as n"), "id").orderBy("place").collect()
    assert [r["n"] for r in order] == ["F0", "o0", "o1", "o2", "F1", "o3", "o4"]


def test_nested_sizes_are_nested(spark):
    df = spark.range(200).selectExpr("id", "id % 13 as text_tokens")
    out = sample.nested_sizes(df, {"s": 100, "m": 400}).collect()
    assert all(r["m"] for r in out if r["s"]) and sum(r["text_tokens"] for r in out if r["s"]) >= 100


def test_syntax():
    assert syntax.lex("let a = '(';\nf(() => {});")[:2] == (0, 0)
    assert syntax.lex("function f() { }")[3:] == (1, 1)
    assert syntax.lex("a)(")[:2] == (1, 1) and syntax.lex(None) == (0, 0, 0, 0, 0)


def test_markdown():
    text = "# A\np [t](u)\n## B\nprose\n```ts\n# not a heading\nlet a;\n```\n```python\nx\n```\n# C\n```js\nopen"
    got = markdown.doc_records("d.md", text)
    assert [r[3] for r in got] == ["<DOC>\nSection: A / B\nSummary:\nprose\n</DOC>\n<CODE>\n# not a heading\nlet a;\n</CODE>", "# not a heading\nlet a;"]
    assert [r[4:] for r in got] == [(1, 0, "doc_inject"), (1, 0, "pure_code")] and got[0][0].startswith("doc_inject:") and got[1][0] == got[0][0].replace("doc_inject", "pure_code")
    assert markdown.doc_records("d.md", None) == []
    assert markdown.sections("# A\n## B\n```ts\nx\n```")[1]["codes"] == [("ts", "x")]  # a title alone is a section
    assert markdown.heading_paths(["## A", "### C", "## B", "# D"]) == ["A", "A / C", "A / B", "D"]
    assert markdown.sections("\n```ts\nx")[0]["codes"] == []
    assert markdown.properties_and_events(["- [b](number): two\n- [a](): one\n- onClick(x)\n- plain\n- [a](): one"]) == (["- a: one", "- b: two"], ["- onClick(x)"])


def test_fim_restores_the_code(spark):
    code = "".join(f"function part{i}(other) {{\n  let name{i} = other + {i};\n  return name{i} * other;\n}}\n" for i in range(40))
    out = augment.fim(spark.createDataFrame([(str(i), code) for i in range(40)] + [("n", None), ("s", "x")], "id string, text string")).collect()
    assert len(out) == 40 and len({r["meta"]["strategy"] for r in out}) >= 3
    for r in out:
        a, b = r["meta"]["middle_chars"]
        assert r["text"] == f"<|fim_prefix|>{code[:a]}<|fim_suffix|>{code[b:]}<|fim_middle|>{code[a:b]}" and 80 <= b - a <= 1200


def test_spans():
    r = augment.rng_of(1, "x")
    code = "let a = 1;\n" * 50
    assert all(80 <= b - a <= 183 for a, b in (augment.token_span(code, r, 80, 1200) for _ in range(50))) and augment.token_span("short", r, 80, 1200) is None
    body = "function f() {" + "x" * 300 + "}"
    spans = [augment.function_span(body, r, 80, 1200) for _ in range(100)]
    assert all(13 <= a < b <= 315 and 80 <= b - a <= 151 for a, b in spans)
    assert augment.identifier_span("name other name", r, 1, 100) is None and augment.identifier_span("AA AA AA AA", r, 1, 100) is None
    assert augment.identifier_span("name " * 4, r, 1, 100) is not None


def test_fim_prefers_formatted_texts_and_mixes_both(spark):
    code = "".join(f"let name{i} = other + {i};\n" for i in range(60))
    df = spark.createDataFrame([(str(i), code, (code.upper() if i % 2 else "") if i else None) for i in range(10)], "id string, text string, llm_formatted string")
    only = augment.fim_dataset(df, 4, weights=(("token", 1.0),)).collect()
    assert [r["id"] for r in only] == ["1", "3", "5", "7"] and all("LET NAME" in r["text"] for r in only)
    mix = augment.fim_with_originals(df, 100.0).collect()
    assert sum(not r["is_fim"] for r in mix) == 10 and sum(r["is_fim"] for r in mix) == 15 and sorted(r["place"] for r in mix) == list(range(25))
    assert augment.fim_with_originals(df, 0.0, replay=True).count() == 10


def test_full_run_resumes(spark, tmp_path):
    items = spark.createDataFrame([(i, f"text {i}", "en") for i in range(6)], "doc_id int, text string, lang string")
    reply = '{"decision": "KEEP", "arkts_score": 4, "confidence": 0.5}'

    def first(prompt, heat):
        if prompt.endswith("3"):
            raise ValueError("crash")
        return reply, {"prompt_tokens": 7, "completion_tokens": 2, "total_tokens": 9}

    path = str(tmp_path / "judged")
    judged, told = judge.full_run(items, path, first, "{code}", key="doc_id", replicas=1)
    assert judged.where("item_id = 'UNKNOWN'").count() == 1 and judged.where("lang = 'en'").count() == 5
    totals = judge.usage_totals(judged).first()
    assert (totals["judgements"], totals["exec_error"], totals["total_tokens"]) == (6, 1, 45)
    judged, told = judge.full_run(items, path, lambda p, h: reply, "{code}", key="doc_id", replicas=1)
    assert judged.where("item_id <> 'UNKNOWN'").count() == 6 and {r["item_id"]: r["len_chars"] for r in told.collect()}["3"] == 6


def test_rules_in_rounds(spark):
    rows = spark.createDataFrame([(str(i), "# note\n" * 12 if i % 2 else "let total = 1\n" * 3) for i in range(10)], "item_id string, text string")
    reply = lambda p, h: '{"name": "Comment share", "thresholds": {"most": 0.6}}' if "notes" in p else "nothing"

    def detect(df, n):
        return df.select("item_id", F.col("text").startswith("#").alias("is_dirty"), F.lit("notes").alias("category"), F.lit("only notes").alias("reason"), F.lit(0.9).alias("confidence"))

    kept, found = judge.rule_rounds(rows, detect, reply)
    assert sorted(r["item_id"] for r in kept.collect()) == ["0", "2", "4", "6", "8"] and [tuple(r) for r in found.collect()] == [("notes", 5)]
    assert judge.rules_from(judge.category_report(detect(rows, 0)), lambda p, h: "nothing") == []
    out, counts = judge.integrated(rows, [{"name": "unknown"}])
    assert out.where("reject_reason is null").count() == 10 and counts.count() == 0


@pytest.mark.parametrize("limit", [200_000, 0])
def test_lists_of_any_length(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    names = ["ab", "a", "abc", "xabcx", "q-r-s", "", None, "zz", "repo~me~12", "éa"]
    ids = ["a", "ab", "abc", "bcx", "12", "q", "none", "é", "zzz", None]
    df = spark.createDataFrame([(n,) for n in names], "project_name string")
    listed = [*ids, ""] if limit else ids
    for some in (ids, listed):
        m = spark.createDataFrame([(v, f"v{i}", i) for i, v in enumerate(some)], "id string, api_ver string, seq int")
        got = {r["project_name"]: r["api_ver"] for r in joins.add_api_version(df, m).collect()}
        assert got == {n: next((f"v{i}" for i, v in enumerate(some) if n is not None and v is not None and v in n), None) for n in names}
    urls = spark.createDataFrame([("https://h/q/r-s.git",), ("https://h/abc",), (None,)], "git_url string")
    assert {r[0] for r in joins.matched_projects(df, urls).collect()} == {"ab", "a", "abc", "q-r-s"}
    paths = spark.createDataFrame([("org/multi-nav-bar/x.ets",), ("a/b/c/multi-nav-bar",), ("a/b",), (None,)], "path string")
    assert [r["leaked"] for r in joins.tag_leaks(paths, spark.createDataFrame([("Multi_Nav_Bar",), ("-",), ("zz",)], "pattern string")).orderBy("path").collect()] == [False, False, False, True]


def test_strata_of_null_and_empty(spark):
    rows = [(str(i), None if i < 6 else "" if i < 40 else "x") for i in range(100)]
    got = sample.stratified_sample(spark.createDataFrame(rows, "id string, s string"), 50, ["s"]).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {None: 3, "": 17, "x": 30}


@pytest.mark.parametrize("n", [1, 7, 40, 90, 400])
@pytest.mark.parametrize("most", [0, sample.BROADCAST_STRATA])
def test_quotas_are_the_allocation(spark, monkeypatch, n, most):
    monkeypatch.setattr(sample, "BROADCAST_STRATA", most)
    rows = [(str(i), None if i % 31 == 0 else f"s{i * i % 23}", "" if i % 3 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "id string, s string, t string")
    sizes = {tuple(r)[:2]: r["count"] for r in df.groupBy("s", "t").count().collect()}
    name = {k: tuple((x is not None, x or "") for x in k) for k in sizes}
    want = sample.allocation({name[k]: v for k, v in sizes.items()}, n)
    assert {name[r["s"], r["t"]]: r["quota"] for r in sample.quotas(df, n, ["s", "t"]).collect()} == want
    got = sample.stratified_sample(df, n, ["s", "t"])
    assert got.columns == df.columns and got.count() == min(n, 300)
    if sum(want.values()) <= n:
        assert {name[r["s"], r["t"]]: r["count"] for r in got.groupBy("s", "t").count().collect()} == want
    assert sample.stratified_sample(df.limit(0), n, ["s", "t"]).count() == 0


def test_reports_are_whole_or_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="more than 3 rows"):
        files.write_report(spark.range(4), str(tmp_path / "r"), 3)


def test_statistics_of_completion_records(spark):
    rows = [("a", None, "c", "p", "f.ets"), ("a", "b", "c", None, None)]
    got = shape.concat_statistics(spark.createDataFrame(rows, "above_functions string, source_method_code string, below_functions string, projectName string, filePath string")).first()
    assert (got["total"], got["fields_processed"], got["missing_fields"], got["ids_from_path"], got["fields_renamed"]) == (2, 1, 1, 1, 2)
    assert shape.with_text(spark.createDataFrame([("x",)], "code string")).first()["text"] == "x" and shape.with_text(spark.range(3)).count() == 0


def test_near_duplicates_against_exact_similarity(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    sets = {i: {t[k : k + 5] for k in range(len(t) - 4)} for i, t in texts.items()}
    ids = sorted(texts)
    chance: dict[int, float] = {}  # of a row with a smaller id at 0.85 or more: that the closest of those shares a band
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) >= 0.85 * max(len(sets[a]), len(sets[b])):
                alike = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
                if alike >= 0.85:
                    chance[b] = max(chance.get(b, 0.0), 1 - (1 - alike**dedup.ROWS) ** dedup.BANDS)
    got = {r["doc_id"] for r in dedup.near_duplicate_ids(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), id_col="doc_id").collect()}
    found, expected = len(chance.keys() & got), sum(chance.values())
    assert len(chance) > 10 and found >= expected - 3 * sum(p * (1 - p) for p in chance.values()) ** 0.5
    print(f"{found} of {len(chance)} rows at 0.85 or more, {expected:.1f} expected")


def test_renaming():
    assert augment.declared("function f(first: string, second) { let total = 1; const x = (y) => { return y } }") == ["total", "x", "first", "second", "y"]
    assert augment.rename("let a = b.a + a; // a\n'a'", {"a": "z"}) == "let z = b.a + z; // a\n'a'"


def test_places_are_those_of_the_sorted_rows(spark):
    rows = [(1, "test", "b"), (2, None, None), (3, "train", ""), (4, "odd", "a"), (5, "unused", "b"), (6, "valid", None), (7, "train", "a")]
    df = spark.createDataFrame(rows, "id int, split string, project_name string")
    for f, args, want in ((shape.in_split_order, ("split", "id"), [3, 7, 6, 1, 5, 2, 4]), (shape.by_project, ("id",), [2, 3, 6, 4, 7, 1, 5])):
        assert [r["id"] for r in f(df, *args).collect()] == want
        placed = f(df, *args, place="at")
        assert placed.columns == [*df.columns, "at"]
        assert sorted((r["at"], r["id"]) for r in placed.collect()) == list(enumerate(want))
        assert f(df.limit(0), *args, place="at").count() == 0
