"""Every registered query, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.functions.text import preview
from loamworks.operators import augment, clean, dedup, filters, joins, judge, markdown, ordering, sample, shape, syntax, tokens
from loamworks.plans.views import CODE_SQL, DOCS_SQL, LINES_SQL, code, docs, quoted
from loamworks.sources import files
from loamworks.streaming import clean_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- filters -------------------------------------------------------------------------------------------------------

AVERAGE = 100
_WORDS = r"len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+'))"
_JOINED = "list_reduce(list_prepend('', content), lambda a, b: a || b)"
_COUNT = lambda x, test: f"len(list_filter({x}, lambda x: {test}))"
_SIGNS = lambda xs, c="lower(text)": "(" + " or ".join(f"contains({c}, '{x}')" for x in xs) + ")"
FILTER_SQL = {
    "empty_content": "length(text) > 0",
    "auto_generated": "not contains(lower(text), 'auto-generated') and length(text) > 0",
    "avg_line_length": f"list_sum(list_transform(lines, lambda x: length(x))) <= {AVERAGE} * len(lines)",
    "max_line_length": "list_max(list_transform(lines, lambda x: length(x))) <= 1000",
    "min_line_count": "len(content) >= 5",
    "blank_vs_content": "not (len(lines) - len(filled) > len(filled) or (len(filled) > 0 and len(lines) - len(filled) > 0.8 * len(filled) and len(lines) - len(filled) >= 14))",
    "colon_density": f"len(filled) < 80 or {_COUNT('filled', 'contains(x, chr(58))')} <= 0.45 * len(filled)",
    "trivial_assignment": r"not regexp_matches(text, '(^|[^\p{L}\p{M}\p{N}_])(a|b|c)\s*=')",
    "prefix_repetition": "len(content) > 0 and coalesce(list_max(map_values(list_histogram(list_transform(list_filter(content, lambda x: length(x) > 16), lambda x: substring(x, 1, 16))))), 0) <= 0.4 * len(content)",
    "chinese_char_threshold": f"length(replace({_JOINED}, ' ', '')) = 0 or len(regexp_extract_all({_JOINED}, '[一-鿿]')) <= 0.3 * length(replace(replace({_JOINED}, ' ', ''), chr(9), ''))",
    "forbidden_token_frequency": "(length(text) - length(replace(text, 'public', ''))) // 6 <= 6 and (length(text) - length(replace(text, 'private', ''))) // 7 <= 6",
    "numeric_literal_density": rf"{_WORDS} > 0 and len(regexp_extract_all(text, '\b-?\d+(?:\.\d+)?\b')) <= 0.3 * {_WORDS}",
    "jinja_template": "not (" + " or ".join(f"regexp_matches(text, {quoted(x)})" for x in filters.TEMPLATE_PATTERNS) + f" or len(regexp_extract_all(text, {quoted(filters.TEMPLATE_EXPRESSION)})) >= 2 or (contains(text, '{{%') and contains(text, '%}}')))",
    "config_file": "len(parts) < 5 or len(list_filter(parts, lambda x: " + " or ".join(f"regexp_matches(x, {quoted(x)})" for x in filters.CONFIG_PATTERNS) + ")) <= 0.5 * len(parts)",
    "total_length": "length(text) <= 30696",
    "numeric_array_length": r"len(list_filter(list_transform(regexp_extract_all(text, '\[([^\]]+)\]', 1), lambda b: list_filter(list_transform(string_split(b, ','), lambda e: trim(e, ' ' || chr(9) || chr(10))), lambda e: e <> '')), lambda es: len(es) > 10 and len(list_filter(es, lambda e: not regexp_full_match(e, '-?\d+(\.\d+)?'))) = 0)) = 0",
    "import_ratio": f"len(parts) < 10 or {_COUNT('parts', chr(40) + 'starts_with(x, ' + chr(39) + 'import ' + chr(39) + ') or starts_with(x, ' + chr(39) + 'from ' + chr(39) + ') or (starts_with(x, ' + chr(39) + 'const ' + chr(39) + ') and contains(x, ' + chr(39) + 'require(' + chr(39) + '))' + chr(41))} <= 0.5 * len(parts)",
    "comment_ratio": "len(parts) < 10 or len(list_filter(parts, lambda x: starts_with(x, '//') or starts_with(x, '/*') or starts_with(x, '*') or starts_with(x, '#'))) <= 0.6 * len(parts)",
    "line_repetition": "len(parts) < 10 or len(list_filter(parts, lambda x: length(x) > 10)) - len(list_distinct(list_filter(parts, lambda x: length(x) > 10))) <= 0.3 * len(parts)",
    "rule_auto_generated": f"not {_SIGNS(filters.GENERATED_SIGNS)}",
    "test_file": f"{_COUNT('raw', _SIGNS(filters.TEST_SIGNS, 'x'))} <= 0.3 * len(raw)",
    "trivial_variable": r"len(regexp_extract_all(text, '\b(?:let|const|var)\s+([a-zA-Z_][a-zA-Z0-9_]*)\s*[=:]', 1)) < 3 or len(list_filter(regexp_extract_all(text, '\b(?:let|const|var)\s+([a-zA-Z_][a-zA-Z0-9_]*)\s*[=:]', 1), lambda x: x in ('a','b','c','d','e','x','y','z','i','j','k'))) <= 0.4 * len(regexp_extract_all(text, '\b(?:let|const|var)\s+([a-zA-Z_][a-zA-Z0-9_]*)\s*[=:]', 1))",
}
FUNNEL, RULES = filters.ARKTS, filters.RULES


def _filter_query(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out, t = filters.prepared(code(spark, sf), "text")
        return out.select("doc_id", filters.FILTERS[name](t).alias("stays"))

    return run


for _name in filters.FILTERS:
    _sql = f"with {LINES_SQL} select doc_id, coalesce({FILTER_SQL[_name]}, false) as stays from t" if _name in FILTER_SQL else None
    query(_sql, f"filter_{_name}")(_filter_query(_name))

_REASON = lambda names: "case " + " ".join(f"when not coalesce({FILTER_SQL[n]}, false) then '{n}'" for n in names) + " end"


@query(f"with {LINES_SQL}, r as (select {_REASON(FUNNEL)} as reason from t) select coalesce(reason, 'kept') as reason, count(*) as n from r group by 1")
def filter_funnel(spark, sf):
    return filters.funnel(filters.with_reject_reason(code(spark, sf), FUNNEL))


@query(f"with {LINES_SQL}, r as (select {_REASON(filters.TS)} as reason from t) select coalesce(reason, 'kept') as reason, count(*) as n from r group by 1")
def filter_funnel_ts(spark, sf):
    return filters.funnel(filters.with_reject_reason(code(spark, sf), filters.TS))


_PLACES = ", ".join(f"('{n}', {i})" for i, n in enumerate(RULES))


@query(
    f"with {LINES_SQL}, r as (select coalesce(case {' '.join(f'when not coalesce({FILTER_SQL[n]}, false) then {i}' for i, n in enumerate(RULES))} end, {len(RULES)}) as stop from t), f(filter_name, place) as (values {_PLACES})"
    ' select filter_name as "filter", count(*) filter (where stop >= place) as applied, count(*) filter (where stop = place) as filtered, round(coalesce(count(*) filter (where stop = place) / nullif(count(*) filter (where stop >= place), 0)::double, 0), 6) as rate from f cross join r group by filter_name'
)
def rule_filter_stats(spark, sf):
    return filters.filter_statistics(filters.with_reject_reason(code(spark, sf), RULES), RULES)


@query()
def syntax_triage(spark, sf):
    return syntax.triage(code(spark, sf), clean.unescaped(F.col("text"))).groupBy("syntax").agg(F.count("*").alias("n"))


@query()
def filter_with_syntax(spark, sf):
    first = filters.with_reject_reason(code(spark, sf), FUNNEL)
    return filters.funnel(syntax.with_syntax_reason(first, clean.unescaped(F.col("text"))))


# ---- cleaners ------------------------------------------------------------------------------------------------------


def _clean_query(change):
    return lambda spark, sf: code(spark, sf).select("doc_id", F.sha2(change(F.col("text"), F.col("path")), 256).alias("hash"))


_WS = "' ' || chr(9) || chr(10) || chr(13)"
_MASK = lambda x: rf"regexp_replace({x}, '(?is)-----BEGIN (?:RSA )?PRIVATE KEY-----.*?-----END (?:RSA )?PRIVATE KEY-----', '-----BEGIN PRIVATE KEY-----' || chr(10) || '<MASKED_PRIVATE_KEY>' || chr(10) || '-----END PRIVATE KEY-----', 'g')"
_LEAD = lambda x: rf"case when trim({x}, {_WS}) = '' then '' else regexp_replace({x}, '\A(?:[^\S\n]*\n)+', '') end"
_LICENCE = lambda x: rf"regexp_replace(regexp_replace({x}, '(?is)/\*+.*?(?:Copyright|Licensed).*?\*/\s*', '', 'g'), '\A\s+', '')"
_HEAD = lambda x: rf"case when regexp_matches({x}, '(?i)\A\s*//[^\S\n]*[^\n]+\.ets[^\S\n]*(?:\n|\z)') then {x} else '// doc_' || doc_id || '.ets' || chr(10) || {x} end"
_SIGN = " or ".join(f"contains(l, {quoted(x)})" for x in clean.CODE_SIGNS)
_KINDS = lambda x: f"list_transform(string_split({x}, chr(10)), lambda l: case when trim(l, {_WS}) = '' then 0 when contains(l, '<') and contains(l, '>') and not ({_SIGN}) and not starts_with(trim(l, {_WS}), '//') then 1 else 2 end)"


def _tag_sql(x: str, source: str) -> str:
    """doc_id and ``x`` of the source as t, cut after the last header line before the first line of code."""
    return (
        f"select doc_id, array_to_string(lines[coalesce(list_max(list_filter(range(1, stop), lambda i: kinds[i] = 1)), 0) + 1:], chr(10)) as t from ("
        f"select *, coalesce(nullif(list_position(kinds, 2), 0), len(kinds) + 1) as stop from (select doc_id, string_split({x}, chr(10)) as lines, {_KINDS(x)} as kinds from {source}))"
    )


_UNESCAPED = r"""regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(text, '\\n', chr(10)), '\\t', chr(9)), '\\r', chr(13)), '\\"', '"'), '\\''', ''''), '\\\\', '\'), '\\(.)', '\1', 'g'), '\r\n?', chr(10), 'g')"""
_CLEANERS = {
    "clean_private_key": (lambda t, p: clean.mask_private_key(t), _MASK("text")),
    "clean_leading_blank": (lambda t, p: clean.drop_leading_blank_lines(F.concat(F.lit(" \n\n"), t)), _LEAD("(' ' || chr(10) || chr(10) || text)")),
    "clean_licence_comment": (lambda t, p: clean.drop_licence_comments(t), _LICENCE("text")),
    "clean_line_comments": (lambda t, p: clean.drop_line_comments(t), r"regexp_replace(text, '//[^\n]*', '', 'g')"),
    "ensure_header": (clean.ensure_header, _HEAD("text")),
    "leak_key": (lambda t, p: clean.leak_key(t), "replace(replace(lower(text), '-', ''), '_', '')"),
    "normalize_for_syntax": (lambda t, p: clean.unescaped(t), _UNESCAPED),
    "normalize_text": (lambda t, p: clean.unescaped_and_stripped(t), f"trim({_UNESCAPED}, {_WS})"),
    "markdown_text": (lambda t, p: clean.markdown_text(t), rf"trim(regexp_replace(regexp_replace(text, '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '!\[[^\]]*\]\([^)]+\)', '', 'g'), {_WS})"),
    "preview": (lambda t, p: preview(t), "case when length(text) > 200 then substring(text, 1, 200) || '...' else text end"),
}
for _name, (_change, _sql) in _CLEANERS.items():
    query(f"select doc_id, sha256({_sql}) as hash from ({CODE_SQL})", _name)(_clean_query(_change))


query(f"with s as (select * from ({CODE_SQL})), a as ({_tag_sql('text', 's')}) select doc_id, sha256(t) as hash from a", "clean_tag_header")(_clean_query(lambda t, p: clean.drop_tag_header(t)))


@query(
    f"with s as (select doc_id, {_MASK('text')} as t from ({CODE_SQL})), b as (select doc_id, {_LEAD('t')} as t from s), c as ({_tag_sql('t', 'b')}), d as (select doc_id, {_LICENCE('t')} as t from c),"
    f" e as (select doc_id, {_LEAD('t')} as t from d) select doc_id, sha256({_HEAD('t')}) as hash from e"
)
def clean_pipeline(spark, sf):
    return code(spark, sf).select("doc_id", F.sha2(clean.clean_code(F.col("text"), F.col("path")), 256).alias("hash"))


_INDENT = "length(l) - length(ltrim(l, ' ' || chr(9)))"


@query(
    f"with x as (select doc_id, string_split('    ' || replace(text, chr(10), chr(10) || '    '), chr(10)) as ls from ({CODE_SQL})),"
    f" m as (select *, coalesce(list_min(list_transform(list_filter(ls, lambda l: trim(l, {_WS}) <> ''), lambda l: {_INDENT})), 0) as n from x)"
    f" select doc_id, sha256(trim(array_to_string(list_transform(ls, lambda l: case when trim(l, {_WS}) = '' then '' else substr(l, n + 1) end), chr(10)), {_WS})) as hash from m"
)
def dedent(spark, sf):
    indented = F.concat(F.lit("    "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n    ")))
    return code(spark, sf).select("doc_id", F.sha2(clean.dedented(indented), 256).alias("hash"))


# ---- duplicates ----------------------------------------------------------------------------------------------------


@query("select min(doc_id) as doc_id from documents group by sha256(text)")
def exact_dedup(spark, sf):
    return dedup.exact_dedup(docs(spark, sf), "doc_id").select("doc_id")


@query("select count(*) as total_rows, count(distinct sha256(text)) as distinct_texts, count(*) - count(distinct sha256(text)) as duplicates from documents")
def dedup_report(spark, sf):
    groups = docs(spark, sf).groupBy(dedup.content_hash(F.col("text")).alias("h")).agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("total_rows"), F.count("*").alias("distinct_texts"), (F.sum("n") - F.count("*")).alias("duplicates"))


@query()
def near_dup_lsh(spark, sf):
    return dedup.near_duplicate_ids(docs(spark, sf), id_col="doc_id")


@query("select source as project_name, min(doc_id) as doc_id from documents group by 1")
def first_by_name(spark, sf):
    return dedup.first_by_name(docs(spark, sf), "project_name", "doc_id").select("project_name", "doc_id")


# ---- joins ---------------------------------------------------------------------------------------------------------

_PATTERNS = [("Src1",), ("src_2",), ("en-",)]
_PATTERN_SQL = "(values ('src1'), ('src2'), ('en')) p(pattern)"
_LEAKED = f"exists (select 1 from {_PATTERN_SQL} where contains(replace(replace(lower(path), '-', ''), '_', ''), p.pattern))"


@query(f"select doc_id, {_LEAKED} as leaked from ({DOCS_SQL})")
def leak_path_tag(spark, sf):
    return joins.tag_leaks(docs(spark, sf), ordering.table(spark, _PATTERNS, "pattern string")).select("doc_id", "leaked")


@query(f"select doc_id from ({DOCS_SQL}) where not {_LEAKED}")
def leak_anti(spark, sf):
    return joins.tag_leaks(docs(spark, sf), ordering.table(spark, _PATTERNS, "pattern string")).where("not leaked").select("doc_id")


@query(f"with f as (select text, max_by('f' || doc_id, doc_id) as llm_formatted from documents where doc_id % 2 = 0 group by text) select d.doc_id, sha256(coalesce(f.llm_formatted, d.text)) as hash from ({DOCS_SQL}) d left join f using (text)")
def format_left_join(spark, sf):
    d = docs(spark, sf)
    made = d.where("doc_id % 2 = 0").select("text", F.concat(F.lit("f"), "id").alias("llm_formatted"), F.col("doc_id").alias("seq"))
    return joins.format_join(d, made).select("doc_id", F.sha2("llm_formatted", 256).alias("hash"))


@query("with f as (select text, max_by('tag' || doc_id, doc_id) as tag from documents where doc_id % 3 = 0 group by text) select d.doc_id, f.tag from documents d left join f using (text)")
def tag_join(spark, sf):
    d = docs(spark, sf)
    made = d.where("doc_id % 3 = 0").select("text", F.concat(F.lit("tag"), "id").alias("tag"), F.col("doc_id").alias("seq"))
    return joins.format_join(d, made, out_col="tag", fallback=False).select("doc_id", "tag")


@query(f"with m as (select s_suppkey::varchar as id, 'v' || s_suppkey as api_ver, s_suppkey as seq from supplier) select d.doc_id, (select min_by(m.api_ver, m.seq) from m where contains(d.project_name, m.id)) as api_ver from ({DOCS_SQL}) d")
def api_version_lookup(spark, sf):
    m = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("v"), F.col("s_suppkey").cast("string")).alias("api_ver"), F.col("s_suppkey").alias("seq"))
    return joins.add_api_version(docs(spark, sf), m).select("doc_id", "api_ver")


@query("with n as (select distinct replace(p_name, ' ', '-') as project_name from part), u as (select distinct 'https://host.example/' || replace(p_name, ' ', '/') || '.git' as git_url from part where p_partkey % 2 = 0) select project_name from n where exists (select 1 from u, (select project_name as v union all select left(project_name, i - 1) || '/' || substr(project_name, i + 1) from range(1, length(project_name) + 1) r(i) where substr(project_name, i, 1) = '-') where contains(git_url, v))")
def repo_url_match(spark, sf):
    p = table(spark, sf, "part")
    names = p.select(F.regexp_replace("p_name", " ", "-").alias("project_name"))
    urls = p.where("p_partkey % 2 = 0").select(F.concat(F.lit("https://host.example/"), F.regexp_replace("p_name", " ", "/"), F.lit(".git")).alias("git_url"))
    return joins.matched_projects(names, urls)


_URLS = "select distinct 'https://host.example/' || replace(p_name, ' ', '/') as git_url from part where p_partkey % 2 = 0"
_URL_ROWS = "select p_brand as file, replace(p_name, ' ', '-') as project_name, case when p_size > 10 then p_type end as repo_url from part"
_VARIANTS = "(select project_name as v union all select left(project_name, i - 1) || '/' || substr(project_name, i + 1) from range(1, length(project_name) + 1) r(i) where substr(project_name, i, 1) = '-')"


@query(
    f"with u as ({_URLS}), p as ({_URL_ROWS}), n as (select project_name, exists (select 1 from u, {_VARIANTS} where contains(git_url, v)) as known from (select distinct project_name from p)), j as (select p.*, case when not known then project_name end as miss from p join n using (project_name))"
    " select file, count(*) as rows, count(*) filter (where repo_url is null) as no_url, count(miss) as unmatched, count(distinct miss) as unmatched_names from j group by rollup(file)"
)
def repo_url_report(spark, sf):
    p = table(spark, sf, "part")
    rows = p.select(F.col("p_brand").alias("file"), F.regexp_replace("p_name", " ", "-").alias("project_name"), F.when(F.col("p_size") > 10, F.col("p_type")).alias("repo_url"))
    urls = p.where("p_partkey % 2 = 0").select(F.concat(F.lit("https://host.example/"), F.regexp_replace("p_name", " ", "/")).alias("git_url"))
    return joins.url_report(rows, urls, file_col="file")


@query("select doc_id from documents where source not in (select source from documents where doc_id % 7 = 0)")
def diff_by_key(spark, sf):
    d = docs(spark, sf)
    return joins.not_in(d, d.where("doc_id % 7 = 0"), "project_name").select("doc_id")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def resume_anti_join(spark, sf):
    return judge.resumed(docs(spark, sf), table(spark, sf, "labels"), "doc_id").select("doc_id")


@query("select l.doc_id, l.quality, d.source as project_name from labels l left join documents d using (doc_id)")
def judgement_join(spark, sf):
    return joins.with_originals(table(spark, sf, "labels"), docs(spark, sf), "doc_id").select("doc_id", "quality", "project_name")


@query("select doc_id::bigint as k from documents union all select item_id::bigint from benchmark")
def union_corpora(spark, sf):
    return joins.concatenated(docs(spark, sf).select(F.col("doc_id").alias("k")), table(spark, sf, "benchmark").select(F.col("item_id").alias("k")))


# ---- samples, splits, mixtures -------------------------------------------------------------------------------------

_ORDER = "sha256('42:' || id), id"
_TOKENS = "len(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+|[^\\p{L}\\p{M}\\p{N}_\\s]'))::bigint"
_TOKENED = f"select *, {_TOKENS} as text_tokens, {_LEAKED} as leaked from ({DOCS_SQL})"


def tokened(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf, "lang").withColumn("text_tokens", tokens.word_tokens(F.col("text")))


@query(f"select doc_id from ({DOCS_SQL}) order by {_ORDER} limit 100")
def random_sample(spark, sf):
    return sample.random_sample(docs(spark, sf), 100).select("doc_id")


_BUCKET = "case when length(text) < 200 then '<200' when length(text) < 800 then '200-799' when length(text) < 2000 then '800-1999' when length(text) < 6000 then '2000-5999' else '>=6000' end"


@query(
    f"with d as (select *, {_BUCKET} as bucket from ({DOCS_SQL})), s as (select bucket, project_name, lang, count(*) as size, greatest(1, floor(count(*) / (select count(*) from d)::double * 120)) as share from d group by all), t as (select *, least(size, share) as base, 120 - sum(least(size, share)) over () as spare from s),"
    " q as (select *, base + case when row_number() over (partition by base < size order by base - size, bucket, project_name, lang) <= spare and base < size then 1 else 0 end as quota from t),"
    f" r as (select doc_id, bucket, project_name, lang, id, quota, row_number() over (partition by bucket, project_name, lang order by {_ORDER}) as place from d join q using (bucket, project_name, lang))"
    f" select doc_id, bucket, project_name, lang from r where place <= quota order by {_ORDER} limit 120"
)
def stratified_sample(spark, sf):
    d = docs(spark, sf, "lang").withColumn("bucket", sample.length_bucket(F.length("text")))
    return sample.stratified_sample(d, 120, ["bucket", "project_name", "lang"]).select("doc_id", "bucket", "project_name", "lang")


@query(f"select doc_id, {_BUCKET} as bucket from documents")
def length_bucket(spark, sf):
    return docs(spark, sf).select("doc_id", sample.length_bucket(F.length("text")).alias("bucket"))


@query(f"with s as (select doc_id, row_number() over (order by {_ORDER}) - 1 as p, least(500, count(*) over ()) as n from ({DOCS_SQL})) select doc_id, case when p < floor(n * 0.8) then 'train' when p < floor(n * 0.8) + floor(n * 0.1) then 'valid' else 'test' end as split from s where p < n")
def ratio_split(spark, sf):
    return sample.ratio_split(docs(spark, sf), 500).select("doc_id", "split")


@query(f"with s as (select doc_id, coalesce(sum(text_tokens) over (order by {_ORDER} rows between unbounded preceding and 1 preceding), 0) as ahead from ({_TOKENED})) select doc_id from s where ahead < 50000")
def token_budget_sample(spark, sf):
    return sample.token_budget(tokened(spark, sf), 50_000).select("doc_id")


@query(
    f"with k as ({_TOKENED}), a as (select id, coalesce(sum(text_tokens) over (order by {_ORDER} rows between unbounded preceding and 1 preceding), 0) as ahead from k where leaked), test as (select id from a where ahead < 20000),"
    f" b as (select id, coalesce(sum(text_tokens) over (order by sha256('43:' || id), id rows between unbounded preceding and 1 preceding), 0) as ahead from k where leaked and id not in (select id from test)), valid as (select id from b where ahead < 5000)"
    " select doc_id, case when id in (select id from test) then 'test' when id in (select id from valid) then 'valid' when leaked then 'unused' else 'train' end as split from k"
)
def split_assignment(spark, sf):
    tagged = joins.tag_leaks(tokened(spark, sf), ordering.table(spark, _PATTERNS, "pattern string"))
    return sample.assign_splits(tagged, test_tokens=20_000, valid_tokens=5_000).select("doc_id", "split")


@query(f"with s as (select doc_id, coalesce(sum(text_tokens) over (order by {_ORDER} rows between unbounded preceding and 1 preceding), 0) as ahead from ({_TOKENED})) select doc_id, ahead < 10000 as small, ahead < 50000 as middle, ahead < 200000 as large from s")
def nested_train_sizes(spark, sf):
    return sample.nested_sizes(tokened(spark, sf), {"small": 10_000, "middle": 50_000, "large": 200_000}).select("doc_id", "small", "middle", "large")


@query(f"with m as (select 'c' || conv_id || '-' || turn as id from conversations), o as (select id from ({DOCS_SQL}) order by {_ORDER} limit (select round(count(*) / 0.8)::bigint - count(*) from m)) select id from m union all select id from o")
def ratio_mix(spark, sf):
    main = table(spark, sf, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"))
    return sample.ratio_mix(main, docs(spark, sf).select("id"))


@query(f"select doc_id::varchar as id, (ntile(7) over (order by doc_id) - 1)::bigint as block from documents union all select 'b' || item_id, (ntile(7) over (order by item_id) - 1)::bigint from benchmark")
def block_mix(spark, sf):
    a = docs(spark, sf).select("id", F.col("doc_id").alias("k"))
    b = table(spark, sf, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), F.col("item_id").alias("k"))
    return sample.block_mix(a, b, 7, order="k").select("id", "block")


@query("with a as (select 'b' || item_id as id, (row_number() over (order by item_id) - 1) / (count(*) over ())::double as due, 0 as s from benchmark), b as (select doc_id::varchar, (row_number() over (order by doc_id) - 1) / (count(*) over ())::double, 1 from documents) select id, (row_number() over (order by due, s) - 1)::bigint as place from (select * from a union all select * from b)")
def interleave(spark, sf):
    a = table(spark, sf, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), F.col("item_id").alias("k"))
    b = docs(spark, sf).select("id", F.col("doc_id").alias("k"))
    return sample.interleave(a, b, "k").select("id", F.col("place").cast("long").alias("place"))


# ---- tokens and counters -------------------------------------------------------------------------------------------

_RANGES = ((0, 200), (100, 400), (401, 100_000))


@query(f"select doc_id, text_tokens from ({_TOKENED})")
def token_count(spark, sf):
    return tokened(spark, sf).select("doc_id", "text_tokens")


@query(f"select sum(text_tokens)::bigint as total_tokens, count(*) as entries, count(*) filter (where text = '') as empty_entries, round(sum(text_tokens) / nullif(count(*) filter (where text <> ''), 0)::double, 2) as avg_tokens from ({_TOKENED})")
def token_stats(spark, sf):
    return tokens.token_stats(tokened(spark, sf))


@query(f"select round(sum(length(text))::double * 1000 / sum(text_tokens), 6) as chars_per_1000 from (select * from ({_TOKENED}) order by doc_id limit 10)")
def chars_per_1000_tokens(spark, sf):
    return tokens.chars_per_1000_tokens(tokened(spark, sf), "doc_id")


_RANGE_SQL = "(values " + ", ".join(f"({a}, {b})" for a, b in _RANGES) + ") r(low, high)"


@query(f"select doc_id, low || '-' || high as token_range from ({_TOKENED}) join {_RANGE_SQL} on text_tokens between low and high")
def token_range_multi(spark, sf):
    return tokens.in_ranges(tokened(spark, sf), _RANGES).select("doc_id", "token_range")


@query(f"with m as (select doc_id, low || '-' || high as token_range, row_number() over (partition by low, high order by doc_id) as rank from ({_TOKENED}) join {_RANGE_SQL} on text_tokens between low and high) select * from m where rank <= 5")
def first_per_range(spark, sf):
    return tokens.first_per_range(tokened(spark, sf), _RANGES, "doc_id").select("doc_id", "token_range", "rank")


@query("select lang, count(*) as n, round(100.0 * count(*) / (select count(*) from documents), 6) as percent from documents group by 1")
def language_distribution(spark, sf):
    return tokens.distribution(table(spark, sf, "documents"), "lang")


@query("with e as (select unnest([case when quality = 1 then 'good' else 'poor' end, case when toxic = 1 then 'toxic' else 'clean' end]) as label from labels) select label, count(*) as n, round(100.0 * count(*) / (select count(*) from e), 6) as percent from e group by 1")
def label_distribution(spark, sf):
    e = table(spark, sf, "labels").select(F.explode(F.array(F.when(F.col("quality") == 1, "good").otherwise("poor"), F.when(F.col("toxic") == 1, "toxic").otherwise("clean"))).alias("label"))
    return tokens.distribution(e, "label")


@query("with e as (select min(length(text))::double as low, max(length(text))::double as high from documents) select least(49, floor((length(text) - low) * 50 / (high - low)))::bigint as bin, count(*) as n from documents, e group by 1")
def length_histogram(spark, sf):
    return tokens.length_histogram(docs(spark, sf))


@query("select case when lower(role) in ('train', 'valid', 'test', 'unused') then lower(role) else 'unknown' end as split, count(*) as n from (select case turn % 3 when 0 then 'TRAIN' when 1 then 'test' else role end as role from conversations) group by 1")
def split_stats(spark, sf):
    c = table(spark, sf, "conversations").select(F.when(F.col("turn") % 3 == 0, "TRAIN").when(F.col("turn") % 3 == 1, "test").otherwise(F.col("role")).alias("split"))
    return tokens.split_stats(c)


# ---- judgements ----------------------------------------------------------------------------------------------------

_DECISION = "case when toxic = 1 then 'REMOVE' when quality = 0 then 'KEEP_WITH_TAG' else 'KEEP' end"
_JUDGED = f"""
select doc_id::varchar as item_id, r as replica, case when (doc_id + r) % 7 = 0 then 'REMOVE' when (doc_id + r) % 5 = 0 then 'KEEP_WITH_TAG' else {_DECISION} end as decision,
       ['l' || ((doc_id + r) % 3), 'all'] as labels, ((doc_id + r) % 5)::double as arkts_score, ((doc_id * r) % 5)::double as quality_score, ((doc_id + r) % 4)::double / 4 as confidence, 'why ' || r as rationale
from labels, range(0, 3) t(r)
"""


def judged(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "labels").withColumn("replica", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))))
    k, r = F.col("doc_id"), F.col("replica")
    plain = F.when(F.col("toxic") == 1, "REMOVE").when(F.col("quality") == 0, "KEEP_WITH_TAG").otherwise("KEEP")
    return base.select(
        k.cast("string").alias("item_id"), "replica",
        F.when((k + r) % 7 == 0, "REMOVE").when((k + r) % 5 == 0, "KEEP_WITH_TAG").otherwise(plain).alias("decision"),
        F.array(F.concat(F.lit("l"), ((k + r) % 3).cast("string")), F.lit("all")).alias("labels"),
        ((k + r) % 5).cast("double").alias("arkts_score"), ((k * r) % 5).cast("double").alias("quality_score"), (((k + r) % 4) / 4.0).alias("confidence"),
        F.concat(F.lit("why "), r.cast("string")).alias("rationale"),
    )


_CONSENSUS = f"""
with j as ({_JUDGED}), v as (
  select item_id, decision, count(*) as votes, case decision when 'REMOVE' then 2 when 'KEEP_WITH_TAG' then 1 else 0 end as severity from j group by item_id, decision
), w as (select item_id, decision from v qualify row_number() over (partition by item_id order by votes desc, severity desc) = 1)
select j.item_id, any_value(w.decision) as final_decision, array_to_string(list_sort(list_distinct(flatten(list(j.labels)))), ',') as final_labels,
       round(avg(arkts_score), 3) as final_arkts_score, round(avg(quality_score), 3) as final_quality_score, round(avg(confidence), 3) as final_confidence,
       string_agg(rationale, '; ' order by replica) as rationale_sample, count(*) as replicas
from j join w using (item_id) group by j.item_id
"""


@query(_CONSENSUS)
def consensus(spark, sf):
    return judge.consensus(judged(spark, sf)).withColumn("final_labels", F.array_join("final_labels", ","))


@query(f"with c as ({_CONSENSUS}) select d.doc_id, coalesce(c.final_decision, 'KEEP_WITH_TAG') as final_decision, coalesce(c.final_arkts_score, 3.0) as final_arkts_score, coalesce(c.final_confidence, 0.3) as final_confidence, coalesce(c.replicas, 0) as replicas from documents d left join c on c.item_id = d.doc_id::varchar")
def consensus_summary(spark, sf):
    items = docs(spark, sf).select("doc_id", F.col("id").alias("item_id"))
    return judge.with_consensus(items, judged(spark, sf).withColumn("rationale", F.lit(""))).select("doc_id", "final_decision", "final_arkts_score", "final_confidence", "replicas")


@query(f"select decision, count(*) as n from ({_JUDGED}) group by 1")
def decision_counts(spark, sf):
    return joins.concatenated(*judge.by_decision(judged(spark, sf)).values()).groupBy("decision").agg(F.count("*").alias("n"))


@query(
    "select doc_id::varchar as item_id, case length(text) % 3 when 0 then 'KEEP' when 1 then 'REMOVE' else 'KEEP_WITH_TAG' end as final_decision,"
    " case when length(text) % 3 = 2 then 3.0 else least(5, length(text) % 9) end::double as final_arkts_score, case when length(text) % 3 = 2 then 0.3 else 0.5 end::double as final_confidence, 3::bigint as replicas from documents"
)
def llm_round_stub(spark, sf):
    def call(prompt: str, heat: float) -> str:
        return '```json\n{"decision": "%s", "labels": ["a"], "arkts_score": %d, "confidence": %s}\n```' % (("keep", "REMOVE", "x")[len(prompt) % 3], len(prompt) % 9, heat)

    got = judge.judge(docs(spark, sf), call, "{code}", key="doc_id")
    return judge.consensus(got).select("item_id", "final_decision", "final_arkts_score", "final_confidence", "replicas")


@query("with j as (select doc_id, case doc_id % 4 when 0 then 'keep' when 1 then 'REMOVE' when 2 then 'drop' else 'KEEP_WITH_TAG' end as d, (doc_id % 9)::double as s from documents) select doc_id, case when d = 'drop' then null else upper(d) end as decision, case when d = 'drop' then null else least(5.0, s) end as arkts_score from j")
def judgement_validate(spark, sf):
    d = F.when(F.col("doc_id") % 4 == 0, " keep ").when(F.col("doc_id") % 4 == 1, "REMOVE").when(F.col("doc_id") % 4 == 2, "drop").otherwise("KEEP_WITH_TAG")
    reply = F.concat(F.lit('so:\n{"decision": "'), d, F.lit('", "arkts_score": '), (F.col("doc_id") % 9).cast("string"), F.lit("} end"))
    j = judge.validated(judge.extracted_json(reply))
    return docs(spark, sf).select("doc_id", j.alias("j")).select("doc_id", "j.decision", "j.arkts_score")


# ---- shapes and scalars --------------------------------------------------------------------------------------------


@query(f"select doc_id, split_part(project_name, '/', -1) as project_name, sha256(path) as id from (select doc_id, 'org/' || project_name as project_name, path from ({DOCS_SQL}) where trim(text) <> '')")
def starcoder_format(spark, sf):
    raw = docs(spark, sf).select(F.col("path").alias("max_stars_repo_path"), F.concat(F.lit("org/"), "project_name").alias("max_stars_repo_name"), F.col("text").alias("content"))
    return shape.starcoder_records(raw).select(F.regexp_extract("path", r"doc_(\d+)", 1).cast("long").alias("doc_id"), "project_name", F.sha2("path", 256).alias("id"))


@query(f"select sha256(path) as id, path, project_name, sha256(case when doc_id % 5 = 0 then '' else 'a' || text || id end) as hash from ({DOCS_SQL})")
def fields_concat(spark, sf):
    d = docs(spark, sf)
    raw = d.select(F.lit("a").alias("above_functions"), F.when(F.col("doc_id") % 5 != 0, F.col("text")).alias("source_method_code"), F.col("id").alias("below_functions"), F.col("project_name").alias("projectName"), F.col("path").alias("filePath"))
    return shape.fields_records(raw).select("id", "path", "project_name", F.sha2("text", 256).alias("hash"))


_FENCE = "```arkts\n"


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    prompt = F.concat(
        F.lit(f"The context below the method is:\n{_FENCE}B\n```\n\nThe context above the method is:\n{_FENCE}"), "id", F.lit(f"\n```\n\nAnd here is the code snippet you are asked to complete:\n{_FENCE}S <unused98>\n```\n\nEnsure that only missing codes")
    )
    response = F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit(_FENCE), "text", F.lit("\n```"))).otherwise("no code")
    return docs(spark, sf).select(prompt.alias("prompt"), response.alias("response"), F.concat(F.lit("https://host.example/o/"), "project_name", F.lit(".git")).alias("repoUrl"))


@query(f"select project_name as path, project_name, sha256(id || repeat(chr(10), 3) || 'S ' || text || repeat(chr(10), 3) || 'B') as hash from ({DOCS_SQL}) where doc_id % 4 <> 0")
def prompt_concat(spark, sf):
    return shape.prompt_records(prompts(spark, sf)).select("path", "project_name", F.sha2("text", 256).alias("hash"))


@query("select page_id, split_part(regexp_replace(rtrim(url, '/'), '\\.git$', ''), '/', -1) as project from pages")
def project_from_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", shape.project_of(F.col("url")).alias("project"))


_NAMES = (
    ".gitignore", "a/.gitignore", "a/b.PY", "x.cxx", "x.unknownext", "d/y.tar.gz", "Dockerfile", "x.jsx", "X.TSX", "m.mm", "h.hs", "h.h", "c.cfg", "c.conf", "c.cmd", "q.clj",
    "q.cljs.edn", "q.coffee", ".Pipfile", "b/.Pipfile", "my.package.json", "stack.yaml.lock", "a.b/c", "noending", "r.r", "end.", "go.mod", "x.poetry.lock",
)
_ENDINGS = ", ".join(f"({quoted(k)}, {quoted(v)}, {i})" for i, (k, v) in enumerate(shape.LANGUAGES.items()))
_BARE = "lower(regexp_replace(regexp_extract(path, '([^/]*)/*$', 1), '^\\.+', ''))"


@query(
    f"with e(k, v, place) as (values {_ENDINGS}), n as (select p_partkey, [{', '.join(map(quoted, _NAMES))}][p_partkey % {len(_NAMES)} + 1] as path from part), f as (select distinct path, {_BARE} as bare from n),"
    " g as (select f.path, coalesce((select v from e where k = f.path and starts_with(f.path, '.')), (select v from e where k = regexp_extract(bare, '(\\.[^.]+)$', 1)),"
    " (select v from e where k = regexp_extract(bare, '^[^.]*(\\..*)$', 1) and not ends_with(bare, '.')), (select min_by(v, place) from e where contains(lower(f.path), lower(k))), 'Unknown') as language from f)"
    " select p_partkey, language from n join g using (path)"
)
def language_from_filename(spark, sf):
    names = F.array(*[F.lit(x) for x in _NAMES])
    return table(spark, sf, "part").select("p_partkey", shape.language_of(F.element_at(names, (F.col("p_partkey") % len(_NAMES) + 1).cast("int"))).alias("language"))


@query("select doc_id, lang || '.ets' as edited, [source, lang]::varchar[] as labels from documents")
def event_text(spark, sf):
    text = F.concat(F.lit('User edited "'), "lang", F.lit('.ets"\n<labels> '), "source", F.lit(", ,"), "lang", F.lit(" </labels>"))
    return table(spark, sf, "documents").select("doc_id", shape.edited_file(text).alias("edited"), shape.labels_in(text).alias("labels"))


_REPO_FILES = "select p_brand as repo, case when p_size % 3 = 0 then null when p_size % 3 = 1 then '.git/config' else 'src/' || p_partkey end as path from part"


@query(f"select repo, case when not g and not o then 'empty' when not g then 'invalid' when not o then 'incomplete' else 'complete' end as status from (select repo, coalesce(bool_or(starts_with(path, '.git/')), false) as g, coalesce(bool_or(not starts_with(path, '.git/')), false) as o from ({_REPO_FILES}) group by 1)")
def repo_status(spark, sf):
    path = F.when(F.col("p_size") % 3 == 1, ".git/config").when(F.col("p_size") % 3 == 2, F.concat(F.lit("src/"), F.col("p_partkey").cast("string")))
    return shape.repo_status(table(spark, sf, "part").select(F.col("p_brand").alias("repo"), path.alias("path")))


@query("select n_name, regexp_replace(n_name || ':a/b?', '[<>:\"/\\\\|?*]', '_', 'g') as safe from nation")
def safe_name(spark, sf):
    return table(spark, sf, "nation").select("n_name", shape.safe_name(F.concat("n_name", F.lit(":a/b?"))).alias("safe"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select(F.col("path").alias("file"), F.posexplode(F.split("text", "\n", -1)).alias("line_number", "content"))


_LINES_TABLE = f"select path as file, unnest(range(len(string_split(text, chr(10)))))::int as line_number, unnest(string_split(text, chr(10))) as content from ({DOCS_SQL})"


@query(f"select * from ({_LINES_TABLE}) where contains(content, 'License')")
def search_substring(spark, sf):
    return shape.search(_lines(spark, sf), "License")


@query(f"select * from ({_LINES_TABLE}) where regexp_matches(content, '(?i)\\blicense\\b')")
def search_word(spark, sf):
    return shape.search(_lines(spark, sf), "license", "word", True)


@query(f"select file, line_number, substring(content, greatest(1, instr(content, 'the') - 42), 88) as preview from ({_LINES_TABLE}) where contains(content, 'the')")
def search_preview(spark, sf):
    return shape.search(_lines(spark, sf), "the").select("file", "line_number", shape.match_preview(F.col("content"), "the").alias("preview"))


@query(f"select doc_id, len(list_distinct(regexp_extract_all(text, '[A-Za-z0-9_]+')))::int as n from documents")
def word_set_size(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(shape.word_set(F.col("text"))).alias("n"))


@query(r"select page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as text from pages")
def html_to_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", markdown.html_to_text(F.col("html")).alias("text"))


@query(
    "with d as (select doc_id, sha1(source || '/' || lang || '/doc_' || doc_id || '.ets') as p, source || '/' || lang || '/doc_' || doc_id || '.ets' as path, source from documents), k as (select * from (values ('let a = 1;', 1, 0), ('let b = 2;', 2, 0)) k(code, section, block)),"
    " r as (select *, p || '_' || section || '_' || block || '_' || left(sha1(code), 8) as key, 'Section: Guide' || case section when 1 then ' / ' || source else ' / Deep' end || chr(10) || 'Summary:' || chr(10) || case section when 1 then 'see b' else '- size: how large' || chr(10) || '- onClick runs it' end as told from d, k)"
    " select 'doc_inject:' || key as id, path, sha256('<DOC>' || chr(10) || told || chr(10) || 'Props:' || chr(10) || '- size: how large' || chr(10) || 'Events:' || chr(10) || '- onClick runs it' || chr(10) || '</DOC>' || chr(10) || '<CODE>' || chr(10) || code || chr(10) || '</CODE>') as hash from r"
    " union all select 'pure_code:' || key, path, sha256(code) from r"
)
def markdown_records(spark, sf):
    page = F.concat(F.lit("# Guide\n## "), "project_name", F.lit("\nsee [b](c)\n```ts\n  let a = 1;\n```\n```python\nx\n```\n## Deep\n- [size](number): how large\n- onClick runs it\n```js\nlet b = 2;\n```\n```ts\nopen\n"))
    return markdown.extract(docs(spark, sf).select("path", page.alias("text"))).select("id", "path", F.sha2("text", 256).alias("hash"))


@query(
    "select (select count(*) from documents) as total, (select count(*) from documents where doc_id % 4 <> 0) as prompt_processed, (select count(*) from documents where doc_id % 4 <> 0) as tags_replaced,"
    " (select count(*) from documents where doc_id % 4 = 0) as tags_left, (select array_to_string(list_sort(list_distinct(list(source))), ',') from documents where doc_id % 4 = 0) as left_paths"
)
def concat_statistics(spark, sf):
    return shape.concat_statistics(prompts(spark, sf)).select("total", "prompt_processed", "tags_replaced", "tags_left", F.array_join("left_paths", ",").alias("left_paths"))


@query("select doc_id, sha256(text) as hash from documents")
def text_fallback(spark, sf):
    return shape.with_text(docs(spark, sf).withColumnRenamed("text", "content")).select("doc_id", F.sha2("text", 256).alias("hash"))


@query("select doc_id, case when doc_id % 3 = 0 then null else lang end as lang from documents")
def safe_json(spark, sf):
    line = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("broken "), F.col("lang"))).otherwise(F.to_json(F.struct("lang")))
    return docs(spark, sf, "lang").select("doc_id", shape.parsed(line, "lang string")["lang"].alias("lang"))


@query(f"select status, count(*) as n, round(100.0 * count(*) / (select count(distinct p_brand) from part), 6) as percent from (select repo, case when not g and not o then 'empty' when not g then 'invalid' when not o then 'incomplete' else 'complete' end as status from (select repo, coalesce(bool_or(starts_with(path, '.git/')), false) as g, coalesce(bool_or(not starts_with(path, '.git/')), false) as o from ({_REPO_FILES}) group by 1)) group by 1")
def repo_rollup(spark, sf):
    return shape.repo_rollup(repo_status(spark, sf))


_SPLIT = "case doc_id % 5 when 0 then 'train' when 1 then 'valid' when 2 then 'test' when 3 then 'unused' else 'other' end"


@query(f"select doc_id, {_SPLIT} as split, row_number() over (order by case {_SPLIT} when 'train' then 0 when 'valid' then 1 when 'test' then 2 when 'unused' then 3 else 4 end, doc_id) - 1 as place from documents")
def split_order(spark, sf):
    k = F.col("doc_id") % 5
    split = F.when(k == 0, "train").when(k == 1, "valid").when(k == 2, "test").when(k == 3, "unused").otherwise("other")
    return shape.in_split_order(docs(spark, sf).select("doc_id", split.alias("split")), "split", "doc_id", place="place")


@query("select *, row_number() over (order by coalesce(project_name, ''), doc_id) - 1 as place from (select doc_id, case when doc_id % 4 = 0 then null else source end as project_name from documents)")
def project_order(spark, sf):
    d = docs(spark, sf).withColumn("project_name", F.when(F.col("doc_id") % 4 != 0, F.col("project_name")))
    return shape.by_project(d.select("doc_id", "project_name"), "doc_id", place="place")


@query("select doc_id from documents order by doc_id limit (select floor(count(*) * 1.5)::bigint from benchmark)")
def corpus_head(spark, sf):
    return shape.head_for(docs(spark, sf), table(spark, sf, "benchmark"), 1.5, "doc_id").select("doc_id")


@query("select category, count(*) * 2 as n from (select case doc_id % 3 when 0 then 'noise' when 1 then 'short' else 'fine' end as category from documents) group by 1")
def merged_categories(spark, sf):
    k = F.col("doc_id") % 3
    one = docs(spark, sf).groupBy(F.when(k == 0, "noise").when(k == 1, "short").otherwise("fine").alias("category")).agg(F.count("*").alias("n"))
    return judge.merged_categories([one, one])


def _trip(spark: SparkSession, tag: str) -> str:
    """A folder of its own in the shared folder, for a table that is written and read again."""
    import uuid

    return f"{ordering.shared_folder(spark).rstrip('/')}/loamworks-trip-{tag}-{uuid.uuid4().hex}"


@query("select doc_id, lang, sha256(text) as hash from documents")
def jsonl_round_trip(spark, sf):
    path = _trip(spark, "jsonl")
    files.write_jsonl(table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    return files.read_jsonl(spark, path, "doc_id long, lang string, text string").select("doc_id", "lang", F.sha2("text", 256).alias("hash"))


@query("select c_custkey, c_name, c_mktsegment from customer")
def csv_round_trip(spark, sf):
    path = _trip(spark, "csv")
    files.write_csv(table(spark, sf, "customer").select("c_name", "c_custkey", "c_mktsegment"), path)
    return spark.read.option("header", True).schema("c_custkey long, c_mktsegment string, c_name string").csv(path)


@query("select l_returnflag, count(*) as n from lineitem group by 1")
def partitioned_round_trip(spark, sf):
    path = _trip(spark, "parts")
    files.write_partitioned(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), path, "l_returnflag")
    return spark.read.schema("l_orderkey long, l_returnflag string").json(path).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("select n_nationkey, n_name, n_regionkey from nation")
def report_round_trip(spark, sf):
    path = _trip(spark, "report")
    files.write_report(table(spark, sf, "nation"), path)
    return files.read_json(spark, path).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("int").alias("n_regionkey"))


@query("select page_id, unnest(range(len(string_split(html, chr(10)))))::int as line_number, sha256(unnest(string_split(html, chr(10)))) as hash from pages")
def line_scan(spark, sf):
    """Whole files, a folder a page, read back line by line."""
    path = _trip(spark, "lines")
    pages = table(spark, sf, "pages").select("html", "page_id")
    pages.repartition("page_id").write.partitionBy("page_id").option("maxRecordsPerFile", 1).text(path)
    name = F.regexp_extract("_metadata.file_path", r"page_id=(\d+)", 1).cast("long")
    return files.read_lines(spark, path, name.alias("page_id")).select("page_id", "line_number", F.sha2("content", 256).alias("hash"))


# ---- augmentation, streams -----------------------------------------------------------------------------------------


@query()
def fim(spark, sf):
    return augment.fim(code(spark, sf)).select("id", "meta.strategy", "meta.middle_len", F.length("text").alias("chars"))


@query()
def fim_mix(spark, sf):
    return augment.fim_with_originals(docs(spark, sf), 10.0).select("id", "is_fim", "place")


def _functions(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("id", F.concat(F.lit("function f"), "id", F.lit("(first: string) {\n  let total = first;\n  return total; // total\n}\n")).alias("text"))


@query("select doc_id::varchar as source_id, 'function f' || doc_id || '(first: string) {' as prefix, chr(10) || '  let total = first;' || chr(10) || '  return total; // total' || chr(10) as middle, sha256('}' || chr(10)) as suffix_hash, 0 as start_line, 'function' as fim_type from documents")
def fim_functions(spark, sf):
    return augment.fim_functions(_functions(spark, sf)).select("source_id", "prefix", "middle", F.sha2("suffix", 256).alias("suffix_hash"), "start_line", "fim_type")


@query()
def fim_dataset(spark, sf):
    return augment.fim_dataset(code(spark, sf), 100).select("id", "meta.strategy", "meta.middle_len", F.length("text").alias("chars"))


@query()
def variable_rename(spark, sf):
    return augment.renamed(_functions(spark, sf)).select("id", "text", "augmentation", F.size("variable_mappings").alias("n"))


@query("select date_trunc('hour', ts) as start, event_type, count(*) as n, round(sum(value), 4) as value from events group by 1, 2")
def events_tumbling(spark, sf):
    return clean_stream.tumbling(table(spark, sf, "events"))
