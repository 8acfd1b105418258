"""Model judgements: calls, validation, consensus, full runs."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DECISIONS = ("KEEP", "KEEP_WITH_TAG", "REMOVE")
JUDGEMENT = (
    "decision string, labels array<string>, arkts_score double, quality_score double, confidence double, rationale string, "
    "model string, temperature double, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint, raw_response string"
)
USAGE = ("prompt_tokens", "completion_tokens", "total_tokens")
PARSED = "decision string, labels array<string>, arkts_score double, quality_score double, confidence double, rationale string"


def json_object(reply: str | None) -> str | None:
    """The first JSON object in a reply: in a fence, from the first to the last brace, or by matching braces."""
    if not reply:
        return None
    fenced = re.search(r"```(?:json)?\s*(.*?)```", reply, re.DOTALL)
    body = fenced.group(1) if fenced else reply
    whole = re.search(r"\{.*\}", body, re.DOTALL)
    tries = [body.strip(), whole.group(0) if whole else ""]
    for start in (m.start() for m in re.finditer(r"\{", body)):
        depth, quoted, skip = 0, False, False
        for at in range(start, len(body)):
            ch = body[at]
            if skip:
                skip = False
            elif quoted:
                skip, quoted = ch == "\\", ch != '"'
            elif ch == '"':
                quoted = True
            elif ch in "{}":
                depth += 1 if ch == "{" else -1
                if depth == 0:
                    tries.append(body[start : at + 1])
                    break
    for t in tries:
        try:
            if isinstance(json.loads(t), dict):
                return t
        except ValueError:
            continue
    return None


@F.pandas_udf(StringType())
def extracted_json(replies: pd.Series) -> pd.Series:
    return replies.map(json_object)


def validated(text: Column) -> Column:
    """A judgement struct from JSON text: the decision upper-cased and known, scores within 0 to 5, confidence within 0
    to 1, the rationale cut to 400 characters; null if the decision isn't one of the three."""
    raw = F.from_json(text, PARSED)
    within = lambda c, low, high, default: F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(raw[c], F.lit(default))))
    decision = F.upper(F.trim(raw["decision"]))
    made = F.struct(
        decision.alias("decision"),
        F.coalesce(raw["labels"], F.array().cast("array<string>")).alias("labels"),
        within("arkts_score", 0.0, 5.0, 0.0).alias("arkts_score"),
        within("quality_score", 0.0, 5.0, 0.0).alias("quality_score"),
        within("confidence", 0.0, 1.0, 0.0).alias("confidence"),
        F.substring(F.coalesce(raw["rationale"], F.lit("")), 1, 400).alias("rationale"),
    )
    return F.when(decision.isin(*DECISIONS), made)


def severity(decision: Column) -> Column:
    return F.when(decision == "REMOVE", 2).when(decision == "KEEP_WITH_TAG", 1).otherwise(0)


def consensus(judgements: DataFrame) -> DataFrame:
    """A row an item: the decision with most votes (the more severe on a tie), all labels, mean scores, and rationales in
    replica order cut to 400 characters."""
    votes = F.array(*[F.struct(F.count_if(F.col("decision") == d).alias("votes"), F.lit(i).alias("severity"), F.lit(d).alias("decision")) for i, d in enumerate(DECISIONS)])
    told = F.transform(F.array_sort(F.collect_list(F.struct("replica", F.coalesce("rationale", F.lit("")).alias("r")))), lambda x: x["r"])
    mean = lambda c: F.round(F.avg(c), 3)
    return judgements.groupBy("item_id").agg(
        F.array_max(votes)["decision"].alias("final_decision"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("final_labels"),
        mean("arkts_score").alias("final_arkts_score"),
        mean("quality_score").alias("final_quality_score"),
        mean("confidence").alias("final_confidence"),
        F.substring(F.array_join(F.filter(told, lambda x: x != ""), "; "), 1, 400).alias("rationale_sample"),
        F.count("*").alias("replicas"),
    )


def with_consensus(items: DataFrame, judgements: DataFrame, key: str = "item_id") -> DataFrame:
    """Every item; those without a judgement are kept with a tag, middling scores and little confidence."""
    empty = {"final_decision": F.lit("KEEP_WITH_TAG"), "final_labels": F.array().cast("array<string>"), "final_arkts_score": F.lit(3.0), "final_quality_score": F.lit(3.0), "final_confidence": F.lit(0.3), "rationale_sample": F.lit(""), "replicas": F.lit(0).cast("long")}
    return items.join(consensus(judgements), key, "left").withColumns({c: F.coalesce(F.col(c), d) for c, d in empty.items()})


def by_decision(df: DataFrame, decision_col: str = "decision") -> dict[str, DataFrame]:
    return {d: df.where(F.col(decision_col) == d) for d in DECISIONS}


def judge(items: DataFrame, call: Callable[[str, float], str], template: str, *, key: str = "item_id", text_col: str = "text", replicas: int = 3, temperatures: tuple[float, ...] = (0.2, 0.5, 0.8), model: str = "stub", concurrency: int | None = None) -> DataFrame:
    """Judgements of every item by every replica, in the columns of ``JUDGEMENT``. ``call(prompt, temperature)`` is the
    connection to a model: it returns the reply, or a reply and its usage (prompt_tokens, completion_tokens,
    total_tokens). A connection's error (OSError) or an unreadable reply becomes a judgement that keeps the row with a
    tag; any other failure one of the item ``UNKNOWN``, so that a resumed run judges the item again."""
    # plain strings, so that executors need nothing but the callable

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for item, replica, text, heat in zip(f["item_id"], f["replica"], f["text"], f["temperature"]):
                reply, usage, error = None, {}, None
                try:
                    got = call(template.replace("{code}", text or ""), heat)
                    reply, usage = got if isinstance(got, tuple) else (got, {})
                except OSError as e:
                    error = f"API_ERROR {e}"[:400]
                except Exception as e:  # noqa: BLE001  whatever else a caller's code raises
                    item, error = "UNKNOWN", f"EXEC_ERROR {e}"[:400]
                out.append((item, replica, heat, reply, error, *(usage.get(k) for k in USAGE)))
            yield pd.DataFrame(out, columns=["item_id", "replica", "temperature", "raw_response", "error", *USAGE]).astype(dict.fromkeys(USAGE, "Int64"))

    heats = F.array(*[F.lit(t) for t in temperatures])
    jobs = items.select(F.col(key).cast("string").alias("item_id"), F.col(text_col).alias("text"), F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("replica"))
    jobs = jobs.withColumn("temperature", F.element_at(heats, F.least(F.col("replica"), F.lit(len(temperatures) - 1)) + 1))
    if concurrency:
        jobs = jobs.repartition(concurrency)
    answers = jobs.mapInPandas(run, "item_id string, replica int, temperature double, raw_response string, error string, " + ", ".join(f"{k} bigint" for k in USAGE))
    made = answers.withColumn("j", validated(extracted_json("raw_response")))
    fallback = lambda label, sure, why: F.struct(F.lit("KEEP_WITH_TAG").alias("decision"), F.array(F.lit(label)).alias("labels"), F.lit(3.0).alias("arkts_score"), F.lit(3.0).alias("quality_score"), F.lit(sure).alias("confidence"), why.alias("rationale"))
    reason = F.regexp_replace("error", "^[A-Z_]+ ", "")
    failed = F.when(F.col("error").startswith("EXEC_ERROR"), fallback("EXEC_ERROR", 0.2, reason)).otherwise(fallback("API_ERROR", 0.2, reason))
    unread = fallback("PARSE_ERROR", 0.3, F.lit("the reply holds no judgement"))
    return made.withColumn("j", F.when(F.col("error").isNotNull(), failed).otherwise(F.coalesce("j", unread))).select("item_id", "replica", "j.*", F.lit(model).alias("model"), "temperature", *USAGE, "raw_response")


def resumed(items: DataFrame, judged: DataFrame, key: str = "item_id") -> DataFrame:
    """Items that have no judgement yet."""
    return items.join(judged.select(key).distinct(), key, "left_anti")


def full_run(items: DataFrame, path: str, call: Callable[[str, float], str], template: str, *, key: str = "item_id", **more) -> tuple[DataFrame, DataFrame]:
    """Judge the items that the table at ``path`` (JSON lines, appended to) has no judgement of, and return all judgements
    with the items' other columns, and the summary. A run that broke off goes on where it was: what it wrote stays."""
    from loamworks.operators.joins import with_originals

    spark = items.sparkSession
    kind = f"item_id string, replica int, {JUDGEMENT}"
    past = Path(spark, path)
    todo = items.withColumn(key, F.col(key).cast("string"))
    if past.exists():
        done = spark.read.schema(kind).json(path).where("item_id <> 'UNKNOWN'")
        todo = resumed(todo, done.withColumnRenamed("item_id", key), key)
    judge(todo, call, template, key=key, **more).write.mode("append").json(path)
    judged = spark.read.schema(kind).json(path)
    own = items.withColumn("item_id", F.col(key).cast("string"))
    return with_originals(judged, own, "item_id"), summary(own, judged)


class Path:
    """A path of any file system that Spark knows."""

    def __init__(self, spark, path: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return bool(self.system.exists(self.path))


def summary(items: DataFrame, judgements: DataFrame, text_col: str = "text") -> DataFrame:
    """The consensus of each judged item, rounded, with its source, language and length."""
    has = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in items.columns else F.lit("")
    known = items.select("item_id", has("source").alias("source"), has("lang").alias("lang"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("len_chars"))
    return consensus(judgements).join(known, "item_id", "left")


def usage_totals(judgements: DataFrame) -> DataFrame:
    """Judgements, distinct items, failures by kind and tokens, in one row."""
    labelled = lambda x: F.count_if(F.array_contains("labels", x))
    tokens = [F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in USAGE]
    return judgements.agg(F.count("*").alias("judgements"), F.count_distinct("item_id").alias("items"), *[labelled(x).alias(x.lower()) for x in ("API_ERROR", "PARSE_ERROR", "EXEC_ERROR")], *tokens)


def merged_categories(rounds: list[DataFrame]) -> DataFrame:
    """category, n: counts (category, n) of several rounds added up."""
    from loamworks.operators.joins import concatenated

    return concatenated(*rounds).groupBy("category").agg(F.sum("n").alias("n"))


def rules_from(report: DataFrame, call: Callable[[str, float], str], most: int = 20) -> list[dict]:
    """Rules (name, description, implementation, thresholds, expected_impact) that a model draws up from the reasons of each
    of the ``most`` largest categories; an unreadable answer gives none. A report has a row a category, so this is done
    on the driver."""
    rules = []
    for r in report.orderBy(F.desc("n"), "category").limit(most).collect():
        prompt = f"Category: {r['category']}\nRows: {r['n']}\nReasons:\n" + "\n".join(f"- {x}" for x in r["reasons"])
        try:
            got = json.loads(json_object(call(prompt, 0.2)) or "null")
            rules.append({"name": str(got["name"]), **{k: str(got.get(k, "")) for k in ("description", "implementation", "expected_impact")}, "thresholds": dict(got.get("thresholds") or {})})
        except (OSError, ValueError, KeyError, TypeError):
            continue
    return rules


def integrated(df: DataFrame, rules: list[dict], text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows with ``reject_reason`` by the filters that the rules stand for, in the rules' order (each filter once; rules
    that stand for none are left out), and what each filter applied to and rejected."""
    from loamworks.operators.filters import filter_statistics, rule_for, with_reject_reason

    names = tuple(dict.fromkeys(n for r in rules if (n := rule_for(r["name"], r.get("implementation", ""))) is not None))
    if not names:
        none = df.sparkSession.createDataFrame([], "filter string, applied long, filtered long, rate double")
        return df.withColumn("reject_reason", F.lit(None).cast("string")), none
    out = with_reject_reason(df, names, text_col)
    return out, filter_statistics(out, names)


def rule_rounds(df: DataFrame, detect: Callable[[DataFrame, int], DataFrame], call: Callable[[str, float], str], rounds: int = 3, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows that stay after several rounds, and the categories of all rounds. In each, ``detect(rows, round)`` finds
    dirty rows (as ``dirty_rows`` returns them), rules are drawn up from its report and applied; a round without a rule
    is the last. Rows between rounds are checkpointed."""
    from loamworks.operators.ordering import checkpointed

    counts = []
    for n in range(rounds):
        report = checkpointed(category_report(detect(df, n)))
        counts.append(report.select("category", "n"))
        rules = rules_from(report, call)
        if not rules:
            break
        df = checkpointed(integrated(df, rules, text_col)[0].where("reject_reason is null").drop("reject_reason"))
    return df, merged_categories(counts)


def dirty_rows(items: DataFrame, call: Callable[[str, float], str], template: str, *, key: str = "item_id", text_col: str = "text") -> DataFrame:
    """is_dirty, category, reason, confidence; a failed call or reply counts as clean, of category ``error``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for i, text in zip(f["item_id"], f["text"]):
                try:
                    got = json.loads(json_object(call(template.replace("{code}", text or ""), 0.1)) or "null")
                    out.append((i, bool(got["is_dirty"]), str(got.get("category", "unknown")), str(got.get("reason", "")), float(got.get("confidence", 0.0))))
                except Exception as e:  # noqa: BLE001
                    out.append((i, False, "error", str(e)[:400], 0.0))
            yield pd.DataFrame(out, columns=["item_id", "is_dirty", "category", "reason", "confidence"])

    source = items.select(F.col(key).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(run, "item_id string, is_dirty boolean, category string, reason string, confidence double")


def category_report(found: DataFrame, samples: int = 3) -> DataFrame:
    """Per category of dirty rows: how many, and the first reasons by item."""
    from pyspark.sql import Window

    # the first few reasons are cut before they are gathered
    top = found.where("is_dirty").withColumn("__n", F.row_number().over(Window.partitionBy("category").orderBy("item_id")))
    reasons = top.where(F.col("__n") <= samples).groupBy("category").agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "reason"))), lambda x: x["reason"]).alias("reasons"))
    return found.where("is_dirty").groupBy("category").agg(F.count("*").alias("n")).join(reasons, "category")


def rating(reply: Column) -> Column:
    return F.struct(F.regexp_extract(reply, r"Score:\s*([1-5])", 1).try_cast("int").alias("score"), F.regexp_extract(reply, r"Reason:\s*([^\n]*)", 1).alias("reason"))
