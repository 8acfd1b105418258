"""Benchmark decontamination by templates. DataFrame operations only.

Texts and benchmark items are brought to a canonical form in which numbers, names and units are typed placeholders.
Windows of five canonical words are hashed and joined; an item of whose words the matched windows cover 0.8 or more is
found in the text, if its slots are filled consistently: wherever the item repeats a value, so does the text, each
with its own, however many words came in between. So a question with other numbers and names is caught, and a chance mixture of its windows is not. Capitals
in mid-sentence are names; at the start of a sentence they may be, so texts and items are also read with all capitalised
words as names, and with none. The queries also take near verbatim copies, whose unchanged windows alone cover 0.8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm.shared import written

WORDS = 5
COVERAGE = 0.8
#: Words of a window that must not be placeholders.
LITERALS = 2
#: Benchmark windows that are broadcast at most; a larger benchmark is joined by shuffle.
BROADCAST_WINDOWS = 500_000
#: Keys of texts to drop that are broadcast at most; more are taken out by a shuffled join.
BROADCAST_TEXTS = 1_000_000

# Units that count as such after a number.
UNITS = (
    "mm cm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards "
    "mg g kg t gram grams kilogram kilograms ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "hz khz mhz ghz w kw kwh mw v volt volts amp amps n j kj cal kcal pa bar psi k c f degree degrees percent "
    "usd eur gbp dollar dollars euro euros cent cents kb mb gb tb kmh mph"
).split()


def raw_words(text: Column) -> Column:
    """Words in lower case, digits with their separators as one word. Capitalised words are marked: by ``~`` in
    mid-sentence, where they are names, and by ``~~`` at the start of a sentence or line, where they may be."""
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), r"[.,](?<=\d.)(?=\d)", "")
    capitals = F.regexp_replace(F.regexp_replace(joined, "~", " "), r"(?=\p{Lu}\p{Ll})(?<![\p{L}\p{N}])", "~~")
    marked = F.regexp_replace(capitals, r"~~(?<=[\p{Ll}\p{N},;:] ~~)", "~")
    return F.filter(F.split(F.lower(marked), r"[^\p{L}\p{N}~]+"), lambda w: (w != "") & (w != "~"))


def _bare(word: Column) -> Column:
    return F.ltrim(word, F.lit("~"))


def _kind(word: Column, before: Column) -> Column:
    """The canonical word: ``#`` a number, ``&`` a unit after one, ``@`` a name, or the word."""
    digit = lambda w: w.substr(1, 1).between("0", "9")
    return F.when(word.startswith("~"), "@").when(digit(word), "#").when(digit(before) & word.isin(UNITS), "&").otherwise(word)


def _canon(raw: str) -> Column:
    return F.transform(raw, lambda w, i: _kind(w, F.when(i > 0, F.get(raw, i - 1)).otherwise("")))


def _window(words: str, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)])


def _text_windows(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, words, at, window: the hash of each run of five canonical words, where it starts, and the words themselves;
    where they differ also those with every capitalised word as a name and those with none. A row holds five words and
    never the text, so that a shuffle of the windows stays in proportion to it."""
    once = lambda c: F.explode(F.array(c))  # for all that read it
    held = df.select(*keys, once(F.struct(F.col("raw").alias("marked"), F.transform("raw", _bare).alias("raw"))).alias("h")).select(*keys, "h.*").where(F.size("raw") >= WORDS)
    held = held.select(*keys, "marked", "raw", once(F.transform(_canon("raw"), lambda w: F.xxhash64(w))).alias("none"))
    name = F.xxhash64(F.lit("@"))
    some = F.transform("marked", lambda w, i: F.when(w.startswith("~") & ~w.startswith("~~"), name).otherwise(F.get("none", i)))
    every = F.transform("marked", lambda w, i: F.when(w.startswith("~"), name).otherwise(F.get("none", i)))
    held = held.select(*keys, "raw", "none", once(F.struct(some.alias("some"), every.alias("every"))).alias("f")).select(*keys, "raw", "none", "f.*")
    last = F.size("none") - WORDS

    def differ(form: str) -> Column:
        """The starts of windows that hold a word in which ``form`` differs from ``some``."""
        places = F.filter(F.transform(form, lambda h, i: F.when(h != F.get("some", i), i)), lambda i: i.isNotNull())
        return F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(F.greatest(i - WORDS + 1, F.lit(0)), F.least(i, last)))))

    of = lambda form, at: F.transform(at, lambda i: F.struct(i.alias("at"), _window(form, i).alias("window")))
    windows = F.concat(of("some", F.sequence(F.lit(0), last)), of("every", differ("every")), of("none", differ("none")))
    # made once as well: of what inline() reads itself, Spark also makes a filter
    return held.select(*keys, "raw", once(windows).alias("windows")).select(*keys, "raw", F.inline("windows")).select(*keys, "at", "window", F.slice("raw", F.col("at") + 1, WORDS).alias("words"))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """window, item_id, form, item_at, coverable: a row for each window with enough literals; coverable counts the
    item's words that such windows hold. An item with names has a second form without them, as a text in small or in
    large letters only shows no names; one with capitals at the start of a sentence has a third in which they are names."""
    found = benchmark.select(benchmark[id_col].alias("item_id"), raw_words(benchmark[text_col]).alias("raw")).where(F.size("raw") >= WORDS)
    marked = lambda mark: F.exists("raw", lambda w: w.startswith(mark))
    as_form = lambda df, n, change: df.select("item_id", F.transform("raw", change).alias("raw"), F.lit(n).alias("form"))
    items = as_form(found, 0, lambda w: F.regexp_replace(w, "^~~", "")).unionByName(as_form(found.where(marked("~")), 1, _bare)).unionByName(as_form(found.where(marked("~~")), 2, lambda w: F.regexp_replace(w, "^~~", "~")))
    items = items.select("item_id", "form", "raw", F.explode(F.array(_canon("raw"))).alias("canon"))
    items = items.withColumn("hashes", F.transform("canon", lambda w: F.xxhash64(w)))
    literal = lambda i: sum((~F.get("canon", i + k).isin("@", "#", "&")).cast("int") for k in range(WORDS)) >= LITERALS
    usable = F.filter(F.sequence(F.lit(0), F.size("canon") - WORDS), literal)
    rows = items.select("item_id", "form", F.transform("raw", _bare).alias("raw"), "canon", "hashes", usable.alias("usable")).withColumn("coverable", _covered(F.col("usable")))
    return rows.select("item_id", "form", "coverable", "raw", "canon", "hashes", F.explode("usable").alias("item_at")).select(
        _window("hashes", F.col("item_at")).alias("window"),
        "item_id",
        "form",
        "item_at",
        "coverable",
        F.slice("raw", F.col("item_at") + 1, WORDS).alias("item_raw"),
        F.slice("canon", F.col("item_at") + 1, WORDS).alias("item_canon"),
    )


def _covered(starts: Column) -> Column:
    """How many words the windows that start there hold; starts are distinct."""
    ordered = F.array_sort(starts)
    gaps = F.aggregate(ordered, F.struct(F.lit(0).alias("n"), F.lit(-WORDS).alias("last")), lambda a, s: F.struct((a["n"] + F.least(F.lit(WORDS), s.cast("int") - a["last"])).alias("n"), s.cast("int").alias("last")))
    return gaps["n"]


def _short_matches(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame | None:
    """doc_id, text_key, item_id: texts that hold an item of at most ``WORDS`` words, word for word; None without such items."""
    whole = lambda words: F.xxhash64(F.array_join(words, " "))
    bare = lambda text: F.transform(raw_words(text), _bare)
    items = benchmark.select(benchmark[item_col].alias("item_id"), bare(benchmark[item_text_col]).alias("w")).where(F.size("w").between(1, WORDS))
    lengths = {r["n"]: r["count"] for r in items.groupBy(F.size("w").alias("n")).count().collect()}  # at most WORDS rows
    if not lengths:
        return None
    items = items.select("item_id", F.size("w").alias("n"), whole(F.col("w")).alias("key"))
    if sum(lengths.values()) <= BROADCAST_WINDOWS:
        items = F.broadcast(items)
    texts = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_key"), F.explode(F.array(bare(docs[text_col]))).alias("raw"))

    def run(n: int) -> Column:
        starts = F.when(F.size("raw") >= n, F.sequence(F.lit(0), F.size("raw") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(n).alias("n"), whole(F.slice("raw", i + 1, n)).alias("key")))

    runs = [run(n) for n in sorted(lengths)]
    keyed = texts.select("doc_id", "text_key", F.explode(F.array(F.array_distinct(F.concat(*runs)))).alias("runs")).select("doc_id", "text_key", F.inline("runs"))
    return keyed.join(items, ["n", "key"]).select("doc_id", "text_key", "item_id")


def matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE, near_verbatim: bool = False) -> DataFrame:
    """doc_id, text_key, item_id, coverage, n_slots, reparameterised: a row for each text and each item found in it.

    text_key is the text's hash: repeated rows (same id, same text) give one row. Items repeated under other ids are
    other items. Null and empty texts and items match nothing; null ids are kept. Items of up to five words are also
    found by their whole word sequence, so an item of one common word is found in every text with that word. An empty
    table on either side gives no rows. Other columns are not read. With ``near_verbatim``, an item whose windows the
    text holds word for word up to ``coverage`` is found however the other slots are filled.
    """
    items = benchmark_windows(benchmark, item_col, item_text_col)
    if items.count() <= BROADCAST_WINDOWS:
        items = F.broadcast(items)
    exploded = _text_windows(docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_key"), raw_words(docs[text_col]).alias("raw")), ["doc_id", "text_key"])
    pair = lambda k: F.struct((F.col("item_at") + k).alias("place"), F.get("item_raw", F.lit(k)).alias("item"), F.get("words", F.lit(k)).alias("doc"))
    slots = F.filter(F.array(*[F.when(F.get("item_canon", F.lit(k)).isin("@", "#", "&"), pair(k)) for k in range(WORDS)]), lambda p: p.isNotNull())
    hits = exploded.join(items, "window").select("doc_id", "text_key", "item_id", "form", "coverable", "item_at", (F.col("at") - F.col("item_at")).alias("shift"), slots.alias("slots"))
    changed = lambda c: F.exists(c, lambda p: p["item"] != p["doc"])
    # All windows of a text are in one task, so these combine before the shuffle; sets are bounded by the item.
    lined = hits.groupBy("doc_id", "text_key", "item_id", "form", "coverable", "shift").agg(F.collect_set("item_at").alias("starts"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"), F.collect_set(F.when(~changed("slots"), F.col("item_at"))).alias("same"))
    # A slot of other many words shifts what follows. Each place of the item is read from the shift that covers most (the
    # first of equal ones) of those that hold it, so that a chance hit elsewhere decides nothing.
    runs = F.array_sort(F.collect_list(F.struct((-F.size("starts")).alias("less"), "shift", "slots")))
    places = lambda m: F.transform(m, lambda p: p["place"])
    merged = F.aggregate(runs, F.array().cast("array<struct<place: int, item: string, doc: string>>"), lambda got, r: F.concat(got, F.filter(r["slots"], lambda p: ~F.array_contains(places(got), p["place"]))))
    whole = lined.groupBy("doc_id", "text_key", "item_id", "form", "coverable").agg(
        F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"),
        F.array_distinct(F.flatten(F.collect_list("same"))).alias("same"),
        merged.alias("placed"),
    )
    whole = whole.withColumn("slots", F.array_distinct(F.transform("placed", lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc")))))
    filled = F.array_distinct(F.transform("slots", lambda p: p["item"]))
    accepted = F.size(filled) == F.size("slots")
    if near_verbatim:
        accepted = accepted | (_covered(F.col("same")) / F.col("coverable") >= coverage)
    found = (
        whole.withColumn("coverage", _covered(F.col("starts")) / F.col("coverable"))
        .where((F.col("coverage") >= coverage) & accepted)
        .select("doc_id", "text_key", "item_id", F.struct("coverage", (-F.col("form")).alias("form"), F.size("slots").cast("long").alias("n_slots"), changed("slots").alias("reparameterised")).alias("b"))
    )
    short = _short_matches(docs, benchmark, id_col, text_col, item_col, item_text_col)
    if short is not None:
        b = F.struct(F.lit(1.0).alias("coverage"), F.lit(-3).alias("form"), F.lit(0).cast("long").alias("n_slots"), F.lit(False).alias("reparameterised"))
        found = found.unionByName(short.select("doc_id", "text_key", "item_id", b.alias("b")))
    return found.groupBy("doc_id", "text_key", "item_id").agg(F.max("b").alias("b")).select("doc_id", "text_key", "item_id", "b.coverage", "b.n_slots", "b.reparameterised")


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", near_verbatim: bool = False) -> DataFrame:
    """The rows, with all their columns, whose texts hold no benchmark item. Null and empty texts stay."""
    bad = written(matches(docs, benchmark, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col, near_verbatim=near_verbatim).select(F.col("text_key").alias("__text_key")).distinct(), "leaked")
    if bad.count() <= BROADCAST_TEXTS:
        bad = F.broadcast(bad)
    return docs.join(bad, F.xxhash64(docs[text_col]) == bad["__text_key"], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), near_verbatim=True)
    return found.select("doc_id", "item_id", F.round("coverage", 6).alias("coverage"), "n_slots", "reparameterised")
