"""Lattices, models, licences and decontamination against brute force, and on odd tables; the pipeline and the queries."""

import math
import zlib
from collections import Counter
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from loamworks.llm import decontaminate
from loamworks.llm import lattice as lattice_of
from loamworks.llm import lattice_lm, license_scan, piece_sampling, quality_gam, queries, toxicity_pu
from loamworks.llm.lattice import Lattice, Vocabulary, load_vocabulary
from loamworks.llm.shared import crc_mod

DOCS = "doc_id long, text string, ids string, decoded string, word string, score double, window long"
TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", 0.5, 3) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(piece_sampling.VOCABULARY)


def segmentations(v, unit):
    look = {p: i for i, p in enumerate(v.pieces) if p}

    def rest(at):
        if at == len(unit):
            yield ()
            return
        if unit[at] not in look:
            for r in rest(at + 1):
                yield (*(int(v.byte_ids[b]) for b in unit[at].encode()), *r)
        for end in range(at + 1, len(unit) + 1):
            if unit[at:end] in look:
                for r in rest(end):
                    yield (look[unit[at:end]], *r)

    return {s: float(v.log_weight[list(s)].sum()) for s in rest(0)}


def test_lattice_sums_all_segmentations(vocabulary):
    lattice = Lattice(vocabulary)
    units = [" the", " tho☃r", "\n", "   ab", "a", " tionnt", "", "é汉"]
    got = lattice.log_marginal(units)
    for unit, g in zip(units, got):
        assert g == pytest.approx(math.log(sum(map(math.exp, segmentations(vocabulary, unit).values()))) if unit else 0.0)


@pytest.mark.parametrize(("segment", "block"), [(1 << 17, 256), (512, 64), (300, 7), (17, 5)])
def test_long_units_by_segments_equal_the_plain_recursion(vocabulary, monkeypatch, segment, block):
    monkeypatch.setattr(lattice_of, "SEGMENT", segment)
    monkeypatch.setattr(lattice_of, "BLOCK", block)
    lattice = Lattice(vocabulary)
    unit = " " + "".join(np.random.default_rng(0).choice(list("aeionthrsé☃😀"), 900))
    _, piece, alpha, _ = lattice.forward([unit], 0.7)
    look = {p: i for i, p in enumerate(vocabulary.pieces) if p}
    states = list(lattice.states(unit, 0.7))
    assert states[-1][0] == pytest.approx(alpha[-1])
    for i, start in enumerate(range(0, len(unit), segment)):
        ids, cdf = lattice.segment(unit, start, states[i], 0.7)
        for j in range(ids.shape[1]):
            end, chance = start + j + 1, [0.0] * lattice.reach
            for l in range(min(lattice.reach, end)):
                text = unit[end - l - 1 : end]
                assert ids[l, j] == look.get(text, -2 if l == 0 else -1)
                weight = vocabulary.log_weight[look[text]] if text in look else lattice.byte_weight(np.array([ord(text)]))[0] if l == 0 else -np.inf
                chance[l] = math.exp(0.7 * weight + (alpha[end - l - 2] if end - l - 2 >= 0 else 0.0) - alpha[end - 1])
            assert np.allclose(np.cumsum(chance), cdf[j], atol=1e-5)


def test_words_of_megabytes(spark, vocabulary):
    word = "".join(np.random.default_rng(1).choice(list("aeionthrsé☃"), 1_500_000))
    table = docs(spark, [(1, word), (2, f"a {word[:70_000]} b"), (3, word), (7, " " * 300_000)])
    out = {r["doc_id"]: r for r in piece_sampling.encode_sampled(table, vocabulary, decoded_col="back").collect()}
    assert all(r["back"] == r["text"] for r in out.values()) and 0 < len(out[1]["ids"]) < 2 * len(word)
    scored = {r["doc_id"]: r for r in lattice_lm.score_documents(table, F.col("doc_id") == 1, vocabulary).collect()}
    assert scored[1]["n_tokens"] == 2 and scored[3]["n_known"] == 2 and scored[1]["score"] == scored[3]["score"] < scored[2]["score"] < scored[7]["score"] < 0
    assert scored[1]["adapted_score"] > -3 and math.isfinite(scored[2]["adapted_score"])


def test_samples_follow_the_weights(vocabulary):
    sampler = piece_sampling.Sampler(vocabulary, 0.5, 42)
    n = 100_000
    ids, per = sampler.sample([" thon☃"] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919), np.zeros(n, np.int64))
    ends = np.cumsum(per)
    counts = Counter(tuple(ids[e - p : e].tolist()) for e, p in zip(ends, per))
    every = {s: math.exp(w * 0.5) for s, w in segmentations(vocabulary, " thon☃").items()}
    for s, w in every.items():
        p = w / sum(every.values())
        assert abs(counts[s] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_encoding_is_lossless_and_reproducible(spark, vocabulary, monkeypatch):
    odd = ["", None, " ", "  a", "▁x ▁", "\n\n a\r\n\t", "\x00\x01", "ab☃ 😀 y", "   ", "long " * 5000, "x" * 3000]
    table = docs(spark, [*enumerate(odd), (0, "same"), (0, "same"), (None, "no key")])
    first = piece_sampling.encode_sampled(table, vocabulary)
    assert sorted(first.columns) == sorted(table.columns)
    decoded = piece_sampling.decode_ids(first, vocabulary).collect()
    assert all(r["decoded"] == r["text"] and (r["ids"] is None) == (r["text"] is None) for r in decoded)
    assert all(r["decoded"] == r["text"] for r in piece_sampling.encode_sampled(table, vocabulary, decoded_col="decoded").collect())
    over = {r["doc_id"]: r["text"] for r in piece_sampling.encode_sampled(table, vocabulary, out_col="text").collect()}
    assert over[1] is None and over[3] == [r["ids"] for r in decoded if r["doc_id"] == 3][0]
    again = piece_sampling.encode_sampled(table.repartition(3).coalesce(1), vocabulary).collect()
    row = lambda r: (r["doc_id"], r["text"], None if r["ids"] is None else tuple(r["ids"]))
    assert Counter(map(row, again)) == Counter(map(row, first.collect()))
    assert piece_sampling.encode_sampled(docs(spark, []), vocabulary).count() == 0
    sampler = piece_sampling.Sampler(vocabulary, 1.0, 42)
    whole = sampler.encode(odd[4:], np.arange(7, dtype=np.uint64))
    assert len(whole[6]) > 0
    monkeypatch.setattr(lattice_of, "CHUNK_CHARS", 50)
    assert all(np.array_equal(a, b) for a, b in zip(whole, sampler.encode(odd[4:], np.arange(7, dtype=np.uint64))))
    long = np.concatenate([sampler.sample_long("   thon☃", np.uint64(k), 0)[None][:, :1] for k in range(2000)])
    short, per = sampler.sample(["   thon☃"] * 2000, np.arange(2000, dtype=np.uint64), np.zeros(2000, np.int64))
    assert np.array_equal(long[:, 0], short[np.cumsum(per) - per])  # the same draws


@pytest.mark.parametrize("frequent", [200_000, 3, 0])
def test_language_model(spark, vocabulary, frequent):
    rows = [(i, f"The cat {'Sat' * (i % 3)} on  é\x1cx\t{i}") for i in range(30)] + [(3, "again again")] * 2 + [(None, None), (50, ""), (51, "cat " * 70_000 + "unseen")]
    out = lattice_lm.score_documents(docs(spark, rows), crc_mod("doc_id", 7) != 2, vocabulary, frequent=frequent).collect()
    trains = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    counts = Counter(w for i, t in rows if trains(i) for w in [*lattice_lm.tokens(t), b""])
    n, v, end = sum(counts.values()), len(counts), counts[b""] / sum(counts.values())
    weight = np.exp(vocabulary.log_weight)
    weight[vocabulary.end_id] = 0
    with np.errstate(divide="ignore"):
        own = replace(vocabulary, log_weight=np.log(weight / weight.sum() * (1 - end)))
    chance = {w: sum(map(math.exp, segmentations(own, f" {w.decode()}").values())) if w else end for w in {w for _, t in rows for w in [*lattice_lm.tokens(t), b""]}}
    assert len(out) == len(rows)
    got = Counter((r["doc_id"], r["trains"], r["n_tokens"], r["n_known"], r["train_tokens"], *(round(r[c], 4) for c in ("base_score", "score", "adapted_score"))) for r in out)
    want = Counter()
    for i, t in rows:
        ws = [*lattice_lm.tokens(t), b""]
        of = lambda f: round(sum(math.log10(f(w)) for w in ws), 4)
        want[(i, trains(i), len(ws), sum(counts[w] > 0 for w in ws), n, of(lambda w: (counts[w] + 1) / (n + v + 1)), of(chance.get), of(lambda w: (counts[w] + v * chance[w]) / (n + v)))] += 1
    assert got == want
    assert lattice_lm.score_documents(docs(spark, []), crc_mod("doc_id", 7) != 2, vocabulary).count() == 0
    none = lattice_lm.score_documents(docs(spark, rows), F.lit(None).cast("boolean"), vocabulary).agg(F.max("n_known"), F.max("train_tokens"), F.count_if(~F.isnan("adapted_score"))).first()
    assert tuple(none) == (0, 0, len(rows))


def test_words_that_are_broadcast(spark):
    words = spark.createDataFrame([(f"w{i}".encode(), 1 if i < 900 else i) for i in range(1000)], "word binary, total long")
    for most in (0, 1, 50, 100, 500, 1000, 2000):
        got = [r["total"] for r in words.where(lattice_lm._split(words, most)).collect()]
        assert len(got) <= most and len(got) >= min(most, 1000) * 0.8 and sum(t > 1 for t in got) >= min(most, 100) * 0.6


def accuracy(out, labels, label):
    j = out.join(labels, "doc_id").where("held_out")
    rows = j.select("predicted", label, "score").collect()
    return sum(r["predicted"] == r[label] for r in rows) / len(rows), rows


def test_quality_on_held_out_rows(spark):
    share, _ = accuracy(quality_gam.query(spark, SMALL), spark.read.parquet(f"{SMALL}/labels.parquet"), "quality")
    assert share >= 0.95


def test_toxicity_on_held_out_rows(spark):
    share, rows = accuracy(toxicity_pu.query(spark, SMALL), spark.read.parquet(f"{SMALL}/labels.parquet"), "toxic")
    assert share >= 0.9 and sum(r["predicted"] and not r["toxic"] for r in rows) <= 2


def test_risk_is_corrected_and_kept_from_going_negative():
    z = np.array([4.0, 4.0, -4.0, -4.0, -4.0, 4.0])
    positive = np.array([True, True, False, False, False, False])
    hit, as_clean, unlabelled = toxicity_pu.risk(z, positive, 0.25)
    assert hit == pytest.approx(math.log1p(math.exp(-4))) and as_clean == pytest.approx(math.log1p(math.exp(4)))
    assert unlabelled == pytest.approx((3 * math.log1p(math.exp(-4)) + math.log1p(math.exp(4))) / 4)
    rng = np.random.default_rng(0)  # word 0 is toxic; a quarter of the unlabelled hold it
    row, col, n = [], [], 400
    positive = np.arange(n) < 100
    for i in range(n):
        if i < 100 or i % 4 == 0:
            row.append(i), col.append(0)
        for w in rng.integers(1, 20, 3):
            row.append(i), col.append(int(w))
    w, b = toxicity_pu.fit(np.array(row), np.array(col), positive, 20, 0.25)
    assert b < 0 and w[0] + b > 1 and w[0] > 3 * np.abs(w[1:]).max()


def test_models_on_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "word " * 60_000), (3, "x"), (None, "y")]
    for module, label in ((quality_gam, "quality"), (toxicity_pu, "toxic")):
        for marks in ([], [(1, 1)], [(1, 1), (2, 0), (None, 1), (3, None)]):
            labels = spark.createDataFrame([(i, m, m, "z") for i, m in marks], "doc_id long, quality int, toxic int, text string")
            model = module.train(docs(spark, rows), labels, F.lit(True), label_col=label)
            out = module.score(docs(spark, rows), model).collect()
            assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
            kept = module.keep(docs(spark, rows), model, threshold=0.0 if module is quality_gam else 1.1)
            assert kept.columns == docs(spark, []).columns and kept.count() == 5
            assert module.score(docs(spark, []), model).count() == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000])
    assert (1, 0) in model.pairs
    assert (((model.score(x[2000:]) >= 0.5) == y[2000:]).mean()) > 0.9


def test_licences(spark):
    mit = license_scan.TEMPLATES["mit"]
    words = mit.split()
    changed = " ".join(w if i % 45 else "altered" for i, w in enumerate(words))
    half = " ".join(words[: len(words) // 2])
    rows = [(1, "some words before it " + mit + " and after"), (2, changed), (3, half), (4, "released UNDER the\nMIT license"), (4, "released UNDER the\nMIT license"), (5, None), (6, ""), (7, "four words are few"), (None, "x Licensed under CC BY-NC 4.0. y")]
    got = {(r["doc_id"], r["template_id"]): r["containment"] for r in license_scan.scan(docs(spark, rows), license_scan.TEMPLATES).collect()}
    assert set(got) == {(1, "mit"), (2, "mit"), (4, "mit-line"), (None, "cc-by-nc-4.0-line")} and got[(1, "mit")] == 1.0 and 0.8 <= got[(2, "mit")] < 1
    assert license_scan.scan(docs(spark, []), license_scan.TEMPLATES).count() == 0


@pytest.mark.parametrize(("literals", "rows"), [(100_000, 500_000), (0, 0)])
def test_licences_equal_plain_search(spark, monkeypatch, literals, rows):
    """Every window of a template's length, by brute force, against the banded search, also past its limits."""
    monkeypatch.setattr(license_scan, "LITERAL_SHINGLES", literals)
    monkeypatch.setattr(license_scan, "BROADCAST_ROWS", rows)
    rng = np.random.default_rng(3)
    texts = []
    for i, (name, text) in enumerate(license_scan.TEMPLATES.items()):
        words = text.split()
        for lost in (0, 1, 2, len(words) // 4):
            kept = [w for k, w in enumerate(words) if k not in set(rng.choice(len(words), min(lost, len(words) - 1), replace=False).tolist())]
            texts.append(" ".join([*(f"w{k}" for k in rng.integers(0, 99, i)), *kept, *(f"w{k}" for k in rng.integers(0, 99, 7))]))
    texts += [None, "", "four words are few", "word " * 30_000 + license_scan.TEMPLATES["mit"], "x" * 200_000]
    table = docs(spark, [*enumerate(texts), (0, texts[0]), (None, texts[4])])
    split = lambda t: [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
    runs = lambda t: [tuple(x) for x in zip(*(split(t)[k:] for k in range(5)))]
    want, near = set(), set()
    for i, t in [*enumerate(texts), (None, texts[4])]:
        own = runs(t)
        for name, template in license_scan.TEMPLATES.items():
            has, n = set(runs(template)), len(runs(template))
            step = max(1, n // 8)
            best = max((len(has & set(own[max(0, s - step) : s + n + step])) / len(has) for s in range(0, len(own), step)), default=0) if set(own) & has else 0
            (want if best >= 0.8 else near).add((i, name))
    got = {(r["doc_id"], r["template_id"]) for r in license_scan.scan(table, license_scan.TEMPLATES).collect()}
    assert got <= want and len(got) >= 0.98 * len(want) and all((i * 4, name) in got for i, name in enumerate(license_scan.TEMPLATES))


ITEM = "A train leaves Boston at 9 and runs 60 km each hour while Alice walks 5 km home, and after 60 minutes Alice meets it near the old bridge."


def test_reparameterised_questions(spark):
    other = ITEM.replace("Boston", "Paris").replace("9", "11").replace("60", "75").replace("Alice", "Maria").replace("walks 5", "walks 8")
    mixed = ITEM.replace("60 km", "75 km")  # one value of the item becomes two
    rows = [(1, "Words ahead. " + ITEM), (2, "Words ahead. " + other + " More."), (3, mixed), (4, ITEM[:60]), (5, None), (6, ""), (7, ITEM.upper()), (9, ITEM.lower()), (1, "Words ahead. " + ITEM), (None, ITEM), (8, "nothing of the sort at all in here")]
    bench = spark.createDataFrame([(10, ITEM, 1), (11, None, 2), (12, "too short", 3)], "item_id long, text string, window int")
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert got == {(1, 10): False, (2, 10): True, (7, 10): False, (9, 10): False, (None, 10): False}
    kept = decontaminate.decontaminated(docs(spark, rows), bench)
    assert kept.columns == docs(spark, []).columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 8]
    assert decontaminate.matches(docs(spark, []), bench).count() == 0
    assert decontaminate.matches(docs(spark, rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [500_000, 0])
def test_slots_beyond_a_longer_one_are_checked(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    monkeypatch.setattr(decontaminate, "BROADCAST_TEXTS", limit)
    item = "a farmer sells 40 sacks of grain at the old market in Boston and then he carries the rest of 40 sacks home to the barn by the river"
    rows = [(1, item), (2, item.replace("Boston", "New York")), (3, item.replace("40", "70")), (4, item.replace("40", "70").replace("Boston", "New York"))]
    rows += [(5, item.replace("40", "50", 1).replace("40", "70")), (6, item.replace("40", "50", 1).replace("40", "70").replace("Boston", "New York")), (7, None), (8, "word " * 30_000 + item), (9, "")]
    bench = spark.createDataFrame([(10, item)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.matches(docs(spark, rows), bench).collect()} == {1, 2, 3, 4, 8}
    assert sorted(r["doc_id"] for r in decontaminate.decontaminated(docs(spark, rows), bench).collect()) == [5, 6, 7, 9]


def test_names_that_open_sentences(spark):
    item = "Tom has 3 apples. Tom buys 4 more at the market. Tom eats 2 of them. How many apples does Tom have left?"
    other = item.replace("Tom", "Anna").replace("3", "7").replace("4", "9").replace("2", "5")
    torn = other.replace("Anna eats", "Maria eats")  # one name of the item becomes two
    rows = [(1, other), (2, "Question: " + other), (3, item), (4, item.title()), (5, other.replace("Anna has", "anna has")), (6, torn), (7, "Anna has a market. How many apples are left?")]
    bench = spark.createDataFrame([(10, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["coverage"], r["reparameterised"]) for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert got.keys() == {1, 2, 3, 4, 5} and [got[i] for i in (1, 2, 3, 4)] == [(1.0, True), (1.0, True), (1.0, False), (1.0, False)]
    assert [r["doc_id"] for r in decontaminate.decontaminated(docs(spark, rows), bench).orderBy("doc_id").collect()] == [6, 7]


def test_near_verbatim_items(spark, tmp_path):
    mixed = ITEM.replace("60 km", "75 km")
    torn = ITEM.replace("60 km", "75 km").replace("while Alice", "while Maria").replace("5 km", "8 km").replace("the old", "an old")
    rows = [(1, mixed), (2, "Ahead. " + mixed + " More."), (3, torn), (4, "nothing of the sort at all in here")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.query(spark, str(tmp_path)).collect()} == {(1, 10), (2, 10)}
    assert sorted(r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs(spark, rows), str(tmp_path)).collect()) == [3, 4]


def test_short_items(spark):
    bench = spark.createDataFrame([(1, "Who wrote Faust?"), (2, "What has four sharp legs"), (3, "Bob met Ann and Tom"), (4, None), (5, "?")], "item_id long, text string")
    rows = [(1, "Question: who wrote Faust?"), (2, "Question: What has four sharp legs?"), (3, "see What has four sharp legs"), (4, "Yes. Bob met Ann and Tom."), (5, "Who wrote it"), (6, "Faust"), (7, None), (8, "")]
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert got == {(1, 1): 1.0, (2, 2): 1.0, (3, 2): 1.0, (4, 3): 1.0}


def test_decontamination_equals_plain_search(spark):
    table, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    items = bench.collect()
    want = {(d["doc_id"], b["item_id"]) for d in table.collect() for b in items if b["text"] in d["text"]}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(table, bench).collect()} == want


def test_pipeline(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    out, sizes = table, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.written(stage(spark, out, SMALL), "stage")
        sizes.append(out.count())
        if i < 4:
            assert out.columns == table.columns
    assert sizes[0] < 1000 and sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()} == {r["doc_id"] for r in out.select("doc_id").collect()}


def test_queries_are_registered_and_match_their_sql(spark):
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in queries.QUERIES} and "pipeline" in __spark_entry__.queries()
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{TINY}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        df = queries.QUERIES[name](spark, TINY)
        columns = sorted(df.columns)
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(names) == columns
        assert Counter(tuple(row[names.index(c)] for c in columns) for row in want.fetchall()) == Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_vocabulary_without_its_file():
    v = Vocabulary([None, "a", " a", None], np.log(np.array([0.25] * 4)), np.zeros(256, int), 3)
    assert Lattice(v).log_marginal([" a"])[0] == pytest.approx(math.log(0.25 + 0.25 * 0.25))  # the piece, or a byte and a piece
