"""Each pipeline stage against a plain version of it on that stage's own input; models' tables and scores likewise; long texts."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from loamworks.llm import decontaminate, license_scan, piece_sampling, quality_gam, sharding, simhash_ball, token_packing, toxicity_pu
from loamworks.llm.lattice import load_vocabulary
from loamworks.llm.shared import crc_mod, written

SMALL = "/root/testdata/sf0.01"
WHITE = re.compile(r"[ \t\n\x0b\x0c\r]+")
ODD = "doc_id long, text string, lang string, doc string, fp string, row string, least string, root string, ids string, words string, score double"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each one."""
    tables = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], SMALL), f"test-{name}"))
    return tables


def texts(table):
    return {r["doc_id"]: r["text"] for r in table.select("doc_id", "text").collect()}


def plain_features(text):
    raw = text.encode()
    words = [w for w in re.split(rb"[ \t\n\x0b\x0c\r]+", raw) if w]
    n, size, lengths = max(1, len(words)), max(1, len(raw)), [len(w) for w in words] or [0]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    share = lambda these, of: sum(c in these for c in raw) / of
    letters = max(1, sum(65 <= c <= 90 or 97 <= c <= 122 for c in raw))
    mean = sum(lengths) / len(lengths)
    return {
        "log_words": math.log(1 + len(words)),
        "log_chars": math.log(1 + len(raw)),
        "word_length": mean,
        "word_length_spread": math.sqrt(sum((x - mean) ** 2 for x in lengths) / len(lengths)),
        "longest_word": math.log(1 + max(lengths)),
        "short_words": sum(x <= 2 for x in lengths) / n,
        "distinct_words": len(set(words)) / n,
        "repeated_triples": 1 - len(set(triples)) / len(triples) if triples else 0.0,
        "top_word": max(Counter(words).values(), default=0) / n,
        "log_lines": math.log(1 + len(lines)),
        "line_length": math.log(1 + len(raw) / max(1, len(lines))),
        "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "upper": share(range(65, 91), letters),
        "digits": share(b"0123456789", size),
        "marks": share(b"!\"'(),-.:;?", size),
        "symbols": share(b"#$%&*+/<=>@[\\]^_`{|}~", size),
        "commas": share(b",", n),
        "stops": share(b".", n),
        "bars": share(b"|", n),
        "exclamations": share(b"!", n),
        "high_bytes": share(range(128, 256), size),
        "control": share([c for c in range(32) if c not in (9, 10, 13)] + [127], size),
        "shouted_words": sum(w.upper() == w != w.lower() and len(w) > 1 for w in words) / n,
        "marked_words": sum(w[-1] in b"#$%&*+/<=>@[\\]^_`{|}~!" for w in words) / n,
    }


def test_quality_stage(spark, stages):
    """Features by plain counting, cells by comparing with every edge."""
    model = quality_gam.trained_on(spark, SMALL)
    place = lambda edges, v: sum(e <= v for e in edges)
    kept = set()
    for doc, text in texts(stages[0]).items():
        found = plain_features(text or "")
        x = [found[f] for f in quality_gam.FEATURES]
        assert x == pytest.approx(quality_gam.features(text))
        x = quality_gam.features(text)
        z = model.intercept + sum(t[place(e, v)] for e, t, v in zip(model.edges, model.tables, x))
        z += sum(t[place(model.pair_edges[i], x[i]), place(model.pair_edges[j], x[j])] for (i, j), t in zip(model.pairs, model.pair_tables))
        if 1 / (1 + math.exp(-z)) >= 0.3:
            kept.add(doc)
    assert set(texts(stages[1])) == kept and 0 < len(kept) < stages[0].count()


def test_cuts_are_the_best_of_all():
    rng = np.random.default_rng(3)
    gain = lambda g, h: g.sum() ** 2 / (h.sum() + quality_gam.RIDGE)
    for _ in range(20):
        g, h = rng.normal(size=9), rng.random(9)
        all_cuts = [gain(g[:c], h[:c]) + gain(g[c:], h[c:]) - gain(g, h) for c in range(1, 9)]
        best, cut = quality_gam._best_cut(g, h)
        assert best == pytest.approx(max(all_cuts)) and cut == 1 + int(np.argmax(all_cuts))
        step = quality_gam.shallow_tree(g, h, leaves=2)
        left = slice(0, cut if best > 0 else 9)  # the ridge can make every cut a loss
        assert step[left] == pytest.approx(g[left].sum() / (h[left].sum() + quality_gam.RIDGE))
        g, h = rng.normal(size=(5, 4)), rng.random((5, 4))
        crosses = {(r, c): sum(gain(x[:, :c], y[:, :c]) + gain(x[:, c:], y[:, c:]) for x, y in ((g[:r], h[:r]), (g[r:], h[r:]))) for r in range(1, 5) for c in range(1, 4)}
        best, r, c = quality_gam._best_cross(g, h)
        assert (r, c) == max(crosses, key=crosses.get) and best == pytest.approx(crosses[r, c])


def test_toxicity_stage(spark, stages):
    model = toxicity_pu.trained_on(spark, SMALL)
    assert model.weight
    kept = set()
    for doc, text in texts(stages[1]).items():
        held = set(re.findall(r"\w+", (text or "").lower()))
        z = model.bias + math.fsum(w for word, w in model.weight.items() if word in held)
        if 1 / (1 + math.exp(-z)) < 0.7:
            kept.add(doc)
    assert set(texts(stages[2])) == kept and len(kept) < stages[1].count()


def test_toxicity_words_are_screened_by_plain_counts(spark):
    """The samples hold all of a small table: words, their ratios and the fit are made again from its rows."""
    table, marks = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    usable = crc_mod("doc_id", 3) != 1
    known = {r["doc_id"]: r["toxic"] for r in marks.where(usable & F.col("toxic").isNotNull()).collect()}
    held = {d: set(re.findall(r"\w+", (t or "").lower())) for d, t in texts(table.where(usable)).items()}
    toxic, plain = [d for d in held if known.get(d) == 1], list(held)
    p, u = (Counter(w for d in rows for w in held[d]) for rows in (toxic, plain))
    part = lambda k, n, rate: (k * math.log(k / (n * rate)) if k else 0) + ((n - k) * math.log((n - k) / (n * (1 - rate))) if k < n else 0)
    ratio = {w: 2 * sum(part(c[w], n, (p[w] + u[w]) / (len(toxic) + len(plain))) for c, n in ((p, len(toxic)), (u, len(plain)))) for w in p if p[w] >= 3}
    chosen = sorted(w for w in ratio if ratio[w] >= math.log(len(ratio)))
    rows = [(d, True) for d in toxic] + [(d, False) for d in plain]
    row, col = zip(*[(i, j) for i, (d, _) in enumerate(rows) for j, w in enumerate(chosen) if w in held[d]])
    prior = sum(v == 1 for v in known.values()) / len(known)
    w, b = toxicity_pu.fit(np.array(row), np.array(col), np.array([t for _, t in rows]), len(chosen), prior)
    model = toxicity_pu.trained_on(spark, SMALL)
    assert model.bias == pytest.approx(b, abs=1e-3)
    assert [model.weight.get(c, 0.0) for c in chosen] == pytest.approx(w, abs=1e-3) and set(model.weight) <= set(chosen)


def plain_fingerprint(text):
    words = [w for w in WHITE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(x >> bit & 1 for x in h) > len(h))


def test_near_duplicate_stage(stages):
    prints = {d: plain_fingerprint(t) for d, t in texts(stages[2]).items()}
    of = {}
    for d in sorted(prints):
        of.setdefault(prints[d], d)
    root = {fp: fp for fp in of}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    all_prints = np.array(list(of), np.uint64)
    for fp in of:
        for other in all_prints[np.bitwise_count(all_prints ^ np.uint64(fp)) <= 4].tolist():
            a, b = sorted((find(fp), find(other)), key=of.get)
            root[b] = a
    assert set(texts(stages[3])) == {of[find(fp)] for fp in of} and stages[3].count() < stages[2].count()


def test_decontamination_stage(spark, stages):
    items = [WHITE.sub(" ", r["text"]).strip() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {d for d, t in texts(stages[3]).items() if not any(i in WHITE.sub(" ", t or "") for i in items)}
    assert set(texts(stages[4])) == clean and len(clean) < stages[3].count()


def test_encoding_stage(spark, stages):
    """Pieces put together by hand give back the text, after the space that opens each segmentation."""
    v = load_vocabulary(piece_sampling.VOCABULARY)
    piece = {i: p.encode() for i, p in enumerate(v.pieces) if p} | {int(i): bytes([b]) for b, i in enumerate(v.byte_ids)}
    want = texts(stages[4])
    got = {r["doc_id"]: (r["ids"], r["n_ids"]) for r in stages[5].select("doc_id", "ids", "n_ids").collect()}
    assert got.keys() == want.keys()
    for d, (ids, n) in got.items():
        assert len(ids) == n and b"".join(piece[i] for i in ids).decode() == (" " + want[d] if want[d] else "")


def odd(spark, rows):
    return spark.createDataFrame([(i, t, None, "a", "b", "c", "d", "e", "f", "g", 0.5) for i, t in rows], ODD)


def test_stages_on_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y z"), (None, None), (5, "word " * 60_000), (6, "w" * 300_000)]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd(spark, rows), SMALL)
        got = out.collect()
        if name != "encoding":
            assert out.columns == odd(spark, []).columns
        if name in ("toxicity", "decontamination", "encoding"):
            assert len(got) == 8
        if name == "near_duplicates":  # no words: one group; x twice: another
            assert sorted(r["doc_id"] or 0 for r in got) == [0, 1, 3, 5, 6]
        none = stage(spark, odd(spark, []), SMALL)
        assert none.columns == out.columns and none.count() == 0


def test_long_texts(spark):
    """Texts of a million characters, of words and unbroken; what is sought lies at their ends."""
    filler = " ".join(f"w{i * 7919 % 99991}" for i in range(150_000))
    line = license_scan.TEMPLATES["mit"]
    question = "How many sacks of flour does the old miller need for the forty loaves that the town ordered"
    bench = spark.createDataFrame([(1, question)], "item_id long, text string")
    table = odd(spark, [(1, f"{filler} {line}"), (2, f"{filler} {question}"), (3, "x" * 1_000_000), (4, filler)]).repartition(4)
    assert {(r["doc_id"], r["template_id"]) for r in license_scan.scan(table, license_scan.TEMPLATES).collect()} == {(1, "mit")}
    assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in decontaminate.matches(table, bench).collect()] == [(2, 1, 1.0)]
    want = {r["doc_id"]: len(r["text"]) + 16 for r in table.collect()}
    assert {r["doc_id"]: r["size"] for r in sharding.shard_by_bytes(table, 3).collect()} == want
    prints = {r["doc_id"]: r["fingerprint"] for r in simhash_ball.near_duplicates(table).collect()}
    assert prints == {d: f"{plain_fingerprint(t):016x}" for d, t in texts(table).items()}
    ranks = {bytes([b]): b for b in range(256)}
    packed = token_packing.pack_tokens(table, ranks, r"\S+|\s+", length=4096).collect()
    got = Counter()
    for r in packed:
        assert r["n_tokens"] <= 4096 and r["cu_seqlens"][-1] == r["n_tokens"]
        for d, a, b in zip(r["doc_ids"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            got[d] += b - a
    assert got == Counter({d: n - 16 for d, n in want.items()})


def test_ids_to_pack_are_integers(spark):
    with pytest.raises(TypeError):
        token_packing.pack_tokens(spark.createDataFrame([("a", "b")], "doc_id string, text string"), {b"b": 0}, ".")
