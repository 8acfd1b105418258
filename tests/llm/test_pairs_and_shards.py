"""SimHash, rotated codes, components, sharding and packing against brute force, and on odd tables."""

import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loamworks.llm import components, rotated_codes, shared, sharding, simhash_ball, token_packing

DOCS = "doc_id long, text string, fp string, row string, size long, shard int"
TINY = "/root/testdata/sf0.001"


def docs(spark, rows):
    """A table whose other columns clash with names that the operators use."""
    return spark.createDataFrame([(i, t, "x", "y", 7, 9) for i, t in rows], DOCS)


def groups_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(4000, 4100)] + [(7, 7)]
    got = {r["vertex"]: r["component"] for r in components.components(spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect()}
    want = groups_of(6000, edges)
    assert got == {i: c for i, c in enumerate(want) if i != c}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_cluster_needs_a_shared_folder():
    class Named:
        conf = type("C", (), {"get": staticmethod(lambda k, d: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.checkpoint_dir(Named)


@pytest.mark.parametrize("prefix", [4, 17, 22])
def test_longer_keys_lose_no_link(spark, prefix):
    rng = np.random.default_rng(4)
    fps = [int(b) for b in rng.integers(0, 2**62, 60, dtype=np.uint64)]
    fps += [f ^ sum(1 << int(k) for k in rng.choice(62, rng.integers(1, 6), replace=False)) for f in fps]
    edges = simhash_ball.fingerprint_edges(spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, least long"), 4, prefix).collect()
    at = {f: i for i, f in enumerate(fps)}
    assert groups_of(len(fps), [(at[r["a"]], at[r["b"]]) for r in edges]) == groups_of(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints():
    for t in ("", " \t", "One", "a b c", "A b C d", "a b c d e\x0bf\x1cg", "é É ß 汉字 x y z", "w " * 70_000):
        assert simhash_ball.fingerprint(t.encode()) == plain_fingerprint(t)


@pytest.mark.parametrize("block", [1_000_000, 500])
def test_ball_links_equal_all_pairs(block, monkeypatch):
    monkeypatch.setattr(simhash_ball, "BLOCK_VARIANTS", block)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = [int(b) for b in base] + [int(base[i % 40]) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 8), replace=False)) for i in range(200)]
    fps = sorted(set(fps))
    import pandas as pd

    masks = simhash_ball._masks(6, 2)
    keyed = sorted((int(f >> 58) ^ int(m), f) for f in fps for m in masks)
    frame = pd.DataFrame({"key": [k for k, _ in keyed], "fp": np.array([f for _, f in keyed], np.uint64).view(np.int64)})
    links = pd.concat(simhash_ball._ball_links(2, 4, 6)([frame.iloc[:77], frame.iloc[77:]]))
    at = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
    got = groups_of(len(fps), [(at[a], at[b]) for a, b in zip(links["a"], links["b"])])
    want = groups_of(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert got == want


@pytest.mark.parametrize("most", [2_000, 100_000])
def test_one_large_group_of_near_copies_is_held_in_bounded_blocks(most, monkeypatch):
    """Fingerprints that agree in most bits are not split by their next few bits."""
    import pandas as pd

    rng = np.random.default_rng(2)
    fps = sorted({0x9E3779B97F4A7C15 ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(400)})
    fps = [f for f in fps if ((f >> 60) ^ 0x9).bit_count() <= 2]
    held, sort = [], np.argsort
    monkeypatch.setattr(simhash_ball, "BLOCK_VARIANTS", most)
    monkeypatch.setattr(simhash_ball.np, "argsort", lambda v, **kw: held.append(len(v)) or sort(v, **kw))
    links = pd.concat(simhash_ball._ball_links(2, 4, 4)([pd.DataFrame({"key": 0x9, "fp": np.array(fps, np.uint64).view(np.int64)})]))
    monkeypatch.undo()
    assert max(held) <= most
    low = simhash_ball._masks(60, 2).tolist()  # variants under the key, as plainly as can be
    flips = [((f >> 60) ^ 0x9).bit_count() for f in fps]
    meet = {}
    for i, f in enumerate(fps):
        for m in low:
            if m.bit_count() + flips[i] <= 2:
                meet.setdefault((f & (1 << 60) - 1) ^ m, []).append(i)
    assert sum(held) == sum(map(len, meet.values()))
    at = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
    assert groups_of(len(fps), [(at[a], at[b]) for a, b in zip(links["a"], links["b"])]) == groups_of(len(fps), [(x[0], y) for x in meet.values() for y in x])


def test_near_duplicates(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(5, long), (3, long), (3, long), (9, long + " w"), (None, long), (8, None), (2, ""), (4, "alone in here"), (None, "nobody")]
    out = simhash_ball.near_duplicates(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in out}
    prints = {(i, f"{plain_fingerprint(t):016x}") for i, t in rows}
    assert set(by) == prints
    assert by[(5, f"{plain_fingerprint(long):016x}")] == 3 and by[(8, "0" * 16)] == 2 and by[(None, f"{plain_fingerprint('nobody'):016x}")] is None
    assert simhash_ball.near_duplicates(docs(spark, [])).count() == 0


def test_keep_one(spark):
    long = " ".join(f"w{i}" for i in range(200))
    table = docs(spark, [(5, long), (3, long), (3, long), (None, long), (8, None), (2, ""), (4, "alone"), (None, "nobody")])
    kept = simhash_ball.keep_one(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect()) == [-1, 2, 3, 4]


def test_keep_one_with_any_column_names(spark):
    table = docs(spark, [(5, "a text here"), (3, "a text here"), (4, "alone")]).selectExpr("*", "1 as `a b`", "2 as `n-chars`", "named_struct('x y', 3) as `A:b,c<d>`", "4 as `q``q`", "5 as `u.v`")
    kept = simhash_ball.keep_one(table)
    assert kept.schema.names == table.schema.names
    assert sorted(tuple(r) for r in kept.collect()) == [(i, t, "x", "y", 7, 9, 1, 2, (3,), 4, 5) for i, t in ((3, "a text here"), (4, "alone"))]


def test_sharding(spark):
    rows = [(i, "x" * (i * 37 % 500)) for i in range(300)] + [(7, "same")] * 50 + [(None, None), (None, "é")]
    out = sharding.shard_by_bytes(docs(spark, rows), 5).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in out) == sorted((-1 if i is None else i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    total = sum(r["size"] for r in out)
    for s in range(5):
        own = [r for r in out if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 5) <= 516
    assert sharding.shard_by_bytes(docs(spark, []), 5).count() == 0


def brute_links(rows):
    ok = {}
    for k, (_, vec, label) in enumerate(rows):
        if vec and label is not None and all(v is not None and np.isfinite(v) for v in vec) and any(vec):
            ok[k] = np.array(vec, float) / np.linalg.norm(np.array(vec, float))
    return [(i, j) for i in ok for j in ok if i < j and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.93]


@pytest.mark.parametrize("tile", [2048, 16])
def test_rotated_codes(spark, tile, monkeypatch):
    monkeypatch.setattr(rotated_codes, "TILE", tile)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 24))
    near = base[rng.integers(0, 4, 80)] + 0.15 * rng.standard_normal((80, 24))
    vecs = [v.tolist() for v in np.concatenate([base, near]).astype(np.float32)]
    rows = [(i, v, i % 2) for i, v in enumerate(vecs)] + [(500 + i, vecs[0], 0) for i in range(5)]
    rows += [(600, None, 0), (601, [0.0] * 24, 0), (602, [float("nan")] * 24, 0), (603, vecs[0], None), (604, [None] * 24, 0), (605, [], 0), (606, [1.0, 2.0], 0), (607, [2.0, 4.0], 0)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, size int, codes int")
    out = {r["vec_id"]: r for r in rotated_codes.near_duplicates(df).collect()}
    links = brute_links(rows)
    root = groups_of(len(rows), links)
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert len(out) == len(rows)
    found = sum(out[r[0]]["n_links"] for r in rows)
    assert found >= 0.98 * degree.sum() and all(out[r[0]]["n_links"] <= d for r, d in zip(rows, degree))
    assert all(out[r[0]]["component_id"] == rows[root[k]][0] for k, r in enumerate(rows) if degree[k] in (0, degree.max()))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())
    assert rotated_codes.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounds_hold(monkeypatch):
    rng = np.random.default_rng(0)
    for dim in (8, 64, 300):
        for wanted in (0.0, 0.5, 0.93, 0.99):
            o, q = rng.standard_normal((2, dim))
            o /= np.linalg.norm(o)
            q -= (q @ o) * o
            q = wanted * o + np.sqrt(1 - wanted**2) * q / np.linalg.norm(q)
            got, missed = [], 0
            for seed in range(60):
                turned = [rotated_codes.projection(dim, 1000 * seed + at) for at in (0, 500)]
                unit = np.stack([o, q])
                (one, f, a), (two, g, c) = (rotated_codes.coded(unit, t) for t in turned)
                u, v = rotated_codes.restored(one, turned[0]) / f[:, None], rotated_codes.restored(two, turned[1]) / g[:, None]
                got.append((u[0] @ v[1] + v[0] @ u[1]) / 2)
                hit = rotated_codes.open_pairs(u.astype(np.float32), v.astype(np.float32), np.maximum(a, c), dim, 0.93, slice(0, 1), 0)
                missed += wanted >= 0.93 and not hit[0, 1]
            assert abs(np.mean(got) - wanted) < 5 * np.std(got) / np.sqrt(60) + 1e-3 and not missed


RANKS = {bytes([b]): b for b in range(256)} | {b"th": 256, b"the": 257}


def test_packing_is_lossless(spark, tmp_path):
    rows = [(i, "the cat " * (i % 9)) for i in range(60)] + [(7, "again")] * 3 + [(None, None), (99, "x" * 1000)]
    packed = token_packing.pack_tokens(docs(spark, rows), RANKS, r"\w+|\W", length=64, window_tokens=500)
    out = packed.collect()
    names = {v: k for k, v in RANKS.items()}
    whole = {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["n_tokens"] == r["cu_seqlens"][-1] <= 64
        for k, row in enumerate(r["row_ids"]):
            whole.setdefault((row, r["doc_ids"][k]), []).append((r["seg_offsets"][k], ids[r["cu_seqlens"][k] : r["cu_seqlens"][k + 1]]))
    texts = sorted((-1 if d is None else d, b"".join(names[int(i)] for _, part in sorted(parts, key=lambda p: p[0]) for i in part).decode()) for (_, d), parts in whole.items())
    assert texts == sorted((-1 if i is None else i, t or "") for i, t in rows)
    token_packing.write_packed(packed, str(tmp_path / "packed"), length=64)
    m = spark.read.parquet(str(tmp_path / "packed")).first()
    position = np.frombuffer(m["position_ids"], "<u4")
    assert len(np.frombuffer(m["ids"], "<u2")) == 64 and all(position[a] == 0 for a in m["cu_seqlens"][:-1] if a < 64)
    assert token_packing.pack_tokens(docs(spark, []), RANKS, r"\w+|\W").count() == 0


def test_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(50):
        length = int(rng.integers(1, 40))
        sizes = rng.integers(0, length + 1, rng.integers(0, 60))
        spare = []
        for i in np.argsort(-sizes, kind="stable"):
            fit = [c for c in spare if c >= sizes[i]]
            if fit:
                spare.remove(min(fit))
            spare.append((min(fit) if fit else length) - sizes[i])
        bins = token_packing.best_fit_decreasing(sizes, length)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert sorted(length - sizes[b].sum() for b in bins) == sorted(spare)
