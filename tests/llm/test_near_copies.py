from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm.components import components
from gridtally.llm.hashing import shingle_sets
from gridtally.llm.jaccard_join import index_keys, jaccard_components
from gridtally.llm.suffix_dedup import remove_repeats
from tests.llm import brute


def jaccard_rows(df, **options):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, **options).collect())


def test_components_of_all_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute.jaccard_components(rows)
    assert any(v[1] != k for k, v in want.items())
    assert jaccard_rows(documents) == sorted((k, *v) for k, v in want.items())


def near_copies(n=120, words=90, seed=5):
    """A large group of near copies, some linked only through others, beside unrelated texts with one passage."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        mine = list(base)
        for at in rng.choice(words, rng.integers(0, 4), replace=False):
            mine[at] = f"x{rng.integers(1_000_000)}"
        rows.append((i, " ".join(mine)))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(1000 + i, passage + " " + " ".join(f"u{i}.{j}" for j in range(30))) for i in range(60)]
    rows += [(2000 + i, " ".join(f"s{j}" for j in range(9)) + f" t{i % 7}") for i in range(40)]
    return rows


@pytest.mark.parametrize("frequent", [2, 16])
def test_groups_of_near_copies_lose_no_link(spark, frequent):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert jaccard_rows(df, frequent=frequent) == sorted((k, *v) for k, v in brute.jaccard_components(rows).items())


def test_links_inside_components_are_counted(spark, monkeypatch):
    import gridtally.llm.jaccard_join as module

    monkeypatch.setattr(module, "BLOCK_TEXTS", 16)
    rows = near_copies()
    rows += [(3000 + i, t) for i, t in rows[:5]] + [(4000, None), (4001, " ")]
    sets = {i: frozenset(brute.shingles(t)) for i, t in rows}
    distinct = {s for s in sets.values() if s}
    want = {s: sum(100 * len(s & o) >= 80 * len(s | o) for o in distinct if o != s) for s in distinct}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.n_links for r in jaccard_components(df).collect()}
    assert max(got.values()) > 2 and got == {i: want.get(s, 0) for i, s in sets.items()}


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(11)
    for n in (3, 7, 20, 21, 26, 30, 33, 100, 415, 420, 600, 900):
        for often in (0.0, 0.5, 0.95, 1.0):
            x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            drop = int(0.1 * len(x))
            y = np.unique(np.concatenate((rng.permutation(x)[drop:], rng.integers(0, 2**64, drop, dtype=np.uint64))))
            if 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
                continue
            marked = set(x[rng.random(len(x)) < often].tolist())
            keys = [index_keys(s, np.array([v in marked for v in s.tolist()]), np.ones(len(s), bool)) for s in (x, y)]
            assert len(np.intersect1d(*keys)), (n, often)


def test_shingles_of_odd_texts():
    import pyarrow as pa

    from tests.llm.conftest import odd_texts

    texts = odd_texts()
    assert [len(s) for s in shingle_sets(pa.array(texts, pa.string()), 5)] == [len(brute.shingles(t)) for t in texts]


def test_jaccard_of_odd_rows(odd, nothing):
    clash = odd.withColumns({c: F.lit(1) for c in ("node", "keys", "component_id", "n_shingles", "key", "a")})
    got = jaccard_components(clash).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert len(got) == len(rows)
    pooled = defaultdict(list)
    for r in got:
        pooled[r.doc_id].append(r)
    unique = [(i, t) for i, t in rows if i is not None and sum(1 for j, u in set(rows) if j == i) == 1]
    want = brute.jaccard_components(unique)
    for i, (n, component) in want.items():
        assert {(r.n_shingles, r.component_id) for r in pooled[i]} == {(n, component)}, i
    assert [r.component_id for r in pooled[None]] == [None]
    assert jaccard_components(nothing).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3), (900, 901), (901, 900)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 560)} | {900: 900, 901: 900}
    assert got == want


def repeats(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_repeated_bytes_of_all_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = sorted((True, k[0], *v) for k, v in brute.remove_repeats(rows).items())
    assert sum(w[3] for w in want) > 0
    assert repeats(remove_repeats(documents)) == want


def test_repeats_by_small_batches_and_hot_anchors(documents, monkeypatch):
    import gridtally.llm.suffix_dedup as module

    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = sorted((True, k[0], *v) for k, v in brute.remove_repeats(rows).items())
    found = {}
    for name, value in (("BATCH", 8), ("HOT_ANCHOR", 2), ("FLUSH", 500), ("PAIRS", 16)):
        before = getattr(module, name)
        monkeypatch.setattr(module, name, value)
        found[name] = repeats(remove_repeats(documents))
        monkeypatch.setattr(module, name, before)
        assert found[name] == want, name


def test_levels_are_a_logarithmic_family():
    from gridtally.llm.suffix_dedup import SUFFIX, Levels

    levels, rng = Levels(), np.random.default_rng(3)
    for i in range(13):
        batch = np.zeros(20, SUFFIX)
        batch["anchor"], batch["rank"] = rng.integers(0, 2**63, 20), i
        levels.add(batch)
    assert [size for size, _, _ in levels.levels] == [8, 4, 1]
    assert [len(rows) for _, rows, _ in levels.levels] == [160, 80, 20]


def test_repeats_of_odd_rows(odd, nothing):
    clash = odd.withColumns({c: F.lit(1) for c in ("part", "key", "row", "spans", "kept", "N_Removed")})
    got = remove_repeats(clash)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute.remove_repeats([r for r in rows if r[0] is not None])
    found = got.collect()
    assert len(found) == len(rows)
    by_bytes = defaultdict(list)
    for r in found:
        by_bytes[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    for i in {i for i, _ in rows if i is not None}:
        assert sorted(by_bytes[i]) == sorted(want[j, t] for j, t in rows if j == i), i
    assert [x[1] for x in by_bytes[None]] == [0]
    assert remove_repeats(nothing).collect() == []
