import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm.lexical_search import Shard, lexical_search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """{item: [(score, doc_id)]} by scoring every document for every item."""
    counts = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    holding = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(words(text))
    out = {}
    for item, terms in asked.items():
        scores = []
        for i, c in counts:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in terms.items()
                if t in c
            )
            if score > 0:
                scores.append((-score, i is not None, i))
        if scores:
            out[item] = [(-s, i) for s, _, i in sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.item_id is not None, r.item_id or 0, r.rank)):
        out.setdefault(r.item_id, []).append((r.score, r.doc_id))
        assert r.rank == len(out[r.item_id])
    return out


ITEMS = [
    (1, "quick brown fox"), (1, "quick brown fox"), (1, "seven WISE owls owls"), (2, "naïve façade über"), (3, None), (4, ""),
    (5, "zzz unknown"), (6, "word7 and thing3 the the"), (None, "line one"), (7, "日本語のテキスト a b c 123"),
]


def test_whole_tables_equal_brute_force(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()], 20)
    assert got(lexical_search(documents, items)) == want
    assert got(lexical_search(documents.repartition(7, "source"), items, block_terms=300)) == want


@pytest.mark.parametrize("k", [1, 3, 100])
def test_odd_rows(spark, odd, k):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = lexical_search(odd.withColumn("rank", F.lit(1)).withColumn("score", F.lit("x")), items.withColumn("doc_id", F.lit(3)), k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(found) == brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS, k)


def test_no_rows(spark, odd, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search(nothing, items).count() == 0
    assert lexical_search(odd, items.limit(0)).count() == 0


def test_accumulators_are_limited_and_survivors_exact():
    draw = np.random.default_rng(5)
    lists = [np.unique(draw.zipf(1.3, 40) % 300) for _ in range(4000)]
    lengths = np.array([len(x) for x in lists])
    terms = np.concatenate(lists)
    times = draw.integers(1, 9, len(terms))
    shard = Shard(draw.integers(40, 900, 4000), lengths, terms, times, 4000, 4000 * 300)
    holding = np.bincount(terms, minlength=300)
    limited = 0
    for _ in range(60):
        asked = draw.choice(np.flatnonzero(holding), 12, replace=False)
        asked = asked[np.lexsort((asked, holding[asked]))]
        weights = np.array([math.floor(1000 * math.log(8002 / (2 * h + 1))) for h in holding[asked]]) * draw.integers(1, 3, 12)
        docs, score = shard.search(asked, weights, 5)
        full = np.zeros(4000, np.int64)
        for t, w in zip(asked, weights):
            i = np.searchsorted(shard.terms, t)
            part = slice(shard.starts[i], shard.starts[i + 1])
            full[shard.docs[part]] += w * shard.gain[part]
        limited += int(shard.begun.sum() < (full > 0).sum())
        least = np.sort(full)[-5]
        assert set(docs) == set(np.flatnonzero(full >= max(least, 1))) and (score == full[docs]).all()
    assert limited > 20


def test_hot_term_and_long_text(spark):
    """Two thirds of the rows hold one text; one text is listed in several parts."""
    docs = [(i, "common words here") for i in range(400)] + [(i, f"common rare{i}") for i in range(400, 600)]
    items = [(0, "common rare450"), (1, "here here words")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(lexical_search(df, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items, 20)
    raw = ("ab cd-éé " * 1_500_000).encode()
    parts = list(terms_of(raw))
    assert len(parts) == 2 and sum(map(len, parts)) == 4_500_000 and {w for p in parts for w in p} == {b"ab", b"cd", "éé".encode()}


def test_products_beyond_64_bits(spark):
    from gridtally.llm.inner_topk import inner_top_k, whole_vectors

    def found(rows):
        vectors = whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        return inner_top_k(vectors, vectors.filter("vec_id = 0"), 2)

    big = [(0, [3e6, 1.0]), (1, [2e6, 0.0]), (2, [-3e12, 5.0]), (3, [1e6, 7.0])]
    assert [(r.vec_id, r.score) for r in found(big).orderBy("rank").collect()] == [(1, 3 * 2 * 10**12 * 1024**2), (3, 3 * 10**12 * 1024**2 + 7 * 1024**2)]
    for rows in ([(0, [3e12, 1.0]), (1, [3e12, 1.0])], [(0, [1e300]), (1, [1.0])]):
        with pytest.raises(Exception, match="beyond"):
            found(rows).collect()
