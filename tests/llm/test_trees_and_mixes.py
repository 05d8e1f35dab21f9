import hashlib
import math
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm.curriculum import SCHEDULES, assign_positions, delivered, source_targets, time_due, training_order, word_count, write_training_order
from gridtally.llm.inner_topk import inner_top_k, whole_vectors
from gridtally.llm.merkle import edited_fingerprints, edits, fingerprint, leaves, likeness
from gridtally.llm.preference_format import format_preferences


def edited_texts(rows):
    rows = sorted(rows)
    out = {}
    for at, (i, text) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        out[i] = (len(text), text[: len(text) - quarter] + after[:quarter], rows[(at + 1) % len(rows)][0])
    return out


def check_prints(df, rows):
    want = edited_texts(rows)
    got = {r.doc_id: r for r in edited_fingerprints(df).collect()}
    assert set(got) == set(want)
    texts = dict(rows)
    by_text = defaultdict(set)
    for i, r in got.items():
        n, edited, after = want[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest()), i
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[texts[i] or ""].add(r.fingerprint)
        by_text[edited].add(r.edited_fingerprint)
        if (texts[i] or "") == (texts[after] or ""):
            assert r.near_next == 1.0
    assert all(len(prints) == 1 for prints in by_text.values())
    assert len({p for ps in by_text.values() for p in ps}) == len(by_text)
    return got


def test_fingerprints_of_all_documents(documents):
    got = check_prints(documents, [(r.doc_id, r.text) for r in documents.collect()])
    assert np.mean([r.near_edited for r in got.values()]) > 0.4 > 0.1 > np.mean([r.near_next for r in got.values()])


def test_fingerprints_of_odd_rows(odd, nothing):
    seen = odd.filter("doc_id is not null").dropDuplicates(["doc_id"]).withColumns({"key": F.lit(1), "id": F.lit(2), "head": F.lit("")})
    check_prints(seen, [(r.doc_id, r.text) for r in seen.collect()])
    whole = edited_fingerprints(odd).collect()
    assert Counter(r.doc_id for r in whole) == Counter(r.doc_id for r in odd.collect())
    assert edited_fingerprints(nothing).collect() == []
    one = odd.filter("doc_id = 12").limit(1)
    assert edited_fingerprints(one).first().near_next == 1.0


def test_edits_are_located(spark):
    lines = [f"line {i}, with some words {i}. And more of them; number {i * 7}\n" for i in range(60)]
    other = list(lines)
    other[33] = "line 33, with other words. And more of them; number 231\n"
    df = spark.createDataFrame([("".join(lines), "".join(other))], "a string, b string")
    a, b = fingerprint(F.col("a")), fingerprint(F.col("b"))
    r = df.select(edits(a, b).alias("e"), edits(a, a).alias("same"), likeness(a, b).alias("near")).first()
    assert r.same == [] and len(r.e) == 1 and len(r.e[0].leaves) == 1 and r.near > 0.95


def test_every_long_text_has_bounded_leaves(spark, documents):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(600)]
    texts = {
        "words": " ".join(words), "code": "".join(words), "cjk": "".join(chr(0x4E00 + i) for i in rng.integers(0, 5000, 3000)),
        "marks": "。".join(words), "symbols": "".join(rng.choice(list("#=+*<>~^"), 3000)), "table": "\t".join(words), "period": "word " * 800,
    }
    for name, text in texts.items():
        n = len(text)
        df = spark.createDataFrame([(text, text[: n - n // 4] + "other ends " + words[0] * 9, text[: n // 2] + "!" + text[n // 2 :])], "a string, b string, c string")
        a, b, c = df.select(*[fingerprint(F.col(x)) for x in "abc"]).first()
        prints = spark.createDataFrame([(a, b, c)], "a string, b string, c string")
        r = prints.select(leaves(F.col("a")).alias("all"), likeness(F.col("a"), F.col("b")).alias("cut"), likeness(F.col("a"), F.col("c")).alias("put")).first()
        assert len(r.all) >= n / 256 and r.cut > 0.3, (name, len(r.all), r.cut)
        if name != "period":
            e = prints.select(edits(F.col("a"), F.col("c")).alias("e")).first().e
            assert r.put > 0.9 and 0 < sum(len(x.leaves) for x in e) <= 5, (name, r.put, e)
    long = {r.doc_id for r in documents.collect() if len(r.text or "") >= 100}
    assert min(r.near_edited for r in edited_fingerprints(documents).collect() if r.doc_id in long) > 0.05


def test_targets_fill_up_by_weight(spark):
    def level(sizes):
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        targets, open_, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
        while open_ and rest > 1e-9:
            whole = sum(weights[i] for i in open_)
            give = {i: rest * weights[i] / whole for i in open_}
            rest = 0.0
            for i in list(open_):
                targets[i] += give[i]
                if targets[i] >= 3 * sizes[i]:
                    rest += targets[i] - 3 * sizes[i]
                    targets[i] = 3.0 * sizes[i]
                    open_.discard(i)
        return targets

    rng = np.random.default_rng(8)
    for sizes in ([100, 100, 100], [1, 1000, 50, 0, 7, 3000, 2], [0, 0], [5], rng.integers(0, 500, 23).tolist()):
        names = [f"s{i:02d}" for i in range(len(sizes) - 1)] + [None]
        df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long").repartition(3)
        got = {r.source: r.target for r in source_targets(df).collect()}
        assert [got[n] for n in names] == pytest.approx(level(sizes)), sizes
        assert sum(got.values()) == pytest.approx(sum(sizes))


def test_schedule_inverts_its_integral(spark):
    df = spark.range(1, 100).select((F.col("id") / 100).alias("u"))
    for schedule in (*SCHEDULES, ((0.0, 0.0), (0.4, 0.0), (0.6, 3.0), (1.0, 0.0))):
        for u, t in [tuple(r) for r in df.select("u", time_due(F.col("u"), schedule)).collect()]:
            knots = np.linspace(0, t, 20001)
            rate = np.interp(knots, *zip(*schedule))
            whole = np.trapezoid(np.interp(np.linspace(0, 1, 20001), *zip(*schedule)), np.linspace(0, 1, 20001))
            assert np.trapezoid(rate, knots) / whole == pytest.approx(u, abs=1e-3)


def test_mix_comes_near_its_targets(documents):
    rows = assign_positions(documents).collect()
    by_source = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"] and all(0 <= p <= 1 for p in r.positions)
        by_source[r.source].append(r)
    for of in by_source.values():
        largest = max(r["size"] for r in of)
        assert abs(sum(r.taken for r in of) - of[0].target) <= largest
    assert sorted(rows) == sorted(assign_positions(documents.repartition(7)).collect())


def test_training_order_is_sorted_by_position(documents):
    assigned = assign_positions(documents)
    times = {r.doc_id: sorted(r.positions) for r in assigned.collect()}
    order = [r.doc_id for r in training_order(documents, assigned).collect()]
    assert Counter(order) == Counter({i: len(p) for i, p in times.items() if p})
    seen, at = Counter(), []
    for i in order:
        at.append(times[i][seen[i]])
        seen[i] += 1
    assert at == sorted(at)


def test_mix_query_writes_the_training_order(spark, documents, tmp_path, monkeypatch):
    from gridtally.llm import queries

    folders = []
    path = queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda s, label: folders.append(path(s, label)) or folders[-1])
    docs = documents.limit(60)
    docs = docs.union(docs.limit(7)).union(documents.limit(1).select(F.lit(None).cast("long"), *documents.columns[1:]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op9_curriculum_mix(spark, str(tmp_path)).collect()
    (folder,) = folders
    assigned = assign_positions(docs).collect()
    order = spark.read.parquet(folder).collect()
    want = Counter((r.doc_id, round(p, 9)) for r in assigned for p in r.positions)
    assert Counter((r.row.doc_id, round(r.position, 9)) for r in order) == want
    assert {r.row.text for r in order} <= {r.text for r in docs.collect()}
    files = sorted((p.name for p in Path(folder.removeprefix("file:")).glob("part-*")))
    at = [r.position for f in files for r in spark.read.parquet(f"{folder}/{f}").collect()]
    assert at == sorted(at) and len(at) == len(order)
    columns = ("doc_id", "size", "source_size", "target", "taken")
    assert Counter(tuple(r[c] for c in columns) for r in rows) == Counter(tuple(r[c] for c in columns) for r in assigned)


def test_delivered_counts_the_copies_of_the_order(spark, odd, nothing, tmp_path):
    assigned = assign_positions(odd)
    write_training_order(odd, assigned, f"{tmp_path}/all")
    order = spark.read.parquet(f"{tmp_path}/all")
    assert sorted(r.taken for r in delivered(assigned, order).collect()) == sorted(r.taken for r in assigned.collect())
    assert {r.taken for r in delivered(assigned, order.limit(0)).collect()} == {0}
    write_training_order(nothing, assign_positions(nothing), f"{tmp_path}/none")
    assert delivered(assign_positions(nothing), spark.read.parquet(f"{tmp_path}/none")).collect() == []


def test_mix_of_odd_rows(odd, nothing):
    clash = odd.withColumns({c: F.lit(1) for c in ("size", "row_key", "target", "positions", "row", "_id", "rank")})
    rows = assign_positions(clash).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    sizes = {(r.doc_id, r.text): len((r.text or "").encode().split()) for r in odd.collect()}
    assert sorted(r["size"] for r in rows) == sorted(sizes[r.doc_id, r.text] for r in odd.collect())
    copies = training_order(clash, assign_positions(clash))
    assert copies.columns == clash.columns
    assert copies.count() == sum(len(r.positions) for r in rows)
    assert assign_positions(nothing).collect() == []


def brute_top(rows, k=10):
    vectors = [(i, [math.floor(1024 * float(np.float32(v))) for v in x]) for i, x in rows]
    out = []
    for q, x in vectors:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def top(df, **options):
    vectors = whole_vectors(df)
    return sorted(tuple(r) for r in inner_top_k(vectors, vectors.filter("vec_id % 100 = 0"), **options).collect())


def test_top_k_by_small_blocks(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = brute_top([(r.vec_id, r.embedding) for r in df.collect()])
    assert top(df) == want
    assert top(df, block=16, query_block=2) == want


def test_top_k_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(250)]
    rows += [(300 + i, rows[3][1]) for i in range(20)] + [(400, [0.0] * 6), (500, [1e3] * 6), (501, [])]
    bad = [(None, [1.0] * 6), (600, None), (700, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (800, [float("nan")] * 6), (900, [float("inf")] * 6)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("x", F.lit(1))
    got = top(df, block=32)
    padded = [(i, x + [0.0] * (6 - len(x))) for i, x in rows]
    assert got == brute_top(padded)
    few = df.filter("vec_id in (100, 200, 3)")
    assert len(top(few)) == 4
    assert top(df.filter("vec_id = 100")) == [] and top(df.limit(0)) == []


def test_top_k_sends_no_vectors_to_the_driver(spark):
    """A few queries, in a small file, meet every block: what they grow to must not be broadcast."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(600)]
    vectors = whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = inner_top_k(vectors, vectors.filter("vec_id % 100 = 0"), block=16, query_block=2)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = [lines[m] for m in range(n + 1, len(lines)) if min(depth[n + 1 : m + 1]) > depth[n]]
            assert below and not any("MapInArrow" in x or "FileScan" in x for x in below), below
    assert sorted(tuple(r) for r in found.collect()) == brute_top([(i, [float(np.float32(v)) for v in x]) for i, x in rows])


def test_preferences(spark):
    def turns(pair, side, *texts):
        return [(pair, side, i, r, t) for i, (r, t) in enumerate(texts)]

    rows = turns(1, True, ("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "good"))
    rows += turns(1, False, ("user", "hi"), ("assistant", "yes"), ("user", "less"), ("assistant", "bad"))
    rows += turns(2, True, ("user", "a"), ("assistant", "b")) + turns(2, False, ("user", "a"), ("assistant", "b"))
    rows += turns(3, True, ("user", "alone")) + turns(4, True, ("user", None)) + turns(4, False, (None, ""), ("assistant", "z"))
    rows += [(None, True, 0, "user", "x"), (5, None, 0, "user", "x"), (6, True, None, "assistant", "late"), (6, False, 0, "user", "early")]
    rows += turns(7, True, *[("assistant", str(i)) for i in range(100)]) + turns(7, False, *[("assistant", str(i if i < 70 else -i)) for i in range(100)])
    df = spark.createDataFrame(rows, "pair_id long, chosen boolean, turn long, role string, text string").withColumn("part", F.lit(1))
    got = {(r.pair_id, r.chunk): r for r in format_preferences(df).collect()}
    one = got[1, 0]
    assert one.prompt == "<|user|>\nhi\n<|assistant|>\nyes\n" and one.prompt_turns == 2
    assert one.chosen_text == "<|user|>\nmore\n<|assistant|>\ngood\n" and one.rejected_text == "<|user|>\nless\n<|assistant|>\nbad\n"
    assert [one.chosen_text[a:b] for a, b in one.chosen_mask] == ["<|assistant|>\ngood\n"]
    assert [one.rejected_text[a:b] for a, b in one.rejected_mask] == ["<|assistant|>\nbad\n"]
    assert (got[2, 0].prompt_turns, got[2, 0].chosen_text, got[2, 0].rejected_text) == (2, "", "")
    assert (got[3, 0].prompt, got[3, 0].chosen_text) == ("", "<|user|>\nalone\n")
    assert (got[4, 0].prompt, got[4, 0].chosen_text, got[4, 0].rejected_text) == ("", "<|user|>\n\n", "<||>\n\n<|assistant|>\nz\n")
    assert [(got[7, c].prompt_turns, len(got[7, c].chosen_mask), len(got[7, c].rejected_mask)) for c in (0, 1)] == [(64, 0, 0), (6, 30, 30)]
    assert {k[0] for k in got} == {1, 2, 3, 4, 6, 7}
    assert format_preferences(df.limit(0)).collect() == []


def test_preferences_of_all_conversations(spark, sf_dir):
    from gridtally.llm.queries import op6_preference_format

    sides = defaultdict(lambda: {0: [], 1: []})
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        sides[r.conv_id // 2][r.conv_id % 2].append((r.role, r.text))
    for r in op6_preference_format(spark, sf_dir).collect():
        yes, no = sides[r.pair_id][0], sides[r.pair_id][1]
        n = 0
        while n < min(len(yes), len(no)) and yes[n] == no[n]:
            n += 1
        text = lambda turns: "".join(f"<|{a}|>\n{b}\n" for a, b in turns)
        assert (r.prompt_turns, r.prompt, r.chosen_text, r.rejected_text) == (n, text(yes[:n]), text(yes[n:]), text(no[n:]))


def test_words_are_counted_like_bytes_split(spark):
    texts = [None, "", " a\tb\x0b\x0cc d \n", "x y", "\x1c \x85"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(word_count(F.col("text"))).collect()] == [len((t or "").encode().split()) for t in texts]
