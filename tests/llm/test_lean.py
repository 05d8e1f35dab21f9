"""What keeps memory, shuffled bytes and CPU low, without a change of results."""

import numpy as np
import pyarrow as pa
import pytest

from gridtally import session
from gridtally.llm import jaccard_join, tokens
from gridtally.llm.frequency import BITMAP_BITS
from gridtally.llm.hashing import pieces, prefix_sums, text_bytes
from gridtally.llm.jaccard_join import jaccard_components, signatures, sketch
from gridtally.llm.language_id import LanguageModel, identify
from gridtally.llm.merkle import edited_fingerprints
from gridtally.llm.suffix_dedup import NEAR, OWNER, SIDE, SPAN, SUFFIX, anchors, beside, needed, pack, pack_owners, pack_spans
from gridtally.llm.suffix_dedup import pack_suffixes, reach, remove_repeats, unpack_owners, unpack_spans, unpack_suffixes
from gridtally.llm.token_files import PART_BYTES, TOKENIZER
from gridtally.llm.tokens import Encoder, tokenizer_path
from gridtally.llm.vector_packing import pack_documents

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize(
    "operator",
    [lambda d: identify(d, LanguageModel([], [{}] * 5)), jaccard_components, remove_repeats, pack_documents],
    ids=["identify", "jaccard_components", "remove_repeats", "pack_documents"],
)
@pytest.mark.parametrize("asked, used", [("10000", "1000"), ("0", "1000"), ("300", "300")])
def test_texts_go_to_python_in_small_batches(spark, nothing, operator, asked, used):
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, asked)
    try:
        operator(nothing)
        assert spark.conf.get(ROWS) == used
    finally:
        spark.conf.set(ROWS, before)


def test_leaves_are_taken_from_a_fingerprint_once(odd):
    plan = edited_fingerprints(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct(") == 3


@pytest.mark.parametrize("common, sent", [(34, False), (50, True), (80, True)])
def test_only_anchors_that_may_match_are_sent(common, sent):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", np.uint8)

    def some(n):
        return letters[rng.integers(0, len(letters), n)].tobytes().decode()

    for _ in range(20):
        same = some(common)
        data, offsets = text_bytes(pa.array([some(90) + same + some(90), some(70) + same + some(110)]))
        sums = prefix_sums(data)
        at, hashes, least = anchors(data, offsets, sums)
        values, times = np.unique(np.concatenate([h for _, h in beside(sums, at, *reach(at, hashes, least))]), return_counts=True)
        near = np.zeros(2**BITMAP_BITS, bool)
        near[values[times > 1] >> np.uint64(64 - BITMAP_BITS)] = True
        use, before, after = needed(sums, at, hashes, least, np.packbits(near, bitorder="little"))
        assert use.any() == sent
        assert (before.astype(int) + after >= SIDE).all()
        assert ((before >= NEAR) | (after >= NEAR)).all()


def test_packed_records_come_back_and_lose_their_repeats():
    rng = np.random.default_rng(3)
    owners = np.zeros(3000, OWNER)
    owners["id"], owners["key"] = 10**12 + np.cumsum(rng.integers(1, 4, 3000)), rng.integers(-(2**63), 2**63, 3000)
    assert (unpack_owners(pack_owners(owners)) == owners).all() and not len(unpack_owners(pack_owners(owners[:0])))
    # a key costs its 8 bytes; 9.5 at least if ids go as they are
    assert len(pack_owners(owners)) < 8.5 * len(owners)
    spans = np.zeros(5000, SPAN)
    spans["key"] = np.sort(rng.choice(owners["key"], 5000))
    spans["start"] = rng.integers(0, 3000, 5000)
    spans["end"] = spans["start"] + rng.integers(50, 400, 5000)
    assert (unpack_spans(pack_spans(spans)) == spans).all() and not len(unpack_spans(pack_spans(spans[:0])))
    assert len(pack_spans(spans)) < 0.85 * len(pack(spans))
    rows = np.zeros(4000, SUFFIX)
    rows["anchor"] = rng.integers(0, 2**48, 4000, np.uint64) << np.uint64(16)
    rows["owner"] = np.sort(rng.integers(0, 500, 4000))
    rows["at"], rows["before"], rows["after"] = rng.integers(0, 4000, 4000), SIDE, rng.integers(0, SIDE + 1, 4000)
    rows["left"] = rng.integers(97, 123, (4000, SIDE))
    rows["right"] = np.where(np.arange(SIDE) < rows["after"][:, None], rng.integers(97, 123, (4000, SIDE)), 0)
    assert (unpack_suffixes(pack_suffixes(rows)) == rows).all() and not len(unpack_suffixes(pack_suffixes(rows[:0])))


def test_sketches_of_linked_sets_pass(spark):
    rng = np.random.default_rng(9)
    rows = []
    for n in (1, 3, 10, 60, 500, 3000):
        for _ in range(20):
            one = rng.integers(0, 2**64, n, np.uint64)
            other = np.concatenate((one[: max(1, round(n * rng.uniform(0.7, 1)))], rng.integers(0, 2**64, rng.integers(0, n // 4 + 1), np.uint64)))
            common, union = len(np.intersect1d(one, other)), len(np.union1d(one, other))
            rows.append((sketch(one).tolist(), sketch(other).tolist(), len(one), len(other), 100 * common >= 80 * union))
        far = rng.integers(0, 2**64, n, np.uint64)
        rows.append((sketch(one).tolist(), sketch(far).tolist(), n, n, n > 1000))
    frame = spark.createDataFrame(rows, "x array<long>, y array<long>, n long, m long, linked boolean")
    found = frame.select("linked", jaccard_join._near("x", "y", "n", "m", 80).alias("near")).collect()
    assert any(r.linked for r in found)
    assert all(r.near for r in found if r.linked)
    # sets that have nothing in common
    assert [r.near for r in found[20::21]] == [False] * 5 + [found[-1].near]


def test_many_alike_texts_make_few_pairs(spark, monkeypatch):
    """Texts that share passages but do not link: candidates no longer grow with the square of their number."""
    rng = np.random.default_rng(2)
    common = [f"c{i}" for i in range(60)]
    texts = [" ".join(common[i % 20 : i % 20 + 40] + [f"u{x}" for x in rng.integers(0, 10**9, 60)]) for i in range(300)]
    texts += [t + " one more word" for t in texts[:5]]
    tried = []

    def kept(df, label):
        copy = session.materialize(df, label)
        if label == "tried":
            tried.append(copy.count())
        return copy

    monkeypatch.setattr(jaccard_join, "materialize", kept)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert found == {i: i if i < 300 else i - 300 for i in range(305)}
    assert sum(tried) < 50


def test_shuffles_of_steps_go_and_the_setting_comes_back(spark):
    before = spark.conf.get(session.SHUFFLES_GO, None)
    with session.passing_shuffles(spark):
        assert spark.conf.get(session.SHUFFLES_GO) == "true"
    assert spark.conf.get(session.SHUFFLES_GO, None) == before


def test_a_tokenizer_remembers_few_strings():
    words = Encoder(tokenizer_path(TOKENIZER), False)
    texts = [" ".join(f"w{chr(97 + i)}{chr(97 + j)}{chr(97 + k)}{a}{b}" for a in "abcdefghij" for b in "klmnopqrst") for i in range(26) for j in range(26) for k in range(7)]
    assert len(texts) * 100 > 450_000
    for at in range(0, len(texts), 500):
        words.encode(texts[at : at + 500])
        assert len(words.place) <= 400_000
    # what was forgotten is encoded anew
    assert words.encode(texts[:2]) == [words._whole([t])[0].tobytes() for t in texts[:2]]


def test_token_files_look_a_word_up_once_in_many_texts():
    words, asked = Encoder(tokenizer_path(TOKENIZER), False), []
    places = words._places
    words._places = lambda strings: asked.extend(strings) or places(strings)
    batch = pa.RecordBatch.from_pydict({"text": ["some words and more of the same " * 40] * 1000})
    found = [ids for part in pieces(batch, "text", PART_BYTES) for ids in words.encode(part.column("text"))]
    assert asked.count("words") == 1
    assert found == words.encode(batch.column("text").to_pylist())


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: identify(d, LanguageModel([], [{}] * 5)),
        lambda d: signatures(d.withColumnRenamed("doc_id", "node"), "text", (np.zeros(1), np.zeros(1)), 80, 5),
    ],
    ids=["identify", "signatures"],
)
def test_tasks_without_a_tokenizer_free_the_worker_of_it(odd, monkeypatch, operator):
    tasks = []
    monkeypatch.setattr(type(odd), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
    operator(odd)
    tokens.encoder(tokenizer_path(TOKENIZER), False)
    assert tokens._encoders
    list(tasks[-1](iter([])))
    assert not tokens._encoders


def test_arrow_gives_freed_memory_back_after_a_batch(monkeypatch):
    given = []
    monkeypatch.setattr(pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: given.append(1)})())
    assert len(list(pieces(pa.RecordBatch.from_pydict({"text": ["abc", None, "de"]}), "text", 3))) == 2
    assert given == [1]
