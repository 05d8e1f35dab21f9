import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridtally.llm.mixture_packing import Plan, pack_mixture, phases
from gridtally.llm.tokens import Encoder


def round_robin(tokens, weights, window):
    """Deficit round-robin, window after window, with exact deficits: tokens served by each queue in each window."""
    left, deficit, out = list(tokens), defaultdict(Fraction), []

    def fill(queues, n):
        if len(queues) == 1:
            return {queues[0]: n}
        first, second = queues[: len(queues) // 2], queues[len(queues) // 2 :]
        deficit[first[0], len(queues)] += Fraction(n * sum(weights[j] for j in first), sum(weights[j] for j in queues))
        have = deficit[first[0], len(queues)]
        take = have.numerator // have.denominator
        deficit[first[0], len(queues)] -= take
        return fill(first, take) | fill(second, n - take)

    for _ in range(sum(tokens) // window):
        row = fill(list(range(len(tokens))), window)
        left = [n - row[j] for j, n in enumerate(left)]
        out.append([row[j] for j in range(len(tokens))])
    return out, left


@pytest.mark.parametrize("tokens", [[1000, 1, 333, 7], [50], [17, 17, 17], [3, 100_003, 9]])
def test_windows_are_those_of_the_round_robin(tokens):
    plan = Plan(tokens, None, 16, 2)
    got = defaultdict(Counter)
    for j, n in enumerate(tokens):
        for _, size, window, _, _ in plan.place(j, 0, n):
            got[window][j] += size
    want, left = round_robin(tokens, tokens, 32)
    assert [[got[w][j] for j in range(len(tokens))] for w in range(len(want))] == want
    assert [got[len(want)][j] for j in range(len(tokens))] == left


@pytest.mark.parametrize("weights", [[1, 1, 1, 1], [5, 0, 3, 1], [0, 0, 1, 0], [1000, 1, 1, 1]])
def test_weights_until_used_up(weights):
    tokens = [900, 40, 333, 2]
    plan = Plan(tokens, weights, 8, 4)
    seen = np.zeros(sum(tokens), int)
    windows = defaultdict(Counter)
    for j, n in enumerate(tokens):
        at = 0
        # documents of 11 tokens, placed one by one
        while at < n:
            for start, size, window, sequence, offset in plan.place(j, at, min(11, n - at)):
                place = sequence * 8 + offset if sequence < plan.full else plan.full * 8 + plan.tail[sequence - plan.full][0] + offset
                seen[place : place + size] += 1
                windows[window][j] += size
            at += 11
    assert (seen == 1).all()
    # before the first queue is used up, every window has its shares
    first = min((n / w * sum(weights) for n, w in zip(tokens, weights) if w))
    for w in range(int(first) // 32 - 1):
        for j in range(4):
            assert abs(windows[w][j] - 32 * weights[j] / sum(weights)) < 5
    assert sum(p.length for p in phases(tokens, weights)) == sum(tokens)


def check(rows, found, length=2048, window=8, natural=True):
    """Every id once, sequences without gaps or padding, windows in proportion."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text, source in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[i, source, tuple(ids)] += 1
    by_doc, by_sequence, by_window = defaultdict(list), defaultdict(list), defaultdict(Counter)
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        by_doc[r.doc_id, r.source, r.doc_tokens].append((r.start, r.length, r.ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_window[r.window][r.source] += r.length
    got = Counter()
    for (i, source, n), parts in by_doc.items():
        parts.sort(key=lambda p: (p[0], p[2]))
        copies = sum(p[0] == 0 for p in parts)
        assert sum(p[1] for p in parts) == copies * n
        if copies == 1:
            ids = b"".join(p[2] for p in parts)
            got[i, source, tuple(np.frombuffer(ids, "<u4").tolist())] += 1
        else:
            for key in [k for k in want if k[0] == i and k[1] == source and len(k[2]) == n]:
                got[key] = want[key]
    assert got == want
    total = sum(len(k[2]) * c for k, c in want.items())
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length if s < total // length else at & (at - 1) == 0 and at < length
    if natural:
        shares = Counter()
        for (_, source, ids), c in want.items():
            shares[source] += Fraction(len(ids) * c, total)
        for w, counts in by_window.items():
            filled = sum(counts.values())
            assert filled == min(length * window, total - w * length * window)
            assert all(abs(counts[s] - filled * shares[s]) < 1 + 2 * len(shares).bit_length() for s in shares)


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    found = pack_mixture(documents, with_ids=True)
    check(rows, found.collect())
    # dealt out otherwise, queues are in another order, but proportions and sequences hold
    check(rows, pack_mixture(documents.repartition(9), with_ids=True, window=1).collect(), window=1)


def test_odd_rows(spark, odd):
    found = pack_mixture(odd.withColumns({"window": F.lit("x"), "ids": F.lit(1), "part": F.lit(2)}), length=64, window=2, with_ids=True)
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    check(rows, found.collect(), 64, 2)
    weighted = pack_mixture(odd, {"a": 3, None: 1}, length=64, window=2, with_ids=True)
    check(rows, weighted.collect(), 64, 2, natural=False)
    plain = pack_mixture(odd)
    assert plain.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "window"]


def test_hot_source(spark):
    rows = [(i, f"text number {i} " * (1 + i % 9), "hot" if i % 10 else f"s{i % 3}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    check(rows, pack_mixture(df, length=128, with_ids=True).collect(), 128)


def test_no_rows(nothing):
    assert pack_mixture(nothing).count() == 0


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_any_mix_of_characters_encodes_like_the_whole(name, keeps):
    draw = np.random.default_rng(1)
    letters = list("aB zé'0 1.\n\t,ÑÿĀ̄’  _-s t rellvd 日×²")
    texts = ["".join(draw.choice(letters, draw.integers(1, 40))) for _ in range(3000)]
    texts += ["don't 'sup 'S !'s ''s 's't", "a <|endoftext|> b", "\x85 \x1c a\x1cb", "0", " 0", "0 00 10", "😀 a😀b", "ﬁ ŉ ǅ İ ı Å ẞ", "É́ ÷ª º"]
    tokenizer, encoder = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name), keeps)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
