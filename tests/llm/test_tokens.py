import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridtally.llm.token_files import Shard, re_pair, read_documents, read_token_files, write_token_files
from gridtally.llm.tokens import Encoder
from gridtally.llm.vector_packing import Capacity, best_fit, pack_documents
from gridtally.session import scratch_path
from tests.llm.conftest import odd_texts


def plain(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_encode_like_whole_texts(name, keeps):
    whole = plain(name)
    texts = [*odd_texts(), " lead", "trail ", "a\n b", "tab\t tab", "it's we'll I'D", "x  y", "e ́ x", "  wide", "Á B"]
    got = Encoder(public_tokenizers.path(name), keeps).encode(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text)[:-1], repr(text)


@pytest.fixture(scope="module")
def files(spark, documents):
    folder = scratch_path(spark, "test-tokens")
    write_token_files(documents, folder, file_documents=64)
    return folder


def test_files_hold_all_ids_in_order(spark, documents, files):
    whole, at, want = plain("word_bpe_49k.json"), 0, []
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = whole(r.text)
        want.append((r.doc_id, at, len(ids), crc(ids), ids))
        at += len(ids)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in read_token_files(spark, files).collect())
    assert got == want


def test_random_access(spark, documents, files):
    whole = plain("word_bpe_49k.json")
    texts = {r.doc_id: r.text for r in documents.collect()}
    some = [0, 17, 150]
    got = {r.doc_id: r.ids for r in read_documents(spark, files, some).collect()}
    assert got == {i: whole(texts[i]) for i in some}
    part = {r.doc_id: r.ids for r in read_documents(spark, files, some, start=5, n=40).collect()}
    assert part == {i: whole(texts[i])[5:45] for i in some}


def test_grammar_is_smaller_and_lossless():
    rng = np.random.default_rng(2)
    phrases = [rng.integers(0, 1000, rng.integers(2, 9)).astype(np.uint32) for _ in range(50)]
    docs = [np.concatenate([phrases[i] for i in rng.integers(0, 50, n)]) if n else np.zeros(0, np.uint32) for n in (400, 0, 300, 1, 900, 0)]
    docs += [np.full(501, 7, np.uint32)]
    ids = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    symbols, head, rules, lengths = re_pair(ids, starts[:-1][sizes > 0], 1000, least=4)
    assert len(symbols) < len(ids) / 3 and len(rules) == len(lengths)
    shard = Shard(np.arange(1), np.ones(1, bool), np.array([0, len(symbols)]), 1000, rules, lengths, symbols, 2)
    again = Shard.from_bytes(shard.to_bytes())
    assert np.array_equal(again.document(0)[:-1], ids)
    for start, n in ((0, 1), (3, 50), (1500, 7), (len(ids) - 2, 9), (0, 10**6)):
        assert again.document_range(0, start, n).tolist() == [*ids, 2][start : start + n]
    bounds = np.flatnonzero(head[:-1])
    assert len(bounds) == (sizes > 0).sum()


def test_files_of_odd_rows(spark, odd, nothing):
    whole = plain("word_bpe_49k.json")
    folder = scratch_path(spark, "test-odd")
    write_token_files(odd.withColumns({c: F.lit(1) for c in ("file", "place", "shard", "ids")}), folder, file_documents=5)
    got = sorted(read_token_files(spark, folder).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    assert len(got) == len(rows)
    for r, (i, t) in zip(got, rows):
        ids = whole(t)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) == (i, at, len(ids), crc(ids), ids)
        at += len(ids)
    empty = scratch_path(spark, "test-none")
    write_token_files(nothing, empty)
    assert read_token_files(spark, empty).collect() == []


def packed(df, **options):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    rows = pack_documents(df, **options).collect()
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    return rows, by_doc, by_sequence


def test_packing_of_all_documents(documents):
    whole = plain("byte_bpe_50k.json")
    rows, by_doc, by_sequence = packed(documents)
    total = 0
    for r in documents.collect():
        ids, at = whole(r.text), 0
        total += len(ids)
        pieces = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        for p in pieces:
            assert p.start == at and crc(ids[at : at + p.length]) == p.ids_crc32
            assert p.length == 1024 or p.piece == 0
            at += p.length
        assert at == len(ids)
        assert len(pieces) == -(-len(ids) // 1024)
    assert len(by_sequence) <= 1.03 * total / 1024 + 1


def test_packing_of_odd_rows(odd, nothing):
    whole = plain("byte_bpe_50k.json")
    rows, by_doc, _ = packed(odd.withColumns({"piece": F.lit("x"), "ids": F.lit(2), "OFFSET": F.lit(0)}))
    want = defaultdict(int)
    for r in odd.collect():
        want[r.doc_id] += len(whole(r.text))
    assert {i: sum(p.length for p in ps) for i, ps in by_doc.items()} == want
    assert pack_documents(nothing).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 100, 3000)
    capacity = Capacity(tokens=100, documents=4, attention=6000, weights=(1.0, 0.3, 0.3), rule=rule)
    lengths = lengths[lengths**2 <= 6000]
    sequence, before, made = best_fit(lengths, capacity)
    for s in range(made):
        mine = sequence == s
        assert 0 < mine.sum() <= 4 and (lengths[mine] ** 2).sum() <= 6000 and lengths[mine].sum() <= 100
        order = np.argsort(before[mine])
        assert np.array_equal(before[mine][order], np.concatenate(([0], np.cumsum(lengths[mine][order])[:-1])))
    with pytest.raises(ValueError):
        best_fit([90], capacity)
    assert best_fit([], capacity)[2] == 0
