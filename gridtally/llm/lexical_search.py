"""Ranked lexical search, term at a time with a limited set of accumulators.

Documents become short lists of the query terms they hold, written once; nothing of them is shuffled.
Every task ranks its own documents for each item: terms come rarest first, each adds to the score of the
documents that hold it. Once the terms still to come cannot lift a document without a score to the k-th
best partial score, no new scores are begun, and the later, frequent terms only update those that exist,
exactly. The tasks' best documents are merged in Spark.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import materialize, release

# Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; A-Z in lower case.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
MOST = 20
# Query terms that are broadcast at a time, some 10 MB; more are searched block by block.
BLOCK_TERMS = 100_000
# A task ranks so many documents, or documents with so many query terms, at a time.
SHARD_DOCS = 1 << 17
SHARD_POSTINGS = 1 << 22
# Bytes of a text whose words are listed at a time.
CHUNK = 1 << 23

_KEPT = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))
TABLE = _KEPT.translate(bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)))


def terms_of(raw: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text's bytes in order, in lists of bounded size."""
    plain = (raw or b"").translate(TABLE)
    at = 0
    while at < len(plain):
        to = plain.find(b" ", at + CHUNK)
        to = len(plain) if to < 0 else to
        yield plain[at:to].split()
        at = to


def _query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, term, times) of the items' whole texts; equal rows count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                for words in terms_of(raw):
                    found = Counter(words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(found), pa.int64()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                        names=["item_id", "term", "times"],
                    )

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("binary").alias("text")).distinct()
    return (
        rows.mapInArrow(count, "item_id long, term binary, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))
    )


_POSTING = "doc_id long, row_key long, n long, terms array<int>, times array<long>"


def _postings(docs: DataFrame, shared) -> DataFrame:
    """For every document with a term: `n`, all its terms with repeats, and how often it holds which query term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, terms, times = [], [], []
            for raw in batch.column("text").to_pylist():
                n, found = 0, Counter()
                for words in terms_of(raw):
                    n += len(words)
                    found.update(map(number, words))
                found.pop(None, None)
                sizes.append(n)
                terms.append(list(found))
                times.append(list(found.values()))
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "n", "terms", "times"],
            )
            yield out.filter(pa.array(np.array(sizes) > 0))

    return docs.mapInArrow(count, _POSTING)


def _totals(postings: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms with repeats, and documents that hold each query term."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            total[:width] += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
            total[width] += batch.num_rows
            total[width + 1] += batch.column("n").to_numpy().sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "total"])

    summed = postings.select("n", "terms").mapInArrow(add, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    out = np.zeros(width + 2, np.int64)
    out[summed["cell"].to_numpy()] = summed["total"].to_numpy()
    return int(out[width]), int(out[width + 1]), out[:width]


def term_weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


class Shard:
    """Posting lists over some documents, and the search in them."""

    def __init__(self, sizes: np.ndarray, lengths: np.ndarray, terms: np.ndarray, times: np.ndarray, n_docs: int, n_terms: int) -> None:
        if len(sizes) and 25 * int(sizes.max()) * n_docs >= 1 << 63:
            norm = np.array([75 + 25 * int(s) * n_docs // n_terms for s in sizes], np.int64)
        else:
            norm = 75 + 25 * sizes * n_docs // max(n_terms, 1)
        order = np.argsort(terms, kind="stable")
        owner = np.repeat(np.arange(len(sizes)), lengths)
        self.docs = owner[order]
        gain = (1_000_000_000 * times) // (1000 * times + 12 * norm[owner])
        self.gain = gain[order]
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.most = np.maximum.reduceat(self.gain, starts) if len(order) else self.gain
        self.score = np.zeros(len(sizes), np.int64)
        self.begun = np.zeros(len(sizes), bool)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and exact scores, all above 0, among them the k best and their ties; terms come rarest first."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        here = (self.terms[at] == terms) & (weights > 0) if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[here], weights[here]
        bounds = weights * self.most[at]
        left = bounds[::-1].cumsum()[::-1]
        score, begun = self.score, self.begun
        score[:], begun[:] = 0, False
        alive = None
        for j, (i, weight) in enumerate(zip(at.tolist(), weights.tolist())):
            docs, gain = self.docs[self.starts[i] : self.starts[i + 1]], self.gain[self.starts[i] : self.starts[i + 1]]
            if alive is None and left[j] < left[0] - left[j]:
                now = np.flatnonzero(begun)
                if len(now) >= k and left[j] < np.partition(score[now], len(now) - k)[len(now) - k]:
                    alive = now
            if alive is None:
                score[docs] += weight * gain
                begun[docs] = True
            elif 8 * len(alive) < len(docs):
                place = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
                hit = docs[place] == alive
                score[alive[hit]] += weight * gain[place[hit]]
            else:
                old = begun[docs]
                score[docs[old]] += weight * gain[old]
        found = np.flatnonzero(score)
        if len(found) > k:
            found = found[score[found] >= np.partition(score[found], len(found) - k)[len(found) - k]]
        return found, score[found]


def _ranked(postings: DataFrame, shared, k: int) -> DataFrame:
    """Each task's best documents for each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, items = shared.value
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            lists = table["terms"].combine_chunks()
            shard = Shard(
                table["n"].to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
                lists.flatten().to_numpy(), table["times"].combine_chunks().flatten().to_numpy(), n_docs, n_terms,
            )
            missing = table["doc_id"].is_null().to_numpy()
            ids, keys = table["doc_id"].fill_null(0).to_numpy(), table["row_key"].to_numpy()
            for item, terms, weights in items:
                docs, score = shard.search(terms, weights, k)
                best = docs[order := np.lexsort((keys[docs], ids[docs], ~missing[docs], -score))[:k]]
                if len(best):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * len(best), pa.int64()), pa.array(ids[best], mask=missing[best]),
                            pa.array(keys[best]), pa.array(score[order]),
                        ],
                        names=["item_id", "doc_id", "row_key", "score"],
                    )

        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= SHARD_POSTINGS or sum(b.num_rows for b in held) >= SHARD_DOCS:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return postings.mapInArrow(search, "item_id long, doc_id long, row_key long, score long")


def _search_block(rows: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    """The tasks' best documents for the items of one block of query terms (item_id, term, times)."""
    sc = rows.sparkSession.sparkContext
    vocabulary = {t: i for i, t in enumerate(sorted(set(asked["term"].to_pylist())))}
    postings = materialize(_postings(rows, words := sc.broadcast(vocabulary)), "postings")
    words.unpersist()
    n_docs, n_terms, holding = _totals(postings, len(vocabulary))
    by_item: dict[int | None, list[tuple[int, int, int]]] = {}
    for item, term, times in zip(*(asked[c].to_pylist() for c in ("item_id", "term", "times"))):
        i = vocabulary[term]
        if holding[i]:
            by_item.setdefault(item, []).append((int(holding[i]), i, times * term_weight(n_docs, int(holding[i]))))
    items = []
    for item, found in by_item.items():
        _, terms, weights = np.array(sorted(found), np.int64).T
        items.append((item, terms.copy(), weights.copy()))
    out = materialize(_ranked(postings, sc.broadcast((n_docs, n_terms, items)), k), "ranked")
    release(postings)
    return out


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = MOST,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Each item's k highest-scoring documents with a score above 0: `item_id`, `rank` from 1, `doc_id`, `score`.

    N documents have a term, L is the number of all their terms, n that of one document, df how many hold a
    term, tf how often one does. With w = floor(1000 ln((2N + 2) / (2df + 1))) and m = 75 + 25 n N div L, a
    document scores the sum of w (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included.

    Texts are read whole; null and empty ones have no terms and neither rank nor count. Rows that share a
    doc_id are documents of their own, equal scores go by doc_id, null first, then by a hash of the text.
    Equal rows of an item count once; different texts of one item_id are one item with all their terms.
    Items without a term that a document holds give no rows, nor does an empty table. Other columns are
    ignored. At most `block_terms` query terms, or one item's, are broadcast at a time; each further block
    reads the documents again.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("row_key"), F.col(text).cast("binary").alias("text"))
    asked = materialize(_query_terms(items, item_id, item_text), "query-terms")
    blocks = max(1, math.ceil(asked.count() / block_terms))
    found = []
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        found.append(_search_block(rows, part, k))
    release(asked)
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "row_key")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
