"""Token-id files under Re-Pair grammar compression, with random access to documents and ranges.

Documents are sorted by id and tokenised in the tasks that write them. A shard holds consecutive
documents of about a million ids as one record: symbols, rules, and where documents begin. Re-Pair runs
per shard: the pairs of neighbouring symbols that occur often are replaced by new symbols, again and
again; each rule keeps the number of ids it stands for, so a reader skips to any document or range and
expands only the symbols that it needs. Pairs never cross documents. Spark's writer commits the records,
so lost tasks leave no half shards, and readers need nothing but the shared folder.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.llm.hashing import pieces
from gridtally.llm.tokens import encoder, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SHARD_IDS = 1 << 20
# Documents of a file; a task holds one shard at a time.
FILE_DOCUMENTS = 8192
# Bytes of text that are parted at a time: in larger parts more words are looked up once.
PART_BYTES = 1 << 21
# A pair is replaced while it occurs so often in a shard, for at most so many rounds.
LEAST_COUNT = 24
MOST_ROUNDS = 12
MAGIC = b"RPR1"
_CELLS = 1 << 20


@dataclass
class Shard:
    """Compressed ids of consecutive documents; `starts` are their first symbols, and the end."""

    doc_ids: np.ndarray
    has_id: np.ndarray
    starts: np.ndarray
    first_rule: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    end_id: int

    def to_bytes(self) -> bytes:
        """Magic, then sizes, then the arrays, lowest byte first; symbols take 2 bytes where all fit."""
        wide = len(self.symbols) and int(self.symbols.max()) >= 1 << 16 or self.first_rule + len(self.rules) > 1 << 16
        head = struct.pack(
            "<4sIIIIQ?", MAGIC, self.end_id, len(self.doc_ids), self.first_rule, len(self.rules), len(self.symbols), wide
        )
        return head + b"".join(
            [
                self.doc_ids.astype("<i8").tobytes(),
                self.has_id.astype("u1").tobytes(),
                self.starts.astype("<u8").tobytes(),
                self.rules.astype("<u4").tobytes(),
                self.lengths.astype("<u4").tobytes(),
                self.symbols.astype("<u4" if wide else "<u2").tobytes(),
            ]
        )

    @staticmethod
    def from_bytes(data: bytes) -> Shard:
        form = struct.Struct("<4sIIIIQ?")
        magic, end_id, docs, first_rule, rules, symbols, wide = form.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = form.size
        arrays = []
        for kind, n in (("<i8", docs), ("u1", docs), ("<u8", docs + 1), ("<u4", 2 * rules), ("<u4", rules), ("<u4" if wide else "<u2", symbols)):
            arrays.append(np.frombuffer(data, kind, n, at))
            at += arrays[-1].nbytes
        doc_ids, has_id, starts, pairs, lengths, seq = arrays
        return Shard(doc_ids, has_id.astype(bool), starts, first_rule, pairs.reshape(-1, 2), lengths, seq.astype(np.uint32), end_id)

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that symbols stand for; every pass opens one level of rules."""
        while (ruled := symbols >= self.first_rule).any():
            width = ruled + 1
            out = np.repeat(symbols, width)
            last = np.cumsum(width) - 1
            pair = self.rules[symbols[ruled] - self.first_rule]
            out[last[ruled] - 1], out[last[ruled]] = pair[:, 0], pair[:, 1]
            symbols = out
        return symbols.astype(np.uint32)

    def sizes(self) -> np.ndarray:
        """Ids of every document, its end id among them, without expanding any."""
        n = np.ones(len(self.symbols), np.int64)
        ruled = self.symbols >= self.first_rule
        n[ruled] = self.lengths[self.symbols[ruled] - self.first_rule]
        upto = np.concatenate(([0], np.cumsum(n)))
        starts = self.starts.astype(np.int64)
        return upto[starts[1:]] - upto[starts[:-1]] + 1

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document."""
        ids = self._expanded(self.symbols[int(self.starts[i]) : int(self.starts[i + 1])])
        return np.append(ids, np.uint32(self.end_id))

    def document_range(self, i: int, start: int, n: int) -> np.ndarray:
        """Ids start … start+n-1 of the i-th document, expanding only the symbols that hold them."""
        symbols = self.symbols[int(self.starts[i]) : int(self.starts[i + 1])]
        size = np.ones(len(symbols), np.int64)
        ruled = symbols >= self.first_rule
        size[ruled] = self.lengths[symbols[ruled] - self.first_rule]
        upto = np.cumsum(size)
        low, high = np.searchsorted(upto, start, "right"), np.searchsorted(upto, start + n, "left") + 1
        before = int(upto[low - 1]) if low else 0
        found = self._expanded(symbols[low:high])
        if start + n > (int(upto[-1]) if len(upto) else 0):
            found = np.append(found, np.uint32(self.end_id))
        return found[start - before : start - before + n]

    def all_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the shard and where each document begins, and the end."""
        bounds = np.concatenate(([0], np.cumsum(self.sizes())))
        out = np.full(int(bounds[-1]), self.end_id, np.uint32)
        inner = np.ones(len(out), bool)
        inner[bounds[1:] - 1] = False
        out[inner] = self._expanded(self.symbols)
        return out, bounds


def re_pair(
    ids: np.ndarray, starts: np.ndarray, first_rule: int, least: int = LEAST_COUNT, rounds: int = MOST_ROUNDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Replace frequent pairs by new symbols; returns symbols, flags of first symbols, rules and their lengths.

    A round counts all pairs, takes those that occur `least` times or more, the most frequent first, and
    replaces them from left to right where they do not overlap a more frequent one. Counting goes through
    hashed cells first, so that only pairs that can be frequent are sorted.
    """
    symbols = ids.astype(np.uint32)
    head = np.zeros(len(symbols) + 1, bool)
    head[starts] = True
    rules, lengths = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.uint32)]
    made = 0
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        pair = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
        cell = ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        inside = ~head[1:-1]
        often = np.bincount(cell[inside], minlength=_CELLS) >= least
        at = np.flatnonzero(inside & often[cell])
        if not len(at):
            break
        values, place, counts = np.unique(pair[at], return_inverse=True, return_counts=True)
        enough = counts >= least
        if not enough.any():
            break
        rank = np.full(len(values), len(values), np.int64)
        rank[np.flatnonzero(enough)[np.argsort(-counts[enough], kind="stable")]] = np.arange(enough.sum())
        mine = rank[place]
        at, mine = at[mine < len(values)], mine[mine < len(values)]
        # a pair gives way to a more frequent neighbour that it overlaps, else to the one on its left
        near = np.flatnonzero(np.diff(at) == 1)
        loses = np.zeros(len(at), bool)
        loses[near] |= mine[near + 1] < mine[near]
        loses[near + 1] |= mine[near] < mine[near + 1]
        at, mine = at[~loses], mine[~loses]
        run = np.concatenate(([True], np.diff(at) != 1))
        in_run = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        at, mine = at[in_run % 2 == 0], mine[in_run % 2 == 0]
        used, new = np.unique(mine, return_inverse=True)
        order = np.argsort(rank, kind="stable")
        chosen = values[order[used]]
        two = np.stack((chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)), axis=1).astype(np.uint32)
        known = np.concatenate(lengths)
        size = np.ones(two.shape, np.uint32)
        ruled = two >= first_rule
        size[ruled] = known[two[ruled] - first_rule]
        rules.append(two)
        lengths.append(size.sum(axis=1, dtype=np.uint32))
        symbols[at] = (first_rule + made + new).astype(np.uint32)
        made += len(used)
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols = symbols[stay]
        head = np.append(head[:-1][stay], False)
        if len(at) * 64 < len(symbols):
            break
    return symbols, head, np.concatenate(rules), np.concatenate(lengths)


def _compressed(waiting: list[tuple[int | None, bytes]], first_rule: int, end_id: int) -> tuple[Shard, int]:
    sizes = np.array([len(b) // 4 for _, b in waiting], np.int64)
    ids = np.frombuffer(b"".join(b for _, b in waiting), "<u4")
    starts = np.concatenate(([0], np.cumsum(sizes)))
    filled = sizes > 0
    symbols, head, rules, lengths = re_pair(ids, starts[:-1][filled], first_rule)
    found = np.append(np.flatnonzero(head[:-1]), len(symbols))
    # a document without ids begins where the next one does
    new = np.empty(len(sizes) + 1, np.int64)
    new[-1] = len(symbols)
    new[:-1] = found[np.concatenate(([0], np.cumsum(filled)[:-1]))]
    shard = Shard(
        np.array([0 if i is None else i for i, _ in waiting], np.int64),
        np.array([i is not None for i, _ in waiting], bool),
        new,
        first_rule,
        rules,
        lengths,
        symbols,
        end_id,
    )
    return shard, int(sizes.sum()) + len(sizes)


def write_token_files(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    keeps_space: bool = False,
    end_id: int = END_ID,
    file_documents: int = FILE_DOCUMENTS,
) -> None:
    """Write the ids of every whole text, each followed by `end_id`, in ascending id to `folder`.

    Null texts are empty; rows without an id come first; rows of equal id follow one another by text.
    Records carry their file and place in it, the ids they hold, and the shard's bytes.
    """
    path = path or tokenizer_path(TOKENIZER)
    rows = docs.count()
    files = max(1, -(-rows // file_documents))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, keeps_space)
        first_rule = words.tokenizer.get_vocab_size(with_added_tokens=True)
        file = TaskContext.get().partitionId()
        waiting: list[tuple[int | None, bytes]] = []
        held = place = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, place
            shard, n = _compressed(waiting, first_rule, end_id)
            out = pa.RecordBatch.from_pydict(
                {
                    "file": pa.array([file], pa.int64()),
                    "place": pa.array([place], pa.int64()),
                    "n_documents": pa.array([len(waiting)], pa.int64()),
                    "n_ids": pa.array([n], pa.int64()),
                    "n_symbols": pa.array([len(shard.symbols)], pa.int64()),
                    "shard": pa.array([shard.to_bytes()], pa.binary()),
                }
            )
            waiting.clear()
            held = 0
            place += 1
            return out

        for batch in batches:
            for part in pieces(batch, "text", PART_BYTES):
                for owner, ids in zip(part.column("doc_id").to_pylist(), words.encode(part.column("text"))):
                    if waiting and held + len(ids) // 4 > SHARD_IDS:
                        yield flush()
                    waiting.append((owner, ids))
                    held += len(ids) // 4 + 1
        if waiting:
            yield flush()

    (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(files, F.col("doc_id"))
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, "file long, place long, n_documents long, n_ids long, n_symbols long, shard binary")
        .write.parquet(folder)
    )


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files: `doc_id`, `start` (ids of all documents before it), `n_tokens`,
    `ids_crc32`, and with `with_ids` the `ids` themselves.

    Places come from sums over the records' counts: per file first, then over the few files.
    """
    records = spark.read.parquet(folder)
    counts = records.select("file", "place", "n_ids")
    files = counts.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("file", before.alias("file_start"))
    inner = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(files, "file").select(
        "file", "place", (F.col("file_start") + F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).alias("shard_start")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, place, data in zip(*(batch.column(c) for c in ("file", "place", "shard"))):
                shard = Shard.from_bytes(data.as_py())
                ids, bounds = shard.all_ids()
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                cuts = list(zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist()))
                n = len(cuts)
                out = {
                    "file": pa.array([file.as_py()] * n, pa.int64()),
                    "place": pa.array([place.as_py()] * n, pa.int64()),
                    "doc_id": pa.array(shard.doc_ids, mask=~shard.has_id),
                    "inner": pa.array(bounds[:-1]),
                    "n_tokens": pa.array(np.diff(bounds)),
                    "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in cuts], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([ids[a // 4 : b // 4].astype(np.int64) for a, b in cuts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    schema = "file long, place long, doc_id long, `inner` long, n_tokens long, ids_crc32 long" + (
        ", ids array<long>" if with_ids else ""
    )
    decoded = records.select("file", "place", "shard").mapInArrow(decode, schema)
    return decoded.join(starts, ["file", "place"]).select(
        "doc_id",
        (F.col("shard_start") + F.col("inner")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def read_documents(
    spark: SparkSession, folder: str, doc_ids: Sequence[int], start: int = 0, n: int | None = None
) -> DataFrame:
    """Ids of the named documents, or n of them from `start` on, decoding only what is asked for."""
    named = spark.sparkContext.broadcast(np.array(doc_ids, np.int64))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("shard"):
                shard = Shard.from_bytes(data.as_py())
                hits = np.flatnonzero(np.isin(shard.doc_ids, named.value) & shard.has_id)
                found = [
                    shard.document(i) if n is None and not start else shard.document_range(i, start, 1 << 62 if n is None else n)
                    for i in hits.tolist()
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(shard.doc_ids[hits]),
                        "ids": pa.array([f.astype(np.int64) for f in found], pa.list_(pa.int64())),
                    }
                )

    return spark.read.parquet(folder).select("shard").mapInArrow(decode, "doc_id long, ids array<long>")
