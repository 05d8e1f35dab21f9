"""Packing of tokenised documents into windows of fixed source proportions.

Every source is a queue of its documents' tokens. Windows are filled by deficit round-robin: in each window
two halves of the queues are credited their shares, and so are the halves of a half, down to single queues;
whole tokens are served, and the fraction of a credit that is not is the deficit from which the next window
starts. Served tokens are thereby the whole part of a running sum of shares, so a queue's state before any
window is a few quotients and needs no run through the windows before it. Tasks tokenise their documents
once and write the ids; then each starts from the state that the tokens before it leave, and places its
documents by itself. No text and no ids are shuffled, and neither a source nor a window is gathered anywhere.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.hashing import pieces
from gridtally.llm.tokens import encoder, tokenizer_path
from gridtally.session import materialize, release

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
LENGTH = 2048
# Sequences of a window, in which every source has its share.
WINDOW = 8
# Bytes of text that are encoded at a time.
PART_BYTES = 1 << 22


@dataclass
class Phase:
    """A stretch of the mixed tokens with fixed shares; a queue's turns are (share of the first half, of both, whether it is in the second)."""

    start: int
    length: int
    turns: dict[int, list[tuple[int, int, bool]]]
    before: dict[int, int]

    def served(self, queue: int, t: int) -> tuple[int, int]:
        """Tokens that the queue has served in all when t tokens of the phase are filled, and what those before it have served in the phase."""
        ahead = 0
        for first, both, second in self.turns[queue]:
            n = first * t // both
            if second:
                ahead += n
                t -= n
            else:
                t = n
        return self.before[queue] + t, ahead


def turns(shares: dict[int, int]) -> dict[int, list[tuple[int, int, bool]]]:
    """For each queue the halves it is in, from all queues down to itself."""
    out: dict[int, list[tuple[int, int, bool]]] = {j: [] for j in shares}
    open_ = [sorted(shares)]
    while open_:
        queues = open_.pop()
        if len(queues) > 1:
            halves = queues[: len(queues) // 2], queues[len(queues) // 2 :]
            first, both = sum(shares[j] for j in halves[0]), sum(shares[j] for j in queues)
            for second, half in enumerate(halves):
                for j in half:
                    out[j].append((first, both, bool(second)))
            open_ += halves
    return out


def phases(tokens: list[int], weights: list[int]) -> list[Phase]:
    """Phases in which queues of so many tokens are served by weight until one after the other is used up.

    A queue that is down to its last few tokens gives them in a short phase of its own, so that counts
    stay whole. Queues without a weight follow at the end, by their size.
    """
    left, out, start = list(tokens), [], 0
    # no queue is ever further from its share than it has halvings
    slack = len(tokens).bit_length() + 1

    def serve(shares: dict[int, int], length: int) -> None:
        nonlocal start
        phase = Phase(start, length, turns(shares), {j: tokens[j] - left[j] for j in shares})
        for j in shares:
            left[j] = tokens[j] - phase.served(j, length)[0]
        start += length
        out.append(phase)

    while live := {j: weights[j] for j in range(len(left)) if left[j] and weights[j]}:
        if all(live[j] == left[j] for j in live):
            serve(live, sum(live.values()))
            continue
        whole = sum(live.values())
        length = min((left[j] - slack) * whole // w for j, w in live.items())
        if length > 0:
            serve(live, length)
        few = {j: left[j] for j in live if 0 < left[j] <= 2 * slack}
        if few:
            serve(few, sum(few.values()))
    if any(left):
        rest = {j: n for j, n in enumerate(left) if n}
        serve(rest, sum(rest.values()))
    return out


class Plan:
    """Places of all queues' tokens in sequences."""

    def __init__(self, tokens: list[int], weights: list[int] | None, length: int, window: int) -> None:
        self.phases = phases(tokens, weights or tokens)
        self.length, self.window = length, length * window
        self.starts = {j: ([], []) for j in range(len(tokens))}
        for i, phase in enumerate(self.phases):
            for j in phase.before:
                self.starts[j][0].append(phase.before[j])
                self.starts[j][1].append(i)
        self.total = sum(tokens)
        self.full = self.total // length
        # the end goes into sequences of a power of two each, so that nothing is padded
        self.tail, rest = [], self.total % length
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                self.tail.append((self.tail[-1][1] if self.tail else 0, (self.tail[-1][1] if self.tail else 0) + (1 << bit)))

    def _sequences(self, at: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, length) of n tokens from a place in the mixed stream."""
        while n:
            if at < self.full * self.length:
                sequence, offset = divmod(at, self.length)
                room = self.length - offset
            else:
                rest = at - self.full * self.length
                i = next(i for i, (_, end) in enumerate(self.tail) if rest < end)
                sequence, offset, room = self.full + i, rest - self.tail[i][0], self.tail[i][1] - rest
            take = min(n, room)
            yield sequence, offset, take
            at, n = at + take, n - take

    def place(self, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(start in the document, length, window, sequence, offset) of n tokens from a place in a queue."""
        done = 0
        befores, indices = self.starts[queue]
        while done < n:
            x = start + done
            phase = self.phases[indices[bisect_right(befores, x) - 1]]
            end = phase.start + phase.length
            share = 1.0
            for first, both, second in phase.turns[queue]:
                share *= (both - first if second else first) / both
            # about where the token is due; the windows beside it are tried until one holds it
            number = min(phase.start + int((x - phase.before[queue]) / share), end - 1) // self.window
            while True:
                a = max(number * self.window, phase.start) - phase.start
                b = min((number + 1) * self.window, end) - phase.start
                (served, ahead), (until, beyond) = phase.served(queue, a), phase.served(queue, b)
                if served > x:
                    number -= 1
                elif until <= x:
                    number += 1
                else:
                    break
            take = min(n - done, until - x)
            at = phase.start + a + beyond - ahead + x - served
            for sequence, offset, length in self._sequences(at, take):
                yield done, length, number, sequence, offset
                done += length


def _tokenised(docs: DataFrame, path: str, keeps_space: bool, end_id: int) -> DataFrame:
    """Each document's ids, 16 bits each where the vocabulary allows, and the tokens before it of its source and part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = encoder(path, keeps_space), TaskContext.get().partitionId()
        small = max(words.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        before: dict[str | None, int] = {}
        for batch in batches:
            for part in pieces(batch, "text", PART_BYTES):
                ids, offsets = words.arrays(part.column("text"))
                ids = np.insert(ids, offsets[1:], end_id).astype("<u2" if small else "<u4")
                offsets = offsets + np.arange(len(offsets))
                raw, width = ids.tobytes(), ids.itemsize
                sizes, starts = np.diff(offsets), []
                for source, n in zip(part.column("source").to_pylist(), sizes.tolist()):
                    starts.append(before.get(source, 0))
                    before[source] = starts[-1] + n
                found = [raw[a * width : b * width] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("source"), pa.array([number] * part.num_rows, pa.int64()),
                        pa.array(starts, pa.int64()), pa.array(sizes), pa.array(found, pa.binary()),
                    ],
                    names=["doc_id", "source", "part", "before", "doc_tokens", "ids"],
                )

    return docs.mapInArrow(encode, "doc_id long, source string, part long, before long, doc_tokens long, ids binary")


def pack_mixture(
    docs: DataFrame,
    weights: Mapping[str | None, int] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    length: int = LENGTH,
    window: int = WINDOW,
    path: str | None = None,
    keeps_space: bool = False,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`, `source`, `window`;
    with `with_ids` also `ids`, the piece's ids as unsigned 32-bit integers.

    A document's ids are those of its whole text (null is empty) and `end_id`. Every window of `window`
    sequences holds the sources in proportion to `weights`, whole numbers, to a token; without weights these
    are the sources' tokens, so that all windows are alike to the last. A source that is used up leaves its
    share to the others; sources that `weights` leaves out come when the rest is used up. Documents of a
    source follow one another and go on from window to window; they are cut where their source's share of a
    window or a sequence ends.

    Sequences are full but for the last few, whose lengths are powers of two, so nothing is padded.
    Every row is packed, also rows without an id or with one that others have; a null source is a source,
    last in its windows. An empty table gives no pieces. Other columns are ignored. One row per source is
    kept on the driver.
    """
    if weights is not None and any(w < 0 or w != int(w) for w in weights.values()):
        raise ValueError("weights are whole numbers from 0")
    path = path or tokenizer_path(TOKENIZER)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text")
    )
    tokenised = materialize(_tokenised(rows, path, keeps_space, end_id), "mixture-ids")
    parts = materialize(tokenised.groupBy("source", "part").agg(F.sum("doc_tokens").alias("tokens")), "mixture-parts")
    queues = [tuple(r) for r in parts.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()]
    queues.sort(key=lambda q: (q[0] is None, (q[0] or "").encode()))
    names = {name: j for j, (name, _) in enumerate(queues)}
    plan = Plan(
        [n for _, n in queues], None if weights is None else [int(weights.get(name, 0)) for name, _ in queues], length, window
    )
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = materialize(
        parts.select(F.col("source").alias("of"), F.col("part").alias("number"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first")),
        "mixture-firsts",
    )
    release(parts)
    ready = tokenised.join(firsts, (F.col("part") == F.col("number")) & F.col("source").eqNullSafe(F.col("of")))
    ready = ready.select("doc_id", "source", (F.col("first") + F.col("before")).alias("at"), "doc_tokens", "ids")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found, held = [], [], []
            for i, (name, at, n, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("source", "at", "doc_tokens", "ids")))):
                raw = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
                for start, size, number, sequence, offset in plan.place(names[name], at, n):
                    mine = raw[4 * start : 4 * (start + size)]
                    owner.append(i)
                    found.append((start, size, zlib.crc32(mine), n, sequence, offset, number))
                    if with_ids:
                        held.append(mine)
            columns = np.array(found, np.int64).reshape(-1, 7).T
            arrays = [batch.column("doc_id").take(pa.array(owner, pa.int64())), *map(pa.array, columns[:6])]
            arrays += [batch.column("source").take(pa.array(owner, pa.int64())), pa.array(columns[6])]
            named = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "window"]
            if with_ids:
                arrays.append(pa.array(held, pa.binary()))
                named.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=named)

    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, source string, `window` long"
    )
    out = ready.mapInArrow(place, schema + (", ids binary" if with_ids else ""))
    return out.withColumnsRenamed({"doc_id": doc_id} | ({"source": source} if source != "source" else {}))
