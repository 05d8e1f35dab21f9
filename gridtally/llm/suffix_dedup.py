"""Byte passages that an earlier document has as well, found with a logarithmic family of suffix arrays.

Two equal strings of 50 bytes hold the same anchor: the substring of 26 bytes with the least hash among
their 25. So only suffixes that begin at anchors are indexed, about one in thirteen, and of those only the
ones whose anchor occurs in two documents or more. A match goes on for 12 bytes at least to one side of its
anchor: a side whose first 12 bytes no other document has beside this anchor is cut to 11, and a suffix with too
little left for any match is not sent. With each other suffix goes the text of the strings that have
it as their anchor, at most 24 bytes to either side, which is all that their matches can need.

Suffixes are dealt into buckets by their anchor. In a bucket, documents come in batches of ascending id.
A batch's suffix array is sorted by anchor and following bytes, merge-scanned against every level of the
index and against its own earlier documents, and then becomes a level; levels of equal size are merged, so
a bucket of n batches has log n levels, and every suffix is merged log n times. A level holds each distinct
surrounding once. Longest matches come from comparing the surroundings to the left and to the right.

Anchors in very many documents are not held in one bucket: there the strings of 50 bytes themselves are
hashed, each task keeps a string's first document only, and buckets by string hash settle the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.frequency import frequency_bitmaps, holds
from gridtally.llm.hashing import mix, pieces, prefix_sums, substring_hashes, text_bytes
from gridtally.session import materialize, passing_shuffles, text_batches

LENGTH = 50
ANCHOR = 26
SIDE = LENGTH - ANCHOR
# Bytes that every match has in common before its anchor or after it.
NEAR = SIDE // 2
# Anchors in this many documents or more are matched by string hashes instead.
HOT_ANCHOR = 1024
# Suffixes of a bucket that make up a batch.
BATCH = 1 << 15
# Suffixes a task gathers before it sends them to their buckets; a string counts as a quarter of one.
FLUSH = 1 << 19
# Suffix pairs compared, and bytes of text searched for anchors, at a time.
PAIRS = 1 << 18
PIECE = 1 << 18
# Bytes of documents that are dealt out together; longer records compress better.
DEALT = 1 << 25
# Effort of compressing what is shuffled.
LEVEL = 9

SUFFIX = np.dtype(
    [
        ("anchor", "<u8"),
        ("owner", "<u4"),
        ("rank", "<u4"),
        ("at", "<u4"),
        ("before", "u1"),
        ("after", "u1"),
        ("left", "u1", SIDE),
        ("right", "u1", SIDE),
    ]
)
STRING = np.dtype([("hash", "<u8"), ("owner", "<u4"), ("rank", "<u4"), ("at", "<u4")])
# A document's id, and a hash of its id and text that tells rows of equal id apart.
OWNER = np.dtype([("id", "<i8"), ("key", "<i8")])
SPAN = np.dtype([("key", "<i8"), ("start", "<u4"), ("end", "<u4")])


def pack(rows: np.ndarray) -> bytes:
    raw = rows.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.Codec("zstd", LEVEL).compress(raw, asbytes=True) if raw else b"")


def unpack(blob: bytes, kind: np.dtype) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True) if size else b"", kind)


def _planes(x: np.ndarray) -> np.ndarray:
    """The numbers' bytes, all first ones, then all second ones: where few change, they compress to nothing."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).reshape(-1)


def _from_planes(raw: bytes, kind: str, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, "u1", n * size, at).reshape(size, n).T).view(kind).reshape(-1)


def pack_owners(rows: np.ndarray) -> bytes:
    """Documents' ids as steps, then their keys."""
    return pack(np.concatenate([_planes(np.diff(rows["id"], prepend=np.int64(0))), np.ascontiguousarray(rows["key"]).view("u1")]))


def unpack_owners(blob: bytes) -> np.ndarray:
    raw = unpack(blob, np.dtype("u1")).tobytes()
    rows = np.zeros(len(raw) // OWNER.itemsize, OWNER)
    rows["id"] = np.cumsum(_from_planes(raw, "<i8", len(rows), 0))
    rows["key"] = np.frombuffer(raw, "<i8", len(rows), 8 * len(rows))
    return rows


def pack_spans(rows: np.ndarray) -> bytes:
    """Spans in order of their documents: each key once, the number of its spans, then their starts and lengths."""
    key, n = np.unique(rows["key"], return_counts=True)
    order = np.argsort(rows["key"], kind="stable")
    start, end = rows["start"][order], rows["end"][order]
    head = np.array([len(rows), len(key)], "<u8").view(np.uint8)
    return pack(np.concatenate([head, key.view(np.uint8), *(_planes(x.astype("<u4")) for x in (n, start, end - start))]))


def unpack_spans(blob: bytes) -> np.ndarray:
    raw = unpack(blob, np.dtype("u1")).tobytes()
    n, m = np.frombuffer(raw, "<u8", 2).tolist()
    rows = np.zeros(n, SPAN)
    rows["key"] = np.repeat(np.frombuffer(raw, "<i8", m, 16), _from_planes(raw, "<u4", m, 16 + 8 * m))
    rows["start"] = _from_planes(raw, "<u4", n, 16 + 12 * m)
    rows["end"] = rows["start"] + _from_planes(raw, "<u4", n, 16 + 12 * m + 4 * n)
    return rows


def pack_suffixes(rows: np.ndarray) -> bytes:
    """Suffixes column by column, each distinct surrounding once and without bytes that it has not.

    Of an anchor's hash the upper 48 bits go: two anchors that agree in them match only if the same 24 bytes or more
    stand beside both.
    """
    _, first, place = np.unique(_codes(rows), return_index=True, return_inverse=True)
    order = np.argsort(first)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    kinds, column = rows[first[order]], np.arange(SIDE)
    steps = [np.diff(x.astype(np.int64), prepend=0).astype("<i4") for x in (number[place], rows["owner"], rows["at"])]
    texts = [kinds[side][column < kinds[n][:, None]] for side, n in (("left", "before"), ("right", "after"))]
    head = np.array([len(rows), len(kinds)], "<u8").view(np.uint8)
    return pack(np.concatenate([head, *(np.ascontiguousarray(x).view(np.uint8) for x in (
        *(_planes(x) for x in steps), _planes(kinds["anchor"])[2 * len(kinds) :], kinds["before"], kinds["after"], *texts))]))


def unpack_suffixes(blob: bytes) -> np.ndarray:
    raw = unpack(blob, np.dtype("u1")).tobytes()
    n, m = np.frombuffer(raw, "<u8", 2).tolist()
    steps = [_from_planes(raw, "<i4", n, 16 + 4 * n * i) for i in range(3)]
    kinds, column = np.zeros(m, SUFFIX), np.arange(SIDE)
    at = 16 + 12 * n
    kinds["anchor"] = _from_planes(bytes(2 * m) + raw[at : at + 6 * m], "<u8", m, 0)
    kinds["before"], kinds["after"] = np.frombuffer(raw, "u1", 2 * m, at + 6 * m).reshape(2, m)
    at += 8 * m
    for side, size in (("left", "before"), ("right", "after")):
        there = column < kinds[size][:, None]
        text = np.zeros(there.shape, np.uint8)
        text[there] = np.frombuffer(raw, "u1", int(kinds[size].sum(dtype=np.int64)), at)
        kinds[side] = text
        at += int(there.sum())
    place, owner, start = (np.cumsum(c, dtype=np.int64) for c in steps)
    rows = kinds[place]
    rows["owner"], rows["at"] = owner, start
    return rows


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every `width` neighbours."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def anchors(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors of several documents, one after another in `data`, the anchors' hashes, and of
    every string of 50 bytes the least hash in it, with SIDE zeros at both ends; 0 if it crosses documents.

    A place is an anchor if it has the least hash in one of the strings of 50 bytes that it lies in; of
    equal hashes all count. Strings do not cross documents.
    """
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(2 * SIDE, np.uint64)
    places = np.arange(len(data) - ANCHOR + 1)
    hashes = substring_hashes(sums, places, places + ANCHOR)
    least = _sliding(hashes, SIDE + 1, np.minimum)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    least[places[: len(least)] + LENGTH > ends] = 0
    edge = np.zeros(SIDE, np.uint64)
    least = np.concatenate((edge, least, edge))
    chosen = _sliding(least, SIDE + 1, np.maximum) == hashes
    return places[chosen], hashes[chosen], least


def reach(at: np.ndarray, hashes: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before and after each anchor that the strings with this anchor take up.

    Equal strings have the same anchor, so an anchor need only be compared within its own strings.
    """
    before, after = np.zeros(len(at), np.uint8), np.zeros(len(at), np.uint8)
    views = np.lib.stride_tricks.sliding_window_view(least, SIDE + 1) if len(at) else least
    for i in range(0, len(at), PAIRS):
        mine = views[at[i : i + PAIRS]] == hashes[i : i + PAIRS, None]
        before[i : i + PAIRS] = SIDE - mine.argmax(axis=1)
        after[i : i + PAIRS] = SIDE - mine[:, ::-1].argmax(axis=1)
    return before, after


def beside(
    sums: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray
) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Which anchors' strings reach NEAR bytes before them, and the hashes of these bytes with the anchor; the same after."""
    left, right = np.flatnonzero(before >= NEAR), np.flatnonzero(after >= NEAR)
    return (
        (left, substring_hashes(sums, at[left] - NEAR, at[left] + ANCHOR)),
        (right, substring_hashes(sums, at[right], at[right] + ANCHOR + NEAR)),
    )


def needed(
    sums: np.ndarray, at: np.ndarray, hashes: np.ndarray, least: np.ndarray, near: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which anchors may have a match, and the bytes before and after these that it may take up.

    `near` has the hashes from `beside` that two documents or more have. A match of NEAR bytes or more on a side has
    that side's hash in common, so without it the side matters for less than NEAR; a match needs SIDE bytes in all.
    """
    reached = reach(at, hashes, least)
    sides = []
    for far, (place, found) in zip(reached, beside(sums, at, *reached)):
        most = np.full(len(at), NEAR - 1, np.uint8)
        most[place[holds(near, found)]] = SIDE
        sides.append(np.minimum(far, most))
    use = sides[0] + sides[1] >= SIDE
    return use, sides[0][use], sides[1][use]


def surrounded(
    data: np.ndarray, offsets: np.ndarray, at: np.ndarray, hashes: np.ndarray, row: np.ndarray, before: np.ndarray, after: np.ndarray
) -> np.ndarray:
    """Suffix records of anchors: where each begins in its document and the bytes before and after that it needs."""
    out = np.zeros(len(at), SUFFIX)
    out["anchor"], out["at"] = hashes, at - offsets[row]
    out["before"], out["after"] = before, after
    padded = np.concatenate((np.zeros(SIDE, np.uint8), data, np.zeros(SIDE, np.uint8)))
    views = np.lib.stride_tricks.sliding_window_view(padded, SIDE)
    column = np.arange(SIDE)
    out["left"] = np.where(column < out["before"][:, None], views[at][:, ::-1], 0)
    out["right"] = np.where(column < out["after"][:, None], views[at + SIDE + ANCHOR], 0)
    return out


def _codes(suffixes: np.ndarray) -> np.ndarray:
    """A number for each suffix that is equal for equal anchors and surroundings."""
    cells = np.concatenate(
        (suffixes["left"], suffixes["right"], suffixes["before"][:, None], suffixes["after"][:, None]), axis=1
    )
    words = np.ascontiguousarray(np.pad(cells, ((0, 0), (0, -cells.shape[1] % 8)))).view("<u8")
    code = suffixes["anchor"].copy()
    for i in range(words.shape[1]):
        code = mix(code + words[:, i])
    return code


def _sorted(suffixes: np.ndarray) -> np.ndarray:
    """The suffix array: by anchor, then by the bytes that follow it, then by document."""
    words = np.ascontiguousarray(suffixes["right"]).view(">u8")
    keys = [words[:, i] for i in reversed(range(words.shape[1]))]
    return suffixes[np.lexsort((suffixes["rank"], *keys, suffixes["anchor"]))]


def _common(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common beginning of the rows of x and y, up to `most`."""
    differ = np.concatenate((x != y, np.ones((len(x), 1), bool)), axis=1)
    return np.minimum(differ.argmax(axis=1), most)


def _scan(probes: np.ndarray, level: np.ndarray, own: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Merge-scan a sorted batch against a sorted level: owner and span of every match of 50 bytes or more.

    With `own`, the level is of the probes' own batch, and only its earlier documents count.
    """
    low = np.searchsorted(level["anchor"], probes["anchor"], "left")
    runs = np.searchsorted(level["anchor"], probes["anchor"], "right") - low
    upto = np.cumsum(runs)
    owners, spans = [np.zeros(0, np.uint32)], [np.zeros((0, 2), np.int64)]
    at = 0
    while at < len(probes):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        n = runs[at:to]
        i = np.repeat(np.arange(at, to), n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at:to], n)
        if own:
            earlier = level["rank"][j] < probes["rank"][i]
            i, j = i[earlier], j[earlier]
        x, y = probes[i], level[j]
        left = _common(x["left"], y["left"], np.minimum(x["before"], y["before"])).astype(np.int64)
        right = _common(x["right"], y["right"], np.minimum(x["after"], y["after"])).astype(np.int64)
        long = left + right >= SIDE
        place = x["at"][long].astype(np.int64)
        owners.append(x["owner"][long])
        spans.append(np.stack((place - left[long], place + ANCHOR + right[long]), axis=1))
        at = to
    return np.concatenate(owners), np.concatenate(spans)


class Levels:
    """The index family of one bucket: suffix arrays, each twice the batches of the next or more."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Match a batch of documents later than all before; then take it in. Owners and spans of matches."""
        batch = _sorted(batch)
        code = _codes(batch)
        by = np.lexsort((batch["rank"], code))
        opens = np.concatenate(([True], code[by][1:] != code[by][:-1]))
        first = np.empty(len(by), np.int64)
        first[by] = by[opens][np.cumsum(opens) - 1]
        # whole surroundings that an earlier document has, in this batch or in a level
        again = batch["rank"] > batch["rank"][first]
        for _, _, known in self.levels:
            place = np.minimum(np.searchsorted(known, code), len(known) - 1)
            again |= known[place] == code
        full, rest = batch[again], batch[~again]
        at = full["at"].astype(np.int64)
        found = [(full["owner"], np.stack((at - full["before"], at + ANCHOR + full["after"]), axis=1))]
        distinct = np.zeros(len(batch), bool)
        distinct[by[opens]] = True
        own = batch[distinct]
        found.append(_scan(rest, own, own=True))
        for _, level, _ in self.levels:
            found.append(_scan(rest, level))
        self.levels.append((1, own, np.sort(code[distinct])))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self._merge()
        return np.concatenate([o for o, _ in found]), np.concatenate([s for _, s in found])

    def _merge(self) -> None:
        """Make one level of the two newest; a surrounding that both have stays once."""
        (size, late, _), (_, early, known) = self.levels.pop(), self.levels.pop()
        code = _codes(late)
        place = np.minimum(np.searchsorted(known, code), len(known) - 1)
        new = known[place] != code
        both = _sorted(np.concatenate((early, late[new])))
        self.levels.append((2 * size, both, np.sort(np.concatenate((known, code[new])))))


def _matched_suffixes(owners: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Matched spans of a bucket's suffixes, batch by batch in ascending id."""
    levels, out, at = Levels(), [np.zeros(0, SPAN)], 0
    rows = suffixes[np.argsort(suffixes["rank"], kind="stable")]
    while at < len(rows):
        to = min(len(rows), at + BATCH)
        if to < len(rows):
            to = int(np.searchsorted(rows["rank"], rows["rank"][to - 1], "right"))
        owner, span = levels.add(rows[at:to])
        found = np.zeros(len(owner), SPAN)
        found["key"], found["start"], found["end"] = owners["key"][owner], span[:, 0], span[:, 1]
        out.append(_joined(found))
        at = to
    return np.concatenate(out)


def _matched_strings(owners: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the strings that a document of smaller rank has as well, and which strings these are not."""
    by = np.lexsort((strings["rank"], strings["hash"]))
    rows = strings[by]
    opens = np.concatenate(([True], rows["hash"][1:] != rows["hash"][:-1]))[: len(rows)]
    again = rows["rank"] > rows["rank"][opens][np.cumsum(opens) - 1] if len(rows) else opens
    found = np.zeros(int(again.sum()), SPAN)
    found["key"], found["start"] = owners["key"][rows["owner"][again]], rows["at"][again]
    found["end"] = found["start"] + LENGTH
    return _joined(found), rows[~again]


def _joined(spans: np.ndarray) -> np.ndarray:
    """The same bytes in as few spans as possible, by document and place."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["key"]))]
    # ends run up within a document: documents are told apart by adding a step larger than any end
    new_key = np.concatenate(([True], spans["key"][1:] != spans["key"][:-1]))
    step = int(spans["end"].max()) + 1
    base = (np.cumsum(new_key) - 1).astype(np.int64) * step
    reach = np.maximum.accumulate(spans["end"] + base)
    opens = np.concatenate(([True], spans["start"][1:] + base[1:] > reach[:-1]))
    out = spans[opens]
    last = np.concatenate((np.flatnonzero(opens)[1:] - 1, [len(spans) - 1]))
    out["end"] = reach[last] - base[last]
    return out


def _ranked(owners: np.ndarray, rows: np.ndarray) -> np.ndarray:
    rows = rows.copy()
    rows["rank"] = np.unique(owners["id"], return_inverse=True)[1].reshape(-1)[rows["owner"]]
    return rows


def _dealt(kind: int, bucket: np.ndarray, owners: np.ndarray, rows: np.ndarray, out: list[tuple]) -> None:
    """Pack records into one row per bucket, each with the owners that it needs."""
    order = np.argsort(bucket, kind="stable")
    for chosen in _runs(bucket, order):
        mine = rows[chosen]
        used, place = np.unique(mine["owner"], return_inverse=True)
        mine["owner"] = place.reshape(-1)
        out.append((kind, int(bucket[chosen[0]]), pack_owners(owners[used]), pack(mine) if kind else pack_suffixes(mine)))


def _runs(values: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
    """`order`, which sorts `values`, cut where the value changes."""
    return np.split(order, np.flatnonzero(np.diff(values[order])) + 1) if len(order) else []


def _spans_by_part(spans: np.ndarray, parts: int) -> list[tuple[int, bytes]]:
    part = np.mod(spans["key"], parts)
    order = np.argsort(part, kind="stable")
    return [(int(part[c[0]]), pack_spans(spans[c])) for c in _runs(part, order)]


def _stream(batch: pa.RecordBatch) -> bytes:
    """A batch as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _once_a_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Each row's distinct hashes."""
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    return hashes[np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])))[: len(row)]]


def repeated_spans(docs: DataFrame, rows: int) -> DataFrame:
    """Spans of bytes that an earlier document has, packed: (part, spans); `part` is `pmod(key, parts)`.

    `docs` has `doc_id` (long), `text` and `key`, a hash of both.
    """
    parts = part_count(rows)
    buckets = parts

    def counted(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in pieces(batch, "text", PIECE):
            data, offsets = text_bytes(part.column("text"))
            at, hashes, _ = anchors(data, offsets, prefix_sums(data))
            yield _once_a_row(hashes, np.searchsorted(offsets, at, "right") - 1)

    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(frequency_bitmaps(docs.select("text"), counted, rows, HOT_ANCHOR))

    def counted_near(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        shared, hot = known.value
        for part in pieces(batch, "text", PIECE):
            data, offsets = text_bytes(part.column("text"))
            sums = prefix_sums(data)
            at, hashes, least = anchors(data, offsets, sums)
            use = holds(shared, hashes) & ~holds(hot, hashes)
            at, hashes = at[use], hashes[use]
            (left, one), (right, two) = beside(sums, at, *reach(at, hashes, least))
            row = np.searchsorted(offsets, at[np.concatenate((left, right))], "right") - 1
            yield _once_a_row(np.concatenate((one, two)), row)

    # only whether a hash is shared is of use here
    sieve = spark.sparkContext.broadcast(frequency_bitmaps(docs.select("text"), counted_near, rows, HOT_ANCHOR)[0])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, hot = known.value
        owners, suffixes, strings, held, n = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            out: list[tuple] = []
            who = np.concatenate(owners)
            rows = np.concatenate(suffixes)
            _dealt(0, rows["anchor"] % np.uint64(buckets), who, rows, out)
            spans, rest = _matched_strings(who, _ranked(who, np.concatenate(strings)))
            _dealt(1, rest["hash"] % np.uint64(buckets), who, rest, out)
            out += [(2, part, b"", blob) for part, blob in _spans_by_part(spans, parts)]
            owners.clear(), suffixes.clear(), strings.clear()
            columns = list(zip(*out)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                names=["kind", "bucket", "owners", "records"],
            )

        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                data, offsets = text_bytes(part.column("text"))
                sums = prefix_sums(data)
                at, hashes, least = anchors(data, offsets, sums)
                use = holds(shared, hashes)
                at, hashes = at[use], hashes[use]
                row = np.searchsorted(offsets, at, "right") - 1
                often = holds(hot, hashes)
                kept, before, after = needed(sums, at[~often], hashes[~often], least, sieve.value)
                chosen = np.flatnonzero(~often)[kept]
                mine = surrounded(data, offsets, at[chosen], hashes[chosen], row[chosen], before, after)
                mine["owner"] = row[chosen] + n
                # every string of 50 bytes with a hot anchor
                before, after = (x.astype(np.int64) for x in reach(at[often], hashes[often], least))
                n_strings = before + after - SIDE + 1
                opens = np.repeat(np.cumsum(n_strings) - n_strings, n_strings)
                start = np.repeat(at[often] - before, n_strings) + np.arange(len(opens)) - opens
                start, place = np.unique(start, return_index=True)
                where = np.repeat(row[often], n_strings)[place]
                string = np.zeros(len(start), STRING)
                string["hash"] = substring_hashes(sums, start, start + LENGTH)
                string["owner"], string["at"] = where + n, start - offsets[where]
                who = np.zeros(part.num_rows, OWNER)
                who["id"], who["key"] = part.column("doc_id").to_numpy(), part.column("key").to_numpy()
                owners.append(who), suffixes.append(mine), strings.append(string)
                n += part.num_rows
                held += len(mine) + len(string) // 4
                if held >= FLUSH:
                    yield flush()
                    held, n = 0, 0
        if owners:
            yield flush()

    emitted = docs.mapInArrow(emit, "kind int, bucket int, owners binary, records binary")

    def match(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        if kind == 2:
            # spans that a task has settled by itself; their bucket is their part
            return pa.table({"part": table["bucket"], "spans": table["records"]})
        owners, records, n = [], [], 0
        for who, blob in zip(table["owners"], table["records"]):
            mine = unpack_owners(who.as_py())
            rows = unpack(blob.as_py(), STRING).copy() if kind else unpack_suffixes(blob.as_py())
            rows["owner"] += np.uint32(n)
            n += len(mine)
            owners.append(mine), records.append(rows)
        who = np.concatenate(owners)
        rows = _ranked(who, np.concatenate(records))
        spans = _joined(_matched_strings(who, rows)[0] if kind else _matched_suffixes(who, rows))
        found = list(zip(*_spans_by_part(spans, parts))) or [(), ()]
        return pa.table({"part": pa.array(found[0], pa.int32()), "spans": pa.array(found[1], pa.binary())})

    return emitted.groupBy("kind", "bucket").applyInArrow(match, "part int, spans binary")


def part_count(rows: int) -> int:
    """Groups of documents that are cut together, about eight thousand each, and buckets of suffixes.

    A task sends each group one packed record: fewer groups make longer records, which compress better.
    """
    return max(8, -(-rows // 8000))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the bytes removed that lie in a string of 50 bytes which a document of smaller id has.

    Texts count as UTF-8 bytes, null as empty; matches never cross documents and are judged on the input.
    Adds `n_bytes`, `n_removed`, `n_spans` (runs of removed bytes), `kept` (the rest as bytes) and
    `kept_sha256`. The text column holds the rest as text, without characters of which a part was
    removed; it stays null where it was null. A column of one of these names gives way to the new one.

    Every row comes back once. Rows that share an id are not matched with one another; a row without an
    id is not matched at all. Empty tables give empty results.
    """
    text_batches(docs.sparkSession)
    rows = docs.count()
    parts = part_count(rows)
    added = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary", "kept_sha256": "string"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    key = F.xxhash64(F.col(doc_id).cast("long"), F.col(text))
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), key.alias("key"))
    # a small copy: the suffixes' shuffle is gone before that of the documents begins
    with passing_shuffles(docs.sparkSession):
        spans = materialize(repeated_spans(source.filter("doc_id is not null"), rows), "spans")
    names = docs.columns
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + "".join(f", {n} {t}" for n, t in added.items())
    keyed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), key.alias("key"))
    keyed = keyed.withColumn("part", F.pmod("key", F.lit(parts)).cast("int"))

    def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def dealt() -> pa.RecordBatch:
            (batch,) = pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting.clear()
            part = batch.column("part").to_numpy()
            order = np.argsort(part, kind="stable")
            of_part, blobs = zip(*((int(part[c[0]]), _stream(batch.take(pa.array(c)))) for c in _runs(part, order)))
            return pa.RecordBatch.from_pydict(
                {"part": pa.array(of_part, pa.int32()), "documents": pa.array(blobs, pa.binary())}
            )

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                held += batch.nbytes
                if held >= DEALT:
                    yield dealt()
                    held = 0
        if waiting:
            yield dealt()

    def cut(documents: pa.Table, found: pa.Table) -> pa.Table:
        spans = [unpack_spans(b.as_py()) for b in found["spans"]] if found.num_rows else []
        spans = _joined(np.concatenate(spans)) if spans else np.zeros(0, SPAN)
        return pa.concat_tables(
            [cut_rows(pa.ipc.open_stream(blob.as_buffer()).read_all(), spans) for blob in documents["documents"]]
        )

    def cut_rows(documents: pa.Table, spans: np.ndarray) -> pa.Table:
        keys = documents["key"].to_numpy()
        low, high = np.searchsorted(spans["key"], keys, "left"), np.searchsorted(spans["key"], keys, "right")
        (rows,) = documents["row"].chunks
        columns = dict(zip(names, rows.flatten()))
        new: dict[str, list] = {n: [] for n in added}
        texts = []
        for value, a, b in zip(columns[text], low.tolist(), high.tolist()):
            value = value.as_py()
            raw = (value or "").encode()
            mine = spans[a:b]
            edges = [0, *np.stack((mine["start"], mine["end"]), axis=1).reshape(-1).tolist(), len(raw)]
            kept = b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
            new["n_bytes"].append(len(raw))
            new["n_removed"].append(len(raw) - len(kept))
            new["n_spans"].append(b - a)
            new["kept"].append(kept)
            new["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            texts.append(None if value is None else value if a == b else kept.decode("utf-8", "ignore"))
        columns[text] = pa.array(texts, pa.string())
        kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        return pa.table(columns | {n: pa.array(v, kinds[added[n]]) for n, v in new.items()})

    return (
        keyed.mapInArrow(by_part, "part int, documents binary")
        .groupBy("part")
        .cogroup(spans.groupBy("part"))
        .applyInArrow(cut, schema)
    )
