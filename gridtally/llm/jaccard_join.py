"""Links between texts whose sets of word shingles overlap, found by token-combination prefixes.

A token is a hashed shingle. All tokens have one order: rare ones before frequent ones, and by hash
within each kind. Two texts of similarity `percent` miss at most `errors = n - ceil(percent * n / 100)`
of the other's tokens each, which bounds how much of a text must be indexed:

* every rare token of the prefix is an index key by itself;
* frequent tokens are dealt into groups by their hash, and only pairs of prefix tokens of the same group
  are keys. A group with c prefix tokens that shares no pair has at least c - 1 errors.

The prefix is extended until its rare tokens, plus one less than each group's tokens, exceed `errors`.
Then two linked texts share a key, whatever the tokens are called frequent, as both use the same list:
it only decides how long the index's rows per key get.

A key that many texts share is not expanded into all their pairs. It names one of its texts as pivot and the
others are compared with it exactly; texts in the same component need no further comparison. When few pairs
are left between a key's components they are compared one by one, so no link that joins components is lost.

Before texts are fetched, a pair must pass its sketches. A sketch has a bit for each of 1024 cells, which says
whether the set has an odd number of tokens there, so two sets differ in no fewer tokens than their sketches in bits.
Pairs whose sketches differ in more bits than linked sets may in tokens are left out, without a loss.

Links inside a component are counted afterwards: its different texts are dealt into blocks, and every two blocks
are compared whole, so a text's number of links is exact and no pair is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm.components import components
from gridtally.llm.frequency import frequency_bitmaps, holds, id_bitmap
from gridtally.llm.hashing import mix, pieces, shingle_sets
from gridtally.llm.tokens import drop_encoders
from gridtally.session import materialize, passing_shuffles, release, text_batches

SHINGLE_WORDS = 5
PERCENT = 80
# Tokens in this many texts or more count as frequent.
FREQUENT = 16
# Set sizes at which the number of groups changes; sizes near a limit are indexed on both sides.
FIRST_TIER, TIER_FACTOR = 26, 16
STAR_ROUNDS = 6
# Pivots that link fewer than one in so many of their keys' texts are given up.
FEW_LINKS = 100
# Bits of a sketch, 64 to a word.
SKETCH_BITS = 1024
# Texts and bytes of a block whose links are counted at once, and tokens that are multiplied at a time.
BLOCK_TEXTS, BLOCK_BYTES, TOKENS = 256, 1 << 20, 4096

_SIGNATURE = "n_shingles long, set_a long, set_b long, sketch array<long>, keys array<long>"


def _tiers(n: int, percent: int) -> Iterator[int]:
    """Lower size limits of the tiers that a set of n tokens is indexed in; 0 has single tokens only."""
    low = 0
    high = FIRST_TIER
    while low * percent / 100 <= n:
        if n <= high * 100 / percent:
            yield low
        low, high = high, high * TIER_FACTOR


def index_keys(
    tokens: np.ndarray, frequent: np.ndarray, shared: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """The keys of one set: its prefix's rare tokens that occur elsewhere, and pairs of its frequent ones.

    `tokens` are the set's sorted hashes, `frequent` and `shared` say of each whether it is frequent and
    whether it occurs in another text.
    """
    n = len(tokens)
    if not n:
        return tokens
    needed = n - math.ceil(percent * n / 100) + 1
    rare = tokens[~frequent]
    keys = [rare[:needed][shared[~frequent][:needed]]]
    rest = needed - len(rare)
    if rest <= 0:
        return keys[0]
    often = tokens[frequent]
    for low in _tiers(n, percent):
        if not low:
            keys.append(often[:rest])
            continue
        groups = max(1, min(low // 2, math.floor(low * (percent / 100) ** 2) - 1))
        group = mix(often) % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        opens = np.ones(len(often), bool)
        opens[1:] = group[order][1:] != group[order][:-1]
        counts = np.ones(len(often), np.int64)
        counts[order[opens]] = 0
        used = int(np.searchsorted(np.cumsum(counts), rest)) + 1
        inside = order[order < used]
        size = np.unique(group[inside], return_counts=True)[1]
        # for every token its partners are the earlier ones of its group
        rank = np.arange(len(inside)) - np.repeat(np.cumsum(size) - size, size)
        second = np.repeat(np.arange(len(inside)), rank)
        first = second - 1 - (np.arange(len(second)) - np.repeat(np.cumsum(rank) - rank, rank))
        keys.append(mix(often[inside[first]] * np.uint64(3) + mix(often[inside[second]] + np.uint64(low))))
    return np.unique(np.concatenate(keys))


def signatures(
    docs: DataFrame, text: str, bitmaps: tuple[np.ndarray, np.ndarray], percent: int, words: int
) -> DataFrame:
    """Set size, set hash, sketch and index keys of every row, beside its id column `node`."""
    known = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        shared, often = known.value
        for batch in batches:
            for part in pieces(batch, text):
                sizes, first, second, sketches, keys, ends = [], [], [], [], [], [0]
                for tokens in shingle_sets(part.column(text), words):
                    found = index_keys(tokens, holds(often, tokens), holds(shared, tokens), percent)
                    sizes.append(len(tokens))
                    one, two = _set_hashes(tokens)
                    first.append(one)
                    second.append(two)
                    sketches.append(sketch(tokens))
                    keys.append(found)
                    ends.append(ends[-1] + len(found))
                flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node"),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(first, np.uint64).view(np.int64)),
                        pa.array(np.array(second, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sketches) + 1) * (SKETCH_BITS // 64), pa.int32()),
                            pa.array(np.concatenate(sketches) if sketches else np.zeros(0, np.int64)),
                        ),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64))),
                    ],
                    names=["node", "n_shingles", "set_a", "set_b", "sketch", "keys"],
                )

    return docs.select("node", text).mapInArrow(sign, f"node long, {_SIGNATURE}")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets overlap enough, by their whole texts; a written copy.

    Only texts that some pair names leave their place: the list of them is written first, so that its size
    on file tells the planner whether it is small enough to go to the texts.
    """
    ends = [materialize(pairs.select(F.col(c).alias("node")).distinct(), "ends") for c in ("a", "b")]
    left, right = (
        texts.join(end, "node", "left_semi").select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
        for c, end in zip(("a", "b"), ends)
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text_b"):
                for half in pieces(part, "text_a"):
                    seen: dict[int, np.ndarray] = {}
                    keep = []
                    a_ids, b_ids = half.column("a").to_pylist(), half.column("b").to_pylist()
                    for name, ids in (("text_a", a_ids), ("text_b", b_ids)):
                        places = [i for i, x in enumerate(ids) if (name, x) not in seen]
                        todo = list({ids[i]: i for i in places}.values())
                        for i, found in zip(todo, shingle_sets(half.column(name).take(pa.array(todo, pa.int64())), words)):
                            seen[name, ids[i]] = found
                    for a, b in zip(a_ids, b_ids):
                        x, y = seen["text_a", a], seen["text_b", b]
                        merged = np.concatenate((x, y))
                        merged.sort()
                        union = 1 + int((merged[1:] != merged[:-1]).sum()) if len(merged) else 0
                        keep.append(bool(len(x) and len(y) and 100 * (len(merged) - union) >= percent * union))
                    yield half.select(["a", "b"]).filter(pa.array(keep))

    compared = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    found = materialize(compared.mapInArrow(compare, "a long, b long"), "edges")
    release(*ends)
    return found


def _fits(x: str, y: str, percent: int):
    """Whether two set sizes allow the similarity at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Of each cell whether an odd number of the tokens lies in it, 64 cells to a word."""
    cells = np.bincount((tokens % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((cells & 1).astype(bool), bitorder="little").view(np.int64)


def _near(x: str, y: str, n_x: str, n_y: str, percent: int):
    """Whether two sketches allow the similarity; linked sets differ in (100 - p) / (100 + p) of their tokens at most."""
    words = (F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH_BITS // 64))
    return reduce(lambda a, b: a + b, words) * (100 + percent) <= (F.col(n_x) + F.col(n_y)) * (100 - percent)


def _pair(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _cross_pairs(postings: DataFrame) -> DataFrame:
    """Keys whose texts are in several components, with their texts and the pairs between components."""
    return (
        postings.groupBy("key", "component")
        .agg(F.count("*").alias("c"))
        .groupBy("key")
        .agg(F.sum("c").alias("texts"), F.sum(F.col("c") * F.col("c")).alias("same"))
        .select("key", "texts", ((F.col("texts") * F.col("texts") - F.col("same")) / 2).alias("pairs"))
        .filter("pairs > 0")
    )


def _link_texts(
    postings: DataFrame, texts: DataFrame, sketches: DataFrame, percent: int, words: int
) -> DataFrame | None:
    """Components over the texts of an index (key, node, n): (node, component), or None without links.

    A key with few pairs left between components is finished by comparing them all. The others compare
    their texts with one pivot, and come back in the next round with what is then left. After
    `STAR_ROUNDS` rounds, or when pivots hardly link any more texts, every key is finished. `sketches` has
    (node, sketch, n) of every text; only pairs that pass them are compared, and in the last round only these are rows.
    """
    labels = None
    edges, done = [], []
    open_ = postings.withColumn("component", F.col("node"))
    copy = None
    few = False
    for turn in range(STAR_ROUNDS + 1):
        keys = materialize(_cross_pairs(open_), "keys")
        all_ = few or turn == STAR_ROUNDS
        finish = F.lit(True) if all_ else F.col("pairs") <= 2 * F.col("texts")
        one = open_.join(keys.filter(finish).select("key"), "key")
        use = F.col("component") < F.col("component_2")
        if all_:
            one = one.join(sketches, ["node", "n"])
            use &= _near("sketch", "sketch_2", "n", "n_2", percent)
        other = one.select("key", *[F.col(c).alias(f"{c}_2") for c in one.columns if c != "key"])
        found = one.join(other, "key").filter(use & _fits("n", "n_2", percent)).select(*_pair("node", "node_2")).distinct()
        wide = open_.join(keys.filter(~finish).select("key"), "key")
        last = all_ or keys.filter(~finish).isEmpty()
        if not last:
            wide = materialize(wide, "wide")
            pivot = F.min_by(F.struct("node", "n", "component"), F.xxhash64(F.lit(turn), "node"))
            pivots = wide.groupBy("key").agg(pivot.alias("pivot"))
            star = wide.join(pivots, "key").filter(
                (F.col("component") != F.col("pivot.component")) & _fits("n", "pivot.n", percent)
            )
            found = found.unionByName(star.select(*_pair("node", "pivot.node"))).distinct()
        if done:
            found = found.join(reduce(DataFrame.unionByName, done), ["a", "b"], "left_anti")
        sides = [sketches.select(*[F.col(c).alias(f"{c}_{e}") for c in sketches.columns]) for e in ("a", "b")]
        for e, side in zip(("a", "b"), sides):
            found = found.join(side.withColumnRenamed(f"node_{e}", e), e)
        near = _near("sketch_a", "sketch_b", "n_a", "n_b", percent)
        tried = materialize(found.filter(near).select("a", "b").distinct(), "tried")
        done.append(tried)
        new = _verified(tried, texts, percent, words)
        edges.append(new)
        if not new.isEmpty():
            labels = components(reduce(DataFrame.unionByName, edges))
        release(keys, *([copy] if copy is not None else []))
        if last:
            break
        few = new.count() * FEW_LINKS < wide.count()
        open_ = wide
        if labels is not None:
            open_ = wide.drop("component").join(labels, "node", "left")
            open_ = open_.withColumn("component", F.coalesce("component", "node"))
        copy = open_ = materialize(open_, "open")
        release(wide)
    # the components are a copy of their own
    release(*done, *edges)
    return labels


def _set_hashes(tokens: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two hashes of a whole set."""
    return tokens.sum(dtype=np.uint64), mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)


def links_between(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each two of the sets (sorted tokens) are linked, by products of their 0-1 rows."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    # a token of one set alone is in no intersection
    several = uses > 1
    row, column = row[several[column]], (np.cumsum(several) - 1)[column][several[column]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    inner = np.zeros((len(sets), len(sets)), np.int64)
    for low in range(0, int(several.sum()), TOKENS):
        a, b = np.searchsorted(column, (low, low + TOKENS))
        ones = np.zeros((len(sets), TOKENS), np.float32)
        ones[row[a:b], column[a:b] - low] = 1
        inner += (ones @ ones.T).astype(np.int64)
    linked = (100 * inner >= percent * (sizes[:, None] + sizes[None, :] - inner)) & (inner > 0)
    np.fill_diagonal(linked, False)
    return linked


def _link_counts(labels: DataFrame, classes: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Every class of a component with its number of linked classes: (set_a, set_b, n_shingles, n_links)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = list(shingle_sets(part.column("text"), words))
                hashes = np.array([_set_hashes(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, sizes, pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy())],
                    names=["node", "text", "component", "n_shingles", "set_a", "set_b"],
                )

    identity = ["set_a", "set_b", "n_shingles"]
    signed = texts.join(labels, "node").select("node", "text", "component").mapInArrow(
        sign, "node long, text string, component long, n_shingles long, set_a long, set_b long"
    )
    one_each = signed.join(classes.withColumnRenamed("class_id", "node"), [*identity, "node"], "left_semi")
    one_each = materialize(one_each.dropDuplicates(identity), "grouped")
    blocks = one_each.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    dealt = (
        one_each.join(blocks, "component")
        .withColumn("block", F.pmod(F.xxhash64(*identity), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", *identity, "text")
    )

    def count(rows: pa.Table) -> pa.Table:
        sets = [s for batch in rows.to_batches() for part in pieces(batch, "text") for s in shingle_sets(part.column("text"), words)]
        linked = links_between(sets, percent)
        node, block = rows.column("node").to_numpy(), rows.column("block").to_numpy()
        linked &= node[:, None] != node[None, :]
        if rows.column("one")[0] != rows.column("two")[0]:
            linked &= block[:, None] != block[None, :]
        return rows.select(identity).append_column("n_links", pa.array(linked.sum(axis=1).astype(np.int64)))

    counted = dealt.groupBy("component", "one", "two").applyInArrow(
        count, "set_a long, set_b long, n_shingles long, n_links long"
    )
    return counted.groupBy(*identity).agg(F.sum("n_links").alias("n_links"))


def jaccard_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    words: int = SHINGLE_WORDS,
    frequent: int = FREQUENT,
    links: bool = True,
) -> DataFrame:
    """Every row's id with `n_shingles`, `class_id`, `component_id` and, with `links`, `n_links`.

    Texts are cut into words at ASCII white space, A-Z in lower case. A text's set holds its distinct runs
    of `words` words; a shorter text's whole sequence is its only element; a text that is null, empty or
    without words has an empty set (`n_shingles` 0) and no links. Two texts link when
    100 * intersection >= percent * union. `class_id` is the least id with exactly the same set,
    `component_id` the least id that links lead to, the row's own included. `n_links` is the number of different
    sets that the row's set links to; sets of the same class id, that is of one document, do not count.

    Ids are whole numbers. Rows that share an id count as one document and pool their links; each gets
    its row. A row without an id gets its set size and null for the rest. An empty table gives an
    empty result. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text_batches(spark)
    source = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    with passing_shuffles(spark):
        found = _components(spark, source, percent, words, frequent, links)
    return found.withColumnRenamed("node", doc_id)


def _components(
    spark: SparkSession, source: DataFrame, percent: int, words: int, frequent: int, links: bool
) -> DataFrame:
    """`jaccard_components` of rows (node, text)."""
    rows = source.count()

    def sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in pieces(batch, "text"):
            yield from shingle_sets(part.column("text"), words)

    bitmaps = frequency_bitmaps(source.select("text"), sets, rows, frequent)
    signed = materialize(signatures(source, "text", bitmaps, percent, words), "signatures")
    classes = (
        signed.filter("n_shingles > 0 and node is not null")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("node").alias("class_id"))
    )
    members = signed.drop("keys", "sketch").join(classes, ["set_a", "set_b", "n_shingles"], "left")
    one_each = (
        signed.join(
            classes.select("set_a", "set_b", "n_shingles", F.col("class_id").alias("node")),
            ["set_a", "set_b", "n_shingles", "node"],
            "left_semi",
        )
        .select(F.explode("keys").alias("key"), "node", F.col("n_shingles").alias("n"))
        .distinct()
    )
    # keys of the very same texts lead to the same pairs: one of them is enough
    of_key = one_each.groupBy("key").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")
    )
    several = of_key.filter("c > 1").groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key")
    postings = materialize(one_each.join(several, "key"), "postings")

    sieve = spark.sparkContext.broadcast(id_bitmap(postings, "node"))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sieve.value
        for batch in batches:
            hashed = batch.column("cell").to_numpy().view(np.uint64)
            yield batch.select(["node", "text"]).filter(pa.array(holds(bits, hashed)))

    texts = materialize(
        source.filter("node is not null")
        .withColumn("cell", F.xxhash64("node"))
        .mapInArrow(sift, "node long, text string"),
        "texts",
    )
    # rows that share an id are one node: each of its sketches may let a pair pass
    sketches = materialize(
        signed.join(postings.select("node").distinct(), "node", "left_semi")
        .select("node", "sketch", F.col("n_shingles").alias("n"))
        .distinct(),
        "sketches",
    )
    labels = _link_texts(postings, texts, sketches, percent, words)
    own = F.coalesce("class_id", "node")
    component = own
    if labels is not None:
        members = members.join(labels.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
        component = F.coalesce("component", "class_id", "node")
        if links:
            counts = _link_counts(labels, classes, texts, percent, words)
            members = members.join(counts, ["set_a", "set_b", "n_shingles"], "left")
    # what is still read are the signatures, the components and the texts of linked classes, all copies
    release(postings, sketches, texts)
    known = F.col("node").isNotNull()
    n_links = F.coalesce("n_links", F.lit(0)) if labels is not None and links else F.lit(0)
    return members.select(
        "node",
        "n_shingles",
        F.when(known, component).alias("component_id"),
        F.when(known, own).alias("class_id"),
        *([F.when(known, n_links.cast("long")).alias("n_links")] if links else []),
    )
