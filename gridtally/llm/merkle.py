"""Merkle-tree fingerprints of texts, in SQL functions only.

Leaves are pieces of text up to a line's end, a mark of punctuation, or a word that ends in one of a few letters;
a piece that is still long is cut further, at words and within long words at characters that are chosen by
a hash, so that an edit moves no cut far away, and wherever that leaves too much, as in periodic text, at a
fixed length. A paragraph is a line; a paragraph whose hash is a multiple of four ends a section, so an edit
moves no other section's limits. A fingerprint reads `root|section;section;…`, a section
`hash#leaf.leaf,leaf`, with `,` between paragraphs; the root is a hash of the paragraphs' hashes, which are
of full length. Equal roots mean equal texts; where roots differ, sections whose hash the other tree lacks
hold the edits, and in them the leaves that it lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import materialize

SECTION = 4
# Pieces of more than MOST characters are cut after one word in WORDS, words of more than LONG after one character in CHARACTERS.
LONG, WORDS, CHARACTERS = 64, 4, 32
# Characters of a leaf at most, white space and marks of punctuation included.
MOST = 256
# Where leaves end: after a mark and a space, after a full-width mark, and after about one word in six. All of these
# end in the characters that are looked for first, so most places take one look.
ENDS = r"(?<=[\s。！？，、；：])(?:(?<=[.!?,;:|] )|(?<=[。！？，、；：])|(?<=[agiouyzéíóñüß0-4%$]\s))"


def _digits(value: Column) -> Column:
    """Eight hex digits, in capitals."""
    return F.right(F.hex(F.xxhash64(value).bitwiseOR(F.lit(-(1 << 63)))), F.lit(8))


def _digest(value: Column) -> Column:
    """Eight hex digits."""
    return F.lower(_digits(value))


def _bounded(piece: Column) -> Column:
    """The parts that a long piece is cut into; a cut is a zero character, which stays with its part."""

    def cut_one_in(n: int, *hashed: Column) -> Column:
        return F.when(F.pmod(F.xxhash64(*hashed), F.lit(n)) == 0, "\0").otherwise("")

    def cut_inside(word: Column) -> Column:
        # a list of one list, so that the word is taken apart once
        return F.array_join(
            F.flatten(
                F.transform(
                    F.array(F.split(word, "")),
                    lambda s: F.transform(s, lambda c, i: F.concat(c, cut_one_in(CHARACTERS, c, F.get(s, i - 1)))),
                )
            ),
            "",
        )

    words = F.transform(
        F.split(piece, r"(?<=\s)"),
        lambda w: F.concat(F.when(F.length(w) > LONG, cut_inside(w)).otherwise(w), cut_one_in(WORDS, w)),
    )
    marked = F.regexp_replace(F.array_join(words, ""), rf"([^\x00]{{{MOST}}})(?=[^\x00])", "$1\0")
    return F.split(marked, r"(?<=\x00)(?=[\s\S])")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text, null counting as empty."""

    def paragraph(line: Column) -> Column:
        leaves = F.array_join(
            F.transform(
                F.split(line, ENDS),
                lambda p: F.when(F.length(p) > MOST, F.array_join(F.transform(_bounded(p), _digits), ".")).otherwise(_digits(p)),
            ),
            ".",
        )
        # a list of one, so that the leaves are found once
        return F.transform(
            F.array(F.lower(leaves)),
            lambda x: F.concat(x, F.when(F.pmod(F.xxhash64(x), F.lit(SECTION)) == 0, ";").otherwise(",")),
        )[0]

    def tree(lines: Column) -> Column:
        body = F.array_join(F.transform(lines, paragraph), "")
        sections = F.split(F.regexp_replace(body, "[,;]$", ""), ";")
        branches = F.array_join(F.transform(sections, lambda s: F.concat(_digest(s), F.lit("#"), s)), ";")
        trunk = F.md5(F.array_join(F.transform(lines, lambda line: F.md5(line)), ""))
        return F.concat(trunk, F.lit("|"), branches)

    # the same for the lines
    return F.transform(F.array(F.split(F.coalesce(text, F.lit("")), r"(?<=\n)")), tree)[0]


def root(print_: Column) -> Column:
    return F.substring_index(print_, "|", 1)


def sections(print_: Column) -> Column:
    return F.split(F.substring(print_, 34, 1 << 30), ";")


def leaves(print_: Column) -> Column:
    """All leaf hashes, in order."""
    return F.flatten(F.transform(sections(print_), lambda s: F.split(F.translate(F.substring(s, 10, 1 << 30), ",", "."), r"\.")))


def likeness(one: Column, other: Column) -> Column:
    """Share of distinct leaves that two fingerprints have in common, 1 for equal roots."""
    return _alike(root(one) == root(other), F.array_distinct(leaves(one)), F.array_distinct(leaves(other)))


def _alike(equal: Column, a: Column, b: Column) -> Column:
    """Likeness by distinct leaves."""
    common = F.size(F.array_intersect(a, b))
    return F.when(equal, F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def edits(one: Column, other: Column) -> Column:
    """Where the first text differs: sections that hold leaves the other lacks, each with its place from 0
    and the places of these leaves, from 0 in the section. Equal roots: none. Leaves that only the other
    has are found the other way round."""
    theirs = leaves(other)
    branch = F.transform(sections(one), lambda s, i: F.struct(i.alias("section"), s.alias("branch")))
    differing = F.filter(branch, lambda b: ~F.array_contains(sections(other), b["branch"]))
    found = F.transform(
        differing,
        lambda b: F.struct(
            b["section"].alias("section"),
            F.filter(
                F.transform(
                    F.split(F.substring_index(b["branch"], "#", -1), "[.,]"),
                    lambda x, i: F.when(~F.array_contains(theirs, x), i),
                ),
                lambda x: x.isNotNull(),
            ).alias("leaves"),
        ),
    )
    # an edit may open or close a section beside it, in which nothing else differs
    found = F.filter(found, lambda s: F.size(s["leaves"]) > 0)
    return F.when(root(one) == root(other), F.slice(found, 1, 0)).otherwise(found)


def _successors(docs: DataFrame) -> DataFrame:
    """(id, key, next_id, next_key) in ascending order, the last followed by the first.

    Ids are sorted by range and written once; a row's number is its place in its partition and the sizes
    of the partitions before, so no task sees all rows.
    """
    rows = docs.groupBy("id", "key").agg(F.count("*").alias("copies")).drop("copies")
    placed = rows.repartitionByRange("id", "key").sortWithinPartitions("id", "key")
    placed = placed.select("id", "key", F.monotonically_increasing_id().alias("at"))
    placed = materialize(
        placed.select("id", "key", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at")),
        "order",
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all"))
    numbered = placed.join(sizes, "part").select(
        "id", "key", (F.col("before") + F.col("at")).alias("place"), F.col("all")
    )
    following = numbered.select(
        F.col("id").alias("next_id"),
        F.col("key").alias("next_key"),
        F.pmod(F.col("place") - 1, F.col("all")).alias("place"),
    )
    return numbered.drop("all").join(following, "place").drop("place")


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of an edited text, and their likeness.

    The edited text has the last floor(n/4) of a text's n code points replaced by the first as many, or
    all, of the next document by ascending id; after the last comes the first. Returns the id, `n_chars`,
    `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited` and `near_next`, the likeness to
    the edited text's and the next document's fingerprint.

    Null texts are empty. Rows without an id come first. Rows that share an id are ordered by a hash of
    their texts; equal rows count once in the order and all come back. A single document follows itself.
    Other columns are ignored; an empty table gives no rows. `next_id` is the id of the next document.

    Both joins deal the same columns of the documents out by the same key, so texts are shuffled once.
    """
    base = docs.select(
        F.col(doc_id).alias("given"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    base = base.select("given", "id", "text", F.xxhash64("given", "text").alias("key"))
    order = _successors(base.select("id", "key"))
    whole = base.withColumn("quarter", F.floor(F.length("text") / 4).cast("int"))
    asks = order.select(
        F.col("next_id").alias("id"), F.col("next_key").alias("key"), F.col("id").alias("for_id"), F.col("key").alias("for_key")
    )
    lengths = whole.select("id", "key", "quarter").distinct()
    asks = asks.join(
        lengths.select(F.col("id").alias("for_id"), F.col("key").alias("for_key"), "quarter"), ["for_id", "for_key"]
    )
    heads = (
        base.join(asks, ["id", "key"])
        .select(
            F.col("for_id").alias("id"),
            F.col("for_key").alias("key"),
            F.col("given").alias("next_id"),
            F.expr("substring(text, 1, quarter)").alias("head"),
            fingerprint(F.col("text")).alias("next_fingerprint"),
        )
        .dropDuplicates(["id", "key"])
    )
    edited = F.expr("concat(substring(text, 1, length(text) - cast(floor(length(text) / 4) as int)), head)")
    own = base.join(heads, ["id", "key"]).select(
        "given",
        F.length("text").cast("long").alias("n_chars"),
        "text",
        edited.alias("edited"),
        "next_fingerprint",
        "next_id",
    )
    prints = own.select(
        "given",
        "n_chars",
        "next_id",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    # each text's leaves are taken from its fingerprint once
    kinds = {c: f"{c}_leaves" for c in ("fingerprint", "edited_fingerprint", "next_fingerprint")}
    listed = prints.withColumns({name: F.array_distinct(leaves(F.col(c))) for c, name in kinds.items()})

    def near(other: str) -> Column:
        return _alike(root(F.col("fingerprint")) == root(F.col(other)), F.col(kinds["fingerprint"]), F.col(kinds[other]))

    return listed.select(
        F.col("given").alias(doc_id),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        near("edited_fingerprint").alias("near_edited"),
        near("next_fingerprint").alias("near_next"),
        "next_id",
    )
