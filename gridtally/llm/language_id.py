"""Language of a text by its words, and for words never seen by their character n-grams.

A known word scores its log frequency in each language. An unknown word backs off: to its 4-grams that
are known, without any to its 3-grams, and so on down to single letters. Texts are split into words and
equal words of a batch scored once, in Arrow.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.hashing import pieces
from gridtally.llm.tokens import drop_encoders
from gridtally.session import text_batches

UNDETERMINED = "und"
# Bounds of the model: labelled texts that are read for a language, and entries kept for it.
TEXTS = 1000
WORDS = 20_000
GRAMS = 5_000
LONGEST = 4
# Occurrences that make a word known.
LEAST = 3
# The share of probability below which a prediction is rejected.
LEAST_SCORE = 0.5
PIECE = 1 << 22


@dataclass
class LanguageModel:
    """Log frequencies by language: `tables[0]` of words, `tables[n]` of n-grams, rows by `languages`."""

    languages: list[str]
    tables: list[dict[str, np.ndarray]]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters in lower case, and the row that each stands in."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+")
    words, rows = lists.flatten(), pc.list_parent_indices(lists)
    filled = pc.greater(pc.binary_length(words), 0)
    return words.filter(filled), rows.filter(filled).to_numpy()


def _grams(word: str, n: int) -> list[str]:
    """n-grams of a word between its limits; single letters without them."""
    if n == 1:
        return list(word)
    framed = f" {word} "
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


def learnable(doc_id: str = "doc_id") -> Column:
    """Whether a document may be learned from: crc32 of its id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(False))


def fit_languages(
    docs: DataFrame, text: str = "text", lang: str = "lang", texts: int = TEXTS, words: int = WORDS, grams: int = GRAMS
) -> LanguageModel:
    """Count words and n-grams in about `texts` labelled texts per language, drawn by a hash of the text.

    Rows without text or language are not learned from. The model holds, whatever the input's size, the
    `words` most frequent words and `grams` most frequent n-grams of each length and language, and all
    that any language keeps is counted for every language.
    """
    named = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    per_language = {r.lang: r.n for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(per_language)
    if not languages:
        return LanguageModel([], [{} for _ in range(LONGEST + 1)])
    share = F.create_map(
        *[F.lit(x) for name, n in per_language.items() for x in (name, min(1.0, texts / n))]
    )
    drawn = named.filter(
        F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * float(1 << 30)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {name: Counter() for name in languages}
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                flat, rows = _words(part.column("text"))
                names = np.array(part.column("lang").to_pylist(), object)[rows]
                for name in set(names.tolist()):
                    counted = pc.value_counts(flat.filter(pa.array(names == name)))
                    found[name].update(
                        dict(zip(counted.field("values").to_pylist(), counted.field("counts").to_pylist()))
                    )
        for name, words in found.items():
            times = np.fromiter(words.values(), np.int64, len(words))
            for size in range(LONGEST + 1):
                grams = [_grams(w, size) if size else [w] for w in words]
                coded = pa.array([g for gs in grams for g in gs], pa.string()).dictionary_encode()
                n = np.bincount(
                    coded.indices.to_numpy(), np.repeat(times, [len(gs) for gs in grams]), len(coded.dictionary)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(n), pa.string()),
                        pa.array(np.full(len(n), size, np.int32)),
                        coded.dictionary,
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["lang", "size", "entry", "n"],
                )

    counts = (
        drawn.mapInArrow(count, "lang string, size int, entry string, n long")
        .groupBy("lang", "size", "entry")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("size") > 0) | (F.col("n") >= LEAST))
    )
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.col("n").desc(), "entry"))
    kept = counts.withColumn("place", place).filter(
        F.col("place") <= F.when(F.col("size") == 0, words).otherwise(grams)
    )
    rows = kept.select("lang", "size", "entry", "n").toArrow().to_pylist()
    tables: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST + 1)]
    column = {name: i for i, name in enumerate(languages)}
    for r in rows:
        table = tables[r["size"]]
        if r["entry"] not in table:
            table[r["entry"]] = np.zeros(len(languages))
        table[r["entry"]][column[r["lang"]]] = r["n"]
    for size, table in enumerate(tables):
        if not table:
            continue
        total = np.sum(list(table.values()), axis=0)
        base = np.log(total + 0.5 * len(table))
        tables[size] = {k: np.log(v + 0.5) - base for k, v in table.items()}
    return LanguageModel(languages, tables)


def _score(word: str, tables: list[dict[str, np.ndarray]], none: np.ndarray) -> np.ndarray:
    """Log frequencies of a word, or the mean of its longest known n-grams'."""
    found = tables[0].get(word)
    if found is not None:
        return found
    for n in range(LONGEST, 0, -1):
        table = tables[n]
        known = [table[g] for g in _grams(word, n) if g in table]
        if known:
            return sum(known) / len(known)
    return none


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the predicted language and its share of the probability, judged on the whole text.

    A text that is null or has no letter is `und` with score 0, as is every text where nothing was learned.
    Ties go to the first language by name. Columns named like the new ones are replaced.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (pred.lower(), score.lower())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        languages, tables = shared.value.languages, shared.value.tables
        none = np.zeros(len(languages))
        names = np.array([*languages, UNDETERMINED], object)
        for batch in batches:
            for part in pieces(batch, text, PIECE):
                words, rows = _words(part.column(text))
                total = np.zeros((part.num_rows, len(languages)))
                if len(words) and languages:
                    coded = words.dictionary_encode()
                    scores = np.stack([_score(w, tables, none) for w in coded.dictionary.to_pylist()])
                    codes = coded.indices.to_numpy()
                    for i in range(len(languages)):
                        total[:, i] = np.bincount(rows, scores[codes, i], part.num_rows)
                known = np.bincount(rows, minlength=part.num_rows) > 0
                if languages:
                    best = np.where(known, total.argmax(axis=1), len(languages))
                    likely = np.exp(total - total.max(axis=1, keepdims=True))
                    share = np.where(known, 1.0 / likely.sum(axis=1), 0.0)
                else:
                    best, share = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names[best], pa.string()), pa.array(share)], names=[*part.schema.names, pred, score]
                )

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + f", `{pred}` string, `{score}` double"
    return docs.mapInArrow(predict, schema)


def accepted(pred: str = "lang_pred", score: str = "score", least: float = LEAST_SCORE) -> Column:
    """Whether a prediction names a language, by at least that share of the probability."""
    return (F.col(pred) != UNDETERMINED) & (F.col(score) >= least) & ~F.isnan(score)
