"""Language identification with a language-bitmask n-gram filter.

One Bloom filter serves all languages: its cells are bit masks with one bit a language, stored as bit slices of eight
languages each.  A look-up ANDs the cells of an n-gram's hashes and returns all languages that contain it.  The bits
are counted for each language over a text, corrected for the filter's false positives, and decide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotlens.llm.spans import LOWER, WORDS, mix, per_text, slices, tidy
from lotlens.runtime import cut

#: Documents the filter learns from, at most about.
MAX_TRAIN_DOCS = 20_000
#: Documents of each language that it learns from at least, if there are so many, about.
MIN_TRAIN_DOCS = 500
#: Values of the language column that are learned at most, those with the most documents: a bound of the filter's width.
MAX_LANGUAGES = 256
#: Share of a language's n-grams that one must reach; no language can then have more than 1 / MIN_RATE of them.
MIN_RATE = 1e-5
GRAM = 4
#: An n-gram belongs to a language if it is at least this frequent there, compared with where it is most frequent.
NEAR_BEST = 0.5
HASHES, CELLS_PER_GRAM = 2, 16
UNKNOWN = "und"


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The GRAM bytes at each position, lower-cased, gaps and marks as one blank; 0 where they leave the text or start in two blanks."""
    n = len(data)
    if n < GRAM:
        return np.zeros(n, np.uint32)
    plain = np.where(WORDS[data] == 1, LOWER[data], np.uint8(32)).astype(np.uint8)
    out = np.zeros(n, np.uint32)
    m = n - GRAM + 1
    for k in range(GRAM):
        out[:m] |= plain[k : k + m].astype(np.uint32) << np.uint32(8 * k)
    dull = (plain[:-1] == 32) & (plain[1:] == 32)
    out[:-1][dull] = 0
    for k in range(1, GRAM):
        ends = offsets[1:] - k
        out[ends[ends >= offsets[:-1]]] = 0
    return out


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with blanks behind those of fewer than GRAM bytes, so that each text but an empty one has a position for an n-gram."""
    size = np.diff(offsets)
    lack = np.where(size > 0, np.maximum(GRAM - size, 0), 0)
    if not lack.any():
        return data, offsets
    return np.insert(data, np.repeat(offsets[1:], lack), 32), offsets + np.concatenate([[0], np.cumsum(lack)])


class LanguageFilter:
    """Bit-sliced Bloom filter over (n-gram, language)."""

    def __init__(self, learned: dict[str, np.ndarray], prior: str | None):
        self.languages, self.prior = sorted(learned), prior
        most = max([len(g) for g in learned.values()] or [1])
        self.cells = 1 << max(12, int(most * CELLS_PER_GRAM - 1).bit_length())
        self.slices = [np.zeros(self.cells, np.uint8) for _ in range(-(-len(self.languages) // 8))]
        for k, name in enumerate(self.languages):
            for at in self._places(learned[name].astype(np.uint64)):
                self.slices[k // 8][at] |= np.uint8(1 << (k % 8))
        fill = [float(np.mean((self.slices[k // 8] >> (k % 8)) & 1)) for k in range(len(self.languages))]
        self.false_rate = np.array([f**HASHES for f in fill])

    def _places(self, gram: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(gram)
        mask = np.uint64(self.cells - 1)
        for k in range(HASHES):
            yield ((h >> np.uint64(32 * k)) & mask).astype(np.int64)

    def masks(self, gram: np.ndarray) -> list[np.ndarray]:
        """For each slice the languages that contain each n-gram, as bits."""
        places = list(self._places(gram.astype(np.uint64)))
        out = []
        for cells in self.slices:
            found = cells[places[0]]
            for at in places[1:]:
                found = found & cells[at]
            out.append(found)
        return out

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the likeliest language of each text, -1 without evidence, and its share of the corrected counts."""
        data, offsets = padded(data, offsets)
        gram = grams(data, offsets)
        real = gram != 0
        counted = per_text(real.astype(np.uint8), offsets, np.add, 0)
        scores = np.zeros((len(offsets) - 1, len(self.languages)))
        masks = self.masks(gram)
        for k in range(len(self.languages)):
            hits = ((masks[k // 8] >> np.uint8(k % 8)) & 1) & real
            share = per_text(hits, offsets, np.add, 0) / np.maximum(counted, 1)
            scores[:, k] = np.clip((share - self.false_rate[k]) / max(1e-9, 1 - self.false_rate[k]), 0, 1)
        if not self.languages:
            return np.full(len(scores), -1), np.zeros(len(scores))
        best = scores.argmax(1)
        total = scores.sum(1)
        top = scores[np.arange(len(scores)), best]
        return np.where(total > 0, best, -1), np.where(total > 0, top / np.where(total > 0, total, 1), 0.0)


def has_letter(text: str | None) -> bool:
    return bool(text) and (any(c.isalpha() for c in text[:64]) or any(map(str.isalpha, text)))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for a, b, data, offsets in slices(batch.column("text")):
            data, offsets = padded(data, offsets)
            gram = grams(data, offsets)
            of = np.repeat(np.arange(b - a), np.diff(offsets))
            for name in set(langs[a:b]):
                own, n = np.unique(gram[(langs[a:b] == name)[of] & (gram != 0)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(own), pa.string()), pa.array(own.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        tidy()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS) -> LanguageFilter:
    """A filter from rows with known languages: about ``max_docs`` of them, chosen by a hash of the id, whole texts.

    A language has the share of the rows that it has in all, but about MIN_TRAIN_DOCS rows (or all) if that is less.  Rows whose text or language is null teach nothing, and
    of more than MAX_LANGUAGES values those with the fewest rows are not learned.  A language keeps the n-grams with a share of MIN_RATE or more that
    are not much more frequent elsewhere, so the model is bounded whatever the corpus.
    """
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    per_lang = rows.groupBy("lang").count()
    n = per_lang.agg(F.sum("count")).first()[0] or 0
    docs_in = {r["lang"]: r["count"] for r in per_lang.orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()}
    share = max_docs / n if n else 1.0
    spark = labelled.sparkSession
    shares = spark.createDataFrame([(name, min(1 << 30, max(int(share * (1 << 30)), -(-(MIN_TRAIN_DOCS << 30) // own)))) for name, own in docs_in.items()], "lang string, most long")
    rows = rows.join(F.broadcast(shares), "lang")  # MAX_LANGUAGES rows at most
    if n > max_docs:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("most"))
    counts = cut(rows.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    totals = spark.createDataFrame(list(total.items()), "lang string, total long")
    rated = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total")).withColumn("best", F.max("rate").over(Window.partitionBy("gram")))
    kept = rated.where((F.col("rate") >= NEAR_BEST * F.col("best")) & (F.col("rate") >= MIN_RATE) & (F.col("n") >= 2))
    found = kept.select("lang", "gram").toArrow()  # 1 / MIN_RATE rows a language at most
    langs, gram = np.array(found["lang"].to_pylist(), object), found["gram"].to_numpy().astype(np.uint64)
    prior = min(docs_in, key=lambda k: (-docs_in[k], k)) if docs_in else None
    return LanguageFilter({name: np.sort(gram[langs == name]) for name in docs_in}, prior)


def verdict(model: LanguageFilter, docs: DataFrame, text: Column) -> Column:
    """struct<lang string, score double> for a text column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang string, score double>")
    def judge(texts: pa.Array) -> pa.Array:
        own, langs, scores = sent.value, [], []
        names = [*own.languages, own.prior or UNKNOWN]  # -1: no evidence, the commonest language
        for a, b, data, offsets in slices(texts):
            best, score = own.judge(data, offsets)
            for t, k, s in zip(texts[a:b], best.tolist(), score.tolist(), strict=True):
                spoken = has_letter(t.as_py())
                langs.append(names[k] if spoken else UNKNOWN)
                scores.append(s if spoken else 0.0)
        tidy()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return judge(text)


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (replaced if there).

    score is the share of the chosen language in the corrected counts of all; ties go to the first name.  A text that
    is null or has no letter is ``und`` with score 0; one with letters but no known n-gram gets the commonest language
    with score 0, or ``und`` if nothing was learned.  Rows and other columns stay as they are.
    """
    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    found = docs.select(*[F.col(f"`{c}`") for c in own], verdict(model, docs, F.col(text)).alias("lang_pred"))  # ``own`` has no such column
    return found.select(*[F.col(f"`{c}`") for c in own], F.col("lang_pred.lang").alias("lang_pred"), F.col("lang_pred.score").alias("score"))


def keep_known(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """The rows of docs that identify() gives a language: all but ``und``; columns as they are.

    A text with letters but no known n-gram stays, as what it holds may only be missing from what was learned.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # columns may have any names
    found = docs.select(row.alias("row"), verdict(model, docs, F.col(text)).alias("found"))
    return found.where(F.col("found.lang") != UNKNOWN).select("row.*")
