"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words are hashed to rows of an embedding; filters of several widths slide over them, the largest answer of each filter
over a text goes to a logistic output.  Thresholds are calibrated for each language on training rows kept from the model.
Many labels are learned from in their tasks: a first model is taken over all of them once, and what the tasks learn is averaged.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.llm.quality import labelled, sample
from lotlens.llm.spans import WORDS, mix, per_text, runs, slices, token_hashes

#: Up to so many labelled documents are learned from in one place; of more, about so many give the first values of the weights, and then all
#: of them change these.  STEP_WORDS: the words that one step reads, at most about.
MAX_TRAIN_DOCS = 8_000
#: Tasks whose weights are averaged, at most; each sends some 2 MB.
MAX_TASKS = 32
STEP_WORDS = 24_000
#: A piece counts if this many training texts hold it.
MIN_DOCS = 8
#: One training text in so many, chosen by its checksum, is kept from the model and calibrates the thresholds.
APART = 8
BITS, WIDTH, FILTERS, SPANS, PIECES = 16, 8, 8, (1, 2, 3), 4
_STEPS, _RATE, _DECAY = 600, 0.02, 2e-3
#: The rate of the steps over all labels, which falls with their number in a task.
_LATER_RATE, _FALL = 0.004, 200


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embedding rows of each word's pieces (row 0 is padding) and the index of each text's first word.

    The pieces are the word itself, its first four and seven bytes and its last four; a word's vector is their sum.
    """
    start, end, first = runs(data, offsets, WORDS)
    spans = [(start, end), (start, np.minimum(start + 4, end)), (start, np.minimum(start + 7, end)), (np.maximum(end - 4, start), end)]
    rows = np.empty((len(start), PIECES), np.int32)
    for k, (a, b) in enumerate(spans):
        salted = mix(token_hashes(data, a, b) + np.uint64(k))
        rows[:, k] = np.maximum((salted >> np.uint64(64 - BITS)).astype(np.int32), 1)
    return rows, first


class ToxicityModel:
    """Embedding E, filters F[w] of shape (w, WIDTH, FILTERS) with biases, and a logistic output."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p = {"E": rng.normal(0, 0.2, (1 << BITS, WIDTH)).astype(np.float32)}
        for w in SPANS:
            self.p[f"F{w}"] = rng.normal(0, 0.5 / np.sqrt(w), (w, WIDTH, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["v"] = rng.normal(0, 0.3, len(SPANS) * FILTERS).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)
        self.thresholds: dict[str | None, float] = {}

    def know(self, rows: np.ndarray) -> None:
        """Only these rows of the embedding count; a piece that few training texts hold says nothing."""
        self.known = np.zeros(1 << BITS, bool)
        self.known[rows] = True
        self.known[0] = False
        self.p["E"][~self.known] = 0

    def _vectors(self, ids: np.ndarray) -> np.ndarray:
        out = self.p["E"][ids[:, 0]]
        for k in range(1, PIECES):
            out += self.p["E"][ids[:, k]]
        return out

    def _answers(self, vectors: np.ndarray, first: np.ndarray, w: int) -> np.ndarray:
        """What the filters of width w say at each word; windows may reach past a text's end into padding."""
        answer = vectors @ self.p[f"F{w}"][0] + self.p[f"b{w}"]
        left = np.repeat(first[1:], np.diff(first)) - np.arange(len(vectors))  # words from here to the end of the text
        for k in range(1, w):
            then = vectors[k:] @ self.p[f"F{w}"][k]
            then[left[:-k] <= k] = 0
            answer[:-k] += then
        return answer

    def _pooled(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The largest answer of each filter over each text, at least 0."""
        vectors = self._vectors(ids)
        best = [per_text(self._answers(vectors, first, w), first, np.maximum, 0) for w in SPANS]
        return np.maximum(np.concatenate(best, 1), 0)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        ids, first = words(data, offsets)
        logit = self._pooled(ids, first).astype(np.float64) @ self.p["v"].astype(np.float64) + float(self.p["c"][0])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def gradients(self, ids: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, tuple]:
        """Gradients of the weighted log loss; only the window that won a filter's maximum gets a share."""
        n, out, states, pooled = len(first) - 1, {}, [], []
        full = np.flatnonzero(first[1:] > first[:-1])
        vectors = self._vectors(ids)
        for w in SPANS:
            answer = self._answers(vectors, first, w)
            top, where = np.zeros((n, FILTERS), np.float32), np.zeros((n, FILTERS), np.int64)
            best = np.maximum.reduceat(answer, first[:-1][full], axis=0)
            spot = np.where(answer == np.repeat(best, np.diff(first)[full], axis=0), np.arange(len(ids))[:, None], len(ids))
            where[full] = np.minimum.reduceat(spot, first[:-1][full], axis=0)
            top[full] = np.maximum(best, 0)
            pooled.append(top)
            states.append((where, top > 0))
        hidden = np.concatenate(pooled, 1)
        chance = 1 / (1 + np.exp(-np.clip(hidden @ self.p["v"] + self.p["c"][0], -30, 30)))
        error = ((chance - y) * weight / max(1e-9, weight.sum())).astype(np.float32)
        out["v"], out["c"] = (None, hidden.T @ error), (None, np.array([error.sum()], np.float32))
        back = error[:, None] * self.p["v"]
        rows, shares = [], []
        for i, w in enumerate(SPANS):
            where, live = states[i]
            g = back[:, i * FILTERS : (i + 1) * FILTERS] * live
            out[f"b{w}"] = (None, g.sum(0))
            window = where[:, :, None] + np.arange(w)
            inside = window < first[1:, None, None]
            window = np.minimum(window, len(ids) - 1)
            out[f"F{w}"] = (None, np.einsum("nf,nfkd->kdf", g, vectors[window] * inside[..., None]))
            share = np.einsum("nf,kdf->nfkd", g, self.p[f"F{w}"]) * inside[..., None]
            rows.append(ids[window.reshape(-1)].reshape(-1))
            shares.append(np.repeat(share.reshape(-1, WIDTH), PIECES, axis=0))
        rows, shares = np.concatenate(rows), np.concatenate(shares)
        used, back_to = np.unique(rows, return_inverse=True)
        total = np.zeros((len(used), WIDTH), np.float32)
        np.add.at(total, back_to, shares)
        known = self.known[used]
        out["E"] = (used[known], total[known])
        return out


def train(texts: list[str | None], labels: list[int], langs: list[str | None], steps: int = _STEPS) -> ToxicityModel:
    """Adam over batches of about STEP_WORDS words, both classes weighing alike; then the thresholds of each language.

    The thresholds come from texts that the model does not learn from, or from all if those or the rest lack a class.
    """
    model = ToxicityModel()
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        model.p["v"][:] = 0
        model.p["c"][:] = 0 if not len(y) else (2 if y[0] else -2)
        return model
    apart = np.array([zlib.crc32((t or "").encode("utf-8", "surrogatepass")) % APART == 0 for t in texts])
    if min(len(set(y[apart])), len(set(y[~apart]))) < 2:
        apart[:] = False
    own = np.flatnonzero(~apart)
    docs = []
    for text in texts:
        _, _, data, offsets = next(iter(slices(pa.array([text], pa.string()), 1 << 62)))
        docs.append(words(data, offsets)[0])
    size = np.array([len(d) for d in docs])
    held_by = np.zeros(1 << BITS, np.int64)
    for i in own:
        held_by[np.unique(docs[i])] += 1
    model.know(np.flatnonzero(held_by >= MIN_DOCS))
    held = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    rng, queue = np.random.default_rng(5), np.empty(0, np.int64)
    share = y[own].mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for step in range(1, steps + 1):
        if not len(queue):
            queue = rng.permutation(own)
        take = max(1, int(np.searchsorted(np.cumsum(size[queue]), STEP_WORDS)))
        take = min(take, 64)
        some, queue = queue[:take], queue[take:]
        ids, first = np.concatenate([docs[i] for i in some]), np.concatenate([[0], np.cumsum(size[some])])
        if not len(ids):
            continue
        for k, (rows, g) in model.gradients(ids, first, y[some], weight[some]).items():
            at = slice(None) if rows is None else rows
            m, s = held[k]
            m[at] = 0.9 * m[at] + 0.1 * g
            s[at] = 0.99 * s[at] + 0.01 * g * g
            rate = _RATE * min(1.0, 2 * (1 - (step - 1) / steps))
            model.p[k][at] -= rate * (m[at] / (1 - 0.9 ** min(step, 200))) / (np.sqrt(s[at] / (1 - 0.99 ** min(step, 1000))) + 1e-6) + _DECAY * model.p[k][at]
    judged = np.flatnonzero(apart) if apart.any() else own
    scores = np.concatenate([model.score(d, o) for _, _, d, o in slices(pa.array([texts[i] for i in judged], pa.string()))])
    model.thresholds = calibrated(scores, y[judged], [langs[i] for i in judged])
    return model


def calibrated(scores: np.ndarray, y: np.ndarray, langs: Iterable[str | None], least: int = 10, n: np.ndarray | None = None) -> dict[str | None, float]:
    """For each language the threshold with the best F1, the middle of a gap between scores; None holds that of all rows.

    Languages with fewer than ``least`` positive rows use the threshold of all rows.  n: how many rows each entry stands for,
    of which the share y is positive.
    """
    n = np.ones(len(scores)) if n is None else n

    def best(s: np.ndarray, t: np.ndarray, n: np.ndarray) -> float:
        order = np.argsort(-s, kind="stable")
        s, hits, upto = s[order], np.cumsum((t * n)[order]), np.cumsum(n[order])
        f1 = 2 * hits / (upto + hits[-1])
        k = int(np.argmax(f1))
        return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])

    langs = np.array([x if x is not None else "" for x in langs], object)
    out: dict[str | None, float] = {None: best(scores, y, n)}
    for name in sorted(set(langs) - {""}):
        own = langs == name
        if (y * n)[own].sum() >= least:
            out[name] = best(scores[own], y[own], n[own])
    return out


def _apart(texts: list[str | None]) -> np.ndarray:
    return np.array([zlib.crc32((t or "").encode("utf-8", "surrogatepass")) % APART == 0 for t in texts], bool)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, n) of a task: how many texts to learn from hold a piece; below 0 the number of texts by label and whether kept apart."""
    held, seen = np.zeros(1 << BITS, np.int64), np.zeros(4, np.int64)
    for batch in batches:
        apart, y = _apart(batch.column(0).to_pylist()), batch.column(1).to_numpy() > 0
        seen += np.bincount(2 * apart + y, minlength=4)
        for a, b, data, offsets in slices(batch.column(0)):
            rows, first = words(data, offsets)
            for i in np.flatnonzero(~apart[a:b]):
                held[np.unique(rows[first[i] : first[i + 1]])] += 1
    places = np.concatenate([np.flatnonzero(held), [-4, -3, -2, -1]]).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.concatenate([held[held > 0], seen]))], names=["place", "n"])


def _descend(model: ToxicityModel, batches: Iterable[pa.RecordBatch], weight: np.ndarray, keep: bool) -> Iterator[pa.RecordBatch]:
    """The weights after one pass over a task's texts, the rows of the embedding it changed, and its number of texts."""
    model = copy.deepcopy(model)  # a worker keeps what was sent for its next task
    held = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    touched, texts, step = np.zeros(1 << BITS, bool), 0, 0
    for batch in batches:
        own = np.flatnonzero(~_apart(batch.column(0).to_pylist()) | keep)
        column, labels = batch.column(0).take(pa.array(own)), (batch.column(1).to_numpy() > 0)[own]
        for a in range(0, len(own), 64):
            y = labels[a : a + 64].astype(np.float32)
            for i, j, data, offsets in slices(pa.concat_arrays([column.slice(a, 64)])):
                ids, first = words(data, offsets)
                if not len(ids):
                    continue
                step, texts = step + 1, texts + j - i
                rate = _LATER_RATE / (1 + step / _FALL)
                for k, (rows, g) in model.gradients(ids, first, y[i:j], weight[y[i:j].astype(int)]).items():
                    at = slice(None) if rows is None else rows
                    if rows is not None:
                        touched[rows] = True
                    m, s = held[k]
                    m[at] = 0.9 * m[at] + 0.1 * g
                    s[at] = 0.99 * s[at] + 0.01 * g * g
                    model.p[k][at] -= rate * (m[at] / (1 - 0.9 ** min(step, 200))) / (np.sqrt(s[at] / (1 - 0.99 ** min(step, 1000))) + 1e-6)
    if texts:
        names = sorted(model.p)
        flat = np.concatenate([model.p[k].astype(np.float32).ravel() for k in names])
        yield pa.RecordBatch.from_arrays([pa.array([texts], pa.int64()), pa.array([flat.tobytes()], pa.binary()), pa.array([touched.tobytes()], pa.binary())], names=["n", "weights", "touched"])


def _averaged(model: ToxicityModel, found: list) -> None:
    """Each weight becomes the mean of the tasks', by their texts; a row of the embedding that of the tasks that changed it."""
    total = {k: np.zeros(v.shape) for k, v in model.p.items()}
    rows, n = np.zeros(1 << BITS), 0
    for r in sorted(found, key=lambda r: (r["n"], bytes(r["weights"]))):
        flat, at = np.frombuffer(r["weights"], np.float32), 0
        touched = np.frombuffer(r["touched"], bool) * float(r["n"])
        for k in sorted(model.p):
            size = model.p[k].size
            total[k] += flat[at : at + size].reshape(model.p[k].shape) * (touched[:, None] if k == "E" else r["n"])
            at += size
        rows, n = rows + touched, n + r["n"]
    for k in model.p:
        if k == "E":
            model.p[k][rows > 0] = (total[k][rows > 0] / rows[rows > 0, None]).astype(np.float32)
        elif n:
            model.p[k] = (total[k] / n).astype(np.float32)


def over_all(model: ToxicityModel, rows: DataFrame, lang: str) -> ToxicityModel:
    """The model after one pass over all of ``rows`` (text, label, lang) in their tasks, with thresholds from all texts kept apart."""
    sc = rows.sparkSession.sparkContext
    counts = {r["place"]: r["n"] for r in rows.select("text", "label").mapInArrow(_counts, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).where(f"place < 0 or n >= {MIN_DOCS}").collect()}
    seen = np.array([counts.get(k, 0) for k in (-4, -3, -2, -1)], float)  # learned from with label 0 and 1, apart with 0 and 1
    keep = bool((seen == 0).any())
    learned = seen[:2] + seen[2:] * keep
    if (learned == 0).any():
        return model
    known = np.array(sorted(k for k in counts if k >= 0), np.int64)
    model.know(known)
    sent, weight = sc.broadcast(model), 0.5 * learned.sum() / learned
    weight = weight.astype(np.float32)
    tasks = rows.select("text", "label").coalesce(min(MAX_TASKS, sc.defaultParallelism))
    found = tasks.mapInArrow(lambda batches: _descend(sent.value, batches, weight, keep), "n long, weights binary, touched binary").collect()  # MAX_TASKS rows
    _averaged(model, found)

    done = sc.broadcast(model)

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array(np.flatnonzero(_apart(batch.column(0).to_pylist()) | keep))
            some = batch.take(own)
            scores = np.concatenate([np.empty(0), *(done.value.score(data, offsets) for _, _, data, offsets in slices(some.column(0)))])
            yield pa.RecordBatch.from_arrays([some.column(2).cast(pa.string()), pa.array((some.column(1).to_numpy() > 0).astype(float)), pa.array(np.round(scores, 4))], names=["lang", "y", "score"])

    bins = rows.select("text", "label", F.col(lang).cast("string")).mapInArrow(judged, "lang string, y double, score double").groupBy("lang", "score").agg(F.avg("y").alias("y"), F.count("*").alias("n")).toPandas()
    model.thresholds = calibrated(bins["score"].to_numpy(), bins["y"].to_numpy(), [x if isinstance(x, str) else None for x in bins["lang"]], n=bins["n"].to_numpy(float))
    return model


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS
) -> ToxicityModel:
    """A model from all labelled rows among ``docs`` with their whole texts: up to about ``max_docs`` at once, more by over_all."""
    rows = sample(docs, labels, label, max_docs, text, doc_id, lang).toArrow()  # bounded by max_docs
    model = train(rows["text"].to_pylist(), rows["label"].to_pylist(), rows[lang].to_pylist())
    if labels.where(F.col(label).cast("int").isNotNull() & F.col(doc_id).isNotNull()).count() <= max_docs:
        return model
    return over_all(model, labelled(docs, labels, label, text, doc_id, lang), lang)


def probability(model: ToxicityModel, docs: DataFrame, text: Column) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.empty(0), *(sent.value.score(data, offsets) for _, _, data, offsets in slices(texts))]))

    return of(text)


def classify(docs: DataFrame, model: ToxicityModel, text: str = "text", lang: str = "lang", threshold: float = 0.5) -> DataFrame:
    """docs with score (0 to 1), predicted (score >= threshold) and flagged (score >= the threshold of its language).

    The score follows from the text alone; the language only chooses the threshold of ``flagged``, and an unknown or
    null one uses that of all rows.  Null and empty texts have no windows and get the output for none.  Equal texts get
    equal scores; columns of these names are replaced, rows and other columns stay as they are.
    """
    own = [c for c in docs.columns if c.lower() not in ("score", "predicted", "flagged")]
    found = docs.select(*[F.col(f"`{c}`") for c in own], probability(model, docs, F.col(text)).alias("score"))
    limit = F.lit(model.thresholds.get(None, threshold))
    for name, value in model.thresholds.items():
        if name is not None:
            limit = F.when(F.col(lang) == name, value).otherwise(limit)
    return found.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)).withColumn("flagged", F.col("score") >= limit)
