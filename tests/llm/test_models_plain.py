"""The trained models against plain Python that goes token by token and n-gram by n-gram."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lotlens.llm import langid, media, quality, queries, spans, toxicity

SF = "/root/testdata/sf0.001"
ALL = (1 << 64) - 1
ODD = [None, "", "  ", "!!", "A.", "one", "Two words, TWO words", "é ü\x00x", "12 12 12 a", "x" * 40 + " yz"]


def mix(h):
    for _ in range(2):
        h = ((h ^ h >> 32) * 0xD6E8FEB86659FD93) & ALL
    return h ^ h >> 32


def token_hash(token):
    return mix(sum(mix((c + 1) * 0x9E3779B97F4A7C15 & ALL) * pow(0x5851F42D4C957F2D, i, 1 << 64) for i, c in enumerate(token)) & ALL)


def raw(text):
    return (text or "").encode("utf-8", "surrogatepass")


def scored(model, texts):
    return np.concatenate([model.score(d, o) for _, _, d, o in spans.slices(pa.array(texts, pa.string()))])


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    return docs.select("doc_id", "text", docs["lang"], "quality", "toxic").orderBy("doc_id").collect()


def test_toxicity_forward_pass(rows):
    texts = [r["text"] for r in rows][:120] + ODD
    labels, langs = [r["toxic"] for r in rows], [r["lang"] for r in rows]
    model = toxicity.train([r["text"] for r in rows], labels, langs, steps=20)
    p = {k: v.astype(float) for k, v in model.p.items()}

    def plain(text):
        vectors = []
        for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", raw(text)):
            places = [max(1, mix((token_hash(piece.lower()) + k) & ALL) >> (64 - toxicity.BITS)) for k, piece in enumerate((w, w[:4], w[:7], w[-4:]))]
            vectors.append(sum(p["E"][at] for at in places))
        best = []
        for w in toxicity.SPANS:
            answers = [p[f"b{w}"] + sum(vectors[i + k] @ p[f"F{w}"][k] for k in range(w) if i + k < len(vectors)) for i in range(len(vectors))]
            best.extend(max([0.0, *(float(a[f]) for a in answers)]) for f in range(toxicity.FILTERS))
        return 1 / (1 + math.exp(-(np.dot(best, p["v"]) + p["c"][0])))

    assert np.allclose(scored(model, texts), [plain(t) for t in texts], atol=1e-4)


def test_toxicity_thresholds_are_of_texts_kept_apart():
    texts = [f"{'bad awful' if i % 2 else 'fine good'} text {i}" for i in range(400)]
    labels = [i % 2 for i in range(400)]
    apart = [zlib.crc32(t.encode()) % toxicity.APART == 0 for t in texts]
    model = toxicity.train(texts, labels, ["en"] * 400, steps=30)
    assert 20 < sum(apart) < 100 and set(model.thresholds) == {None, "en"}
    judged = np.flatnonzero(apart)
    want = toxicity.calibrated(scored(model, [texts[i] for i in judged]), np.array(labels)[judged], ["en"] * len(judged))
    assert model.thresholds == want


def plain_grams(text):
    data = bytes(c if re.match(rb"[a-z0-9\x80-\xff]", bytes([c])) else 32 for c in raw(text).lower())
    data = data.ljust(langid.GRAM) if data else data
    found = (data[i : i + langid.GRAM] for i in range(len(data) - langid.GRAM + 1))
    return [int.from_bytes(g, "little") for g in found if g[:2] != b"  "]


def test_language_filter_is_plain_sets_and_counts(spark, rows):
    texts, langs = [r["text"] for r in rows] + ODD, [r["lang"] for r in rows] + ["en"] * len(ODD)
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(texts, langs, strict=True))], "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, langid.learn(docs)).collect()}
    counts, docs_in = defaultdict(Counter), Counter()
    grams = [plain_grams(t) for t in texts]
    for t, x, g in zip(texts, langs, grams, strict=True):
        if t is not None and x is not None:
            counts[x].update(g)
            docs_in[x] += 1
    rate = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    best = Counter()
    for own in rate.values():
        for g, r in own.items():
            best[g] = max(best[g], r)
    learned = {x: [g for g, r in rate[x].items() if r >= langid.NEAR_BEST * best[g] and r >= langid.MIN_RATE and counts[x][g] >= 2] for x in docs_in}
    cells = 1 << max(12, (max(map(len, learned.values())) * langid.CELLS_PER_GRAM - 1).bit_length())

    def places(g):
        return [(mix(g) >> (32 * k)) & (cells - 1) for k in range(langid.HASHES)]

    filled = {x: {at for g in own for at in places(g)} for x, own in learned.items()}
    names, known = sorted(learned), {}
    prior = min(docs_in, key=lambda x: (-docs_in[x], x))
    for i, (t, own) in enumerate(zip(texts, grams, strict=True)):
        if not any(c.isalpha() for c in t or ""):
            assert got[i] == ("und", 0.0)
            continue
        share = []
        for x in names:
            false = (len(filled[x]) / cells) ** langid.HASHES
            for g in set(own) - known.keys():
                known[g] = {y for y in names if all(at in filled[y] for at in places(g))}
            hits = sum(x in known[g] for g in own)
            share.append(min(1.0, max(0.0, (hits / max(1, len(own)) - false) / (1 - false))))
        if not sum(share):
            assert got[i] == (prior, 0.0)
            continue
        assert got[i][0] == names[share.index(max(share))] and abs(got[i][1] - max(share) / sum(share)) < 1e-9


def plain_features(text):
    tokens = re.findall(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\t-\r ]+", raw(text))
    hashes, shapes = [token_hash(t) for t in tokens], []
    for i, t in enumerate(tokens):
        parts = (not re.match(rb"[A-Za-z0-9\x80-\xff]", t), t[:1].isupper(), t[-1:].isupper() and len(t) > 1, t[:1].isdigit(), i > 0 and hashes[i] == hashes[i - 1], min(len(t).bit_length() - 1, 5))
        code = 0
        for p in parts:
            code = code * 8 + int(p)
        shapes.append(mix(code + (1 << 40)))
    out = []
    for kind, base in enumerate((hashes, shapes)):
        pairs = [mix((a * 0x9E3779B97F4A7C15 + b) & ALL) for a, b in zip(base, base[1:], strict=False)]
        for order, grams in ((1, base), (2, pairs)):
            out.extend(mix((g + kind * 16 + order) & ALL) >> (64 - quality.BITS) for g in grams)
    return out


def test_quality_is_plain_ftrl(rows):
    texts, labels = [r["text"] for r in rows][:60] + ODD, [r["quality"] for r in rows][:60] + [0, 1] * 5
    labels = [x or 0 for x in labels]
    model = quality.train(texts, labels, passes=2)
    z, squares, bias = defaultdict(float), defaultdict(float), [0.0, 0.0]
    inputs = [{f: quality.SCALE * n / len(own) for f, n in Counter(own).items()} for own in map(plain_features, texts)]

    def weight(z, n, l1):
        return 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((quality._BETA + math.sqrt(n)) / quality._ALPHA + quality._L2)

    def chance(x):
        return 1 / (1 + math.exp(-(weight(*bias, 0.0) + sum(weight(z[f], squares[f], quality._L1) * v for f, v in x.items()))))

    order = np.random.default_rng(1)
    for _ in range(2):
        for i in order.permutation(len(texts)):
            error = chance(inputs[i]) - labels[i]
            old = weight(*bias, 0.0)
            for f, v in inputs[i].items():
                g, w = error * v, weight(z[f], squares[f], quality._L1)
                z[f] += g - (math.sqrt(squares[f] + g * g) - math.sqrt(squares[f])) / quality._ALPHA * w
                squares[f] += g * g
            bias[0] += error - (math.sqrt(bias[1] + error * error) - math.sqrt(bias[1])) / quality._ALPHA * old
            bias[1] += error * error
    assert np.allclose(scored(model, texts), [chance(x) for x in inputs], atol=1e-4)


def test_media_feature_and_stored_form(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    page = media.PAGE_ROWS * media.ROW_BYTES
    for r in queries.op7_media_tiff(spark, SF).collect():
        payload = media.payload_of(texts[r["doc_id"]])
        features = []
        for at in range(0, len(payload), page):
            part = payload[at : at + page]
            means = [sum(part[c :: media.ROW_SAMPLES]) * 1000 // (len(part) // media.ROW_SAMPLES) for c in range(media.ROW_SAMPLES)]
            counts = Counter(b >> 4 for b in part)
            features.append(f"{media.ROW_PIXELS}x{len(part) // media.ROW_BYTES}x{media.ROW_SAMPLES}:{','.join(map(str, means))}:{','.join(str(counts[k]) for k in range(16))}")
        form = media.stored(payload)
        assert (r["feature"], r["media_bytes"], r["media_sha256"]) == (";".join(features), len(form), hashlib.sha256(form).hexdigest())
