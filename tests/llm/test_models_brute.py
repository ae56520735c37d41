"""The classifiers against their definitions in plain loops."""

import math
import zlib

import numpy as np
import pytest

from martlet.llm import language, quality

WORDS = {
    "aa": "tree river stone cloud winter summer bird house garden morning",
    "bb": "baum fluss stein wolke winter sommer vogel haus garten morgen über",
}


def texts(n=24):
    rng = np.random.default_rng(3)
    return [(k, lang, " ".join(rng.choice(own.split(), 6 + k % 5))) for lang, own in WORDS.items() for k in range(ord(lang[0]) % 2, 2 * n, 2)]


# ------------------------------------------------------------------ language


def grams(text):
    """{bucket: count} of byte n-grams, every stretch without letters one gap."""
    raw = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode())
    raw = b" " + b" ".join(raw.split()) + b" "
    out = {}
    for n in (2, 3):
        for k in range(len(raw) - n + 1):
            bucket = (int.from_bytes(raw[k : k + n], "big") + n) * 0x9E3779B1 % 2**32 >> 32 - language.BUCKET_BITS
            out[bucket] = out.get(bucket, 0) + 1
    return out


def unit(vector):
    length = math.sqrt(sum(x * x for x in vector.values()))
    return {k: x / length for k, x in vector.items()}


def cosine(u, v):
    return sum(x * v.get(k, 0.0) for k, x in u.items())


def centroids(rows):
    """[(lang, centroid, least cosine)] and the idf by bucket, from (doc_id, lang, text)."""
    rows = sorted(r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1)
    found = [grams(t) for _, _, t in rows]
    seen = [sum(b in g for g in found) for b in range(1 << language.BUCKET_BITS)]
    idf = [math.log((1 + len(rows)) / (1 + s)) + 1 for s in seen]
    out = []
    for lang in sorted({lang for _, lang, _ in rows}):
        own = [unit({b: c * idf[b] for b, c in g.items()}) for g, r in zip(found, rows) if r[1] == lang]
        centres = [own[k] for k in np.random.default_rng(11).choice(len(own), language.CENTROIDS, replace=False)]
        for turn in range(language.TURNS + 1):
            near = [[cosine(v, c) for c in centres] for v in own]
            nearest = [row.index(max(row)) for row in near]
            if turn == language.TURNS:
                break
            for c in range(len(centres)):
                total = {}
                for v in (v for v, k in zip(own, nearest) if k == c):
                    for b, x in v.items():
                        total[b] = total.get(b, 0.0) + x
                centres[c] = unit(total or centres[c])
        for c, centre in enumerate(centres):
            held = sorted(row[c] for row, k in zip(near, nearest) if k == c)
            place = (1 - language.QUANTILE) * (len(held) - 1)
            low = int(place)
            edge = held[low] + (place - low) * (held[min(low + 1, len(held) - 1)] - held[low]) if held else 0.0
            out.append((lang, centre, 1 - language.MARGIN * (1 - edge)))
    return out, idf


def test_language_matches_plain_loops(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = language.fit(docs)
    want, idf = centroids(rows)
    assert np.allclose(model.idf, idf, atol=1e-9) and model.langs == [lang for lang, _, _ in want]
    for got, least, (_, centre, edge) in zip(model.unit, model.least, want):
        assert max(abs(got[b] - centre.get(b, 0.0)) for b in range(len(got))) < 1e-9 and abs(least - edge) < 1e-9
    asked = [t for _, _, t in rows] + ["stone and haus", "zzz qqq", "x"]
    for text in asked:
        own = unit({b: c * idf[b] for b, c in grams(text).items()})
        near = [cosine(own, c) for _, c, _ in want]
        top = near.index(max(near))
        lang, score, rejected = model.predict(text, language.BUCKET_BITS)
        assert lang == want[top][0] and abs(score - near[top]) < 1e-9
        # a cluster of one text has its edge at that very text, where rounding decides
        assert rejected == (near[top] < want[top][2]) or abs(near[top] - want[top][2]) < 1e-9
    assert model.predict("zzz qqq", language.BUCKET_BITS)[2]


# ------------------------------------------------------------------ quality


def bucket(value, kind, bits):
    mixed = (value ^ kind) * 0xD6E8FEB86659FD93 % 2**64
    mixed ^= mixed >> 32
    return mixed * 0xD6E8FEB86659FD93 % 2**64 >> 64 - bits


def buckets(text, bits):
    """Buckets of all words and of the n-grams that have no gap inside."""
    out = []
    words = text.encode().split() or [b""]  # a text without words has the empty word
    for word in words:
        value = sum(b * pow(0x9E3779B97F4A7C15, k, 2**64) for k, b in enumerate(b" " + word))
        out.append(bucket((value + (len(word) + 1) * 0x9E3779B97F4A7C15) % 2**64, 1, bits))
    marked = b" " + b" ".join(words) + b" "
    for n in (3, 4):
        for k in range(len(marked) - n + 1):
            if b" " not in marked[k + 1 : k + n - 1]:
                out.append(bucket(int.from_bytes(marked[k : k + n], "big"), n, bits))
    return out


@pytest.mark.parametrize("epochs", [1, 3])
def test_quality_training_and_scores_match_plain_loops(monkeypatch, epochs):
    monkeypatch.setattr(quality, "EPOCHS", epochs)
    bits, size = 7, quality.DIMENSIONS
    samples = [(t, int(lang == "aa")) for _, lang, t in texts(12)]
    rows = []
    for text, _ in samples:
        own = buckets(text, bits)
        assert sorted(own) == sorted(np.concatenate(list(quality.features(text, bits))).tolist())
        names = sorted(set(own))
        rows.append((names, [own.count(b) / len(own) for b in names]))
    labels = [y for _, y in samples]
    model = quality.train([(np.array(b), np.array(s)) for b, s in rows], np.array(labels), bits)

    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / size, 1 / size, (1 << bits, size)).tolist()
    weights, bias, done = [[0.0, 0.0] for _ in range(size)], [0.0, 0.0], 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            rate = quality.RATE * (1 - done / (epochs * len(rows)))
            done += 1
            names, shares = rows[i]
            hidden = [sum(s * vectors[b][d] for b, s in zip(names, shares)) for d in range(size)]
            z = [sum(hidden[d] * weights[d][y] for d in range(size)) + bias[y] for y in (0, 1)]
            p = [math.exp(x) / (math.exp(z[0]) + math.exp(z[1])) for x in z]
            p[labels[i]] -= 1
            back = [sum(weights[d][y] * p[y] for y in (0, 1)) for d in range(size)]
            for y in (0, 1):
                bias[y] -= rate * 0.1 * p[y]
                for d in range(size):
                    weights[d][y] -= rate * 0.1 * hidden[d] * p[y]
            for b, s in zip(names, shares):
                for d in range(size):
                    vectors[b][d] -= rate * math.sqrt(len(names)) * s * back[d]
    assert np.allclose(model.vectors, vectors, atol=1e-9) and np.allclose(model.weights, weights, atol=1e-9)
    assert np.allclose(model.bias, bias, atol=1e-9)
    for text, _ in [*samples, ("", 0), ("unseen words of neither", 0)]:
        own = buckets(text, bits)
        hidden = [sum(vectors[b][d] for b in own) / max(len(own), 1) for d in range(size)]
        z = [sum(hidden[d] * weights[d][y] for d in range(size)) + bias[y] for y in (0, 1)]
        want = math.exp(z[1]) / (math.exp(z[0]) + math.exp(z[1]))
        assert abs(model.score(text, model.margins(), bits) - want) < 1e-9
