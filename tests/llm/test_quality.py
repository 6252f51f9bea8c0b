"""Quality rules and classifier, language ID."""
import collections
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import regex
import zstandard

from inkline.llm import language_id, quality_classifier, quality_rules
from inkline.llm.queries import QUERIES

from .conftest import prose

D = "/root/testdata/sf0.01"


def brute(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)


def test_base_counts():
    rnd, press = random.Random(1), zstandard.ZstdCompressor(level=3)
    for _ in range(5000):
        t = "".join(rnd.choice(["a", "b", "é ", "\xa0", "\n", "\x0b", "\x1c", "\x85", "# ", "|", " ", "漢 "]) for _ in range(rnd.randint(0, 40)))
        assert quality_rules.judge(t, press)[:5] == brute(t)


def test_rules_verdict(edge, nothing):
    press = zstandard.ZstdCompressor(level=3)
    verdict = lambda t: quality_rules.judge(t, press)[-2:]
    assert verdict(prose(1, 60)) == (False, True) and verdict(prose(1, 5000)) == (False, True)
    assert verdict(None) == verdict("") == (True, False)
    assert verdict("word " * 49)[0] and verdict("word " * 200)[0]
    lines = "".join(f"{i} the same long line of text stands here again and again {i % 7}\n" for i in range(400))
    assert not verdict(lines)[1]
    rnd = random.Random(2)
    assert verdict(" ".join("".join(chr(rnd.randint(33, 0x2fff)) for _ in range(9)) for _ in range(300))) == (False, False)
    rows = quality_rules.quality_rules(edge).collect()
    assert len(rows) == edge.count() and sum(r.kept for r in rows) == len(quality_rules.keep_good(edge).collect()) == 6
    kept = quality_rules.keep_good(edge)
    assert kept.schema == edge.schema
    assert quality_rules.quality_rules(nothing).count() == quality_rules.keep_good(nothing).count() == 0


def test_rules_keep_labelled_good(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, D).collect()}
    good = [r.doc_id for r in spark.read.parquet(f"{D}/labels.parquet").filter("quality = 1").collect()]
    assert all(rows[i].kept for i in good if not rows[i].base_failed)


def test_rules_measure_bands(spark, nothing):
    """Texts that pass the base rules: repetitive ones, noise and pages with a stretch of junk go, clean ones stay, copies or not."""
    rnd = random.Random(5)
    lexicon = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    clean = lambda n: " ".join(rnd.choices(lexicon, k=n))
    marked = lambda n: " ".join(w + rnd.choice(["###", "$$$", "%%%", "&&&"]) for w in rnd.choices(lexicon[:400], k=n))
    noise = lambda n: " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(6)) for _ in range(n))
    kinds = {"clean": [clean(rnd.randint(250, 1100)) for _ in range(400)] + [clean(500)] * 60,
             "bad": [f(n) for n in (350, 450, 600, 900) for f in (marked, noise)] + [clean(550) + " " + f(500) for f in (marked, noise)]}
    rows = [(i, kind, t) for i, (kind, t) in enumerate((k, t) for k, v in kinds.items() for t in v)]
    docs = spark.createDataFrame(rows, "doc_id long, kind string, text string").repartition(7)
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert len(found) == len(rows) and not any(r.base_failed for r in found.values())
    assert [found[i].kept for i, kind, _ in rows] == [kind == "clean" for _, kind, _ in rows]
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == {i for i, kind, _ in rows if kind == "clean"}
    assert quality_rules.measure(nothing) == {}


def plain_verdict(texts):
    """Kept or not of each text, from lists of ratios instead of counts."""
    q = quality_rules

    def pieces(raw):
        cuts = [raw[i:i + q.CHUNK] for i in range(0, len(raw), q.CHUNK)]
        if len(cuts[-1]) < q.CHUNK // 2:
            cuts[-2:] = [cuts[-2] + cuts[-1]]
        return cuts

    def ratio(raw):
        return len(zstandard.ZstdCompressor(level=q.LEVEL).compress(raw)) / len(raw)

    def kind(chunk, text, raw):
        per = len(text.encode()) / len(text)
        return chunk, 1 if per < 1.3 else 2 if per < 2.3 else 3, int(np.floor(2 * np.log2(len(raw)) + 1e-9))

    def of(text):
        raw = text.encode()
        return [(kind(False, text, raw), ratio(raw))] + [(kind(True, text, p), ratio(p)) for p in (pieces(raw) if len(raw) >= 2 * q.CHUNK else [])]

    seen = collections.defaultdict(list)
    failed = [(lambda b: b[0] < 50 or 100 * b[4] > 50 * b[0])(brute(t)) for t in texts]
    for t, bad in zip(texts, failed, strict=True):
        for k, x in [] if bad else of(t):
            seen[k].append(round(x / q.BIN) * q.BIN)

    def limits(k):
        size = 2 ** (k[2] / 2)
        lo, hi = q.CHUNK_BAND if k[0] else [(a, b) for most, a, b in q.WHOLE if size <= most][0]
        if k not in seen:
            return lo, hi
        xs = sorted(seen[k])
        lower = lambda v: sorted(v)[(len(v) - 1) // 2]
        mid = lower(xs)
        spread = max(1.4826 * lower([abs(x - mid) for x in xs]), q.LEAST / size ** 0.5) * (1 + 2 / len(xs) ** 0.5)
        prior = q.PRIOR_CHUNKS if k[0] else q.PRIOR
        mix = lambda a, b: (len(xs) * a + prior * b) / (len(xs) + prior)
        return mix(mid - q.BELOW * spread, lo), mix(mid + q.ABOVE * spread, hi)

    out = []
    for t, bad in zip(texts, failed, strict=True):
        if bad:
            out.append(False)
            continue
        inside = [limits(k)[0] <= x <= limits(k)[1] for k, x in of(t)]
        out.append(inside[0] and inside[1:].count(False) <= q.BAD_SHARE * len(inside[1:]))
    return out


def test_verdict_equals_plain(spark):
    rnd = random.Random(8)
    junk = lambda n: " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(6)) for _ in range(n))
    texts = [prose(i, rnd.randint(40, 900)) for i in range(120)] + [junk(rnd.randint(60, 900)) for _ in range(15)] + ["", "a b", "ä漢 " * 70]
    texts += [prose(500 + i, 300) + " " + junk(400) + prose(i, 600) for i in range(8)] + [" ".join(f"w{i}{i % 9}é" for i in range(n)) for n in range(60, 90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert [kept[i] for i in range(len(texts))] == plain_verdict(texts)


def test_bands_move_smoothly():
    """One ratio more moves a class's limits little, at every size."""
    kind = (False, 1, 20)
    bands = [quality_rules.band(kind, np.array([0.5, 0.52, 0.48]), np.array([n, n // 2, n // 2])) for n in range(2, 200)]
    steps = [abs(a[0] - b[0]) for a, b in zip(bands, bands[1:], strict=False)]
    assert max(steps[8:]) < 0.01 and quality_rules.broad(kind)[0] < bands[0][0] < bands[-1][0]


def test_rules_reject_labelled_bad(spark):
    big = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, big).collect()}
    labels = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{big}/labels.parquet").collect()]
    assert all(r.kept for y, r in labels if y == 1 and not r.base_failed)
    bad = [r for y, r in labels if y == 0 and not r.base_failed]
    assert sum(not r.kept for r in bad) > len(bad) / 2 and not any(r.kept for r in bad if r.word_chars > 8192)


def test_classifier_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    rows = QUERIES["op1_quality_classifier"](spark, D).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([y == p for y, _, p in held]) > 0.95
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_classifier_sparse_equals_flat():
    texts = [prose(i, 40) for i in range(30)] + ["!! THIS!! IS!! LOUD!!" * 5] * 3 + [""]
    frame = pd.DataFrame({"text": texts, "quality": [1] * 30 + [0] * 3 + [1]})
    model = quality_classifier.learn(frame)
    array = pa.array(texts)
    found, rows = quality_classifier.features(array)
    for i, p in enumerate(quality_classifier.predict(model, array)):
        at, x = quality_classifier.sparse(found, rows, i)
        assert p == pytest.approx(1 / (1 + np.exp(-(x @ model.weights[at] + model.bias))), abs=1e-6)


def test_classifier_edges(spark, edge, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, text string")
    usable = none.quality.isNotNull()
    model = quality_classifier.train(edge, none, usable)
    rows = quality_classifier.score(edge, model).collect()
    assert len(rows) == edge.count() and all(r.score == 0.5 for r in rows)
    assert quality_classifier.score(nothing, model).count() == 0
    twice = spark.createDataFrame([(1, 0), (1, 1), (3, 1), (5, 0), (None, 1), (9, None)], "doc_id long, quality int")
    model = quality_classifier.train(edge, twice, twice.doc_id.isNotNull())
    assert quality_classifier.score(edge, model).count() == edge.count()


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    rows = QUERIES["op3_language_id"](spark, D).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.98


@pytest.mark.parametrize("n", [2, 3, 5, 9, 40])
def test_codewords(n):
    codes = language_id.codewords(n)
    apart = min((codes[i] != codes[j]).sum() for i in range(n) for j in range(i))
    assert len(codes) == n and apart >= codes.shape[1] // 4 and (abs(codes.sum(0)) < n).all()


def test_codes_correct_a_wrong_bit():
    codes = language_id.codewords(5)
    model = language_id.Model(list("abcde"), codes, np.full(codes.shape, 1 / codes.shape[1]), np.zeros((1 << language_id.BITS, codes.shape[1]), np.float32), None)
    for i in range(5):
        margin = codes[i] * 4.0
        margin[3] *= -1
        assert language_id.predict(model._replace(bias=margin), pa.array(["word"]))[0] == ["abcde"[i]]


def test_predict_equals_plain_loop():
    """Margins, weighted losses and the nearest codeword by plain loops over grams, bits and languages."""
    frame = pd.DataFrame({"text": [prose(i, 30) + x for i in range(8) for x in (" das und die", " the of to", " le la Étés", " los él")], "lang": ["de", "en", "fr", "es"] * 8})
    model = language_id.learn(frame)
    texts = ["Und THE la", prose(99, 20), "été", "12 a!", None, "漢字 los", "--"]
    lang, score, _ = language_id.predict(model, pa.array(texts))
    for text, found, p in zip(texts, lang, score, strict=True):
        raw = "".join(c if regex.match(r"\p{L}", c) else " " * len(c.encode()) for c in (text or "").lower()).encode()
        grams = [raw[i:i + n] for n in language_id.GRAMS for i in range(len(raw) - n + 1)]
        at = [((int.from_bytes(g, "big") + len(g)) * 2654435769 % 2**32) >> (32 - language_id.BITS) for g in grams if g.strip(b" ")]
        at = [k for k in at if k]
        if not at:
            assert found == "und" and p == 0
            continue
        size = len(set(at)) ** 0.5 / len(at)
        far = []
        for code, trust in zip(model.codes, model.trust, strict=True):
            margins = [sum(float(model.weights[k, bit]) for k in at) * size + model.bias[bit] for bit in range(len(code))]
            far.append(len(code) * sum(w * np.log1p(np.exp(-m * c)) for m, c, w in zip(margins, code, trust, strict=True)))
        best = int(np.argmin(far))
        assert found == model.langs[best] and p == pytest.approx(1 / sum(np.exp(far[best] - f) for f in far), abs=1e-5)


def test_language_sample_counts_an_id_once(spark, monkeypatch):
    """An id on a third of all rows brings one text, and a hot language its share at most."""
    seen = []
    monkeypatch.setattr(language_id, "SAMPLE", 20)
    monkeypatch.setattr(language_id, "learn", lambda frame: seen.append(frame))
    rows = [(1, f"x{i:03}", "de") for i in range(200)] + [(i, f"y{i}", "de") for i in range(2, 300)] + [(i, "z", "en") for i in range(5)] + [(None, "n", "en")] * 3
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.train(docs, F.lit(True))
    frame = seen[0]
    assert dict(frame["lang"].value_counts()) == {"de": 20, "en": 6} and not frame.duplicated(["lang", "at"]).any()
    order = [r["h"] for r in docs.filter("lang = 'de'").select(F.xxhash64("doc_id").alias("h")).distinct().orderBy("h").limit(20).collect()]
    assert sorted(frame[frame["lang"] == "de"]["at"]) == order and set(frame[frame["text"].str.startswith("x")]["text"]) <= {"x000"}


def test_language_edges(spark, edge, nothing):
    from pyspark.sql import functions as F

    docs = edge.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.train(docs, F.lit(True)) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    one = language_id.train(edge.withColumn("lang", F.lit("xx")), F.lit(True))
    rows = language_id.identify(edge, one).collect()
    assert len(rows) == edge.count()
    texts = edge.select("text").collect()
    assert sorted(r.lang_pred for r in rows) == sorted("xx" if any(c.isalpha() for c in t.text or "") else "und" for t in texts)
    assert language_id.identify(nothing, one).count() == 0
    frame = pd.DataFrame({"text": ["der die und das ist " * 4, "the of and to is in " * 4] * 10, "lang": ["de", "en"] * 10})
    model = language_id.learn(frame)
    lang, score, unsure = language_id.predict(model, pa.array(["und die", "and the", None, "12 !!", "漢字"]))
    assert lang[:4] == ["de", "en", "und", "und"] and score[2] == score[3] == 0 and unsure[2] and unsure[4]


def test_language_cut_offs(spark, monkeypatch):
    """Each language's cut-off takes the same keys as sorting them does, whatever its size and how near its keys lie."""
    monkeypatch.setattr(language_id, "ROUND_BITS", 3)
    rng = random.Random(5)
    keys = {"hot": [rng.randrange(-2**63, 2**63) for _ in range(3000)], "few": [-2**63, 2**63 - 1, 0], "near": [*range(-20, 20)], "even": [rng.randrange(-2**63, 2**63) for _ in range(25)]}
    rows = spark.createDataFrame([(lang, at) for lang, own in keys.items() for at in own], "lang string, at long")
    found = language_id.cut_offs(rows, 25)
    assert set(found) == set(keys)
    for lang, own in keys.items():
        assert sorted(x for x in own if x <= found[lang]) == sorted(own)[:25], lang
    assert language_id.cut_offs(rows.limit(0), 25) == {}
