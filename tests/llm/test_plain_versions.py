"""Operators and stages against plain versions of what they say they do."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from millrace.llm import edits, language, lattice, packing, phrases
from millrace.llm.tokens import encoder, vocabulary

FOLDER = "/root/testdata/sf0.001"


def plain_convolution(model, window):
    """Logarithms of probabilities: embed, convolve at every place, take the largest, softmax."""
    x = model.embedding[np.frombuffer(window.ljust(language.WINDOW, b"\0"), np.uint8)]
    pooled = []
    for w in language.WIDTHS:
        filters = model.filters[w].reshape(w, language.EMBEDDING, -1)
        answers = [sum(x[i + k] @ filters[k] for k in range(w)) for i in range(language.WINDOW - w + 1)]
        pooled.append(np.max(answers, axis=0))
    scores = np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.weights + model.offset
    return scores - np.log(np.exp(scores).sum())


def test_network_is_the_plain_convolution():
    rng = random.Random(1)
    sample = [(lang, " ".join(rng.choices(words, k=20)).encode()[:language.WINDOW])
              for lang, words in (("a", ["lorem", "ipsum", "dolor"]), ("b", ["über", "straße", "weiß"]), ("c", ["one", "two"])) for _ in range(30)]
    model = language.train(sample, epochs=2)
    texts = [w.decode(errors="ignore") for _, w in sample[::9]]
    got = np.log(language._Network(model).texts(pa.array(texts)))
    for text, row in zip(texts, got):
        assert np.allclose(row, plain_convolution(model, text.encode()), atol=1e-3)
    # A text of several windows: their logarithms weigh by the bytes inside.
    text = "lorem ipsum über straße " * 9
    data = text.encode()
    parts = [data[i:i + language.WINDOW] for i in range(0, len(data), language.WINDOW)]
    total = sum(len(p) * plain_convolution(model, p) for p in parts) / len(data)
    want = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
    assert np.allclose(language._Network(model).texts(pa.array([text]))[0], want, atol=1e-4)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    v = {"embedding": rng.normal(size=(256, language.EMBEDDING)), "bias": rng.normal(size=len(language.WIDTHS) * language.FILTERS),
         "weights": rng.normal(size=(len(language.WIDTHS) * language.FILTERS, 3)), "offset": rng.normal(size=3)}
    v |= {w: rng.normal(size=(w * language.EMBEDDING, language.FILTERS)) for w in language.WIDTHS}
    x, y, share = rng.integers(0, 256, (4, language.WINDOW)), np.array([0, 1, 2, 1]), np.array([1.0, 0.5, 2.0, 0.5])

    def loss():
        model = language.Model(("a", "b", "c"), v["embedding"], {w: v[w] for w in language.WIDTHS}, v["bias"], v["weights"], v["offset"])
        return -sum(s * plain_convolution(model, bytes(r.astype(np.uint8)))[k] for r, k, s in zip(x, y, share)) / len(y)

    grads = language._gradients(v, x, y, share)
    for name, at in (("offset", 1), ("bias", 3), ("weights", (5, 2)), ("embedding", (int(x[0, 3]), 2)), (3, (4, 1))):
        kept, step = v[name][at], 1e-5
        v[name][at] = kept + step
        up = loss()
        v[name][at] = kept - step
        down = loss()
        v[name][at] = kept
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=1e-4)


def plain_lz78(data):
    known, phrase = set(), b""
    for b in data:
        phrase += bytes([b])
        if phrase not in known:
            known.add(phrase)
            phrase = b""
    return known


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaaaa", "abracadabra " * 30, "é" * 50 + "x", "".join(map(chr, range(32, 2000)))])
def test_phrases_are_those_of_a_plain_parse(text):
    parse, data = phrases.Parse(), text.encode()
    parse.feed(data)
    begins = [0, *parse.ends]
    assert {data[a:b] for a, b in zip(begins, parse.ends)} == plain_lz78(data) and len(parse.ends) == len(plain_lz78(data))


def test_edits_of_a_table_are_the_librarys_counts(spark):
    path, rng = vocabulary("byte_bpe_50k.json"), random.Random(4)
    rows = []
    for i in range(60):
        text = None if i == 0 else " ".join(rng.choices(["alpha", "beta\n", "gamma,", "é", "x"], k=rng.randrange(200)))
        some = [None if rng.random() < 0.1 else (rng.randrange(-3, 900), None if rng.random() < 0.1 else rng.randrange(900),
                                                 None if rng.random() < 0.1 else rng.choice(["", " new words", "\n\n"])) for _ in range(rng.randrange(5))]
        rows.append((i, text, None if i == 1 else some, "old", -1))
    docs = spark.createDataFrame(rows, "doc_id int, text string, changes array<struct<start:int,end:int,text:string>>, tree string, n_tokens long")
    counted = edits.with_counts(docs, path)
    library = lambda t: len(encoder(path).library_ids([t or ""])[0]) // 4
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {r[0]: library(r[1]) for r in rows}
    done = {r.doc_id: r for r in edits.with_edits(counted, "changes", path).collect()}
    for i, text, some, *_ in rows:
        text = text or ""
        for e in some or []:
            if e is not None:
                start = min(max(0, e[0]), len(text))
                end = min(max(start, start if e[1] is None else e[1]), len(text))
                text = text[:start] + (e[2] or "") + text[end:]
        assert (done[i].text or "", done[i].n_tokens) == (text, library(text))


def test_language_stage_keeps_texts_with_a_letter(spark):
    rows = [(1, None, None, "s", 0), (2, "123 !", None, "s", 0), (3, "words", None, "s", 0), (4, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    unlabelled = pipeline.language(spark, spark.createDataFrame(rows[:3], schema), "")
    assert [(r.doc_id, r.lang) for r in unlabelled.collect()] == [(3, None)]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    kept = pipeline.language(spark, docs, FOLDER).collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()}
    labels = {r.doc_id: r.lang for r in docs.where("lang IS NOT NULL").collect()}
    assert all(r.lang == labels.get(r.doc_id, r.lang) and r.lang for r in kept)


def test_near_copy_stage_keeps_one_of_each_group(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for r in rows:
        words = (r.text or "").translate(lower).encode().split()
        sets[r.doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    group = {k: k for k in sets}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            met = len(sets[a] & sets[b])
            if met and 100 * met >= 80 * (len(sets[a]) + len(sets[b]) - met):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    kept = pipeline.jaccard(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in ids if root(k) == k]
    assert kept.columns == docs.columns


def test_packing_stage_places_every_token_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {}
    for r in pipeline.packing(spark, docs, FOLDER).orderBy("doc_id", "piece").collect():
        assert r.start == len(ids.setdefault(r.doc_id, b"")) // 4 and r.length == len(r.ids) // (4 if isinstance(r.ids, (bytes, bytearray)) else 1)
        ids[r.doc_id] += bytes(r.ids) if isinstance(r.ids, (bytes, bytearray)) else np.array(r.ids, "<u4").tobytes()
    rows = docs.collect()
    library = encoder(vocabulary("word_bpe_49k.json")).library_ids([r.text or "" for r in rows])
    assert ids == {r.doc_id: x + bytes(4) for r, x in zip(rows, library)}


def one_by_one(lengths, limits):
    """Best fit of every single piece, longest first: (tokens, documents, cost) of each sequence."""
    size, weights, opened = (limits.tokens, limits.documents, limits.attention), limits.weights, []
    for n in sorted(lengths, reverse=True):
        need = (n, 1, limits.cost(n))

        def score(held):
            left = [c - h for c, h in zip(size, held)]
            if limits.rule == "dot":
                return -sum(r / c * x / c * w for r, x, c, w in zip(left, need, size, weights))
            return sum(((r - x) / c) ** 2 * w for r, x, c, w in zip(left, need, size, weights))

        fits = [h for h in opened if all(a + b <= c for a, b, c in zip(h, need, size))]
        held = min(fits, key=score, default=None)
        if held is None:
            held = (0, 0, 0)
        else:
            opened.remove(held)
        opened.append(tuple(a + b for a, b in zip(held, need)))
    return sorted(opened)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits,binds", [
    ({"tokens": 300, "documents": 300, "attention": 90_000}, 0), ({"tokens": 300, "documents": 3, "attention": 90_000}, 1),
    ({"tokens": 320, "documents": 300, "attention": 320**2, "block": 64}, 2)])
def test_each_capacity_binds_as_if_placed_one_by_one(rule, limits, binds):
    rng = np.random.default_rng(5)
    limits = packing.Capacity(rule=rule, **limits)
    for most in (300, 40, 12):
        values = rng.integers(1, most + 1, 250)
        lengths, counts = np.unique(values, return_counts=True)
        all_lengths = np.repeat(lengths, counts)
        ranks = np.concatenate([np.arange(n) for n in counts])
        sequence, _ = packing.places(packing.plan(dict(zip(lengths.tolist(), counts.tolist())), limits), all_lengths, ranks)
        cost = np.array([limits.cost(n) for n in all_lengths.tolist()])
        held = np.stack([np.bincount(sequence, w) for w in (all_lengths, np.ones(len(cost)), cost)]).astype(int)
        assert (held.max(1) <= [limits.tokens, limits.documents, limits.attention]).all()
        plain = one_by_one(values.tolist(), limits)
        assert len(plain) == held.shape[1]
        if rule == "norm":
            assert sorted(map(tuple, held.T.tolist())) == plain
    # With short pieces it is this limit that says how many sequences there must be.
    least = held.sum(1) / [limits.tokens, limits.documents, limits.attention]
    assert least.argmax() == binds and held.shape[1] >= least[binds] > 1.5 * np.delete(least, binds).max()


def plain_best_path(word, scores, longest):
    """Pieces on the path of the largest sum of scores; of equal sums that with the longer last piece."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for size in range(1, min(end, longest) + 1):
            score = scores.get(word[end - size:end], (None, -1e6 if size == 1 else None))[1]
            if score is not None:
                options.append((best[end - size][0] + score, size))
        best.append(max(options))
    out, end = [], len(word)
    while end:
        out.insert(0, word[end - best[end][1]:end])
        end -= best[end][1]
    return out


def test_best_path_of_a_unigram_reading(spark):
    path = vocabulary("piece_bpe_32k.model")
    pieces, longest, byte_base = lattice._pieces(spark, path)
    scores = {p: (i, s) for p, i, s in lattice.piece_rows(path)}
    rng = random.Random(6)
    text = spark.read.parquet(f"{FOLDER}/documents.parquet").where("text IS NOT NULL").limit(20).collect()
    words = {f"{lattice.MARK}{w}" for r in text for w in r.text.split()[:40]}
    words |= {"".join(rng.choices("ab▁éλ字", k=rng.randrange(1, 30))) for _ in range(40)} | {"x" * 90, lattice.MARK}
    frame = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    found = {r.word: r.ids for r in lattice.encode_words(frame, pieces, longest, byte_base, "unigram").collect()}
    for w in words:
        want = [i for p in plain_best_path(w, scores, longest)
                for i in ([scores[p][0]] if p in scores else [byte_base + b for b in p.encode()])]
        assert found[w] == want
