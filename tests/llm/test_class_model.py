"""The class model against plain dictionaries; the exchange against likelihoods counted anew."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import class_model, exchange

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "never seen wörds Ünd"), (None, "of no id"), (5004, "w " * 5000),
       (5005, "x" * 600), (5006, "A a\x0bB\x1fb")]


def tokens(text):
    words = (text or "").translate(LOWER).encode().split()
    return [*words, None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [(r.doc_id, r.text) for r in docs.collect()]
    return found + ODD + found[:5]


def scored(spark, rows):
    docs = spark.createDataFrame([(*r, 0.0, "n") for r in rows], "doc_id long, text string, score double, block string")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return class_model.class_scores(docs.repartition(3), fold).collect()


@pytest.mark.parametrize("size,block", [(8192, 1 << 20), (50, 500)])
def test_scores(spark, rows, monkeypatch, size, block):
    monkeypatch.setattr(class_model, "CORE", size)
    monkeypatch.setattr(class_model, "BLOCK_WORDS", block)
    kept = {}
    real = class_model._texts
    monkeypatch.setattr(class_model, "_texts", lambda *a: kept.update(vocabulary=a[1], model=a[2], core=a[3]) or real(*a))
    counts = Counter(t for k, text in rows if not held(k) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    got = scored(spark, rows)
    assert len(got) == len(rows)
    model = kept["model"]
    assert (model.tokens, model.words) == (n, v)
    vocabulary = {r.word: (r.n, r["class"]) for r in kept["vocabulary"].collect()}
    core = kept["core"]
    vocabulary |= {int(w): (int(core.n[i]), int(core.of[i])) for w, i in zip(core.words.view(np.int64), core.numbers)}
    assert len(vocabulary) == v - 1
    hashed = class_model.words_of(class_model.pa.array([t.decode() for t in counts if t is not None])).hashes.view(np.int64).tolist()
    known = {t: vocabulary[x] for t, x in zip((t for t in counts if t is not None), hashed)}
    assert all(known[t][0] == counts[t] for t in known)
    known[None] = (counts[None], exchange.END)
    # A proper distribution after every class: all known words, and all unseen ones as one.
    by_class = np.zeros(class_model.CLASSES)
    for c, k in known.values():
        by_class[k] += 10 ** model.emission(np.array([c]), np.array([k]))[0]
    assert np.allclose(10 ** model.follows @ by_class + 10 ** model.unseen, 1)
    want = []
    for k, text in rows:
        base = score = 0.0
        last = exchange.END
        for t in tokens(text):
            base += math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1)))
            if t in known:
                c, kind = known[t]
                score += model.follows[last, kind] + model.emission(np.array([c]), np.array([kind]))[0]
                last = kind
            else:
                score += model.unseen[last]
                last = class_model.CLASSES
        want.append((k, held(k), len(tokens(text)), sum(t in known for t in tokens(text)), n, base, score))
    for g, w in zip(sorted(map(tuple, got), key=lambda r: (r[0] is None, r)), sorted(want, key=lambda r: (r[0] is None, r))):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:])
    fresh = [r for r in got if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)


def test_nothing_to_learn_from(spark):
    held_only = [(k, "a b") for k in range(40) if held(k)]
    assert {(r.score, r.base_score, r.train_tokens, r.n_known) for r in scored(spark, held_only)} == {(0.0, 0.0, 0, 0)}
    assert scored(spark, []) == []


def test_moves_raise_the_likelihood():
    rng = np.random.default_rng(3)
    words, classes = 60, 7
    kind = rng.integers(0, 5, words)
    likely = rng.random((5, 5)) ** 6
    text = [0]
    for _ in range(4000):
        p = likely[kind[text[-1]]][kind] + 1e-9
        text.append(int(rng.choice(words, p=p / p.sum())))
    text = 1 + np.array(text)
    of = exchange.first_classes(words, classes)

    def pairs(of):
        out = np.zeros((classes + 1, classes + 1))
        np.add.at(out, (of[text[:-1]], of[text[1:]]), 1)
        return out

    table, before = exchange.Exchange(pairs(of)), exchange.likelihood(pairs(of))
    for w in range(1, words + 1):
        sides, itself = [], 0
        for here, there in ((text[1:], text[:-1]), (text[:-1], text[1:])):
            other = there[here == w]
            itself = (other == w).sum()
            sides.append(np.bincount(of[other[other != w]], minlength=classes + 1).astype(float))
        best = []
        for c in range(1, classes):
            trial = of.copy()
            trial[w] = c
            best.append(exchange.likelihood(pairs(trial)))
        of[w] = table.move(int(of[w]), *sides, int(itself))
        assert exchange.likelihood(pairs(of)) == pytest.approx(max(best))
        assert np.allclose(table.pairs, pairs(of))
    assert exchange.likelihood(pairs(of)) > before


def test_class_pairs_of_many_texts_take_little_memory():
    """One batch of 2 million tokens: pairs within texts, in far less than the batch's numbers take as long integers."""
    import tracemalloc

    of = np.random.default_rng(1).integers(1, class_model.CLASSES, (4000, 500), np.uint8)
    of[:, -1] = exchange.END
    batch = class_model.pa.RecordBatch.from_arrays(
        [class_model.pa.array([row.tobytes() for row in of], class_model.pa.binary())], names=["classes"])
    before = np.hstack([np.full((len(of), 1), exchange.END, np.uint8), of[:, :-1]])
    wanted = Counter((before.astype(int) * class_model.CLASSES + of).ravel().tolist())
    tracemalloc.start()
    got = list(class_model._class_pairs(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {r["pair"]: r["n"] for part in got for r in part.to_pylist()} == wanted
    assert peak < of.size * 8


def test_moves_at_once_are_those_of_single_words():
    """One word in a batch goes where it goes alone and moves the counts alike."""
    rng = np.random.default_rng(5)
    words, classes = 40, 9
    text = 1 + rng.integers(0, words, 3000) // rng.integers(1, 6, 3000)
    of = exchange.first_classes(words, classes)
    pairs = np.zeros((classes + 1, classes + 1))
    np.add.at(pairs, (of[text[:-1]], of[text[1:]]), 1)
    moved = 0
    for w in np.unique(text):
        sides, itself = [], 0
        for here, there in ((text[1:], text[:-1]), (text[:-1], text[1:])):
            other = there[here == w]
            itself = int((other == w).sum())
            sides.append(of[other[other != w]])
        one, many = exchange.Exchange(pairs), exchange.Exchange(pairs)
        want = one.move(int(of[w]), *[np.bincount(c, minlength=classes + 1).astype(float) for c in sides], itself)
        entries = [(np.zeros(len(c), int), c, np.ones(len(c), int)) for c in sides]
        assert many.moves(of[[w]], *entries, np.array([itself])).tolist() == [want]
        assert np.allclose(one.pairs, many.pairs) and np.allclose(one.first, many.first) and np.allclose(one.second, many.second)
        moved += want != of[w]
    assert moved > 5


def test_words_outside_the_core_move_too(spark, rows, monkeypatch):
    """With a core of 50, the rounds' counts of class pairs are those of the texts, and the likelihood rises well beyond the core's own rounds."""
    monkeypatch.setattr(class_model, "CORE", 50)
    kept, seen = {}, []
    real, pairs = class_model._texts, class_model._pairs
    monkeypatch.setattr(class_model, "_texts", lambda *a: kept.update(vocabulary=a[1], core=a[3]) or real(*a))
    monkeypatch.setattr(class_model, "_pairs", lambda *a: seen.append(pairs(*a)) or seen[-1])
    scored(spark, rows)
    core = kept["core"]
    of = {int(w): int(core.of[i]) for w, i in zip(core.words.view(np.int64), core.numbers)}
    of |= {r.word: r["class"] for r in kept["vocabulary"].collect()}
    flat = [t for k, text in rows if not held(k) for t in tokens(text)]
    words = [t for t in dict.fromkeys(flat) if t is not None]
    hashed = class_model.words_of(class_model.pa.array([t.decode() for t in words])).hashes.view(np.int64).tolist()
    kinds = {None: exchange.END} | {t: of[h] for t, h in zip(words, hashed)}
    classes = np.array([exchange.END] + [kinds[t] for t in flat])
    found = np.zeros((class_model.CLASSES + 1,) * 2)
    np.add.at(found, (classes[:-1], classes[1:]), 1)
    reached = exchange.likelihood(found)
    assert any(np.array_equal(found, p) for p in seen)
    assert reached > 0.95 * max(exchange.likelihood(p) for p in seen[:class_model.ROUNDS + 1])  # both are negative
