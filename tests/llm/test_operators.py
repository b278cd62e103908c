"""Each operator against a brute-force version, and on empty, null, repeated and clashing rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from millrace.llm import jaccard, lattice, packing, passages, phrases, queries
from millrace.llm.addressable import Addressable, pack
from millrace.llm.edits import Counter
from millrace.llm.histogram_shards import histogram_shards, write_shards
from millrace.llm.language import predict, train, training_sample
from millrace.llm.nearest import nearest_neighbours
from millrace.llm.queries import registered
from millrace.llm.token_file import read_token_file, tokens_at, write_token_file
from millrace.llm.tokens import encoder, vocabulary

FOLDER = "/root/testdata/sf0.001"
ODD = ["", None, " a", "a  b", "x\n\ny\n", "a \n b", "don't 'tis I'LL x\t\ty", "<|endoftext|> a<|endoftext|>b", "\n",
       "\n\nfoo", "tab\x1fx \x1f y", "é ́x", "\0a \0 b\0.", "a.", "word " * 3000, "x" * 600]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, text_hash string, shard string"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Odd rows, and none: every registered query must run on both."""
    rows = [(i, t, "en" if i % 2 else None, "s", 0, 1, "h", "z") for i, t in enumerate(ODD)]
    rows += [rows[3], rows[3], rows[1], (None, "of no id", "de", None, None, None, None, None)]
    vectors = [(i, [float(i % 7), 1.0]) for i in range(120)] + [(100, [2.0, 1.0]), (None, [1.0, 1.0]), (7, None)]
    vectors += [(500, [0.0, 0.0]), (501, [None, 1.0]), (502, [float("nan"), 1.0]), (503, [1.0, 2.0, 3.0]), (600, [])]
    out = []
    for name, some, near in (("odd", rows, vectors), ("none", [], [])):
        folder = tmp_path_factory.mktemp(name)
        spark.createDataFrame(some, SCHEMA).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(near, "vec_id long, embedding array<float>, label int" if not near else
                              "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
        out.append(str(folder))
    return out


PER_ROW = ["op1_token_file", "op2_jaccard_join", "op3_language", "op4_edit_counts", "op5_lattice",
           "op6_fingerprints", "op7_histogram_shards"]


@pytest.mark.parametrize("name", registered())
def test_odd_and_no_rows(spark, folders, name):
    assert registered()[name](spark, folders[1]).count() == 0
    rows = registered()[name](spark, folders[0]).collect()
    if name in PER_ROW:
        assert len(rows) == len(ODD) + 4


def test_token_ids_are_the_librarys(texts):
    some = [*texts.values(), *ODD]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = encoder(vocabulary(name))
        ids, bounds = e.encode(pa.array(some, pa.string()))
        assert [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])] == e.library_ids([t or "" for t in some])


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], list(range(70000))])
def test_addressable_codes(values):
    code = Addressable(pack(np.array(values, "<u4")))
    assert code.all().tolist() == values
    some = np.random.default_rng(1).permutation(len(values))[:500]
    assert code.at(some).tolist() == [values[i] for i in some]


def test_token_file_and_random_access(spark, texts, tmp_path):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    write_token_file(frame, str(tmp_path / "f"), vocabulary("byte_bpe_50k.json"))
    rows = read_token_file(spark, str(tmp_path / "f")).orderBy("doc_id").collect()
    library = encoder(vocabulary("byte_bpe_50k.json")).library_ids
    stream = b"".join(x + bytes(4) for x in library([texts[k] for k in sorted(texts)]))
    assert b"".join(bytes(r.ids) for r in rows) == stream
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    ids = np.frombuffer(stream, "<u4")
    wanted = [0, 5, len(ids) // 2, len(ids) - 1, len(ids), -1]
    found = tokens_at(spark, str(tmp_path / "f"), spark.createDataFrame([(p,) for p in wanted], "position long"))
    assert {r.position: r.token for r in found.collect()} == {p: int(ids[p]) for p in wanted[:4]}


@pytest.mark.parametrize("percent,documents", [(80, 100), (80, 10**9), (85, 100), (85, 10**9)])
def test_similar_sets_share_a_key(percent, documents):
    rng = np.random.default_rng(percent)
    for size in (7, 8, 13, 20, 40, 90, 300):
        for _ in range(5):
            x = y = np.unique(rng.integers(1, 1 << 62, size, dtype=np.uint64))
            while True:
                y = np.delete(y, rng.integers(len(y))) if rng.random() < 0.5 else np.append(y, rng.integers(1, 1 << 62, dtype=np.uint64))
                y = np.unique(y)
                met = len(np.intersect1d(x, y))
                if 100 * met < percent * (len(x) + len(y) - met):
                    break
                keys = [{int(k): i < f[1] for f in jaccard.keys_of(s, percent, documents) for i, k in enumerate(f[0])} for s in (x, y)]
                assert any(keys[0][k] or keys[1][k] for k in keys[0].keys() & keys[1].keys())


def test_near_copies(spark):
    rng, words = random.Random(5), [f"w{i}" for i in range(400)]
    base = [rng.choices(words, k=rng.randint(3, 200)) for _ in range(30)]
    texts = {}
    for i in range(300):
        t = list(base[i % 30])
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts[i] = " ".join(t)
    sets = {k: {tuple(t.split()[j:j + 5]) for j in range(max(1, len(t.split()) - 4))} for k, t in texts.items()}
    least = dict(zip(texts, texts))
    links = [(a, b) for a in texts for b in texts if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    rows = jaccard.near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in rows} == {k: (least[k], len(sets[k])) for k in texts}
    assert sum(r.kept for r in rows) == len(set(least.values()))


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    guessed = predict(docs.where(held), train(training_sample(docs.where(~held), per_language=60)))
    right = guessed.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_edits():
    rng, counter = random.Random(3), Counter(vocabulary("byte_bpe_50k.json"))
    library = encoder(vocabulary("byte_bpe_50k.json")).library_ids
    for _ in range(300):
        text = "".join(rng.choice(["a", "bc", " ", "  ", "\n", "'s", "1", ".", "é", "\t", "don't"]) for _ in range(rng.randint(0, 300)))
        tree = counter.tree(text)
        for _ in range(4):
            i, new = rng.randint(0, len(text) + 2), "".join(rng.choice("a \n'.s") for _ in range(rng.randint(0, 40)))
            text, tree, _ = counter.edit(text, tree, i, i + rng.randint(0, 30), new)
            assert (tree.tokens[1], tree.chars[1]) == (len(library([text])[0]) // 4, len(text))


def test_lattice_is_the_librarys(spark, texts):
    path = vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    some = dict(enumerate([*list(texts.values())[:40], *[t for t in ODD if t is None or len(t) < 4000]]))
    frame = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    rows = lattice.encode(frame, path).withColumn("again", lattice.decoded("ids", path)).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {k: library.encode(t or "") for k, t in some.items()}
    assert {r.doc_id: r.again for r in rows} == {k: t or "" for k, t in some.items()}


def test_fingerprints(spark, texts):
    rows = {r.doc_id: r for r in registered()["op6_fingerprints"](spark, FOLDER).collect()}
    order = sorted(texts, reverse=True)
    for i, k in enumerate(order):
        text, other = texts[k], texts[order[(i + 1) % len(order)]]
        n = len(text) // 3
        edited = text[:len(text) - n] + other[:n]
        a, b, c = map(phrases.fingerprint, (text, edited, other))
        assert (rows[k].n_chars, rows[k].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (rows[k].fingerprint, rows[k].edited_fingerprint) == (phrases.as_text(a), phrases.as_text(b))
        assert (rows[k].near_edited, rows[k].near_next) == (phrases.likeness(a, b), phrases.likeness(a, c))


def test_sample_is_bounded_for_repeated_ids(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 1, F.lit("always the same words")).otherwise(F.concat(F.lit("text number "), "id")).alias("text"))
    sample = training_sample(rows, per_language=50)
    assert 50 <= len(sample) <= 200
    nulls = rows.withColumn("doc_id", F.lit(None).cast("long")).withColumn("_label", F.lit("x"))
    assert 50 <= len(training_sample(nulls, per_language=50)) <= 200
    assert training_sample(rows.where("lang = 'none'")) == []


def test_shards_of_one_hot_group(spark, tmp_path):
    frame = spark.createDataFrame([(i, "same" if i % 3 == 0 else f"t{i}", "clash", 1) for i in range(3000)], "i long, t string, shard string, slot int")
    out = histogram_shards(frame, F.lit(1), F.col("t"), F.col("i"))
    rows = out.collect()
    counts = np.bincount([r.shard for r in rows])
    assert len(rows) == 3000 and counts.min() >= 374 and counts.max() <= 376 and out.columns == ["i", "t", "shard", "slot"]
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert sum(len({r.shard for r in rows if r.t == t}) > 1 for t in {r.t for r in rows}) == 1  # only the hot group is cut
    write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3000


def test_shards_of_equal_rows(spark):
    """Rows that nothing tells apart are cut too, by a stored number."""
    frame = spark.createDataFrame([(7 if i % 4 else i, "same" if i % 4 else f"t{i}") for i in range(2000)], "i long, t string")
    rows = histogram_shards(frame, F.lit(1), F.col("t"), F.col("i")).collect()
    counts = np.bincount([r.shard for r in rows])
    assert len(rows) == 2000 and counts.min() >= 249 and counts.max() <= 251
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_outputs_hold_whole_documents(spark, texts, monkeypatch):
    """op7's shards have the texts, and op10's stored pieces the ids."""
    written = []
    monkeypatch.setattr(queries, "write_shards", lambda out, path: (written.append(path), write_shards(out, path)))
    rows = registered()["op7_histogram_shards"](spark, FOLDER).collect()
    back = spark.read.parquet(written[0]).select("doc_id", "text", "shard", "slot").collect()
    assert {r.doc_id: r.text for r in back} == texts
    assert sorted((r.doc_id, r.shard, r.slot) for r in back) == sorted((r.doc_id, r.shard, r.slot) for r in rows)
    stored = []
    monkeypatch.setattr(packing, "stage", lambda frame, label, stage=packing.stage: stored.append(stage(frame, label)) or stored[-1])
    crc = {(r.doc_id, r.piece): r.ids_crc32 for r in registered()["op10_packing"](spark, FOLDER).collect()}
    assert {(r.doc_id, r.piece): zlib.crc32(r.ids) for r in stored[0].collect()} == crc


def test_repeated_passages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    first, shared = {}, {}
    for k in sorted(texts):
        words, own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[k])), set()
        for i in range(len(words) - 49):
            run = tuple(words[i:i + 50])
            if first.get(run, k) != k:
                shared.setdefault(k, set()).update(range(i, i + 50))
            own.add(run)
        for run in own:
            first.setdefault(run, k)
    found = {}
    for r in passages.repeated_passages(docs).collect():
        found.setdefault(r.doc_id, set()).update(range(r.first_word, r.end_word))
        assert r.same_words >= passages.MIN_SAME * (r.end_word - r.first_word)
    assert not [k for k, v in shared.items() if v - found.get(k, set())]
    cut = {r.doc_id: r.text for r in passages.without_repeats(docs).collect()}
    assert all(cut[k] == t for k, t in texts.items() if k not in found)
    assert all(len(cut[k].split()) == len(texts[k].split()) - len(v) for k, v in found.items())


def fresh(n, mark):
    return [f"{mark}{i}" for i in range(n)]


@pytest.fixture(scope="module")
def two_shared(spark):
    """Pairs of texts that share two passages, of so many words and so many own words between."""
    rows, places = [], {}
    for k, (n, own) in enumerate([(60, 35), (60, 60), (60, 100), (300, 100)]):
        one, two = fresh(n, f"a{k}x"), fresh(n, f"b{k}x")
        for i in (2 * k, 2 * k + 1):
            rows.append((i, " ".join([*fresh(30, f"p{i}x"), *one, *fresh(own, f"q{i}x"), *two, *fresh(30, f"r{i}x")])))
        places[2 * k + 1] = [(30, 30 + n), (30 + n + own, 30 + 2 * n + own)]
    return spark.createDataFrame(rows, "doc_id long, text string"), places


def test_two_passages_of_one_pair(two_shared):
    docs, places = two_shared
    found = {}
    for r in passages.repeated_passages(docs).collect():
        assert (r.source_id, r.source_first_word, r.source_end_word) == (r.doc_id - 1, r.first_word, r.end_word)
        found.setdefault(r.doc_id, []).append((r.first_word, r.end_word))
    assert {k: sorted(v) for k, v in found.items()} == places


def test_own_words_between_passages_stay(two_shared):
    docs, places = two_shared
    cut = {r.doc_id: r.text.split() for r in passages.without_repeats(docs).collect()}
    for r in docs.collect():
        gone = {i for lo, hi in places.get(r.doc_id, []) for i in range(lo, hi)}
        assert cut[r.doc_id] == [w for i, w in enumerate(r.text.split()) if i not in gone]


def test_no_passage_holds_seven_other_words_in_a_row():
    at = np.concatenate([np.arange(300), np.arange(306, 600), np.arange(607, 900)])  # gaps of 6 and 7 words
    assert sorted(passages.segments(at, at, 50, 0.8)) == [(0, 600, 0, 600, 594), (607, 900, 607, 900, 293)]


def changed(words, rng, substituted, inserted, deleted):
    words = list(words)
    for i in rng.sample(range(len(words)), substituted):
        words[i] = f"s{rng.random()}"
    for _ in range(inserted):
        words.insert(rng.randrange(1, len(words)), f"i{rng.random()}")
    for _ in range(deleted):
        del words[rng.randrange(1, len(words) - 1)]
    return words


EDITS = {(5, 0, 0): 100, (6, 0, 0): 100, (9, 0, 0): 97, (3, 1, 1): 100, (0, 3, 3): 100, (4, 2, 2): 97, (12, 0, 0): 95}


def test_recall_of_changed_passages(spark):
    """Least number of 100 passages of 60 words found after substitutions, insertions and deletions."""
    rng, rows, kinds = random.Random(5), [], {}
    for kind in EDITS:
        for _ in range(100):
            i = len(rows)
            passage = fresh(60, f"a{i}x")
            for k, words in ((i, passage), (i + 1, changed(passage, rng, *kind))):
                rows.append((k, " ".join([*fresh(40, f"p{k}x"), *words, *fresh(40, f"q{k}x")])))
            kinds[i + 1] = kind
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.source_id) for r in passages.repeated_passages(docs).collect()}
    recall = {kind: sum((k, k - 1) in found for k, x in kinds.items() if x == kind) for kind in EDITS}
    print(recall)
    assert all(recall[kind] >= least for kind, least in EDITS.items()), recall


def test_passages_of_fragments_seen_before(spark):
    """A passage of two documents whose parts occur earlier, each in another."""
    rows = []
    for t in range(40):
        one, two = fresh(30, f"a{t}x"), fresh(30, f"b{t}x")
        for k, words in enumerate([one, two, [*one, *two], [*one, *two]]):
            i = 4 * t + k
            rows.append((i, " ".join([*fresh(20, f"p{i}x"), *words, *fresh(20, f"q{i}x")])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r.doc_id, r.first_word, r.end_word, r.source_id) for r in passages.repeated_passages(docs).collect()]
    assert sorted(found) == [(4 * t + 3, 20, 80, 4 * t + 2) for t in range(40)]


def test_chains_leave_the_line_for_no_outlier():
    best = passages.chains(np.array([0, 9, 18, 27]), np.array([100, 109, 5, 127]))
    assert sorted(map(len, best)) == [1, 3]


@pytest.mark.parametrize("rule,documents", [("norm", 2048), ("dot", 2048), ("norm", 4), ("dot", 4)])
def test_packing_plan(rule, documents):
    rng = np.random.default_rng(2)
    counts = {int(n): int(rng.integers(1, 300)) for n in rng.integers(1, 2049, 400)}
    lengths = np.repeat(list(counts), list(counts.values()))
    ranks = np.concatenate([np.arange(n) for n in counts.values()])
    limits = packing.Capacity(documents=documents, rule=rule)
    sequence, offset = packing.places(packing.plan(counts, limits), lengths, ranks)
    held = np.bincount(sequence, weights=lengths)
    assert held.max() <= 2048 and np.bincount(sequence).max() <= documents
    assert len(held) <= 1.1 * max(lengths.sum() / 2048, len(lengths) / documents) + 1
    order = np.lexsort((offset, sequence))
    starts = np.concatenate([[0], np.cumsum(lengths[order])[:-1]]) - np.repeat(np.cumsum(held) - held, np.bincount(sequence))
    assert (starts == offset[order]).all()


def test_packed_pieces(spark, texts):
    rows = {(r.doc_id, r.piece): r for r in registered()["op10_packing"](spark, FOLDER).collect()}
    for k, ids in zip(texts, encoder(vocabulary("word_bpe_49k.json")).library_ids(list(texts.values()))):
        ids += bytes(4)
        for p in range(-(-len(ids) // 8192)):
            part, row = ids[8192 * p:8192 * (p + 1)], rows.pop((k, p))
            assert (row.start, row.length, row.ids_crc32) == (2048 * p, len(part) // 4, zlib.crc32(part))
    assert not rows


def test_nearest_with_vectors_of_two_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3 if i % 5 else 4).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "v long, e array<double>")
    found = nearest_neighbours(frame.where("v % 20 = 0"), frame, "v", "e", 5).collect()
    for q, x in rows[::20]:
        want = sorted((float(np.linalg.norm(np.subtract(x, y))), v) for v, y in rows if v != q and len(y) == len(x))[:5]
        got = sorted((r.rank, r.v, r.score) for r in found if r.query_id == q)
        assert [g[1] for g in got] == [v for _, v in want] and np.allclose([g[2] for g in got], [d for d, _ in want])
