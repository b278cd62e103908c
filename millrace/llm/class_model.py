"""Class-based bigram language model over a corpus, learnt and applied by Spark.

p(word | words before) = p(class | class before) * p(word | class). Every word has one class, by
exchange clustering (see ``exchange``). The most frequent words, the core, whose classes every task holds, begin:
they move between classes in rounds, each on one row of its neighbours' counts. Then every other word is put by
the same criterion into a class, and in as many rounds again all words move, however rare. A word outside the core
tells its class to the words outside the core beside it, in messages that are counted by receiver. Class transitions are interpolated with the
classes' own shares by the number of different followers (Witten and Bell); a class gives 0.1 of a word's
count to the words it has never seen. All probabilities after a class, with all unseen words as one, sum to 1.

Texts are read once and stored as blocks of words, each with the list of its different words. All that
moves between machines are these lists, messages and counts; nothing is gathered but the core, its counts beside
each class, the class tables and one row of sums.

Words are told apart by 64-bit hashes of their bytes: among a billion different words some two may be taken
for one with a chance of 3 %.

Defined cases: A-Z count as a-z; null and empty texts are their end alone; an end is a token of its own class; a null
id is learnt from; repeated rows are learnt from and scored each by itself; with nothing to learn from all scores are 0; ties of
frequency go to the smaller hash, ties of classes to the smaller number; an empty table gives no rows; other columns
are not used. A text and the words of a block are worked on in one task, in memory of some 50 bytes a byte of text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.exchange import END, Exchange, first_classes, likelihood
from millrace.llm.words import in_slices, words_of
from millrace.sources.staging import new_location, stage

CLASSES = 64
#: Words whose classes every task holds; all others take part in the exchange by messages.
CORE = 8192
ROUNDS = 5
#: What a word counts that was never seen, and what is added to every count.
ADDED = 0.1
BLOCK_WORDS = 1 << 20
_SLICE = 1 << 20  # bytes of text that are worked on at once
_UNKNOWN = 255  # class of words that were never seen in training
_OTHER = CLASSES  # class of words outside the core, while it is clustered
_MERGED = 1 << 20  # different pairs that a task holds before it passes them on
_BUCKET = 1 << 18  # words of blocks' lists for each bucket of words
_MOST_BUCKETS = 100_000
_TOGETHER = 128  # words outside the core that move at once
_PART = 1 << 15  # numbers of a table that travel in one row
_STEPS = 1 << 18  # tokens whose steps from class to class are worked on at once

_BLOCK = "block long, ids array<long>, held array<boolean>, ends array<int>, codes binary, size int, words binary, n_words int, counts binary"


def _record(schema: str, columns: list, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=[x.split()[0] for x in schema.split(", ")])


def _squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, their first bytes before their second ones, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unsqueeze(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True) if size else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32

    def block(ids, held, sizes, hashes):
        hashes, sizes = np.concatenate(hashes), np.array(sizes, np.int64)
        words, codes = np.unique(hashes, return_inverse=True)
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        codes = rank[codes]
        counts = np.bincount(codes[np.repeat(~np.array(held), sizes)], minlength=len(words))
        columns = [[number], [ids], [held], [np.cumsum(sizes)], [_squeeze(codes)], [len(codes)],
                   [words[order].astype("<u8").tobytes()], [len(words)], [_squeeze(counts)]]
        return _record(_BLOCK, columns, [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()),
                                         pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary()])

    for batch in batches:
        keys, out = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
        ids, held, sizes, hashes = [], [], [], []
        for lo, texts in in_slices(batch.column("text"), _SLICE):
            found = words_of(texts)
            ids += keys[lo:lo + len(texts)]
            held += out[lo:lo + len(texts)]
            sizes += np.diff(found.first).tolist()
            hashes.append(found.hashes)
            if sum(map(len, hashes)) >= BLOCK_WORDS:
                yield block(ids, held, sizes, hashes)
                number += 1
                ids, held, sizes, hashes = [], [], [], []
        if ids:
            yield block(ids, held, sizes, hashes)
            number += 1


@dataclass
class _Block:
    """A stored block, its words' codes by place in its own list."""

    row: dict

    def __post_init__(self):
        row = self.row
        self.n_words = row["n_words"]
        self.words = np.frombuffer(row.get("words", b""), "<u8")
        self.ends = np.array(row["ends"], np.int64)
        self.sizes = np.diff(self.ends, prepend=0)
        self.held = np.array(row["held"], bool)

    @property
    def counts(self) -> np.ndarray:
        return _unsqueeze(self.row["counts"], self.n_words)

    def tokens(self, numbers: np.ndarray, end: int, train: bool = True) -> np.ndarray:
        """Numbers of the words of all texts (of those to learn from), an end before and after each."""
        codes = _unsqueeze(self.row["codes"], self.row["size"])
        sizes = self.sizes
        if train:
            codes, sizes = codes[np.repeat(~self.held, sizes)], sizes[~self.held]
        out = np.full(len(codes) + len(sizes) + 1, end, np.int64)
        out[np.arange(len(codes)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)] = numbers[codes]
        return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        words, counts = np.frombuffer(row["words"], "<u8"), _unsqueeze(row["counts"], len(row["words"]) // 8)
        often = counts >= max(1, row["size"] // (4 * CORE))
        yield _record("word, n", [words[often].view(np.int64), counts[often]], [pa.int64(), pa.int64()])


@dataclass
class _Core:
    """The core's words by hash; numbers are 1 for the most frequent one and so on, 0 for ends."""

    words: np.ndarray  # sorted
    numbers: np.ndarray
    n: np.ndarray | None = None  # how often each number occurs in the training texts
    of: np.ndarray | None = None  # its class

    def numbered(self, words: np.ndarray) -> np.ndarray:
        """The core numbers of some words; the others have the number after the last."""
        if not len(self.words):
            return np.ones(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.numbers[at], len(self.words) + 1)


def _core_of(blocks: DataFrame) -> _Core:
    """The most frequent words, by what each block's frequent ones sum up to.

    This decides only which words' classes every task holds; the others move between classes as well.
    """
    top = (blocks.select("size", "words", "counts").mapInArrow(_frequent, "word long, n long").groupBy("word")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(CORE).select("word").collect())
    words = np.array([r.word for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    return _Core(words[order], 1 + order)


_NEIGHBOURS = "word int, before binary, n_before binary, after binary, n_after binary"


def _neighbours_of(blocks: DataFrame, core: _Core) -> DataFrame:
    """One row for each core word, the ends and the other words as one: what stood before and after, how often.

    A row has as many entries as the core at most.
    """
    k = len(core.words) + 2
    types = [pa.int32(), *[pa.binary()] * 4]

    def packed(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, second = np.divmod(keys, k)
        sides = []
        for word, other in ((second, first), (first, second)):
            order = np.argsort(word, kind="stable")
            bounds = np.searchsorted(word[order], np.arange(k + 1))
            sides.append((other[order].astype("<i4"), n[order].astype("<i8"), bounds))
        rows = []
        for w in np.union1d(first, second).tolist():
            rows.append((w, *[x[b[w]:b[w + 1]].tobytes() for o, m, b in sides for x in (o, m)]))
        for lo in range(0, len(rows), 1000):
            yield _record(_NEIGHBOURS, list(zip(*rows[lo:lo + 1000])), types)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for row in _rows(batches):
            block = _Block(row)
            tokens = block.tokens(core.numbered(block.words), 0)
            new, times = np.unique(tokens[:-1] * k + tokens[1:], return_counts=True)
            keys, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([n, times])).astype(np.int64)
            if len(keys) > _MERGED:
                yield from packed(keys, n)
                keys, n = keys[:0], n[:0]
        if len(keys):
            yield from packed(keys, n)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, sums = None, None

        def merged():
            parts = [x for s in sums for x in (np.flatnonzero(s).astype("<i4"), s[s > 0].astype("<i8"))]
            return _record(_NEIGHBOURS, [[word], *[[x.tobytes()] for x in parts]], types)

        for row in _rows(batches):
            if row["word"] != word:
                if word is not None:
                    yield merged()
                word, sums = row["word"], np.zeros((2, k), np.int64)
            for side, (o, m) in zip(sums, (("before", "n_before"), ("after", "n_after"))):
                side[np.frombuffer(row[o], "<i4")] += np.frombuffer(row[m], "<i8")
        if word is not None:
            yield merged()

    parts = blocks.mapInArrow(count, _NEIGHBOURS)
    return stage(parts.repartition("word").sortWithinPartitions("word").mapInArrow(merge, _NEIGHBOURS), "neighbours")


def _pairs(neighbours: DataFrame, of: np.ndarray, beside: _Beside | None = None) -> np.ndarray:
    """Counts of class pairs: at most as many numbers from every task as there are pairs of classes.

    Words outside the core count as one class of their own, or by their classes as told by ``beside``.
    """
    k = CLASSES + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for row in _rows(batches):
            before = of[np.frombuffer(row["before"], "<i4")]
            np.add.at(total, before * k + of[row["word"]], np.frombuffer(row["n_before"], "<i8"))
        seen = np.flatnonzero(total)
        yield _record("pair, n", [seen, total[seen]], [pa.int64(), pa.int64()])

    rows = (neighbours.select("word", "before", "n_before").mapInArrow(count, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).collect())
    pairs = _table(rows, k)
    if beside is not None:
        pairs[_OTHER] = pairs[:, _OTHER] = 0
        pairs += beside.rest
        np.add.at(pairs, of[:-1], beside.core[0])
        np.add.at(pairs.T, of[:-1], beside.core[1])
    return pairs


def _table(rows: list, k: int) -> np.ndarray:
    pairs = np.zeros(k * k, np.int64)
    pairs[[r.pair for r in rows]] = [r.n for r in rows]
    return pairs.reshape(k, k)


def _round(neighbours: DataFrame, of: np.ndarray, pairs: np.ndarray, beside: _Beside | None = None) -> np.ndarray:
    """Every core word is moved once; within a task one after the other."""
    last = len(of) - 1

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, new = Exchange(pairs), of.copy()
        for row in _rows(batches):
            w = row["word"]
            if w in (0, last):
                continue
            sides, itself = [], 0
            for side, (o, m) in enumerate((("before", "n_before"), ("after", "n_after"))):
                other, n = np.frombuffer(row[o], "<i4"), np.frombuffer(row[m], "<i8")
                itself = int(n[other == w].sum())
                sides.append(np.bincount(new[other], n * (other != w), CLASSES + 1))
                if beside is not None:
                    sides[-1][_OTHER] = 0
                    sides[-1] += beside.core[1 - side][w]
            new[w] = table.move(int(new[w]), *sides, itself)
            yield _record("word, class", [[w], [new[w]]], [pa.int64(), pa.int64()])

    moved, out = neighbours.mapInArrow(move, "word long, class long").collect(), of.copy()
    out[[r["word"] for r in moved]] = [r["class"] for r in moved]
    return out


def _clustered(neighbours: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of ends, core words and all others as one, and the counts of class pairs: the best of all rounds."""
    of = first_classes(words, CLASSES)
    pairs = _pairs(neighbours, of)
    best = (likelihood(pairs), of, pairs)
    for _ in range(ROUNDS if words else 0):
        of = _round(neighbours, of, pairs)
        pairs = _pairs(neighbours, of)
        best = max(best, (likelihood(pairs), of, pairs), key=lambda x: x[0])
    return best[1], best[2]


_SEEN = "word long, seen binary, links binary"
_NEAR = np.dtype([("around", "<i4"), ("n", "<i4")])
_FAR = np.dtype([("other", "<i8"), ("tag", "<i4")])  # n and, in the last bit, the side
_BEFORE, _AFTER, _ITSELF = 0, 1, 2
_HEARD = "word long, told long"  # n and, in the last 8 bits, a class before, a class after, or a word's own class
_KINDS = CLASSES + 1


@dataclass
class _Beside:
    """How often words outside the core, by class, stand beside others."""

    core: np.ndarray  # before: core word, class; after: core word, class
    rest: np.ndarray  # class, class after it: both of words outside the core


def _bucketed(rows: DataFrame, label: str, buckets: int) -> DataFrame:
    """Rows that are dealt by word, stored so that they meet others of the same word without moving again."""
    spark, name = rows.sparkSession, f"{label}_{uuid.uuid4().hex[:12]}"
    (rows.write.format("parquet").option("path", new_location(spark, label)).option("compression", "zstd")
     .bucketBy(buckets, "word").sortBy("word").saveAsTable(name))
    return spark.table(name)


def _outside(blocks: DataFrame, core: _Core, buckets: int) -> DataFrame:
    """Every word of the training texts outside the core, stored: how often it occurs, and the words beside it.

    ``seen`` has core words by number and the word itself, ``links`` the other words outside the core.
    """
    last = len(core.words) + 1

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = _Block(row)
            size = block.n_words
            number, word = np.append(core.numbered(block.words), 0), block.tokens(np.arange(size), size)
            hashes = np.append(block.words.view(np.int64), 0)
            at, near, links = np.flatnonzero(number[word] == last), [], []
            for side, step in ((_BEFORE, -1), (_AFTER, 1)):
                keys, n = np.unique(word[at] * (size + 1) + word[at + step], return_counts=True)
                own, other = np.divmod(keys, size + 1)
                itself, far = own == other, number[other] == last
                sides = np.where(itself, _ITSELF, side)
                use = ~far | itself if side == _BEFORE else ~far
                around = np.where(itself, 0, number[other]) + sides * last
                near.append((own[use], np.rec.fromarrays([around[use], n[use]], dtype=_NEAR)))
                use = far & ~itself
                links.append((own[use], np.rec.fromarrays([hashes[other[use]], n[use] * 2 + side], dtype=_FAR)))
            words = np.unique(word[at])
            columns = [_binaries(words, *map(np.concatenate, zip(*x))) for x in (near, links)]
            yield _record(_SEEN, [hashes[words], *columns], [pa.int64(), pa.binary(), pa.binary()])

    rows = blocks.mapInArrow(contexts, _SEEN).repartition(buckets, "word")
    return _bucketed(rows.groupBy("word").agg(F.collect_list("seen").alias("seen"), F.collect_list("links").alias("links")),
                     "outside", buckets)


def _binaries(words: np.ndarray, of: np.ndarray, entries: np.ndarray) -> pa.Array:
    """The entries of each of the sorted words in one value."""
    order = np.argsort(of, kind="stable")
    bounds = np.append(np.searchsorted(of[order], words), len(of)) * entries.dtype.itemsize
    data = np.ascontiguousarray(entries[order]).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(bounds.astype("<i4").tobytes()), pa.py_buffer(data)])


def _entries(batch: pa.RecordBatch, column: str, kind: np.dtype) -> list[np.ndarray]:
    """Rows and fields of all entries that a column's lists of binaries hold."""
    lists = batch.column(column)
    parts = lists.flatten().cast(pa.large_binary())
    bounds = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset:parts.offset + len(parts) + 1]
    data = (parts.buffers()[2] or b"")[bounds[0]:bounds[-1]] if len(parts) else b""
    found = np.frombuffer(data, kind)
    at = np.append(0, np.cumsum(np.diff(np.asarray(lists.offsets))))  # a row's first part
    row = np.repeat(np.arange(batch.num_rows), np.diff(bounds[at] if len(parts) else at * 0) // kind.itemsize)
    return [row, *[found[f].astype(np.int64) for f in kind.names]]


def _around(batch: pa.RecordBatch, of: np.ndarray):
    """Core words before and after a batch's words, as (row, number, n) each, and how often each word follows itself."""
    word, around, n = _entries(batch, "seen", _NEAR)
    side, number = np.divmod(around, len(of) - 1)
    return *[(word[side == s], number[side == s], n[side == s]) for s in (_BEFORE, _AFTER)], np.bincount(
        word[side == _ITSELF], n[side == _ITSELF], batch.num_rows)


def _classed(batch: pa.RecordBatch):
    """The words' own classes, and classes of words outside the core before and after them, as (row, class, n) each."""
    lists = batch.column("heard")
    told = np.asarray(lists.flatten())
    word, n = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets))), told >> 8
    kind, of = np.divmod(told & 255, _KINDS)
    own = np.zeros(batch.num_rows, np.int64)
    own[word[kind == 2]] = of[kind == 2]
    return own, *[(word[kind == s], of[kind == s], n[kind == s]) for s in (_BEFORE, _AFTER)]


def _both(one: tuple, two: tuple) -> tuple:
    return tuple(np.concatenate(x) for x in zip(one, two))


def _told(batch: pa.RecordBatch, own: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The words' classes, to themselves and to the words outside the core beside them."""
    word, other, tag = _entries(batch, "links", _FAR)
    beside = np.where(tag & 1 == _BEFORE, _AFTER, _BEFORE) * _KINDS + own[word]
    yield _record(_HEARD, [np.concatenate([batch.column("word").to_numpy(), other]),
                           np.concatenate([256 + 2 * _KINDS + own, (tag >> 1 << 8) + beside])], [pa.int64(), pa.int64()])


def _state(told: DataFrame, buckets: int) -> DataFrame:
    """What every word outside the core was told, stored."""
    rows = told.repartition(buckets, "word").groupBy("word").agg(F.collect_list("told").alias("heard"))
    return _bucketed(rows, "classes", buckets)


def _placed(outside: DataFrame, core: _Core, pairs: np.ndarray, buckets: int) -> DataFrame:
    """A first class for every word outside the core, by the core's classes around it."""
    of = core.of

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Exchange(pairs)
        for batch in batches:
            new = []
            for some in _together(batch):
                *sides, itself = _around(some, of)
                word, _, tag = _entries(some, "links", _FAR)
                both = []
                for s, (w, number, n) in enumerate(sides):
                    beside = word[tag & 1 == s]
                    both.append(_both((w, of[number], n), (beside, np.full(len(beside), _OTHER), tag[tag & 1 == s] >> 1)))
                new.append(table.moves(np.full(some.num_rows, _OTHER), *both, itself))
            yield from _told(batch, np.concatenate(new))

    return _state(outside.select("word", "seen", "links").mapInArrow(place, _HEARD), buckets)


def _together(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, _TOGETHER):
        yield batch.slice(lo, _TOGETHER)


def _met(outside: DataFrame, state: DataFrame, *columns: str) -> DataFrame:
    """Both rows of every word; a bucket's classes are held in memory."""
    return outside.select("word", *columns).join(state.hint("shuffle_hash"), "word")


def _beside(outside: DataFrame, state: DataFrame, core: _Core) -> _Beside:
    """Counts by class, added up in parts of a table of fixed size."""
    k, of = CLASSES + 1, core.of
    last = len(of) - 1
    size = 2 * last * k + k * k

    def packed(part: int, sums: np.ndarray) -> pa.RecordBatch:
        return _record("part, sums", [[part], [pa.compress(sums.tobytes(), codec="zstd", asbytes=True)]], [pa.int32(), pa.binary()])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            own, before, _ = _classed(batch)
            *sides, itself = _around(batch, of)
            for s, (word, number, n) in enumerate(sides):
                np.add.at(total, (s * last + number) * k + own[word], n)
            word, other, n = before
            np.add.at(total, 2 * last * k + other * k + own[word], n)
            np.add.at(total, 2 * last * k + own * (k + 1), itself.astype(np.int64))
        for lo in range(0, size, _PART):
            if total[lo:lo + _PART].any():
                yield packed(lo // _PART, total[lo:lo + _PART])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for row in _rows(batches):
            wide = min(_PART, size - row["part"] * _PART)
            sums[row["part"]] = sums.get(row["part"], 0) + np.frombuffer(
                pa.decompress(row["sums"], 8 * wide, codec="zstd", asbytes=True), np.int64)
        yield from (packed(*x) for x in sums.items())

    parts = _met(outside, state, "seen").mapInArrow(count, "part int, sums binary")
    total = np.zeros(size, np.int64)
    for r in parts.repartition("part").mapInArrow(merge, "part int, sums binary").collect():
        part = total[r.part * _PART:(r.part + 1) * _PART]
        part[:] = np.frombuffer(pa.decompress(bytes(r.sums), 8 * len(part), codec="zstd", asbytes=True), np.int64)
    # A core word before a word of a class stands at the first side of the pair.
    return _Beside(total[:2 * last * k].reshape(2, last, k), total[2 * last * k:].reshape(k, k))


def _moved(outside: DataFrame, state: DataFrame, core: _Core, pairs: np.ndarray, buckets: int) -> DataFrame:
    """Every word outside the core is moved once; within a task some at a time, one batch after the other."""
    of = core.of

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Exchange(pairs)
        for batch in batches:
            new = []
            for some in _together(batch):
                own, *heard = _classed(some)
                *sides, itself = _around(some, of)
                sides = [_both((w, of[number], n), far) for (w, number, n), far in zip(sides, heard)]
                new.append(table.moves(own, *sides, itself))
            yield from _told(batch, np.concatenate(new))

    return _state(_met(outside, state, "seen", "links").mapInArrow(move, _HEARD), buckets)


def _vocabulary(blocks: DataFrame, neighbours: DataFrame, core: _Core, pairs: np.ndarray) -> DataFrame:
    """word, n and class of every word of the training texts outside the core, stored: the best of all rounds.

    The core's words move in the same rounds; their classes in the best one are put into ``core``.
    """
    listed = blocks.agg(F.sum("n_words")).first()[0] or 0
    parallel = blocks.sparkSession.sparkContext.defaultParallelism
    buckets = min(_MOST_BUCKETS, max(parallel, -(-listed // _BUCKET)))
    outside = _outside(blocks, core, buckets)
    best, state = None, _placed(outside, core, pairs, buckets)
    for left in range(0 if outside.isEmpty() else ROUNDS, -1, -1):
        beside = _beside(outside, state, core)
        pairs = _pairs(neighbours, core.of, beside)
        if best is None or likelihood(pairs) > best[0]:
            best = (likelihood(pairs), core.of, state)
        if left:
            state, core.of = _moved(outside, state, core, pairs, buckets), _round(neighbours, core.of, pairs, beside)
    _, core.of, state = best
    of = core.of

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, before, _ = _classed(batch)
            near, _, itself = _around(batch, of)
            n = itself + sum(np.bincount(word, n, batch.num_rows) for word, _, n in (before, near))
            yield _record("word, n, class", [batch.column("word"), n.astype(np.int64), own], [pa.int64(), pa.int64(), pa.int32()])

    return stage(_met(outside, state, "seen").mapInArrow(counted, "word long, n long, class int"), "vocabulary")


def _core_counts(neighbours: DataFrame, words: int) -> np.ndarray:
    """How often ends, core words and all others occur: one number for each core word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield _record("word, n", [[row["word"]], [np.frombuffer(row["n_before"], "<i8").sum()]], [pa.int64(), pa.int64()])

    n = np.zeros(words + 2, np.int64)
    for r in neighbours.select("word", "n_before").mapInArrow(count, "word long, n long").collect():
        n[r.word] = r.n
    return n


@dataclass
class ClassModel:
    """Sums over the training texts, and the class tables."""

    tokens: int  # N
    words: int  # V
    class_tokens: np.ndarray
    class_words: np.ndarray
    follows: np.ndarray | None = None  # log10 p(class | class before); the last row after an unseen word
    unseen: np.ndarray | None = None  # log10 p(any unseen word | class before)

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + ADDED) / (self.tokens + ADDED * (self.words + 1)))

    def emission(self, n: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 p(word | class)."""
        return np.log10((n + ADDED) / (self.class_tokens[of] + ADDED * (self.class_words[of] + 1)))

    def learn(self, pairs: np.ndarray) -> None:
        share = (self.class_tokens + ADDED) / (self.class_tokens.sum() + ADDED * CLASSES)
        kinds = np.maximum((pairs > 0).sum(1), 1)[:, None]
        after = (pairs + kinds * share) / (pairs.sum(1)[:, None] + kinds)
        after = np.vstack([after, share])
        self.follows = np.log10(after)
        self.unseen = np.log10(after @ (ADDED / (self.class_tokens + ADDED * (self.class_words + 1))))


def _sums(core: _Core, vocabulary: DataFrame) -> ClassModel:
    own = slice(0, len(core.words) + 1)  # ends and core words
    tokens = np.bincount(core.of[own], core.n[own], CLASSES).astype(np.int64)
    words = np.bincount(core.of[own], core.n[own] > 0, CLASSES).astype(np.int64)
    for r in vocabulary.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tokens[r["class"]] += r.n
        words[r["class"]] += r.words
    return ClassModel(int(tokens.sum()), int(words.sum()), tokens, words)


_TEXT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, words_score double, classes binary"


def _texts(blocks: DataFrame, vocabulary: DataFrame, model: ClassModel, core: _Core) -> DataFrame:
    """Each text with its classes and what its words give on their own, stored.

    A block's list of words meets the vocabulary word by word and comes back to the block as one list.
    """
    last = len(core.words) + 1

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words = np.frombuffer(row["words"], "<u8")
            numbers = core.numbered(words)
            at = np.flatnonzero(numbers == last)
            yield _record("word, block, at", [words[at].view(np.int64), np.full(len(at), row["block"]), at],
                          [pa.int64(), pa.int64(), pa.int32()])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [_squeeze(core.numbered(np.frombuffer(w, "<u8"))) for w in batch.column("words").to_pylist()]
            kept = [c for c in batch.schema.names if c != "words"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(numbers, pa.binary())],
                                             names=[*kept, "numbers"])

    lists = blocks.select("block", "words").mapInArrow(listed, "word long, block long, at int")
    # A word is in a block's list once, so the most common word has one row for a block.
    known = lists.join(vocabulary, "word").groupBy("block").agg(
        F.collect_list(F.shiftleft(F.col("at").cast("long"), 8).bitwiseOR(F.col("class"))).alias("known"),
        F.collect_list("n").alias("times"))
    carried = blocks.select("block", "ids", "held", "ends", "codes", "size", "n_words", "words").mapInArrow(
        numbered, "block long, ids array<long>, held array<boolean>, ends array<int>, codes binary, size int, n_words int, numbers binary")
    both = carried.join(known, "block", "left")
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                piece = batch.slice(i, 1)
                block = _Block(piece.drop_columns(["known", "times"]).to_pylist()[0])
                numbers = np.append(_unsqueeze(block.row["numbers"], block.n_words), 0)  # an end comes last
                n = np.where(numbers < last, core.n[numbers], 0)
                classes = np.where(n > 0, core.of[numbers], _UNKNOWN)
                at = np.asarray(piece.column("known").flatten())
                n[at >> 8], classes[at >> 8] = np.asarray(piece.column("times").flatten()), at & 255
                on_own = np.where(n > 0, model.emission(n, np.where(classes == _UNKNOWN, 0, classes)), 0.0)
                tokens = block.tokens(np.arange(block.n_words), block.n_words, train=False)[1:]
                ends = block.ends + np.arange(1, len(block.ends) + 1)
                starts = ends - block.sizes - 1
                sums = [np.add.reduceat(x[tokens], starts) for x in ((n > 0).astype(np.int64), model.base(n), on_own)]
                data = classes.astype(np.uint8)[tokens].tobytes()
                yield _record(_TEXT, [block.row["ids"], block.held, block.sizes + 1, *sums,
                                      [data[a:b] for a, b in zip(starts, ends)]], types)

    return stage(both.mapInArrow(score, _TEXT), "classed-texts")


def _class_sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all texts, the ends' class before each of them, and where each text begins."""
    data = batch.column("classes").cast(pa.large_binary())
    bounds = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
    flat = np.frombuffer(data.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]].astype(np.int64)
    starts = bounds[:-1] - bounds[0]
    return np.insert(flat, starts, END), starts + np.arange(len(starts))


def _in_steps(batches: Iterator[pa.RecordBatch], size: int = _STEPS) -> Iterator[pa.RecordBatch]:
    """Batches of texts' classes, cut between texts; only a text longer than ``size`` makes a longer one."""
    for batch in batches:
        for lo, texts in in_slices(batch.column("classes"), size):
            yield batch.slice(lo, len(texts))


def _class_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in _in_steps(batches):
        flat, starts = _class_sequences(batch)
        inside = np.ones(len(flat), bool)
        inside[starts] = False  # no pair leads from one text into the next
        at = np.flatnonzero(inside)
        total += np.bincount(flat[at - 1] * CLASSES + flat[at], minlength=CLASSES * CLASSES)
    seen = np.flatnonzero(total)
    yield _record("pair, n", [seen, total[seen]], [pa.int64(), pa.int64()])


def _transitions(texts: DataFrame) -> np.ndarray:
    rows = (texts.where("not held_out").select("classes").mapInArrow(_class_pairs, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).collect())
    return _table(rows, CLASSES)


def class_scores(docs: DataFrame, held_out) -> DataFrame:
    """Every text's tokens, known tokens, base score and score by a class model of the texts not held out.

    ``held_out`` is a condition on the rows. Scores are log10 probabilities of whole texts; a text's
    perplexity is 10 to the power of -score / n_tokens.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = stage(rows.mapInArrow(_blocks, _BLOCK), "word-blocks")
    core = _core_of(blocks)
    neighbours = _neighbours_of(blocks, core)
    core.of, pairs = _clustered(neighbours, len(core.words))
    core.n = _core_counts(neighbours, len(core.words))
    vocabulary = _vocabulary(blocks, neighbours, core, pairs)
    model = _sums(core, vocabulary)
    texts = _texts(blocks, vocabulary, model, core)
    model.learn(_transitions(texts))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        follows = np.hstack([model.follows, model.unseen[:, None]])
        for batch in _in_steps(batches):
            flat, starts = _class_sequences(batch)
            flat = np.where(flat == _UNKNOWN, CLASSES, flat)
            steps = np.zeros(len(flat))
            steps[1:] = follows[flat[:-1], flat[1:]]
            steps[starts] = 0.0
            total = np.add.reduceat(steps, starts) + batch.column("words_score").to_numpy()
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in out[:-1]], pa.array(total)], names=out)

    out = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    scored = texts.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    return scored.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                    "base_score double, score double")
