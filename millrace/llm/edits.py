"""Token counts that follow edits.

A document's pre-tokens lie between places where the vocabulary always cuts: a single blank
or line end between two other characters. Blocks of pre-tokens are the leaves of a segment
tree of character and token sums, stored as two arrays beside the text. An edit is looked up
in the tree, the blocks it touches (with two characters of context on either side, on which
a cut depends) are split and encoded again, and the sums above them are updated. Everything
else keeps its count.

Defined cases: null and empty texts have one empty block and no tokens; edits reach from
``start`` up to ``end`` (code points, kept within the text; null ends or texts count as
nothing) and apply one after another; null edits change nothing; other columns stay, those
named text, tree, n_tokens and encoded_chars are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import encoder
from millrace.llm.words import in_slices

#: Pre-tokens of a block, and how many times as many it may grow to before the tree is built anew.
BLOCK, GROWTH = 32, 4
_SLICE = 1 << 20  # bytes of text whose pieces are held at once
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
TREE = "struct<chars:array<int>,tokens:array<int>>"
_LISTS = pa.struct([("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))])
_DONE = pa.struct([("text", pa.string()), ("tree", _LISTS), ("n_tokens", pa.int64()), ("encoded_chars", pa.int64())])
_COUNTED = f"struct<text:string,tree:{TREE},n_tokens:bigint,encoded_chars:bigint>"


class Tree:
    """Sums of characters and tokens over blocks; node 1 is the root, leaves are the last half."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens
        self.half = len(chars) // 2

    @classmethod
    def over(cls, chars: list[int], tokens: list[int]) -> Tree:
        half = 1 << max(0, len(chars) - 1).bit_length()
        out = []
        for leaves in (chars, tokens):
            level = np.zeros(half, np.int64)
            level[:len(leaves)] = leaves
            levels = [level]
            while len(levels[-1]) > 1:
                levels.append(levels[-1].reshape(-1, 2).sum(1))
            out.append([0, *np.concatenate(levels[::-1]).tolist()])
        return cls(*out)

    def block_at(self, place: int) -> tuple[int, int]:
        """The block that holds a character, and where it begins."""
        node, begin = 1, 0
        while node < self.half:
            node *= 2
            if place >= begin + self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.half, begin

    def put(self, block: int, chars: int, tokens: int) -> None:
        node = block + self.half
        more, gained = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more
            self.tokens[node] += gained
            node //= 2


class Counter:
    """Counts tokens of pre-tokens, which it remembers."""

    def __init__(self, vocabulary_path: str):
        self.encoder = encoder(vocabulary_path)

    def tokens(self, pieces: list[str]) -> list[int]:
        known = self.encoder.counts
        found = list(map(known.get, pieces))
        missing = {p for p, n in zip(pieces, found) if n is None}
        if missing:
            learnt = self.encoder.count(missing)
            found = [learnt[p] if n is None else n for p, n in zip(pieces, found)]
        return found

    def blocks(self, pieces: list[str], counts: list[int], size: int = BLOCK) -> tuple[list[int], list[int]]:
        at = range(0, max(1, len(pieces)), size)
        return ([sum(map(len, pieces[i:i + size])) for i in at], [sum(counts[i:i + size]) for i in at])

    def tree(self, text: str) -> Tree:
        pieces = _CUT.split(text) if text else []
        return Tree.over(*self.blocks(pieces, self.tokens(pieces)))

    def edit(self, text: str, tree: Tree, start: int, end: int, new: str) -> tuple[str, Tree, int]:
        """Text and tree after an edit, and the characters that were encoded."""
        start = min(max(0, start), len(text))
        end = min(max(start, end), len(text))
        if not text or tree.chars[1] == 0:
            return new, self.tree(new), len(new)
        first, begin = tree.block_at(max(0, start - 2))
        last, last_begin = tree.block_at(min(len(text) - 1, end + 2))
        stop = last_begin + tree.chars[last + tree.half]
        region = text[begin:start] + new + text[end:stop]
        text = text[:start] + new + text[end:]
        pieces = _CUT.split(region) if region else []
        counts, slots = self.tokens(pieces), last - first + 1
        if len(pieces) > GROWTH * BLOCK * slots:
            return text, self.tree(text), len(text)
        chars, tokens = self.blocks(pieces, counts, max(1, -(-len(pieces) // slots)))
        for k in range(slots):
            tree.put(first + k, chars[k] if k < len(chars) else 0, tokens[k] if k < len(tokens) else 0)
        return text, tree, len(region)


def with_counts(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """``documents`` with tree and n_tokens of their texts."""

    def build(texts: pa.Array) -> pa.Array:
        counter = Counter(vocabulary_path)
        return pa.concat_arrays([pa.array([], _LISTS), *[sliced(counter, part) for _, part in in_slices(texts, _SLICE)]])

    def sliced(counter: Counter, texts: pa.Array) -> pa.Array:
        split = [_CUT.split(t) if t else [] for t in texts.to_pylist()]
        counts = counter.tokens([p for pieces in split for p in pieces])
        rows, at = [], 0
        for pieces in split:
            tree = Tree.over(*counter.blocks(pieces, counts[at:at + len(pieces)]))
            at += len(pieces)
            rows.append({"chars": tree.chars, "tokens": tree.tokens})
        return pa.array(rows, _LISTS)

    counted = documents.withColumn("tree", F.arrow_udf(build, TREE)("text"))
    return counted.withColumn("n_tokens", F.col("tree.tokens")[1].cast("long"))


def with_edits(counted: DataFrame, edits: str, vocabulary_path: str) -> DataFrame:
    """Text, tree and n_tokens after the edits in the column named ``edits``, an array of
    (start, end, text), and encoded_chars, the characters that had to be encoded for it."""

    def apply(texts: pa.Array, trees: pa.Array, changes: pa.Array) -> pa.Array:
        counter = Counter(vocabulary_path)
        return pa.concat_arrays([pa.array([], _DONE), *[
            sliced(counter, part, trees.slice(lo, len(part)), changes.slice(lo, len(part)))
            for lo, part in in_slices(texts, _SLICE)]])

    def sliced(counter: Counter, texts: pa.Array, trees: pa.Array, changes: pa.Array) -> pa.Array:
        rows = []
        for text, tree, some in zip(texts.to_pylist(), trees.to_pylist(), changes.to_pylist()):
            now, read, text = Tree(tree["chars"], tree["tokens"]), 0, text or ""
            for e in some or []:
                if e is not None:
                    start = e["start"] or 0
                    end = start if e["end"] is None else e["end"]
                    text, now, seen = counter.edit(text, now, start, end, e["text"] or "")
                    read += seen
            rows.append({"text": text, "tree": {"chars": now.chars, "tokens": now.tokens},
                         "n_tokens": now.tokens[1], "encoded_chars": read})
        return pa.array(rows, _DONE)

    done = counted.withColumn("_done", F.arrow_udf(apply, _COUNTED)("text", "tree", edits))
    return done.withColumns({c: F.col(f"_done.{c}") for c in ("text", "tree", "n_tokens", "encoded_chars")}).drop("_done")
