"""Token ids of whole texts, from the vocabulary files of public tokenizers.

A text is cut where the vocabulary's own splitting rule always cuts, and the encodings of
its short parts are remembered by each Python worker. The ids are those of the tokenizers
library for the whole text: parts are encoded by it, and a text in which a cut could change
the result is handed to it as a whole.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that a worker remembers; about 200 bytes each.
REMEMBERED = 600_000
#: Stands between texts that are encoded together; no letter.
BETWEEN = "\0"
#: The id that ends each document.
END = 0
#: Bytes of text whose parts are looked up together.
AT_ONCE = 8 << 20


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteLevelParts:
    """Byte-level vocabularies that split by the pattern `` ?letters| ?digits|...|\\s+``.

    A part starts at a single blank, or at a single line end, between two other characters.
    """

    start = "\n"  # so that every part has one of both before it

    def marked(self, texts: pa.Array) -> pa.Array:
        """Texts whose parts lie between blanks."""
        return pc.replace_substring(texts, "\n", " \n")

    def source(self, part: str) -> str | None:
        """The text a part stands for, None where it can't be encoded by itself."""
        core = part[1:] if part[:1] == "\n" else part
        if not core or core[0].isspace() or core[-1].isspace():
            return None
        return part if part[:1] == "\n" else " " + part


class BlankFreeParts:
    """Vocabularies that drop white space: any blank or line end parts two texts."""

    start = ""

    def marked(self, texts: pa.Array) -> pa.Array:
        return pc.replace_substring(texts, "\n", " ")

    def source(self, part: str) -> str | None:
        return part


class TextEncoder:
    """Encodes arrays of texts to unsigned 32-bit ids."""

    def __init__(self, path: str, parts):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings are ordinary text here
        self.splitter = parts
        self.known: dict[str, bytes | bool] = {}  # False: can't be encoded by itself
        self.counts: dict[str, int] = {}  # of texts between places where it always cuts
        self.marks = dict(zip(",.", self.library_ids([",", "."])))
        self.line = self.library_ids(["\n"])[0]
        self.skip = bool(parts.start)
        # Runs of letters are one piece of the splitting rule: no need to look for its cuts.
        self.letters = Tokenizer(self.library.model)
        if self.library.normalizer is not None:
            self.letters.normalizer = self.library.normalizer
        self.letters.pre_tokenizer = Sequence([
            Split(BETWEEN, "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.between = np.frombuffer(self.library_ids([BETWEEN])[0], "<u4")[0]

    def library_ids(self, texts: list[str]) -> list[bytes]:
        done = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in done]

    def letter_ids(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of letters, after a blank or not; many are encoded as one."""
        out = []
        for i in range(0, len(texts), 64):
            some = BETWEEN.join(texts[i:i + 64]) + BETWEEN
            ids = np.array(self.letters.encode_batch_fast([some], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(ids == self.between) * 4).tolist()
            ids = ids.tobytes()
            out += [ids[a:b] for a, b in zip([0, *[e + 4 for e in ends]], ends)]
        return out

    def _learn(self, new: set[str], keep: bool = True) -> dict[str, bytes | bool]:
        """Ids of parts not known so far. A mark after a letter is a token of its own."""
        known, marks, words = self.known, self.marks, set()
        marked = {p: p[:-1] for p in new if p[-1:] in marks and p[-2:-1].isalpha()}
        words.update(p for p in new if p not in marked)
        words.update(w for w in marked.values() if w not in known)
        learnt: dict[str, bytes | bool] = {}
        plain = [p for p in words if p.isalpha()]
        if plain:
            learnt.update(zip(plain, self.letter_ids([self.splitter.source(p) for p in plain])))
        first = [p for p in words if p[:1] == "\n" and p[1:].isalpha()]
        if first:
            learnt.update((p, self.line + x) for p, x in zip(first, self.letter_ids([p[1:] for p in first])))
        others = {p: self.splitter.source(p) for p in words if p not in learnt}
        good = [p for p, s in others.items() if s is not None]
        learnt.update(dict.fromkeys(others, False))
        learnt.update(zip(good, self.library_ids([others[p] for p in good])))
        for part, word in marked.items():
            ids = learnt.get(word, known.get(word))
            learnt[part] = ids is not False and ids + marks[part[-1]]
        if keep and len(known) < REMEMBERED:  # frequent parts come early
            known.update(islice(learnt.items(), REMEMBERED - len(known)))
        return learnt

    def count(self, pieces: set[str]) -> dict[str, int]:
        """Numbers of tokens of pieces that follow a cut, blank or line end included."""
        parts = {p: p[1:] if p[:1] == " " else p for p in pieces if p[:1] in (" ", "\n")}
        parts = {p: x for p, x in parts.items() if self.splitter.source(x) == p}
        ids = self._learn(set(parts.values()), keep=False)  # their numbers are remembered below
        out = {p: len(ids[x]) // 4 for p, x in parts.items() if ids[x] is not False}
        rest = [p for p in pieces if p not in out]
        out.update((p, len(x) // 4) for p, x in zip(rest, self.library_ids(rest)))
        if len(self.counts) < REMEMBERED:
            self.counts.update(islice(out.items(), REMEMBERED - len(self.counts)))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (one more than texts); null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        flat, bounds = [], [np.zeros(1, np.int64)]
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        cuts = np.searchsorted(sizes, np.arange(AT_ONCE, sizes[-1], AT_ONCE)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
            if lo < hi:
                ids, ends = self._encode_some(texts.slice(lo, hi - lo))
                flat.append(ids)
                bounds.append(ends + bounds[-1][-1])
        return np.concatenate(flat), np.concatenate(bounds)

    def _encode_some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        start = pa.scalar(self.splitter.start, pa.large_string())
        empty = pa.scalar("", pa.large_string())
        lists = pc.split_pattern(pc.binary_join_element_wise(start, self.splitter.marked(texts), empty), " ")
        first = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        parts = lists.flatten().dictionary_encode()
        place = parts.indices.to_numpy()
        words = parts.dictionary.to_pylist()
        ids = list(map(self.known.get, words))
        missing = {w for w, x in zip(words, ids) if x is None}
        if missing:
            learnt = self._learn(missing)
            ids = [learnt[w] if x is None else x for w, x in zip(words, ids)]
        alone = np.array([x is not False for x in ids], bool)
        ids = [x or b"" for x in ids]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ids = np.frombuffer(b"".join(ids), "<u4")
        ends = np.concatenate([[0], np.cumsum(size[place])])[first]
        out = spread_out(ids, (np.cumsum(size) - size)[place], size[place])
        skipped, wrong = self.skip, np.zeros(len(texts), bool)
        if not alone.all():
            wrong[np.searchsorted(first, np.flatnonzero(~alone[place]), "right") - 1] = True
        if not skipped and not wrong.any():
            return out, ends[1:]
        keep = np.ones(len(out), bool)  # what was put before each text goes
        if skipped:
            keep[ends[:-1][ends[:-1] < ends[1:]]] = False
        if not wrong.any():
            lengths = np.diff(np.concatenate([[0], np.cumsum(keep)])[ends])
            return out[keep], np.cumsum(lengths)
        pieces = []
        for i, text in enumerate(texts):
            if wrong[i]:
                pieces.append(np.frombuffer(self.library_ids([text.as_py()])[0], "<u4"))
            else:
                pieces.append(out[ends[i]:ends[i + 1]][keep[ends[i]:ends[i + 1]]])
        return np.concatenate(pieces), np.cumsum([len(x) for x in pieces])


def spread_out(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices values[start:start + size], one after another."""
    total = int(size.sum())
    at = np.repeat(start - (np.cumsum(size) - size), size)
    return values[at + np.arange(total)]


def with_end(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids followed by the id that ends a document."""
    return np.insert(ids, bounds[1:], END), bounds + np.arange(len(bounds))


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    """One encoder for each vocabulary and worker process."""
    import json

    with open(path, encoding="utf-8") as file:
        kind = json.load(file)["pre_tokenizer"]["type"]
    return TextEncoder(path, ByteLevelParts() if kind == "ByteLevel" else BlankFreeParts())
