"""Language of whole texts by a small convolutional network over bytes.

A text is cut into windows of fixed length. Filters of several widths slide over the
embedded bytes of a window, the largest answer of each filter is kept, and a softmax layer
turns these into probabilities; a text's are the mean of its windows' logarithms. The
network is trained in numpy on a bounded sample of labelled rows; every window of every text
is predicted. Filters run as table look-ups of byte pairs, which gives the same sums.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is
every text if nothing was learnt; empty tables give no rows; columns lang_pred and score of
the input are replaced, all others stay. Ties go to the language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Bound of the training sample: documents of each language, and windows of each document.
DOCUMENTS_PER_LANGUAGE = 400
WINDOWS_PER_DOCUMENT = 4
UNKNOWN = "und"
_AT_ONCE = 2048


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    embedding: np.ndarray  # byte, dimension
    filters: dict[int, np.ndarray]  # width: (place and dimension, filter)
    bias: np.ndarray
    weights: np.ndarray  # filter of any width, language
    offset: np.ndarray


def training_sample(documents: DataFrame, label: str = "lang", key: str = "doc_id",
                    per_language: int = DOCUMENTS_PER_LANGUAGE) -> list[tuple[str, bytes]]:
    """(language, window) of up to ``per_language`` documents of each language, chosen by a hash of key and text.

    A share of each language, some four times as many as wanted, goes by the hash alone; copies among them
    become one, and only these are ranked. So no task sees all documents of a language, and what reaches the
    driver is bounded however often an id or a text is repeated. A null key is one like others.
    """
    labelled = documents.where(F.col(label).isNotNull() & (F.length("text") > 0)).withColumn("_label", F.col(label))
    counts = labelled.groupBy("_label").agg(F.count("*").alias("n")).collect()
    if not counts:
        return []
    shares = {r._label: min(1.0, 4 * per_language / r.n) for r in counts}
    limit = F.element_at(F.create_map(*[F.lit(x) for k, share in shares.items() for x in (
        k, min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))]), F.col("_label"))
    at = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOCUMENT - 1)), lambda i: F.substring(
        F.col("text"), 1 + F.floor(i * F.length("text") / WINDOWS_PER_DOCUMENT).cast("int"), F.lit(WINDOW)))
    some = labelled.withColumn("_order", F.xxhash64(F.col(key), F.col("text"))).where(F.col("_order") <= limit)
    some = some.select("_label", "_order", F.array_distinct(at).alias("_windows")).distinct()
    chosen = Window.partitionBy("_label").orderBy("_order", "_windows")
    rows = (some.withColumn("_rank", F.row_number().over(chosen)).where(F.col("_rank") <= per_language)
            .select("_label", "_order", F.explode("_windows").alias("_window"))
            .where("length(_window) > 0").orderBy("_label", "_order", "_window").collect())
    return [(r[0], r[2].encode()[:WINDOW]) for r in rows]


def train(sample: list[tuple[str, bytes]], epochs: int = 8, batch: int = 64, rate: float = 0.01,
          seed: int = 7) -> Model | None:
    """Fit by Adam; languages weigh alike. None if there is nothing to learn from."""
    languages = tuple(sorted({label for label, _ in sample}))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    x = np.zeros((len(sample), WINDOW), np.int64)
    for i, (_, window) in enumerate(sample):
        x[i, :len(window)] = np.frombuffer(window, np.uint8)
    y = np.searchsorted(languages, [label for label, _ in sample])
    share = len(y) / (len(languages) * np.bincount(y, minlength=len(languages)))
    n = len(WIDTHS) * FILTERS
    values = {"embedding": rng.normal(0, 0.3, (256, EMBEDDING)), "bias": np.zeros(n),
              "weights": rng.normal(0, 0.2, (n, len(languages))), "offset": np.zeros(len(languages))}
    values |= {w: rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)) for w in WIDTHS}
    first = {k: np.zeros_like(v) for k, v in values.items()}
    second = {k: np.zeros_like(v) for k, v in values.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            rows = order[lo:lo + batch]
            step += 1
            for k, g in _gradients(values, x[rows], y[rows], share[y[rows]]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                values[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(languages, values["embedding"], {w: values[w] for w in WIDTHS}, values["bias"],
                 values["weights"], values["offset"])


def _gradients(v: dict, x: np.ndarray, y: np.ndarray, share: np.ndarray) -> dict:
    embedded = v["embedding"][x]
    pooled, places, views = [], [], []
    for w in WIDTHS:
        view = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1).swapaxes(2, 3)
        view = view.reshape(len(x), WINDOW - w + 1, w * EMBEDDING)
        answers = view @ v[w]
        places.append(answers.argmax(1))
        pooled.append(np.take_along_axis(answers, places[-1][:, None], 1)[:, 0])
        views.append(view)
    hidden = np.concatenate(pooled, 1) + v["bias"]
    active = np.maximum(hidden, 0)
    scores = active @ v["weights"] + v["offset"]
    p = np.exp(scores - scores.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p *= (share / len(y))[:, None]
    back = (p @ v["weights"].T) * (hidden > 0)
    out = {"weights": active.T @ p, "offset": p.sum(0), "bias": back.sum(0),
           "embedding": np.zeros_like(v["embedding"])}
    row = np.arange(len(x))[:, None]
    for n, w in enumerate(WIDTHS):
        g = back[:, n * FILTERS:(n + 1) * FILTERS]
        out[w] = np.einsum("bf,bfd->df", g, views[n][row, places[n]])
        into = (g[:, :, None] * v[w].T[None]).reshape(len(x), FILTERS, w, EMBEDDING)
        for k in range(w):
            np.add.at(out["embedding"], x[row, places[n] + k], into[:, :, k])
    return out


class _Network:
    """A model as tables of byte pairs: every filter is a sum of one or two of their rows."""

    def __init__(self, model: Model):
        e, self.model = model.embedding, model
        one = {w: e @ model.filters[w].reshape(w, EMBEDDING, FILTERS) for w in WIDTHS}  # place, byte, filter
        pair = lambda w, k: (one[w][k][:, None] + one[w][k + 1][None]).reshape(65536, FILTERS)
        self.heads = np.concatenate([pair(w, 0) for w in WIDTHS], 1).astype(np.float32)
        self.tails = {w: (one[w][2] if w == 3 else pair(w, 2)).astype(np.float32) for w in WIDTHS if w > 2}

    def windows(self, w: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of windows, given as (place, window) bytes."""
        pairs = w[:-1].astype(np.int32) * 256 + w[1:]
        best = np.full((w.shape[1], len(WIDTHS) * FILTERS), -np.inf, np.float32)
        for i in range(WINDOW - 1):
            answers = self.heads.take(pairs[i], 0)
            for n, width in enumerate(WIDTHS):
                here = slice(n * FILTERS, (n + 1) * FILTERS)
                if i + width > WINDOW:
                    answers[:, here] = -np.inf
                elif width == 3:
                    answers[:, here] += self.tails[3].take(w[i + 2], 0)
                elif width == 4:
                    answers[:, here] += self.tails[4].take(pairs[i + 2], 0)
            np.maximum(best, answers, out=best)
        scores = np.maximum(best + self.model.bias, 0) @ self.model.weights + self.model.offset
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of whole texts, by all their windows."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        number = np.maximum(1, -(-np.diff(bounds) // WINDOW))
        of = np.repeat(np.arange(len(texts)), number)
        start = bounds[of] + WINDOW * (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number))
        total = np.zeros((len(texts), len(self.model.languages)))
        for lo in range(0, len(of), _AT_ONCE):
            some = slice(lo, lo + _AT_ONCE)
            at = start[some] + np.arange(WINDOW)[:, None]
            inside = at < bounds[of[some] + 1]
            w = np.where(inside, data[np.minimum(at, max(0, len(data) - 1))] if len(data) else 0, 0).astype(np.uint8)
            np.add.at(total, of[some], self.windows(w) * inside.sum(0)[:, None])
        total /= np.maximum(1, np.diff(bounds))[:, None]
        p = np.exp(total - total.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """``documents`` with lang_pred and score."""
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return documents.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    def guess(texts: pa.Array) -> pa.Array:
        p = _network(model).texts(texts)
        best = p.argmax(1)
        return pa.StructArray.from_arrays(
            [pa.array([model.languages[i] for i in best], pa.string()), pa.array(p[np.arange(len(p)), best])],
            names=["lang_pred", "score"])

    udf = F.arrow_udf(guess, "lang_pred string, score double")
    guessed = documents.withColumn("_guess", udf("text"))
    return guessed.withColumns({
        "lang_pred": F.when(known, F.col("_guess.lang_pred")).otherwise(UNKNOWN),
        "score": F.when(known, F.col("_guess.score")).otherwise(0.0)}).drop("_guess")


_networks: dict[int, _Network] = {}


def _network(model: Model) -> _Network:
    if id(model) not in _networks:
        _networks.clear()
        _networks[id(model)] = _Network(model)
    return _networks[id(model)]
