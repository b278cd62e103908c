"""Runs of words against all stretches tried one by one; extensions against single steps."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from millrace.llm import periodic
from millrace.llm.lce import COVER, PERIOD, CommonExtensions

ODD = [None, "", "a", "a " * 7, "A a " * 9, "x\t\ny  " * 5, "w " * 5000, "é ü é ü é ü é ü é ü", " ".join("abcab" * 40),
       ("a b c d " * 30 + "e ") * 9, "a " * 40 + "b " + "a " * 41]


def brute(words):
    """Every stretch that no period extends, by its smallest period."""
    runs, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                runs.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in runs.items())


def texts():
    rng = random.Random(11)
    out = []
    for k in range(150):
        words = []
        while len(words) < rng.randrange(4, 400):
            part = [rng.choice("abc" if k % 3 else "ab") for _ in range(rng.choice([1, 2, 3, 7, 33, 60]))]
            words += part * rng.choice([1, 1, 4, 5, 9]) + part[:rng.randrange(3)]
        out.append(words)
    return out


def test_cover():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_common_extensions():
    rng = np.random.default_rng(1)
    for size, kinds in ((1, 1), (40, 1), (700, 1), (900, 2), (3000, 30)):
        codes = np.append(rng.integers(0, kinds, size), -9)
        codes[size // 2] = -8
        a, b = rng.integers(0, len(codes), (2, 400))
        a, b = a[a != b], b[a != b]
        got = CommonExtensions(codes)(a, b)
        for x, y, n in zip(a.tolist(), b.tolist(), got.tolist()):
            want = 0
            while max(x, y) + want < len(codes) and codes[x + want] == codes[y + want]:
                want += 1
            assert n == want


@pytest.mark.parametrize("points", [1 << 21, 64])
def test_runs(points, monkeypatch):
    monkeypatch.setattr(periodic, "_POINTS", points)
    some = texts()
    coded = [np.array([ord(w) for w in ws], np.int64) for ws in some]
    assert periodic.runs_of(coded) == [brute(ws) for ws in some]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_rows(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(300)))) for i in range(120)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "a " * 8), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, start long, n_runs long")
    got = {}
    for r in periodic.word_runs(docs, rewrite=True).collect():
        got.setdefault(r.doc_id, r)
    assert len(got) == len(rows) - 2
    for k, text in rows:
        words = (text or "").split()
        h = 1 if k is None else zlib.crc32(str(k).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        gone = {i for s, n_, q in runs for i in range(s + q, s + n_)}
        top = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[0] if runs else (None,) * 3
        row = got[k]
        assert (row.n_words, row.n_runs, row.start, row.length, row.period) == (n, len(runs), *top)
        assert row.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n_},{q}\n" for s, n_, q in runs))
        assert row.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
