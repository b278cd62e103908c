"""The manifest against one built from sorted lists, on plain, odd, single and no rows."""

import hashlib
import random
import zlib

import pytest

from millrace.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, m int, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def tree(nodes):
    """The last node, and (before, after) of every first node on each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            first = i // 16 * 16
            path.append((nodes[first:i], nodes[i + 1:first + 16]))
        at = [i // 16 for i in at]
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    sources, found = {}, {}
    for k, row in enumerate(rows):
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), k))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        members = sorted(sources[s])
        subroot, paths = tree([m[2] for m in members])
        found |= {m[3]: (s, subroot, p) for m, p in zip(members, paths)}
        sources[s] = subroot
    root, tops = tree([sources[s] for s in names]) if names else ("", [])
    for k, row in enumerate(rows):
        s, subroot, path = found[k]
        path, text = path + tops[names.index(s)], row[4]
        if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        folded = leaf(row, text)
        for before, after in path:
            folded = h(*before, folded, *after)
        proof = h(*[d for before, after in path for d in before + after])
        yield row[0], leaf(row, row[4]), subroot, root, proof, folded, folded == root


def rows_of(name):
    rng = random.Random(3)
    plain = [(i * rng.randrange(1, 400), f"s{min(3, rng.randrange(9))}", "en", i, f"Text {i}") for i in range(700)]
    odd = [plain[3]] * 40 + [(None, "s0", None, None, "X")] * 3 + [(None,) * 5, (-5, "s0", "x", 1, "É A"), (1 << 50, "s0", "x", 1, "B")]
    odd += [(7, "s1", "x", 1, f"T {i}") for i in range(50)] + [(i, f"k{i}", "x", 1, "Lone") for i in range(300)]
    odd += [(9, "s2", "x", 1, f"U {i // 2}") for i in range(20)] + [(32768 * k, "s3", "", 0, "") for k in range(-3, 3)]
    return {"plain": plain, "odd": plain + odd, "one": plain[:1], "none": []}[name]


@pytest.mark.parametrize("name", ["plain", "odd", "one", "none"])
def test_manifest(spark, name, monkeypatch):
    monkeypatch.setattr(manifest, "_COPIES", 7)
    rows = rows_of(name)
    docs = spark.createDataFrame([(*r, "g", 1, "l") for r in rows], SCHEMA)
    got = manifest.proofs(docs).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))
