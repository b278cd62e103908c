"""The manifest as plain SQL, with one block for each level of the trees."""

from __future__ import annotations

FAN = 16
#: Levels written out: room for 16^6 rows of a source and 16^3 sources.
LEVELS, TOP_LEVELS = 6, 3

_CHECKSUM = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: list_reduce(
  list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _levels(name: str, levels: int) -> str:
    """Nodes of each level and, beside each node, the digests before and after it in its run."""
    side = "coalesce(string_agg(hash, '') OVER (PARTITION BY source, i // 16 ORDER BY i ROWS BETWEEN {}), '')"
    out = []
    for k in range(levels):
        out.append(f"""{name}_path{k} AS (SELECT source, i,
  {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, {side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {name}{k}),
{name}{k + 1} AS (SELECT source, m, i // 16 AS i, CASE WHEN m <= {FAN**k} THEN min(hash)
  ELSE sha256(string_agg(hash, '' ORDER BY i)) END AS hash FROM {name}{k} GROUP BY source, m, i // 16)""")
    return ",\n".join(out)


def _joins(name: str, levels: int, place: str, source: str) -> str:
    return " ".join(f"JOIN {name}_path{k} {name}p{k} ON {name}p{k}.source IS NOT DISTINCT FROM {source} AND "
                    f"{name}p{k}.i = {place} // {FAN**k}" for k in range(levels))


def manifest_sql() -> str:
    steps, siblings, last = [], [], "coalesce(tampered, leaf)"
    for name, levels, m in (("leaf", LEVELS, "g.m"), ("top", TOP_LEVELS, "s.m")):
        for k in range(levels):
            p = f"{name}p{k}"
            steps.append(f"CASE WHEN {m} > {FAN**k} THEN sha256({p}.l || {last} || {p}.r) ELSE {last} END AS {name}f{k}")
            siblings.append(f"CASE WHEN {m} > {FAN**k} THEN {p}.l || {p}.r ELSE '' END")
            last = f"{name}f{k}"
    return f"""
WITH d AS (SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {_CHECKSUM} % 5 = 0 THEN
    {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered FROM documents),
g AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
      count(*) OVER (PARTITION BY source) AS m FROM d),
leaf0 AS (SELECT source, m, i, leaf AS hash FROM g),
{_levels('leaf', LEVELS)},
s AS (SELECT source, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS m FROM leaf{LEVELS}),
top0 AS (SELECT '' AS source, m, i, hash FROM s),
{_levels('top', TOP_LEVELS)},
folded AS (SELECT g.doc_id, leaf, s.hash AS subroot, top{TOP_LEVELS}.hash AS root, {', '.join(steps)},
  sha256({' || '.join(siblings)}) AS proof_sha256
  FROM g JOIN s ON s.source IS NOT DISTINCT FROM g.source CROSS JOIN top{TOP_LEVELS}
  {_joins('leaf', LEVELS, 'g.i', 'g.source')} {_joins('top', TOP_LEVELS, 's.i', "''")})
SELECT doc_id, leaf, subroot, root, proof_sha256, {last} AS folded_root, {last} = root AS verified FROM folded"""
