"""SQL (DuckDB) for the registered queries of this package that SQL can express."""

from __future__ import annotations

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_LINE_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT *, {_LOWERED.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
many AS (SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, m.key IS NULL OR k.doc_id = m.largest AS stays FROM keyed k LEFT JOIN many m ON k.key = m.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP12_COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM words), (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
), freq AS (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), halves AS (
    SELECT lang, phrase, f AS a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS j FROM freq)
), cuts AS (
    SELECT h.lang, h.phrase, a, x.f AS l, y.f AS r, j, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
    FROM halves h JOIN freq x ON x.lang = h.lang AND x.phrase = head JOIN freq y ON y.lang = h.lang AND y.phrase = rest
), worst AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_parts AS (
    SELECT c.lang, array_to_string(c.w[i : i + m - 1], ' ') AS phrase, c.f
    FROM freq c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i) WHERE m < c.k AND i + m - 1 <= c.k
), around AS (
    SELECT lang, phrase, max(f) AS f FROM inner_parts GROUP BY lang, phrase
), ranked AS (
    SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
    FROM worst w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
    WHERE o.f IS NULL OR 100::HUGEINT * o.f < 80::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(parts)})"


#: The CRC-32 of a decimal number, bit by bit (its polynomial, reversed, is 0xEDB88320).
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""

#: Levels of a source's tree and of the tree over the sources that the SQL has: 16^6 leaves a source, 16^3 sources.
_DEPTH, _TOP_DEPTH = 6, 3


def _merkle() -> str:
    """Level by level: ``n`` nodes of a tree (t), numbered from 0 (p); a tree of one node goes on unchanged."""
    steps = [
        f"""leaves AS (
    SELECT row_number() OVER () AS r, doc_id, source AS t, {_leaf("text")} AS h, CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(_LOWERED.format("text"))} ELSE {_leaf("text")} END AS given FROM documents
)""",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, h, r) - 1 AS p, count(*) OVER (PARTITION BY t) AS n FROM leaves)",
        "s0 AS (SELECT t, p, n, h FROM placed)",
        "c0 AS (SELECT r, t, p, n, given AS f, '' AS proof FROM placed)",
    ]

    def level(now: str, state: str, above: str, after: str, number: str) -> None:
        steps.append(f"{number} AS (SELECT t, p // 16 AS p, n, list(h ORDER BY p) AS hs FROM {now} GROUP BY t, p // 16, n)")
        steps.append(f"{above} AS (SELECT t, p, (n + 15) // 16 AS n, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {number})")
        left, right = "array_to_string(hs[1 : c.p % 16], '')", "array_to_string(hs[c.p % 16 + 2 : 16], '')"
        steps.append(f"""{after} AS (
    SELECT r, c.t, c.p // 16 AS p, (c.n + 15) // 16 AS n, CASE WHEN c.n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f, CASE WHEN c.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof
    FROM {state} c JOIN {number} x ON x.t IS NOT DISTINCT FROM c.t AND x.p = c.p // 16
)""")

    for k in range(_DEPTH):
        level(f"s{k}", f"c{k}", f"s{k + 1}", f"c{k + 1}", f"x{k}")
    steps.append(f"subroots AS (SELECT t AS source, h, row_number() OVER (ORDER BY t NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM s{_DEPTH})")
    steps.append("t0 AS (SELECT 0 AS t, p, n, h FROM subroots)")
    steps.append(f"d0 AS (SELECT r, 0 AS t, s.p, s.n, f, proof FROM c{_DEPTH} c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.t)")
    for k in range(_TOP_DEPTH):
        level(f"t{k}", f"d{k}", f"t{k + 1}", f"d{k + 1}", f"y{k}")
    return f"""WITH {", ".join(steps)}
SELECT doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM leaves l JOIN d{_TOP_DEPTH} d ON d.r = l.r JOIN subroots s ON s.source IS NOT DISTINCT FROM l.t, t{_TOP_DEPTH} t"""


OP13_MERKLE_MANIFEST = _merkle()
