"""DuckDB texts of the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS first_id, payload_bytes >= 1000 AS large FROM p)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN large AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN large AND first_id <> page_id THEN first_id END AS refers_to
FROM r
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
), c AS (
  SELECT conv_id, count(*) AS n_turns, list({'role': role, 'text': text} ORDER BY place) AS said FROM t GROUP BY conv_id
), g AS (SELECT min(conv_id) AS conv_id, n_turns, said, count(*) AS n_logged FROM c GROUP BY n_turns, said),
stay AS (
  SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM g AS o WHERE o.n_turns > g.n_turns AND o.said[1] = g.said[1] AND o.said[: g.n_turns] = g.said)
)
SELECT t.conv_id, t.place, n_turns, n_logged,
       '<|im_start|>' || coalesce(role, 'user') || chr(10) || regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '< |\1|>', 'g') || '<|im_end|>' || chr(10) AS rendered
FROM t JOIN stay USING (conv_id)
""".replace("\\\\", "\\")

DECONTAMINATION = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
), hits AS (SELECT doc_id, item_id, p, places.size FROM places JOIN windows USING (win, size)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    octets = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    step = "list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: {step}))"


def _merkle() -> str:
    """Trees of runs of 8, a level a step: as many steps as 8^7 leaves need; a tree that has one node waits."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join([field("doc_id"), field("source"), field("lang"), field("n_chars"), field(text)]) + ")"
    lowered = f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    parts = [
        f"d AS (SELECT doc_id, lang, source, n_chars, text, {lowered} AS forged FROM documents)",
        f"l AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf('forged')} AS forged FROM d)",
        "a0 AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS r, doc_id, leaf, forged, leaf AS h, '' AS proof, forged AS f FROM l)",
    ]

    def climb(k: int, source: str, out: str, group: str, rows: str) -> None:
        # nodes of the level, their runs, and each leaf's next node with the others of the run
        parts.append(f"{out}n AS (SELECT DISTINCT {group} AS g, r, h FROM {source})")
        parts.append(f"{out}c AS (SELECT g, count(*) AS n FROM {out}n GROUP BY g)")
        parts.append(f"{out}r AS (SELECT g, r // 8 AS r, list(h ORDER BY r) AS hs, sha256(string_agg(h, '' ORDER BY r)) AS h FROM {out}n GROUP BY g, r // 8)")
        own = "CAST(s.r % 8 AS BIGINT)"
        parts.append(
            f"{out} AS (SELECT {rows}, CASE WHEN n = 1 THEN s.r ELSE s.r // 8 END AS r, CASE WHEN n = 1 THEN s.h ELSE u.h END AS h, "
            f"CASE WHEN n = 1 THEN s.proof ELSE s.proof || array_to_string(hs[: {own}], '') || array_to_string(hs[{own} + 2 :], '') END AS proof, "
            f"CASE WHEN n = 1 THEN s.f ELSE sha256(array_to_string(hs[: {own}], '') || s.f || array_to_string(hs[{own} + 2 :], '')) END AS f "
            f"FROM {source} AS s JOIN {out}c AS c ON s.{group} IS NOT DISTINCT FROM c.g JOIN {out}r AS u ON s.{group} IS NOT DISTINCT FROM u.g AND u.r = s.r // 8)"
        )

    for k in range(7):
        climb(k, f"a{k}", f"a{k + 1}", "lang", "doc_id, lang, leaf, forged")
    parts.append("b0 AS (SELECT doc_id, 0 AS whole, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, leaf, h AS subroot, h, proof, f FROM a7)")
    for k in range(4):
        climb(k, f"b{k}", f"b{k + 1}", "whole", "doc_id, whole, leaf, subroot")
    return "WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM b4"


def _repair() -> str:
    """One turn a step: of all ways to each state, the cheapest, ties by the initials; no halving."""
    states = {"n": "", "s": "", "u": "", "a": ""}
    way = lambda cost, audit, said: f"{{'cost': {cost}, 'audit': {audit}, 'said': {said}}}"
    turn = lambda who: f"[{who} || ':' || text]"
    empty = lambda who: f"['{who}:']"

    def after(old: str, cost: str, marks: str, said: str) -> str:
        return way(f"{old}.cost + {cost}", f"{old}.audit || '{marks}'", f"list_concat({old}.said, {said})")

    extra = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
    ways: dict[str, list[tuple[str, str]]] = {s: [("true", way(f"w.{s}.cost + 4", f"w.{s}.audit || 'D'", f"w.{s}.said"))] for s in states}
    live = "fault NOT IN (1, 2)"
    ways["s"].append((f"{live} AND role[1] = 's'", after("w.n", extra, "K", turn("role"))))
    for old in "nsa":
        ways["u"].append((f"{live} AND role[1] = 'u'", after(f"w.{old}", extra, "K", turn("role"))))
        ways["u"].append((live, after(f"w.{old}", f"3 + {extra}", "R", turn("'user'"))))
        ways["a"].append((f"{live} AND role[1] = 'a'", after(f"w.{old}", f"3 + {extra}", "IK", f"list_concat({empty('user')}, {turn('role')})")))
        ways["a"].append((live, after(f"w.{old}", f"6 + {extra}", "IR", f"list_concat({empty('user')}, {turn(chr(39) + 'assistant' + chr(39))})")))
    ways["a"].append((f"{live} AND role[1] = 'a'", after("w.u", extra, "K", turn("role"))))
    ways["a"].append((live, after("w.u", f"3 + {extra}", "R", turn("'assistant'"))))
    ways["u"].append((f"{live} AND role[1] = 'u'", after("w.u", f"3 + {extra}", "IK", f"list_concat({empty('assistant')}, {turn('role')})")))
    ways["u"].append((live, after("w.u", f"6 + {extra}", "IR", f"list_concat({empty('assistant')}, {turn(chr(39) + 'user' + chr(39))})")))
    best = {s: "list_min([" + ", ".join(f"CASE WHEN {c} THEN {w} END" for c, w in found) + "])" for s, found in ways.items()}
    none = "CAST([] AS VARCHAR[])"
    far = way("1000000", "''", none)
    close = [
        "w.n", "w.a",
        after("w.u", "3", "I", empty("assistant")),
        after("w.s", "6", "II", f"list_concat({empty('user')}, {empty('assistant')})"),
    ]
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(key)} % 20 AS f FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE f <> 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS said,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS ending
  FROM p
), t AS MATERIALIZED (
  SELECT conv_id, turn, i, role, text, CASE WHEN ending = '' THEN 1 WHEN said > 1 THEN 2 WHEN ending NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM o
), w(conv_id, i, n, s, u, a) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {way("0", "''", none)}, {far}, {far}, {far} FROM t
  UNION ALL
  SELECT w.conv_id, t.i, {", ".join(best.values())}
  FROM w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
), e AS (
  SELECT conv_id, list_min([{", ".join(close)}]) AS r FROM w
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM t GROUP BY conv_id
)
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(r.cost, 0) AS BIGINT) AS cost, coalesce(r.audit, '') AS audit, sha256(coalesce(array_to_string(r.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS k
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM k.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op3_warc": WARC,
        "op6_chat_formatting": CHAT,
        "op4_decontamination": DECONTAMINATION,
        "op12_conversation_repair": _repair(),
        "op13_merkle_manifest": _merkle(),
    }
