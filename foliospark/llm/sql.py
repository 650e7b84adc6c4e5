"""DuckDB SQL for the queries that SQL can express, from the same fixed values as the operators."""

from __future__ import annotations

from . import licenses, line_dedup as lines, sharding
from .quality_rules import BASE_RULES, RULES, SYMBOLS, stop_word_list
from .warc import BASE32

WS = r"[\x20\x09-\x0D]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def exact_dedup() -> str:
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, length(t) AS n_cp, sha256(regexp_replace(t, '{WS}+', '', 'g')) AS s FROM d),
w AS (SELECT *, first_value(doc_id) OVER o AS keep_id, row_number() OVER o AS rn, count(*) OVER (PARTITION BY s) AS group_size
      FROM n WINDOW o AS (PARTITION BY s ORDER BY n_cp DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, s AS text_sha256 FROM w"""


def quality_rules() -> str:
    def failed(r) -> str:
        m = r.metric
        if m.startswith("if("):
            cond, a, b = m[3:-1].split(", ", 2)
            m = f"CASE WHEN {cond} THEN {a} ELSE {b} END"
        m = m.replace("/ nullif", "* 1.0 / nullif")
        parts = ([f"({m}) < {r.low}"] if r.low is not None else []) + ([f"({m}) > {r.high}"] if r.high is not None else [])
        return f"coalesce({' OR '.join(parts)}, true)"

    stops = ", ".join(_q(w) for w in stop_word_list())
    base = " OR ".join(failed(r) for r in BASE_RULES)
    names = ", ".join(f"CASE WHEN {failed(r)} THEN '{r.name}' END" for r in (*BASE_RULES, *RULES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{WS}+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ln FROM d),
win AS (SELECT rid, i, array_to_string(w[i:i+4], chr(0)) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
dup AS (SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + 5) AS nx
        FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, sum(least(5, nx - i))::BIGINT AS n FROM dup GROUP BY rid),
c AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
        (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(ln)::BIGINT AS n_lines,
        len(list_filter(w, lambda x: x IN ({stops})))::BIGINT AS n_stop_words FROM w LEFT JOIN rep USING (rid)),
f AS (SELECT *, {base} AS base_failed, list_filter([{names}], lambda x: x IS NOT NULL) AS f FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(f) = 0 AS kept, n_lines, n_stop_words,
       array_to_string(f, '|') AS failed_rules FROM f"""


def substring_doubling(window: int = 35) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{WS}+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i:i+{window - 1}], ' ')) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {window - 2})) AS i FROM d WHERE len(w) >= {window})),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
pos AS (SELECT rid, w[p] AS word, p FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
last AS (SELECT pos.rid, pos.p, pos.word, rep.i AS start FROM pos ASOF LEFT JOIN rep ON pos.rid = rep.rid AND pos.p >= rep.i),
k AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM last WHERE start IS NULL OR p > start + {window - 1} GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)"""


def warc_transactions() -> str:
    at = " || ".join(f"substr('{BASE32}', ((('0x' || substr(h, {1 + 10 * g}, 10))::BIGINT >> {35 - 5 * j}) & 31)::INT + 1, 1)" for g in range(4) for j in range(8))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, url FROM pages),
h AS (SELECT page_id, url, octet_length(encode(t))::BIGINT AS payload_bytes, sha1(t) AS h FROM p),
r AS (SELECT *, first_value(page_id) OVER o AS head, row_number() OVER o AS rn
      FROM h WINDOW o AS (PARTITION BY h ORDER BY page_id NULLS LAST, url ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT page_id, payload_bytes, {at} AS payload_digest, CASE WHEN rn = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rn > 1 THEN head END AS refers_to FROM r"""


def _canonical(text: str) -> str:
    t = f"translate(replace({text}, chr(13), ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    t = f"regexp_replace({t}, {_q(licenses.COPYRIGHT_LINE)}, '\\1', 'g')"
    for a, b in licenses.SPELLINGS:
        t = f"replace({t}, {_q(a)}, {_q(b)})"
    return f"trim(regexp_replace({t}, {_q(licenses.PUNCTUATION)}, ' ', 'g'), ' ')"


def license_scan() -> str:
    known = ", ".join(f"({_q(i)}, {_q(t)})" for i, t in licenses.KNOWN)
    digests = ", ".join(f"({_q(i)}, {_q(t)})" for i, t in licenses.DIGESTS)
    return f"""
WITH k0 AS (SELECT license_id, {_canonical('t')} AS c FROM (VALUES {known}) v(license_id, t)),
k AS (SELECT h, min(license_id) AS license_id FROM (SELECT sha256(c) AS h, license_id FROM k0 WHERE c <> '' UNION ALL SELECT h, license_id FROM (VALUES {digests}) v(license_id, h)) GROUP BY h),
d AS (SELECT doc_id, {_canonical("coalesce(text, '')")} AS c FROM documents)
SELECT doc_id, sha256(c) AS canonical_sha256, length(c)::BIGINT AS canonical_chars, license_id FROM d LEFT JOIN k ON sha256(c) = k.h"""


def line_dedup(max_percent: int = 30, min_pages: int = 2) -> str:
    t = "coalesce(html, '')"
    for p in lines.NOT_TEXT:
        t = f"regexp_replace({t}, {_q(p)}, '', 'g')"
    t = f"regexp_replace(regexp_replace({t}, {_q(lines.BLOCK_TAG)}, chr(10), 'g'), {_q(lines.ANY_TAG)}, '', 'g')"
    return f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, lower(coalesce(regexp_extract(url, {_q(lines.HOST)}, 2), '')) AS host, {t} AS t FROM pages),
l AS (SELECT rid, page_id, host, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, chr(32) || chr(9) || chr(13) || chr(11) || chr(12))), lambda x: x <> '') AS ls FROM p),
u AS (SELECT rid, host, unnest(list_distinct(ls)) AS line FROM l),
n AS (SELECT host, line, count(*) AS n FROM u GROUP BY ALL),
tot AS (SELECT host, count(*) AS total FROM l GROUP BY host),
b AS (SELECT host, line FROM n JOIN tot USING (host) WHERE n >= {min_pages} AND n * 100 > total * {max_percent}),
bl AS (SELECT host, list(line) AS drops FROM b GROUP BY host),
k AS (SELECT page_id, l.host, len(ls)::BIGINT AS n_lines, list_filter(ls, lambda x: NOT list_contains(coalesce(drops, []), x)) AS ks FROM l LEFT JOIN bl ON l.host = bl.host)
SELECT page_id, host, n_lines, n_lines - len(ks) AS n_dropped, sha256(array_to_string(ks, chr(10))) AS kept_sha256 FROM k"""


def _winner(nodes) -> str:
    """The node with the smallest draw; a draw is that of ``sharding._draw``."""
    if len(nodes) == 1:
        return str(nodes[0].value)
    out = []
    for node in nodes:
        a, b, c = node.constants()
        u = f"(k1 * {a} + k2 * {b} + {c}) % {sharding.PRIME}"
        u = f"((({u}) * 48271 + (({u}) >> 7)) % {sharding.PRIME})"
        out.append(f"{{'draw': -ln(({u} + 1) / {float(sharding.PRIME + 1)}) / {float(node.weight)}, 'value': {node.value}}}")
    return f"list_min([{', '.join(out)}]).value"


def _descend(source: str, out: str, leaves, name: str) -> str:
    """Three steps down: ``out`` is ``source`` with the shard as ``name``."""
    regions = sharding.tree(leaves)
    case = lambda col, branches: f"CASE {col} " + " ".join(f"WHEN {v} THEN {x}" for v, x in branches) + " END"
    rack = case("region", [(r.value, _winner(r.children)) for r in regions])
    shard = case("region", [(r.value, case("rack", [(k.value, _winner(k.children)) for k in r.children])) for r in regions])
    return f"""{out}1 AS (SELECT *, {_winner(regions)} AS region FROM {source}),
{out}2 AS (SELECT *, {rack} AS rack FROM {out}1),
{out} AS (SELECT * EXCLUDE (region, rack), {shard} AS {name} FROM {out}2)"""


def hash_tree_shards(n_shards: int = 24) -> str:
    """CRC-32 of the bytes by a table of the reversed polynomial, which SQL makes for itself."""
    return f"""
WITH RECURSIVE bits(b, c, k) AS (
  SELECT b, b, 0 FROM range(256) t(b) UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS x, md5(coalesce(doc_id::VARCHAR, 'null')) AS m FROM documents),
e AS (SELECT doc_id, (octet_length(encode(x)) + 8)::BIGINT AS size, hex(encode(x)) AS h,
        ('0x' || substr(m, 1, 7))::BIGINT AS k1, ('0x' || substr(m, 8, 7))::BIGINT AS k2 FROM d),
f AS (SELECT doc_id, size, k1, k2, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM e, tab),
{_descend("f", "g", sharding.layout(n_shards), "shard")},
{_descend("g", "h", sharding.layout(n_shards + 1), "grown_shard")}
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, grown_shard::INT AS grown_shard FROM h"""
