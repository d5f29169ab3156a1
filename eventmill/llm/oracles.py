"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from eventmill.llm import codes, licenses, line_frequency, pii

OP8 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, source,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM d),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(3) AS r(j) GROUP BY doc_id),
base AS (SELECT w.doc_id, source, t, len(ws)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
         FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
texts AS (SELECT DISTINCT source, t FROM d),
lines AS (SELECT source, t, unnest(list_filter(
            list_transform(string_split(t, chr(10)), lambda x:
              lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g')))), lambda x: x <> '')) AS line FROM texts),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM lines GROUP BY source),
freq AS (SELECT l.source, line, min(md5(t)) AS keeper FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
         GROUP BY l.source, line, h.n HAVING count(DISTINCT t) >= 20 AND count(DISTINCT t) > least(0.25 * h.n, 30)),
lost AS (SELECT l.source, l.t, sum(len(string_split(l.line, ' '))) AS n
         FROM lines l JOIN freq f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line AND md5(l.t) <> f.keeper
         GROUP BY l.source, l.t),
v AS (SELECT base.*, n_words < {line_frequency.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        coalesce(lost.n, 0)::BIGINT AS n_lost_words
      FROM base LEFT JOIN lost ON base.source IS NOT DISTINCT FROM lost.source AND base.t = lost.t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_lost_words <= 0.7 * n_words AS kept, n_lost_words
FROM v
"""


def _pii() -> str:
    # The same matches without look-around and possessive quantifiers, which RE2 runs in linear time.
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Za-z0-9]*[A-Z]{2}[0-9]{2}[A-Z0-9]{11}[A-Za-z0-9]*",
        "ssn": r"[0-9-]*[0-9]{3}-[0-9]{2}-[0-9]{4}[0-9-]*",
    }
    digits = "regexp_replace(s.m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 "
        f"THEN reverse({digits})[i]::INT ELSE reverse({digits})[i]::INT * 2 "
        f"- CASE WHEN reverse({digits})[i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
    )
    near = f"substr(t, greatest(s.st - {pii.NEAR}, 0) + 1, s.st + length(s.m) + {pii.NEAR} - greatest(s.st - {pii.NEAR}, 0))"
    mod97 = (
        "list_reduce(list_prepend(0, list_transform(string_split(substr(s.m, 5) || substr(s.m, 1, 4), ''), "
        "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END)), "
        "lambda r, x: CASE WHEN x < 10 THEN (r * 10 + x) % 97 ELSE (r * 100 + x) % 97 END) = 1"
    )
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(s.m, '.'), lambda p: NOT regexp_matches(p, '^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$'))) = 0",
        "card": f"length({digits}) BETWEEN 16 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
        "iban": f"CASE WHEN regexp_matches(s.m, '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}$') THEN {mod97} ELSE false END",
        "ssn": "regexp_matches(s.m, '^[0-9]{3}-[0-9]{2}-[0-9]{4}$') "
        f"AND regexp_matches({near}, '(?i)ssn|social security|tax')",
    }
    steps, prior = ["d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"], "d"
    for name, p in patterns.items():
        spans = (
            f"list_transform(range(1, len(h) + 1), lambda i: {{'m': h[i], 'st': coalesce(list_sum(list_transform("
            f"g[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0)::BIGINT}})"
        )
        steps.append(
            f"{name}_raw AS (SELECT * EXCLUDE (h, g), {spans} AS s_{name} FROM (SELECT *, regexp_extract_all(t, '{p}') AS h, "
            f"regexp_split_to_array(t, '{p}') AS g FROM {prior}))"
        )
        steps.append(
            f"{name}_ok AS (SELECT * EXCLUDE (s_{name}), list_transform(list_filter(s_{name}, lambda s: {valid[name]}), "
            f"lambda s: '{name}:' || s.st || ':' || (s.st + length(s.m))) AS {name} FROM {name}_raw)"
        )
        prior = f"{name}_ok"
    base = " || ".join(k.name for k in pii.BASE)
    every = " || ".join(k.name for k in pii.KINDS)
    counts = ", ".join(f"len({k.name})::BIGINT AS n_{k.name}" for k in pii.BASE)
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, {counts}, sha256(array_to_string({base}, ',')) AS base_sha256, "
        f"array_to_string({every}, ',') AS spans FROM {prior}"
    )


OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
        '([<\[])(\\*)(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])', '\1\\\2\3', 'g'))
      + length(regexp_replace(text, '([<\[])(\\*)(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])', '\1\\\2\3', 'g')) + 24 AS chars FROM r)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _licenses() -> str:
    labels = list(licenses.PHRASES.items())
    parts = []
    for phrase, label in labels:
        ws = phrase.split()
        test = " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(ws))
        parts.append(f"list_transform(list_filter(range(1, len(ws) + 1), lambda i: {test}), lambda i: {{'i': i - 1, 'l': '{label}'}})")
    places = " || ".join(parts)
    def listed(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]::VARCHAR[]"

    rows = ", ".join(
        f"({i}, '{label}', string_split('{text}', ' '), {listed(must)}, {listed(never)})"
        for i, (label, text) in enumerate(licenses.TEMPLATES)
        for must, never in [licenses.markers(sorted(set(text.split())))]
    )
    split = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    half, window = licenses.WINDOW // 2, licenses.WINDOW
    return f"""
WITH templates(id, label, raw, must, never) AS (VALUES {rows}),
t AS (SELECT label, list_distinct(raw) AS ws, must, never FROM templates),
d AS (SELECT doc_id, {low} AS t FROM documents),
w AS (SELECT doc_id, t, {split.format("t")} AS ws FROM d),
p AS (SELECT *, {places} AS places FROM w),
dl AS (SELECT DISTINCT doc_id, line FROM (
         SELECT doc_id, unnest(list_append(string_split(t, chr(10)), replace(t, chr(10), ' '))) AS line FROM d)
       WHERE regexp_matches(line, 'licen|permission|redistribut')),
lines AS (SELECT DISTINCT line FROM dl),
lw AS (SELECT line, {split.format("line")} AS lws FROM lines),
blocks AS (SELECT line, list_distinct(lws[i * {half} + 1 : i * {half} + {window}]) AS b
           FROM (SELECT line, lws, unnest(range(0, greatest(ceil(len(lws) / {half})::BIGINT - 1, 1))) AS i FROM lw)),
hits AS (SELECT line, label, max(len(list_intersect(b, t.ws)) / len(t.ws)) AS score FROM blocks, t
         WHERE len(list_intersect(b, t.ws)) >= CASE WHEN len(t.ws) <= {licenses.SHORT} THEN len(t.ws) ELSE ceil(0.8 * len(t.ws)) END
           AND list_has_all(b, must) AND NOT list_has_any(b, never) GROUP BY line, label),
doc_hits AS (SELECT doc_id, list(DISTINCT label) AS more, max(score) AS best
             FROM dl JOIN hits USING (line) GROUP BY doc_id)
SELECT p.doc_id, len(ws)::BIGINT AS n_words, len(places)::BIGINT AS n_base,
       list_min(list_transform(places, lambda x: x.i))::BIGINT AS first_word,
       list_max(list_transform(places, lambda x: x.i))::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.l))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.l) || coalesce(more, []))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM p LEFT JOIN doc_hits ON p.doc_id = doc_hits.doc_id
"""


def _codes() -> str:
    rounds = []
    for k in range(codes.ROUNDS + 1):
        rounds.append(f"""
a{k} AS MATERIALIZED (SELECT rn, p, min(struct_pack(d := d, e := e)) AS best FROM (
  SELECT v.rn, v.p, c.e, list_sum(list_transform(list_zip(v.xs, c.xs),
           lambda z: (z[1] - z[2])::HUGEINT * (z[1] - z[2])))::HUGEINT AS d
  FROM parts v JOIN c{k} c ON v.p = c.p) GROUP BY rn, p)""")
        if k < codes.ROUNDS:
            rounds.append(f"""
m{k} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS xs FROM (
  SELECT p, best.e AS e, i, sum(x)::HUGEINT AS s, count(*) AS n
  FROM (SELECT a.p, a.best, unnest(v.xs) AS x, generate_subscripts(v.xs, 1) AS i
        FROM a{k} a JOIN parts v ON a.rn = v.rn AND a.p = v.p) GROUP BY p, best.e, i) GROUP BY p, e),
c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.xs, c.xs) AS xs
  FROM c{k} c LEFT JOIN m{k} m ON c.p = m.p AND c.e = m.e)""")
    last = codes.ROUNDS
    return f"""
WITH kept AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rn
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
shape AS (SELECT ceil(max(len(embedding)) / 4.0)::BIGINT AS w FROM kept),
parts AS MATERIALIZED (SELECT rn, p, list_transform(range(p * w + 1, (p + 1) * w + 1),
    lambda i: floor({codes.SCALE} * coalesce(embedding[i], 0)::DOUBLE)::BIGINT) AS xs FROM kept, shape, range(4) AS r(p)),
c0 AS MATERIALIZED (SELECT p, rn AS e, xs FROM parts WHERE rn < {codes.ENTRIES}),
{",".join(rounds)},
book AS (SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{last}),
coded AS (SELECT rn, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM a{last} GROUP BY rn)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rn), book
"""


OP12 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
usable AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
  AND len(list_filter(x, lambda y: y <> 0)) > 0),
links AS MATERIALIZED (SELECT a.rid AS a, b.rid AS b FROM usable a JOIN usable b ON a.label = b.label AND a.rid <> b.rid
  WHERE len(a.x) = len(b.x) AND CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) END >= 0.98),
reach(rid, other) AS (SELECT rid, rid FROM v UNION SELECT r.rid, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT r.rid, min(v.vec_id) AS component_id FROM reach r JOIN v ON r.other = v.rid GROUP BY r.rid),
n AS (SELECT a AS rid, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (rid) LEFT JOIN n USING (rid)
"""

OP13 = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place FROM conversations),
convs AS (SELECT conv_id, max(place) AS own, conv_id - conv_id % 20 AS donor,
    CASE WHEN conv_id IS NULL THEN 0 ELSE xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda x: ord(x)::BIGINT), lambda c, x:
        list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z:
          CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END), 4294967295), 4294967295) % 4 END AS h
  FROM t GROUP BY conv_id),
given AS (SELECT c.conv_id, c.own, c.h, c.donor, least(c.h, coalesce(d.own, 0)) AS given
  FROM convs c LEFT JOIN convs d ON c.donor = d.conv_id),
rebuilt AS (
  SELECT g.conv_id, t.place AS depth, role, text FROM given g JOIN t ON g.donor = t.conv_id AND t.place <= g.given
  UNION ALL
  SELECT g.conv_id, t.place - h + given, role, text FROM given g JOIN t ON g.conv_id IS NOT DISTINCT FROM t.conv_id
  WHERE t.place > h),
path AS MATERIALIZED (
  SELECT conv_id, depth, list(struct_pack(role := role, text := text)) OVER
    (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS name, text FROM rebuilt
  UNION ALL SELECT conv_id, 0, [], '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS n_turns FROM path GROUP BY conv_id),
node AS MATERIALIZED (SELECT row_number() OVER () AS k, * FROM (
  SELECT name, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(list_filter(
      regexp_split_to_array(any_value(text), '[ 	-
]+'), lambda w: w <> '')) END AS saved,
    sha256(coalesce(string_agg(coalesce(p.conv_id::VARCHAR, ''), ',' ORDER BY p.conv_id NULLS LAST)
      FILTER (WHERE n_turns = depth), '')) AS ends_sha256
  FROM path p JOIN lengths l ON p.conv_id IS NOT DISTINCT FROM l.conv_id GROUP BY name, depth)),
children AS (SELECT p.k, count(*) AS n_children FROM node c JOIN node p ON c.depth = p.depth + 1 AND c.name[:-2] = p.name
  GROUP BY p.k),
above AS (SELECT n.k, a.k AS ancestor FROM node n JOIN path p ON n.conv_id IS NOT DISTINCT FROM p.conv_id
    AND p.depth <= n.depth JOIN node a ON a.name = p.name),
totals AS (SELECT ancestor AS k, sum(saved)::BIGINT AS saved_tokens,
    count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM above JOIN node USING (k) LEFT JOIN children USING (k) GROUP BY ancestor)
SELECT node.conv_id, node.depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves, saved_tokens, node.ends_sha256
FROM node JOIN totals USING (k) LEFT JOIN children USING (k)
LEFT JOIN node p ON node.depth = p.depth + 1 AND node.name[:-2] = p.name
"""

ORACLES = {
    "op3_line_frequency": OP3,
    "op5_license_join": _licenses(),
    "op8_exact_dedup": OP8,
    "op9_personal_data": _pii(),
    "op10_chat_format": OP10,
    "op11_walsh_codes": _codes(),
    "op12_embedding_dedup": OP12,
    "op13_prefix_trie": OP13,
}
