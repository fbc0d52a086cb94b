"""DuckDB SQL for the operator queries that SQL can express."""

from __future__ import annotations

from .chat import ChatWindows
from .hard_negatives import Mining
from .line_dedup import LineRules
from .mixing import Mix
from .quality import QualityRules
from .topk import TopK

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


def quality_sql(rules: QualityRules = QualityRules()) -> str:
    strip = lambda n, p: f"regexp_replace({n}, '{p}', '', 'g')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, nullif(lang, '') AS lang FROM documents),
s AS (SELECT *, {_WORDS} AS ws, {strip('t', r'\p{Ll}+')} AS r1 FROM d),
s2 AS (SELECT *, {strip('r1', r'[\x20\x09-\x0D]+')} AS r2 FROM s),
s3 AS (SELECT *, {strip('r2', r'\p{Lu}+')} AS r3 FROM s2),
s4 AS (SELECT *, {strip('r3', r'\p{N}+')} AS r4 FROM s3),
s5 AS (SELECT *, {strip('r4', r'[.,;:''"()?!-]+')} AS r5 FROM s4),
s6 AS (SELECT *, {strip('r5', r'[#*$%&|<>]+')} AS r6 FROM s5),
c AS (SELECT rid, lang, unnest([1, 2, 3, 4, 5, 6, 7]) AS k,
        unnest([length(t) - length(r1), length(r1) - length(r2), length(r2) - length(r3), length(r3) - length(r4),
                length(r4) - length(r5), length(r5) - length(r6), length(r6)]) AS n FROM s6),
wd AS (SELECT rid, lang, unnest(ws) AS word FROM s6),
wc AS (SELECT lang, word, count(*) AS n FROM wd WHERE lang IS NOT NULL GROUP BY ALL),
tot AS (SELECT lang, sum(n) AS total FROM wc GROUP BY lang HAVING sum(n) >= {rules.min_ref_words}),
top AS (SELECT wc.*, tot.total FROM wc JOIN tot ON wc.lang = tot.lang
        QUALIFY row_number() OVER (PARTITION BY wc.lang ORDER BY n DESC, word) <= {rules.common_words}),
rw AS (SELECT lang, word, n * 1.0 / total AS q FROM top
       UNION ALL SELECT lang, NULL, (any_value(total) - sum(n)) * 1.0 / any_value(total) FROM top GROUP BY lang),
rc0 AS (SELECT lang, k, sum(n) AS n FROM c WHERE lang IS NOT NULL GROUP BY ALL),
rc AS (SELECT lang, k, n * 1.0 / sum(n) OVER (PARTITION BY lang) AS q FROM rc0),
doc AS (SELECT s6.rid, s6.doc_id, s6.t, s6.ws, len(s6.ws) AS n_words, tot.lang AS ref
        FROM s6 LEFT JOIN tot ON s6.lang = tot.lang),
cd AS (SELECT doc.rid, c.n * 1.0 / sum(c.n) OVER (PARTITION BY doc.rid) AS p, rc.q
       FROM doc JOIN c USING (rid) JOIN rc ON rc.k = c.k AND rc.lang = doc.ref WHERE length(doc.t) >= {rules.min_class_chars}),
cdist AS (SELECT rid, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
            + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS dist FROM cd GROUP BY rid),
hits AS (SELECT doc.rid, rw.word, count(*) AS n FROM doc JOIN wd USING (rid)
         JOIN rw ON rw.word = wd.word AND rw.lang = doc.ref GROUP BY ALL),
bins AS (SELECT doc.rid, rw.word, rw.q, doc.n_words, coalesce(hits.n, 0) AS n FROM doc
         JOIN rw ON rw.lang = doc.ref LEFT JOIN hits ON hits.rid = doc.rid AND hits.word = rw.word
         WHERE doc.n_words >= {rules.min_dist_words}),
wp AS (SELECT rid, q, CASE WHEN word IS NULL THEN n_words - sum(n) OVER (PARTITION BY rid) ELSE n END * 1.0 / n_words AS p FROM bins),
wdist AS (SELECT rid, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
            + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS dist FROM wp GROUP BY rid),
pos AS (SELECT rid, unnest(range(1, n_words - {rules.window - 2})) AS i FROM doc WHERE n_words >= {rules.window}),
win AS (SELECT rid, i, array_to_string(ws[i : i + {rules.window - 1}], ' ') AS v FROM pos JOIN doc USING (rid)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, v) > 1),
cov AS (SELECT rid, least({rules.window}, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, {rules.window})) AS n FROM twice),
rep AS (SELECT rid, sum(n) AS n FROM cov GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM doc),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
res AS (SELECT doc.doc_id, n_words, length({strip('doc.t', r'[\x20\x09-\x0D]+')}) AS word_chars,
          length(doc.t) - length({strip('doc.t', r'[#*$%&|<>]')}) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
          coalesce(rep.n, 0) AS n_repeat_words,
          n_words < {rules.min_words} OR 100 * coalesce(rep.n, 0) > {rules.max_repeat_pct} * n_words AS base_failed,
          coalesce(cdist.dist > {rules.max_class_distance}, false) OR coalesce(wdist.dist > {rules.max_word_distance}, false) AS far
        FROM doc LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN cdist USING (rid) LEFT JOIN wdist USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT far AS kept FROM res"""


def line_sql(rules: LineRules = LineRules()) -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, coalesce(text, '') AS t, coalesce('s' || source, 'null') AS site FROM documents),
p AS (SELECT rid, doc_id, text, site, string_split(t, chr(10)) AS ls FROM d),
l AS (SELECT rid, site, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS raw FROM p),
k AS (SELECT rid, site, i, raw, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM l),
shared AS (SELECT line FROM k WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= {rules.min_sites}),
f AS (SELECT k.*, k.line <> '' AS full_line, shared.line IS NOT NULL AS hit FROM k LEFT JOIN shared ON shared.line = k.line),
n AS (SELECT rid, count(*) FILTER (full_line) AS n_lines, count(*) FILTER (hit) AS n_shared,
        string_agg(raw, chr(10) ORDER BY i) FILTER (NOT hit) AS kept FROM f GROUP BY rid),
r AS (SELECT d.doc_id, d.text, n.*, n_shared > 0 AND n_shared < n_lines AS cuts FROM d JOIN n USING (rid))
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_shared AS BIGINT) AS n_shared,
  CAST(CASE WHEN cuts THEN n_shared ELSE 0 END AS BIGINT) AS n_removed,
  CASE WHEN cuts THEN coalesce(kept, '') ELSE text END AS text FROM r"""


def mix_sql(mix: Mix = Mix()) -> str:
    weights = ", ".join(str(float(w)) for w in mix.weights)
    epochs = ", ".join(str(e) for e in range(mix.max_epochs))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('{mix.seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        ([{weights}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.weights)} + 1]::DOUBLE AS w FROM d GROUP BY source),
f AS (SELECT *, source_size * {mix.max_epochs} AS cap, sum(source_size) OVER ()::DOUBLE * {mix.budget} AS budget,
        coalesce(sum(source_size * {mix.max_epochs}) OVER q, 0)::DOUBLE AS stopped, sum(w) OVER () - coalesce(sum(w) OVER q, 0) AS open
      FROM s WINDOW q AS (ORDER BY source_size * {mix.max_epochs} / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (budget - stopped) / open AS share FROM f),
v AS (SELECT arg_min(share, stopped) AS level FROM l WHERE share * w <= cap),
t AS (SELECT source, source_size, CASE WHEN level IS NULL OR level * w > cap THEN cap::DOUBLE ELSE level * w END AS target FROM l, v),
p AS (SELECT d.*, t.source_size, t.target, sum(size) OVER q AS upto, row_number() OVER q AS slot FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
      WINDOW q AS (PARTITION BY d.source ORDER BY o, doc_id NULLS FIRST, size, rid ROWS UNBOUNDED PRECEDING)),
c AS (SELECT rid, source, epoch, slot, size, CAST(upto + epoch * source_size AS DOUBLE) / target AS finish FROM p, (SELECT unnest([{epochs}]) AS epoch) WHERE size > 0),
z AS (SELECT rid, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, slot ROWS UNBOUNDED PRECEDING) - size AS position FROM c),
k AS (SELECT rid, sum(least(size, budget - position)) AS n FROM z, (SELECT floor(sum(size) * {mix.budget}) AS budget FROM d) WHERE position < budget GROUP BY rid)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(k.n, 0) AS BIGINT) AS taken FROM p LEFT JOIN k USING (rid)"""


def chat_sql(conf: ChatWindows = ChatWindows()) -> str:
    said = "'\\### Assistant: </turn> ok'"
    escaped = lambda c: f"length({c}) + length({c}) - length(translate({c}, '\\<>', ''))"
    low = max(1, conf.budget // 4)
    return rf"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said}),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 3 AS tokens, {escaped('role')} + {escaped('text')} + 16 AS chars FROM a),
h0 AS (SELECT *, first_value(role) OVER q = '{conf.system}' AS has, greatest(1, {conf.budget}
        - CASE WHEN first_value(role) OVER q = '{conf.system}' THEN first_value(tokens) OVER q ELSE 0 END) AS room
      FROM r WINDOW q AS (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
h AS (SELECT *, greatest(0, least({conf.history}, room - {low})) AS past, room - greatest(0, least({conf.history}, room - {low})) AS stride FROM h0),
b AS (SELECT *, has AND i = 1 AS sys, sum(CASE WHEN has AND i = 1 THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)
        - CASE WHEN has AND i = 1 THEN 0 ELSE tokens END AS beg FROM h),
s AS (SELECT *, CASE WHEN sys THEN -1 ELSE 2 * floor(beg / stride) + CASE WHEN floor(beg / stride) = floor((beg + tokens - 1) / stride) THEN 0 ELSE 1 END END AS span FROM b),
w AS (SELECT conv_id, span, min(beg) AS start FROM s WHERE span >= 0 GROUP BY ALL),
again AS (SELECT s.conv_id, sum(s.chars) AS n FROM s JOIN w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.span > s.span
          AND (s.sys OR (w.start > s.beg AND w.start - s.beg <= s.past)) WHERE NOT (s.sys AND w.start = 0) GROUP BY s.conv_id),
c AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY i) FILTER (role = '{conf.target}'), '') AS loss, sum(chars) AS chars FROM s GROUP BY conv_id)
SELECT c.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars + coalesce(again.n, 0) AS BIGINT) AS formatted_chars
FROM c LEFT JOIN again ON again.conv_id IS NOT DISTINCT FROM c.conv_id"""


def topk_sql(conf: TopK = TopK()) -> str:
    return rf"""
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: floor({conf.scale} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM (SELECT DISTINCT vec_id, v FROM n WHERE vec_id % 50 = 0) q JOIN n c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
QUALIFY rank <= {conf.k}"""


def trie_sql() -> str:
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), "
           "lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)")
    path = lambda n: f"sha256(array_to_string(list_transform(t[1:{n}], lambda x: x.id), ''))"
    return rf"""
WITH a AS (SELECT conv_id, turn, left(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS id,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'id': id, 'w': w}} ORDER BY turn NULLS FIRST, id) AS t FROM a GROUP BY conv_id),
k AS (SELECT conv_id, t, conv_id - conv_id % 20 AS host, {crc} % 4 AS h FROM o),
r AS (SELECT k.conv_id, list_concat(coalesce(o.t[1:k.h], []), k.t[k.h + 1:]) AS t FROM k LEFT JOIN o ON o.conv_id = k.host),
p AS (SELECT conv_id, t, len(t) AS n, unnest(range(0, len(t) + 1)) AS depth FROM r),
q AS (SELECT conv_id, depth, n, {path('depth')} AS path, CASE WHEN depth > 0 THEN {path('depth - 1')} END AS parent,
        CASE WHEN depth > 0 THEN t[depth].w ELSE 0 END AS w FROM p),
nodes AS (SELECT path, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w, max(n) > depth AS inner_node,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM q GROUP BY path, depth),
sub AS (SELECT q.path AS top, count(*) FILTER (NOT inner_node) AS n_leaves, sum((n_convs - 1) * nodes.w) AS saved
        FROM nodes JOIN q ON q.conv_id = nodes.conv_id AND q.depth <= nodes.depth GROUP BY top),
ch AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n, 0) AS n_children, sub.n_leaves,
  CAST(sub.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sub ON sub.top = n.path LEFT JOIN ch ON ch.parent = n.path LEFT JOIN nodes u ON u.path = n.parent"""


def negatives_sql(conf: Mining = Mining()) -> str:
    low, high = conf.window
    return rf"""
WITH n AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
v AS (SELECT rid, vec_id, label, list_transform(embedding, lambda x: floor({conf.scale} * x::DOUBLE)) AS v FROM n
      WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT vec_id AS anchor_id, label, v, min(rid) AS aid FROM v WHERE vec_id % 100 = 0 GROUP BY ALL),
s AS (SELECT aid, anchor_id, v.vec_id AS id, v.label = a.label AS same, CAST(list_inner_product(a.v, v.v) AS BIGINT) AS score
      FROM a JOIN v ON v.vec_id <> a.anchor_id AND len(v.v) = len(a.v)),
p AS (SELECT aid, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY aid ORDER BY score DESC, id) AS pr
      FROM s WHERE same QUALIFY pr <= {conf.positives})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.aid, pr ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.aid = p.aid AND NOT s.same AND {low} * positive_score <= 100 * s.score AND 100 * s.score <= {high} * positive_score
QUALIFY rank <= {conf.negatives}"""
