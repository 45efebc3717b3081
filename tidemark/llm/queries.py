"""One query per operator, and DuckDB SQL for those SQL can express."""

from __future__ import annotations

from .chunk_dedup import op5
from .collocations import op13
from .decontaminate import op7
from .divergence import op12
from .kernel_quality import op11
from .lm_scores import op9
from .packing import op10
from .parity_join import op4
from .quality import op8
from .range_coder import op2
from .sharding import op3
from .token_counts import op6
from .toxicity import op1

QUERIES = {
    "op1_toxicity": op1,
    "op2_token_ids": op2,
    "op3_sharding": op3,
    "op4_parity_join": op4,
    "op5_chunk_dedup": op5,
    "op6_token_counts": op6,
    "op7_decontamination": op7,
    "op8_quality_rules": op8,
    "op9_lm_scores": op9,
    "op10_packing": op10,
    "op11_kernel_quality": op11,
    "op12_source_divergence": op12,
    "op13_collocations": op13,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op4_parity_join": rf"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
          FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM both_ JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
      WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT DISTINCT a AS d, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.d),
least_ AS (SELECT d, min(m) AS m FROM r GROUP BY d)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least_.m, documents.doc_id) AS component_id
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id LEFT JOIN least_ ON least_.d = documents.doc_id""",
    "op7_decontamination": rf"""
WITH
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT item_id, least(len(w), 10) AS l, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS s FROM v),
ls AS (SELECT DISTINCT l FROM win),
p AS (SELECT doc_id, l, w, unnest(range(1, len(w) - l + 2)) AS i FROM d, ls WHERE len(w) >= l),
hit AS (SELECT DISTINCT doc_id, i, p.l, item_id FROM p JOIN win ON win.l = p.l AND win.s = array_to_string(w[i:i + p.l - 1], ' ')),
at_ AS (SELECT DISTINCT doc_id, unnest(range(i, i + l)) AS k FROM hit),
nh AS (SELECT doc_id, count(*) AS n FROM at_ GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(nh.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, coalesce(nh.n, 0) > 0 AS contaminated
FROM d LEFT JOIN nh ON nh.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id""",
    "op12_source_divergence": rf"""
WITH
d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
             regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT lang, source, doc, unnest(w) AS t FROM d),
k AS (SELECT lang, t FROM o GROUP BY lang, t HAVING count(DISTINCT doc) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, t, count(*) AS n FROM o JOIN k USING (lang, t) GROUP BY lang, source, t),
lc AS (SELECT lang, t, sum(n) AS n FROM c GROUP BY lang, t),
ln AS (SELECT lang, sum(n) AS n FROM lc GROUP BY lang),
gn AS (SELECT lang, source, coalesce(any_value(v.v), 0) AS v, coalesce(sum(c.n), 0) AS n
       FROM g LEFT JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT gn.lang, gn.source, k.t, coalesce(c.n, 0) AS n,
             CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (gn.n + gn.v) AS HUGEINT) AS p
      FROM gn JOIN k ON k.lang = gn.lang LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.t = k.t),
q AS (SELECT lang, lc.t, CAST(1 + (1000000000::HUGEINT * (lc.n + 1)) // (ln.n + v.v) AS HUGEINT) AS q
      FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.t AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value
          FROM p JOIN q ON p.lang = q.lang AND p.t = q.t WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200""",
    "op13_collocations": rf"""
WITH
d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS k)) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM g WHERE k > 1 AND f >= 10),
cut AS (SELECT lang, k, g, f, w, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cut.lang, cut.k, cut.g, cut.f, cut.j, a.f AS l, b.f AS r,
             (1000000::HUGEINT * cut.f * cut.f) // (a.f::HUGEINT * b.f) AS score
      FROM cut JOIN g AS a ON a.lang = cut.lang AND a.g = x JOIN g AS b ON b.lang = cut.lang AND b.g = y
      QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.g ORDER BY score, j) = 1),
inner_ AS (SELECT lang, g, max(f) AS f FROM (SELECT lang, array_to_string(w[1:2], ' ') AS g, f FROM c WHERE k = 3
           UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM c WHERE k = 3) GROUP BY lang, g),
r AS (SELECT s.lang, s.g AS phrase, s.f AS a, s.l, s.r, CAST(s.score AS BIGINT) AS score,
             row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.f DESC, s.g) AS rank
      FROM s LEFT JOIN inner_ AS i ON i.lang = s.lang AND i.g = s.g WHERE i.f IS NULL OR 100 * i.f < 50 * s.f)
SELECT r.lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000""",
}
