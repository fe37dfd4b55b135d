"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .mixing import Mix
from .secrets import BASE, RULES
from .urlfilter import POLICY, Tree, policies

_WS = r"[\x20\x09-\x0D]+"
_WORDS = f"[x FOR x IN string_split_regex(coalesce(text, ''), '{_WS}') IF x <> '']"

OP7 = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
l AS (SELECT rid, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM w),
g AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
d AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
s AS (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS k FROM d),
r AS (SELECT rid, sum(k) AS n FROM s GROUP BY rid),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN l USING (rid) LEFT JOIN r USING (rid)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_dup_lines > 40 * n_lines) AS kept
FROM f
"""


def _op4() -> str:
    finds = " UNION ALL ".join(
        f"""SELECT rid, '{r.kind}' AS kind, {k} AS ord, unnest(range(1, len(a) + 1)) AS i, a, g, p FROM (
        SELECT rid, regexp_extract_all(t, '{r.pattern.replace("'", "''")}', 0) AS a, regexp_extract_all(t, '{r.pattern.replace("'", "''")}', {r.group}) AS g,
        string_split_regex(t, '{r.pattern.replace("'", "''")}') AS p FROM d)"""
        for k, r in enumerate(RULES))
    least = "CASE kind " + " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in RULES) + " END"
    kinds = ", ".join(f"'{r.kind}'" for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({finds}),
c AS (SELECT rid, kind, ord, length(a[i]) AS n, length(g[i]) AS gn,
  sum(length(p[i])) OVER (PARTITION BY rid, kind ORDER BY i) + sum(length(a[i])) OVER (PARTITION BY rid, kind ORDER BY i) - length(a[i]) AS pos FROM m),
s AS (SELECT rid, kind, ord, pos, kind || ':' || pos::BIGINT || ':' || (pos + n)::BIGINT AS x FROM c WHERE gn >= {least}),
j AS (SELECT rid, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
  string_agg(x, ',' ORDER BY pos, ord) FILTER (kind IN ({kinds})) AS base, string_agg(x, ',' ORDER BY pos, ord) AS spans FROM s GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (rid)
"""


def _op2(m: Mix = Mix()) -> str:
    weights = "[" + ", ".join(f"{float(x)}" for x in m.weights) + "]"

    def apportioned(src: str, out: str, share: str, by: str, key: str, seats: str, name: str) -> str:
        part, same = (f"PARTITION BY {by}", f"r.{by} IS NOT DISTINCT FROM q.{by} AND ") if by else ("", "")
        cols = f"{by}, {key}" if by else key
        return f"""
{out}_a AS (SELECT *, ({seats})::DOUBLE AS n_, sum({share}) OVER ({part}) AS sum_, count(*) OVER ({part}) / 2.0 AS half_ FROM {src}),
{out}_b AS (SELECT *,
  greatest(0, CASE WHEN {share} > 0 AND n_ > half_ THEN floor({share} * (n_ - half_) / sum_ + 0.5) ELSE 0 END::BIGINT - 1) AS low_,
  CASE WHEN {share} > 0 THEN ceil({share} * (n_ + half_) / sum_ + 0.5) ELSE 0 END::BIGINT + 1 AS high_ FROM {out}_a),
{out}_c AS (SELECT *, (n_ - sum(low_) OVER ({part}))::BIGINT AS left_ FROM {out}_b),
{out}_d AS (SELECT {cols}, {share} AS t_, left_, unnest(range(low_, high_ + 1)) AS k_ FROM {out}_c WHERE {share} > 0),
{out}_e AS (SELECT {cols}, left_, row_number() OVER ({part} ORDER BY t_ / (2 * k_ + 1) DESC, {key} NULLS LAST, k_) AS r_ FROM {out}_d),
{out}_f AS (SELECT {cols}, count(*) AS more_ FROM {out}_e WHERE r_ <= left_ GROUP BY {cols}),
{out} AS (SELECT r.*, (r.low_ + coalesce(q.more_, 0))::BIGINT AS {name} FROM {out}_c r LEFT JOIN {out}_f q ON {same}r.{key} IS NOT DISTINCT FROM q.{key})"""

    digest = lambda *x: "md5(" + " || ':' || ".join(f"coalesce(({y})::VARCHAR, '\\N')" for y in x) + ")"
    number = lambda x: f"('0x' || substr({x}, 1, 8))::BIGINT"
    seed = f"'{m.seed}'"
    return f"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(text, '')) AS tie FROM documents),
s0 AS (SELECT source AS src, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY source),
s1 AS (SELECT *, ({weights})[(row_number() OVER (ORDER BY src NULLS LAST) - 1) % {len(m.weights)} + 1] AS w, {m.most}.0 * source_size AS cap, {m.share} * sum(source_size) OVER () AS total FROM s0),
s2 AS (SELECT *, cap / w AS ratio FROM s1),
s3 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY ratio, src NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + ratio * sum(w) OVER (ORDER BY ratio, src NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= total AS full_ FROM s2),
s4 AS (SELECT *, sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER () AS spent, sum(CASE WHEN full_ THEN 0 ELSE w END) OVER () AS sharing FROM s3),
s5 AS (SELECT src, source_size, docs, CASE WHEN full_ OR sharing = 0 THEN cap ELSE least(cap, w * (total - spent) / sharing) END::DOUBLE AS target FROM s4),
s6 AS (SELECT *, greatest(1, least({m.block}, floor(coalesce(min(target) FILTER (target > 0) OVER (), 1.0) / {m.per_source})))::BIGINT AS block FROM s5),
s7 AS (SELECT *, round(sum(target) OVER () / block) AS all_ FROM s6),
{apportioned("s7", "s8", "target", "", "src", "all_", "quota")},
s9 AS (SELECT src, source_size, target, block, quota, greatest(1, least(ceil(docs / {m.shard_docs}.0), ceil(4 * sqrt(docs)), floor(source_size / ({m.shard_blocks}.0 * block))))::BIGINT AS shards FROM s8),
p AS (SELECT d.*, s9.*, {digest(seed, "d.doc_id", "d.tie")} AS h, {number(digest(seed, "d.doc_id", "d.tie"))} % s9.shards AS shard FROM d JOIN s9 ON d.source IS NOT DISTINCT FROM s9.src),
h00 AS (SELECT src, shard, any_value(quota) AS quota, any_value(block) AS block, any_value(source_size) AS source_size, sum(size)::BIGINT AS shard_size FROM p GROUP BY src, shard),
h01 AS (SELECT *, CASE WHEN shard_size > 0 THEN greatest(1, round(shard_size / block::DOUBLE)) ELSE 0 END::BIGINT AS blocks FROM h00),
h0 AS (SELECT *, least({m.most} * sum(blocks) OVER (PARTITION BY src), CASE WHEN sum(blocks) OVER (PARTITION BY src) > 0
  THEN round((quota * block * sum(blocks) OVER (PARTITION BY src))::DOUBLE / source_size) ELSE 0 END) AS seats FROM h01),
{apportioned("h0", "h1", "blocks", "src", "shard", "seats", "q")},
h3 AS (SELECT *, {number(digest(seed, "src", "shard"))} % blocks AS first_ FROM h1 WHERE blocks > 0),
h4 AS (SELECT *, q // blocks AS copies, first_ + q % blocks AS end_ FROM h3),
h5 AS (SELECT src AS s_, shard AS k_, copies, (first_ * shard_size) // blocks AS r0, (least(end_, blocks) * shard_size) // blocks AS r1, (greatest(0, end_ - blocks) * shard_size) // blocks AS w1 FROM h4),
o AS (SELECT *, sum(size) OVER (PARTITION BY src, shard ORDER BY h, doc_id NULLS FIRST, tie, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS begin_ FROM p)
SELECT doc_id, size, source_size, target,
  coalesce(copies * size + least(greatest(r1 - begin_, 0), size) - least(greatest(r0 - begin_, 0), size) + least(greatest(w1 - begin_, 0), size), 0)::BIGINT AS taken
FROM o LEFT JOIN h5 ON o.src IS NOT DISTINCT FROM h5.s_ AND o.shard = h5.k_
"""


#: Levels that the SQL of op5 spells out: more than any path of the given pages has.
LEVELS = 12


def _op5(t: Tree = Tree()) -> str:

    rules = sorted(policies(POLICY), key=lambda r: (len(r.name), r.verdict == "block", r.name), reverse=True)
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules]
    case = lambda f: "CASE " + " ".join(f"WHEN {x} THEN '{f(r)}'" for x, r in zip(fits, rules, strict=True)) + " END"
    levels = []
    for k in range(1, LEVELS + 1):
        src = f"t{k - 1}"
        levels.append(f"""
l{k} AS (SELECT *, CASE WHEN len(segs) >= {k} THEN segs[{k}] END AS seg,
  CASE WHEN len(segs) < {k + 1} THEN 0 WHEN len(segs) >= {k + 2} THEN 3 WHEN regexp_matches(segs[{k + 1}], '^[0-9]') THEN 1 ELSE 2 END AS shape FROM {src}),
k{k} AS (SELECT host, tpl, seg, sum(n) AS n, sum(labelled) AS lab, sum(bad) AS bad, {", ".join(f"sum(CASE WHEN shape = {i} THEN n ELSE 0 END) AS s{i}" for i in range(4))}
  FROM l{k} WHERE seg IS NOT NULL GROUP BY host, tpl, seg),
p{k} AS (SELECT host, tpl, count(*) AS kids, {", ".join(f"sum({c}) AS p_{c}" for c in ("n", "lab", "bad", "s0", "s1", "s2", "s3"))} FROM k{k} GROUP BY host, tpl),
b{k} AS (SELECT host, tpl, seg, CASE
  WHEN kids >= {t.min_children} AND n <= {t.max_share} * p_n THEN '*'
  WHEN kids > 1 AND ({" + ".join(f"abs(s{i} / n::DOUBLE - p_s{i} / p_n::DOUBLE)" for i in range(4))}) / 2 <= {t.distance} + 1 / sqrt(n) AND
    CASE WHEN p_lab = 0 THEN true WHEN lab = 0 THEN p_bad = 0 OR p_bad = p_lab
    ELSE abs(bad / lab::DOUBLE - p_bad / p_lab::DOUBLE) <= {t.z} * sqrt((p_bad / p_lab::DOUBLE) * (1 - p_bad / p_lab::DOUBLE) / lab) END THEN '~'
  ELSE seg END AS named FROM k{k} JOIN p{k} USING (host, tpl)),
t{k} AS (SELECT l.host, l.path, l.n, l.labelled, l.bad, l.segs, CASE WHEN l.seg IS NULL THEN l.tpl ELSE l.tpl || '/' || b.named END AS tpl
  FROM l{k} l LEFT JOIN b{k} b ON l.host = b.host AND l.tpl = b.tpl AND l.seg = b.seg)""")
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
r AS (SELECT page_id, CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
v AS (SELECT *, {case(lambda r: r.name)} AS rule, {case(lambda r: r.verdict)} AS ruled FROM h),
c AS (SELECT host, path, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS bad FROM v GROUP BY host, path),
t0 AS (SELECT *, string_split(path, '/')[2:] AS segs, '' AS tpl FROM c),
{",".join(levels)},
f AS (SELECT host, path, labelled, bad, tpl FROM t{LEVELS}),
q AS (SELECT host, tpl, sum(labelled) AS lab, sum(bad) AS bad FROM f GROUP BY host, tpl),
g AS (SELECT CASE WHEN sum(lab) > 0 THEN sum(bad) / sum(lab)::DOUBLE ELSE 0 END AS prior FROM q),
hh AS (SELECT host, (sum(bad) + {t.smooth} * any_value(prior)) / (sum(lab) + {t.smooth}) AS share FROM q, g GROUP BY host),
z AS (SELECT q.host, q.tpl, CASE WHEN (q.bad + {t.smooth} * hh.share) / (q.lab + {t.smooth}) >= {t.cut} THEN 'block' ELSE 'allow' END AS verdict FROM q JOIN hh USING (host))
SELECT v.page_id, v.host, v.path, v.rule, coalesce(v.ruled, z.verdict) AS verdict, f.tpl AS template
FROM v JOIN f USING (host, path) JOIN z ON z.host = f.host AND z.tpl = f.tpl
"""


OP10 = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id,
  [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WS}') IF x <> ''] AS ws FROM documents),
g AS (SELECT DISTINCT rid, array_to_string(ws[i:i + 3], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
b AS (SELECT x.rid AS a, y.rid AS b, count(*) AS i FROM g x JOIN g y ON x.g = y.g AND x.rid <> y.rid GROUP BY x.rid, y.rid),
e AS (SELECT a, b FROM b JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
c(rid, other) AS (SELECT rid, rid FROM w UNION SELECT c.rid, e.b FROM c JOIN e ON e.a = c.other)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM w LEFT JOIN n ON n.rid = w.rid JOIN c ON c.rid = w.rid JOIN w o ON o.rid = c.other GROUP BY w.rid, w.doc_id
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM (SELECT rid, lang, source, unnest(ws) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS total FROM c GROUP BY lang, term HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source)::HUGEINT AS own FROM cell),
p AS (SELECT s.lang, s.source, s.term, s.n, 1 + (1000000000 * (s.n + 5)) // (s.own + 5 * v.v) AS p, 1 + (1000000000 * (s.total + 5)) // (v.n + 5 * v.v) AS q FROM s JOIN v USING (lang)),
w AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(w.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN w ON w.lang = a.lang AND w.source = a.source AND w.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
"""

ORACLE = {"op2_mixing": _op2(), "op4_secrets": _op4(), "op5_urls": _op5(), "op7_quality": OP7, "op10_jaccard": OP10, "op12_divergence": OP12}
