"""DuckDB SQL for the corpus queries that SQL can express."""

from weir.llm.mixing import Mix
from weir.llm.quality_rules import LineLimits
from weir.llm.url_filters import Templates
from weir.llm.vector_codes import VectorCodes

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SPLIT = f"d AS (SELECT doc_id, text, source, {WORDS} AS ws FROM documents)"
REACHED = "r(id, reached) AS (SELECT id, id FROM ids UNION SELECT r.id, l.b FROM r JOIN l ON r.reached = l.a), c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id)"

OP1 = f"""WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  l AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.id <> b.id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
  ids AS (SELECT vec_id AS id FROM embeddings), {REACHED}
  SELECT id AS vec_id, (SELECT count(*) FROM l WHERE l.a = c.id) AS n_links, component_id, id = component_id AS kept FROM c"""

OP2 = f"""WITH {SPLIT},
  k AS (SELECT doc_id, s, md5(array_to_string(ws[s + 1:s + 35], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(len(ws) - 34)) AS s FROM d WHERE len(ws) >= 35)),
  g AS (SELECT DISTINCT doc_id, s + o AS i FROM (SELECT doc_id, s FROM k QUALIFY count(*) OVER (PARTITION BY h) > 1), range(35) t(o)),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d) w WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = w.doc_id AND g.i = w.i) GROUP BY doc_id)
  SELECT doc_id, len(ws)::BIGINT AS n_words, (SELECT count(*) FROM g WHERE g.doc_id = d.doc_id) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

_L = LineLimits()
OP3 = rf"""WITH {SPLIT},
  b AS (SELECT doc_id, coalesce(source, '') AS host, text, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
  w AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (SELECT doc_id, s, ws[s + 1:s + 3] AS g FROM (SELECT doc_id, ws, unnest(range(len(ws) - 2)) AS s FROM d WHERE len(ws) >= 3))),
  rep AS (SELECT doc_id, count(DISTINCT s + o) AS n_repeat_words FROM w, range(3) t(o) WHERE n > 1 GROUP BY doc_id),
  x AS (SELECT doc_id, host, text, trim(regexp_replace(regexp_replace(lower(raw), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS line, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT doc_id, host, text, unnest(lines) AS raw FROM b)),
  common AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS holders FROM x GROUP BY 1, 2) JOIN (SELECT host, count(DISTINCT text) AS texts FROM b GROUP BY 1) USING (host) WHERE holders > {_L.texts} AND holders > {_L.share} * texts),
  gone AS (SELECT doc_id, sum(n)::BIGINT AS n_removed FROM x JOIN common USING (host, line) GROUP BY doc_id),
  o AS (SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed, 0) AS n_removed FROM b LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_removed > 0 AND (n_words - n_removed < {_L.left} * n_words OR n_words - n_removed < {_L.least})) AS kept FROM o"""

OP4 = f"""WITH {SPLIT}, t AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
  g AS (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM t), one AS (SELECT w, count(*) AS n FROM t GROUP BY w),
  two AS (SELECT before, w, count(*) AS n FROM g GROUP BY 1, 2),
  s AS (SELECT doc_id, CAST(round(1000000 * ln(CASE WHEN two.n >= 2 THEN two.n / coalesce(b.n, (SELECT count(DISTINCT doc_id) FROM t)) ELSE 0.4::DOUBLE * a.n / (SELECT count(*) FROM t) END)) AS BIGINT) AS micro
    FROM g JOIN two ON g.before IS NOT DISTINCT FROM two.before AND g.w = two.w JOIN one a ON a.w = g.w LEFT JOIN one b ON b.w = g.before)
  SELECT doc_id, count(micro) AS n_words, coalesce(sum(micro), 0)::BIGINT AS score_micro FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id"""

_M = Mix()
OP5 = f"""WITH RECURSIVE n AS (SELECT coalesce(source, '') AS src, count(*) AS n FROM documents GROUP BY 1),
  rate AS (SELECT src, {_M.size}::DOUBLE * (SELECT sum(n) FROM n) * pow(n, {_M.power}) / (SELECT sum(pow(n, {_M.power})) FROM n) / n AS rate FROM n),
  part AS (SELECT src, rate, greatest(1, ceil(rate / 30))::INT AS parts FROM rate), one AS (SELECT src, parts, rate / parts AS m FROM part),
  cdf AS (SELECT src, m, 0 AS k, exp(-m) AS p, exp(-m) AS c FROM one UNION ALL SELECT src, m, k + 1, p * m / (k + 1), c + p * m / (k + 1) FROM cdf WHERE k < ceil(m + 12 * sqrt(m) + 20)),
  u AS (SELECT doc_id, src, CAST(concat('0x', substring(md5(concat('{_M.seed}:', doc_id, ':', j)), 1, 13)) AS UBIGINT)::DOUBLE / pow(2, 52) AS u
    FROM (SELECT doc_id, src, unnest(range(1, parts + 1)) AS j FROM documents JOIN one ON src = coalesce(source, ''))),
  drawn AS (SELECT doc_id, count(*) AS n FROM u JOIN cdf ON cdf.src = u.src AND cdf.c <= u.u GROUP BY doc_id)
  SELECT documents.doc_id, text, lang, source, n_chars, CAST(unnest(range(n)) AS INT) AS copy FROM documents JOIN drawn ON documents.doc_id = drawn.doc_id"""

OP7 = f"""WITH RECURSIVE w AS (SELECT doc_id AS id, list_transform({WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
  s AS (SELECT DISTINCT id, g FROM (SELECT id, unnest(CASE WHEN len(ws) = 1 THEN [ws[1]] ELSE list_transform(range(1, len(ws)), lambda i: concat(ws[i], ' ', ws[i + 1])) END) AS g FROM w WHERE len(ws) > 0)),
  n AS (SELECT id, count(*) AS n FROM s GROUP BY id), pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
  l AS (SELECT a, b FROM pairs JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * pairs.n >= 80 * (x.n + y.n - pairs.n)), ids AS (SELECT id FROM w), {REACHED}
  SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept FROM c LEFT JOIN n USING (id)"""


def _op8(rules: list[tuple[str, str]], t: Templates) -> str:
    def fits(rule: str) -> str:
        host, _, path = rule.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    case = lambda k: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[k]}'" for r in ordered) + " END"
    general = lambda s: f"CASE WHEN regexp_matches({s}, '[0-9]|%|.{{25,}}') THEN concat('*', regexp_extract({s}, '(\\.[A-Za-z]{{1,5}})$', 1)) ELSE {s} END"
    return rf"""WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
      rows AS (SELECT *, {case(1)} AS rule, {case(0)} AS ruled, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: {general("s")}) AS segs FROM u),
      l AS (SELECT host, segs, count(ruled) AS known, count(*) FILTER (ruled = 'block') AS blocked FROM rows GROUP BY ALL),
      p AS (SELECT host, segs, known, blocked, segs[:d] AS above, segs[d + 1] AS seg, d FROM (SELECT *, unnest(range(len(segs))) AS d FROM l)),
      b AS (SELECT host, above, seg, sum(known) AS known, sum(blocked) AS blocked FROM p GROUP BY ALL HAVING sum(known) >= {t.least}),
      c AS (SELECT *, CAST(floor(blocked / known * {t.bins} + 0.5) AS BIGINT) AS bin FROM b),
      n AS (SELECT host, above, bin, sum(known) AS known, sum(blocked) AS blocked, count(*) AS branches FROM c GROUP BY ALL),
      w AS (SELECT *, lag(known) OVER o AS pk, lag(blocked) OVER o AS pb FROM n WINDOW o AS (PARTITION BY host, above ORDER BY bin)),
      x AS (SELECT host, above, bin, branches, sum(CASE WHEN abs(blocked / known - pb / pk) <= {t.z} * sqrt((blocked + pb) / (known + pk) * (1 - (blocked + pb) / (known + pk)) * (1 / known + 1 / pk)) THEN 0 ELSE 1 END) OVER (PARTITION BY host, above ORDER BY bin)::BIGINT AS alike FROM w),
      alike AS (SELECT host, above, seg, alike FROM (SELECT *, sum(branches) OVER (PARTITION BY host, above, alike) AS several FROM x) JOIN c USING (host, above, bin) WHERE several > 1),
      stars AS (SELECT host, segs, map(list(d), list(alike)) AS stars FROM p JOIN alike USING (host, above, seg) GROUP BY ALL),
      shaped AS (SELECT host, segs, known, blocked, array_to_string(list_transform(segs, lambda s, i: concat('/', CASE WHEN stars[i - 1] IS NULL THEN s ELSE concat('*', stars[i - 1]) END)), '') AS template FROM l LEFT JOIN stars USING (host, segs)),
      nodes AS (SELECT host, template, (sum(blocked) + {t.prior * t.neutral}) / (sum(known) + {t.prior}) AS purity FROM shaped GROUP BY ALL)
      SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity >= {t.purity} THEN 'block' ELSE 'allow' END) AS verdict, coalesce(template, '') AS template, round(purity, 9) AS purity FROM rows JOIN shaped USING (host, segs) JOIN nodes USING (host, template)"""


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11 = f"""WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents), n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY 1), g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM n),
  q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY 1, 2),
  f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
  w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term, docs),
  s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score FROM q JOIN f USING (term) JOIN w USING (term) JOIN n USING (doc_id), g GROUP BY 1, 2)
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 10"""


_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP12 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
  d AS (SELECT *, strlen(html) AS payload_bytes, array_to_string(list_transform(range(32), lambda k: substr('{_DIGITS}', CAST((CAST(concat('0x', substr(hex, CAST(k // 4 AS INT) * 5 + 1, 5)) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS INT) + 1, 1)), '') AS payload_digest,
    min(page_id) OVER (PARTITION BY html) AS first FROM p)
  SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d"""


def _op13(p: VectorCodes) -> str:
    ctes = [
        f"v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({p.scale} * x) AS BIGINT)) AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS (SELECT vec_id, part, e[part * (len(e) // {p.parts}) + 1:(part + 1) * (len(e) // {p.parts})] AS e FROM v, range({p.parts}) t(part))",
        f"b0 AS (SELECT part, entry, e FROM (SELECT part, e, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM x) WHERE entry < {p.entries})",
    ]
    for k in range(p.rounds + 1):
        ctes.append(f"a{k} AS (SELECT vec_id, part, x.e AS e, min({{'gap': CAST(list_sum(list_transform(list_zip(x.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'entry': entry}}) AS near FROM x JOIN b{k} b USING (part) GROUP BY vec_id, part, x.e)")
        if k < p.rounds:
            ctes.append(f"u{k} AS (SELECT part, near.entry AS entry, place, sum(value) AS s, count(*) AS n FROM (SELECT part, near, unnest(e) AS value, unnest(range(len(e))) AS place FROM a{k}) GROUP BY ALL)")
            ctes.append(f"m{k} AS (SELECT part, entry, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY place) AS e FROM u{k} GROUP BY ALL)")
            ctes.append(f"b{k + 1} AS (SELECT part, entry, coalesce(m.e, b.e) AS e FROM b{k} b LEFT JOIN m{k} m USING (part, entry))")
    last = f"a{p.rounds}"
    ctes += [
        f"c AS (SELECT vec_id, string_agg(printf('%02x', near.entry), '' ORDER BY part) AS code, CAST(sum(near.gap) AS BIGINT) AS error FROM {last} GROUP BY vec_id)",
        f"h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{p.rounds})",
    ]
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN v USING (vec_id), h"


def sql(rules: list[tuple[str, str]]) -> dict[str, str]:
    return {"op1_near_vectors": OP1, "op2_substring_dedup": OP2, "op3_quality_rules": OP3, "op4_lm_scores": OP4, "op5_mixing": OP5, "op7_near_copies": OP7, "op8_url_filters": _op8(rules, Templates()), "op11_lexical_search": OP11, "op12_warc": OP12, "op13_vector_codes": _op13(VectorCodes())}
