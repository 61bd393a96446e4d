"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op3_chat_formatting": """
WITH s AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE conv_id IS NOT NULL AND role IS NOT NULL AND role <> 'system'),
r AS (SELECT conv_id, speaker, turn, role, coalesce(text, '') AS body, coalesce(role = speaker, false) AS target FROM conversations JOIN s USING (conv_id)),
h AS (SELECT *, CASE WHEN target THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10) ELSE '<|user name=' || coalesce(role, 'unknown') || '|>' || chr(10) END AS head FROM r),
g AS (SELECT *, head || body || '<|end|>' || chr(10) AS segment FROM h),
e AS (SELECT *, sum(length(segment)) OVER w AS stop, row_number() OVER w AS place FROM g WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role NULLS FIRST, body ROWS UNBOUNDED PRECEDING))
SELECT conv_id, speaker, count(*) AS n_turns, count(*) FILTER (target) AS n_target_turns, string_agg(segment, '' ORDER BY place) AS text,
string_agg((stop - length(segment) + length(head))::BIGINT || '-' || stop::BIGINT, ',' ORDER BY place) FILTER (target) AS mask,
CAST(sum(CASE WHEN target THEN length(segment) - length(head) ELSE 0 END) AS BIGINT) AS n_target_chars FROM e GROUP BY ALL""",
    "op6_substring_dedup": """
WITH w AS (SELECT doc_id, """ + _WORDS.format(text="coalesce(text, '')") + """ AS words FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first FROM g) WHERE doc_id > first),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f),
a AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
k AS (SELECT a.doc_id, count(c.i) AS n_removed, coalesce(string_agg(words[a.i], ' ' ORDER BY a.i) FILTER (c.i IS NULL), '') AS kept FROM a LEFT JOIN c ON c.doc_id = a.doc_id AND c.i = a.i GROUP BY a.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)""",
    "op7_decontamination": """
WITH d AS (SELECT doc_id, regexp_extract_all(""" + _LOWER.format(text="coalesce(text, '')") + """, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(""" + _LOWER.format(text="coalesce(text, '')") + """, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
t AS (SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS run FROM (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)),
n AS (SELECT DISTINCT n FROM t),
g AS (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS run FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, n WHERE len(words) >= n)),
h AS (SELECT doc_id, i, g.n, item_id FROM g JOIN t ON g.run = t.run AND g.n = t.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN x USING (doc_id)""",
    "op2_ngram_jaccard_join": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(""" + _LOWER.format(text="coalesce(text, '')") + """, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m ON m.doc_id = w.doc_id""",
    "op13_collocations": """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, """ + _LOWER.format(text="coalesce(text, '')") + """ AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1 HAVING sum(len(w)) > 0),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) v(k) WHERE len(w) >= k),
f AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT x.lang, x.phrase, a, cut, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score FROM x
  JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(w[1:cut], ' ') JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, a, w, k, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) v(m) WHERE m < k),
o AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM i GROUP BY ALL),
e AS (SELECT lang, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM b LEFT JOIN o USING (lang, phrase) JOIN n USING (lang) WHERE coalesce(100 * longer < 80 * a, true))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM e
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""",
}
