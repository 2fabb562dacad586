"""DuckDB SQL of the queries that SQL can express; constants are stated here anew."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, sha1(body) || '00' AS hex, strlen(body) AS n,
  min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (((
    (strpos('0123456789abcdef', substr(hex, (5 * i) // 4 + 1, 1)) - 1) * 16
    + strpos('0123456789abcdef', substr(hex, (5 * i) // 4 + 2, 1)) - 1) >> (3 - (5 * i) % 4)) & 31) AS BIGINT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id = page_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""

TOPK = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS query_row, a.vec_id AS query_id, b.vec_id AS vec_id,
  CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM k WHERE n <= 5
"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS BIGINT) AS size,
  coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS ord FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS most, [3, 1, 2][CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT)] AS weight,
  row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
f AS (SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
    - (sum(most) OVER (ORDER BY most / weight, place ROWS UNBOUNDED PRECEDING) - most))
    / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
l AS (SELECT level FROM f WHERE level <= most / weight ORDER BY most / weight, place LIMIT 1),
t AS (SELECT source, source_size, least(CAST(most AS DOUBLE), weight * l.level) AS target FROM f, l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS goal,
  CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - source_size - start)) AS taken
FROM p
"""

RULES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT r, doc_id, text, regexp_extract_all(text, '{_WORD}') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM m WHERE len(words) >= 3),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM g),
c AS (SELECT r, least(3, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3)) AS x FROM h WHERE n > 1),
rep AS (SELECT r, CAST(sum(x) AS BIGINT) AS n FROM c GROUP BY r),
b AS (SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words FROM m LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_symbols * 10 > n_words OR word_chars > n_words * 14 OR word_chars < n_words * 2
    OR n_dup_lines * 2 > length(regexp_replace(text, '[^\\n]+', '', 'g')) + 1
    OR length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 3 > word_chars
    OR length(regexp_replace(text, '[^!]+', '', 'g')) * 4 > n_words
    OR length(regexp_replace(text, '[^0-9]+', '', 'g')) * 2 > word_chars) AS kept
FROM f
"""

_TEMPLATES = (
    ("cc-by", True, "cc by"),
    ("gpl", True, "general public license"),
    ("reserved", True, "all rights reserved"),
    ("apache-2.0", False, "licensed under the apache license version 2 0"),
    ("gpl-3.0", False, "licensed under the gnu general public license version 3"),
    ("cc-by-nc-4.0", False, "licensed under cc by nc 4 0"),
    ("mit", False, "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                   "associated documentation files to deal in the software without restriction"),
    ("bsd", False, "redistribution and use in source and binary forms with or without modification are permitted "
                   "provided that the following conditions are met"),
    ("mpl-2.0", False, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("apache-2.0", False, "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license you may obtain a copy of the license at http www apache org licenses license "
                   "2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied "
                   "see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-notice", False, "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "general public license as published by the free software foundation either version 3 of the license "
                   "or at your option any later version"),
    ("gpl-notice", False, "this program is distributed in the hope that it will be useful but without any warranty without even "
                   "the implied warranty of merchantability or fitness for a particular purpose see the gnu general public "
                   "license for more details"),
    ("mit", False, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
            "permit persons to whom the software is furnished to do so subject to the following conditions the above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "software"),
    ("bsd", False, "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met redistributions of source code must retain the above copyright notice this "
            "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
            "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
            "materials provided with the distribution"),
    ("mpl-2.0", False, "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl "
                "was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("creative-commons", False, "this work is licensed under the creative commons attribution 4 0 international license to view "
                         "a copy of this license visit http creativecommons org licenses by 4 0 or send a letter to "
                         "creative commons po box 1866 mountain view ca 94042 usa"),
    ("public-domain", False, "dedicated the work to the public domain by waiving all of his or her rights to the work"),
)
_COMMON = ["a", "all", "an", "and", "any", "are", "as", "at", "by", "for", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "under", "with", "you"]
_VALUES = ", ".join(f"('{label}', {base}, '{words}')" for label, base, words in _TEMPLATES)

LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
t AS (SELECT row_number() OVER () AS template, label, base, string_split(phrase, ' ') AS tw
  FROM (VALUES {_VALUES}) AS x(label, base, phrase)),
tu AS (SELECT *, tw[q] AS w1, tw[q + 1] AS w2 FROM (SELECT *, unnest(range(1, len(tw))) AS q FROM t)),
tg AS (SELECT template, label, base, count(*) OVER (PARTITION BY template) AS grams, len(tw) AS size, q - 1 AS q, w1, w2 FROM
  (SELECT *, count(*) OVER (PARTITION BY template, w1, w2) AS held FROM tu)
  WHERE base OR (held = 1 AND NOT (list_contains({_COMMON}, w1) AND list_contains({_COMMON}, w2)))),
g AS (SELECT r, p - 1 AS p, words[p] AS w1, words[p + 1] AS w2
  FROM (SELECT r, words, unnest(range(1, len(words))) AS p FROM d)),
v AS (SELECT r, template, label, base, grams, size, greatest(2, size // 4) AS drift, p - q AS diagonal, count(*) AS votes, min(p) AS lo, max(p) AS hi
  FROM g JOIN tg USING (w1, w2) GROUP BY ALL),
f AS (SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > drift, true)
  THEN 1 ELSE 0 END AS fresh FROM v),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS passage FROM f),
s AS (SELECT r, template, label, base, grams, size, drift, sum(votes) AS votes, min(diagonal) AS diagonal, min(lo) AS lo, max(hi) AS hi
  FROM n GROUP BY r, template, label, base, grams, size, drift, passage),
k AS (SELECT r, label, base, diagonal, least(1.0, CAST(votes AS DOUBLE) / grams) AS share,
  CASE WHEN base THEN votes = grams ELSE hi - lo + 2 <= size + drift
    AND least(1.0, CAST(votes AS DOUBLE) / grams) >= CAST(0.7 AS DOUBLE) END AS found FROM s),
a AS (SELECT r, count(*) FILTER (base) AS n_base, min(diagonal) FILTER (base) AS first_word, max(diagonal) FILTER (base) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score
  FROM k WHERE found GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM d LEFT JOIN a USING (r)
"""


def _clusters() -> str:
    """Five rounds over the kept vectors; a round is an assignment and the floors of the means."""
    q = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {q} AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, q) - 1 AS INTEGER) AS c, q
  FROM v QUALIFY c < 40)"""]
    for i in range(6):
        steps.append(f"""d{i} AS (SELECT v.r, c{i}.c,
  CAST(list_sum(list_transform(list_zip(v.q, c{i}.q), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d FROM v, c{i}),
a{i} AS MATERIALIZED (SELECT r, c, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < 5:
            steps.append(f"""s{i} AS (SELECT a.c, j, CAST(sum(v.q[j]) AS BIGINT) AS s, count(*) AS n
  FROM a{i} a JOIN v USING (r), (SELECT unnest(range(1, 65)) AS j) GROUP BY a.c, j),
m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS q FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.q, c{i}.q) AS q FROM c{i} LEFT JOIN m{i} USING (c))""")
    return "WITH " + ",\n".join(steps) + """
SELECT v.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.q, ',')) AS centroid_sha256
FROM a5 a JOIN v USING (r) JOIN c5 ON c5.c = a.c
"""


CLUSTERS = _clusters()


def _least(*options: str) -> str:
    """The least (cost, letters) of some, absent ones left out."""
    return f"list_min([{', '.join(options)}])"


def _repair() -> str:
    """Damage, faults, then one row per conversation and step: the best (cost, letters) that reaches
    each of the four states (no turn yet, after system, after user, after assistant)."""
    crc = ("xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT)), "
           "lambda c, b: list_reduce(range(8), lambda x, n: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)), "
           "CAST(4294967295 AS BIGINT))")

    def add(state: str, cost: str, letter: str, when: str = "TRUE") -> str:
        return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}} END"

    may, keep = "f NOT IN (1, 2)", "(CASE WHEN f = 3 THEN 3 ELSE 0 END)"
    row = {  # a row is consumed
        "n": _least(add("w.n", "4", "D")),
        "s": _least(add("w.s", "4", "D"), add("w.n", keep, "K", f"{may} AND r.first = 's'")),
        "u": _least(add("w.u", "4", "D"), *(add(f"w.{x}", keep, "K", f"{may} AND r.first = 'u'") for x in "nsa"),
                    *(add(f"w.{x}", f"3 + {keep}", "R", may) for x in "nsa")),
        "a": _least(add("w.a", "4", "D"), add("w.u", keep, "K", f"{may} AND r.first = 'a'"), add("w.u", f"3 + {keep}", "R", may)),
    }
    user = _least("x.u", *(add(f"x.{x}", "3", "I") for x in "nsa"))  # turns are put in
    assistant = _least("y.a", add("y.u", "3", "I"))
    again = _least("z.u", add("z.a", "3", "I"))
    return f"""
WITH RECURSIVE given AS (SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
harmed AS (SELECT *, {crc} % 20 AS harm FROM given),
rows_left AS (SELECT g, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
  CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy FROM harmed WHERE harm <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i FROM rows_left),
placed AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS again FROM ordered),
r AS MATERIALIZED (SELECT g, i, turn, role, text, substr(role, 1, 1) AS first, CASE WHEN NOT regexp_matches(text, '{_WORD}') THEN 1 WHEN again > 1 THEN 2
  WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f FROM placed),
counts AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 1) AS blank,
  count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated, count(*) AS n FROM r GROUP BY g),
pairs AS (SELECT g, count(*) FILTER (before IS NOT NULL AND before || first NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT g, first, lag(first) OVER (PARTITION BY g ORDER BY i) AS before FROM r) GROUP BY g),
walk AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}} AS n, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR)) AS s,
    {{'c': 3, 'a': 'I'}} AS u, {{'c': 6, 'a': 'II'}} AS a FROM given
  UNION ALL
  SELECT z.g, z.i, z.n, z.s, {again} AS u, z.a FROM (
    SELECT y.g, y.i, y.n, y.s, y.u, {assistant} AS a FROM (
      SELECT x.g, x.i, x.n, x.s, {user} AS u, x.a FROM (
        SELECT w.g, r.i, {row["n"]} AS n, {row["s"]} AS s, {row["u"]} AS u, {row["a"]} AS a
        FROM walk w JOIN r ON r.g = w.g AND r.i = w.i + 1) x) y) z),
best AS (SELECT w.g, {_least("w.n", "w.a")} AS b FROM walk w LEFT JOIN counts USING (g) WHERE w.i = coalesce(counts.n, 0)),
letters AS (SELECT g, b.a AS audit, unnest(range(1, length(b.a) + 1)) AS p FROM best),
spelt AS (SELECT g, p, substr(audit, p, 1) AS e, length(replace(substr(audit, 1, p), 'I', '')) AS i,
  length(replace(substr(audit, 1, p), 'D', '')) AS turn_no FROM letters),
turns AS (SELECT t.g, t.p, t.e, t.turn_no, r.role, r.text, max(CASE WHEN t.turn_no = 1 AND t.e = 'K' AND r.first = 's' THEN 1 ELSE 0 END)
  OVER (PARTITION BY t.g) AS system FROM spelt t LEFT JOIN r ON r.g = t.g AND r.i = t.i AND t.e <> 'I' WHERE t.e <> 'D'),
said AS (SELECT g, string_agg(CASE WHEN e = 'K' THEN role WHEN (turn_no - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
  || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS whole FROM turns GROUP BY g)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.b.c AS BIGINT) AS cost, best.b.a AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM given) JOIN best USING (g) LEFT JOIN counts USING (g) LEFT JOIN pairs USING (g) LEFT JOIN said USING (g)
"""


REPAIR = _repair()
