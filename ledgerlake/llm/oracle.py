"""DuckDB SQL of the queries that SQL can express (same column names).

Written from the definitions: every window, shingle and pair, without filters
or indexes.  The models (language, toxicity, secrets), the tokenizer and the
seeded mix have no SQL form; tests/llm holds them against brute force.
"""

from __future__ import annotations

import string

from ledgerlake.llm.chat import CLOSE, END, OPEN
from ledgerlake.llm.quality import RULES, STOP_WORDS

_WORDS = r"list_filter(string_split_regex(coalesce({t}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _words(t: str) -> str:
    return _WORDS.format(t=t)


#: Components of links (a, b) by reachability: the least id that reaches a vertex.
_COMPONENTS = """
reach AS (SELECT a AS id, b AS other FROM links
          UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
part AS (SELECT id, least(id, min(other)) AS component_id FROM reach GROUP BY id)"""

OP1 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g FROM s),
dup AS (SELECT g FROM g GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM g SEMI JOIN dup USING (g)),
wordy AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
marked AS (SELECT wordy.*, gone.p IS NOT NULL AS cut,
                  lag(gone.p IS NOT NULL, 1, FALSE) OVER (PARTITION BY wordy.doc_id ORDER BY wordy.p) AS cut_before
           FROM wordy LEFT JOIN gone ON wordy.doc_id = gone.doc_id AND wordy.p = gone.p),
per AS (SELECT doc_id, count(*) FILTER (WHERE cut) AS n_removed,
               coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT cut), '') AS kept,
               count(*) FILTER (WHERE cut AND NOT cut_before) AS n_spans
        FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN per ON d.doc_id = per.doc_id"""

OP2 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
          ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
             AND list_cosine_similarity(x.e, y.e) >= 0.98),
{_COMPONENTS},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN part ON vec_id = part.id"""

OP3 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text
           FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective,
             CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                  ELSE 'user' END AS role
      FROM t JOIN people ON t.conv_id IS NOT DISTINCT FROM people.conv_id),
h AS (SELECT *, '{OPEN}' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END
                || '{CLOSE}' AS head FROM r)
SELECT conv_id, perspective, turn, speaker, role, head || text || '{END}' AS rendered,
       CASE WHEN role = 'assistant' THEN length(head) ELSE -1 END AS mask_start,
       CASE WHEN role = 'assistant' THEN length(head || text || '{END}') - 1 ELSE -1 END AS mask_end
FROM h"""

OP4 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_words(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} AS w
  FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS k
         FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * k >= 75 * (na + nb - k)),
{_COMPONENTS},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(n.n, 0) AS n_links,
       coalesce(component_id, doc_id) AS component_id
FROM s LEFT JOIN n ON doc_id = n.a LEFT JOIN part ON doc_id = part.id"""


def _failed(rule) -> str:
    top, _, below = rule.over.partition(" / ")
    x = f"CAST({top} AS DOUBLE) / nullif({below}, 0)" if below else top
    bad = [f"{x} < {rule.low}"] if rule.low is not None else []
    bad += [f"{x} > {rule.high}"] if rule.high is not None else []
    return f"CASE WHEN {' OR '.join(bad)} THEN '{rule.name}' END"


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_words('text')} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT g.doc_id, unnest([i, i + 1, i + 2]) AS p FROM g SEMI JOIN twice USING (doc_id, g))
        GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(len(list_filter(l, lambda x: regexp_matches(x, '^\s*([-*•])\s'))) AS BIGINT) AS n_bullet_lines,
             CAST(len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS BIGINT) AS n_ellipsis_lines,
             CAST(len(list_filter(w, lambda x: x IN ({_STOP}))) AS BIGINT) AS n_stop_words,
             CAST(length(regexp_replace(t, '[^\pL]+', '', 'g')) AS BIGINT) AS n_letters
      FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             concat_ws(',', {', '.join(map(_failed, RULES))}) AS failed_rules FROM m)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM v"""

_ITEM_WORDS = (r"list_filter(string_split_regex(translate(coalesce(text, ''), "
               f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
               r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
OP11 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
test AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
long AS (SELECT DISTINCT k FROM test),
g AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN long ON len(w) >= k)),
met AS (SELECT doc_id, g.k, i, item FROM g JOIN test ON g.k = test.k AND g.g = test.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN found ON d.doc_id = found.doc_id"""


def _crc_of_byte(b: int) -> int:
    for _ in range(8):
        b = b >> 1 ^ 0xEDB88320 * (b & 1)
    return b


#: crc32 of a string of ASCII and U+00C0 to U+00FF, byte by byte.
_CRC = """xor(4294967295, list_reduce(
  flatten(list_transform(string_split({s}, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) - 64 AS BIGINT)] END)),
  lambda c, b: xor(c >> 8, {table}[CAST(xor(c, b) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)))"""
_CRC = _CRC.replace("{table}", f"CAST({[_crc_of_byte(b) for b in range(256)]} AS BIGINT[])")

OP12 = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, r, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
          '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY doc_id, r),
dealt AS (SELECT r, k, {_CRC.replace('{s}', "coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")} AS h FROM runs),
typed AS (SELECT k, CASE WHEN h % 31 = 0 THEN substring(r, 1, CAST(h % length(r) AS INT))
                    || substring(r, CAST(h % length(r) AS INT) + 2) ELSE r END AS word FROM dealt),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n, length(word) AS size FROM typed WHERE length(word) >= 7
      GROUP BY word HAVING sum(k) >= 2),
pairs AS (SELECT x.word, x.n, y.word AS near, y.n AS m
          FROM v x JOIN (SELECT *, unnest([size - 1, size, size + 1]) AS met FROM v) y
            ON x.size = y.met AND levenshtein(x.word, y.word) = 1),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(near, (-m, near)) AS near FROM pairs GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN near END AS form,
             CASE WHEN m >= 10 * v.n THEN m END AS form_n FROM v LEFT JOIN best ON v.word = best.word),
path AS (SELECT word, word AS at, form AS next FROM f
         UNION ALL SELECT path.word, f.word, f.form FROM path JOIN f ON path.next = f.word)
SELECT f.word, form, at AS root, n, n_near, form_n FROM f JOIN path ON f.word = path.word AND path.next IS NULL"""

ORACLE: dict[str, str] = {
    "op1_rlz_substring_dedup": OP1,
    "op2_cap_filter_dedup": OP2,
    "op3_perspective_rotation": OP3,
    "op4_ngram_jaccard_join": OP4,
    "op10_quality_rules": OP10,
    "op11_wu_manber_decontamination": OP11,
    "op12_vgram_spelling_variants": OP12,
}
