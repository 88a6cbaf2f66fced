"""SQL that the queries must agree with, where SQL can express the operator."""

from __future__ import annotations

import re
from math import ceil

from convspark.llm.licences import PHRASES, TEMPLATES, WORD
from convspark.llm.line_dedup import LOWER, UPPER


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


LINE_DEDUP = f"""WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
          FROM lines),
repeated AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
             GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, line, pos, coalesce(doc_id < keeper, false) AS dropped FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def _licences(threshold: float = 0.9) -> str:
    """Blocks are listed and compared with every template, without an index."""
    split = lambda text: re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))
    at, met = [], []
    for phrase in PHRASES:
        parts = split(phrase)
        stands = " AND ".join(f"w[i + {k + 1}] = {_text(p)}" for k, p in enumerate(parts))
        at.append(f"list_filter(range(0, len(w) - {len(parts)} + 1), lambda i: {stands})")
    for _, text in TEMPLATES:
        parts, reach = split(text), 4
        while reach < len(parts):
            reach *= 2
        distinct = list(dict.fromkeys(parts))
        shared = f"len(list_filter({_list(distinct)}, lambda t: list_contains(w[s + 1:s + {2 * reach}], t)))"
        starts = f"range(0, greatest(len(w) - {reach} - 1, 0) + 1, {reach})"
        most = f"coalesce(list_max(list_transform({starts}, lambda s: {shared})), 0)"
        need = ceil(threshold * len(distinct) - 1e-9)
        met.append(f"CASE WHEN {most} >= {need} THEN {most} / {len(distinct)} ELSE 0.0 END")
    bases = [f"CASE WHEN len(at{k}) > 0 THEN {_text(label)} END" for k, label in enumerate(PHRASES.values())]
    labels = [f"CASE WHEN met{k} > 0 THEN {_text(label)} END" for k, (label, _) in enumerate(TEMPLATES)]
    every = " || ".join(f"at{k}" for k in range(len(at)))
    sort = "list_sort(list_distinct(list_filter([{}], lambda x: x IS NOT NULL)))"
    return f"""WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
placed AS (SELECT doc_id, len(w) AS n, {', '.join(f'{a} AS at{k}' for k, a in enumerate(at))},
  {', '.join(f'({m})::DOUBLE AS met{k}' for k, m in enumerate(met))} FROM split),
named AS (SELECT *, {every} AS places, {sort.format(', '.join(bases))} AS base,
  {sort.format(', '.join(bases + labels))} AS every_label FROM placed)
SELECT doc_id, n::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
  list_max(places)::BIGINT AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(every_label, ',') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE greatest({', '.join(f'met{k}' for k in range(len(met)))}) END AS score
FROM named"""


LICENCES = _licences()

MIXING = """WITH RECURSIVE d AS (
  SELECT doc_id, source, source IS NULL AS none, coalesce(source, '') AS src, row_number() OVER () AS row,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5(concat_ws('/', '8', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 13))::BIGINT
          + 0.5::DOUBLE) / 4503599627370496 AS u
  FROM documents),
s AS (SELECT none, src, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY ALL),
w AS (SELECT *, ([3, 1, 2][(row_number() OVER (ORDER BY none, src) - 1) % 3 + 1])::DOUBLE AS weight,
             2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS goal FROM s),
l AS (SELECT *, (goal - coalesce(sum(cap) OVER (ORDER BY cap / weight, none, src
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, none, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
c AS (SELECT *, cap <= level * weight AS capped FROM l),
t AS (SELECT *, CASE WHEN capped THEN cap ELSE (max(CASE WHEN NOT capped THEN level END) OVER ()) * weight END AS target FROM c),
e AS (SELECT d.*, source_size, target, n, least(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END, 2.0::DOUBLE) AS e
      FROM d JOIN t USING (none, src)),
o AS (SELECT *, floor(e) AS certain, e - floor(e) AS odds, least(1024, greatest(1, n // 512)) AS b1 FROM e),
p AS (SELECT *, target - sum(certain * size) OVER (PARTITION BY none, src) AS lack,
             avg(CASE WHEN odds > 0 THEN odds END) OVER (PARTITION BY none, src) AS mean,
             b1 * least(1024, greatest(1, floor(n / b1 / 512)))::BIGINT AS b FROM o),
r AS (SELECT *, CASE WHEN odds > 0 THEN (u / (1 - u)) / (odds / (1 - odds)) END AS rank FROM p),
f AS (SELECT *, CASE WHEN odds > 0 THEN least(floor(rank * (mean / (1 - mean)) / (1 + rank * (mean / (1 - mean))) * b), b - 1)
                END AS fine FROM r),
sums AS (SELECT none, src, fine, sum(size) AS words, any_value(lack) AS lack FROM f
         WHERE fine IS NOT NULL AND lack > 0 GROUP BY ALL),
running AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY none, src ORDER BY fine
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sums),
edge AS (SELECT none, src, fine AS last, lack - before AS gap FROM running WHERE before < lack AND lack <= before + words),
near AS (SELECT none, src, row, size, row_number() OVER (PARTITION BY none, src ORDER BY rank, row) AS k
         FROM f JOIN edge USING (none, src) WHERE fine = last),
fit AS (
  SELECT none, src, 0::BIGINT AS k, gap, -1::BIGINT AS row, false AS taken FROM edge
  UNION ALL
  SELECT none, src, near.k, CASE WHEN near.size <= gap THEN gap - near.size ELSE gap END, near.row, near.size <= gap
  FROM fit JOIN near USING (none, src) WHERE near.k = fit.k + 1),
x AS (SELECT f.*, (certain + CASE WHEN fit.taken THEN 1
                                  WHEN fine < coalesce(last, CASE WHEN lack > 0 THEN b ELSE 0 END) THEN 1 ELSE 0 END)::BIGINT AS copies
      FROM f LEFT JOIN edge USING (none, src) LEFT JOIN fit ON fit.row = f.row AND fit.taken)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies, source FROM x"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, byte by byte; ``codes`` of :data:`CRC_TABLE` must be in scope."""
    digits = f"hex(encode({text}))"
    byte = "instr('0123456789ABCDEF', substr({0}, 2 * i + {1}, 1)) - 1"
    high, low = byte.format(digits, 1), byte.format(digits, 2)
    value = f"list_transform(range(0, strlen({text})), lambda i: (16 * ({high}) + {low})::BIGINT)"
    step = "lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {value}), {step}), 4294967295::BIGINT)"


CRC_TABLE = """crc_table AS (SELECT list_transform(range(0, 256), lambda x: list_reduce(
    [x::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS codes)"""

_WORD_LIST = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"


def _runs_of_words(table: str, key: str) -> str:
    """(key, feature) of all runs of one to three words."""
    return " UNION ALL ".join(
        f"SELECT {key}, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS feature"
        f" FROM {table} WHERE len(w) >= {k}"
        for k in (1, 2, 3)
    )


RESAMPLING = f"""WITH {CRC_TABLE},
docs AS (SELECT doc_id, {_WORD_LIST} AS w FROM documents),
target AS (SELECT item_id, {_WORD_LIST} AS w FROM benchmark),
features AS ({_runs_of_words('docs', 'doc_id')}),
wanted AS ({_runs_of_words('target', 'item_id')}),
hashed AS (SELECT feature, {_crc32('feature')} % 10000 AS bucket
           FROM (SELECT feature FROM features UNION SELECT feature FROM wanted), crc_table),
raw AS (SELECT bucket, count(*) AS s FROM features JOIN hashed USING (feature) GROUP BY bucket),
good AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (feature) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM features) AS s_all, (SELECT count(*) FROM wanted) AS t_all),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)
                                         / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
          FROM raw FULL JOIN good USING (bucket) CROSS JOIN totals),
weights AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
            FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) AS n, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
   + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM docs LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS place,
                  count(*) OVER (PARTITION BY n >= 20) AS able FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n >= 20 AND place <= 5 * able // 100 THEN place END::BIGINT AS rank FROM ranked"""

SPELLING = f"""WITH RECURSIVE {CRC_TABLE},
found AS (SELECT doc_id, run, count(*) AS times FROM (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run
  FROM documents) GROUP BY ALL),
hashed AS (SELECT run, times, {_crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM found, crc_table),
written AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                   times FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
gaps AS (SELECT word, n, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM places),
near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b USING (head, tail) WHERE a.word <> b.word
         UNION SELECT g.word, g.n, w.word, w.n FROM gaps g JOIN words w ON w.word = g.head || g.tail
         UNION SELECT w.word, w.n, g.word, g.n FROM gaps g JOIN words w ON w.word = g.head || g.tail),
best AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS first FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
                  CASE WHEN -first.less >= 2 * n THEN first.other END AS form,
                  CASE WHEN -first.less >= 2 * n THEN -first.less END::BIGINT AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS reached, 0 AS steps FROM formed UNION ALL
          SELECT chain.word, formed.form, steps + 1 FROM chain JOIN formed ON formed.word = chain.reached WHERE formed.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(reached, steps) FROM chain WHERE chain.word = formed.word) AS root, n, n_near, form_n FROM formed"""
