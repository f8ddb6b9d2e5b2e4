"""SQL for the queries of this package that DuckDB can express, written another way than the operators."""

from __future__ import annotations

import string

from stallbook.llm.licenses import BASE, FIRST, KINDS, WIDEST, rules

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, eight shifts a byte; the polynomial is fixed."""
    codes = f"[('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT FOR i IN range(strlen({text}))]"
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    step = f"list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: {shift})"
    return f"xor(list_reduce({codes}, lambda crc, byte: {step}, 4294967295::BIGINT), 4294967295)"


def resampling(buckets: int = 10_000, least: int = 20, per_cent: int = 10, seed: int = 2024) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
     dw AS (SELECT row, unnest(words) AS word FROM d),
     bw AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
     place AS (SELECT word, {crc32('word')} % {buckets} AS b
               FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
     s AS (SELECT b, count(*) AS s FROM dw JOIN place USING (word) GROUP BY b),
     t AS (SELECT b, count(*) AS t FROM bw JOIN place USING (word) GROUP BY b),
     gain AS (SELECT s.b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + {buckets})::DOUBLE
                / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bw) + {buckets})::DOUBLE)))::BIGINT AS gain
              FROM s LEFT JOIN t ON s.b = t.b),
     weight AS (SELECT row, sum(gain)::BIGINT AS weight FROM dw JOIN place USING (word) JOIN gain USING (b) GROUP BY row),
     scored AS (SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT
                    + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
                FROM d LEFT JOIN weight USING (row)),
     ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
                FROM scored WHERE n_features >= {least})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {per_cent} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (row)"""


def licenses() -> str:
    """One row per word of a document instead of arrays; without the gate, which must not change anything."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    table = ",\n".join(f"({quoted(word)}, {list(KINDS).index(rule.kind)}, {k}, {quoted(rule.keyword)}, "
                       f"{quoted(rf'^({rule.pattern})(?: |$)')}, {quoted(rule.label)})"
                       for k, rule in enumerate(rules()) for word in rule.first)
    phrases = ", ".join(f"({quoted(phrase)}, {len(phrase.split(' '))}, {quoted(label)})" for phrase, label in BASE.items())
    sure = ", ".join(f"({k}, {x}::DOUBLE)" for k, x in enumerate(KINDS.values()))
    first = ", ".join(map(quoted, FIRST))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
     rules(first, kind, rule, keyword, pattern, label) AS (VALUES {table}),
     phrases(phrase, n, label) AS (VALUES {phrases}),
     sure(kind, sure) AS (VALUES {sure}),
     places AS (SELECT row, words, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS start FROM d),
     ahead AS (SELECT row, start, word, array_to_string(words[start + 1:start + {WIDEST}], ' ') AS text
               FROM places WHERE word IN ({first})),
     tried AS (SELECT row, start, kind, rule, label, regexp_extract(text, pattern, 1) AS matched
               FROM ahead JOIN rules ON word = first WHERE contains(text, keyword)),
     best AS (SELECT row, start, start + len(string_split(matched, ' ')) AS stop, kind, label FROM tried WHERE matched <> ''
              QUALIFY row_number() OVER (PARTITION BY row, start
                                         ORDER BY kind, len(string_split(matched, ' ')) DESC, rule) = 1),
     matches AS (SELECT * FROM best m WHERE NOT EXISTS (
                   SELECT 1 FROM best o WHERE o.row = m.row AND o.start < m.start AND o.start >= m.start - {WIDEST}
                     AND o.stop >= m.stop AND o.kind <= m.kind)),
     base AS (SELECT row, start, label FROM ahead JOIN phrases ON starts_with(text || ' ', phrase || ' ')),
     base_of AS (SELECT row, count(*) AS n, min(start) AS low, max(start) AS high, list(DISTINCT label) AS labels
                 FROM base GROUP BY row),
     match_of AS (SELECT row, list(DISTINCT label) AS labels, max(sure) AS sure FROM matches JOIN sure USING (kind) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(b.n, 0) AS n_base, b.low::BIGINT AS first_word,
       b.high::BIGINT AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, m.labels))), ','), '') AS labels,
       greatest(coalesce(m.sure, 0::DOUBLE), CASE WHEN b.n IS NULL THEN 0 ELSE {KINDS['name']} END)::DOUBLE AS score
FROM d LEFT JOIN base_of b USING (row) LEFT JOIN match_of m USING (row)"""


def repair() -> str:
    """Left to right, the least (cost, audit) per state of the pattern, turn by turn, instead of intervals."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def cell(state: str, cost: str, letter: str, only: str = "true") -> str:
        return (f"CASE WHEN {only} AND {state} IS NOT NULL "
                f"THEN struct_pack(c := ({state}.c + {cost})::BIGINT, a := {state}.a || '{letter}') END")

    def least(*cells: str) -> str:
        return f"list_min([{', '.join(cells)}])"

    def moved(role: str, *states: str) -> list[str]:
        """Kept or given a role, from any of the states."""
        kept = [cell(state, "more", "K", f"letter = '{role}'") for state in states]
        return kept + [cell(state, "more + 3", "R", "letter <> 'x'") for state in states if role != "s"]

    return f"""
WITH RECURSIVE marked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
     damage AS (SELECT *, {crc32('key')} % 20 AS damage FROM marked),
     turns AS (SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(CASE damage WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM damage WHERE damage <> 0),
     placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
                  left(role, 1) AS initial, rtrim(text, {white}) AS ended FROM turns),
     seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
                lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM placed),
     faults AS (SELECT *, ended = '' AS blank, ended <> '' AND again AS duplicate,
                  ended <> '' AND NOT again AND right(ended, 1) NOT IN ('.', '!', '?') AS truncated FROM seen),
     letters AS MATERIALIZED (
       SELECT *, CASE WHEN blank OR duplicate THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS letter,
         CASE WHEN truncated THEN 3 ELSE 0 END AS more FROM faults),
     cells(conv_id, place, z, s, u, e) AS (
       SELECT DISTINCT conv_id, 0::BIGINT, struct_pack(c := 0::BIGINT, a := ''), NULL::STRUCT(c BIGINT, a VARCHAR),
         struct_pack(c := 3::BIGINT, a := 'I'), struct_pack(c := 6::BIGINT, a := 'II') FROM conversations
       UNION ALL
       SELECT conv_id, place, z, s, u, {least("e", cell("u", "3", "I"))} FROM (
         SELECT conv_id, place, z, s, {least("u", *[cell(x, "3", "I") for x in "zse"])} AS u, e FROM (
           SELECT c.conv_id, l.place, {cell("z", "4", "D")} AS z, {least(cell("s", "4", "D"), *moved("s", "z"))} AS s,
             {least(cell("u", "4", "D"), *moved("u", "z", "s", "e"))} AS u,
             {least(cell("e", "4", "D"), *moved("a", "u"))} AS e
           FROM cells c JOIN letters l ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND l.place = c.place + 1))),
     best AS (SELECT conv_id, {least("z", "e")} AS best FROM cells
              QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1),
     edits AS (SELECT conv_id, unnest(string_split(best.a, '')) AS edit, unnest(range(len(best.a))) AS step
               FROM best WHERE best.a <> ''),
     numbered AS (SELECT *, count(*) FILTER (edit <> 'I') OVER upto AS place, count(*) FILTER (edit <> 'D') OVER upto AS out,
                    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) AS all_out
                  FROM edits WINDOW upto AS (PARTITION BY conv_id ORDER BY step)),
     repaired AS (SELECT n.conv_id, n.out, CASE edit WHEN 'K' THEN l.role
                    ELSE CASE WHEN (n.out - all_out % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END END
                    || ':' || CASE edit WHEN 'I' THEN '' ELSE l.text END AS line
                  FROM numbered n LEFT JOIN letters l ON n.conv_id IS NOT DISTINCT FROM l.conv_id AND n.place = l.place
                  WHERE edit <> 'D'),
     texts AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY out)) AS digest FROM repaired GROUP BY conv_id),
     counts AS (SELECT conv_id, (max(turn) - min(turn) + 1 - count(DISTINCT turn))::BIGINT AS gaps,
                  count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                  count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
                FROM letters GROUP BY conv_id)
SELECT b.conv_id, {', '.join(f"coalesce({n}, 0)::BIGINT AS {n}" for n in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
       best.c AS cost, best.a AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN texts t ON b.conv_id IS NOT DISTINCT FROM t.conv_id"""
