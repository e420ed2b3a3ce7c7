"""DuckDB SQL for the operators that SQL can express: exact de-duplication and spelling variants.

The SQL is written from the operators' contracts and shares no step with them: texts are grouped as they are, and near
words are found by deleting each code point in turn.
"""

from __future__ import annotations

import zlib

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

STREAM_DEDUP = f"""
WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""


def _crc_step(crc: str, byte: str) -> str:
    """The CRC-32 register after one more byte: shifted, and for each set bit of its low byte that bit's remainder."""
    low = f"(xor({crc}, {byte}) & 255)"
    out = f"({crc} >> 8)"
    for k in range(8):
        # the remainder of a single bit, from the checksums of one byte and of none of its bits
        bit = zlib.crc32(bytes([1 << k])) ^ zlib.crc32(b"\0")
        out = f"xor({out}, (({low} >> {k}) & 1) * {bit})"
    return out


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 of a text that is not empty (code points up to U+07FF: one or two bytes)."""
    code_bytes = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 "
                  "THEN [unicode(c)::BIGINT] ELSE [(192 | (unicode(c) >> 6))::BIGINT, "
                  "(128 | (unicode(c) & 63))::BIGINT] END))")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {code_bytes}), lambda a, b: {_crc_step('a', 'b')}), 4294967295)"


SPELLING = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, {LOWER.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, c, {_crc32("concat(doc_id, ':', run)")} AS h FROM counted),
planted AS (
    SELECT CASE WHEN h % 97 = 0 THEN concat(substring(run, 1, (h % length(run))::BIGINT),
                                            substring(run, (h % length(run))::BIGINT + 2)) ELSE run END AS word, c
    FROM hashed),
words AS (
    SELECT word, sum(c)::BIGINT AS n FROM planted WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cuts AS (
    SELECT word, n, p, concat(substring(word, 1, p - 1), substring(word, p + 1)) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
shorter AS (SELECT DISTINCT c.word AS long_word, c.n AS long_n, w.word AS short_word, w.n AS short_n
            FROM cuts c JOIN words w ON w.word = c.rest),
near AS (
    SELECT long_word AS word, long_n AS n, short_word AS other, short_n AS other_n FROM shorter
    UNION ALL
    SELECT short_word, short_n, long_word, long_n FROM shorter
    UNION ALL
    SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word),
best AS (
    SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
           row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
    FROM near),
formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
           CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
           CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
steps AS (
    SELECT word, word AS at, form AS next FROM formed
    UNION ALL
    SELECT s.word, f.word, f.form FROM steps s JOIN formed f ON f.word = s.next)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN steps s ON s.word = f.word AND s.next IS NULL
"""

ORACLE_SQL = {"op11_stream_dedup": STREAM_DEDUP, "op12_spelling_variants": SPELLING}
