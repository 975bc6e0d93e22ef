"""DuckDB SQL for the queries that SQL can express."""

#: ASCII letters in lower case; words as runs of letters, digits and non-ASCII characters.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

ORACLES: dict[str, str] = {}

ORACLES["op8_benchmark_decontamination"] = f"""
WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(13, len(w)) - 1) AS p
  FROM item_words, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS r(i) WHERE len(w) > 0
),
doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT len(p) AS n FROM windows),
places AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS p FROM doc_words, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (p)),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS r(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

ORACLES["op10_stupid_backoff"] = f"""
WITH words AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS before
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents), unnest(range(1, len(w) + 1)) AS r(i)
),
singles AS (SELECT word, count(*) AS n, sum(count(*)) OVER () AS total FROM words GROUP BY word),
pairs AS (SELECT before, word, count(*) AS n FROM words WHERE before IS NOT NULL GROUP BY before, word),
scored AS (
  SELECT doc_id, CASE WHEN i = 1 THEN s.n / s.total WHEN p.n IS NOT NULL THEN p.n / b.n ELSE 0.4::DOUBLE * s.n / s.total END AS s
  FROM words JOIN singles s USING (word) LEFT JOIN singles b ON b.word = words.before
  LEFT JOIN pairs p ON p.before = words.before AND p.word = words.word
)
SELECT d.doc_id, count(s.s) AS n_words, round(coalesce(sum(log10(s.s)), 0), 4) + 0.0 AS log_score
FROM documents d LEFT JOIN scored s USING (doc_id) GROUP BY d.doc_id
"""

#: The table of CRC-32 (reflected polynomial EDB88320), made by shifting each byte value eight times.
_CRC_TABLE = """crc_steps AS (
  SELECT v, 0 AS k, v AS c FROM range(256) AS r(v)
  UNION ALL SELECT v, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM crc_steps WHERE k = 8)"""

ORACLES["op7_stratified_interleaving"] = f"""
WITH RECURSIVE {_CRC_TABLE},
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled,
    coalesce('s' || source, '') AS stratum,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda h: ('0x' || h)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table
),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY shuffled, doc_id, text_crc32, size)
      - ('0x' || substr(md5('7:' || stratum), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE)
    / count(*) OVER (PARTITION BY stratum) AS fraction FROM sized
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, shuffled, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 8 // n AS INTEGER) AS shard,
  place - ((place * 8 // n) * n + 7) // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

#: A field as it enters a leaf's digest.
_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"


def _merkle_levels(name: str, leaves: str) -> str:
    """Recursive query of all nodes (g, level, pos, d, n) over ``leaves`` with (g, pos, d, n)."""
    return f"""{name} AS (
  SELECT g, 0 AS level, pos, d, n FROM {leaves}
  UNION ALL
  SELECT g, level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY g, level, pos // 3
)"""


def _merkle_steps(nodes: str, leaves: str, key: str) -> str:
    """Of each leaf ``key``, per level the digests before and after its ancestor in the run."""
    return f"""SELECT l.{key}, a.level,
    coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos < a.pos), '') AS before,
    coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos > a.pos), '') AS after
  FROM {leaves} l JOIN {nodes} a ON a.g = l.g AND a.n > 1 AND a.pos = l.pos // CAST(3 ** a.level AS BIGINT)
  JOIN {nodes} s ON s.g = a.g AND s.level = a.level AND s.pos // 3 = a.pos // 3 GROUP BY l.{key}, a.level"""


ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('s' || source, '') AS g, {_LEAF.format(text="text")} AS d,
    {_LEAF.format(text="replace(text, chr(10), '')")} AS cut,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'),
      lambda h: ('0x' || h)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 2 = 0 AS touched
  FROM documents, crc_table
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM docs
),
{_merkle_levels("nodes", "leaves")},
tops AS (
  SELECT g AS name, '' AS g, d, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
),
{_merkle_levels("upper", "tops")},
steps AS (
  SELECT id, level, before, after FROM ({_merkle_steps("nodes", "leaves", "id")})
  UNION ALL
  SELECT id, 1000 + level, before, after FROM ({_merkle_steps("upper", "tops", "name")}) u JOIN leaves ON u.name = leaves.g
),
ordered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level) AS k FROM steps),
folded AS (
  SELECT id, 0 AS k, CASE WHEN touched THEN cut ELSE d END AS d FROM docs
  UNION ALL
  SELECT f.id, o.k, sha256(before || f.d || after) FROM folded f JOIN ordered o ON o.id = f.id AND o.k = f.k + 1
),
reached AS (SELECT id, max_by(d, k) AS folded_root FROM folded GROUP BY id),
proofs AS (SELECT id, sha256(string_agg(before || after, '' ORDER BY k)) AS proof_sha256 FROM ordered GROUP BY id)
SELECT doc_id, l.d AS leaf, t.d AS subroot, r.d AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = r.d AS verified
FROM leaves l JOIN tops t ON t.name = l.g JOIN reached USING (id) LEFT JOIN proofs USING (id), (SELECT d FROM upper WHERE n = 1) r
"""

#: Bits of the filters.
_BITS = "(VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16))"

ORACLES["op11_filter_interaction_audit"] = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents
),
words AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts),
marked AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, CAST(len(w) < 100 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INTEGER)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER) + 16 * CAST(coalesce(first_id < words.doc_id, false) AS INTEGER) AS mask,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN marked ON marked.doc_id = words.doc_id
),
bits(letter, bit) AS {_BITS},
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order FROM bits a, bits b, bits c, bits d, bits e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
),
steps AS (
  SELECT filter_order, step, letter, bit,
    (SELECT coalesce(sum(p.bit), 0) FROM bits p WHERE contains(filter_order[:step - 1], p.letter)) AS applied
  FROM orders, range(1, 6) AS r(step) JOIN bits ON letter = filter_order[step]
),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM judged GROUP BY part, mask),
counted AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN (mask & (applied | bit)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN x ELSE 0 END) AS toxic_lost
  FROM (SELECT filter_order, step, letter, CAST(bit AS BIGINT) AS bit, CAST(applied AS BIGINT) AS applied FROM steps),
    (SELECT part, CAST(mask AS BIGINT) AS mask, n, g, x FROM cells)
  GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
