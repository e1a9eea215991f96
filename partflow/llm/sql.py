"""DuckDB twins of the registered queries that SQL can express.

The mix hands out every seat by its quotient, windows are compared as texts, and chats are digested from
their turns, neighbours come from all similarities: no shortcut of an operator is repeated here. Fingerprints need XXH64, edit distances
over components, tokenizers, and learned weights: those queries are tested against brute force.
"""

from __future__ import annotations

from partflow.llm.chat import HEADERS, OTHER
from partflow.llm.common import LOWER, UPPER
from partflow.llm.mixing import SEED

MIXING = f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE source_no % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM sources),
filling AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source_no) AS place,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(weight) OVER () - coalesce(sum(weight) OVER (
           ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight,
         CAST(sum(source_size) OVER () AS DOUBLE) AS everything FROM weighed),
levels AS (SELECT *, (CAST(1.5 AS DOUBLE) * everything - filled) / open_weight AS level FROM filling),
targets AS (
  SELECT *, least(cap, (SELECT arg_min(level, place) FROM levels WHERE level <= cap / weight) * weight) AS target,
         CAST(ceil(sqrt(n_docs)) AS BIGINT) AS n_shards FROM levels),
units AS (
  SELECT *, CASE WHEN target >= 64 * 32 AND source_size >= 16 * 32 * n_shards THEN 32 ELSE 1 END AS unit FROM targets),
placed AS (
  SELECT d.doc_id, d.size, u.source_no, u.source_size, u.target, u.unit,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % u.n_shards AS shard, CAST('0x' || substr(h, 9, 15) AS BIGINT) AS place
  FROM (SELECT *, md5(concat_ws(':', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR))) AS h FROM sizes) d
  JOIN units u ON d.source IS NOT DISTINCT FROM u.source),
shards AS (
  SELECT source_no, shard, CAST(sum(size) AS BIGINT) AS shard_size,
         CAST(greatest(least(sum(size), 1), round(sum(size) / any_value(unit))) AS BIGINT) AS blocks
  FROM placed GROUP BY source_no, shard),
votes AS (
  SELECT u.unit, u.source_no, u.target * b.blocks / u.source_size AS votes, CAST(2 * b.blocks AS BIGINT) AS most
  FROM units u JOIN (SELECT source_no, CAST(sum(blocks) AS BIGINT) AS blocks FROM shards GROUP BY source_no) b USING (source_no)
  WHERE u.source_size > 0),
source_seats AS (
  SELECT source_no, count(*) AS seats FROM (
    SELECT source_no, row_number() OVER (PARTITION BY unit ORDER BY votes / (2 * k + 1) DESC, source_no) AS nth,
           round(all_votes) AS given FROM (
      SELECT *, unnest(range(most)) AS k FROM (SELECT *, sum(votes) OVER (PARTITION BY unit) AS all_votes FROM votes)))
  WHERE nth <= given GROUP BY source_no),
quotas AS (
  SELECT source_no, shard, count(*) AS quota FROM (
    SELECT source_no, shard, seats, row_number() OVER (PARTITION BY source_no ORDER BY blocks / (2 * k + 1) DESC, shard) AS nth FROM (
      SELECT *, unnest(range(2 * blocks)) AS k FROM shards JOIN source_seats USING (source_no)))
  WHERE nth <= seats GROUP BY source_no, shard),
lined AS (
  SELECT p.*, s.shard_size, s.blocks, coalesce(q.quota, 0) AS quota, p.shard * 7919 % greatest(s.blocks, 1) AS turn,
         CAST(sum(p.size) OVER (PARTITION BY p.source_no, p.shard ORDER BY p.place, p.doc_id, p.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - p.size AS start,
         row_number() OVER () AS row_no
  FROM placed p JOIN shards s USING (source_no, shard) LEFT JOIN quotas q USING (source_no, shard)),
pieces AS (
  SELECT row_no, greatest(0, least(start + size, (block + 1) * shard_size // blocks) - greatest(start, block * shard_size // blocks))
         * (quota // blocks + (block + turn + 1) * (quota % blocks) // blocks - (block + turn) * (quota % blocks) // blocks) AS words
  FROM (SELECT *, unnest(range(greatest(start * blocks // shard_size - 1, 0), least((start + size) * blocks // shard_size + 2, blocks))) AS block
        FROM lined WHERE size > 0))
SELECT doc_id, size, source_size, coalesce(target, 0) AS target, CAST(coalesce(sum(words), 0) AS BIGINT) AS taken
FROM lined LEFT JOIN pieces USING (row_no) GROUP BY row_no, doc_id, size, source_size, target
"""

WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_no, {WORDS} AS words FROM documents),
items AS (SELECT item_id, words, least(len(words), 13) AS n FROM (SELECT item_id, {WORDS} AS words FROM benchmark) WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(words[place:place + n - 1], ' ') AS spelled
            FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS place FROM items)),
places AS (SELECT row_no, words, n, unnest(range(1, len(words) - n + 2)) AS place
           FROM docs JOIN (SELECT DISTINCT n FROM windows) ON len(words) >= n),
hits AS (SELECT p.row_no, p.place, p.n, w.item_id FROM (SELECT *, array_to_string(words[place:place + n - 1], ' ') AS spelled FROM places) p
         JOIN windows w ON p.n = w.n AND p.spelled = w.spelled),
hit_words AS (SELECT row_no, count(DISTINCT word) AS n_hit FROM (SELECT row_no, unnest(range(place, place + n)) AS word FROM hits) GROUP BY row_no),
hit_items AS (SELECT row_no, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY row_no)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit_words USING (row_no) LEFT JOIN hit_items USING (row_no)
"""

MARK_LENGTHS = " ".join(f"WHEN '{role}' THEN {len(head) + len(foot)}" for role, (head, foot) in HEADERS.items())
ESCAPES = "length({0}) - length(replace(replace({0}, '[', ''), '<', ''))"

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS own_role, text AS own_text FROM conversations
  UNION ALL SELECT -7, nth, said, '</s>[INST] ok [/INST]', said, '</s>[INST] ok [/INST]'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS probe(nth, said)),
sized AS (
  SELECT *, length(text) + {ESCAPES.format('text')} + CASE role {MARK_LENGTHS}
         ELSE {sum(map(len, OTHER))} + length(role) + {ESCAPES.format('role')} END AS chars FROM turns),
spelled AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, own_role NULLS FIRST, own_text NULLS FIRST) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, own_role NULLS FIRST, own_text NULLS FIRST)
                  FILTER (WHERE role = 'assistant'), '') AS learned FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars FROM spelled
"""

NEIGHBOURS = """
WITH vectors AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
normed AS (SELECT *, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda total, x: total + x)) AS norm FROM vectors),
scored AS (
  SELECT q.vec_id AS query_id, q.v AS query, c.vec_id,
         list_reduce(list_transform(list_zip(q.v, c.v), lambda pair: pair[1] * pair[2]), lambda total, x: total + x) / (q.norm * c.norm) AS score
  FROM normed q JOIN normed c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS nth FROM scored) WHERE nth <= 5
"""

FLOORED = """
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""


def assigned(book: str) -> str:
    """Every part with its nearest entry of a codebook: the smallest of distance times 64 plus index."""
    return f"""(
  SELECT row_no, p, any_value(piece) AS piece, min(64 * away + entry) AS best FROM (
    SELECT k.row_no, k.p, k.piece, b.entry,
           list_sum(list_transform(range(1, len(k.piece) + 1), lambda i: (k.piece[i] - b.piece[i]) * (k.piece[i] - b.piece[i]))) AS away
    FROM pieces k JOIN {book} b USING (p)) GROUP BY row_no, p)"""


def moved(book: str) -> str:
    """The codebook after a round: floors of the members' means, component by component."""
    return f"""(
  WITH members AS (SELECT p, best % 64 AS entry, piece, unnest(range(1, len(piece) + 1)) AS place FROM {assigned(book)}),
  means AS (SELECT p, entry, place, CAST((s - ((s % c) + c) % c) // c AS BIGINT) AS mean FROM (
    SELECT p, entry, place, CAST(sum(piece[place]) AS BIGINT) AS s, count(*) AS c FROM members GROUP BY p, entry, place))
  SELECT p, entry, coalesce(m.piece, b.piece) AS piece FROM {book} b
  LEFT JOIN (SELECT p, entry, list(mean ORDER BY place) AS piece FROM means GROUP BY p, entry) m USING (p, entry))"""


VECTOR_CODES = f"""
WITH kept AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS row_no FROM ({FLOORED})),
pieces AS MATERIALIZED (SELECT row_no, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS piece
                        FROM (SELECT row_no, v, unnest(range(16)) AS p FROM kept)),
book0 AS MATERIALIZED (SELECT p, row_no AS entry, piece FROM pieces WHERE row_no < 64),
book1 AS MATERIALIZED {moved("book0")},
book2 AS MATERIALIZED {moved("book1")},
coded AS MATERIALIZED (SELECT row_no, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error
          FROM {assigned("book2")} GROUP BY row_no)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(piece, ','), ',' ORDER BY p, entry)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (row_no)
"""

HARD_NEGATIVES = f"""
WITH kept AS (SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, v
              FROM ({FLOORED}) WHERE vec_id IS NOT NULL AND label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, a.v AS anchor, c.vec_id, c.label,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1), lambda i: a.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM kept a JOIN kept c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, own, anchor, vec_id AS positive_id, score AS positive_score, nth FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, own, anchor ORDER BY score DESC, vec_id) AS nth FROM scored WHERE label = own) WHERE nth <= 5)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM (
  SELECT p.*, s.vec_id, s.score,
         row_number() OVER (PARTITION BY p.anchor_id, p.own, p.anchor, p.nth ORDER BY s.score DESC, s.vec_id) AS place
  FROM positives p JOIN scored s USING (anchor_id, own, anchor)
  WHERE s.label <> p.own AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score) WHERE place <= 3
"""

TWINS: dict[str, str] = {"op1_mixing": MIXING, "op2_decontamination": DECONTAMINATION, "op7_chat": CHAT, "op10_neighbours": NEIGHBOURS,
                         "op11_vector_codes": VECTOR_CODES, "op12_hard_negatives": HARD_NEGATIVES}
