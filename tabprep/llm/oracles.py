"""SQL counterparts of the registered queries that SQL can express, for DuckDB.

No counterpart: op1 (parsing of markup), op2 (best fit), op6 (all alignments of all words would be compared),
op7 and op10 (learned models), op9 (a tokenizer). Tests hold these against brute force, exact counts or
held-out accuracy.
"""

from __future__ import annotations

from tabprep.llm.chat_format import LABELS

_BLANK = r"[\x20\x09-\x0D]+"
_WORDS = rf"[w for w in string_split_regex(%s, '{_BLANK}') if w <> '']"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_labels = " ".join(f"WHEN '{role}' THEN '### {label}:'" for role, label in LABELS.items())
OP3 = rf"""WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
  rendered AS (SELECT *, CASE role {_labels} ELSE '### role ' || to_json(role) || ':' END || chr(10)
      || regexp_replace(text, '(\\*(###|</turn>))', '\\\1', 'g') || chr(10) || '</turn>' || chr(10) AS formatted FROM given)
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::bigint AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(length(formatted))::bigint AS formatted_chars FROM rendered GROUP BY conv_id"""

OP4 = """WITH v AS (SELECT vec_id, [floor(256 * x::double) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
  scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
  SELECT query_id, rank::int AS rank, vec_id, score FROM (SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5"""

OP5 = f"""WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS % _LOWER} AS w FROM documents),
  shingles AS (SELECT DISTINCT doc_id, list_slice(w, i, i + least(len(w), 5) - 1) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM docs WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    LEFT JOIN sizes USING (doc_id)"""

OP8 = f"""WITH docs AS (SELECT doc_id, {_WORDS % "coalesce(text, '')"} AS w FROM documents),
  words AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 49 <= len(w) THEN md5(array_to_string(list_slice(w, i, i + 49), ' ')) END AS run
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
  first AS (SELECT run, min(doc_id) AS first_id FROM words WHERE run IS NOT NULL GROUP BY run),
  marked AS (SELECT doc_id, i, word, coalesce(max(CASE WHEN first_id < doc_id THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone FROM words LEFT JOIN first USING (run)),
  kept AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS rest FROM marked GROUP BY doc_id)
  SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0)::bigint AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (doc_id)"""

# The table of the checksum of bytes, by its rule, and the checksum of the UTF-8 of a text.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t)"""


def _crc(text: str) -> str:
    at = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint"
    bytes_of = f"list_transform(range(octet_length(encode({text}))), lambda i: {at})"
    return f"xor(4294967295, list_reduce({bytes_of}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint))"


_FEATURES = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP11 = f"""WITH {_CRC_TABLE}, docs AS (SELECT doc_id, row_number() OVER () AS r, {_FEATURES} AS w FROM documents),
  wanted AS (SELECT unnest({_FEATURES}) AS w FROM benchmark),
  given AS (SELECT r, unnest(w) AS w FROM docs),
  words AS (SELECT w, {_crc("w")} % 10000 AS bucket FROM (SELECT w FROM given UNION SELECT w FROM wanted), crc),
  s AS (SELECT bucket, count(*) AS n FROM given JOIN words USING (w) GROUP BY bucket),
  t AS (SELECT bucket, count(*) AS n FROM wanted JOIN words USING (w) GROUP BY bucket),
  sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS all_s, (SELECT coalesce(sum(n), 0) FROM t) AS all_t),
  gains AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (all_s + 10000)::double
    / ((coalesce(s.n, 0) + 1)::double * (all_t + 10000)::double)))::bigint AS gain FROM s FULL JOIN t USING (bucket), sums),
  weights AS (SELECT r, floor(sum(gain) / count(*))::bigint AS weight FROM given JOIN words USING (w) JOIN gains USING (bucket) GROUP BY r),
  scored AS (SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint AS score
    FROM docs LEFT JOIN weights USING (r)),
  ranks AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS able FROM scored)
  SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * able // 100 THEN k END AS rank FROM ranks"""

OP12 = """WITH p AS (SELECT *, encode(coalesce(html, '')) AS payload FROM pages),
  h AS (SELECT page_id, url, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
  g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM h)
  SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to, url FROM g"""

OP13 = rf"""WITH RECURSIVE {_CRC_TABLE},
  runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL),
  hashed AS (SELECT run, n, {_crc("doc_id || ':' || run")} AS h FROM runs, crc),
  results AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END AS word FROM hashed),
  words AS (SELECT word, sum(n)::bigint AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
  cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
  pairs AS (SELECT a.word AS a, b.word AS b, b.n AS b_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.rest = words.word
    UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.rest = words.word),
  best AS (SELECT a AS word, count(*) AS n_near, min(struct_pack(less := -b_n, other := encode(b))) AS best FROM pairs GROUP BY a),
  forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * n THEN decode(best.other) END AS form,
    CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n FROM words LEFT JOIN best USING (word)),
  way AS (SELECT word, word AS place FROM forms UNION ALL SELECT way.word, form FROM way JOIN forms ON forms.word = way.place WHERE form IS NOT NULL),
  roots AS (SELECT way.word, place AS root FROM way JOIN forms ON forms.word = way.place WHERE form IS NULL)
  SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
