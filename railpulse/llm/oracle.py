"""SQL counterparts, for DuckDB, of the operators that SQL can express."""

from __future__ import annotations

# The base32 digits of a SHA-1: 32 groups of 5 bits, each read from two hex digits.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((16 * (strpos('0123456789abcdef', substr(hex, 1 + (5 * i) // 4, 1)) - 1)
         + strpos('0123456789abcdef', substr(hex || '0', 2 + (5 * i) // 4, 1)) - 1)
        >> (3 - (5 * i) % 4)) & 31), 1)), '')"""

OP9 = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_page FROM hashed
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""


def _shingles(table: str, key: str) -> str:
    """Distinct shingles (five words, or the whole of a shorter text) of a table's texts."""
    return f"""
  SELECT {key}, unnest(CASE WHEN len(w) >= 5
      THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle, len(w) AS n_words
  FROM (SELECT {key}, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w FROM {table})"""


# Items of five words and more; no shorter ones occur.
OP10 = f"""
WITH items AS ({_shingles('benchmark', 'item_id')}),
docs AS ({_shingles('documents', 'doc_id')}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id),
shared AS (
  SELECT doc_id, item_id, count(*) AS n_found FROM docs JOIN items USING (shingle)
  WHERE docs.n_words >= 5 AND items.n_words >= 5 GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_found, n_shingles, CAST(n_found AS DOUBLE) / n_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_found >= 0.75 * n_shingles
"""


OP2 = f"""
WITH RECURSIVE sets AS ({_shingles('documents', 'doc_id')}),
sizes AS (
  SELECT documents.doc_id, count(shingle) AS n FROM documents LEFT JOIN sets USING (doc_id) GROUP BY documents.doc_id
),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_shared
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_shared >= 75 * (x.n + y.n - n_shared)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS terms, len(terms) AS n FROM documents WHERE n > 0),
totals AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM docs),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
),
tfs AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
impacts AS (
  SELECT doc_id, term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // total))) AS impact
  FROM tfs JOIN dfs USING (term), totals
),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

# CRC-32 of a text, bit by bit: the remainder moves right, and takes in the polynomial where a one falls out.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(range(8 * strlen(key)), lambda i:
      (CAST('0x' || substr(hex(key), 1 + 2 * (i // 8), 2) AS BIGINT) >> (i % 8)) & 1)),
    lambda c, bit: xor(c >> 1, (xor(c, bit) & 1) * 3988292384)), 4294967295)"""

# Near words: equal but for the letter at one place, or one is the other without a letter.
OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL
),
hashed AS (SELECT run, times, {_CRC32} AS h FROM runs),
vocabulary AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(times) AS BIGINT) AS n
  FROM hashed GROUP BY word HAVING length(word) >= 6 AND sum(times) >= 5
),
cuts AS (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM vocabulary)
),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN vocabulary b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN vocabulary b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(most := -other_n, other := other)) AS best FROM near GROUP BY word
),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.most >= 5 * n THEN best.other END AS form, CASE WHEN -best.most >= 5 * n THEN -best.most END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)
),
chain(word, root) AS (
  SELECT word, word FROM forms
  UNION
  SELECT chain.word, forms.form FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN chain USING (word) SEMI JOIN (SELECT word AS ended FROM forms WHERE form IS NULL) ON root = ended
"""


def oracle() -> dict[str, str]:
    return {
        "op2_ngram_join": OP2, "op9_warc": OP9, "op10_decontamination": OP10, "op11_lexical": OP11, "op13_spelling": OP13,
    }
