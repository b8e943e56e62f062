"""SQL fragments restating the bindings (B1–B8) for the DuckDB oracles."""

# B1 lexicon from benchmark tokens
LEX = r"""
lex_toks AS (
  SELECT item_id, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS p
  FROM (SELECT item_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS t FROM benchmark)
),
lex AS (
  SELECT min(item_id * 4294967296 + p) AS seq, term,
         term || '-g; alt ' || term AS gloss, 'len' || CAST(length(term) AS VARCHAR) AS term_type
  FROM (SELECT item_id, p, regexp_replace(tok, '[^a-z]', '', 'g') AS term FROM lex_toks)
  WHERE term <> '' GROUP BY term
)"""

# L6 lookup from the lexicon (keys: lower(term) and lower(canonical form))
LOOKUP = LEX + r""",
lookup_src AS (
  SELECT lower(term) AS key, seq * 2 AS ord, gloss FROM lex
  UNION ALL
  SELECT lower(regexp_replace(translate(term, '[]/', ''), '^\s+|\s+$', '', 'g')), seq * 2 + 1, gloss FROM lex
),
lookup AS (SELECT key, arg_max(gloss, ord) AS gloss, min(ord) AS pos FROM lookup_src GROUP BY key)"""

# B2 requests
REQUESTS = r"""
requests AS (
  SELECT conv_id * 4294967296 + turn AS request_id, conv_id % 50 AS user_id, text
  FROM conversations WHERE role = 'user'
)"""

# B3 request log
LOG = r"""
log AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type IN ('click', 'view') THEN 'audio' ELSE 'text' END AS input_type,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         value * 40.0 AS latency_ms,
         CAST(json_extract(props, '$.k') AS BIGINT) / 100.0 AS confidence,
         CAST(json_extract(props, '$.k') AS BIGINT) % 3 = 0 AS missed,
         event_type = 'signup' AS is_submission
  FROM events
)"""

# B4 text pairs
PAIRS = r"""
pairs AS (
  SELECT a.conv_id * 4294967296 + a.turn AS pair_id, a.conv_id % 50 AS user_id,
         a.text AS reference, b.text AS hypothesis
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
)"""

# B8 runs
RUNS = r"""
runs AS (
  SELECT p_brand AS model, p_partkey AS version,
         CASE WHEN p_size % 3 = 0 THEN 'Production' ELSE 'Staging' END AS stage,
         (p_retailprice / 1000.0) - floor(p_retailprice / 1000.0) AS metric,
         p_type AS model_type, p_size
  FROM part
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().strip(",") for p in parts) + "\n"


def tokens_of(text: str) -> str:
    """DuckDB whitespace tokens of an expression (empties dropped)."""
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda x: x <> '')"

# B1 with repeated, bracketed and capitalised entries
RICH = LEX + r""",
rich AS (
  SELECT seq, term, gloss, term_type FROM lex
  UNION ALL SELECT seq + 1000000, '[' || substr(term, 1, 1) || ']/' || substr(term, 2), term || '-second; more', term_type FROM lex WHERE length(term) % 2 = 0
  UNION ALL SELECT seq - 1000000, upper(substr(term, 1, 1)) || substr(term, 2), term || '-first', term_type FROM lex WHERE length(term) % 3 = 0
)"""
