"""DuckDB SQL of the operators that SQL can express."""

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _matches(kind: str, no: int, pattern: str, group: int, least: int) -> str:
    return rf"""
    SELECT rid, start, {no} AS kind_no, start + length(m) AS stop, v AS val, '{kind}' AS kind FROM (
      SELECT rid, m[i] AS m, v[i] AS v,
             CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start
      FROM (SELECT rid, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(body, '{pattern}', 0) AS m, regexp_extract_all(body, '{pattern}', {group}) AS v,
               string_split_regex(body, '{pattern}') AS g FROM d)))
    WHERE length(v) >= {least}"""


SECRETS = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, coalesce(source, '') AS owner FROM documents),
base AS ({_matches('assign', 0, _ASSIGN, 2, 6)} UNION ALL {_matches('access', 1, 'AKIA[A-Z0-9]+', 0, 20)}
  UNION ALL {_matches('hex', 2, '[0-9a-f]+', 0, 24)}),
mixed AS (
  SELECT * FROM ({_matches('mixed', 3, '[A-Za-z0-9+/_=-]{20,}', 0, 20)}) x
  WHERE regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = x.rid AND b.start < x.stop AND x.start < b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM mixed),
owned AS (SELECT val, count(DISTINCT owner) AS owners FROM every JOIN d USING (rid) GROUP BY val),
judged AS (SELECT every.*, owners <= 1 AS live FROM every JOIN owned USING (val)),
lists AS (
  SELECT rid,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) FILTER (kind_no < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) FILTER (kind_no < 3 OR live) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live AND kind_no < 3) AS n_example
  FROM judged GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN lists USING (rid)"""


def mixed_sql(table: str, seed: int = 7) -> str:
    """Poisson replication of a relation with the columns of documents."""
    return f"""
WITH src AS (SELECT * FROM {table}),
w AS (SELECT * FROM (VALUES ('src0', 0.2::DOUBLE), ('src1', 0.1::DOUBLE), ('src2', 0.1::DOUBLE)) t(grp, weight)),
named AS (SELECT *, CASE WHEN source IN (SELECT grp FROM w) THEN source END AS grp FROM src),
sizes AS (SELECT grp, coalesce(sum(length(text)), 0) AS size FROM named GROUP BY grp),
weighted AS (SELECT sizes.grp, size, coalesce(weight, 1 - (SELECT sum(weight) FROM w)) AS weight FROM sizes LEFT JOIN w USING (grp)),
rates AS (SELECT grp, CASE WHEN size > 0 THEN weight / sum(weight) OVER () * sum(size) OVER () / size ELSE 1.0 END AS rate FROM weighted),
cdf AS (SELECT grp, list_transform(range(0, 129), lambda k: list_sum(list_transform(range(0, k + 1),
  lambda j: exp(-rate + j * ln(rate) - lgamma(j + 1))))) AS c FROM rates),
drawn AS (SELECT named.*, len(list_filter(c, lambda x: x <= ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':1'), 1, 13))::BIGINT
  / 4503599627370496.0::DOUBLE)) AS n
  FROM named JOIN cdf ON named.grp IS NOT DISTINCT FROM cdf.grp),
copies AS (SELECT *, unnest(range(1, n + 1))::INTEGER AS copy FROM drawn WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, copy,
  ('0x' || substr(md5('{seed}:mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 15))::BIGINT AS mix_order
FROM copies"""


MIXED = mixed_sql("documents")


CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
judged AS (
  SELECT *, contains(role, '### ') OR contains(role, '</turn>') OR contains(role, ': ') OR regexp_matches(role, '(?s)\\.')
    OR contains(text, '### ') OR contains(text, '</turn>') OR regexp_matches(text, '(?s)\\.') AS conflict FROM t),
sized AS (
  SELECT *, 4 + 2 + 8 + length(role) + length(text) + CASE WHEN conflict THEN
    length(role) - length(replace(role, '\', '')) + length(text) - length(replace(text, '\', ''))
    + (length(role) - length(replace(role, '### ', ''))) // 4 + (length(text) - length(replace(text, '### ', ''))) // 4
    + (length(role) - length(replace(role, '</turn>', ''))) // 7 + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + (length(role) - length(replace(role, ': ', ''))) // 2 ELSE 0 END AS chars FROM judged)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (conflict) AS n_escaped
FROM sized GROUP BY conv_id"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte and bit by bit."""
    byte = """list_reduce(list_prepend(xor(crc, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
      lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)),
      lambda crc, b: {byte}), 4294967295)"""


def _levels(name: str, source: str) -> str:
    """Nodes of all levels over ``source(tree, idx, n, hash)``, two by two."""
    return f"""{name}(tree, level, idx, n, hash) AS (
  SELECT tree, 0, idx, n, hash FROM {source} UNION ALL
  SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM {name} WHERE n > 1
  GROUP BY tree, level, idx // 2, n)"""


def _steps(name: str, nodes: str, source: str) -> str:
    """Per row of ``source`` the sibling on every level: its side and hash, or - where there is none."""
    return f"""{name} AS (
  SELECT rid, list(CASE WHEN s.hash IS NULL THEN '-' WHEN o.at % 2 = 1 THEN 'L' || s.hash ELSE 'R' || s.hash END ORDER BY o.level) AS path
  FROM (SELECT o.rid, o.tree, k.level, o.idx >> k.level AS at FROM {source} o
        JOIN (SELECT DISTINCT tree, level FROM {nodes} WHERE n > 1) k ON k.tree IS NOT DISTINCT FROM o.tree) o
  LEFT JOIN {nodes} s ON s.tree IS NOT DISTINCT FROM o.tree AND s.level = o.level AND s.idx = xor(o.at, 1) GROUP BY rid)"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"


_BEFORE_CHARS = " || ".join(map(_field, ("doc_id", "source", "lang")))

MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang AS tree, sha256({_BEFORE_CHARS} || {_field('n_chars')} || {_field('text')}) AS hash,
    sha256({_BEFORE_CHARS} || {_field(f"(n_chars + CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 7 = 0 THEN 1 ELSE 0 END)")}
      || {_field('text')}) AS claimed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx,
  count(*) OVER (PARTITION BY tree) AS n FROM d),
{_levels('nodes', 'placed')},
subroots AS (SELECT 0 AS tree, tree AS name, hash, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx,
  row_number() OVER (ORDER BY tree NULLS FIRST) AS rid, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_levels('tops', 'subroots')},
{_steps('low', 'nodes', 'placed')},
{_steps('high', 'tops', 'subroots')},
whole AS (
  SELECT doc_id, placed.hash AS leaf, claimed, s.hash AS subroot, (SELECT hash FROM tops WHERE n = 1) AS root,
    list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path
  FROM placed JOIN subroots s ON s.name IS NOT DISTINCT FROM placed.tree
  LEFT JOIN low ON low.rid = placed.rid LEFT JOIN high ON high.rid = s.rid),
checked AS (
  SELECT *, list_reduce(list_prepend(claimed, path), lambda own, step: CASE step[1] WHEN '-' THEN sha256(own)
    WHEN 'L' THEN sha256(step[2:] || own) ELSE sha256(own || step[2:]) END) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(list_filter(path, lambda x: x <> '-'), lambda x: x[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM checked"""
