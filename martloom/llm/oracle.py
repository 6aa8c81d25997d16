"""DuckDB SQL of the queries that SQL can express, written from the contracts and not from the plans:
spans overlap and cover each other by plain joins, blocks and documents by their first and last words."""

from __future__ import annotations

from martloom.llm import licenses, merkle_manifest, mixing, secrets, sharding
from martloom.llm.common import WORD


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _any_case(pattern: str) -> str:
    """The names before an assignment in either case, by ASCII letters alone: SQL's case flag folds others too."""
    names, rest = pattern[: pattern.index(")") + 1], pattern[pattern.index(")") + 1 :]
    head = "(?:" if names.startswith("(?:") else "("
    return head + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in names.removeprefix(head)) + rest


def _located(rows: str, key: str, columns: str) -> str:
    """Rows of (``key``, ``columns``, text, pattern) with one row a match: hit, s, e (code points). Matches and the
    texts between them, laid end to end, give the places."""
    return f"""
      SELECT {key}, {columns}, hit, e - length(hit) AS s, e FROM (
        SELECT {key}, {columns}, hit, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY {key}, {columns} ORDER BY i) AS BIGINT) AS e
        FROM (
          SELECT {key}, {columns}, unnest(range(1, len(gaps) + 1)) AS i, unnest(hits) AS hit, unnest(gaps) AS gap FROM (
            SELECT {key}, {columns}, regexp_extract_all(text, pattern) AS hits, string_split_regex(text, pattern) AS gaps FROM ({rows})))
        WHERE hit IS NOT NULL)"""


def op1_secrets() -> str:
    assign = _any_case(secrets.ASSIGN)
    patterns = {
        "assign": assign, "access": secrets.ACCESS, "hex": secrets.HEX, "ident": _any_case(secrets.IDENT), "email": secrets.EMAIL,
        "label": _any_case(secrets.LABEL), "token": secrets.TOKEN, "endpoint": secrets.ENDPOINT,
    }
    kinds = ", ".join(f"({i}, {_quoted(k)}, {_quoted(secrets.ROLE[k])}, {_quoted(patterns[k])})" for i, k in enumerate(secrets.KINDS))
    reach, least, base = secrets.REACH, secrets.LEAST, secrets.BASE_KINDS
    return f"""
    WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    kinds(kind, name, role, pattern) AS (VALUES {kinds}),
    found AS MATERIALIZED ({_located("SELECT r, kind, name, role, text, pattern FROM docs, kinds", "r", "kind, name, role")}),
    strong AS MATERIALIZED (
      SELECT * FROM found WHERE
        (name = 'assign' AND length(regexp_extract(hit, {_quoted(assign)}, 2)) >= {least["assign"]})
        OR (name = 'access' AND length(hit) >= {least["access"]}) OR (name = 'hex' AND length(hit) >= {least["hex"]})),
    weak AS (
      SELECT * FROM found w WHERE kind >= {base}
        AND (name <> 'token' OR (regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]')))
        AND NOT EXISTS (SELECT 1 FROM strong b WHERE b.r = w.r AND b.s < w.e AND b.e > w.s)),
    breaks AS MATERIALIZED ({_located(f"SELECT r, 0 AS kind, text, {_quoted(chr(92) + 'n[' + chr(92) + 'x20' + chr(92) + 't' + chr(92) + 'r]*' + chr(92) + 'n')} AS pattern FROM docs", "r", "kind")}),
    parts AS MATERIALIZED (
      SELECT p.r, p.kind, p.name, p.role, p.s, p.e, count(b.s) AS scope
      FROM (SELECT * FROM strong UNION ALL SELECT * FROM weak) p LEFT JOIN breaks b ON b.r = p.r AND b.s < p.s
      GROUP BY ALL),
    linked AS (
      SELECT w.r, w.kind, w.name, w.s, w.e
      FROM parts w JOIN parts b ON b.r = w.r AND b.scope = w.scope AND b.role <> w.role AND b.s <= w.e + {reach} AND b.e >= w.s - {reach}
      WHERE w.kind >= {base} GROUP BY ALL
      HAVING (any_value(w.role) <> 'endpoint' AND count(*) FILTER (WHERE b.role IN ('identifier', 'secret')) > 0)
        OR (count(*) FILTER (WHERE b.role = 'identifier') > 0 AND count(*) FILTER (WHERE b.role = 'secret') > 0)),
    spans AS (SELECT r, kind, s, e, name || ':' || s || ':' || e AS item FROM strong UNION ALL SELECT r, kind, s, e, name || ':' || s || ':' || e FROM linked)
    SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
      count(*) FILTER (WHERE kind = 2) AS n_hex,
      sha256(coalesce(string_agg(item, ',' ORDER BY s, kind, e) FILTER (WHERE kind < {base}), '')) AS base_sha256,
      coalesce(string_agg(item, ',' ORDER BY s, kind, e), '') AS spans
    FROM docs LEFT JOIN spans USING (r) GROUP BY r"""


def op4_mixing() -> str:
    seed, shards = mixing.SEED, mixing.SHARDS
    strides = " ".join(f"WHEN blocks % {p} <> 0 THEN {p}" for p in mixing.STRIDES)
    words_of = ", ".join(
        f"CAST(coalesce(sum(words * (SELECT count(*) FROM range(0, passes + 1) t(d) WHERE draw + d * blocks >= ends[{j}] AND draw + d * blocks < ends[{j + 1}])), 0) AS BIGINT)"
        for j in range(1, shards + 1)
    )
    return f"""
    WITH docs AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {_quoted(WORD)})), 0) AS BIGINT) AS size FROM documents),
    placed AS MATERIALIZED (
      SELECT r, doc_id, source, size, coalesce(CAST(sum(size) OVER (PARTITION BY source
          ORDER BY md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size), doc_id NULLS FIRST, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS lo
      FROM docs),
    sources AS (
      SELECT source, source_size, [{", ".join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
        {mixing.MOST_REPEATS} * source_size AS stop
      FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)),
    ranked AS (
      SELECT *, row_number() OVER by_stop AS n,
        CAST((SELECT sum(source_size) FROM sources) - coalesce(sum(stop) OVER (by_stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS words_left,
        CAST(sum(weight) OVER (by_stop ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weight_left
      FROM sources WINDOW by_stop AS (ORDER BY stop / weight, source)),
    -- The sources before the first one that stays below its stop are stopped; the others share the rest.
    level AS (SELECT words_left / weight_left AS level FROM ranked WHERE stop >= words_left / weight_left * weight ORDER BY n LIMIT 1),
    seats AS (
      SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0.0 END AS share FROM (
        SELECT source, source_size, least(CAST(stop AS DOUBLE), level * weight) AS target, CAST(greatest(ceil(source_size / {mixing.BLOCK_WORDS}), 1) AS BIGINT) AS blocks
        FROM sources, level)),
    plan AS MATERIALIZED (
      SELECT *, ends[{shards + 1}] // blocks AS passes, ends[{shards + 1}] % blocks AS rest, source_size % blocks AS longer,
        CASE {strides} END AS stride,
        CAST('0x' || substr(sha256('{seed}:' || sha256(CASE WHEN source IS NULL THEN 'true' ELSE 'false' END || coalesce(source, ''))), 1, 8) AS BIGINT) % blocks AS first
      FROM (SELECT *, list_transform(range(0, {shards + 1}), lambda j: CAST(floor(share * j / {shards} + 0.5) AS BIGINT)) AS ends FROM seats)),
    blocks AS (
      SELECT source, blocks, passes, rest, ends, (b * stride + first) % blocks AS draw,
        b * ((source_size - longer) // blocks) + (b * longer) // blocks AS low,
        (b + 1) * ((source_size - longer) // blocks) + ((b + 1) * longer) // blocks AS high
      FROM (SELECT *, unnest(range(0, blocks)) AS b FROM plan)),
    cut AS (
      SELECT r, draw, b.blocks, passes, rest, ends, least(high, lo + size) - greatest(low, lo) AS words
      FROM placed p JOIN blocks b ON b.source IS NOT DISTINCT FROM p.source AND low < lo + size AND high > lo WHERE size > 0),
    taken AS (
      SELECT r, coalesce(sum(words) FILTER (WHERE draw < rest), 0) AS extra, array_to_string([{words_of}], ',') AS shard_words FROM cut GROUP BY r)
    SELECT p.doc_id, p.size, s.source_size, s.target, CAST(s.passes * p.size + coalesce(t.extra, 0) AS BIGINT) AS taken, p.source,
      coalesce(t.shard_words, '{",".join(["0"] * shards)}') AS shard_words
    FROM placed p JOIN plan s ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN taken t USING (r)"""


def op10_licenses() -> str:
    base = [licenses.Rule(licenses.keyword_of(p), licenses.regex_of(p), label, -1) for p, label in licenses.BASE_PHRASES.items()]
    entries = ", ".join(f"({i}, {_quoted(x.keyword)}, {_quoted(x.regex)}, {_quoted(x.label)}, {x.tier})" for i, x in enumerate(base + licenses.rules()))
    confidence = " ".join(f"WHEN {tier} THEN {value}" for tier, value in enumerate(licenses.CONFIDENCE))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = "SELECT r, rule, label, tier, regex AS pattern, text FROM docs, rules WHERE contains(text, keyword)"
    return f"""
    WITH words AS (
      SELECT row_number() OVER () AS r, doc_id,
        trim(regexp_replace(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), {_quoted(licenses.SEPARATORS)}, '  ', 'g')) AS text
      FROM documents),
    docs AS MATERIALIZED (SELECT r, doc_id, CASE WHEN text = '' THEN '' ELSE ' ' || text || ' ' END AS text FROM words),
    rules(rule, keyword, regex, label, tier) AS (VALUES {entries}),
    found AS MATERIALIZED ({_located(found, "r", "rule, label, tier")}),
    places AS (
      SELECT r, label, (s - length(replace(substr(d.text, 1, s), ' ', ''))) // 2 AS word FROM found JOIN docs d USING (r) WHERE tier < 0),
    based AS (
      SELECT r, count(*) AS n_base, CAST(min(word) AS BIGINT) AS first_word, CAST(max(word) AS BIGINT) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
      FROM places GROUP BY r),
    kept AS MATERIALIZED (
      SELECT * FROM found x WHERE tier >= 0 AND NOT EXISTS (
        SELECT 1 FROM found c WHERE c.tier >= 0 AND c.r = x.r AND c.s <= x.s AND c.e >= x.e AND c.tier <= x.tier
          AND (c.s < x.s OR c.e > x.e OR c.tier < x.tier OR c.rule < x.rule))),
    ruled AS (SELECT r, count(*) AS n_detections, min(tier) AS tier, string_agg(DISTINCT label, ',' ORDER BY label) AS method_labels FROM kept GROUP BY r),
    labelled AS (
      SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM places UNION ALL SELECT r, label FROM kept) GROUP BY r)
    SELECT doc_id, CAST((length(text) - length(replace(text, ' ', ''))) // 2 AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
      coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
      CAST(CASE WHEN tier IS NOT NULL THEN CASE tier {confidence} END WHEN n_base > 0 THEN {licenses.BASE_CONFIDENCE} ELSE 0 END AS DOUBLE) AS score,
      coalesce(method_labels, '') AS method_labels, coalesce(n_detections, 0) AS n_detections
    FROM docs LEFT JOIN based USING (r) LEFT JOIN ruled USING (r) LEFT JOIN labelled USING (r)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, byte by byte over the table that the polynomial's rule gives."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ 0xEDB88320 * (byte & 1)
        table.append(byte)
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    step = f"lambda c, b: xor(c >> 8, CAST({table} AS BIGINT[])[(xor(c, b) & 255) + 1])"
    # A list made of a null one would hold the first value alone.
    return f"CASE WHEN {text} IS NOT NULL THEN xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), {step}), 4294967295) END"


def op7_feistel() -> str:
    prime, walk = sharding._PRIME, "left_half * b + right_half"
    halves = "SELECT {} FROM ({})"
    step = "SELECT n, a, b, row_number, p // b AS left_half, p % b AS right_half FROM {}"
    for i, (x, y, z) in enumerate(sharding.round_keys(7)):
        of = "left_half" if i % 2 else "right_half"
        mixed = f"((({of} + {x}) % {prime}) * (({of} + {x}) % {prime}) % {prime} * {y} + {z}) % {prime}"
        left, right = ("left_half", f"(right_half + {mixed}) % b") if i % 2 else (f"(left_half + {mixed}) % a", "right_half")
        step = halves.format(f"n, a, b, row_number, {left} AS left_half, {right} AS right_half", step)
    step = f"SELECT n, a, b, row_number, {walk} AS p FROM ({step})"
    return f"""
    WITH RECURSIVE sized AS MATERIALIZED (
      SELECT doc_id, CAST(coalesce(strlen(text), 0) + 8 AS BIGINT) AS size, {_crc32("text")} AS text_crc32 FROM documents),
    numbered AS MATERIALIZED (
      SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS row_number, count(*) OVER () AS n FROM sized),
    sides AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM numbered),
    grid AS (SELECT row_number, n, a, (n + a - 1) // a AS b, row_number AS p FROM sides),
    walks AS ({step.format("grid")} UNION ALL {step.format("walks WHERE p >= n")})
    SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % 24 AS INTEGER) AS shard, p // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM numbered JOIN walks USING (row_number) WHERE p < walks.n"""


# Runs of three: enough levels for over half a million documents of a source, and as many sources.
LEVELS = 12


def _climb(tree: str, leaves: str) -> str:
    """The levels over (tree, idx, digest, n) nodes, and of every level what stands beside each node in its run."""
    out = [f"{tree}0 AS MATERIALIZED ({leaves})"]
    for k in range(LEVELS):
        beside = "string_agg(digest, '') OVER (PARTITION BY tree, idx // 3 ORDER BY idx ROWS BETWEEN {} AND {})"
        before, after = beside.format("UNBOUNDED PRECEDING", "1 PRECEDING"), beside.format("1 FOLLOWING", "UNBOUNDED FOLLOWING")
        out.append(f"{tree}_beside{k} AS MATERIALIZED (SELECT tree, idx, n, coalesce({before}, '') AS l, coalesce({after}, '') AS r FROM {tree}{k})")
        up = "CASE WHEN n = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END"
        out.append(f"{tree}{k + 1} AS MATERIALIZED (SELECT tree, idx // 3 AS idx, {up} AS digest, (n + 2) // 3 AS n FROM {tree}{k} GROUP BY tree, idx // 3, n)")
    return ",\n    ".join(out)


def _folds(tree: str, start: str) -> str:
    """Of every (id, tree, idx, now, proof) row the digest folded up its tree, and the siblings met."""
    out = [f"{tree}_fold0 AS MATERIALIZED ({start})"]
    for k in range(LEVELS):
        out.append(
            f"{tree}_fold{k + 1} AS MATERIALIZED (SELECT id, f.tree, f.idx // 3 AS idx, CASE WHEN n = 1 THEN now ELSE sha256(l || now || r) END AS now, proof || l || r AS proof "
            f"FROM {tree}_fold{k} f JOIN {tree}_beside{k} b ON b.tree = f.tree AND b.idx = f.idx)"
        )
    return ",\n    ".join(out)


def op11_merkle() -> str:
    def leaf(text: str) -> str:
        values = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in merkle_manifest.FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    changed = f"text IS NOT NULL AND doc_id IS NOT NULL AND {_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0"
    top = f"source{LEVELS}"
    return f"""
    WITH made AS MATERIALIZED (
      SELECT row_number() OVER () AS id, doc_id, source, {leaf("text")} AS leaf, CASE WHEN {changed} THEN {leaf("replace(text, chr(10), '')")} END AS tampered
      FROM documents),
    rows AS MATERIALIZED (
      SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS idx,
        count(*) OVER (PARTITION BY source) AS n
      FROM made),
    {_climb("source", "SELECT tree, idx, leaf AS digest, n FROM rows")},
    {_climb("top", f"SELECT 0 AS tree, tree AS idx, digest, count(*) OVER () AS n FROM {top}")},
    {_folds("source", "SELECT id, tree, idx, coalesce(tampered, leaf) AS now, '' AS proof FROM rows")},
    {_folds("top", f"SELECT id, 0 AS tree, tree AS idx, now, proof FROM source_fold{LEVELS}")}
    SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = t.digest AS verified
    FROM rows JOIN {top} s ON s.tree = rows.tree JOIN top_fold{LEVELS} f ON f.id = rows.id, top{LEVELS} t"""


ORACLE_SQL = {f.__name__: f() for f in (op1_secrets, op4_mixing, op7_feistel, op10_licenses, op11_merkle)}
