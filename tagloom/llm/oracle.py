"""SQL of the queries that SQL can express, for DuckDB."""

# Levels and margins of the quality rules, as in `quality.RULES`.
_LEVELS = {"word_length": (100, 900, 6), "symbols": (0, 900, 16), "dup_lines": (0, 998, 4), "repeats": (0, 998, 4)}
_PRIOR = 200


def _level(place: int) -> str:
    return "CASE m " + " ".join(f"WHEN '{m}' THEN {rule[place]}" for m, rule in _LEVELS.items()) + " END"


def _start(bucket: str) -> str:
    shift = f"greatest(({bucket}) // 32 - 1, 0)"
    return f"((({bucket}) - 32 * {shift}) << {shift})"


def _drawn(own: str, wider: str) -> str:
    sides = (f"CAST(({own}.{s} * {own}.n + {wider}.{s} * {_PRIOR}) // ({own}.n + {_PRIOR}) AS BIGINT) AS {s}"
             for s in ("low", "high"))
    return ", ".join(sides)



QUALITY_ROWS = r"""
base AS (SELECT row_number() OVER () AS r, *, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM base),
win AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g
        FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least(5, coalesce(nx - i, 5))) AS c
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM dup) GROUP BY r),
counted AS (SELECT w.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
      CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
      CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
      CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov ON w.r = cov.r),
rated AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
      word_chars * 1000 // greatest(n_words, 1) AS word_length,
      n_symbols * 1000 // greatest(word_chars, 1) AS symbols,
      n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_lines,
      n_repeat_words * 1000 // greatest(n_words, 1) AS repeats FROM counted),
long AS (SELECT r, lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS m,
      unnest([word_length, symbols, dup_lines, repeats]) AS v FROM rated WHERE NOT base_failed),
cut AS (SELECT *, CASE WHEN v < 64 THEN 0 ELSE length(bin(v)) - 6 END AS s FROM long),
cells AS (SELECT lang, source, m, CAST(32 * s + (v >> s) AS BIGINT) AS b, count(*) AS n FROM cut GROUP BY ALL),
levels AS (SELECT 0 AS lvl, lang, source, m, b, n FROM cells
      UNION ALL SELECT 1, lang, NULL, m, b, sum(n) FROM cells GROUP BY ALL
      UNION ALL SELECT 2, NULL, NULL, m, b, sum(n) FROM cells GROUP BY ALL),
run AS (SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, m ORDER BY b) AS upto,
      sum(n) OVER (PARTITION BY lvl, lang, source, m) AS total FROM levels),
q AS (SELECT lvl, lang, source, m, max(total) AS n, min(b) FILTER (upto * 1000 >= total * LOWER) AS lower_b,
      min(b) FILTER (upto * 1000 >= total * UPPER) AS upper_b FROM run GROUP BY ALL),
own AS (SELECT lvl, lang, source, m, n, LOW AS low, HIGH AS high
      FROM (SELECT *, greatest(lower_b - MARGIN, 0) AS from_b, upper_b + MARGIN AS to_b FROM q)),
wide AS (SELECT * FROM own WHERE lvl = 2),
lang_lim AS (SELECT o.lang, o.m, DRAWN_LANG FROM own o JOIN wide w ON o.m = w.m WHERE o.lvl = 1),
lim AS (SELECT o.lang, o.source, o.m, DRAWN_OWN FROM own o JOIN lang_lim w
      ON o.m = w.m AND o.lang IS NOT DISTINCT FROM w.lang WHERE o.lvl = 0),
best AS (SELECT l.r, l.m, l.v, low, high FROM long l JOIN lim ON lim.m = l.m
      AND lim.lang IS NOT DISTINCT FROM l.lang AND lim.source IS NOT DISTINCT FROM l.source),
verdict AS (SELECT r, bool_and(v <= high AND (m <> 'word_length' OR v >= low)) AS ok FROM best GROUP BY r),
judged AS (SELECT rated.*, NOT base_failed AND coalesce(ok, false) AS kept
      FROM rated LEFT JOIN verdict ON rated.r = verdict.r)
"""
for _name, _text in {"LOWER": _level(0), "UPPER": _level(1), "MARGIN": _level(2), "LOW ": _start("from_b") + " ",
                     "HIGH ": _start("to_b") + " ", "DRAWN_LANG": _drawn("o", "w"),
                     "DRAWN_OWN": _drawn("o", "w")}.items():
    QUALITY_ROWS = QUALITY_ROWS.replace(_name, _text)

# The lengths of the marks `<|turn|>`, `<|repeat|>` and of `<|end|>` with a line end are 8, 10 and 8.
_ESCAPED = (r"regexp_replace(replace({0}, '\', '\\'), '(<)(\||/?s>)|(\[)(/?INST\])', "
            r"'\1\3\\\2\4', 'g')")
CHAT_ROWS = rf"""
c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
      len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]')) + 4 AS tokens,
      length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 8 AS body FROM c),
s AS (SELECT *, pos = 1 AND role = 'system' AS sys,
      first_value(CASE WHEN role = 'system' THEN tokens END) OVER w AS sys_tokens,
      first_value(CASE WHEN role = 'system' THEN body END) OVER w AS sys_body
      FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
u AS (SELECT *, CASE WHEN sys THEN 0 ELSE tokens END AS own,
      sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY pos) AS upto,
      greatest(512 - coalesce(sys_tokens, 0) - 128, 128) AS cell FROM s),
p AS (SELECT *, upto - own AS before, CASE WHEN sys THEN 0
      WHEN (upto - own) // cell = (upto - 1) // cell THEN 2 * ((upto - own) // cell)
      ELSE 2 * ((upto - own) // cell) + 1 END AS span FROM u),
o AS (SELECT *, span IS DISTINCT FROM lag(span) OVER (PARTITION BY conv_id ORDER BY pos) AS opens FROM p),
again AS (SELECT a.conv_id, sum(10 + a.body) AS chars FROM o a JOIN o b
      ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 2
      AND b.opens AND b.before - a.before <= 128 AND NOT a.sys GROUP BY a.conv_id),
whole AS (SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
      coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS learned,
      sum(8 + body) + coalesce(count(DISTINCT span) FILTER (span > 0) * (10 + any_value(sys_body)), 0)
      AS chars FROM o GROUP BY conv_id)
"""

# Twenty bits of the hexadecimal digest are four characters in base 32.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER))
     & 31) + 1, 1)), '')"""

def _clusters(k: int = 16, rounds: int = 3) -> str:
    """Centroids as lists of longs, moved `rounds` times; all arithmetic is on integers."""
    steps, nearest = [], """
{name} AS (SELECT r, vec_id, x, cluster, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY distance, cluster) AS place FROM (
        SELECT r, vec_id, x, c.cluster, list_sum(list_transform(
            list_zip(x, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
        FROM kept, {centroids} c)) WHERE place = 1)"""
    for i in range(rounds + 1):
        steps.append(nearest.format(name=f"near{i}", centroids=f"centroids{i}"))
        if i < rounds:
            steps.append(f"""
sums{i} AS (SELECT cluster, d, sum(v) AS s, count(*) AS n
    FROM (SELECT cluster, unnest(x) AS v, unnest(range(len(x))) AS d FROM near{i}) GROUP BY ALL),
moved{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS m
    FROM sums{i} GROUP BY cluster),
centroids{i + 1} AS (SELECT c.cluster, coalesce(w.m, c.m) AS m
    FROM centroids{i} c LEFT JOIN moved{i} w ON c.cluster = w.cluster)""")
    return f"""WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: isfinite(c))) = 64),
centroids0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x)
                           - 1 AS INTEGER) AS cluster, x AS m
    FROM kept ORDER BY cluster LIMIT {k}),{",".join(steps)}
SELECT vec_id, n.cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM near{rounds} n JOIN centroids{rounds} c ON n.cluster = c.cluster"""


ORACLES: dict[str, str] = {
    "op10_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM p),
o AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS original FROM d)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to FROM o""",
    "op9_chat": f"""WITH {CHAT_ROWS}
SELECT whole.conv_id, n_turns, turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256,
       CAST(whole.chars + coalesce(again.chars, 0) AS BIGINT) AS formatted_chars
FROM whole LEFT JOIN again ON whole.conv_id IS NOT DISTINCT FROM again.conv_id""",
    "op3_quality": f"""WITH {QUALITY_ROWS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM judged""",
    "op11_centroids": _clusters(),
}
