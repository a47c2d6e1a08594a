"""SQL that DuckDB runs on the same tables, for the operators that SQL can express."""

from __future__ import annotations

#: Written out here, not taken from the operators; the word list is a fixed value.
STOP_WORDS = (
    "the of and to in a is that for on with as by at from or are was be this "
    "de la le les et des en un une du est que pour dans sur au pas qui par "
    "der die und das den von zu mit sich auf für ist im dem nicht ein eine als "
    "el los las y del se por con una su para es al lo como más"
)


def listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


STOPS = STOP_WORDS.split()
SPELT = listed(sorted({*STOPS, *(w[:1].upper() + w[1:] for w in STOPS)}))

QUALITY_ROWS = f"""
q_words AS (
  SELECT row_number() OVER () AS rid, *,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
q_windows AS (
  SELECT rid, i, words[i:i + 4] AS w FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM q_words)),
q_repeated AS (
  SELECT rid, i FROM q_windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1),
q_covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM q_repeated, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
q_measured AS (
  SELECT q_words.*, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    len(list_filter(words, lambda w: w IN ({SPELT}))) AS n_stops,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM q_words LEFT JOIN q_covered USING (rid)),
q_judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM q_measured),
q_kept AS (
  SELECT *, NOT base_failed AND word_chars::DOUBLE / greatest(n_words, 1) BETWEEN 2 AND 14
    AND n_symbols::DOUBLE / greatest(n_words, 1) <= 0.3
    AND n_words::DOUBLE / (n_stops + 1) <= 60
    AND n_dup_lines::DOUBLE / greatest(n_lines, 1) <= 0.5 AS kept
  FROM q_judged)
"""

ASSIGN = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"


def scanned(kind: int, pattern: str, value: str, passes: str) -> str:
    """Spans of one pattern: places are running lengths of the matches and of what lies between."""
    return f"""
  SELECT rid, start, {kind} AS kind, start + length(m) AS stop, {value} AS value FROM (
    SELECT rid, m, sum(length(gap) + coalesce(length(before), 0)) OVER (PARTITION BY rid ORDER BY i) AS start FROM (
      SELECT rid, i, ms[i] AS m, ms[i - 1] AS before, gaps[i] AS gap FROM (
        SELECT rid, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (
          SELECT rid, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gaps
          FROM s_docs))))
  WHERE {passes}"""


SECRETS = f"""
WITH s_docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS owner,
    concat_ws('/', source, lang) AS repository
  FROM documents),
s_base AS (
{scanned(0, ASSIGN, f"regexp_extract(m, '{ASSIGN}', 2)", f"length(regexp_extract(m, '{ASSIGN}', 2)) >= 6")}
  UNION ALL
{scanned(1, "AKIA[A-Z0-9]+", "m", "length(m) >= 20")}
  UNION ALL
{scanned(2, "[0-9a-f]+", "m", "length(m) >= 24")}),
s_bare AS (
{scanned(3, "[A-Za-z0-9+/_-]{20,}", "m", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')")}),
s_all AS (
  SELECT * FROM s_base
  UNION ALL
  SELECT * FROM s_bare r WHERE NOT EXISTS (
    SELECT 1 FROM s_base b WHERE b.rid = r.rid AND b.start < r.stop AND r.start < b.stop)),
s_owners AS (
  SELECT value, count(DISTINCT owner) AS n, count(DISTINCT repository) AS places,
    length(value) >= 12 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS live
  FROM s_all JOIN s_docs USING (rid) GROUP BY value),
s_judged AS (
  SELECT s_all.*, places, CASE WHEN n >= 3 OR places >= 4 THEN 'example' WHEN n = 1 AND live THEN 'live' ELSE 'shared' END AS verdict,
    ['assign', 'access', 'hex', 'bare'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS said
  FROM s_all JOIN s_owners USING (value)),
s_totals AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex,
    string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3 OR verdict = 'live') AS spans,
    count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example,
    max(places) AS most_repositories
  FROM s_judged GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(most_repositories, 0) AS most_repositories
FROM s_docs LEFT JOIN s_totals USING (rid)
"""


def inverted(share: str, schedule: tuple[tuple[float, float], ...]) -> str:
    """Training time at which the integral of a piecewise linear weight reaches ``share``."""
    steps = list(zip(schedule, schedule[1:], strict=False))
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in steps)
    cases, done = [], 0.0
    for (t0, w0), (t1, w1) in steps:
        height, slope = w0 / area, (w1 - w0) / (t1 - t0) / area
        part = (t1 - t0) * (w0 + w1) / 2 / area
        rest = f"greatest({share} - {done!r}::DOUBLE, 0::DOUBLE)"
        root = f"sqrt(greatest({height * height!r}::DOUBLE + {2.0 * slope!r}::DOUBLE * {rest}, 0::DOUBLE))"
        cases.append((done + part, f"{t0!r}::DOUBLE + 2 * {rest} / ({height!r}::DOUBLE + {root})"))
        done += part
    whens = " ".join(f"WHEN {share} < {end!r}::DOUBLE THEN {time}" for end, time in cases[:-1])
    return f"CASE {whens} ELSE {cases[-1][1]} END" if whens else cases[-1][1]


CURRICULA = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
    ((0.0, 1.5), (0.75, 0.5), (1.0, 0.5)),
)

MIXING = f"""
WITH m_docs AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
m_sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM m_docs GROUP BY source),
m_weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn,
    [3, 1, 2][(turn % 3) + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap,
    1.5::DOUBLE * sum(source_size) OVER () AS everything
  FROM m_sources),
m_levels AS (
  SELECT *, (everything - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
    sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM m_weighed),
m_targets AS (SELECT *, least(cap, max(level) OVER () * weight) AS target FROM m_levels),
m_placed AS (
  SELECT d.*, source_size, target, turn, floor(target + 0.5)::BIGINT AS words,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h % 4096, h, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM m_docs d JOIN m_targets t ON d.source IS NOT DISTINCT FROM t.source),
m_taken AS (
  SELECT *, greatest(0, least(size, words - place)) AS first, greatest(0, least(size, words - place - source_size)) AS again,
    place / target AS share
  FROM m_placed)
SELECT doc_id, size, source_size, target, (first + again)::BIGINT AS taken,
  CASE WHEN first > 0 THEN CASE turn % 3 WHEN 0 THEN {inverted("share", CURRICULA[0])}
    WHEN 1 THEN {inverted("share", CURRICULA[1])} ELSE {inverted("share", CURRICULA[2])} END END AS position
FROM m_taken
"""



def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


NUMBER_AFTER_CUE = (
    f"\\b({'|'.join(map(any_case, ('iban', 'account', 'acct', 'passport', 'ssn')))})"
    f"(\\x20?({'|'.join(map(any_case, ('number', 'no', 'nr')))}))?[.:#=]{{0,2}}\\x20{{0,2}}"
    "([A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){2,7}(?:\\x20?[A-Z0-9]{1,3})?|[0-9](?:-?[0-9])+)"
)
LOGIN = (
    f"({any_case('http')}[Ss]?|[Ss]?{any_case('ftp')}|{any_case('ssh')})"
    "://[A-Za-z0-9._~%!$&''()*+,;=:-]+@[A-Za-z0-9.-]+(:[0-9]+)?"
)
DIGITS_OF = "regexp_replace({}, '[^0-9]', '', 'g')"
LUHN = """list_sum(list_transform(range(1, length(d) + 1), lambda i:
    CASE WHEN (length(d) - i) % 2 = 0 THEN d[i]::BIGINT
      ELSE 2 * d[i]::BIGINT - CASE WHEN d[i]::BIGINT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
#: An IBAN's remainder by 97, digit by digit, with letters as two digits.
REMAINDER = """list_reduce(list_concat([0::BIGINT], list_transform(string_split(b[5:] || b[:4], ''), lambda c:
    CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
    lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97)"""

PERSONAL = f"""
WITH s_docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
p_found AS (
{scanned(0, "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", "m", "true")}
  UNION ALL
{scanned(1, "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)", "m",
    "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR ('0' || right(x, 3))::BIGINT > 255)) = 0")}
  UNION ALL
  SELECT rid, start, kind, stop, value FROM (SELECT *, {DIGITS_OF.format("value")} AS d FROM (
{scanned(2, "[0-9]([\\x20-]?[0-9])+", "m", "true")})) WHERE length(d) BETWEEN 16 AND 19 AND {LUHN}
  UNION ALL
{scanned(3, "\\+[0-9][\\x20().0-9-]+[0-9]", "m", f"length({DIGITS_OF.format('m')}) BETWEEN 8 AND 15")}
  UNION ALL
{scanned(4, LOGIN, "m", "true")}
  UNION ALL
  SELECT rid, stop - length(value) AS start, kind, stop, value FROM (
    SELECT *, replace(value, ' ', '') AS b, {DIGITS_OF.format("value")} AS d FROM (
{scanned(5, NUMBER_AFTER_CUE, f"regexp_extract(m, '{NUMBER_AFTER_CUE}', 4)", "true")}))
  WHERE CASE WHEN value BETWEEN 'A' AND 'Z~' THEN length(b) BETWEEN 15 AND 34 AND {REMAINDER} = 1
    ELSE length(d) BETWEEN 6 AND 20 END),
p_said AS (
  SELECT *, ['email', 'ip', 'card', 'phone', 'url', 'account'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS said
  FROM p_found),
p_totals AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip,
    count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
    string_agg(said, ',' ORDER BY kind, start) FILTER (kind < 4) AS base,
    string_agg(said, ',' ORDER BY kind, start) AS spans
  FROM p_said GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM s_docs LEFT JOIN p_totals USING (rid)
"""

NEGATIVES = """
WITH n_rows AS (
  SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n_pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CASE WHEN len(a.q) = 0 THEN 0 ELSE list_dot_product(a.q, r.q) END::BIGINT AS score
  FROM n_rows a JOIN n_rows r ON len(a.q) = len(r.q) AND a.vec_id % 100 = 0),
n_positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM n_pairs WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM n_positives JOIN n_pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def cheapest(*choices: str) -> str:
    return f"list_sort(list_filter([{', '.join(choices)}], lambda x: x IS NOT NULL))[1]"


def edited(letter: str, cost: str, state: int, line: str, when: str = "true") -> str:
    rest = f"s[{state + 1}]"
    return (
        f"CASE WHEN {when} THEN struct_pack(c := ({rest}.c + {cost})::BIGINT, a := '{letter}' || {rest}.a,"
        f" r := {line} || {rest}.r) END"
    )


def consumed(state: int) -> str:
    """The cheapest way to use up a row in one of the states: nothing yet, after system, user, assistant."""
    after = 3 if state == 2 else 2
    name = "assistant" if after == 3 else "user"
    own = "role || ':' || text || chr(10)"
    kept = edited("K", "extra", after, own, f"NOT gone AND initial = '{name[0]}'")
    system = [edited("K", "extra", 1, own, "NOT gone AND initial = 's'")] if state == 0 else []
    given = edited("R", "1 + extra", after, f"'{name}:' || text || chr(10)", "NOT gone")
    return cheapest(edited("D", "2", state, "''"), kept, *system, given)


def inserted(name: str, behind: str) -> str:
    return f"struct_pack(c := ({behind}.c + 5)::BIGINT, a := 'I' || {behind}.a, r := '{name}:' || chr(10) || {behind}.r)"


REPAIR = f"""
WITH RECURSIVE
c_bytes AS (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)),
c_table AS (SELECT list(v ORDER BY i) AS t FROM c_bytes),
c_keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS key
  FROM conversations),
c_hit AS (
  SELECT * EXCLUDE (key, t), xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], key), lambda c, b:
    xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS hit
  FROM c_keyed, c_table),
c_damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM c_hit WHERE hit <> 0),
c_placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || ':' || text), copy) AS pos
  FROM c_damaged),
c_rows AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^ 	-
]') AS blank,
    NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate,
    NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?][ 	-
]*$') AS truncated,
    blank OR duplicate AS gone, CASE WHEN truncated THEN 5 ELSE 0 END AS extra,
    pos > 1 AND lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM c_placed),
c_back AS (
  SELECT conv_id, max(pos) + 1 AS pos, [
    struct_pack(c := 0::BIGINT, a := '', r := ''), struct_pack(c := 10::BIGINT, a := 'II', r := 'user:' || chr(10) || 'assistant:' || chr(10)),
    struct_pack(c := 5::BIGINT, a := 'I', r := 'assistant:' || chr(10)), struct_pack(c := 0::BIGINT, a := '', r := '')] AS s
  FROM c_rows GROUP BY conv_id
  UNION ALL
  SELECT conv_id, pos, [{cheapest("m0", inserted("user", "w2"))}, {cheapest("m1", inserted("user", "w2"))}, w2,
    {cheapest("m3", inserted("user", "m2"))}] AS s
  FROM (SELECT *, {cheapest("m2", inserted("assistant", "m3"))} AS w2 FROM (
    SELECT r.conv_id, r.pos, {consumed(0)} AS m0, {consumed(1)} AS m1, {consumed(2)} AS m2, {consumed(3)} AS m3
    FROM c_back b JOIN c_rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.pos = b.pos - 1))),
c_counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM c_rows GROUP BY conv_id)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s[1].c, 0) AS cost, coalesce(s[1].a, '') AS audit,
  sha256(coalesce(CASE WHEN s[1].r <> '' THEN left(s[1].r, length(s[1].r) - 1) ELSE '' END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN c_counts n ON n.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN c_back b ON b.conv_id IS NOT DISTINCT FROM k.conv_id AND b.pos = 1
"""

ORACLE = {
    "op4_secret_scans": SECRETS,
    "op13_conversation_repair": REPAIR,
    "op12_hard_negatives": NEGATIVES,
    "op11_personal_data": PERSONAL,
    "op8_mixing": MIXING,
    "op7_quality_rules": f"""
WITH {QUALITY_ROWS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM q_kept
""",
}
