"""The same results as DuckDB SQL, written from the definitions rather than from the plans.

Models are scored term by term and class by class over full cross products, with none of
the rearrangement that the Spark side uses.
"""

from __future__ import annotations

from ..functions.wordlists import (
    COMMON_CONTRACTIONS,
    MOJIBAKE_QUOTE,
    PUNCTUATION,
    STOP_WORDS,
)
from .queries import BREAK_MARKS, COMMA_MARKS, STOP_MARKS

NUM_FEATURES = 25_000

# Fixed values, written out once more so that a wrong pattern on the Spark side shows: white space,
# word characters, a leading digit, and the emoticon rules in their order.
SP = r"\x09-\x0D\x1C-\x20\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
GOOD, BAD = " positiveemoji ", " negetiveemoji "
EMOTICONS = (
    (rf":[{SP}]?\)|:-\)|\([{SP}]?:|\(-:|:'\)|:O", GOOD),
    (rf":[{SP}]?D|:-D|[xX]-?D", GOOD),
    (r"<3|:\*", GOOD),
    (r";-?\)|;-?D|\(-?;|@-\)", GOOD),
    (rf":[{SP}]?\(|:-\(|\)[{SP}]?:|\)-:|:-/|:-\|", BAD),
    (r""":,\(|:'\(|:"\(""", BAD),
)


def q(text: str) -> str:
    """A SQL string literal; line breaks are spelled by chr(10)."""
    parts = ["'" + part.replace("'", "''") + "'" for part in text.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")" if len(parts) > 1 else parts[0]


def with_(*ctes: str, then: str) -> str:
    """One WITH list from comma-joined CTE groups."""
    return "WITH " + ",\n".join(ctes) + "\n" + then


def hash32(expr: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8) AS BIGINT)"


SPLIT = f"CASE WHEN {hash32('doc_id')} % 10 < 7 THEN 'train' ELSE 'test' END"
SENTIMENT = (
    "CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END"
)
LABEL = "CASE sentiment WHEN 'negative' THEN 0 WHEN 'positive' THEN 2 ELSE 1 END"

LABELLED = f"""labelled AS (
  SELECT doc_id, text, {SENTIMENT} AS sentiment FROM documents JOIN labels USING (doc_id))"""

TWEETS = f"""texts AS (
  SELECT doc_id, replace(replace(replace(text, ', ', {q(COMMA_MARKS)}), '. ', {q(STOP_MARKS)}),
    chr(10), {q(BREAK_MARKS)}) AS text FROM documents WHERE text IS NOT NULL)"""
TEXTS = "texts AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL)"

# -- token cleaning --------------------------------------------------------------------

JSPACE = r"[ \t\n\x0B\f\r]"
STOP_LIST = ", ".join(q(w) for w in STOP_WORDS)

RAW = f"""listed AS (
  SELECT doc_id, string_split_regex(lower(text), '{JSPACE}') AS t FROM texts),
raw AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM listed)"""


def joined(source: str, column: str) -> str:
    """Words back to one line per document, documents without words included."""
    return f"""SELECT doc_id, coalesce(result, '') AS result FROM texts LEFT JOIN (
  SELECT doc_id, string_agg({column}, ' ' ORDER BY i) AS result FROM {source}
  WHERE {column} <> '' GROUP BY doc_id) USING (doc_id)"""


PLACED = r"""placed AS (
  SELECT doc_id, i, CASE WHEN contains(w, '@') THEN 'AT_USER'
    WHEN regexp_matches(w, 'www\.|https?://') THEN 'URL' ELSE w END AS w FROM raw)"""


def squeezed(source: str) -> str:
    # For a word with a triple: again and again find the leftmost run of three or more, using
    # a pattern made of the word's own letters, and cut that string everywhere in the word.
    return f"""letters AS (
  SELECT w, string_split(w, '') AS c FROM (SELECT DISTINCT w FROM {source})),
triples AS (
  SELECT w, c, len(list_filter(c, lambda x, i: x = c[i + 1] AND x = c[i + 2])) AS n FROM letters),
cuts AS (
  SELECT w, list_reduce(list_prepend(w, list_transform(range(n), lambda j: pattern)),
    lambda acc, p: replace(acc, regexp_extract(acc, p), left(regexp_extract(acc, p), 1))) AS z
  FROM (SELECT w, n, array_to_string(list_transform(list_distinct(c),
    lambda x: regexp_escape(x) || '{{3,}}'), '|') AS pattern FROM triples WHERE n > 0)),
squeezed AS (
  SELECT doc_id, i, coalesce(z, w) AS w FROM {source} LEFT JOIN cuts USING (w))"""


CLEANED = f"""numbered AS (
  SELECT doc_id, i, CASE WHEN regexp_matches(w, '^{DIGIT}') THEN '' ELSE w END AS w FROM squeezed),
cleaned AS (
  SELECT doc_id, i, w FROM (SELECT doc_id, i, trim(w, {q(PUNCTUATION)}) AS w FROM numbered
    WHERE w NOT IN ({STOP_LIST})) WHERE w <> '')"""
CLEAN_CHAIN = ",\n".join([RAW, PLACED, squeezed("placed"), CLEANED])

# -- string cleaning -------------------------------------------------------------------


def basic(x: str) -> str:
    x = f"regexp_replace(lower({x}), '@[^{SP}]+', '', 'g')"
    x = rf"regexp_replace({x}, '(www\.[^{SP}]+)|(https?://[^{SP}]+)', ' ', 'g')"
    x = rf"regexp_replace({x}, '\p{{Nd}}+', ' ', 'g')"
    return f"replace({x}, '&quot;', ' ')"


def emoticons(x: str) -> str:
    for pattern, marker in EMOTICONS:
        x = f"regexp_replace({x}, {q(pattern)}, '{marker}', 'g')"
    return x


def single_letters(x: str) -> str:
    # The boundaries are part of the match, so neighbours need a second pass.
    for _ in range(2):
        x = rf"regexp_replace({x}, '(^|[^{WORD}])[a-zA-Z]($|[^{WORD}])', '\1\2', 'g')"
    return x


KEYS = "[" + ", ".join(q(k) for k in COMMON_CONTRACTIONS) + "]"
PAIRS = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in COMMON_CONTRACTIONS.items()) + "}"


def contractions(x: str) -> str:
    words = f"list_filter(string_split_regex({x}, '[{SP}]+'), lambda w: list_contains({KEYS}, lower(w)))"
    return f"list_reduce(list_prepend({x}, {words}), lambda acc, w: replace(acc, w, {PAIRS}[lower(w)]))"


def punctuation(x: str) -> str:
    return f"regexp_replace({x}, '[^{WORD}{SP}]', ' ', 'g')"


def two(letters: str) -> str:
    """From a list column of letters."""
    return f"""array_to_string(list_filter({letters}, lambda x, i: NOT coalesce(
      i > 2 AND x = {letters}[i - 1] AND x = {letters}[i - 2] AND x <> chr(10), false)), '')"""


def normal_chain(source: str, keep: str) -> str:
    return f"""n1 AS (SELECT {keep}, {single_letters(emoticons(basic('text')))} AS x FROM {source}),
n2 AS (SELECT {keep}, {contractions('x')} AS x FROM n1),
n3 AS (SELECT {keep}, string_split({punctuation('x')}, '') AS c FROM n2),
normal AS (SELECT {keep}, regexp_replace({two('c')}, '[{SP}]+', ' ', 'g') AS x FROM n3)"""


# -- features --------------------------------------------------------------------------


def word_entries(source: str, column: str, keep: str, pairs: bool = True) -> str:
    both = (
        "list_concat(u, list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1]))"
        if pairs
        else "u"
    )
    return rf"""words AS (
  SELECT {keep}, regexp_extract_all(lower({column}), '[{WORD}]{{2,}}') AS u FROM {source}),
ent AS (
  SELECT {keep}, term, count(*) AS tf FROM (SELECT {keep}, unnest({both}) AS term FROM words)
  GROUP BY {keep}, term)"""


V_DOCS = f"""docs AS (
  SELECT doc_id, text, {LABEL} AS label, {SPLIT} AS split FROM labelled WHERE text IS NOT NULL)"""
V_ENT = ",\n".join(
    [
        LABELLED,
        V_DOCS,
        normal_chain("docs", "doc_id, label, split"),
        word_entries("normal", "x", "doc_id, label, split"),
    ]
)

H_DOCS = f"""docs AS (
  SELECT doc_id, text, {LABEL} AS label, {SPLIT} AS split FROM (
    SELECT min(doc_id) AS doc_id, sentiment, text FROM labelled
    WHERE text IS NOT NULL AND sentiment IN ('negative', 'neutral', 'positive')
    GROUP BY sentiment, text)),
texts AS (SELECT doc_id, text FROM docs)"""
H_ENT = ",\n".join(
    [
        LABELLED,
        H_DOCS,
        CLEAN_CHAIN,
        f"""ent AS (
  SELECT doc_id, label, split, {hash32('w')} % {NUM_FEATURES} AS term, count(*) AS tf
  FROM cleaned JOIN docs USING (doc_id) GROUP BY doc_id, label, split, term)""",
    ]
)



def low32(expr: str) -> str:
    return f"(({expr}) & 4294967295)"


def turned(name: str, bits: int) -> str:
    """A 32-bit number turned to the left."""
    return low32(f"({name} << {bits}) | ({name} >> {32 - bits})")


def mixed(blocks: str) -> str:
    """The multiply, turn, multiply step on every 32-bit block of a list."""
    first = f"list_transform({blocks}, lambda k: {low32('k * 3432918353')})"
    second = f"list_transform({first}, lambda k: {turned('k', 15)})"
    return f"list_transform({second}, lambda k: {low32('k * 461845907')})"


def little_endian(start: str, n_bytes: str) -> str:
    """The number in some bytes of the hex string ``x``."""
    digits = f"list_transform(range({n_bytes}), lambda j: substr(x, 2 * ({start} + {n_bytes} - 1 - j) + 1, 2))"
    return f"CAST('0x0' || array_to_string({digits}, '') AS UBIGINT)"


# Murmur3 with seed 42 over the UTF-8 bytes of a word, from its definition.
MURMUR = f"""bytes AS (
  SELECT w, x, length(x) // 2 AS n FROM (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM cleaned))),
blocks AS (
  SELECT w, n, list_transform(range(n // 4), lambda i: {little_endian("4 * i", "4")}) AS whole,
    [{little_endian("(n // 4 * 4)", "(n % 4)")}] AS rest FROM bytes),
body AS (
  SELECT w, n, list_reduce(list_prepend(42::UBIGINT, {mixed("whole")}),
      lambda h, k: {low32(turned("xor(h, k)", 13) + " * 5 + 3864292196")}) AS h, ({mixed("rest")})[1] AS tail
  FROM blocks),
closed AS (SELECT w, xor(xor(h, tail), n::UBIGINT) AS h FROM body),
once AS (SELECT w, {low32("xor(h, h >> 16) * 2246822507")} AS h FROM closed),
twice AS (SELECT w, {low32("xor(h, h >> 13) * 3266489909")} AS h FROM once),
murmur AS (
  SELECT w, CASE WHEN h >= 2147483648 THEN h::BIGINT - 4294967296 ELSE h::BIGINT END AS h
  FROM (SELECT w, xor(h, h >> 16) AS h FROM twice))"""

X_DOCS = f"""docs AS (
  SELECT *, {SPLIT} AS split FROM (
    SELECT doc_id || '-' || copy AS doc_id, text, {LABEL} AS label
    FROM labelled CROSS JOIN (SELECT unnest(range(8)) AS copy) WHERE text IS NOT NULL)),
texts AS (SELECT doc_id, text FROM docs)"""
X_ENT = H_ENT.replace(H_DOCS, X_DOCS)

# -- models ----------------------------------------------------------------------------

CLASS_SIZES = """nc AS (SELECT label AS c, count(*) AS n FROM docs WHERE split = 'train' GROUP BY label),
total AS (SELECT sum(n) AS m, count(*) AS k FROM nc)"""

PLAIN_PRIOR = "prior AS (SELECT c, ln(n / m) AS p FROM nc, total)"
SMOOTH_PRIOR = "prior AS (SELECT c, ln((n + 1.0) / (m + k)) AS p FROM nc, total)"

VOCABULARY = "voc AS (SELECT DISTINCT term FROM ent)"


def likelihood(masses: str, size: str) -> str:
    """``theta(term, c, logp)`` for every term of voc and every class."""
    return f"""mass AS ({masses}),
z AS (SELECT nc.c, coalesce(sum(s), 0) AS z FROM nc LEFT JOIN mass USING (c) GROUP BY nc.c),
theta AS (
  SELECT voc.term, z.c, ln((coalesce(mass.s, 0) + 1.0) / (z.z + {size})) AS logp
  FROM voc CROSS JOIN z LEFT JOIN mass ON mass.term = voc.term AND mass.c = z.c)"""


COUNT_MASS = "SELECT term, label AS c, sum(tf) AS s FROM ent WHERE split = 'train' GROUP BY term, label"
COUNT_THETA = likelihood(COUNT_MASS, "(SELECT count(*) FROM voc)")

TRAIN_DF = "dft AS (SELECT term, count(*) AS df FROM ent WHERE split = 'train' GROUP BY term)"

SPARK_IDF = f"""{TRAIN_DF},
idf AS (SELECT term, ln((m + 1.0) / (coalesce(df, 0) + 1.0)) AS idf, coalesce(df, 0) AS df
  FROM voc LEFT JOIN dft USING (term), total)"""
SPARK_THETA = likelihood(
    """SELECT term, label AS c, sum(tf * idf) AS s FROM ent JOIN idf USING (term)
  WHERE split = 'train' GROUP BY term, label""",
    str(NUM_FEATURES),
)
SPARK_VALUES = "vals AS (SELECT doc_id, term, tf * idf AS v FROM ent JOIN idf USING (term))"

UNIT = f"""{TRAIN_DF},
idf AS (SELECT term, ln((m + 1.0) / (coalesce(df, 0) + 1.0)) + 1.0 AS idf
  FROM voc LEFT JOIN dft USING (term), total),
unit AS (
  SELECT doc_id, label, term,
    tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS v
  FROM ent JOIN idf USING (term) WHERE split = 'train')"""
UNIT_THETA = likelihood(
    "SELECT term, label AS c, sum(v) AS s FROM unit GROUP BY term, label",
    "(SELECT count(*) FROM voc)",
)
COUNT_VALUES = "vals AS (SELECT doc_id, term, tf AS v FROM ent)"

BERNOULLI = """seen AS (
  SELECT term, label AS c, count(*) AS df FROM ent WHERE split = 'train' GROUP BY term, label),
probs AS (
  SELECT voc.term, nc.c, (coalesce(df, 0) + 1.0) / (n + 2.0) AS p
  FROM voc CROSS JOIN nc LEFT JOIN seen ON seen.term = voc.term AND seen.c = nc.c)"""

SUMS = """sums AS (
  SELECT doc_id, c, sum(v * logp) AS s FROM vals JOIN theta USING (term) GROUP BY doc_id, c)"""
BERNOULLI_SUMS = """absent AS (SELECT c, sum(ln(1 - p)) AS a FROM probs GROUP BY c),
present AS (
  SELECT doc_id, c, sum(ln(p) - ln(1 - p)) AS s FROM ent JOIN probs USING (term) GROUP BY doc_id, c),
sums AS (SELECT doc_id, c, a + coalesce(s, 0) AS s
  FROM (SELECT doc_id, c, a FROM docs CROSS JOIN absent) LEFT JOIN present USING (doc_id, c))"""

SCORED = """scored AS (
  SELECT docs.doc_id, prior.c, p + coalesce(s, 0) AS score
  FROM docs CROSS JOIN prior LEFT JOIN sums ON sums.doc_id = docs.doc_id AND sums.c = prior.c),
best AS (
  SELECT doc_id, c AS prediction FROM scored
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, c) = 1),
predicted AS (SELECT doc_id, label, split, prediction FROM docs JOIN best USING (doc_id)),
wide AS (
  SELECT doc_id, round(max(score) FILTER (c = 0), 6) AS score_0,
    round(max(score) FILTER (c = 1), 6) AS score_1, round(max(score) FILTER (c = 2), 6) AS score_2
  FROM scored GROUP BY doc_id)"""
WIDE = """SELECT doc_id, label, split, score_0, score_1, score_2, prediction
FROM predicted JOIN wide USING (doc_id)"""

H_MODEL = ",\n".join([H_ENT, CLASS_SIZES, SMOOTH_PRIOR, VOCABULARY, SPARK_IDF, SPARK_THETA])
H_PREDICTED = ",\n".join([H_MODEL, SPARK_VALUES, SUMS, SCORED])
V_BASE = ",\n".join([V_ENT, CLASS_SIZES, PLAIN_PRIOR, VOCABULARY])
V_COUNT = ",\n".join([V_BASE, COUNT_THETA])
V_PREDICTED = ",\n".join([V_COUNT, COUNT_VALUES, SUMS, SCORED])
V_BERNOULLI = ",\n".join([V_BASE, BERNOULLI, BERNOULLI_SUMS, SCORED])
V_UNIT = ",\n".join([V_BASE, UNIT, UNIT_THETA])
V_TFIDF = ",\n".join([V_UNIT, COUNT_VALUES, SUMS, SCORED])

E_DOCS = f"""parts AS (
  SELECT doc_id, CASE WHEN r < ceil(n * 2 / 10) THEN 'test' ELSE 'train' END AS split FROM (
    SELECT doc_id, count(*) OVER () AS n, row_number() OVER (ORDER BY {hash32("'69:' || doc_id")}, doc_id) - 1 AS r
    FROM labels)),
docs AS (
  SELECT doc_id, text, {LABEL} AS label, split FROM labelled JOIN parts USING (doc_id) WHERE text IS NOT NULL)"""

R_DOCS = f"""docs AS (
  SELECT *, {SPLIT} AS split FROM (
    SELECT conv_id || '-' || turn AS doc_id, text,
      CASE role WHEN 'assistant' THEN 0 WHEN 'user' THEN 1 ELSE 2 END AS label
    FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL))"""
R_PREDICTED = ",\n".join(
    [
        R_DOCS,
        normal_chain("docs", "doc_id, label, split"),
        word_entries("normal", "x", "doc_id, label, split"),
        CLASS_SIZES,
        PLAIN_PRIOR,
        VOCABULARY,
        COUNT_THETA,
        COUNT_VALUES,
        SUMS,
        SCORED,
    ]
)


def theta_columns(key: str = "term") -> str:
    cells = ", ".join(f"round(max(logp) FILTER (c = {c}), 6) AS logp_{c}" for c in (0, 1, 2))
    return f"SELECT term AS {key}, {cells} FROM theta GROUP BY term"


FRESH = rf"""fresh_words AS (
  SELECT item_id AS doc_id, regexp_extract_all(lower(text), '[{WORD}]{{2,}}') AS u
  FROM benchmark WHERE text IS NOT NULL),
fresh AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(list_concat(u,
    list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1]))) AS term FROM fresh_words)
  GROUP BY doc_id, term)"""
FRESH_SCORED = SCORED.replace("FROM docs CROSS JOIN prior", "FROM fresh_words AS docs CROSS JOIN prior").replace(
    "predicted AS (SELECT doc_id, label, split, prediction FROM docs JOIN best USING (doc_id)),\n", ""
)
FRESH_WIDE = "SELECT doc_id, score_0, score_1, score_2, prediction FROM best JOIN wide USING (doc_id)"

SCORE_NEW = with_(
    V_UNIT,
    FRESH,
    """vals AS (
  SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS v
  FROM fresh JOIN idf USING (term))""",
    SUMS,
    FRESH_SCORED,
    then=FRESH_WIDE,
)
SCORE_NEW_COUNTS = with_(
    V_COUNT, FRESH, COUNT_VALUES.replace("FROM ent", "FROM fresh"), SUMS, FRESH_SCORED, then=FRESH_WIDE
)

# -- evaluation ------------------------------------------------------------------------

ACCURACY = """count(*) AS n_rows, count(*) FILTER (label = prediction) AS n_correct,
  round(count(*) FILTER (label = prediction) / count(*), 6) AS accuracy,
  round(100.0 * count(*) FILTER (label = prediction) / count(*), 6) AS accuracy_pct"""

CLASS_METRICS = """tested AS (SELECT * FROM predicted WHERE split = 'test'),
parts AS (
  SELECT c AS label,
    (SELECT count(*) FROM tested t WHERE t.label = c AND t.prediction = c) AS hits,
    (SELECT count(*) FROM tested t WHERE t.prediction = c) AS guessed,
    (SELECT count(*) FROM tested t WHERE t.label = c) AS support
  FROM (VALUES (0), (1), (2)) AS v(c)),
ratios AS (
  SELECT label, CASE WHEN guessed = 0 THEN 0 ELSE hits / guessed END AS p,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r, support FROM parts),
metrics AS (
  SELECT label, p, r, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f, support
  FROM ratios)"""

REPORT = """SELECT CAST(label AS VARCHAR) AS line, round(p, 6) AS precision, round(r, 6) AS recall,
  round(f, 6) AS f1, support FROM metrics
UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n
  FROM (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS a, count(*) AS n FROM tested)
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
  CAST(sum(support) AS BIGINT) FROM metrics
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
  round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM metrics"""

ODDS = """others AS (
  SELECT a.doc_id, a.c, a.score, max(b.score) AS m FROM scored a JOIN scored b ON b.doc_id = a.doc_id AND b.c <> a.c
  GROUP BY a.doc_id, a.c, a.score),
odds AS (
  SELECT o.doc_id, o.c, round(o.score - o.m - ln(sum(exp(b.score - o.m))), 6) AS x
  FROM others o JOIN scored b ON b.doc_id = o.doc_id AND b.c <> o.c GROUP BY o.doc_id, o.c, o.score, o.m)"""


def pairs_in_order(ranked: str) -> str:
    """Over all pairs of a positive and a negative row of ``(g, x, positive)``."""
    return f"""ranked AS ({ranked}),
wins AS (
  SELECT p.g, avg(CASE WHEN p.x > n.x THEN 1.0 WHEN p.x = n.x THEN 0.5 ELSE 0.0 END) AS auc
  FROM ranked p JOIN ranked n ON p.g = n.g AND p.positive AND NOT n.positive GROUP BY p.g),
sizes AS (
  SELECT g, count(*) FILTER (positive) AS n_positive, count(*) FILTER (NOT positive) AS n_negative
  FROM ranked GROUP BY g)"""


AUC_ROW = "n_positive, n_negative, round(auc, 6) AS auc FROM sizes LEFT JOIN wins USING (g)"

FOLD = f"({hash32('doc_id')} // 10)"


def cross_validated(entries: str, k: int, size: str, tfidf: bool, known: str = "") -> str:
    """Each fold's model from the rows of the other folds, over an explicit cross product.

    ``known`` joins what the scores are restricted to.
    """
    idf = "ln((m + 1.0) / (coalesce(df, 0) + 1.0))" if tfidf else "1.0"
    prior = "ln((n + 1.0) / (m + kc))" if tfidf else "ln(n / m)"
    return f"""{entries},
tdocs AS (SELECT doc_id, label, {FOLD} % {k} AS fold FROM docs WHERE split = 'train'),
tent AS (SELECT tdocs.*, term, tf FROM ent JOIN tdocs USING (doc_id)),
f AS (SELECT unnest(range({k})) AS f),
nc AS (SELECT f, label AS c, count(*) AS n FROM tdocs JOIN f ON fold <> f GROUP BY f, label),
total AS (SELECT f, sum(n) AS m, count(*) AS kc FROM nc GROUP BY f),
prior AS (SELECT f, c, {prior} AS p FROM nc JOIN total USING (f)),
dft AS (SELECT f, term, count(*) AS df FROM tent JOIN f ON fold <> f GROUP BY f, term),
idf AS (
  SELECT f, term, {idf} AS idf FROM (SELECT DISTINCT term FROM tent) CROSS JOIN total
  LEFT JOIN dft USING (f, term)),
mass AS (
  SELECT f, term, label AS c, sum(tf * idf) AS s
  FROM tent JOIN f ON fold <> f JOIN idf USING (f, term) GROUP BY f, term, label),
z AS (SELECT f, c, sum(s) AS z FROM mass GROUP BY f, c),
sums AS (
  SELECT doc_id, z.c, sum(tf * idf * ln((coalesce(s, 0) + 1.0) / (z + {size}))) AS s
  FROM tent JOIN idf ON idf.f = tent.fold AND idf.term = tent.term
  JOIN z ON z.f = tent.fold
  {known}
  LEFT JOIN mass ON mass.f = tent.fold AND mass.term = tent.term AND mass.c = z.c
  GROUP BY doc_id, z.c),
best AS (
  SELECT tdocs.doc_id, prior.c AS prediction
  FROM tdocs JOIN prior ON prior.f = tdocs.fold
  LEFT JOIN sums ON sums.doc_id = tdocs.doc_id AND sums.c = prior.c
  QUALIFY row_number() OVER (
    PARTITION BY tdocs.doc_id ORDER BY round(p + coalesce(s, 0), 9) DESC, prior.c) = 1),
acc AS (
  SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_rows,
    count(*) FILTER (label = prediction) AS n_correct,
    count(*) FILTER (label = prediction) / count(*) AS accuracy
  FROM tdocs JOIN best USING (doc_id) GROUP BY fold)"""


#: The terms of the other folds, and how many they are.
OTHER_FOLDS = """JOIN (SELECT f, term AS t, count(*) OVER (PARTITION BY f) AS n_voc FROM dft) k
    ON k.f = tent.fold AND k.t = tent.term"""


def profile() -> str:
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    kinds = ["bigint", "string", "string", "string", "bigint"]
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS column_type, count(*) AS n_rows, "
        f"count({n}) AS n_present, count(DISTINCT {n}) AS n_distinct FROM documents"
        for i, (n, t) in enumerate(zip(names, kinds, strict=True))
    )


def weighted_bounds() -> str:
    h = hash32("'1:' || doc_id")
    return f"""SELECT doc_id, CASE WHEN {h} < {round(0.1 * 2**32)} THEN 0
  WHEN {h} < {round(0.125 * 2**32)} THEN 1 ELSE 2 END AS part FROM documents"""


def per_document(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS result FROM documents WHERE text IS NOT NULL"


def tweets(expr: str) -> str:
    return with_(TWEETS, then=f"SELECT doc_id, {expr} AS result FROM texts")


ORACLE: dict[str, str] = {
    "load_csv": with_(
        LABELLED,
        then="SELECT code AS sentiment, text, CASE code WHEN '0' THEN 0 WHEN '4' THEN 2 ELSE 1 END AS label FROM "
        "(SELECT *, CASE sentiment WHEN 'negative' THEN '0' WHEN 'positive' THEN '4' ELSE '2' END AS code "
        "FROM labelled WHERE doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND text IS NOT NULL AND text <> '')",
    ),
    "load_csv_latin1": with_(
        LABELLED,
        then=r"SELECT doc_id, sentiment, regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') AS text "
        "FROM labelled",
    ),
    "load_csv_lines": with_(
        LABELLED,
        then="SELECT doc_id, sentiment, replace(string_split(text, chr(10))[1], '\"', '') AS text FROM labelled",
    ),
    "load_csv_checked": with_(
        LABELLED,
        """kinds AS (
  SELECT length(text) AS n, CASE WHEN doc_id % 7 = 0 THEN 'columns' WHEN doc_id % 11 = 0 THEN 'type of doc_id'
    WHEN doc_id % 13 = 0 THEN 'missing sentiment' WHEN doc_id % 17 = 0 THEN 'columns' ELSE sentiment END AS kind,
    kind = sentiment AS good FROM labelled)""",
        then="SELECT kind, count(*) AS n_rows, CAST(sum(n) FILTER (good) AS BIGINT) AS n_chars FROM kinds GROUP BY kind",
    ),
    "project_labelled": with_(LABELLED, then="SELECT sentiment, text FROM labelled"),
    "profile_columns": profile(),
    "profile_sketches": "SELECT position, column_name, n_rows, n_present, n_distinct AS n_exact, true AS within_error "
    f"FROM ({profile()})",
    "first_rows": with_(
        LABELLED, then="SELECT doc_id, text, sentiment FROM labelled ORDER BY doc_id LIMIT 20"
    ),
    "filter_labels": with_(
        LABELLED,
        then="SELECT doc_id, sentiment FROM labelled WHERE sentiment IN ('positive', 'negative')",
    ),
    "drop_nulls": "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) "
    "WHERE text IS NOT NULL AND quality IS NOT NULL",
    "encode_label": with_(LABELLED, then=f"SELECT doc_id, sentiment, {LABEL} AS label FROM labelled"),
    "encode_label_numeric": "SELECT doc_id, sentiment, "
    "CASE sentiment WHEN '0' THEN 0 WHEN '4' THEN 2 ELSE 1 END AS label FROM "
    "(SELECT doc_id, CAST(quality * 4 - toxic * quality * 2 AS VARCHAR) AS sentiment FROM labels)",
    "class_counts": with_(
        LABELLED, then="SELECT sentiment, count(*) AS n_rows FROM labelled GROUP BY sentiment"
    ),
    "dedup_rows": with_(
        LABELLED,
        then="SELECT sentiment, text, min(doc_id) AS doc_id FROM labelled GROUP BY sentiment, text",
    ),
    "distinct_labels": with_(LABELLED, then=f"SELECT DISTINCT {LABEL} AS label FROM labelled"),
    "union_replicate": with_(
        LABELLED,
        then="SELECT doc_id, sentiment, count(*) AS n_rows FROM (SELECT doc_id, sentiment "
        "FROM labelled, range(8)) GROUP BY doc_id, sentiment",
    ),
    "split_counts": with_(
        V_ENT,
        then="SELECT split, n_rows, n_terms FROM (SELECT split, count(*) AS n_rows FROM docs GROUP BY split) "
        "JOIN (SELECT split, count(DISTINCT term) AS n_terms FROM ent GROUP BY split) USING (split)",
    ),
    "hash_split": f"SELECT doc_id, quality, {SPLIT} AS split FROM labels",
    "random_split": weighted_bounds(),
    "exact_split": f"""SELECT doc_id, CASE WHEN r < ceil(n * 3 / 10) THEN 'test' ELSE 'train' END AS split,
  CAST(r % 10 AS INTEGER) AS fold FROM (SELECT doc_id, count(*) OVER () AS n,
    row_number() OVER (ORDER BY {hash32("'69:' || doc_id")}, doc_id) - 1 AS r FROM labels)""",
    "cv_folds": f"SELECT doc_id, CAST({FOLD} % 10 AS INTEGER) AS fold FROM labels",
    "lower_text": per_document("lower(text)"),
    "tokenize_ws": per_document(f"array_to_string(string_split_regex(lower(text), '{JSPACE}'), '|')"),
    "token_placeholders": with_(TWEETS, RAW, PLACED, then=joined("placed", "w")),
    "squeeze_runs": with_(TEXTS, RAW, squeezed("raw"), then=joined("squeezed", "w")),
    "drop_number_led": with_(
        TWEETS,
        RAW,
        f"kept AS (SELECT * FROM raw WHERE NOT regexp_matches(w, '^{DIGIT}'))",
        then=joined("kept", "w"),
    ),
    "remove_stopwords": with_(
        TEXTS,
        RAW,
        f"kept AS (SELECT * FROM raw WHERE w NOT IN ({STOP_LIST}, {q(MOJIBAKE_QUOTE)}))",
        then=joined("kept", "w"),
    ),
    "strip_punct": with_(
        TWEETS,
        RAW,
        f"kept AS (SELECT doc_id, i, trim(w, {q(PUNCTUATION)}) AS w FROM raw)",
        then=joined("kept", "w"),
    ),
    "clean_tokens": with_(TEXTS, CLEAN_CHAIN, then=joined("cleaned", "w")),
    "clean_tokens_tweets": with_(TWEETS, CLEAN_CHAIN, then=joined("cleaned", "w")),
    "clean_tokens_128": with_(
        TWEETS.replace(" AS text FROM", f" || ' ' || {q(MOJIBAKE_QUOTE)} || ' end' AS text FROM"),
        CLEAN_CHAIN.replace(STOP_LIST, f"{STOP_LIST}, {q(MOJIBAKE_QUOTE)}"),
        then=joined("cleaned", "w"),
    ),
    "norm_basic": tweets(basic("text")),
    "norm_emoticons": tweets(emoticons("lower(text)")),
    "norm_single_letters": tweets(single_letters("lower(text)")),
    "norm_contractions": tweets(contractions("lower(text)")),
    "norm_contractions_table": tweets(contractions("lower(text)")),
    "norm_punct": tweets(punctuation("lower(text)")),
    "squeeze_to_two": with_(
        "l AS (SELECT doc_id, string_split(text, '') AS c FROM documents WHERE text IS NOT NULL)",
        then=f"SELECT doc_id, {two('c')} AS result FROM l",
    ),
    "normalize_text": with_(
        TEXTS, normal_chain("texts", "doc_id"), then="SELECT doc_id, x AS result FROM normal"
    ),
    "normalize_tweets": with_(
        TWEETS, normal_chain("texts", "doc_id"), then="SELECT doc_id, x AS result FROM normal"
    ),
    "term_counts": with_(
        TEXTS,
        normal_chain("texts", "doc_id"),
        word_entries("normal", "x", "doc_id", pairs=False),
        then="SELECT doc_id, term, tf FROM ent",
    ),
    "ngram_counts": with_(V_ENT, then="SELECT doc_id, term, tf FROM ent"),
    "vocabulary": with_(
        TEXTS,
        normal_chain("texts", "doc_id"),
        word_entries("normal", "x", "doc_id"),
        then="SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM ent GROUP BY term",
    ),
    "hashing_tf": with_(
        H_ENT,
        MURMUR,
        then=f"SELECT doc_id, CAST((h % {NUM_FEATURES} + {NUM_FEATURES}) % {NUM_FEATURES} AS INTEGER) AS bucket, "
        "CAST(count(*) AS DOUBLE) AS tf FROM cleaned JOIN murmur USING (w) GROUP BY ALL",
    ),
    "hash_bucket_tf": with_(H_ENT, then="SELECT doc_id, CAST(term AS INTEGER) AS bucket, tf FROM ent"),
    "idf_spark": with_(
        H_ENT,
        CLASS_SIZES,
        VOCABULARY,
        SPARK_IDF,
        then="SELECT CAST(term AS INTEGER) AS bucket, df, round(idf, 6) AS idf FROM idf WHERE df > 0",
    ),
    "tfidf_spark": with_(
        H_ENT,
        CLASS_SIZES,
        VOCABULARY,
        SPARK_IDF,
        then="SELECT doc_id, CAST(term AS INTEGER) AS bucket, round(tf * idf, 6) AS tfidf "
        "FROM ent JOIN idf USING (term) WHERE split = 'train'",
    ),
    "tfidf_l2": with_(
        V_BASE, UNIT, then="SELECT doc_id, term, round(v, 6) AS tfidf FROM unit"
    ),
    "labelled_points": with_(
        H_ENT,
        CLASS_SIZES,
        VOCABULARY,
        SPARK_IDF,
        then="SELECT doc_id, label, count(*) AS n_features, round(sum(tf * idf), 6) AS total "
        "FROM ent JOIN idf USING (term) WHERE split = 'train' GROUP BY doc_id, label",
    ),
    "nb_train_vocabulary_predict": with_(
        V_ENT,
        CLASS_SIZES,
        PLAIN_PRIOR,
        "voc AS (SELECT DISTINCT term FROM ent WHERE split = 'train')",
        COUNT_THETA,
        COUNT_VALUES,
        SUMS,
        SCORED,
        then=WIDE,
    ),
    "nb_model_grown": with_(V_COUNT, then=theta_columns()),
    "nb_grown_predict": with_(H_PREDICTED, then=WIDE),
    "cv_train_vocabulary": with_(
        cross_validated(V_ENT, 10, "n_voc", False, OTHER_FOLDS),
        then="SELECT fold, n_rows, n_correct, round(accuracy, 6) AS accuracy FROM acc",
    ),
    "cv_vocabulary_sizes": with_(
        V_ENT,
        f"""tent AS (SELECT term, {FOLD} % 10 AS fold FROM ent WHERE split = 'train'),
f AS (SELECT DISTINCT fold FROM tent)""",
        then="""SELECT CAST(fold AS INTEGER) AS fold,
  (SELECT count(DISTINCT term) FROM tent WHERE tent.fold = f.fold
    AND term NOT IN (SELECT t.term FROM tent t WHERE t.fold <> f.fold)) AS n_exclusive,
  (SELECT count(DISTINCT term) FROM tent WHERE tent.fold <> f.fold) AS n_terms FROM f""",
    ),
    "nb_priors": with_(
        LABELLED,
        H_DOCS,
        CLASS_SIZES,
        then="SELECT c AS label, n AS n_docs, round(ln(n / m), 6) AS log_prior, "
        "round(ln((n + 1.0) / (m + k)), 6) AS log_prior_smoothed FROM nc, total",
    ),
    "nb_model_counts": with_(V_COUNT, then=theta_columns()),
    "nb_model_spark": with_(
        H_MODEL.replace("voc AS (SELECT DISTINCT term FROM ent)",
                        "voc AS (SELECT DISTINCT term FROM ent WHERE split = 'train')"),
        then=theta_columns("bucket").replace("term AS bucket", "CAST(term AS INTEGER) AS bucket"),
    ),
    "nb_model_bernoulli": with_(
        V_BASE,
        BERNOULLI,
        "theta AS (SELECT term, c, ln(p) AS logp FROM probs)",
        then=theta_columns(),
    ),
    "nb_model_tfidf": with_(V_UNIT, then=theta_columns()),
    "nb_spark_predict": with_(H_PREDICTED, then=WIDE),
    "nb_ml_stages": with_(H_PREDICTED, then="SELECT doc_id, label, split, prediction FROM predicted"),
    "nb_predict": with_(V_PREDICTED, then=WIDE),
    "nb_bernoulli_predict": with_(V_BERNOULLI, then=WIDE),
    "nb_tfidf_predict": with_(V_TFIDF, then=WIDE),
    "nb_roles_predict": with_(R_PREDICTED, then=WIDE),
    "score_new_docs": SCORE_NEW,
    "score_stream_versions": f"SELECT *, CAST(1 AS INTEGER) AS model_version FROM ({SCORE_NEW}) WHERE doc_id % 2 = 0 "
    f"UNION ALL SELECT *, CAST(2 AS INTEGER) FROM ({SCORE_NEW_COUNTS}) WHERE doc_id % 2 = 1",
    "score_new_stream": SCORE_NEW,
    "accuracy_by_split": with_(
        H_PREDICTED, then=f"SELECT split, {ACCURACY} FROM predicted GROUP BY split"
    ),
    "accuracy_replicated": with_(
        H_PREDICTED.replace(H_ENT, X_ENT),
        then=f"SELECT split, {ACCURACY} FROM predicted GROUP BY split",
    ),
    "accuracy_by_model": " UNION ALL ".join(
        f"SELECT * FROM ({with_(ctes, then=f'SELECT split, {ACCURACY}, {q(name)} AS model FROM predicted GROUP BY split')})"
        for name, ctes in [
            ("multinomial", V_PREDICTED),
            ("bernoulli", V_BERNOULLI),
            ("tfidf", V_TFIDF),
        ]
    ),
    "exact_split_models": " UNION ALL ".join(
        f"SELECT * FROM ({with_(ctes.replace(V_DOCS, E_DOCS), then=f'SELECT split, {ACCURACY}, {q(name)} AS model FROM predicted GROUP BY split')})"
        for name, ctes in [("multinomial", V_PREDICTED), ("bernoulli", V_BERNOULLI)]
    ),
    "confusion_matrix": with_(
        V_PREDICTED,
        then="SELECT c AS label, "
        + ", ".join(
            f"(SELECT count(*) FROM predicted WHERE split = 'test' AND label = c AND prediction = {p}) "
            f"AS predicted_{p}"
            for p in (0, 1, 2)
        )
        + " FROM (VALUES (0), (1), (2)) AS v(c)",
    ),
    "classification_report": with_(V_PREDICTED, CLASS_METRICS, then=REPORT),
    "per_class_metrics": with_(
        H_PREDICTED,
        CLASS_METRICS,
        then="SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support "
        "FROM metrics",
    ),
    "weighted_metrics": with_(
        H_PREDICTED,
        CLASS_METRICS,
        then="SELECT round(sum(r * support) / sum(support), 6) AS weighted_recall, "
        "round(sum(p * support) / sum(support), 6) AS weighted_precision, "
        "round(sum(f * support) / sum(support), 6) AS weighted_f1 FROM metrics",
    ),
    "auc_from_classes": with_(
        H_PREDICTED,
        "tested AS (SELECT * FROM predicted WHERE split = 'test')",
        then="SELECT round(avg(CASE WHEN a.prediction > b.prediction THEN 1.0 "
        "WHEN a.prediction = b.prediction THEN 0.5 ELSE 0.0 END), 6) AS auc "
        "FROM tested a JOIN tested b ON a.label > 0.5 AND b.label <= 0.5",
    ),
    "auc_from_scores": with_(
        H_PREDICTED,
        ODDS,
        pairs_in_order(
            "SELECT 0 AS g, -x AS x, label > 0 AS positive FROM odds JOIN predicted USING (doc_id) WHERE c = 0 AND split = 'test'"
        ),
        then=f"SELECT {AUC_ROW}",
    ),
    "auc_by_class": with_(
        V_PREDICTED,
        ODDS,
        pairs_in_order(
            "SELECT c AS g, x, label = c AS positive FROM odds JOIN predicted USING (doc_id) WHERE split = 'test'"
        ),
        then=f"SELECT g AS label, {AUC_ROW}",
    ),
    "cv_fold_accuracy": with_(
        cross_validated(H_ENT, 2, str(NUM_FEATURES), True),
        then="SELECT fold, n_rows, n_correct, round(accuracy, 6) AS accuracy FROM acc",
    ),
    "cv_summary": with_(
        cross_validated(V_ENT, 10, "(SELECT count(DISTINCT term) FROM ent)", False),
        then="SELECT count(*) AS k, round(avg(accuracy), 6) AS mean_accuracy, "
        "round(stddev_pop(accuracy), 6) AS std_accuracy FROM acc",
    ),
}
