"""The queries in SQL for DuckDB, written independently of the Spark expressions.

Regular expressions are RE2's here: no back-references, no look-around.
"""

from __future__ import annotations

from .seeded import SEEDED_SQL

# Fixed values, as in the patterns and word lists of the operators.
WS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS_INLINE = WS.replace(r"\t-\r", r"\t\x{b}-\r")
WORD = r"\p{L}\p{M}\p{N}_"
PIECE = (
    rf"https?://[^{WS}]+"
    r"|[a-zA-Z0-9._%+-]{1,64}@(?:[a-zA-Z0-9-]{1,63}\.){1,8}[a-zA-Z]{2,63}"
    rf"|\p{{Nd}}{{4}}-\p{{Nd}}{{2}}-\p{{Nd}}{{2}}[{WORD}]*"
    rf"|[$€£]?\p{{Nd}}+(?:[.,]\p{{Nd}}+){{0,8}}%?[{WORD}]*"
    rf"|[{WORD}]+|[{WS}]+|(?s:.)"
)
NUMBER = r"\p{Nd}+(?:[.,]\p{Nd}+){0,8}"
ALLOWED = r"\.,!?\-_:;()\[\]\"''"
LEXICON = {
    1: "amazing excellent excited love outstanding wonderful".split(),
    -1: "disappointing horrible terrible worthless".split(),
}
TAGS = {
    "NOUN": "news product company features service words".split(),
    "ADJ": "amazing good new terrible wonderful worthless".split(),
}
COMMANDS = "explain describe list analyze compare define elaborate illustrate show tell".split()
PHRASES = [
    ("Apple", "ORG"), ("Apple Inc", "ORG"), ("Google", "ORG"), ("Microsoft", "ORG"),
    ("Satya Nadella", "PERSON"), ("Tim Cook", "PERSON"),
]
DEFAULT_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
JOINER = "chr(31)"
DIMENSIONS = {
    "completeness": 0.2, "consistency": 0.15, "validity": 0.15, "uniqueness": 0.15,
    "timeliness": 0.1, "integrity": 0.15, "accuracy": 0.1,
}

SEEDED = "seeded AS (" + SEEDED_SQL.format(documents="documents") + ")"


def stop_words() -> list[str]:
    from ..operators.stopwords import ALL_STOP_WORDS

    return list(ALL_STOP_WORDS)


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def boilerplate(x: str) -> str:
    return f"regexp_replace({x}, 'confidential|private|all rights reserved|copyright', '', 'gi')"


def signature(x: str) -> str:
    return strip(f"regexp_replace({boilerplate(x)}, '(?is)best regards.*', '')")


def blank_lines(x: str) -> str:
    return rf"regexp_replace({x}, '\n[{WS}]*\n', chr(10) || chr(10), 'g')"


def spacing(x: str) -> str:
    one = f"regexp_replace({blank_lines(x)}, '[{WS_INLINE}]+', ' ', 'g')"
    return strip(rf"regexp_replace({one}, ' *\n *', chr(10), 'g')")


def control(x: str) -> str:
    return rf"regexp_replace({x}, '\p{{C}}', '', 'g')"


def quotes(x: str) -> str:
    return f"""translate({x}, '“”‘’', '""''''')"""


def cleaned(x: str) -> str:
    return quotes(control(spacing(signature(x))))


def pieces(x: str) -> str:
    return f"regexp_extract_all({x}, '{PIECE}')"


def tokens(x: str) -> str:
    return f"list_filter({pieces(x)}, lambda p: NOT regexp_matches(p, '^[{WS}]'))"


def sentences(x: str) -> str:
    marked = rf"regexp_replace({x}, '([.!?])[{WS}]+', '\1' || chr(1), 'g')"
    parts = f"list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')})"
    return f"list_filter({parts}, lambda s: s <> '')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[^{WORD}]+'), lambda w: w <> '')"


def ws_words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[{WS}]+'), lambda w: w <> '')"


# Entities. ``source`` must be a relation (id columns..., text).

def phrase_values(regions_sql: str) -> str:
    rows = ", ".join(f"('{p}', '{l}')" for p, l in PHRASES)
    return f"SELECT * FROM (VALUES {rows}) AS v(phrase, label) UNION ALL SELECT r, 'GPE' FROM ({regions_sql}) AS q(r)"


TABLE_REGIONS = "SELECT r_name FROM region"
FIXED_REGIONS = "SELECT unnest([" + quoted(DEFAULT_REGIONS) + "])"


LARGE_PHRASES = """SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{9,}')) AS phrase, 'WORD' AS label FROM documents
  UNION SELECT DISTINCT regexp_extract(text, '^[A-Z][a-z]* [a-z]+'), 'OPENING' FROM documents
  WHERE regexp_matches(text, '^[A-Z][a-z]* [a-z]+')"""


def entity_ctes(source: str, keys: str, regions_sql: str = TABLE_REGIONS, phrases_sql: str = "") -> str:
    """CTEs ending in ``entity`` (keys, ix, span, text, label, start_pos, end_pos)."""
    return f"""
phrases AS ({phrases_sql or phrase_values(regions_sql)}),
cut AS (SELECT {keys}, {pieces('text')} AS p FROM {source} WHERE text IS NOT NULL),
piece AS (SELECT {keys}, unnest(p) AS piece, unnest(range(0, len(p))) AS ix FROM cut),
placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER w, 0) - length(piece) AS start_pos,
    piece || lead(piece, 1) OVER o || lead(piece, 2) OVER o AS three
  FROM piece
  WINDOW w AS (PARTITION BY {keys} ORDER BY ix ROWS UNBOUNDED PRECEDING),
    o AS (PARTITION BY {keys} ORDER BY ix)),
shaped AS (
  SELECT *, CASE
    WHEN regexp_matches(piece, '^https?://.') THEN 'URL'
    WHEN regexp_matches(piece, '.@.') THEN 'EMAIL'
    WHEN regexp_full_match(piece, '\\p{{Nd}}{{4}}-\\p{{Nd}}{{2}}-\\p{{Nd}}{{2}}') THEN 'DATE'
    WHEN regexp_full_match(piece, '[$€£]{NUMBER}') THEN 'MONEY'
    WHEN regexp_full_match(piece, '{NUMBER}%') THEN 'PERCENT'
    WHEN regexp_full_match(piece, '{NUMBER}') THEN 'NUMBER' END AS shape
  FROM placed),
hit AS (
  SELECT {keys}, ix, start_pos,
    CASE WHEN l3.label IS NOT NULL THEN 3 ELSE 1 END AS span,
    CASE WHEN l3.label IS NOT NULL THEN three ELSE piece END AS text,
    coalesce(l3.label, l1.label, shape) AS label
  FROM shaped LEFT JOIN phrases l3 ON three = l3.phrase LEFT JOIN phrases l1 ON piece = l1.phrase
  WHERE coalesce(l3.label, l1.label, shape) IS NOT NULL),
entity AS (
  SELECT {keys}, ix, span, text, label, start_pos, start_pos + length(text) AS end_pos
  FROM (SELECT *, coalesce(max(ix + span) OVER (PARTITION BY {keys} ORDER BY ix
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free FROM hit)
  WHERE ix >= free)
"""


def has_entity_ctes(source: str, keys: str, regions_sql: str = FIXED_REGIONS) -> str:
    return entity_ctes(source, keys, regions_sql) + f""",
entity_docs AS (SELECT DISTINCT {keys} FROM entity)"""


def accepted(text: str, found: str) -> str:
    return f"""coalesce(length({text}) BETWEEN 20 AND 1000 AND len({ws_words(text)}) >= 3
      AND ({found} OR len({tokens(text)}) <= 50), false)"""


def clean_ctes(entities: str) -> str:
    return CLEAN_TEMPLATE.replace("<entities>", entities)


CLEAN_TEMPLATE = f"""WITH {SEEDED},
base AS (SELECT doc_id, {cleaned('text')} AS text FROM seeded),
<entities>,
judged AS (
  SELECT b.doc_id, b.text, {accepted('b.text', 'e.doc_id IS NOT NULL')} AS ok
  FROM base b LEFT JOIN entity_docs e ON b.doc_id = e.doc_id),
aligned AS (SELECT doc_id, CASE WHEN ok THEN text ELSE '' END AS text_cleaned FROM judged),
processed AS (
  SELECT s.doc_id, s.text, a.text_cleaned, {sentences('a.text_cleaned')} AS parts
  FROM seeded s JOIN aligned a ON s.doc_id = a.doc_id)
"""
CLEAN_CTES = clean_ctes(has_entity_ctes("base", "doc_id"))
LARGE_CLEAN_CTES = clean_ctes(
    entity_ctes("base", "doc_id", phrases_sql=LARGE_PHRASES) + ", entity_docs AS (SELECT DISTINCT doc_id FROM entity)"
)


def step(expression: str) -> str:
    return f"WITH {SEEDED} SELECT doc_id, {expression} AS cleaned FROM seeded"


# Quality dimensions over a relation with known columns.

def mean(parts: list[str], default: str) -> str:
    if not parts:
        return default
    return f"coalesce(list_avg([{', '.join(parts)}]), {default})"


class Relation:
    """Scalar SQL expressions for the dimensions of ``FROM source``."""

    def __init__(self, source: str, text: list[str], numeric: list[str], other: list[str] = ()):
        self.source, self.text, self.numeric, self.other = source, text, numeric, list(other)
        self.columns = text + numeric + self.other

    def completeness(self) -> str:
        present = " + ".join(f"count({c})" for c in self.columns)
        return f"1.0 - (count(*) * {len(self.columns)} - ({present})) / (count(*) * {len(self.columns)})"

    def _evenness(self, c: str) -> str:
        return f"""CASE WHEN avg(length({c})) > 0 THEN
          coalesce(greatest(0.0, 1 - stddev_samp(length({c})) / avg(length({c}))), 0.0) END"""

    def consistency(self) -> str:
        return mean([self._evenness(c) for c in self.text], "1.0")

    def gate_consistency(self) -> str:
        parts = [
            f"CASE WHEN avg(length({c})) > 0 THEN 1 - stddev_samp(length({c})) / avg(length({c})) ELSE 0 END"
            for c in self.text
        ]
        return f"({' + '.join(parts)}) / {len(parts)}"

    def validity(self) -> str:
        shares = [f"count(*) FILTER (length({c}) >= 10) / count(*)" for c in self.text]
        shares += [f"count({c}) / count(*)" for c in self.numeric + self.other]
        return mean(shares, "0.0")

    def gate_validity(self) -> str:
        return mean([f"count({c}) / count(*)" for c in self.columns], "0.0")

    def row_uniqueness(self) -> str:
        return (
            f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(self.columns)} FROM {self.source}))"
            f" / (SELECT count(*) FROM {self.source})"
        )

    def text_uniqueness(self) -> str:
        return mean([f"count(DISTINCT {c}) / count(*)" for c in self.text], "1.0")

    def uniqueness(self) -> str:
        return (
            f"(0.7 * {self.row_uniqueness()} + 0.3 * "
            f"(SELECT {self.text_uniqueness()} FROM {self.source}))"
        )

    def outlier_share(self, c: str) -> str:
        return f"""(SELECT avg(CASE WHEN s > 0 AND abs({c} - m) / s > 3 THEN 1.0 ELSE 0.0 END)
          FROM {self.source}, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM {self.source})
          WHERE {c} IS NOT NULL)"""

    def accuracy(self, runs: dict[str, str]) -> str:
        """``runs``: for a text column the relation (key, value) of texts with long
        runs of one character, as SQL condition on the column."""
        parts = [f"1.0 - {self.outlier_share(c)}" for c in self.numeric]
        parts += [
            f"(SELECT coalesce(avg({text_quality(c, runs.get(c, 'false'))}), 0.0) FROM {self.source})"
            for c in self.text
        ]
        return mean(parts, "0.0")


def text_quality(c: str, repeats: str) -> str:
    special = f"length(regexp_replace({c}, '[a-zA-Z0-9{WS}]', '', 'g')) / length({c})"
    return f"""CASE WHEN {c} IS NOT NULL THEN
      CASE WHEN length({c}) > 0 AND {special} > 0.3 THEN 0.7 ELSE 1.0 END
      * CASE WHEN length({c}) < 10 THEN 0.8 ELSE 1.0 END
      * CASE WHEN {repeats} THEN 0.9 ELSE 1.0 END END"""


def runs_cte(name: str, source: str, key: str, column: str) -> str:
    """Keys of the rows whose ``column`` repeats a character five times in a row."""
    return f"""{name} AS (
  SELECT DISTINCT {key} FROM (
    SELECT {key}, c, ix - row_number() OVER (PARTITION BY {key}, c ORDER BY ix) AS island
    FROM (SELECT {key}, unnest(string_split({column}, '')) AS c,
            unnest(range(0, length({column}))) AS ix FROM {source} WHERE {column} IS NOT NULL)
    WHERE c <> chr(10))
  GROUP BY {key}, c, island HAVING count(*) >= 5)"""


SEEDED_RELATION = Relation(
    "seeded", ["lang", "source", "text", "email", "phone", "start_date", "end_date"], ["doc_id"]
)
DOC_RELATION = Relation("documents", ["text", "lang", "source"], ["doc_id", "n_chars"])
EVENT_RELATION = Relation("events", ["event_type", "props"], ["event_id", "user_id", "value"], ["ts"])
SEEDED_RUNS = runs_cte("runs", "seeded", "doc_id", "text")
IN_RUNS = {"text": "doc_id IN (SELECT doc_id FROM runs)"}


def one(expression: str, name: str, source: str, ctes: str = "") -> str:
    return f"{ctes} SELECT round({expression}, 6) AS {name} FROM {source}"


def two_decimals(x: str) -> str:
    return f"printf('%.2f', {x})"


def profile_sql(relation: Relation, ctes: str, runs: dict, timeliness="1.0", integrity="1.0") -> str:
    """CTE ``profile`` with the seven scores and the overall score."""
    weights = " + ".join(f"{d} * {w}" for d, w in DIMENSIONS.items())
    return f"""{ctes} scores AS (
  SELECT {relation.completeness()} AS completeness, {relation.consistency()} AS consistency,
    {relation.validity()} AS validity, {relation.uniqueness()} AS uniqueness,
    {timeliness} AS timeliness, {integrity} AS integrity, {relation.accuracy(runs)} AS accuracy
  FROM {relation.source}),
profile AS (SELECT *, {weights} AS overall_score FROM scores)
"""


VERDICT = f"""verdict AS (SELECT *, array_to_string(list_filter([
    CASE WHEN completeness < 0.8 THEN 'Completeness score ' || {two_decimals('completeness')} || ' below threshold 0.8' END,
    CASE WHEN consistency < 0.7 THEN 'Consistency score ' || {two_decimals('consistency')} || ' below threshold 0.7' END
  ], lambda i: i IS NOT NULL), {JOINER}) AS issues,
  completeness >= 0.8 AND consistency >= 0.7 AND overall_score >= 0.75 AS passed FROM profile)"""
ROUNDED_PROFILE = ", ".join(f"round({d}::DOUBLE, 6) AS {d}" for d in [*DIMENSIONS, "overall_score"])
FRESHNESS = (
    "avg(1 - least(greatest(epoch(TIMESTAMP '2024-01-31' - ts) / 86400.0 / 30, 0), 1))"
)
SEEDED_PROFILE = profile_sql(SEEDED_RELATION, f"WITH {SEEDED}, {SEEDED_RUNS},", IN_RUNS)

# Language model.

TRIGRAMS = (
    r"list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))"
)


def gram_cte(name: str, source: str, keys: str) -> str:
    return rf"""{name}_list AS (
  SELECT {keys}, {TRIGRAMS} AS grams FROM (
    SELECT {keys}, regexp_replace(lower(text), '[^\p{{L}}]+', ' ', 'g') AS t FROM {source})),
{name} AS (SELECT {keys}, gram, count(*) AS n FROM (
    SELECT {keys}, unnest(grams) AS gram FROM {name}_list) GROUP BY {keys}, gram)"""


LANGUAGE_CTES = f"""WITH {gram_cte('train', 'documents', 'doc_id, lang')},
per_lang AS (SELECT lang, gram, sum(n) AS n FROM train GROUP BY lang, gram),
vocabulary AS (SELECT DISTINCT gram FROM per_lang),
languages AS (SELECT DISTINCT lang FROM documents),
known AS (SELECT l.lang, v.gram, coalesce(p.n, 0) AS n FROM languages l
  CROSS JOIN vocabulary v LEFT JOIN per_lang p ON p.lang = l.lang AND p.gram = v.gram),
theta AS (SELECT lang, gram,
  ln(n + 1.0) - ln(sum(n) OVER (PARTITION BY lang) + (SELECT count(*) FROM vocabulary)) AS w FROM known),
seen_grams AS (SELECT lang, sum(n) AS n FROM known GROUP BY lang),
prior AS (SELECT lang, ln(n + 1.0) - ln(sum(n) OVER () + count(*) OVER ()) AS w FROM seen_grams)
"""


def detect_ctes(grams: str, keys: str) -> str:
    join = " AND ".join(f"a.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    selected = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""
seen AS (SELECT {keys}, len(grams) AS n_grams FROM {grams}_list),
summed AS (SELECT {keys}, lang, sum(g.n * t.w) AS score
  FROM {grams}_keys g JOIN theta t ON g.gram = t.gram GROUP BY {keys}, lang),
scored AS (SELECT {selected}, p.lang AS language, p.w + coalesce(s.score, 0) AS score
  FROM seen a CROSS JOIN prior p LEFT JOIN summed s ON {join} AND s.lang = p.lang
  WHERE a.n_grams > 0),
best AS (SELECT {keys}, language, confidence FROM (
  SELECT {keys}, language,
    1.0 / sum(exp(score - top)) OVER (PARTITION BY {keys}) * exp(score - top) AS confidence, score
  FROM (SELECT *, max(score) OVER (PARTITION BY {keys}) AS top FROM scored))
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, language) = 1)
"""


DOC_LANGUAGE = (
    LANGUAGE_CTES
    + ", train_keys AS (SELECT doc_id, gram, n FROM train), "
    + detect_ctes("train", "doc_id")
)
SEEDED_GRAMS = gram_cte("grams", "(SELECT doc_id, text FROM seeded WHERE text IS NOT NULL)", "doc_id")

FOREIGN = "language <> 'en' AND confidence > 0.8"
LANGUAGE_RULE = (
    DOC_LANGUAGE
    + f""", detected AS (SELECT d.doc_id, d.text, b.language, b.confidence
  FROM documents d JOIN best b ON d.doc_id = b.doc_id WHERE length({strip('d.text')}) >= 10)
"""
)

# Words and keywords.

CONTENT = r"list_filter(" + words("text") + r", lambda w: regexp_matches(w, '\p{L}'))"


def keyword_ctes(tagged: bool) -> str:
    tags = ", ".join(f"('{w}', '{t}')" for t, ws in TAGS.items() for w in ws)
    source = (
        f"JOIN (VALUES {tags}) AS g(word, pos) ON f.word = g.word" if tagged else ""
    )
    pos = "g.pos" if tagged else "'X'"
    return f"""
content AS (SELECT doc_id, {CONTENT} AS ws FROM seeded WHERE text IS NOT NULL),
used AS (SELECT doc_id, lower(w) AS word, w AS text, ix FROM (
  SELECT doc_id, unnest(ws) AS w, unnest(range(0, len(ws))) AS ix FROM content)),
counted AS (SELECT word, count(*) AS n FROM used GROUP BY word),
first_use AS (SELECT * FROM used WHERE word NOT IN ({quoted(stop_words())})
  QUALIFY row_number() OVER (PARTITION BY doc_id, word ORDER BY ix) = 1),
keyword AS (SELECT * FROM (
  SELECT f.doc_id, f.text, {pos} AS pos, -ln(c.n / (SELECT sum(n) FROM counted)) AS score,
    row_number() OVER (PARTITION BY f.doc_id ORDER BY c.n, f.ix) AS rank
  FROM first_use f JOIN counted c ON f.word = c.word {source}
  WHERE -ln(c.n / (SELECT sum(n) FROM counted)) > 0.3) WHERE rank <= 10)
"""


# Topics: ``cut`` of the entity CTEs has the pieces.

PHRASE_TEXT = f"""phrase_text AS (SELECT doc_id, list_filter(list_transform(string_split_regex(array_to_string(
    list_transform(p, lambda x: CASE WHEN lower(x) IN ({quoted(stop_words())})
      OR regexp_matches(x, '^(?:[^{WORD}{WS}]|[{WS}]*\\n)') THEN chr(1) ELSE x END), ''),
    '\\x01+'), lambda s: {strip('s')}), lambda s: regexp_matches(s, '\\p{{L}}')) AS runs FROM cut)"""
TOPIC_CTES = f"""
{PHRASE_TEXT},
candidate AS (
  SELECT doc_id, unnest(runs) AS topic, 0 AS kind, unnest(range(0, len(runs))) AS ix FROM phrase_text
  UNION ALL SELECT doc_id, text, 1, ix FROM entity),
topic AS (SELECT doc_id, topic, row_number() OVER (PARTITION BY doc_id ORDER BY kind, ix) - 1 AS position
  FROM (SELECT * FROM candidate
    QUALIFY row_number() OVER (PARTITION BY doc_id, lower(topic) ORDER BY kind, ix) = 1))
"""


def lexicon_words(weight: int) -> str:
    return quoted(LEXICON[weight])


SENTIMENT_CTES = f"""
lexed AS (SELECT doc_id, {words('lower(text)')} AS ws FROM seeded WHERE text IS NOT NULL),
weighed AS (SELECT doc_id,
  len(list_filter(ws, lambda w: w IN ({lexicon_words(1)}))) AS good,
  len(list_filter(ws, lambda w: w IN ({lexicon_words(-1)}))) AS bad FROM lexed),
feeling AS (SELECT doc_id, CASE WHEN good + bad = 0 THEN 0.0 ELSE (good - bad) / (good + bad) END AS score
  FROM weighed)
"""
FEELING_LABEL = "CASE WHEN score > 0.1 THEN 'positive' WHEN score < -0.1 THEN 'negative' ELSE 'neutral' END"


def is_instruction(x: str) -> str:
    return rf"""(regexp_matches(lower({x}), '^(how to|what is|explain|describe|tell me|can you|please)')
      OR regexp_matches(lower({x}), '\?[^\n]*\n?$')
      OR regexp_matches(lower({x}), '^(if|when|why|where|who|whose|which|whatever|whom)'))"""


def commands(x: str) -> str:
    return f"""array_to_string(list_filter(string_split_regex(lower({x}), '[{WS}]+'),
      lambda w: w IN ({quoted(COMMANDS)})), ' ')"""


TAGGED = quoted([w for ws in TAGS.values() for w in ws])


def linguistic(source: str, keys: str, ctes: str) -> str:
    """Counts of the linguistic annotation of each text of ``source``."""
    join = " AND ".join(f"s.{k.strip()} = e.{k.strip()}" for k in keys.split(","))
    selected = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    return f"""{ctes}, {entity_ctes(source, keys)},
named AS (SELECT {keys}, string_agg(text || '/' || label, {JOINER} ORDER BY ix) AS entities
  FROM entity GROUP BY {keys})
SELECT {selected}, CASE WHEN s.text IS NOT NULL THEN coalesce(e.entities, '') END AS entities, len({tokens('s.text')}) AS n_tokens,
  len({sentences('s.text')}) AS n_sentences,
  len(list_filter({tokens('s.text')}, lambda t: lower(t) IN ({TAGGED}))) AS n_tagged,
  CASE WHEN s.text IS NOT NULL THEN 0.0::DOUBLE END AS sentiment
FROM {source} s LEFT JOIN named e ON {join}"""


SENTENCE_SOURCE = f"""WITH {SEEDED},
listed AS (SELECT doc_id, {sentences('text')} AS parts FROM seeded WHERE text IS NOT NULL),
sentence AS (SELECT doc_id, unnest(range(0, len(parts))) AS position, unnest(parts) AS text FROM listed)
"""

STRIPPED = (
    r"regexp_replace(regexp_replace(regexp_replace({x}, 'https?://[a-z$-_!]+', '', 'g'),"
    r" '```[\s\S]*?```', '', 'g'), '`[^\n]*?`', '', 'g')"
)


def special_ratio(x: str) -> str:
    kept = rf"regexp_replace({x}, '[\p{{L}}\p{{N}}{WS}{ALLOWED}]', '', 'g')"
    return f"CASE WHEN length({x}) = 0 THEN 0.0 ELSE length({kept}) / length({x}) END"


def special_ctes(columns: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT doc_id, '{c}' AS \"column\", {STRIPPED.format(x=c)} AS text FROM seeded WHERE {c} IS NOT NULL"
        for c in columns
    )
    return f"WITH {SEEDED}, stripped AS ({rows}), ratios AS (SELECT *, {special_ratio('text')} AS ratio FROM stripped)"


EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE = r"^\+?1?\p{Nd}{9,15}$"
DATE = r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}$"
INVALID = (
    f"WITH {SEEDED}, invalid AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, '{c}' AS \"column\", '{k}' AS format_type, {c} AS value FROM seeded"
        f" WHERE {c} IS NOT NULL AND NOT regexp_matches({c}, '{r}')"
        for c, k, r in (
            ("email", "email", EMAIL), ("phone", "phone", PHONE),
            ("start_date", "date", DATE), ("end_date", "date", DATE),
        )
    )
    + ")"
)
DATES = f"""WITH {SEEDED}, dates AS (SELECT
  coalesce(try_strptime(start_date, '%Y-%m-%d'), try_cast(start_date AS TIMESTAMP)) AS s, start_date,
  try_strptime(end_date, '%Y-%m-%d') AS e, end_date FROM seeded)"""

NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def not_na(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({quoted(NA_TOKENS)}) THEN {c} END AS {c}"


def by_source() -> str:
    """The verdict for every source of the documents, one dimension after the other."""
    text = ["text", "lang"]
    relation = Relation("documents", text, ["doc_id", "n_chars"])
    weights = " + ".join(f"{d} * {w}" for d, w in DIMENSIONS.items())
    quality = ", ".join(
        f"avg({text_quality(c, IN_RUNS.get(c, 'false'))}) AS q_{c}" for c in text
    )
    return f"""WITH {runs_cte('runs', 'documents', 'doc_id', 'text')},
basic AS (SELECT source, {relation.completeness()} AS completeness, {relation.consistency()} AS consistency,
    {relation.validity()} AS validity, {relation.text_uniqueness()} AS text_uniqueness, count(*) AS n, {quality}
  FROM documents GROUP BY source),
rows_of AS (SELECT source, count(*) AS d FROM (SELECT DISTINCT doc_id, text, lang, n_chars, source FROM documents) GROUP BY source),
moments AS (SELECT source, avg(doc_id) AS m1, stddev_pop(doc_id) AS s1, avg(n_chars) AS m2, stddev_pop(n_chars) AS s2
  FROM documents GROUP BY source),
far AS (SELECT d.source, avg(CASE WHEN s1 > 0 AND abs(doc_id - m1) / s1 > 3 THEN 1.0 ELSE 0.0 END) AS o1,
    avg(CASE WHEN s2 > 0 AND abs(n_chars - m2) / s2 > 3 THEN 1.0 ELSE 0.0 END) AS o2
  FROM documents d JOIN moments m ON d.source = m.source GROUP BY d.source),
scores AS (SELECT b.source, completeness, consistency, validity,
    0.7 * d / n + 0.3 * text_uniqueness AS uniqueness, 1.0 AS timeliness, 1.0 AS integrity,
    (1 - o1 + 1 - o2 + q_text + q_lang) / 4 AS accuracy
  FROM basic b JOIN rows_of r ON b.source = r.source JOIN far f ON b.source = f.source),
profile AS (SELECT *, {weights} AS overall_score FROM scores),
{VERDICT}
SELECT source, {ROUNDED_PROFILE}, issues, passed FROM verdict"""


def report_lines_sql() -> str:
    heads = ["'=== Data Quality Report ==='", "''", "'Dataset: documents'", "'Timestamp: 20240131_000000'",
             "'Overall Status: ' || CASE WHEN passed THEN 'PASSED' ELSE 'FAILED' END",
             f"'Overall Score: ' || {two_decimals('overall_score')}", "''", "'--- Quality Metrics ---'"]
    heads += [f"'{d.capitalize()}: ' || {two_decimals(d)}" for d in DIMENSIONS]
    issues = f"""CASE WHEN issues <> '' THEN ['', '--- Issues Found ---'] ||
      list_transform(string_split(issues, {JOINER}), lambda i: '- ' || i) ELSE [] END"""
    tail = """['', '--- Dataset Statistics ---', 'Rows: ' || (SELECT count(*) FROM seeded), 'Columns: 8']"""
    return f"""{SEEDED_PROFILE}, {VERDICT},
lines AS (SELECT [{', '.join(heads)}] || ({issues}) || {tail} AS l FROM verdict)
SELECT unnest(range(0, len(l))) AS line_no, unnest(l) AS line FROM lines"""


SUMMARY = f"""
SELECT s.doc_id, CASE WHEN s.text IS NOT NULL THEN coalesce(n.n_entities, 0) END AS n_entities,
  round(f.score, 6) AS sentiment_score,
  CASE WHEN s.text IS NOT NULL THEN {FEELING_LABEL.replace('score', 'f.score')} END AS sentiment_label,
  CASE WHEN s.text IS NOT NULL THEN coalesce(t.n_topics, 0) END AS n_topics,
  CASE WHEN s.text IS NOT NULL THEN <language> END AS language, {is_instruction('s.text')} AS is_instruction,
  {commands('s.text')} AS command_words<more>
FROM seeded s LEFT JOIN feeling f ON s.doc_id = f.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n_entities FROM entity GROUP BY doc_id) n ON s.doc_id = n.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n_topics FROM topic GROUP BY doc_id) t ON s.doc_id = t.doc_id
<joins>"""


def summary(language: str, more: str = "", joins: str = "") -> str:
    return SUMMARY.replace("<language>", language).replace("<more>", more).replace("<joins>", joins)


IN_ROW_CTES = f"{entity_ctes('seeded', 'doc_id')}, {TOPIC_CTES}, {SENTIMENT_CTES}"

INTEGRITY = """SELECT 'documents' AS child, 'doc_id' AS "column",
        round(avg(CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 1.0 ELSE 0.0 END), 6) AS found_share FROM documents
      UNION ALL SELECT 'events', 'user_id',
        round(avg(CASE WHEN user_id IN (SELECT c_custkey FROM customer) THEN 1.0 ELSE 0.0 END), 6) FROM events
      UNION ALL SELECT 'events', 'event_id', 1.0"""

ORACLES = {
    "src_list_datasets": """SELECT 'docs.csv' AS name, 'csv' AS extension, count(*) > 0 AS filled FROM documents
      UNION ALL SELECT 'talks.jsonl', 'jsonl', count(*) > 0 FROM conversations""",
    "src_csv_scan": f"SELECT doc_id, {not_na('text')}, {not_na('lang')}, {not_na('source')}, n_chars FROM documents",
    "src_csv_multi_line": f"SELECT doc_id, {not_na('text')}, {not_na('lang')}, {not_na('source')}, n_chars FROM documents",
    "src_json_scan": "SELECT conv_id, turn, role, text FROM conversations",
    "src_read_dataset": """SELECT format, CASE WHEN format <> 'txt' THEN conv_id END AS conv_id,
      CASE WHEN format <> 'txt' THEN turn END AS turn, role, CASE WHEN format <> 'txt' THEN text END AS text
      FROM conversations, (VALUES ('csv'), ('json'), ('jsonl'), ('parquet'), ('txt')) AS v(format)""",
    "src_text_columns": f"WITH {SEEDED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(length({c})), 6) AS average_length, avg(length({c})) > 10 AS is_text FROM seeded"
        for c in SEEDED_RELATION.text
    ),
    "snk_processed": f"""{CLEAN_CTES} SELECT doc_id, text_cleaned, len(parts) AS n_annotations,
      array_to_string(list_transform(parts, lambda s: array_to_string({tokens('s')}, ' ')), {JOINER}) AS tokens
      FROM processed""",
    "end_to_end": f"{CLEAN_CTES} SELECT doc_id, text_cleaned, len(parts) AS n_annotations FROM processed",
    "column_metrics": f"""{CLEAN_CTES},
      triple AS (SELECT text AS o, text_cleaned AS c, len(parts) > 0 AS h FROM processed)
      SELECT 'text' AS "column", round((count(o) + 2 * count(*)) / (3 * count(*)), 6) AS completeness,
        round(((1 - stddev_samp(length(o)) / avg(length(o))) + (1 - stddev_samp(length(c)) / avg(length(c)))) / 2, 6) AS consistency,
        round((count(o) + 2 * count(*)) / (3 * count(*)), 6) AS validity,
        round((SELECT count(*) FROM (SELECT DISTINCT o, c, h FROM triple)) / count(*), 6) AS uniqueness FROM triple""",
    "snk_annotated": f"""WITH {SEEDED}, {entity_ctes('seeded', 'doc_id', FIXED_REGIONS)}, {SENTIMENT_CTES},
      {keyword_ctes(False)}
      SELECT format, s.doc_id, CASE WHEN s.text IS NOT NULL THEN {FEELING_LABEL.replace('score', 'f.score')} END AS sentiment,
        CASE WHEN s.text IS NOT NULL THEN coalesce(n.n_entities, 0) END AS n_entities,
        {is_instruction('s.text')} AS is_instruction, coalesce(k.n_keywords, 0) AS n_keywords
      FROM seeded s CROSS JOIN (VALUES ('json'), ('jsonl')) AS v(format) LEFT JOIN feeling f ON s.doc_id = f.doc_id
      LEFT JOIN (SELECT doc_id, count(*) AS n_entities FROM entity GROUP BY doc_id) n ON s.doc_id = n.doc_id
      LEFT JOIN (SELECT doc_id, count(*) AS n_keywords FROM keyword GROUP BY doc_id) k ON s.doc_id = k.doc_id""",
    "quality_report": f"""{SEEDED_PROFILE}, {VERDICT}
      SELECT 'documents' AS dataset, '20240131_000000' AS timestamp, passed, issues, {ROUNDED_PROFILE},
        (SELECT count(*) FROM seeded) AS n_rows, 8::BIGINT AS n_columns FROM verdict""",
    "quality_report_text": report_lines_sql(),
    "dataset_stats": "SELECT count(*) AS n_rows, 5::BIGINT AS n_columns, 'doc_id,lang,n_chars,source,text' AS column_names FROM documents",
    "clean_boilerplate": step(boilerplate("text")),
    "clean_signature": step(signature("text")),
    "clean_blank_lines": step(blank_lines("text")),
    "clean_spacing": step(spacing("text")),
    "clean_control_chars": step(control("text")),
    "clean_quotes": step(quotes("text")),
    "clean_batch": f"{CLEAN_CTES} SELECT doc_id, text FROM judged WHERE ok",
    "stream_clean": f"{CLEAN_CTES} SELECT doc_id, text, {is_instruction('text')} AS is_instruction FROM judged WHERE ok",
    "clean_aligned": f"{CLEAN_CTES} SELECT doc_id, text_cleaned FROM aligned",
    "gate_length": f"WITH {SEEDED} SELECT doc_id, coalesce(length(text) BETWEEN 20 AND 1000, false) AS accepted FROM seeded",
    "gate_words": f"WITH {SEEDED} SELECT doc_id, coalesce(len({ws_words('text')}) >= 3, false) AS accepted FROM seeded",
    "gate_entity_density": f"""WITH {SEEDED}, {has_entity_ctes('seeded', 'doc_id')}
      SELECT s.doc_id, coalesce(e.doc_id IS NOT NULL OR len({tokens('s.text')}) <= 50, false) AS accepted
      FROM seeded s LEFT JOIN entity_docs e ON s.doc_id = e.doc_id""",
    "gate_quality": f"""WITH {SEEDED}, {has_entity_ctes('seeded', 'doc_id')}
      SELECT s.doc_id, {accepted('s.text', 'e.doc_id IS NOT NULL')} AS accepted
      FROM seeded s LEFT JOIN entity_docs e ON s.doc_id = e.doc_id""",
    "batch_gate": f"""WITH {SEEDED}, gates AS (
      SELECT 'customer' AS dataset, count(*) AS n, ({Relation('customer', ['c_name', 'c_mktsegment'], ['c_custkey']).completeness()}
        + {Relation('customer', ['c_name', 'c_mktsegment'], ['c_custkey']).gate_consistency()}
        + {Relation('customer', ['c_name', 'c_mktsegment'], ['c_custkey']).gate_validity()}
        + {Relation('customer', ['c_name', 'c_mktsegment'], ['c_custkey']).row_uniqueness()}) / 4 AS overall FROM customer
      UNION ALL SELECT 'seeded', count(*), ({SEEDED_RELATION.completeness()} + {SEEDED_RELATION.gate_consistency()}
        + {SEEDED_RELATION.gate_validity()} + {SEEDED_RELATION.row_uniqueness()}) / 4 FROM seeded)
      SELECT dataset, CASE WHEN overall >= 0.8 THEN n ELSE 0 END AS n_rows FROM gates""",
    "bg_completeness": one(SEEDED_RELATION.completeness(), "completeness", "seeded", f"WITH {SEEDED}"),
    "bg_consistency": one(SEEDED_RELATION.gate_consistency(), "consistency", "seeded", f"WITH {SEEDED}"),
    "bg_validity": one(SEEDED_RELATION.gate_validity(), "validity", "seeded", f"WITH {SEEDED}"),
    "bg_uniqueness": f"WITH {SEEDED} SELECT round({SEEDED_RELATION.row_uniqueness()}, 6) AS uniqueness",
    "q_completeness": one(SEEDED_RELATION.completeness(), "completeness", "seeded", f"WITH {SEEDED}"),
    "q_consistency": one(SEEDED_RELATION.consistency(), "consistency", "seeded", f"WITH {SEEDED}"),
    "q_validity": one(SEEDED_RELATION.validity(), "validity", "seeded", f"WITH {SEEDED}"),
    "q_row_uniqueness": """SELECT round((SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents))
      / count(*), 6) AS row_uniqueness FROM documents""",
    "q_row_uniqueness_nested": """WITH shown AS (SELECT doc_id % 2 AS side,
        CASE WHEN doc_id % 3 <> 0 THEN coalesce('=' || lang, '-') ELSE '-' END AS l, lang, source FROM documents)
      SELECT round((SELECT count(*) FROM (SELECT DISTINCT CASE side WHEN 0 THEN [l, '=x'] ELSE ['=x', l] END, l, lang, source
        FROM shown)) / count(*), 6) AS row_uniqueness FROM documents""",
    "q_text_uniqueness": one(SEEDED_RELATION.text_uniqueness(), "text_uniqueness", "seeded", f"WITH {SEEDED}"),
    "q_uniqueness": f"SELECT round({DOC_RELATION.uniqueness()}, 6) AS uniqueness",
    "q_text_uniqueness_sketch": """SELECT source, count(*) AS n_rows, true AS within_error FROM documents GROUP BY source
      UNION ALL SELECT 'all', count(*), true FROM documents""",
    "q_unreadable_times": f"""WITH {SEEDED} SELECT source, count(end_date) AS n_filled,
      count(*) FILTER (end_date IS NOT NULL AND try_cast(end_date AS DATE) IS NULL) AS n_unreadable FROM seeded GROUP BY source""",
    "q_timeliness": one(FRESHNESS, "timeliness", "events"),
    "q_integrity": INTEGRITY,
    "q_integrity_filtered": INTEGRITY,
    "q_orphans_filtered": """SELECT 'documents' AS child, doc_id AS value, count(*) AS n FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id
      UNION ALL SELECT 'lineitem', l_orderkey, count(*) FROM lineitem
      WHERE l_orderkey NOT IN (SELECT doc_id FROM documents) GROUP BY l_orderkey""",
    "q_orphans": "SELECT doc_id AS value, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id",
    "q_outliers": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round({EVENT_RELATION.outlier_share(c)}, 6) AS outlier_share,"
        f" round(1 - {EVENT_RELATION.outlier_share(c)}, 6) AS score"
        for c in EVENT_RELATION.numeric
    ),
    "q_text_quality": f"""WITH {SEEDED}, {SEEDED_RUNS}
      SELECT doc_id, round(({text_quality('text', IN_RUNS['text'])})::DOUBLE, 6) AS score FROM seeded""",
    "q_accuracy": f"WITH {SEEDED}, {SEEDED_RUNS} SELECT round({SEEDED_RELATION.accuracy(IN_RUNS)}, 6) AS accuracy",
    "q_overall": profile_sql(
        EVENT_RELATION, "WITH", {}, FRESHNESS,
        "(1.0 + avg(CASE WHEN user_id IN (SELECT c_custkey FROM customer) THEN 1.0 ELSE 0.0 END)) / 2",
    ) + f"SELECT {ROUNDED_PROFILE} FROM profile",
    "q_validate": f"{SEEDED_PROFILE}, {VERDICT} SELECT {ROUNDED_PROFILE}, issues, passed FROM verdict",
    "q_validate_by_source": by_source(),
    "rule_special_chars": special_ctes(["text"]) + f"""
      SELECT "column", doc_id::VARCHAR AS row_key, 'High special character ratio (' || {two_decimals('ratio')}
        || ') in text: ' || substr(text, 1, 50) || '...' AS message FROM ratios WHERE ratio > 0.3""",
    "rule_special_chars_stats": special_ctes(SEEDED_RELATION.text) + """
      SELECT "column", round(avg(ratio), 6) AS avg_ratio, round(max(ratio), 6) AS max_ratio,
        count(*) FILTER (ratio > 0.3) AS violations FROM ratios GROUP BY "column" """,
    "rule_language": f"""{LANGUAGE_RULE}
      SELECT 'text' AS "column", doc_id::VARCHAR AS row_key, 'Text detected as ' || language || ' (confidence: '
        || {two_decimals('confidence')} || '): ' || substr(text, 1, 50) || '...' AS message FROM detected WHERE {FOREIGN}
      UNION ALL SELECT 'text', NULL, 'Column text has low primary language ratio: ' || {two_decimals('r')}
      FROM (SELECT avg(CASE WHEN language = 'en' THEN 1.0 ELSE 0.0 END) AS r FROM detected) WHERE r < 0.8""",
    "rule_language_stats": f"""{LANGUAGE_RULE}
      SELECT 'text' AS "column", round(avg(CASE WHEN language = 'en' THEN 1.0 ELSE 0.0 END), 6) AS primary_language_ratio,
        string_agg(DISTINCT language, ',' ORDER BY language) AS detected_languages,
        count(*) FILTER ({FOREIGN}) AS violations FROM detected""",
    "rule_format": f"""{INVALID} SELECT "column", 'Column ' || "column" || ' (' || format_type || ') has ' || count(*)
      || ' invalid format values' AS message FROM invalid GROUP BY "column", format_type""",
    "rule_format_examples": f"""{INVALID} SELECT "column", format_type, position, value FROM (
      SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY doc_id, value) AS position FROM invalid) WHERE position <= 5""",
    "rule_format_custom": r"""SELECT 'url' AS "column", 'url' AS format_type, count(*) AS invalid_count FROM pages
      WHERE contains(url, '?') OR NOT regexp_matches(url, '^https?://') HAVING count(*) > 0""",
    "rule_cross_field": """WITH joined AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
      SELECT 'o_orderdate+l_shipdate' AS "column", 'Found ' || count(*) || ' violations of: ordered after shipping' AS message
      FROM joined WHERE o_orderdate > l_shipdate HAVING count(*) > 0
      UNION ALL SELECT 'l_quantity', 'Found ' || count(*) || ' violations of: quantity above 49'
      FROM joined WHERE l_quantity > 49 HAVING count(*) > 0
      UNION ALL SELECT 'o_orderdate+o_paydate', 'Missing required fields for validation: [''o_paydate'']'
      UNION ALL SELECT 'l_quantity', 'Validation failed for fields [''l_quantity'']: no rates today'""",
    "rule_date_order": f"""{DATES} SELECT count(*) FILTER (s > e) AS start_after_end,
      count(*) FILTER ((start_date IS NOT NULL AND s IS NULL) OR (end_date IS NOT NULL AND e IS NULL)) AS unparsable,
      count(*) FILTER (s > e) = 0 AND count(*) FILTER ((start_date IS NOT NULL AND s IS NULL)
        OR (end_date IS NOT NULL AND e IS NULL)) = 0 AS passed FROM dates""",
    "ann_tokens": f"""WITH {SEEDED} SELECT doc_id, len({tokens('text')}) AS n_tokens,
      array_to_string({tokens('text')}, {JOINER}) AS tokens FROM seeded""",
    "ann_token_offsets": f"""WITH {SEEDED},
      cut AS (SELECT doc_id, {pieces('text')} AS p FROM seeded WHERE text IS NOT NULL),
      piece AS (SELECT doc_id, unnest(p) AS piece, unnest(range(0, len(p))) AS ix FROM cut),
      placed AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY ix ROWS UNBOUNDED PRECEDING) AS stop FROM piece)
      SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ix) - 1 AS position, piece AS token,
        (stop - length(piece))::BIGINT AS start_pos, stop::BIGINT AS end_pos
      FROM placed WHERE NOT regexp_matches(piece, '^[{WS}]')""",
    "ann_sentences": f"{SENTENCE_SOURCE} SELECT doc_id, position, text AS sentence FROM sentence",
    "ann_pos_tags": f"""WITH {SEEDED}, tok AS (SELECT doc_id, lower(unnest({tokens('text')})) AS t FROM seeded)
      SELECT doc_id, CASE WHEN t IN ({quoted(TAGS['NOUN'])}) THEN 'NOUN' WHEN t IN ({quoted(TAGS['ADJ'])}) THEN 'ADJ'
        ELSE 'X' END AS pos, count(*) AS n FROM tok GROUP BY ALL""",
    "ann_a_text": linguistic("seeded", "doc_id", f"WITH {SEEDED}"),
    "ann_a_sentences": linguistic("sentence", "doc_id, position", SENTENCE_SOURCE.rstrip()),
    "ann_entities": f"""WITH {SEEDED}, {entity_ctes('seeded', 'doc_id')}
      SELECT doc_id, text, label, start_pos::BIGINT AS start_pos, end_pos::BIGINT AS end_pos FROM entity""",
    "ann_sentiment": f"""WITH {SEEDED}, {SENTIMENT_CTES} SELECT s.doc_id, round(score, 6) AS score,
      CASE WHEN score IS NOT NULL THEN {FEELING_LABEL} END AS label
      FROM seeded s LEFT JOIN feeling f ON s.doc_id = f.doc_id""",
    "ann_entities_large": f"""WITH {SEEDED}, {entity_ctes('seeded', 'doc_id', phrases_sql=LARGE_PHRASES)}
      SELECT doc_id, text, label, start_pos::BIGINT AS start_pos, end_pos::BIGINT AS end_pos FROM entity""",
    "gate_quality_large": f"{LARGE_CLEAN_CTES} SELECT doc_id, text_cleaned FROM aligned",
    "ann_sentiment_large": f"""WITH {SEEDED},
      lexicon AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{{9,}}'))) AS word FROM documents),
      used AS (SELECT doc_id, unnest({words('lower(text)')}) AS word FROM seeded WHERE text IS NOT NULL),
      sums AS (SELECT doc_id, sum(length(word) % 11 - 5) AS total, sum(abs(length(word) % 11 - 5)) AS size
        FROM used JOIN lexicon USING (word) GROUP BY doc_id),
      scores AS (SELECT s.doc_id, CASE WHEN s.text IS NOT NULL THEN coalesce(total / nullif(size, 0), 0.0) END AS score
        FROM seeded s LEFT JOIN sums ON s.doc_id = sums.doc_id)
      SELECT doc_id, round(score, 6) AS score, CASE WHEN score IS NOT NULL THEN {FEELING_LABEL} END AS label FROM scores""",
    "ann_sentiment_ml": f"""WITH {SEEDED} SELECT doc_id, text IS NULL AS is_null, true AS in_range, true AS label_fits,
      true AS model_agrees FROM seeded""",
    "ann_own_annotator": f"""WITH {SEEDED} SELECT doc_id, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines,
      length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, {is_instruction('text')} AS is_instruction FROM seeded""",
    "rule_own": f"""WITH {SEEDED}, loud AS (SELECT doc_id FROM seeded
        WHERE length(regexp_replace(text, '[^A-Z]', '', 'g')) / nullif(length(text), 0) > 0.05)
      SELECT 'Shouting' AS rule, 'text' AS "column", doc_id::VARCHAR AS row_key, 'Too many capitals' AS message FROM loud
      UNION ALL SELECT 'Shouting', 'text', NULL, 'violations: ' || count(*) FROM loud""",
    "ann_topics": f"""WITH {SEEDED}, {entity_ctes('seeded', 'doc_id')}, {TOPIC_CTES}
      SELECT doc_id, position, topic FROM topic""",
    "ann_topics_ranked": f"""WITH {SEEDED}, cut AS (SELECT doc_id, {pieces('text')} AS p FROM seeded WHERE text IS NOT NULL),
      {PHRASE_TEXT},
      phrase AS (SELECT doc_id, unnest(runs) AS topic, unnest(range(0, len(runs))) AS ix FROM phrase_text),
      parts AS (SELECT lower(topic) AS folded, {words('lower(topic)')} AS ws FROM phrase),
      used AS (SELECT len(ws) AS size, unnest(ws) AS word FROM parts),
      word_score AS (SELECT word, sum(size)::BIGINT * 1000000 // count(*) AS score FROM used GROUP BY word),
      different AS (SELECT DISTINCT folded, ws FROM parts),
      of_phrase AS (SELECT folded, unnest(ws) AS word FROM different),
      phrase_score AS (SELECT folded, sum(score)::BIGINT / 1000000.0::DOUBLE AS score FROM of_phrase JOIN word_score USING (word) GROUP BY folded),
      firsts AS (SELECT * FROM phrase QUALIFY row_number() OVER (PARTITION BY doc_id, lower(topic) ORDER BY ix) = 1)
      SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ix) - 1 AS position, topic,
        row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ix) AS rank, score
      FROM firsts JOIN phrase_score ON lower(topic) = folded""",
    "ann_keywords": f"WITH {SEEDED}, {keyword_ctes(False)} SELECT doc_id, rank, text, pos, round(score, 6) AS score FROM keyword",
    "ann_keywords_tagged": f"WITH {SEEDED}, {keyword_ctes(True)} SELECT doc_id, rank, text, pos, round(score, 6) AS score FROM keyword",
    "lang_id": f"""{DOC_LANGUAGE} SELECT d.doc_id, b.language, coalesce(round(b.confidence, 6), 0.0) AS confidence
      FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id""",
    "ann_language": f"""{LANGUAGE_CTES}, {gram_cte('talk', 'conversations', 'conv_id, turn')},
      talk_keys AS (SELECT * FROM talk), {detect_ctes('talk', 'conv_id, turn')}
      SELECT c.conv_id, c.turn, b.language, coalesce(round(b.confidence, 6), 0.0) AS confidence
      FROM conversations c LEFT JOIN best b ON c.conv_id = b.conv_id AND c.turn = b.turn""",
    "ann_instruction": f"""WITH {SEEDED} SELECT doc_id, {is_instruction('text')} AS is_instruction,
      contains(text, '?') AS has_question_mark FROM seeded""",
    "ann_command_words": f"WITH {SEEDED} SELECT doc_id, {commands('text')} AS command_words FROM seeded",
    "annotate_text": f"WITH {SEEDED}, {IN_ROW_CTES}" + summary("'en'"),
    "annotate_batch": f"{LANGUAGE_CTES}, {SEEDED}, {SEEDED_GRAMS}, grams_keys AS (SELECT * FROM grams), "
    f"{detect_ctes('grams', 'doc_id')}, {IN_ROW_CTES}, {keyword_ctes(False)}"
    + summary(
        language="b.language",
        more=", CASE WHEN s.text IS NOT NULL THEN coalesce(k.keywords, '') END AS keywords",
        joins=f"""LEFT JOIN best b ON s.doc_id = b.doc_id
LEFT JOIN (SELECT doc_id, string_agg(text, {JOINER} ORDER BY rank) AS keywords FROM keyword GROUP BY doc_id) k ON s.doc_id = k.doc_id""",
    ),
    "corpus_overview": f"""WITH base AS (SELECT doc_id, source, {cleaned('text')} AS text FROM documents),
      {has_entity_ctes('base', 'doc_id')},
      judged AS (SELECT b.source, CASE WHEN {accepted('b.text', 'e.doc_id IS NOT NULL')} THEN b.text ELSE '' END AS t
        FROM base b LEFT JOIN entity_docs e ON b.doc_id = e.doc_id)
      SELECT source, count(*) AS n_rows, count(*) FILTER (t <> '') AS n_accepted,
        round(avg(CASE WHEN t <> '' THEN 1.0 ELSE 0.0 END), 6) AS accepted_share, sum(length(t))::BIGINT AS chars,
        round(coalesce(greatest(0.0, 1 - stddev_samp(length(t)) / nullif(avg(length(t)), 0)), 0.0), 6) AS length_consistency
      FROM judged GROUP BY source""",
}
