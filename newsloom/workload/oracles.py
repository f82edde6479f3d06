"""The same queries as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from newsloom.functions.parse import WS
from newsloom.functions.text import TERM_WORD, TOKEN, WORD
from newsloom.workload import fixture as fx


def q(text: str) -> str:
    return text.replace("'", "''")


def values(name: str, columns: str, rows) -> str:
    def one(v):
        return "NULL" if v is None else f"'{q(v)}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


ARTICLES = """articles AS (
  SELECT d.doc_id, d.doc_id AS _seq,
   'https://news.example/item/' || CAST(CAST(floor(d.doc_id / 3) AS BIGINT) AS VARCHAR) AS url,
   CASE WHEN d.doc_id % 3 = 0 THEN 'alpha' ELSE 'beta' END AS data_source,
   split_part(d.text, chr(10), 1) AS title,
   nullif(substr(d.text, length(split_part(d.text, chr(10), 1)) + 2), '') AS description,
   d.source, d.lang, e.ts AS datetime, e.event_type, e.user_id,
   '["' || e.event_type || '"]' AS search_terms,
   '[{"ticker":"CRYPTO:' || upper(e.event_type) || '","ticker_sentiment_score":"'
     || CAST(d.doc_id % 201 - 100 AS VARCHAR) || '"},{"ticker":"FOREX:U'
     || CAST(e.user_id % 5 AS VARCHAR) || '","ticker_sentiment_score":"'
     || CAST(d.doc_id % 37 AS VARCHAR) || '"}]' AS ticker_sentiment
  FROM documents d JOIN events e ON e.event_id = d.doc_id)"""


def on_articles(sql: str, *ctes: str) -> str:
    return "WITH " + ", ".join([ARTICLES, *ctes]) + " " + sql


TERMS = values(
    "terms", "word, v, b, n",
    [
        (w, fx.LEXICON.valence.get(w), fx.LEXICON.boosters.get(w), "y" if w in fx.LEXICON.negations else None)
        for w in sorted({*fx.LEXICON.valence, *fx.LEXICON.boosters, *fx.LEXICON.negations})
    ],
)
STOP = values("stop", "word", [(w,) for w in fx.LEXICON.stopwords])
BASE = values("base", "word, form", sorted(fx.LEXICON.base_forms.items()))


def tokens_cte(name: str, source: str, key: str, text: str) -> str:
    """Cleaned tokens of a text, one per row."""
    return f"""{name} AS (
      SELECT t.{key}, t.pos, coalesce(base.form, t.tok) AS tok FROM (
        SELECT {key}, unnest(l) AS tok, generate_subscripts(l, 1) AS pos FROM (
          SELECT {key}, regexp_extract_all(
            replace(lower(coalesce({text}, '')), 'n''t', ' n''t '), '{q(TOKEN)}') AS l
          FROM {source})) t
      LEFT JOIN base ON base.word = t.tok
      WHERE t.tok NOT IN (SELECT word FROM stop))"""


def score_ctes(name: str, source: str, key: str, text: str) -> list[str]:
    """Table ``name`` with the compound score of a text per key."""
    steps = []
    for d, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
        prev = "x0" if d == 1 else f"x{d - 1}"
        steps.append(
            f"""{name}_s{d} AS (SELECT *, CASE WHEN v{d} IS NULL THEN
              ({prev} + coalesce(b{d} * {damp} * CASE WHEN {prev} < 0 THEN -1 ELSE 1 END, 0))
              * CASE WHEN n{d} IS NOT NULL THEN -0.74 ELSE 1 END ELSE {prev} END AS x{d}
              FROM {name}_{'w' if d == 1 else f's{d - 1}'})"""
        )
    lags = ", ".join(f"lag({c}, {d}) OVER o AS {c}{d}" for d in (1, 2, 3) for c in "vbn")
    return [
        tokens_cte(f"{name}_t", source, key, text),
        f"""{name}_w AS (SELECT {key}, v AS x0, b, {lags} FROM (
              SELECT t.{key}, t.pos, CAST(terms.v AS DOUBLE) AS v, CAST(terms.b AS DOUBLE) AS b, terms.n
              FROM {name}_t t LEFT JOIN terms ON terms.word = t.tok WHERE length(t.tok) > 1)
            WINDOW o AS (PARTITION BY {key} ORDER BY pos))""",
        *steps,
        f"""{name}_sum AS (SELECT {key}, round(sum(x3), 9) AS s FROM {name}_s3
              WHERE x0 IS NOT NULL AND b IS NULL GROUP BY {key})""",
        f"""{name}_marks AS (SELECT {key},
              least(count(*) FILTER (WHERE tok = '!'), 4) * 0.292::DOUBLE
              + CASE WHEN count(*) FILTER (WHERE tok = '?') > 3 THEN 0.96::DOUBLE
                     WHEN count(*) FILTER (WHERE tok = '?') > 1
                     THEN count(*) FILTER (WHERE tok = '?') * 0.18::DOUBLE ELSE 0::DOUBLE END AS e
              FROM {name}_t GROUP BY {key})""",
        f"""{name} AS (SELECT {key}, round(r / sqrt(r * r + 15), 4) AS score FROM (
              SELECT src.{key}, coalesce(s, 0) + sign(coalesce(s, 0)) * coalesce(e, 0) AS r
              FROM {source} src LEFT JOIN {name}_sum USING ({key}) LEFT JOIN {name}_marks USING ({key})))""",
    ]


def rules_sql() -> str:
    """The compound score of documents with the rules on several words."""
    lex = fx.RULES_LEXICON
    words = sorted({*lex.valence, *lex.boosters, *lex.negations})
    lags = [f"lag({c}, {d}) OVER o AS {c}{d}" for d in (1, 2, 3) for c in ("v", "b", "n", "tok")]
    lags += [f"lead(tok, {d}) OVER o AS ahead{d}" for d in (1, 2)] + ["row_number() OVER o AS rn", "min(CASE WHEN tok = 'but' THEN pos END) OVER (PARTITION BY doc_id) AS but"]
    factors = {
        1: "CASE WHEN n1 IS NOT NULL THEN -0.74 ELSE 1 END",
        2: "CASE WHEN tok2 = 'never' AND tok1 IN ('so', 'this') THEN 1.5 WHEN n2 IS NOT NULL THEN -0.74 ELSE 1 END",
        3: """CASE WHEN (tok3 = 'never' AND tok2 IN ('so', 'this')) OR tok1 IN ('so', 'this') THEN 1.25
                WHEN n3 IS NOT NULL THEN -0.74 ELSE 1 END""",
    }
    steps = [
        f"""s{d} AS (SELECT *, CASE WHEN rn > {d} AND v{d} IS NULL THEN (x{d - 1} + coalesce(b{d} * {damp}, 0)
              * CASE WHEN x{d - 1} < 0 THEN -1 ELSE 1 END) * {factors[d]} ELSE x{d - 1} END AS x{d} FROM s{d - 1})"""
        for d, damp in ((1, 1.0), (2, 0.95), (3, 0.9))
    ]
    phrases = ["tok || ' ' || ahead1 || ' ' || ahead2", "tok || ' ' || ahead1", "tok1 || ' ' || tok", "tok2 || ' ' || tok1 || ' ' || tok",
               "tok2 || ' ' || tok1", "tok3 || ' ' || tok2 || ' ' || tok1", "tok3 || ' ' || tok2"]
    found = ", ".join(f"(SELECT valence FROM idioms WHERE phrase = {x})" for x in phrases)
    return "WITH " + ", ".join([
        values("terms", "word, v, b, n", [(w, lex.valence.get(w), lex.boosters.get(w), "y" if w in lex.negations else None) for w in words]),
        values("stop", "word", [(w,) for w in lex.stopwords]),
        values("base", "word, form", sorted(lex.base_forms.items())),
        values("idioms", "phrase, valence", sorted(lex.idioms.items())),
        tokens_cte("t", "documents", "doc_id", "text"),
        f"""s0 AS (SELECT doc_id, pos, tok, v, v AS x0, b, {', '.join(lags)} FROM (
              SELECT t.doc_id, t.pos, t.tok, CAST(terms.v AS DOUBLE) AS v, CAST(terms.b AS DOUBLE) AS b, terms.n
              FROM t LEFT JOIN terms ON terms.word = t.tok WHERE length(t.tok) > 1) WINDOW o AS (PARTITION BY doc_id ORDER BY pos))""",
        *steps,
        "scored AS (SELECT * FROM s3 WHERE v IS NOT NULL AND b IS NULL)",
        f"idiom AS (SELECT *, CASE WHEN rn > 3 AND v3 IS NULL THEN coalesce({found}, x3) ELSE x3 END AS x4 FROM scored)",
        """weak AS (SELECT *, CASE WHEN rn > 3 AND v3 IS NULL AND (tok3 || ' ' || tok2 = 'sort of' OR tok2 || ' ' || tok1 = 'sort of')
              THEN x4 - 0.293 ELSE x4 END AS x5 FROM idiom)""",
        """least AS (SELECT *, CASE WHEN tok1 = 'least' AND v1 IS NULL AND (rn <= 2 OR tok2 NOT IN ('at', 'very'))
              THEN x5 * -0.74 ELSE x5 END AS x6 FROM weak)""",
        """sums AS (SELECT doc_id, round(sum(x6 * CASE WHEN but IS NULL OR pos = but THEN 1 WHEN pos < but THEN 0.5 ELSE 1.5 END), 9) AS s
              FROM least GROUP BY doc_id)""",
        """marks AS (SELECT doc_id, least(count(*) FILTER (WHERE tok = '!'), 4) * 0.292::DOUBLE
              + CASE WHEN count(*) FILTER (WHERE tok = '?') > 3 THEN 0.96::DOUBLE WHEN count(*) FILTER (WHERE tok = '?') > 1
                  THEN count(*) FILTER (WHERE tok = '?') * 0.18::DOUBLE ELSE 0::DOUBLE END AS e FROM t GROUP BY doc_id)""",
    ]) + """ SELECT doc_id, round(r / sqrt(r * r + 15), 4) AS score FROM (
        SELECT doc_id, coalesce(s, 0) + sign(coalesce(s, 0)) * coalesce(e, 0) AS r
        FROM documents LEFT JOIN sums USING (doc_id) LEFT JOIN marks USING (doc_id))"""


def article_ctes(name: str, source: str, key: str) -> list[str]:
    """Table ``name`` with the article score of title and description per key."""
    return [
        *score_ctes(f"{name}_title", source, key, "title"),
        *score_ctes(f"{name}_desc", source, key, "description"),
        f"""{name} AS (SELECT {key}, CASE WHEN t.score <> 0 AND d.score <> 0 THEN (t.score + d.score) / 2
              WHEN t.score <> 0 THEN t.score WHEN d.score <> 0 THEN d.score ELSE 0 END AS score
              FROM {name}_title t JOIN {name}_desc d USING ({key}))""",
    ]


def label(score: str) -> str:
    return f"CASE WHEN {score} >= 0.05 THEN 'Positive' WHEN {score} <= -0.05 THEN 'Negative' ELSE 'Neutral' END"


def sentences_cte(name: str, source: str, key: str, text: str) -> str:
    parts = (
        f"string_split(regexp_replace(regexp_replace(coalesce({text}, ''), '^{WS}+|{WS}+$', '', 'g'), "
        f"'([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1))"
    )
    return f"""{name} AS (SELECT {key}, sentence, pos - 1 AS pos FROM (
        SELECT {key}, unnest(l) AS sentence, generate_subscripts(l, 1) AS pos FROM (
          SELECT {key}, list_filter(list_transform({parts},
            lambda s: regexp_replace(s, '^{WS}+|{WS}+$', '', 'g')), lambda s: s <> '') AS l
          FROM {source})))"""


def greedy_ctes(name: str, rows: str, key: str, near: str) -> list[str]:
    """Greedy walk over ``rows`` (key, rn from 1) given the pairs ``near`` (key, rn, earlier)."""
    return [
        f"{name}_n AS (SELECT {key}, rn, list(earlier) AS earlier FROM {near} GROUP BY {key}, rn)",
        f"{name}_r AS (SELECT r.{key}, r.rn, n.earlier FROM {rows} r LEFT JOIN {name}_n n USING ({key}, rn))",
        f"""{name} AS (
          SELECT {key}, CAST(1 AS BIGINT) AS rn, [CAST(1 AS BIGINT)] AS kept FROM {name}_r WHERE rn = 1
          UNION ALL
          SELECT w.{key}, r.rn, CASE WHEN r.earlier IS NOT NULL AND list_has_any(r.earlier, w.kept)
            THEN w.kept ELSE list_append(w.kept, r.rn) END
          FROM {name} w JOIN {name}_r r ON r.{key} = w.{key} AND r.rn = w.rn + 1)""",
    ]


def semantic_ctes(name: str, source: str, key: str) -> list[str]:
    """Table ``name`` (key, description, removed) for the sentences of the rows of ``source``."""
    return [
        sentences_cte(f"{name}_s", source, key, "description"),
        f"{name}_rows AS (SELECT *, CAST(pos + 1 AS BIGINT) AS rn FROM {name}_s)",
        f"""{name}_v AS (SELECT {key}, rn, slot, CAST(count(*) AS DOUBLE) AS c FROM (
              SELECT {key}, rn, substr(md5(unnest(regexp_extract_all(lower(sentence),
                '{WORD}|[^\\s\\p{{L}}\\p{{N}}_]'))), 3, 2) AS slot FROM {name}_rows) GROUP BY ALL)""",
        f"{name}_l AS (SELECT {key}, rn, sum(c * c) AS len FROM {name}_v GROUP BY ALL)",
        f"""{name}_near AS (SELECT {key}, rn, earlier FROM (
              SELECT a.{key}, a.rn, b.rn AS earlier, sum(a.c * b.c) AS dot
              FROM {name}_v a JOIN {name}_v b ON a.{key} = b.{key} AND a.slot = b.slot AND b.rn < a.rn
              GROUP BY ALL) p
            JOIN {name}_l la USING ({key}, rn)
            JOIN (SELECT {key}, rn AS earlier, len AS len2 FROM {name}_l) lb USING ({key}, earlier)
            WHERE dot / sqrt(len * len2) >= 0.9)""",
        *greedy_ctes(f"{name}_w", f"{name}_rows", key, f"{name}_near"),
        f"""{name}_k AS (SELECT {key}, max_by(kept, rn) AS kept, max(rn) AS n FROM {name}_w GROUP BY {key})""",
        f"""{name} AS (SELECT r.{key}, string_agg(r.sentence, ' ' ORDER BY r.rn) AS description,
              max(k.n) - count(*) AS removed
            FROM {name}_rows r JOIN {name}_k k ON k.{key} = r.{key} AND list_contains(k.kept, r.rn)
            GROUP BY r.{key})""",
    ]


MESSY = """messy AS (SELECT doc_id, source, lang, doc_id % 9 AS kind FROM documents)"""

# Items of the messy lists, joined by |; {other} is the text for what is no list.
MESSY_ITEMS = """CASE kind WHEN 0 THEN source || '|' || lang WHEN 1 THEN source || '|' || lang
  WHEN 4 THEN CAST(doc_id AS VARCHAR) || '|2' WHEN 5 THEN 'None|True|' || source ELSE {other} END"""
MESSY_SIZE = "CAST(CASE kind WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 4 THEN 2 WHEN 5 THEN 3 ELSE {other} END AS BIGINT)"


def messy(other: str, size: str) -> str:
    return (
        f"WITH {MESSY} SELECT doc_id, {MESSY_ITEMS.format(other=other)} AS items, "
        f"{MESSY_SIZE.format(other=size)} AS n FROM messy"
    )


PLAIN = """CASE kind WHEN 2 THEN source WHEN 3 THEN {null} WHEN 6 THEN '[broken ' || lang
  WHEN 7 THEN '{{"source": "' || source || '"}}' ELSE {number} END"""

KIND_COUNTS = """SELECT kind, CAST(count(*) AS BIGINT) AS n,
  round(count(*) / sum(count(*)) OVER (), 6) AS share FROM kinds GROUP BY kind"""

PAGES = """pages_landed AS (SELECT DISTINCT lang AS term, CAST(floor(doc_id / 10) AS BIGINT) AS page
  FROM articles)"""

CALENDAR = """SELECT bucket, ticker, {score} AS score FROM
  (SELECT unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS bucket FROM
     (SELECT min(bucket) AS lo, max(bucket) AS hi FROM means))
  CROSS JOIN (SELECT DISTINCT ticker FROM means) LEFT JOIN means USING (bucket, ticker)"""


def means(unit: str, source: str) -> str:
    return (
        f"means AS (SELECT date_trunc('{unit}', datetime) AS bucket, ticker, avg(score) AS score "
        f"FROM {source} WHERE score IS NOT NULL GROUP BY ALL)"
    )


SCORED = """scored AS (SELECT datetime, event_type AS ticker,
  CASE WHEN doc_id % 11 > 0 THEN CAST(doc_id % 200 - 100 AS DOUBLE) / 100 END AS score FROM articles)"""
NESTED = """nested AS (
  SELECT datetime, upper(event_type) AS ticker, CAST(doc_id % 201 - 100 AS DOUBLE) AS score FROM articles
  UNION ALL
  SELECT datetime, 'U' || CAST(user_id % 5 AS VARCHAR), CAST(doc_id % 37 AS DOUBLE) FROM articles)"""
EVENT_MEANS = """means AS (SELECT date_trunc('hour', ts) AS bucket,
  event_type || CAST(user_id % 7 AS VARCHAR) AS ticker, avg(value) AS score FROM events GROUP BY ALL)"""

KEYWORD_ROWS = values(
    "keywords", "word, ticker", [(w, t.upper()) for t, ws in fx.KEYWORDS.items() for w in ws]
)
TAGS = f"""tags AS (SELECT doc_id, string_agg(DISTINCT ticker, '|' ORDER BY ticker) AS tickers FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(title), '{WORD}')) AS word FROM articles)
  JOIN keywords USING (word) GROUP BY doc_id)"""

ASKED = [t.strip() for t in fx.SEARCH.replace(" OR ", ",").replace(" AND ", ",").split(",")]
ASKED_ROWS = values("asked", "term, stem", [(t, fx.STEMS.get(t, t)) for t in ASKED])
STEM_ROWS = values("stems", "word, stem", sorted(fx.STEMS.items()))

FIRST_PER_URL = """firsts AS (SELECT * FROM {source} QUALIFY row_number() OVER
  (PARTITION BY url ORDER BY {order}) = 1)"""
TERMS_PER_URL = """all_terms AS (SELECT url, string_agg(DISTINCT event_type, '|' ORDER BY event_type)
  AS search_terms FROM articles GROUP BY url)"""

# Merged rows per URL: the best value of each column that is not null, and all descriptions.
BEST = """best AS (SELECT url,
  {columns}
  coalesce(string_agg(description, ' ' ORDER BY {seq}), '') AS description,
  count(description) > 1 AS was_merged FROM {source} GROUP BY url)"""


def best(source: str, columns: list[str], rank: str, seq: str) -> str:
    firsts = "".join(
        f"arg_min({c}, ({rank}, {seq})) FILTER (WHERE {c} IS NOT NULL) AS {c},\n  " for c in columns
    )
    return BEST.format(columns=firsts, seq=seq, source=source)


RANK = "CASE data_source WHEN 'alpha' THEN 1 WHEN 'beta' THEN 2 ELSE 999 END"

TRANSFORM_A = f"""SELECT a.title, a.url, strftime(a.datetime, '%Y%m%dT%H%M%S') AS time_published,
  a.source || '|' || a.lang AS authors, a.description, a.source, a.source || '.example' AS source_url,
  CAST(a.doc_id % 200 - 100 AS DOUBLE) / 100 AS sentiment_score_source,
  'Neutral' AS sentiment_label_source, a.event_type AS search_terms, a.datetime,
  'alpha_vantage' AS data_source, 'topic ' || lower(a.lang) AS category,
  upper(a.event_type) || '|U' || CAST(a.user_id % 5 AS VARCHAR) AS ticker_names,
  round(s.score, 6) AS sentiment_score_nltk, {label('s.score')} AS sentiment_label_nltk
  FROM articles a JOIN scores s USING (doc_id)"""

TRANSFORM_B = f"""SELECT a.title, a.url, a.source AS authors, a.description,
  strftime(a.datetime, '%Y-%m-%d %H:%M:%S') AS "pubDate", a.source, a.doc_id AS source_priority,
  'www.' || a.source || '.example/x' AS source_url, a.lang AS country, 'top|' || a.lang AS category,
  a.event_type AS search_terms, a.datetime, coalesce(tags.tickers, '') AS ticker_names,
  'newsdata' AS data_source, round(s.score, 6) AS sentiment_score_nltk,
  {label('s.score')} AS sentiment_label_nltk
  FROM articles a JOIN scores s USING (doc_id) LEFT JOIN tags USING (doc_id)"""

DICTIONARIES = [TERMS, STOP, BASE]

# Processed rows of both sources with their common columns; table order decides what comes first.
PROCESSED = f"""processed AS (
  SELECT title, url, source || '|' || lang AS authors, description, source, source || '.example' AS source_url,
    upper(event_type) || '|U' || CAST(user_id % 5 AS VARCHAR) AS ticker_names, 'topic ' || lower(lang) AS category,
    datetime, event_type AS search_terms, 'alpha_vantage' AS data_source, score AS sentiment_score_nltk,
    {label('score')} AS sentiment_label_nltk, doc_id AS seq, 1 AS rank
  FROM articles JOIN scores USING (doc_id) WHERE data_source = 'alpha'
  UNION ALL
  SELECT title, url, source, description, source, 'www.' || source || '.example/x',
    coalesce(tickers, ''), 'top|' || lang, datetime, event_type, 'newsdata', score, {label('score')},
    doc_id + 1000000000, 2
  FROM articles JOIN scores USING (doc_id) LEFT JOIN tags USING (doc_id) WHERE data_source = 'beta')"""

MERGED = [
    "datetime", "title", "category", "authors", "source", "source_url", "search_terms", "data_source",
    "ticker_names", "sentiment_score_nltk", "sentiment_label_nltk",
]


def merge_ctes(name: str, source: str) -> list[str]:
    """The cleaned merge of a table of processed rows."""
    b, c, f = f"{name}_b", f"{name}_c", f"{name}_f"
    plain = ", ".join(f"b.{x}" for x in MERGED if not x.startswith("sentiment"))
    return [
        best(source, MERGED, "rank", "seq").replace("best AS", f"{b} AS"),
        f"{name}_m AS (SELECT url, description FROM {b} WHERE was_merged)",
        *semantic_ctes(c, f"{name}_m", "url"),
        f"""{f} AS (SELECT b.url, b.was_merged, b.title, CASE WHEN b.was_merged
              THEN coalesce(c.description, '') ELSE b.description END AS description
            FROM {b} b LEFT JOIN {c} c USING (url))""",
        *article_ctes(f"{name}_a", f, "url"),
        f"""{name} AS (SELECT {plain}, b.url, f.description,
              round(CASE WHEN b.was_merged THEN s.score ELSE b.sentiment_score_nltk END, 6) AS sentiment_score_nltk,
              CASE WHEN b.was_merged THEN {label('s.score')} ELSE b.sentiment_label_nltk END AS sentiment_label_nltk
            FROM {b} b JOIN {f} f USING (url) JOIN {name}_a s USING (url))""",
    ]


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


PROFILE_COLUMNS = [
    ("doc_id", "int64"), ("url", "string"), ("data_source", "string"), ("title", "string"),
    ("description", "string"), ("source", "string"), ("lang", "string"), ("datetime", "datetime64[ns]"),
    ("search_terms", "list"), ("ticker_sentiment", "string"),
]


def _profile(i: int, name: str, kind: str) -> str:
    text = {
        "datetime64[ns]": f"rtrim(rtrim(strftime({name}, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')",
    }.get(kind, f"CAST({name} AS VARCHAR)")
    return f"""SELECT CAST({i} AS INTEGER) AS position, '{name}' AS name, '{kind}' AS type,
      (SELECT count(*) > 0 FROM articles WHERE {name} IS NULL) AS nullable,
      (SELECT arg_min(t, _seq) FROM (SELECT {text} AS t, _seq FROM articles WHERE {name} IS NOT NULL)) AS example_1,
      (SELECT arg_min(t, _seq) FROM (SELECT {text} AS t, _seq FROM articles) WHERE t <>
        (SELECT arg_min({text}, _seq) FROM articles WHERE {name} IS NOT NULL)) AS example_2"""


_CLEAN = r"regexp_replace(regexp_replace({}, '^[^\p{{L}}\p{{N}}]+', ''), '[^\p{{L}}\p{{N}}.]+$', '')"


def learned_ctes(source: str, key: str, text: str) -> list[str]:
    """Counts of words with and without a full stop over all texts, and which are abbreviations."""
    return [
        f"raw_tokens AS (SELECT {key}, unnest(l) AS token, generate_subscripts(l, 1) AS i, l FROM (SELECT {key}, "
        f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{WS}+'), lambda t: t <> '') AS l FROM {source}))",
        f"clean_tokens AS (SELECT {_CLEAN.format('token')} AS clean, CASE WHEN i > 1 THEN l[i - 1] END AS before FROM raw_tokens)",
        r"""counted AS MATERIALIZED (SELECT regexp_replace(lower(clean), '\.$', '') AS word,
            count(*) FILTER (WHERE ends_with(clean, '.')) AS n_stop, count(*) FILTER (WHERE NOT ends_with(clean, '.')) AS n_plain,
            count(*) FILTER (WHERE left(clean, 1) = lower(left(clean, 1))) AS n_small,
            count(*) FILTER (WHERE left(clean, 1) <> lower(left(clean, 1)) AND before IS NOT NULL
              AND NOT regexp_matches(before, '[.!?][^\p{L}\p{N}.!?]*$')) AS n_large_within
          FROM clean_tokens WHERE regexp_matches(clean, '^\p{L}+(?:\.\p{L}+)*\.?$') GROUP BY word)""",
        "share AS (SELECT least(greatest(sum(n_stop) / sum(n_stop + n_plain), 1e-12), 1 - 1e-12) AS s FROM counted)",
        """scored_words AS (SELECT word, n_stop, n_plain, n_small, n_large_within, length(replace(word, '.', '')) AS letters,
            -2 * ((n_stop * ln(s) + n_plain * ln(1 - s)) - (n_stop * ln(0.99) + n_plain * ln(1 - CAST(0.99 AS DOUBLE))))
            * exp(-CAST(length(replace(word, '.', '')) AS DOUBLE)) * (length(word) - length(replace(word, '.', '')) + 1)
            * pow(CAST(length(replace(word, '.', '')) AS DOUBLE), -CAST(n_plain AS DOUBLE)) AS score FROM counted, share)""",
        """learned AS MATERIALIZED (SELECT *, n_stop > 0 AND score >= 0.3 AS abbreviation,
            n_small > 0 AND n_large_within = 0 AS starter FROM scored_words)""",
    ]


def learned_split(source: str, key: str, text: str) -> str:
    bare = f"regexp_replace(part, '^{WS}+|{WS}+$', '', 'g')"
    last, first = (_CLEAN.format(f"regexp_split_to_array({bare}, '{WS}+')[{i}]") for i in (-1, 1))
    return "WITH " + ", ".join([
        *learned_ctes(source, key, text),
        f"""parts AS (SELECT {key}, unnest(l) AS part, generate_subscripts(l, 1) AS i FROM (SELECT {key},
            list_filter(string_split(regexp_replace(regexp_replace(coalesce({text}, ''), '^{WS}+|{WS}+$', '', 'g'),
              '([.!?]{WS}+)', '\\1' || chr(1), 'g'), chr(1)), lambda p: p <> '') AS l FROM {source}))""",
        f"words AS (SELECT *, {last} AS last, {first} AS first FROM parts)",
        f"before AS (SELECT *, lag(last) OVER (PARTITION BY {key} ORDER BY i) AS last_before FROM words)",
        f"""breaks AS (SELECT b.{key}, b.i, b.part, coalesce(last_before IS NULL
              OR NOT (ends_with(last_before, '.') AND coalesce(a.abbreviation, false))
              OR (left(first, 1) <> lower(left(first, 1)) AND coalesce(s.starter, false)), true) AS new
            FROM before b LEFT JOIN learned a ON a.word = regexp_replace(lower(last_before), '\\.$', '')
            LEFT JOIN learned s ON s.word = regexp_replace(lower(first), '\\.$', ''))""",
        f"numbered AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY {key} ORDER BY i) AS g FROM breaks)",
        f"""whole AS (SELECT {key}, g, regexp_replace(string_agg(part, '' ORDER BY i), '^{WS}+|{WS}+$', '', 'g') AS sentence
            FROM numbered GROUP BY {key}, g)""",
    ]) + f" SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY g) - 1 AS pos, sentence FROM whole WHERE sentence <> ''"


ORACLES: dict[str, str] = {
    "lexicon_score_rules": rules_sql(),
    "abbreviations": "WITH " + ", ".join(learned_ctes("documents", "doc_id", "text"))
    + " SELECT word, n_stop, n_plain, round(score, 6) AS score, starter FROM learned WHERE abbreviation",
    "split_sentences_learned": learned_split("documents", "doc_id", "text"),
    "ingest_feed": on_articles(
        """SELECT title, url, description AS summary, source, source || '.example' AS source_domain,
        CAST(doc_id % 200 - 100 AS DOUBLE) / 100 AS overall_sentiment_score,
        date_trunc('second', datetime) AS datetime, source || '|' || lang AS authors,
        lang AS search_terms, lang AS topics FROM articles
        QUALIFY row_number() OVER (PARTITION BY lang, url ORDER BY doc_id) = 1"""
    ),
    "ingest_pages": on_articles(
        """SELECT title, url AS link, description, source AS source_name, doc_id AS source_priority,
        'https://www.' || source || '.example/x' AS source_url, date_trunc('second', datetime) AS datetime,
        source AS creator, lang AS country, lang AS search_terms FROM articles
        QUALIFY row_number() OVER (PARTITION BY lang, title ORDER BY doc_id) = 1"""
    ),
    "page_completeness": on_articles(
        """SELECT term, CAST(ceil((20 + max(page)) / 10) AS BIGINT) AS expected_pages,
        count(*) AS pages_read,
        CASE WHEN term IN ('en', 'de') THEN 'p' || CAST(max(page) + 1 AS VARCHAR) END AS resume_from,
        term IN ('en', 'de') AS incomplete FROM pages_landed GROUP BY term""",
        PAGES,
    ),
    "ingest_multi_term": on_articles(
        """SELECT title, url AS link, date_trunc('second', datetime) AS datetime, lang AS search_terms
        FROM articles WHERE lang <> 'es' OR NOT EXISTS
          (SELECT 1 FROM pages_landed WHERE term = 'es' AND page % 2 = 0)
        QUALIFY row_number() OVER (PARTITION BY lang, title ORDER BY doc_id) = 1""",
        PAGES,
    ),
    "ingest_then_union": on_articles(
        """SELECT url, title, search_terms FROM (
          SELECT *, string_agg(lang, '|') OVER (PARTITION BY url) AS every,
            row_number() OVER (PARTITION BY url ORDER BY list_position(['fr', 'en', 'es', 'de'], lang), page, doc_id) AS place
          FROM (SELECT 'https://x.example/' || CAST(doc_id % 97 AS VARCHAR) AS url, title, lang, doc_id, floor(doc_id / 10) AS page FROM articles))
        JOIN (SELECT 'https://x.example/' || CAST(doc_id % 97 AS VARCHAR) AS url,
            string_agg(DISTINCT lang, '|' ORDER BY lang) AS search_terms FROM articles GROUP BY 1) USING (url)
        WHERE place = 1"""
    ),
    "missed_terms": on_articles(
        """SELECT term FROM (VALUES ('de'), ('en'), ('es'), ('fr'), ('xx')) AS asked(term)
        WHERE term NOT IN (SELECT term FROM pages_landed)
          OR EXISTS (SELECT 1 FROM pages_landed p WHERE p.term = asked.term AND p.term = 'es' AND page % 2 = 0)""",
        PAGES,
    ),
    "csv_scan": on_articles(
        """SELECT doc_id, nullif(title, '') AS title, description,
        CASE WHEN doc_id % 4 = 0 THEN NULL ELSE datetime END AS datetime FROM articles"""
    ),
    "folder_scan": on_articles(
        """SELECT doc_id, nullif(title, '') AS title,
        CASE WHEN data_source = 'alpha' THEN lang END AS lang FROM articles"""
    ),
    "folder_summary": """SELECT * FROM (VALUES ('.gz', 4::BIGINT, 0::BIGINT), ('uncompressed', 3::BIGINT, 0::BIGINT))
        AS t(compression, loaded_files, skipped_files)""",
    "lookback": """SELECT event_id, ts AS datetime FROM events
        WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'""",
    "sink_roundtrip": on_articles(
        """SELECT doc_id, nullif(title, '') AS title, description, datetime, event_type AS search_terms
        FROM articles"""
    ),
    "version_span": on_articles(
        """SELECT strftime(min(datetime), '%Y%m%dT%H%M') AS "first",
        strftime(max(datetime), '%Y%m%dT%H%M') AS "last" FROM articles"""
    ),
    "schema_profile": on_articles(
        " UNION ALL ".join(_profile(i, n, k) for i, (n, k) in enumerate(PROFILE_COLUMNS))
    ),
    "upsert_main": on_articles(
        """SELECT url, title, description, datetime, t.search_terms, data_source FROM firsts
        JOIN all_terms t USING (url)""",
        FIRST_PER_URL.format(
            source="articles", order="CASE WHEN data_source = 'beta' THEN 0 ELSE 1 END, doc_id"
        ),
        TERMS_PER_URL,
    ),
    "append_distinct": on_articles("SELECT DISTINCT url, source, lang FROM articles"),
    "sorted_layer": on_articles("SELECT datetime, doc_id, url FROM articles"),
    "envelope_validation": on_articles(
        """SELECT term, page, CASE page % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'not_an_object'
        WHEN 2 THEN 'bad_status' WHEN 3 THEN 'missing_key' WHEN 4 THEN 'empty_key' END AS reject_reason
        FROM pages_landed""",
        PAGES,
    ),
    "kind_profile": f"""WITH {MESSY}, kinds AS (SELECT CASE WHEN kind IN (0, 1, 4, 5) THEN 'list'
        WHEN kind IN (2, 6) THEN 'string' WHEN kind = 3 THEN 'null' WHEN kind = 7 THEN 'dict'
        ELSE 'number' END AS kind FROM messy) {KIND_COUNTS}""",
    "element_kind_profile": f"""WITH {MESSY}, kinds AS (SELECT unnest(CASE WHEN kind IN (0, 1)
        THEN ['string', 'string'] WHEN kind = 4 THEN ['number', 'number']
        WHEN kind = 5 THEN ['null', 'bool', 'string'] WHEN kind IN (2, 6) THEN ['string']
        WHEN kind = 3 THEN ['null'] WHEN kind = 7 THEN ['dict'] ELSE ['number'] END) AS kind FROM messy)
        {KIND_COUNTS}""",
    "project_rename": on_articles(
        """SELECT title, url, source AS authors, description,
        strftime(datetime, '%Y-%m-%d %H:%M:%S') AS "pubDate", source, doc_id AS source_priority,
        'https://www.' || source || '.example/x' AS source_url, '["' || lang || '"]' AS country,
        '[''top'', ''' || lang || ''']' AS category, search_terms, datetime FROM articles"""
    ),
    "is_missing": "SELECT event_id, event_id % 4 IN (0, 1) AS missing FROM events",
    "parse_list": messy("''", "0"),
    "normalize_list": messy(
        PLAIN.format(null="''", number="'  ' || CAST(doc_id AS VARCHAR) || ' '"),
        "CASE WHEN kind = 3 THEN 0 ELSE 1 END",
    ),
    "normalize_terms": messy(PLAIN.format(null="'None'", number="CAST(doc_id AS VARCHAR)"), "1"),
    "parse_numbers": """SELECT doc_id, concat_ws('|', CAST(doc_id + 0.125::DOUBLE AS VARCHAR),
        CAST(('1e' || CAST(doc_id % 21 AS VARCHAR))::DOUBLE AS VARCHAR),
        CAST(('-2.5e-' || CAST(doc_id % 9 AS VARCHAR))::DOUBLE AS VARCHAR),
        '7' || CAST(doc_id AS VARCHAR) || '0000000000000000000', 'True', 'None') AS items,
        CASE WHEN doc_id % 2 = 1 THEN 1 ELSE 6 END::BIGINT AS n_terms FROM documents""",
    "safe_eval": f"WITH {MESSY} SELECT doc_id, {MESSY_ITEMS.format(other=chr(39) * 2)} AS items FROM messy",
    "normalize_dicts": """SELECT doc_id, CAST(CASE doc_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS n,
        CASE WHEN doc_id % 5 < 2 THEN source ELSE '' END AS tickers,
        CASE doc_id % 5 WHEN 0 THEN lang WHEN 1 THEN '~' ELSE '' END AS langs FROM documents""",
    "pluck_key": on_articles(
        """SELECT doc_id, 'CRYPTO:' || upper(event_type) || '|FOREX:U' || CAST(user_id % 5 AS VARCHAR) AS tickers
        FROM articles"""
    ),
    "lower_items": on_articles(
        """SELECT doc_id, lower(source) || CASE WHEN lang = 'en' THEN '' ELSE '|' || lower(lang) END
        || '|' || event_type AS items FROM articles"""
    ),
    "strip_ticker": on_articles(
        "SELECT doc_id, upper(event_type) || '|U' || CAST(user_id % 5 AS VARCHAR) AS tickers FROM articles"
    ),
    "strip_scheme": "SELECT page_id, string_split(url, '//')[-1] AS bare_url FROM pages",
    "parse_ts": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts)
        WHEN 1 THEN date_trunc('minute', ts) WHEN 2 THEN date_trunc('second', ts) END AS at FROM events""",
    "keyword_tag": on_articles(
        "SELECT doc_id, coalesce(tickers, '') AS tickers FROM articles LEFT JOIN tags USING (doc_id)",
        KEYWORD_ROWS, TAGS,
    ),
    "filter_ticker": on_articles(
        """SELECT doc_id, CASE WHEN event_type = 'click' THEN CAST(doc_id % 201 - 100 AS VARCHAR) END AS score
        FROM articles"""
    ),
    "ticker_frame": on_articles(
        """SELECT doc_id, CASE WHEN user_id % 5 = 1 THEN 'FOREX:U1' END AS ticker,
        CAST(NULL AS VARCHAR) AS relevance_score,
        CASE WHEN user_id % 5 = 1 THEN CAST(doc_id % 37 AS VARCHAR) END AS ticker_sentiment_score,
        CAST(NULL AS VARCHAR) AS ticker_sentiment_label FROM articles"""
    ),
    "preprocess_text": f"""WITH {STOP}, {BASE}, {tokens_cte('toks', 'documents', 'doc_id', 'text')}
        SELECT d.doc_id, coalesce(clean, '') AS clean FROM documents d LEFT JOIN
        (SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS clean FROM toks GROUP BY doc_id) USING (doc_id)""",
    "lexicon_score": "WITH " + ", ".join([*DICTIONARIES, *score_ctes("scores", "documents", "doc_id", "text")])
    + " SELECT doc_id, score FROM scores",
    "sentiment_label": f"""SELECT doc_id, {label('s')} AS label
        FROM (SELECT doc_id, (doc_id % 21 - 10) / 100.0::DOUBLE AS s FROM documents)""",
    "score_average": on_articles(
        "SELECT doc_id, round(score, 6) AS score FROM scores",
        *DICTIONARIES, *article_ctes("scores", "articles", "doc_id"),
    ),
    "rescore_masked": on_articles(
        f"""SELECT doc_id, CASE WHEN data_source = 'beta' THEN round(score, 6) ELSE 0.5 END AS score,
        CASE WHEN data_source = 'beta' THEN {label('score')} ELSE 'Old' END AS label
        FROM articles JOIN scores USING (doc_id)""",
        *DICTIONARIES, *article_ctes("scores", "articles", "doc_id"),
    ),
    "prefix_terms": on_articles(
        f"""SELECT a.doc_id, coalesce(m.terms, '{'|'.join(ASKED)}') AS terms, coalesce(m.found, '') AS found
        FROM articles a LEFT JOIN (
          SELECT doc_id, string_agg(DISTINCT term, '|' ORDER BY term) AS terms,
            string_agg(DISTINCT word, '|' ORDER BY word) AS found
          FROM title_words JOIN asked ON starts_with(title_words.stem, asked.stem) GROUP BY doc_id) m
        USING (doc_id)""",
        ASKED_ROWS, STEM_ROWS,
        f"""title_words AS (SELECT doc_id, w.word, coalesce(stems.stem, w.word) AS stem FROM (
          SELECT doc_id, unnest(regexp_extract_all(lower(title), '{WORD}')) AS word FROM articles) w
          LEFT JOIN stems ON stems.word = w.word)""",
    ),
    "stem_terms": on_articles(
        """SELECT a.doc_id, coalesce(terms, '') AS terms FROM articles a LEFT JOIN (
          SELECT doc_id, string_agg(DISTINCT term, '|' ORDER BY term) AS terms FROM (
            SELECT doc_id, coalesce(e.term, s.term) AS term FROM title_words w
            LEFT JOIN asked e ON e.term = w.word LEFT JOIN asked s ON s.stem = w.stem)
          WHERE term IS NOT NULL GROUP BY doc_id) USING (doc_id)""",
        ASKED_ROWS, STEM_ROWS,
        f"""title_words AS (SELECT doc_id, w.word, coalesce(stems.stem, w.word) AS stem FROM (
          SELECT doc_id, ltrim(unnest(regexp_extract_all(lower(title), '{TERM_WORD}')), '$#') AS word
          FROM articles) w LEFT JOIN stems ON stems.word = w.word)""",
    ),
    "split_sentences": f"WITH {sentences_cte('s', 'documents', 'doc_id', 'text')} SELECT doc_id, pos, sentence FROM s",
    "normalize_sentence": f"""SELECT doc_id,
        regexp_replace(lower(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')), '{WS}+', ' ', 'g') AS spaced,
        array_to_string(regexp_extract_all(replace(lower(text), 'n''t', ' n''t '), '{q(TOKEN)}'), ' ') AS tokens,
        array_to_string(regexp_extract_all(replace(lower(text), 'n''t', ' n''t '), '{q(TOKEN)}'), ' ') AS hybrid
        FROM documents""",
    "semantic_dedup": "WITH RECURSIVE " + ", ".join(
        [
            "v AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e, "
            "row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings)",
            """near AS (SELECT a.label, a.rn, b.rn AS earlier FROM v a JOIN v b
               ON a.label = b.label AND b.rn < a.rn WHERE list_cosine_similarity(a.e, b.e) >= 0.3)""",
            *greedy_ctes("walk", "v", "label", "near"),
            "last AS (SELECT label, max_by(kept, rn) AS kept FROM walk GROUP BY label)",
        ]
    ) + " SELECT v.label, v.vec_id FROM v JOIN last ON last.label = v.label AND list_contains(last.kept, v.rn)",
    "semantic_dedup_rounds": "WITH RECURSIVE " + ", ".join(
        [
            "v AS (SELECT 1 AS label, vec_id, CAST(embedding AS DOUBLE[]) AS e, "
            "row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings)",
            """near AS (SELECT a.label, a.rn, b.rn AS earlier FROM v a JOIN v b
               ON b.rn < a.rn WHERE list_cosine_similarity(a.e, b.e) >= 0.3)""",
            *greedy_ctes("walk", "v", "label", "near"),
            "last AS (SELECT label, max_by(kept, rn) AS kept FROM walk GROUP BY label)",
        ]
    ) + " SELECT v.vec_id FROM v JOIN last ON list_contains(last.kept, v.rn)",
    "semantic_clean": recursive(on_articles(
        """SELECT b.url, CASE WHEN was_merged THEN coalesce(c.description, '') ELSE b.description END AS description,
        was_merged, CAST(coalesce(c.removed, 0) AS BIGINT) AS removed_sent_count
        FROM best b LEFT JOIN c USING (url)""",
        best("articles", [], RANK, "doc_id"),
        "flagged AS (SELECT url, description FROM best WHERE was_merged)",
        *semantic_ctes("c", "flagged", "url"),
    )),
    "semantic_clean_vectors": recursive(on_articles(
        """SELECT b.url, CASE WHEN was_merged THEN coalesce(c.description, '') ELSE b.description END AS description,
        was_merged, CAST(coalesce(c.removed, 0) AS BIGINT) AS removed_sent_count
        FROM best b LEFT JOIN c USING (url)""",
        best("articles", [], RANK, "doc_id"),
        "flagged AS (SELECT url, description FROM best WHERE was_merged)",
        sentences_cte("c_s", "flagged", "url", "description"),
        """c_rows AS (SELECT s.*, CAST(pos + 1 AS BIGINT) AS rn, CAST(e.embedding AS DOUBLE[]) AS e FROM c_s s
            LEFT JOIN embeddings e ON e.vec_id = (length(sentence) * 7 + pos * 3) % ((SELECT count(*) FROM embeddings) + 20))""",
        """c_near AS (SELECT a.url, a.rn, b.rn AS earlier FROM c_rows a JOIN c_rows b ON a.url = b.url AND b.rn < a.rn
            WHERE list_cosine_similarity(a.e, b.e) >= 0.3)""",
        *greedy_ctes("c_w", "c_rows", "url", "c_near"),
        "c_k AS (SELECT url, max_by(kept, rn) AS kept, max(rn) AS n FROM c_w GROUP BY url)",
        """c AS (SELECT r.url, string_agg(r.sentence, ' ' ORDER BY r.rn) AS description, max(k.n) - count(*) AS removed
            FROM c_rows r JOIN c_k k ON k.url = r.url AND list_contains(k.kept, r.rn) GROUP BY r.url)""",
    )),
    "guards": """SELECT 'whole' AS guard, count(*) AS n, CAST(NULL AS VARCHAR) AS said FROM documents
        UNION ALL SELECT 'german', count(*), NULL FROM documents WHERE lang = 'de'
        UNION ALL SELECT 'columns', 0, 'Missing columns: [''title'', ''url'']'
        UNION ALL SELECT 'rows', 0, 'No data returned: documents in xx'""",
    "schema_profile_samples": on_articles(
        " UNION ALL ".join(
            f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS name, '{kind}' AS type, (SELECT count(*) > 0 FROM articles WHERE {c} IS NULL) AS nullable,
            l[1] AS example_1, l[2] AS example_2, l[3] AS example_3, l[4] AS example_4 FROM (
              SELECT list(t ORDER BY s) AS l FROM (SELECT {text} AS t, min(_seq) AS s FROM articles WHERE {c} IS NOT NULL GROUP BY 1))"""
            for i, (c, kind, text) in enumerate(
                [("doc_id", "bigint", "CAST(doc_id AS VARCHAR)"), ("source", "string", "source"), ("lang", "string", "lang"), ("data_source", "string", "data_source"),
                 ("datetime", "timestamp_ntz", "rtrim(rtrim(strftime(datetime, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')")]
            )
        )
    ),
    "union_sources": on_articles("SELECT doc_id, url, title FROM articles"),
    "source_rank": on_articles(
        """SELECT doc_id, CAST(CASE WHEN lang = 'de' THEN 999 WHEN data_source = 'alpha' THEN 1 ELSE 2 END
        AS BIGINT) AS rank FROM articles"""
    ),
    "best_row_merge": on_articles(
        "SELECT * FROM best",
        "news AS (SELECT * REPLACE (CASE WHEN data_source = 'beta' THEN lang END AS lang) FROM articles)",
        best("news", ["data_source", "datetime", "title", "source", "lang"], RANK, "doc_id"),
    ),
    "term_union": on_articles(
        "SELECT url, title, description, datetime, t.search_terms, _seq FROM firsts JOIN all_terms t USING (url)",
        FIRST_PER_URL.format(source="articles", order="doc_id"), TERMS_PER_URL,
    ),
    "dedup_first": on_articles(
        """SELECT key, title, description, datetime, _seq FROM (
          SELECT *, CASE WHEN lang <> 'es' THEN url END AS key FROM articles)
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1"""
    ),
    "last_seen_ticker": on_articles(
        """SELECT upper(event_type) AS ticker, max(datetime) AS last_seen FROM articles GROUP BY 1
        UNION ALL SELECT 'only CLICK', max(datetime) FROM articles WHERE event_type = 'click'"""
    ),
    "resample_daily": on_articles(
        CALENDAR.format(score="round(score, 12)", unit="DAY"), SCORED, means("day", "scored")
    ),
    "resample_hourly": on_articles(
        CALENDAR.format(score="round(score, 12)", unit="HOUR"), SCORED, means("hour", "scored")
    ),
    "resample_nested": on_articles(
        CALENDAR.format(score="round(score, 12)", unit="DAY"), NESTED, means("day", "nested")
    ),
    "gap_fill": f"WITH {EVENT_MEANS} " + CALENDAR.format(score="round(score, 12)", unit="HOUR"),
    "fill_scores": f"WITH {EVENT_MEANS} " + CALENDAR.format(score="coalesce(round(score, 12), 0)", unit="HOUR"),
    "pivot_scores": on_articles(
        "SELECT bucket, " + ", ".join(
            f"round(max(score) FILTER (WHERE ticker = '{t}'), 12) AS \"{t}\""
            for t in ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "U0", "U1", "U2", "U3", "U4", "VIEW"]
        ) + " FROM series GROUP BY bucket",
        NESTED, means("day", "nested"), f"series AS ({CALENDAR.format(score='score', unit='DAY')})",
    ),
    "transform_a": on_articles(TRANSFORM_A, *DICTIONARIES, *article_ctes("scores", "articles", "doc_id")),
    "transform_b": on_articles(
        TRANSFORM_B, *DICTIONARIES, *article_ctes("scores", "articles", "doc_id"), KEYWORD_ROWS, TAGS
    ),
    "source_run": on_articles(
        CALENDAR.format(score="round(score, 12)", unit="DAY"),
        FIRST_PER_URL.format(
            source="articles", order="CASE WHEN data_source = 'beta' THEN 0 ELSE 1 END, doc_id"
        ),
        *DICTIONARIES, *article_ctes("scores", "firsts", "doc_id"),
        """scored AS (SELECT datetime, unnest([upper(event_type), 'U' || CAST(user_id % 5 AS VARCHAR)]) AS ticker,
           score FROM firsts JOIN scores USING (doc_id))""",
        means("day", "scored"),
    ),
    "source_run_a": on_articles(
        f"""SELECT url, title, date_trunc('second', datetime) AS datetime, langs AS search_terms, upper(lang) AS ticker_names,
          {label('score')} AS sentiment_label_nltk, round(score, 6) AS sentiment_score_nltk
        FROM firsts JOIN scores USING (doc_id)
        JOIN (SELECT url, string_agg(DISTINCT lang, '|' ORDER BY lang) AS langs FROM articles GROUP BY url) USING (url)""",
        FIRST_PER_URL.format(
            source="articles",
            order="CASE WHEN data_source = 'beta' THEN 0 ELSE 1 END, list_position(['fr', 'en', 'es', 'de'], lang), doc_id",
        ),
        *DICTIONARIES, *article_ctes("scores", "firsts", "doc_id"),
    ),
    "source_run_b": on_articles(
        CALENDAR.format(score="round(score, 12)", unit="HOUR"),
        "named AS (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY lang, title ORDER BY doc_id) = 1)",
        FIRST_PER_URL.format(source="named", order="list_position(['fr', 'en', 'es', 'de'], lang), doc_id"),
        *DICTIONARIES, *article_ctes("scores", "firsts", "doc_id"), KEYWORD_ROWS, TAGS,
        """scored AS (SELECT datetime, unnest(string_split(tickers, '|')) AS ticker, score
           FROM firsts JOIN scores USING (doc_id) JOIN tags USING (doc_id))""",
        means("hour", "scored"),
    ),
    "merge_clean": recursive(on_articles(
        "SELECT * FROM m",
        *DICTIONARIES, *article_ctes("scores", "articles", "doc_id"), KEYWORD_ROWS, TAGS, PROCESSED,
        *merge_ctes("m", "processed"),
    )),
    "merge_run": recursive(on_articles(
        "SELECT * FROM m UNION SELECT * FROM o",
        *DICTIONARIES, *article_ctes("scores", "articles", "doc_id"), KEYWORD_ROWS, TAGS, PROCESSED,
        "older AS (SELECT * FROM processed WHERE data_source = 'alpha_vantage')",
        *merge_ctes("m", "processed"), *merge_ctes("o", "older"),
    )),
}

# The same rows by another way.
ORACLES["merge_run_layers"] = ORACLES["merge_run"]
for _name in ("preprocess_text", "lexicon_score", "keyword_tag", "prefix_terms", "stem_terms"):
    ORACLES[f"{_name}_table"] = ORACLES[_name]
ORACLES["upsert_main_any"] = ORACLES["upsert_main"]
ORACLES["semantic_clean_large"] = ORACLES["semantic_clean"]
ORACLES["upsert_buckets"] = ORACLES["upsert_main"]
ORACLES["append_buckets"] = ORACLES["append_distinct"]
ORACLES["merge_clean_pieces"] = ORACLES["merge_clean"]
ORACLES["pivot_blocks"] = ORACLES["pivot_scores"]
