"""The same results in SQL, for checking the queries against another engine."""

from __future__ import annotations

from kvetch.functions.text import FEATURE_STOP_WORDS, FULL_WIDTH, HALF_WIDTH, TRAINING_STOP_WORDS
from kvetch.operators.keywords import NO_CLASS
from kvetch.operators.segment import USER_FREQUENCY
from registry import inputs
from registry.queries import PASSES, PASSES_BY_JOIN


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(value) for value in values)


def _rows(rows) -> str:
    return ", ".join(f"({_list(row)})" for row in rows)


def _widen(column: str) -> str:
    return f"translate({column}, {_text(HALF_WIDTH)}, {_text(FULL_WIDTH)})"


def _narrow(column: str) -> str:
    return f"translate({column}, {_text(FULL_WIDTH)}, {_text(HALF_WIDTH)})"


def _tokens(column: str) -> str:
    return rf"regexp_extract_all({column}, '\p{{L}}+')"


_FOLD_LETTERS = f"{_text(''.join(inputs.VARIANTS))}, {_text(''.join(inputs.VARIANTS.values()))}"

_COMMENTS = """
comments AS (
  SELECT CAST(doc_id AS VARCHAR) AS commentid, CASE WHEN doc_id % 13 <> 4 THEN text END AS content, {nature} AS nature, lang AS devicecode,
         lang AS brandcode, source AS storename, source AS storeid, doc_id AS createtime,
         {day} + doc_id % 5 AS dt
  FROM documents)"""
_NOT_POSITIVE = _COMMENTS.format(day=inputs.DAY, nature="CASE lang WHEN 'en' THEN -1 ELSE 0 END")

_MESSAGES = f"""
messages AS (
  SELECT conv_id || ':' || turn AS id,
         CASE WHEN conv_id % 11 = 10 THEN NULL WHEN conv_id % 5 = 0 THEN text[1:turn * 2 + 1] ELSE text END AS content,
         {inputs.DAY} + conv_id % 5 AS stat_date, {inputs.HOUR} + turn % 3 - 1 AS stat_hour
  FROM conversations)"""
_THIS_HOUR = f"stat_date = {inputs.DAY} AND stat_hour = {inputs.HOUR} AND length(content) > 2"

_LABEL = """CASE WHEN quality = 1 AND toxic <> 1 THEN 'A-1' WHEN quality = 1 THEN 'B-1'
            WHEN toxic <> 1 THEN 'C-2' ELSE 'A-2' END"""

# Lines of documents: mark, label and tab, text. Parts are kept apart, as the split is known.
_DOCUMENT_LINES = f"""
lines AS (
  SELECT d.doc_id, {_LABEL} AS label, replace(text, ' the ', ' 的 ') AS text, quality IS NOT NULL AS labelled,
         CASE lang WHEN 'fr' THEN chr(65279) WHEN 'de' THEN chr(65534) ELSE '' END AS mark
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

_SENTENCES = f"""
sentences AS (
  SELECT doc_id, label, unnest(parts) AS text, generate_subscripts(parts, 1) AS pos
  FROM (SELECT d.doc_id, {_LABEL} AS label, string_split(text, chr(10)) AS parts
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id))"""
_LAST_LABELS = """
last_labels AS (
  SELECT text, label FROM sentences WHERE text <> ''
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id DESC, pos DESC) = 1)"""

_TOKENS = f"tokens AS (SELECT doc_id, {_tokens('lower(text)')} AS tokens FROM documents)"

# Of some documents the text is NULL; those have no tokens.
_SOME_TOKENS = f"""tokens AS (
  SELECT doc_id, CASE WHEN doc_id % 13 <> 4 THEN {_tokens('lower(text)')} ELSE [] END AS tokens FROM documents)"""

_LEXICON = f"""
listed(word, nature) AS (VALUES {_rows(inputs.LEXICON)}),
lexicon AS (SELECT word, min(nature) AS nature FROM listed GROUP BY word)"""

_LABELLED_WORDS = f"""
labelled AS (SELECT d.doc_id, {_LABEL} AS label, {_tokens('lower(text)')} AS tokens
             FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
words AS (SELECT doc_id, label, unnest(tokens) AS word FROM labelled)"""

_RULES = r"""
cut AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS pos, lang || '-' || source AS class, unnest(parts) AS text
  FROM (SELECT doc_id, lang, source, string_split(translate(lower(text), ',', '，'), chr(10)) AS parts FROM documents)),
lists AS (
  SELECT doc_id, pos, class, regexp_extract(text, '^([^\t ]*)[\t ]*(.*)$', ['m', 'd'], 's') AS list
  FROM (SELECT doc_id, pos, class, regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS text
        FROM cut WHERE text <> '')),
rules AS (
  SELECT doc_id, pos, class,
         list_filter(list_transform(string_split(list.m, '，'),
           lambda w: regexp_replace(w, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')), lambda w: w <> '') AS subjects,
         list_filter(list_transform(string_split(list.d, '，'),
           lambda w: regexp_replace(w, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')), lambda w: w <> '') AS descriptors
  FROM lists),
dictionary AS (
  SELECT role, word, class, count(*) AS mult
  FROM (SELECT 'm' AS role, unnest(subjects) AS word, class FROM rules
        UNION ALL SELECT 'd', unnest(descriptors), class FROM rules)
  GROUP BY ALL)"""

_KEYWORDS = f"""
dict(role, word, class) AS (VALUES {_rows(inputs.DICTIONARY)}),
amb AS (SELECT DISTINCT word FROM (SELECT role, word FROM dict GROUP BY ALL HAVING count(DISTINCT class) > 1)),
places AS (SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM tokens),
hits AS MATERIALIZED (SELECT doc_id, pos, role, word FROM places JOIN (SELECT DISTINCT role, word FROM dict) USING (word)),
ballots AS MATERIALIZED (SELECT h.doc_id, h.role, h.word, d.class, h.word NOT IN (SELECT word FROM amb) AS clear
            FROM hits h JOIN dict d ON d.role = h.role AND d.word = h.word),
both_roles AS (SELECT doc_id FROM hits GROUP BY doc_id HAVING count(DISTINCT role) = 2),
common AS (SELECT doc_id, class FROM ballots WHERE role = 'm'
           INTERSECT SELECT doc_id, class FROM ballots WHERE role = 'd'),
votes AS (
  SELECT doc_id, class, count(*) AS votes, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, class) AS place
  FROM ballots WHERE clear AND doc_id IN (SELECT doc_id FROM both_roles) AND doc_id NOT IN (SELECT doc_id FROM common)
  GROUP BY doc_id, class QUALIFY place <= 3),
found AS (
  SELECT doc_id, list(class ORDER BY class) AS classes FROM common GROUP BY doc_id
  UNION ALL SELECT doc_id, list(class ORDER BY place) FROM votes GROUP BY doc_id
  UNION ALL SELECT doc_id, list(DISTINCT class ORDER BY class) FROM ballots
            WHERE clear AND doc_id NOT IN (SELECT doc_id FROM both_roles) GROUP BY doc_id),
hit_words AS (
  SELECT doc_id, coalesce(string_agg(word, ',' ORDER BY pos) FILTER (role = 'm'), '') || '|' ||
         coalesce(string_agg(word, ',' ORDER BY pos) FILTER (role = 'd'), '') AS words
  FROM hits GROUP BY doc_id),
keyed AS (
  SELECT t.doc_id, coalesce(classes, [{_text(NO_CLASS)}]) AS key_classes, coalesce(words, '|') AS words
  FROM tokens t LEFT JOIN found USING (doc_id) LEFT JOIN hit_words USING (doc_id))"""


def _training(passes: int) -> str:
    """From train_docs(doc, label) and train_words(doc, word) to the weights of each text.

    One pass after the other, each with the sums of all weights so far.
    """
    steps = ["""
classes AS (SELECT DISTINCT label FROM train_docs),
sizes AS (SELECT (SELECT count(*) FROM classes) AS c, (SELECT count(DISTINCT word) FROM train_words) AS v),
train_sizes AS MATERIALIZED (SELECT doc, count(*) AS n FROM train_words GROUP BY doc),
weight0 AS (SELECT doc, label, CAST(0 AS DOUBLE) AS w FROM train_docs)"""]
    for k in range(1, passes + 1):
        steps.append(_sums(k - 1) + f""",
train_scores{k} AS (
  SELECT doc, f.label, sum(ln(1 + f)) AS s FROM train_words JOIN f{k - 1} f USING (word) GROUP BY ALL),
train_logs{k} AS (
  SELECT d.doc, d.label AS own, p.label, prior + coalesce(s, 0) - coalesce(n, 0) * base AS lp
  FROM train_docs d CROSS JOIN base{k - 1} p
  LEFT JOIN train_scores{k} t ON t.doc = d.doc AND t.label = p.label LEFT JOIN train_sizes z ON z.doc = d.doc),
train_best{k} AS (SELECT doc, max(lp) AS top FROM train_logs{k} GROUP BY doc),
weight{k} AS MATERIALIZED (
  SELECT w.doc, w.label, w.w + 1 - own_share AS w
  FROM weight{k - 1} w JOIN (
    SELECT doc, sum(exp(lp - top)) FILTER (label = own) / sum(exp(lp - top)) AS own_share
    FROM train_logs{k} JOIN train_best{k} USING (doc) GROUP BY doc) USING (doc))""")
    return ",".join(steps)


def _sums(k: int) -> str:
    """Word and class weights after ``k`` passes."""
    return f"""
f{k} AS MATERIALIZED (
  SELECT word, label, sum(w) AS f FROM train_words JOIN weight{k} USING (doc) GROUP BY ALL),
base{k} AS (
  SELECT g.label, ln((g + 1) / (sum(g) OVER () + c)) AS prior, ln(coalesce(ff, 0) + v) AS base
  FROM (SELECT label, sum(w) AS g FROM weight{k} GROUP BY label) g
  LEFT JOIN (SELECT label, sum(f) AS ff FROM f{k} GROUP BY label) USING (label) CROSS JOIN sizes)"""


def _scoring(k: int) -> str:
    """From score_docs(doc) and score_words(doc, word) to p(doc, known, class, p, place)."""
    return _sums(k) + f""",
known AS (SELECT doc, count(*) AS n FROM score_words WHERE word IN (SELECT word FROM f{k}) GROUP BY doc),
scores AS (SELECT doc, f.label, sum(ln(1 + f)) AS s FROM score_words JOIN f{k} f USING (word) GROUP BY ALL),
logs AS MATERIALIZED (
  SELECT d.doc, coalesce(n, 0) AS known, p.label AS class, prior + coalesce(s, 0) - coalesce(n, 0) * base AS lp
  FROM score_docs d CROSS JOIN base{k} p
  LEFT JOIN scores t ON t.doc = d.doc AND t.label = p.label LEFT JOIN known k ON k.doc = d.doc),
best AS (SELECT doc, max(lp) AS top FROM logs GROUP BY doc),
shares AS (SELECT doc, known, class, exp(lp - top) AS share FROM logs JOIN best USING (doc)),
p AS MATERIALIZED (
  SELECT doc, known, class, p, row_number() OVER (PARTITION BY doc ORDER BY p DESC, class) AS place
  FROM (SELECT doc, known, class, share / sum(share) OVER (PARTITION BY doc) AS p FROM shares)),
top AS (
  SELECT doc, list(class ORDER BY place) FILTER (place <= 3) AS pred_classes, max(p) AS p1, any_value(known) AS known
  FROM p GROUP BY doc)"""


_PLAIN_ROWS = (
    _LABELLED_WORDS
    + """,
train_docs AS (SELECT doc_id AS doc, label FROM labelled),
train_words AS MATERIALIZED (SELECT DISTINCT doc_id AS doc, word FROM words),"""
)
_PLAIN_TRAINING = _PLAIN_ROWS + _training(PASSES)

# Training on labelled lines without the ambiguous keywords.
_COMMENT_TRAINING = (
    _DOCUMENT_LINES
    + f""",
train_words AS MATERIALIZED (
  SELECT DISTINCT doc_id AS doc, word
  FROM (SELECT doc_id, unnest({_tokens('lower(text)')}) AS word FROM lines WHERE labelled)
  WHERE word NOT IN (SELECT word FROM amb)),
train_docs AS (SELECT doc_id AS doc, label FROM lines WHERE doc_id IN (SELECT doc FROM train_words)),"""
    + _training(PASSES)
)

# Training on the last label of each distinct text, as written, without long and stop words.
_MESSAGE_TRAINING = (
    _SENTENCES + "," + _LAST_LABELS
    + f""",
train_docs AS (SELECT text AS doc, label FROM last_labels),
train_words AS MATERIALIZED (
  SELECT DISTINCT doc, word FROM (SELECT text AS doc, unnest({_tokens('text')}) AS word FROM last_labels)
  WHERE length(word) < 20 AND word NOT IN ({_list(FEATURE_STOP_WORDS)})),"""
    + _training(1)
)

# Training on labelled lines without stop words.
_FIT_TRAINING = (
    _DOCUMENT_LINES
    + f""",
train_words AS MATERIALIZED (
  SELECT DISTINCT doc_id AS doc, word
  FROM (SELECT doc_id, unnest({_tokens('lower(text)')}) AS word FROM lines WHERE labelled)
  WHERE word NOT IN ({_list(TRAINING_STOP_WORDS)})),
train_docs AS (SELECT doc_id AS doc, label FROM lines WHERE doc_id IN (SELECT doc FROM train_words)),"""
    + _training(PASSES)
)

_SCORE_DOCUMENTS = """
score_docs AS (SELECT doc_id AS doc FROM tokens),
score_words AS MATERIALIZED (SELECT DISTINCT doc_id AS doc, unnest(tokens) AS word FROM tokens),"""

_MERGED = f"""
merged AS (
  SELECT k.doc_id, key_classes, words, pred_classes,
         list_sort(list_intersect(key_classes, pred_classes)) AS common, p1
  FROM keyed k JOIN top ON top.doc = k.doc_id),
final AS (
  SELECT doc_id, words, array_to_string(key_classes, ',') AS keyclass, array_to_string(pred_classes, ',') AS predclass,
         CASE WHEN len(common) > 0 THEN
                CASE WHEN NOT list_contains(common, pred_classes[1]) AND p1 > 0.7 THEN pred_classes[1]
                     ELSE array_to_string(common, ',') END
              WHEN p1 > 0.9 THEN pred_classes[1]
              WHEN key_classes = [{_text(NO_CLASS)}] AND p1 > 0.10 THEN pred_classes[1]
              ELSE array_to_string(key_classes, ',') END AS class
  FROM merged)"""

_COLUMNS = """SELECT doc_id, text, CAST(length(lang) AS INTEGER) AS width, lang = 'en' AS english, n_chars / 4 AS quarter,
       {partition} AS stat_date FROM documents"""

_SEGMENTS = "|".join(sorted(inputs.SEGMENT_WORDS, key=len, reverse=True))
_SEGMENTED = rf"""SELECT doc_id, CASE WHEN doc_id % 13 <> 4 THEN array_to_string(regexp_extract_all(
  regexp_replace(lower(text), '[^\p{{L}}]', '', 'g'), '{_SEGMENTS}|.'), ' ') ELSE '' END AS words FROM documents"""

_KEYWORD_CLASSES = f"WITH {_SOME_TOKENS}, {_KEYWORDS} SELECT doc_id, array_to_string(key_classes, ',') AS class FROM keyed"


def _term_weights(passes: int) -> str:
    return f"WITH {_PLAIN_ROWS} {_training(passes)}, {_sums(passes)} SELECT word, label, round(f, 4) AS f FROM f{passes}"



_DISTRIBUTION = f"""WITH {_PLAIN_TRAINING}, {_TOKENS}, {_SCORE_DOCUMENTS} {_scoring(PASSES)}
  SELECT doc AS doc_id, known, class, round(p, 4) AS p FROM p"""
_PAIRS = f"""WITH {_NOT_POSITIVE}, {_LEXICON},
  tagged AS (
    SELECT commentid, word, nature, count(*) AS n
    FROM (SELECT commentid, unnest({_tokens('lower(content)')}) AS word FROM comments WHERE nature < 1) t
    JOIN lexicon USING (word)
    WHERE NOT (nature LIKE 'mzd%' OR nature LIKE 'mzm%' OR nature LIKE 'w%') GROUP BY ALL)
  SELECT a.word || '-' || b.word AS words, a.nature || '-' || b.nature AS nature,
         CAST(sum(a.n * b.n) AS BIGINT) AS cnt
  FROM tagged a JOIN tagged b USING (commentid)
  WHERE a.nature LIKE 'n%' AND (b.nature LIKE 'a%' OR (b.nature LIKE 'v%' AND b.nature <> 'vshi')) GROUP BY ALL"""
# Both forms of each document; equal tokens of the two forms do not occur.
_GATED = f"""WITH {_PLAIN_TRAINING},
  forms AS (SELECT doc_id, 0 AS form, text FROM documents UNION ALL SELECT doc_id, 1, {_widen('text')} FROM documents),
  tokens AS (SELECT (doc_id, form) AS doc_id, {_tokens('lower(text)')} AS tokens FROM forms),
  {_SCORE_DOCUMENTS} {_scoring(PASSES)}
  SELECT doc[1] AS doc_id, CASE WHEN known > 0 THEN pred_classes[1] ELSE '-100' END AS classid,
         CASE WHEN known > 0 THEN round(p1, 4) ELSE 0 END AS cvalue
  FROM top"""


def _large_lexicon(rounds: int = 18) -> str:
    """Longest words from left to right: the hits that are reached from each text's first one by jumps of doubled length."""
    k = inputs.LEXICON_LETTERS
    jumps = ", ".join(
        f"""reached{i + 1} AS MATERIALIZED (SELECT node FROM reached{i} UNION SELECT j.target FROM reached{i} JOIN jump{i} j USING (node)),
        jump{i + 1} AS MATERIALIZED (SELECT a.node, b.target FROM jump{i} a JOIN jump{i} b ON b.node = a.target)"""
        for i in range(rounds)
    )
    return f"""WITH {_TOKENS},
    solid AS (SELECT doc_id, regexp_replace(lower(CASE WHEN doc_id % 13 <> 4 THEN text END), '[^\\p{{L}}]', '', 'g') AS s FROM documents),
    vocab AS (SELECT DISTINCT word FROM (SELECT unnest(tokens) AS word FROM tokens) WHERE length(word) >= {k}),
    heads AS (SELECT left(word, {k}) AS head, length(word) AS n FROM vocab GROUP BY ALL),
    reach AS (SELECT max(length(word)) AS most FROM vocab),
    blocks AS (SELECT doc_id, start, substr(s, start + 1, 64 + most) AS part
               FROM (SELECT doc_id, s, unnest(range(0, length(s), 64)) AS start FROM solid), reach),
    places AS (SELECT doc_id, start + j - 1 AS pos, substr(part, j, most) AS part
               FROM (SELECT *, unnest(range(1, least(64, length(part)) + 1)) AS j FROM blocks), reach),
    longest AS (SELECT doc_id, pos, max(n) AS n FROM places JOIN heads ON left(part, {k}) = head AND length(part) >= n
                WHERE left(part, n) IN (SELECT word FROM vocab) GROUP BY doc_id, pos),
    hits AS MATERIALIZED (SELECT *, row_number() OVER () AS node FROM longest),
    jump0 AS MATERIALIZED (SELECT a.node, b.node AS target FROM hits a ASOF JOIN hits b ON b.doc_id = a.doc_id AND a.pos + a.n <= b.pos),
    reached0 AS MATERIALIZED (SELECT arg_min(node, pos) AS node FROM hits GROUP BY doc_id), {jumps},
    taken AS (SELECT doc_id, pos, n FROM hits JOIN reached{rounds} USING (node)),
    chars AS (SELECT doc_id, unnest(string_split(s, '')) AS c, unnest(range(0, length(s))) AS pos FROM solid WHERE s <> ''),
    marked AS (SELECT c.doc_id, c.pos, c.c, t.pos IS NULL OR c.pos = t.pos OR c.pos >= t.pos + t.n AS starts
               FROM chars c ASOF LEFT JOIN taken t ON t.doc_id = c.doc_id AND c.pos >= t.pos),
    cut AS (SELECT doc_id, substr(string_agg(CASE WHEN starts THEN ' ' ELSE '' END || c, '' ORDER BY pos), 2) AS words FROM marked GROUP BY doc_id)
    SELECT doc_id, coalesce(words, '') AS words FROM documents LEFT JOIN cut USING (doc_id)"""


_BEST_PATH = rf"""
WITH RECURSIVE {_TOKENS},
users(word) AS (VALUES {_rows([(word,) for word in inputs.SEGMENT_WORDS])}),
frequencies AS (
  SELECT word, count(*) AS f FROM (SELECT unnest(tokens) AS word FROM tokens) WHERE word NOT IN (SELECT word FROM users) GROUP BY word
  UNION ALL SELECT word, {USER_FREQUENCY} FROM users),
total AS (SELECT sum(f)::DOUBLE AS total, max(length(word)) AS most, round(ln(sum(f)::DOUBLE / 1) * 1000000)::BIGINT AS other FROM frequencies),
costs AS (SELECT word, round(ln(total / f) * 1000000)::BIGINT AS cost FROM frequencies, total),
solid AS (SELECT conv_id, turn, regexp_replace(lower(text), '[^\p{{L}}]', '', 'g') AS s FROM conversations),
ends AS (SELECT conv_id, turn, s, unnest(range(1, length(s) + 1)) AS e FROM solid),
ways AS (
  SELECT conv_id, turn, e, b, coalesce(cost, other) AS cost
  FROM (SELECT conv_id, turn, e, b, substr(s, b + 1, e - b) AS word, other
        FROM (SELECT *, unnest(range(greatest(0, e - most), e)) AS b FROM ends, total)) LEFT JOIN costs USING (word)
  WHERE cost IS NOT NULL OR e - b = 1),
states AS (
  SELECT conv_id, turn, {{costs: [0::BIGINT], backs: []::BIGINT[], ways: []::STRUCT(b BIGINT, cost BIGINT)[]}} AS state, 0 AS e FROM solid
  UNION ALL
  SELECT conv_id, turn, {{costs: []::BIGINT[], backs: []::BIGINT[], ways: list({{b: b, cost: cost}})}}, e FROM ways GROUP BY conv_id, turn, e),
solved AS (
  SELECT conv_id, turn, list_reduce(list(state ORDER BY e), lambda done, next: {{
      costs: list_append(done.costs, list_min(list_transform(next.ways, lambda w: {{cost: done.costs[w.b + 1] + w.cost, b: w.b}})).cost),
      backs: list_append(done.backs, list_min(list_transform(next.ways, lambda w: {{cost: done.costs[w.b + 1] + w.cost, b: w.b}})).b),
      ways: []::STRUCT(b BIGINT, cost BIGINT)[]}}).backs AS backs
  FROM states GROUP BY conv_id, turn),
walk AS (
  SELECT conv_id, turn, backs, len(backs)::BIGINT AS e, NULL::BIGINT AS until FROM solved
  UNION ALL SELECT conv_id, turn, backs, backs[e], e FROM walk WHERE e > 0)
SELECT s.conv_id, s.turn, coalesce(string_agg(substr(s.s, w.e + 1, w.until - w.e), ' ' ORDER BY w.e) FILTER (w.until IS NOT NULL), '') AS words
FROM solid s JOIN walk w ON w.conv_id = s.conv_id AND w.turn = s.turn GROUP BY s.conv_id, s.turn
"""

_NATURES_IN_CONTEXT = f"""
WITH RECURSIVE {_TOKENS},
read AS (SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM tokens),
behind AS (SELECT *, length(coalesce(lag(word) OVER (PARTITION BY doc_id ORDER BY pos), '')) % 2 = 0 AS even FROM read),
tagged AS (
  SELECT doc_id, pos, word, CASE WHEN length(word) > 9 THEN 'nz' WHEN regexp_matches(word, '[aeiou]$') THEN CASE WHEN even THEN 'n' ELSE 'v' END
    WHEN regexp_matches(word, '[nrst]$') THEN CASE WHEN even THEN 'a' ELSE 'n' END ELSE 'd' END AS nature FROM behind),
natures AS (SELECT nature FROM tagged UNION SELECT 'x'),
seen AS (SELECT before, nature, count(*) AS n FROM (
  SELECT nature, coalesce(lag(nature) OVER (PARTITION BY doc_id ORDER BY pos), '') AS before FROM tagged) GROUP BY ALL),
rows_seen AS (SELECT before, sum(n) AS total FROM seen GROUP BY before),
follow AS MATERIALIZED (
  SELECT b.before, a.nature, round(ln((coalesce(r.total, 0) + (SELECT count(*) FROM natures)) / (coalesce(s.n, 0) + 1)) * 1000000)::BIGINT AS cost
  FROM (SELECT nature AS before FROM natures UNION ALL SELECT '') b CROSS JOIN natures a
  LEFT JOIN seen s ON s.before = b.before AND s.nature = a.nature LEFT JOIN rows_seen r ON r.before = b.before),
emitted AS (
  SELECT word, nature, round(ln(sum(n) OVER (PARTITION BY nature) / n) * 1000000)::BIGINT AS cost
  FROM (SELECT word, nature, count(*) AS n FROM tagged GROUP BY ALL)),
turns AS (SELECT conv_id, turn, {_tokens('lower(text)')} AS tokens FROM conversations),
said AS (SELECT conv_id, turn, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM turns),
options AS MATERIALIZED (
  SELECT conv_id, turn, pos, coalesce(nature, 'x') AS nature, coalesce(cost, 0) AS cost FROM said LEFT JOIN emitted USING (word)),
ways AS (
  SELECT conv_id, turn, 0::BIGINT AS pos, '' AS nature, 0::BIGINT AS cost, '' AS path FROM turns
  UNION ALL
  SELECT w.conv_id, w.turn, o.pos, o.nature, min(w.cost + f.cost + o.cost),
    first(w.path || ' ' || o.nature ORDER BY w.cost + f.cost + o.cost, w.nature)
  FROM ways w JOIN options o ON o.conv_id = w.conv_id AND o.turn = w.turn AND o.pos = w.pos + 1
  JOIN follow f ON f.before = w.nature AND f.nature = o.nature
  GROUP BY w.conv_id, w.turn, o.pos, o.nature)
SELECT conv_id, turn, substr(first(path ORDER BY cost, nature), 2) AS natures
FROM ways JOIN (SELECT conv_id, turn, len(tokens) AS pos FROM turns) USING (conv_id, turn, pos) GROUP BY conv_id, turn
"""

ORACLE_SQL: dict[str, str] = {
    "scan_comments_by_day": f"""WITH {_COMMENTS.format(day=inputs.DAY, nature="CASE lang WHEN 'en' THEN -1 WHEN 'fr' THEN 0 WHEN 'es' THEN 1 END")}
        SELECT * EXCLUDE (dt) FROM comments WHERE nature < 1 AND dt = {inputs.DAY} AND content IS NOT NULL""",
    "scan_messages_by_hour": f"WITH {_MESSAGES} SELECT id, content FROM messages WHERE {_THIS_HOUR}",
    "keyword_first_two_fields": "SELECT p_brand AS a, p_name AS b FROM part WHERE p_size <= 25",
    "labelled_lines": f"WITH {_DOCUMENT_LINES} SELECT doc_id, label, text FROM lines WHERE labelled",
    "dedupe_last_label": f"WITH {_SENTENCES}, {_LAST_LABELS} SELECT text, label FROM last_labels",
    "prediction_lines": f"""WITH {_DOCUMENT_LINES}
        SELECT doc_id, CASE WHEN labelled THEN label ELSE 'noclassid' END AS id,
               CASE WHEN labelled THEN text ELSE mark || text END AS text FROM lines""",
    "prediction_lines_unlabelled": f"""WITH {_DOCUMENT_LINES}
        SELECT doc_id, '-100' AS id, CASE WHEN labelled THEN mark || label || chr(9) || text ELSE mark || text END AS text
        FROM lines""",
    "training_tokens": f"""WITH {_DOCUMENT_LINES}
        SELECT doc_id, label, array_to_string(list_filter(tokens, lambda w: w NOT IN ({_list(TRAINING_STOP_WORDS)})), ' ') AS words
        FROM (SELECT doc_id, label, {_tokens('lower(text)')} AS tokens FROM lines WHERE labelled) WHERE words <> ''""",
    "training_tokens_folded": f"""WITH {_DOCUMENT_LINES}
        SELECT doc_id, label, array_to_string(list_filter(tokens, lambda w: w NOT IN ({_list(inputs.STOP_WORDS)})), ' ') AS words
        FROM (SELECT doc_id, label, {_tokens(f"lower(translate(text, {_FOLD_LETTERS}))")} AS tokens FROM lines WHERE labelled)
        WHERE words <> ''""",
    "encoding_fallback": "SELECT doc_id, replace(text, chr(10), ' ') || ' 手机' AS text FROM documents",
    "sink_partition_roundtrip": _COLUMNS.format(partition=f"CAST({inputs.DAY} AS BIGINT)")
    + " UNION ALL " + _COLUMNS.format(partition=f"CAST({inputs.DAY + 1} AS BIGINT)") + " WHERE lang = 'en'",
    "sink_string_partition": _COLUMNS.format(partition="'it''s day 1'"),
    "sink_hour_roundtrip": f"WITH {_MESSAGES} SELECT * FROM messages WHERE {_THIS_HOUR}",
    "sink_ddl": """SELECT count(*) AS n, '`doc_id` bigint, `text` string, `width` int, `english` boolean, `quarter` double' AS ddl
        FROM documents""",
    "lines_out_roundtrip": """SELECT doc_id || chr(9) || CASE WHEN doc_id % 4 <> 1 THEN lang ELSE '' END || chr(9) ||
        '  "say \\"hi\\" ' || translate(text, chr(10) || chr(9), '  ') || ' now"  ' AS line FROM documents""",
    "fold_width": f"SELECT doc_id, length({_widen('text')}) AS chars, {_narrow(_widen('text'))} AS folded FROM documents",
    "fold_variants": f"SELECT doc_id, translate(text, {_FOLD_LETTERS}) AS folded FROM documents",
    "fold_phrases": f"""SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(list_transform(
        regexp_extract_all(text, {_text("(?s)" + "|".join(sorted(inputs.PHRASES, key=len, reverse=True)) + "|.")}),
        lambda part: coalesce(MAP {{{", ".join(f"{_text(old)}: {_text(new)}" for old, new in inputs.PHRASES.items())}}}[part], part)), ''), '') END AS folded
        FROM (SELECT doc_id, CASE WHEN doc_id % 13 <> 4 THEN text END AS text FROM documents)""",
    "tokenize": f"WITH {_TOKENS} SELECT doc_id, len(tokens) AS n, array_to_string(tokens, ' ') AS words FROM tokens",
    "normalized_tokens": f"""SELECT doc_id, array_to_string({_tokens(f"lower(translate({_narrow(_widen('text'))}, {_FOLD_LETTERS}))")}, ' ') AS words
        FROM documents""",
    "stop_word_filter": f"""WITH {_TOKENS} SELECT doc_id,
        array_to_string(list_filter(tokens, lambda w: w NOT IN ({_list(inputs.STOP_WORDS)})), ' ') AS words FROM tokens""",
    "tokenize_with_nature": f"""WITH {_TOKENS}, {_LEXICON},
        places AS (SELECT doc_id, generate_subscripts(tokens, 1) - 1 AS pos, unnest(tokens) AS word FROM tokens)
        SELECT doc_id, pos, word, coalesce(nature, 'x') AS nature FROM places LEFT JOIN lexicon USING (word)""",
    "tokenize_with_nature_in_context": _NATURES_IN_CONTEXT,
    "lexicon_with_user_words": f"""WITH {_TOKENS},
        base AS (SELECT DISTINCT unnest(tokens) AS word FROM tokens),
        users AS (SELECT DISTINCT unnest({_tokens('lower(text)')}) AS word FROM benchmark)
        SELECT word, CASE WHEN word IN (SELECT word FROM users) THEN 'mzm' WHEN word LIKE '%tion' THEN 'n'
               WHEN word LIKE '%ly' THEN 'd' WHEN word LIKE '%ing' THEN 'v' ELSE 'x' END AS nature
        FROM (SELECT word FROM base UNION SELECT word FROM users)""",
    "segment_longest_match": _SEGMENTED,
    "segment_longest_match_by_join": _SEGMENTED,
    "segment_large_lexicon": _large_lexicon(),
    "segment_best_path": _BEST_PATH,
    "keyword_rules": f"""WITH {_RULES} SELECT doc_id, pos, class, array_to_string(subjects, '|') AS subjects,
        array_to_string(descriptors, '|') AS descriptors FROM rules""",
    "keyword_dictionary": f"WITH {_RULES} SELECT * FROM dictionary",
    "ambiguous_keywords": f"""WITH {_RULES} SELECT DISTINCT word
        FROM (SELECT role, word FROM dictionary GROUP BY ALL HAVING count(DISTINCT class) > 1)""",
    "keyword_hits": f"WITH {_SOME_TOKENS}, {_KEYWORDS} SELECT doc_id, words FROM keyed",
    "keyword_hits_large_dictionary": f"""WITH {_RULES}, {_SOME_TOKENS},
        places AS (SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM tokens),
        hits AS (SELECT doc_id, pos, role, word FROM places
                 JOIN (SELECT DISTINCT role, word FROM dictionary) USING (word))
        SELECT t.doc_id, coalesce(string_agg(word, ',' ORDER BY pos) FILTER (role = 'm'), '') || '|' ||
               coalesce(string_agg(word, ',' ORDER BY pos) FILTER (role = 'd'), '') AS words
        FROM tokens t LEFT JOIN hits USING (doc_id) GROUP BY t.doc_id""",
    "keyword_classes": _KEYWORD_CLASSES,
    "keyword_classes_by_join": f"""WITH {_SOME_TOKENS}, {_KEYWORDS}
        SELECT doc_id, words, array_to_string(key_classes, ',') AS class FROM keyed""",
    "keyword_vote_top3": f"WITH {_SOME_TOKENS}, {_KEYWORDS} SELECT doc_id, place, class, votes FROM votes",
    "word_class_counts": f"""WITH {_LABELLED_WORDS}
        SELECT word, label, count(*) AS cnt FROM words WHERE length(word) < 20 GROUP BY ALL""",
    "selected_words": f"""WITH {_LABELLED_WORDS}
        SELECT word, count(*) AS total, count(DISTINCT label) AS class_cnt FROM words
        WHERE length(word) < 20 AND word NOT IN ({_list(FEATURE_STOP_WORDS)}) GROUP BY word HAVING count(*) >= 2""",
    "vocabulary": f"WITH {_LABELLED_WORDS} SELECT DISTINCT word FROM words",
    "class_prior": f"""WITH {_LABELLED_WORDS}
        SELECT label, count(*) AS texts, round(count(*) / (SELECT count(*) FROM labelled), 9) AS share FROM labelled GROUP BY label""",
    "features_binary": f"""WITH {_LABELLED_WORDS}, {_TOKENS}, places AS (SELECT doc_id, unnest(tokens) AS word FROM tokens)
        SELECT DISTINCT doc_id, word, CAST(1 AS BIGINT) AS value FROM places WHERE word IN (SELECT word FROM words)""",
    "features_counts": f"""WITH {_LABELLED_WORDS}, {_TOKENS}, places AS (SELECT doc_id, unnest(tokens) AS word FROM tokens)
        SELECT doc_id, word, count(*) AS value FROM places WHERE word IN (SELECT word FROM words) GROUP BY ALL""",
    "features_labelled": f"""WITH {_LABELLED_WORDS}
        SELECT DISTINCT doc_id, label, word, CAST(1 AS BIGINT) AS value FROM words WHERE word IN (
          SELECT word FROM words WHERE length(word) < 20 AND word NOT IN ({_list(FEATURE_STOP_WORDS)})
          GROUP BY word HAVING count(*) >= 2)""",
    "train_term_weights": _term_weights(PASSES),
    "train_term_weights_by_join": _term_weights(PASSES_BY_JOIN),
    "train_all_passes": _term_weights(PASSES),
    "train_document_weights": f"""WITH {_PLAIN_ROWS} {_training(PASSES_BY_JOIN)}
        SELECT doc AS doc_id, label, round(w, 4) AS weight FROM weight{PASSES_BY_JOIN}""",
    "class_distribution": _DISTRIBUTION,
    "class_distribution_by_join": _DISTRIBUTION,
    "predict_with_gate": _GATED,
    "predict_top3": f"""WITH {_PLAIN_TRAINING}, {_TOKENS}, {_SCORE_DOCUMENTS} {_scoring(PASSES)}
        SELECT doc AS doc_id, array_to_string(pred_classes, ',') AS classes, round(p1, 4) AS p1 FROM top""",
    "merge_classes": f"""WITH {_SOME_TOKENS}, {_KEYWORDS}, {_COMMENT_TRAINING}, {_SCORE_DOCUMENTS} {_scoring(PASSES)}, {_MERGED}
        SELECT doc_id, keyclass, predclass, class FROM final""",
    "merge_classes_cautious": f"""WITH {_SOME_TOKENS}, {_KEYWORDS}, {_COMMENT_TRAINING}, {_SCORE_DOCUMENTS} {_scoring(PASSES)},
        {_MERGED.replace("p1 > 0.7", "p1 > 1").replace("p1 > 0.9", "p1 > 1")}
        SELECT doc_id, keyclass, predclass, class FROM final""",
    "classify_comments": f"""WITH {_SOME_TOKENS}, {_KEYWORDS}, {_COMMENT_TRAINING}, {_SCORE_DOCUMENTS} {_scoring(PASSES)}, {_MERGED},
        {_NOT_POSITIVE}
        SELECT commentid, nature, content, words, class, devicecode, brandcode, storename, storeid, createtime
        FROM comments JOIN final ON createtime = doc_id WHERE nature < 1 AND dt = {inputs.DAY} AND content IS NOT NULL""",
    "score_messages_hourly": f"""WITH {_MESSAGE_TRAINING}, {_MESSAGES},
        score_docs AS (SELECT id AS doc FROM messages WHERE {_THIS_HOUR}),
        score_words AS MATERIALIZED (SELECT DISTINCT doc, word
          FROM (SELECT id AS doc, unnest({_tokens('content')}) AS word FROM messages WHERE {_THIS_HOUR})),
        {_scoring(1)}
        SELECT id, CASE WHEN known > 0 THEN pred_classes[1] ELSE '-100' END AS classid,
               CASE WHEN known > 0 THEN round(p1, 4) ELSE 0 END AS cvalue, content
        FROM messages JOIN top ON doc = id""",
    "score_lines": f"""WITH {_MESSAGE_TRAINING}, {_DOCUMENT_LINES},
        score_docs AS (SELECT doc_id AS doc FROM lines),
        score_words AS MATERIALIZED (SELECT DISTINCT doc, word
          FROM (SELECT doc_id AS doc, unnest({_tokens('text')}) AS word FROM lines)),
        {_scoring(1)}
        SELECT CASE WHEN labelled THEN label ELSE 'noclassid' END AS label,
               CASE WHEN known > 0 THEN pred_classes[1] ELSE '-100' END AS predicted,
               CASE WHEN known > 0 THEN round(p1, 4) ELSE 0 END AS confidence,
               CASE WHEN labelled THEN text ELSE mark || text END AS text
        FROM lines JOIN top ON doc = doc_id""",
    "training_fit_report": f"""WITH {_FIT_TRAINING},
        score_docs AS (SELECT doc FROM train_docs), score_words AS (SELECT doc, word FROM train_words), {_scoring(PASSES)}
        SELECT label, CASE WHEN known > 0 THEN pred_classes[1] ELSE '-100' END AS predicted,
               CASE WHEN known > 0 THEN round(p1, 4) ELSE 0 END AS confidence, text
        FROM lines JOIN top ON doc = doc_id""",
    "noun_predicate_pairs": _PAIRS,
    "noun_predicate_pairs_by_join": _PAIRS,
    "noun_predicate_pairs_folded": _PAIRS.replace("lower(content)", f"lower(translate(content, {_FOLD_LETTERS}))").replace(
        "WHERE NOT (nature", "WHERE word NOT IN ('are', 'eau') AND NOT (nature"
    ),
}
