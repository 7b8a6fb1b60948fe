"""The results of the queries in DuckDB SQL, from the test tables alone."""

from __future__ import annotations

from checks import inputs as given
from checks.queries import EXCLUDED_TYPES
from grantlens.sources import lexicon as lx

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

# ---- scoring ------------------------------------------------------------------

FINANCE_LEXICON = f"""
lexicon AS (
  SELECT upper(word) AS word, positive <> 0 AS positive, negative <> 0 AS negative,
    uncertainty <> 0 AS uncertainty, litigious <> 0 AS litigious,
    modal_number = 3 AS modal_weak, modal_number = 2 AS modal_moderate,
    modal_number = 1 AS modal_strong, constraining <> 0 AS constraining, syllables
  FROM (VALUES {given.finance_values()}) AS t(word, {', '.join(given.FLAGS)}, modal_number, syllables)
  WHERE length(word) > 1 AND NOT regexp_full_match(word, '[0-9]+'))
"""
INQUIRER_LEXICON = f"""
lexicon AS (
  SELECT upper(word) AS word, {', '.join(f"{name} <> '' AS {name}" for name in lx.INQUIRER_CATEGORIES)}
  FROM (VALUES {given.inquirer_values()}) AS t(word, {', '.join(lx.INQUIRER_CATEGORIES)})
  WHERE length(word) > 1 AND NOT regexp_full_match(word, '[0-9]+'))
"""
STORED = "rtrim(coalesce(text, ''), 'None')"


def _words(text: str, key: str = "doc_id", source: str = "documents") -> str:
    return f"""
words AS (
  SELECT id, upper(replace(word, 'ß', 'ss')) AS word
  FROM (SELECT {key} AS id, unnest(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]+')) AS word FROM {source}))
"""


def _sums(flags) -> str:
    parts = ",\n    ".join(
        f"CAST(count(*) FILTER (WHERE lexicon.{flag}) AS BIGINT) / count(*) * 100 AS {flag}"
        for flag in flags
    )
    return f"CAST(count(*) AS INT) AS word_count, {parts}"


def _shares(flags) -> str:
    return ", ".join(f"coalesce({flag}, 0.0) AS {flag}" for flag in flags)


def _stats(text: str) -> str:
    joined = f"regexp_replace({text}, '[.,]([0-9])', '\\1', 'g')"
    return f"""
    CAST(length(regexp_replace({text}, '[^A-Z]', '', 'g')) AS INT) AS alphabetic,
    CAST(length(regexp_replace({text}, '[^0-9]', '', 'g')) AS INT) AS digits,
    CAST(len(list_filter(regexp_extract_all({joined}, '[\\p{{L}}\\p{{N}}]+'),
      lambda run: regexp_full_match(run, '\\p{{Nd}}+'))) AS INT) AS numbers"""


def _finance(
    lexicon: str = FINANCE_LEXICON,
    text: str = STORED,
    where: str = "true",
    key: str = "doc_id",
    out_key: str = "doc_id",
    extra: str = "",
    source: str = "documents",
    before: str = "",
) -> str:
    return f"""
WITH {before} {lexicon}, {_words(text, key, source)},
scores AS (
  SELECT id, {_sums(lx.FINANCE_FLAGS)},
    CAST(sum(syllables) AS BIGINT) / count(*) AS avg_syllables_per_word,
    CAST(sum(length(word)) AS BIGINT) / count(*) AS avg_word_length,
    CAST(count(DISTINCT word) AS INT) AS vocabulary
  FROM words JOIN lexicon USING (word) GROUP BY id)
SELECT {key} AS {out_key}, {extra} coalesce(word_count, 0) AS word_count, {_shares(lx.FINANCE_FLAGS)},
  {_stats(text)},
  coalesce(avg_syllables_per_word, 0.0) AS avg_syllables_per_word,
  coalesce(avg_word_length, 0.0) AS avg_word_length, coalesce(vocabulary, 0) AS vocabulary
FROM {source} LEFT JOIN scores ON id = {key} WHERE {where}
"""


def _inquirer(where: str = "true") -> str:
    return f"""
WITH {INQUIRER_LEXICON}, {_words(STORED)},
scores AS (
  SELECT id, {_sums(lx.INQUIRER_CATEGORIES)} FROM words JOIN lexicon USING (word) GROUP BY id)
SELECT doc_id, coalesce(word_count, 0) AS word_count, {_shares(lx.INQUIRER_CATEGORIES)}
FROM documents LEFT JOIN scores ON id = doc_id WHERE {where}
"""


def _corpus() -> str:
    """Lexicon cells of every word, before typing."""
    cells = ", ".join(f"{sql} AS {name}" for name, sql in given.CORPUS_CELLS.items())
    return f"""
corpus AS (
  SELECT {cells} FROM (
    SELECT upper(replace(word, 'ß', 'ss')) AS word, count(DISTINCT doc_id) AS doc_count
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM documents)
    GROUP BY 1))
"""


STOP_WORDS = ", ".join(f"'{word}'" for word in lx.STOP_WORDS)
TYPED = f"""
typed AS (
  SELECT * REPLACE (negative <> 0 AS negative, positive <> 0 AS positive, uncertainty <> 0 AS uncertainty,
      litigious <> 0 AS litigious, constraining <> 0 AS constraining),
    modal_number = 1 AS strong_modal, modal_number = 2 AS moderate_modal, modal_number = 3 AS weak_modal,
    word IN ({STOP_WORDS}) AS stop_word
  FROM corpus)
"""
CORPUS_LEXICON = f"""
{_corpus()}, {TYPED},
lexicon AS (
  SELECT word, positive, negative, uncertainty, litigious, weak_modal AS modal_weak,
    moderate_modal AS modal_moderate, strong_modal AS modal_strong, constraining, syllables
  FROM typed WHERE length(word) > 1 AND NOT regexp_full_match(word, '[\\p{{Nd}}²³¹]+'))
"""

QUALITY = "doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"
TOXIC = "doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"

REPORT_TEXT = "upper(regexp_replace(replace(coalesce(text, ''), 'ß', 'ss'), '(May|MAY)', ' ', 'g'))"

# ---- names and patents --------------------------------------------------------

TYPES = ", ".join(f"'{name}'" for name in EXCLUDED_TYPES)
PARTICIPANT_MEMBERS = f"""
members AS (
  SELECT name, gan FROM ({given.PARTICIPANTS})
  WHERE type NOT IN ({TYPES}) AND name NOT ILIKE '%Univers%' AND name NOT ILIKE '%Univerz%'
    AND name NOT ILIKE '%College%')
"""
LEADER_MEMBERS = f"""
members AS (
  SELECT trim(string_split(leaders, '|')[2]) AS name, gan FROM ({given.PROJECTS}) WHERE leaders <> '')
"""
BARE = r"regexp_replace(regexp_replace(name, '(?i)(^|[ ,]+)(ltd|gmbh & co\. kg|inc\.)$', ''), '[\s,.;]+$', '')"
GRANTS = """
owner AS (SELECT s_suppkey AS id, s_name AS organization FROM supplier),
link AS (SELECT l_suppkey AS owner_id, l_orderkey AS doc_id FROM lineitem),
doc AS (SELECT o_orderkey AS id, o_orderdate AS d FROM orders)
"""
APPLICATIONS = """
owner AS (SELECT c_custkey AS id, c_name AS organization FROM customer),
link AS (SELECT o_custkey AS owner_id, o_orderkey AS doc_id FROM orders),
doc AS (SELECT o_orderkey AS id, o_orderdate AS d FROM orders)
"""


def _groups(members: str) -> str:
    return f"""
WITH {members}
SELECT name, gan, count(*) AS copies FROM members GROUP BY name, gan
"""


def _yearly(patents: str) -> str:
    return f"""
WITH {patents}
SELECT organization, CAST(year(d) AS INT) AS year, count(doc.id) AS count
FROM owner LEFT JOIN link ON owner_id = owner.id LEFT JOIN doc ON doc.id = doc_id
GROUP BY 1, 2
"""


def _report(members: str, patents: str) -> str:
    return f"""
WITH {members}, {patents},
names AS (SELECT DISTINCT name, {BARE} AS bare FROM members WHERE name <> ''),
counts AS (
  SELECT organization, CAST(year(d) AS INT) AS year, CAST(count(doc.id) AS INT) AS count
  FROM owner JOIN link ON owner_id = owner.id JOIN doc ON doc.id = doc_id GROUP BY 1, 2),
hits AS (
  SELECT name, organization FROM names, (SELECT DISTINCT organization FROM counts)
  WHERE bare <> '' AND starts_with(lower(organization), lower(bare)))
SELECT CAST(gan AS INT) AS gans, name AS participant_name, organization, year, count
FROM members JOIN hits USING (name) JOIN counts USING (organization)
"""


REPORTS = {
    ("participants", "applications"): _report(PARTICIPANT_MEMBERS, APPLICATIONS),
    ("participants", "grants"): _report(PARTICIPANT_MEMBERS, GRANTS),
    ("leaders", "applications"): _report(LEADER_MEMBERS, APPLICATIONS),
    ("leaders", "grants"): _report(LEADER_MEMBERS, GRANTS),
}

# ---- pages --------------------------------------------------------------------


def _stripped(html: str) -> str:
    return (
        f"regexp_replace(replace(regexp_replace({html}, '<[^\\n]*?>', '', 'g'), chr(10), ' '), "
        f"'^{SPACE}+|{SPACE}+$', '', 'g')"
    )


# What the captured project and call pages say, told from the orders.
PROJECTS = f"""
p AS (
  SELECT o_orderkey AS k, CAST(o_orderkey // 2 AS INT) AS gan_no, o_custkey AS c,
    CAST(trunc(o_totalprice) AS BIGINT) AS price, CAST(o_orderdate AS DATE) AS d,
    CAST(o_orderdate AS DATE) + 1000 AS e, o_orderstatus, o_orderpriority
  FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 79 <> 0),
items AS (
  SELECT k AS page_id, '{given.PROJECT_ADDRESS}' || k AS url,
    CASE WHEN k % 97 = 0 THEN 'n/a' ELSE CAST(gan_no AS VARCHAR) END AS gan,
    'Project & partners ' || k AS project_name,
    CASE WHEN k % 89 = 0 THEN 'soon' ELSE strftime(d, '%-d/%-m/%Y') END AS start_date,
    strftime(e, '%d/%m/%Y') AS end_date, 'CALL-' || (c % 50) AS call_id,
    o_orderstatus AS status, o_orderpriority AS program,
    CASE WHEN k % 3 = 0 THEN '' WHEN k % 5 = 0 THEN 'Area ' || (k % 7) || '|Area x'
      ELSE 'Area ' || (k % 7) END AS disease_area,
    'Product ' || (k % 11) AS products,
    CASE WHEN k % 2 = 0 THEN '' ELSE 'Tool ' || (k % 17) END AS tools,
    CAST(price AS VARCHAR) AS imi_funding,
    CASE WHEN k % 4 <> 1 THEN CAST(price * 2 AS VARCHAR) END AS efpia_inkind,
    CASE WHEN k % 83 = 0 THEN '1.5' ELSE CAST(k % 1000 AS VARCHAR) END AS other,
    'Intro of ' || k AS project_intro, 'www.p' || k || '.example.org' AS project_website,
    CASE WHEN k % 6 <> 1 THEN '@p' || k END AS twitter_handle,
    'Coordinator ' || c || '|Customer ' || c AS project_coordinator,
    'Leader ' || k || '| Customer#' || lpad(CAST(c AS VARCHAR), 9, '0') || ' Ltd ' AS project_leader,
    CASE WHEN k % 5 = 0 THEN '' ELSE 'Manager ' || k END AS project_manager,
    'About project ' || k AS summary
  FROM p),
funding AS (
  SELECT k, 'Customer ' || c AS name, CAST(price AS INT) AS funding,
    '<tr><td>Customer ' || c || '</td><td>' || replace(format('{{:,}}', price), ',', ' ') || '</td></tr>' AS raw_text,
    NULL AS reason FROM p
  UNION ALL SELECT k, 'Fund' || chr(160) || k, 1000, '<tr><td>Fund&nbsp;' || k || '</td><td>1 000</td></tr>', NULL FROM p
  UNION ALL SELECT k, 'Beta', NULL, '<tr><td>Beta</td><td>n/a</td></tr>', 'amount is not a whole number' FROM p WHERE k % 10 = 3
  UNION ALL SELECT k, '', NULL, '<tr></tr>', 'fewer than two cells' FROM p WHERE k % 10 = 3
  UNION ALL SELECT k, '5 000', NULL, '<tr><td>Total Cost</td><td>5 000</td></tr>', 'amount is not a whole number' FROM p),
participant AS (
  SELECT k, 'Acme ' || c AS name, 'SME' AS type, 'Paris' AS city, NULL AS region, 'France' AS country, NULL AS reason FROM p
  UNION ALL SELECT k, 'Beta ' || k, 'SME', 'Austin', 'Texas', 'USA', NULL FROM p
  UNION ALL SELECT k, 'Gamma', 'SME', 'Rome', NULL, NULL, 'neither three nor four parts' FROM p WHERE k % 7 = 0
  UNION ALL SELECT k, 'Uni ' || (k % 13), 'Public Sector', 'Rome', NULL, 'Italy', NULL FROM p),
known AS (SELECT DISTINCT CAST(o_orderkey // 2 AS INT) AS gan_no FROM orders WHERE {given.KNOWN_PROJECT}),
checked AS (
  SELECT *, CASE WHEN k % 97 = 0 THEN 'gan is not a whole number' WHEN k % 89 = 0 THEN 'start_date is not a date'
    WHEN k % 83 = 0 THEN 'other is not a whole number' END AS reason FROM p),
fresh AS (
  SELECT * FROM checked WHERE reason IS NULL AND gan_no NOT IN (SELECT gan_no FROM known)
  QUALIFY row_number() OVER (PARTITION BY gan_no ORDER BY k) = 1),
refused AS (
  SELECT * FROM checked r WHERE reason IS NOT NULL AND (k % 97 = 0 OR (
    gan_no NOT IN (SELECT gan_no FROM known)
    AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.gan_no = r.gan_no AND f.k < r.k))))
"""

CALLS = f"""
items AS (
  SELECT o_orderkey AS k, '{given.CALL_ADDRESS}' || o_orderkey AS url,
    CASE WHEN o_orderkey % 53 <> 0 THEN 'CALL-' || (o_orderkey // 8) END AS call_id,
    'Topic ' || (o_orderkey % 19) || '|Topic of customer ' || o_custkey || '|EUR ' || CAST(trunc(o_totalprice) AS BIGINT) AS topics,
    'EUR ' || CAST(trunc(o_totalprice) AS BIGINT) AS indicative_budget,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN '99999999999'
      ELSE CAST(o_orderkey % 400 AS VARCHAR) END AS proposal_submitted,
    CAST(o_orderdate AS DATE) AS call_date
  FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % 71 <> 0),
known AS (SELECT DISTINCT 'CALL-' || (o_orderkey // 8) AS call_id FROM orders WHERE {given.KNOWN_CALL}),
open_items AS (SELECT * FROM items WHERE call_id IS NULL OR call_id NOT IN (SELECT call_id FROM known))
"""
TOO_LARGE = "coalesce(proposal_submitted, '') = '99999999999'"

PROJECT_TEXTS = (
    "project_name, call_id, status, program, disease_area, products, tools, project_intro, "
    "project_website, twitter_handle, project_coordinator, project_leader, project_manager, "
    "url, summary"
)

ORACLE: dict[str, str] = {
    "finance_profile": _finance(),
    "inquirer_profile": _inquirer(),
    "corpus_profile": _finance(CORPUS_LEXICON),
    "shuffled_profile": _finance(CORPUS_LEXICON),
    "char_statistics": f"SELECT doc_id, {_stats('text')} FROM documents",
    "trailing_strip": f"SELECT doc_id, {STORED} AS text, CAST(length({STORED}) AS INT) AS n_chars FROM documents",
    "word_counts": f"""
WITH {_words("coalesce(text, '')")}
SELECT doc_id, CAST(count(word) AS INT) AS n_tokens, CAST(count(DISTINCT word) AS INT) AS n_distinct
FROM documents LEFT JOIN words ON id = doc_id GROUP BY doc_id""",
    "pending_documents": f"""
SELECT doc_id, CAST(length(text) AS INT) AS n_chars, NOT {QUALITY} AS needs_finance, NOT {TOXIC} AS needs_inquirer
FROM documents WHERE NOT {QUALITY} OR NOT {TOXIC}""",
    "pending_by_bits": """
SELECT * FROM (
  SELECT doc_id, CAST(length(text) AS INT) AS n_chars,
    doc_id NOT IN (SELECT l_partkey FROM lineitem) AS needs_part,
    doc_id NOT IN (SELECT l_orderkey FROM lineitem) AS needs_order
  FROM documents)
WHERE needs_part OR needs_order""",
    "incremental_profile": _finance(where=f"NOT {QUALITY}"),
    "incremental_inquirer": _inquirer(f"NOT {TOXIC}"),
    "append_scores": f"""
SELECT doc_id, f.word_count AS finance_words, i.word_count AS inquirer_words, vocabulary
FROM ({_finance()}) f JOIN ({_inquirer()}) i USING (doc_id)""",
    "file_report": _finance(
        text=REPORT_TEXT,
        key="source || '/' || doc_id",
        out_key="file_name",
        extra="CAST(length(coalesce(text, '')) AS INT) AS file_size,",
    ),
    "file_report_stream": "SELECT * EXCLUDE (file) FROM (" + _finance(
        text=REPORT_TEXT,
        key="file",
        out_key="file",
        extra="CAST(length(text) AS INT) AS file_size,",
        source="landed",
        before="""landed AS (
  SELECT doc_id // 50 AS file, string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) || chr(10) AS text
  FROM documents GROUP BY 1),""",
    ) + ")",
    "text_files": """
SELECT CAST(sum(length(text) + 1) AS BIGINT) AS n_chars,
  CAST(sum(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+'))) AS BIGINT) AS n_tokens,
  CAST(sum(length(regexp_replace(text, '[^0-9]', '', 'g'))) AS BIGINT) AS n_digits
FROM documents""",
    "lexicon_load": f"WITH {_corpus()}, {TYPED} SELECT * FROM typed",
    "lexicon_documents": f"WITH {_corpus()} SELECT CAST(sum(doc_count + 1) AS BIGINT) AS total_documents FROM corpus",
    "lexicon_metadata": f"""
WITH {_corpus()}
SELECT '{','.join(lx.FINANCE_COLUMNS)}' AS header, '{','.join(lx.FINANCE_CATEGORIES)}' AS categories,
  '{','.join(lx.STOP_WORDS)}' AS stop_words, CAST(sum(doc_count + 1) AS BIGINT) AS total_documents FROM corpus""",
    "inquirer_load": f"""
WITH {_corpus()}
SELECT word, source, {', '.join(f'doc_count % {step} = 0 AS {name}' for step, name in enumerate(lx.INQUIRER_CATEGORIES, start=2))},
  word IN ({STOP_WORDS}) AS stop_word FROM corpus""",
    "lexicon_words": f"WITH {_corpus()}, {TYPED} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS category, word, 0 AS count FROM typed WHERE {name}"
        for name in lx.FINANCE_CATEGORIES
    ),
    "stop_words": f"WITH {_corpus()}, {TYPED} SELECT word, doc_count FROM typed WHERE stop_word",
    "participant_groups": _groups(PARTICIPANT_MEMBERS),
    "leader_groups": _groups(LEADER_MEMBERS),
    "clean_names": r"""
WITH plain AS (
  SELECT p_partkey, string_split(regexp_replace(regexp_replace(regexp_replace(
    trim(regexp_replace(p_brand || ' & Co. ' || p_name, '[^a-zA-Z0-9& ]', '', 'g')),
    '(?i)\bsmall\b', 'tiny', 'g'), '(?i)\bred\b', 'crimson', 'g'), '(?i)\bco\b', 'company', 'g'), ' ') AS w
  FROM part)
SELECT p_partkey, trim(array_to_string(w[1:len(w) - 1], ' ') || ' ' ||
  regexp_replace(lower(w[len(w)]), '\b(ring|bolt)\b', '', 'g')) AS clean FROM plain""",
    "strip_suffix": rf"""
SELECT gan, {BARE} AS company,
  regexp_replace(regexp_replace(name, '(?i)(^|[ ,.]+)(widget|bolt)$', ''), '[\s,.;]+$', '') AS part
FROM ({given.PARTICIPANTS})""",
    "prefix_match": f"""
WITH names AS (SELECT name FROM ({given.PARTICIPANTS}) WHERE name IS NOT NULL),
keys AS (SELECT name AS key FROM names UNION SELECT rtrim(name, '0123456789 LtdGmbHKIncCo.&,') FROM names),
owners AS (SELECT s_name AS organization FROM supplier UNION SELECT c_name FROM customer)
SELECT key, organization FROM keys, owners
WHERE key <> '' AND starts_with(lower(organization), lower(key))""",
    "yearly_grants": _yearly(GRANTS),
    "yearly_applications": _yearly(APPLICATIONS),
    "bucketed_grants": _yearly(GRANTS),
    "bucketed_applications": _yearly(APPLICATIONS),
    "participant_grants": REPORTS["participants", "grants"],
    "participant_applications": REPORTS["participants", "applications"],
    "leader_grants": REPORTS["leaders", "grants"],
    "leader_applications": REPORTS["leaders", "applications"],
    "all_reports": " UNION ALL ".join(
        f"SELECT '{source}' AS source_type, '{data}' AS data_type, * FROM ({sql})"
        for (source, data), sql in REPORTS.items()
    ),
    "export_roundtrip": f"""
SELECT kind, organization, year, count FROM ({_yearly(GRANTS)}), (VALUES ('csv'), ('table')) AS t(kind)""",
    "page_fields": rf"""
WITH cut AS (
  SELECT page_id, url, html, string_split(string_split(html, '<article>')[2], '</article>')[1] AS article FROM pages)
SELECT page_id, {_stripped("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS title,
  CAST(length({_stripped('article')}) AS INT) AS n_chars,
  CAST(len(regexp_extract_all(html, '(?s)<li\b[^>]*>.*?</li\s*>')) AS INT) AS n_items,
  {_stripped("nullif(regexp_extract(article, '(?s)(<p>.*?</p>)', 1), '')")} AS first_paragraph,
  regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host, string_split(url, '/')[-2] AS kind
FROM cut""",
    "page_links": r"""
WITH found AS (
  SELECT regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS site,
    unnest(regexp_extract_all(html, '<a\b[^>]*?\shref="([^"]*)"', 1)) AS href FROM pages),
absolute AS (
  SELECT DISTINCT CASE WHEN starts_with(href, '/') THEN site || replace(href, '&amp;', '&') ELSE href END AS url FROM found)
SELECT url FROM absolute WHERE regexp_matches(url, '/[A-Za-z]+$')
  AND regexp_matches(url, '^https?://([^/?#:]*\.)?example\.(com|org)([/?#:]|$)')""",
    "page_addresses": r"""
WITH found AS (
  SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS site,
    unnest(regexp_extract_all(html, '<a\b[^>]*?\shref="([^"]*)"', 1)) AS href FROM pages),
absolute AS (
  SELECT page_id, CASE WHEN starts_with(href, '/') THEN site || replace(href, '&amp;', '&') ELSE href END AS url FROM found),
every AS (
  SELECT url, page_id, 0 AS own FROM absolute UNION ALL SELECT url, page_id, 1 FROM pages),
cut AS (
  SELECT page_id, own, regexp_extract(url, '^([^?#]*)', 1) AS place,
    regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query FROM every),
formed AS (
  SELECT page_id, own, place || CASE WHEN query = '' THEN ''
    ELSE '?' || array_to_string(list_sort(string_split(query, '&')), '&') END AS url FROM cut)
SELECT url, CAST(count(*) FILTER (own = 0) AS BIGINT) AS n_links,
  CAST(count(DISTINCT page_id) FILTER (own = 0) AS BIGINT) AS n_pages,
  CAST(count(*) FILTER (own = 1) AS BIGINT) AS captured
FROM formed GROUP BY url""",
    "page_dispatch": """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'call' ELSE 'project' END AS kind, o_orderkey AS page_id FROM orders""",
    "project_pages": f"WITH {PROJECTS} SELECT * FROM items",
    "call_pages": f"""
WITH {CALLS}
SELECT k AS page_id, url, call_id, 'open-calls' AS action_type, topics, indicative_budget, proposal_submitted,
  strftime(call_date, '%-d %B %Y') AS call_phrase FROM items""",
    "funding_rows": f"""
WITH {PROJECTS}
SELECT k AS page_id, gan, name, funding, raw_text, reason FROM funding JOIN items ON page_id = k""",
    "participant_rows": f"""
WITH {PROJECTS}
SELECT k AS page_id, gan, name, type, city, region, country, reason FROM participant JOIN items ON page_id = k""",
    "project_load": f"""
WITH {PROJECTS}
SELECT gan_no AS gan, d AS start_date, e AS end_date, CAST(imi_funding AS INT) AS imi_funding,
  CAST(efpia_inkind AS INT) AS efpia_inkind, CAST(other AS INT) AS other,
  {', '.join('items.' + name.strip() for name in PROJECT_TEXTS.split(','))}
FROM fresh JOIN items ON page_id = k""",
    "project_load_children": f"""
WITH {PROJECTS}
SELECT 'funding' AS kind, gan_no AS gan, name, funding AS amount
FROM fresh JOIN funding USING (k) WHERE funding.reason IS NULL
UNION ALL SELECT 'participant', gan_no, name, NULL
FROM fresh JOIN participant USING (k) WHERE participant.reason IS NULL""",
    "project_load_twice": f"""
WITH {PROJECTS},
loaded AS (
  SELECT 'projects' AS table_name, gan_no FROM fresh
  UNION ALL SELECT 'fundings', gan_no FROM fresh JOIN funding USING (k) WHERE funding.reason IS NULL
  UNION ALL SELECT 'participants', gan_no FROM fresh JOIN participant USING (k) WHERE participant.reason IS NULL)
SELECT table_name, 'first' AS batch, count(*) AS n_rows, CAST(sum(gan_no) AS BIGINT) AS gans FROM loaded GROUP BY table_name""",
    "project_load_rejects": f"""
WITH {PROJECTS},
refusals AS (
  SELECT 'project' AS kind, reason, k FROM refused
  UNION ALL SELECT 'funding', funding.reason, k FROM fresh JOIN funding USING (k) WHERE funding.reason IS NOT NULL
  UNION ALL SELECT 'participant', participant.reason, k FROM fresh JOIN participant USING (k) WHERE participant.reason IS NOT NULL
  UNION ALL SELECT 'funding', 'no parent row', k FROM refused JOIN funding USING (k)
  UNION ALL SELECT 'participant', 'no parent row', k FROM refused JOIN participant USING (k))
SELECT kind, reason, k AS page_id, count(*) AS n FROM refusals GROUP BY 1, 2, 3""",
    "call_load": f"""
WITH {CALLS}
SELECT call_id, call_date, 'open-calls' AS action_type, CAST(proposal_submitted AS INT) AS proposal_submitted,
  topics, indicative_budget, url
FROM open_items WHERE NOT {TOO_LARGE}
QUALIFY call_id IS NULL OR row_number() OVER (PARTITION BY call_id ORDER BY k) = 1""",
    "call_load_rejects": f"""
WITH {CALLS}
SELECT k AS page_id, 'proposal_submitted is too large' AS reason FROM open_items AS refused WHERE {TOO_LARGE} AND NOT EXISTS (
  SELECT 1 FROM open_items AS earlier
  WHERE earlier.call_id = refused.call_id AND earlier.k < refused.k AND NOT {TOO_LARGE})""",
    "load_if_absent": """
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "child_guard": """
WITH parents AS (SELECT o_orderkey FROM orders WHERE o_totalprice >= 200000)
SELECT l_orderkey AS o_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_orderkey IN (SELECT o_orderkey FROM parents) THEN 'kept' ELSE 'no parent row' END AS reason
FROM lineitem""",
}
