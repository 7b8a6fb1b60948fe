"""Inputs the queries derive from the test tables with Spark.

The expressions are kept as SQL text that Spark and DuckDB both understand, so
both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from grantlens.functions import text as tx
from grantlens.operators.groups import split_repeated
from grantlens.plans.matching import Patents
from grantlens.session import new_path
from grantlens.sources.lexicon import (
    FINANCE_COLUMNS,
    INQUIRER_CATEGORIES,
    Lexicon,
    finance_lexicon,
    inquirer_lexicon,
    type_finance,
    type_inquirer,
)
from grantlens.sources.tables import read_table

# Words that are frequent in the documents, four languages, plus two that never
# count (one letter, digits) and one in lower case.
WORDS = (
    "THE OF AND TO IN DE LA DER IS THAT FROM WITH ARE FOR BE THIS IT AS BY ON WAS AT "
    "AN A RE LE LES DES UNE QUE DANS AVEC POUR SUR EL LOS UNA CON PARA DIE UND DAS "
    "NICHT SICH AUF MIT FÜR VON EIN 2009 2011 erth"
).split()
FLAGS = ("negative", "positive", "uncertainty", "litigious", "constraining")


def finance_values() -> str:
    """Finance lexicon rows: flags, modal number and syllables by position."""
    rows = []
    for i, word in enumerate(WORDS):
        flags = [2009 if i % step == 0 else 0 for step in (2, 3, 5, 7, 11)]
        cells = [*flags, i % 4, 1 + i % 3]
        rows.append(f"('{word}', {', '.join(map(str, cells))})")
    return ", ".join(rows)


def inquirer_values() -> str:
    rows = []
    for i, word in enumerate(WORDS):
        cells = ["'x'" if i % step == 0 else "''" for step in range(2, 14)]
        rows.append(f"('{word}', {', '.join(cells)})")
    return ", ".join(rows)


def finance(spark: SparkSession) -> Lexicon:
    names = ", ".join(("word", *FLAGS, "modal_number", "syllables"))
    given = spark.sql(f"SELECT * FROM VALUES {finance_values()} AS t({names})")
    return finance_lexicon(type_finance(_all_cells(given, tuple(FINANCE_COLUMNS))))


def inquirer(spark: SparkSession) -> Lexicon:
    names = ", ".join(("word", *INQUIRER_CATEGORIES))
    given = spark.sql(f"SELECT * FROM VALUES {inquirer_values()} AS t({names})")
    return inquirer_lexicon(type_inquirer(given.withColumn("source", F.lit("given"))))


def _all_cells(given: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return given.select(
        *[
            (F.col(name) if name in given.columns else F.lit("0")).cast("string").alias(name)
            for name in columns
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", columns or ("*",))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


# ---- a lexicon made of the words of the documents -----------------------------


def corpus_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the cells of the finance layout."""
    def of(docs: DataFrame) -> DataFrame:
        upper = F.transform(tx.tokens(F.col("text")), lambda word: F.upper(word))
        return docs.select("doc_id", F.explode(F.array_distinct(upper)).alias("word"))

    # Words are distinct where a text is read; only texts that share an id meet by a shuffle.
    alone, others = split_repeated(documents(spark, sf_dir), "doc_id")
    words = (
        of(alone)
        .select("word")
        .unionAll(of(others).distinct().select("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("doc_count"))
    )
    return words.selectExpr(*[f"{sql} AS {name}" for name, sql in CORPUS_CELLS.items()])


CORPUS_CELLS = {
    "word": "word",
    "sequence_number": "CAST(length(word) AS INT)",
    "word_count": "CAST(doc_count * 2 AS INT)",
    "word_proportion": "CAST(0.5 AS DOUBLE)",
    "average_proportion": "CAST(0.25 AS DOUBLE)",
    "std_dev_prop": "CAST(0 AS DOUBLE)",
    "doc_count": "CAST(doc_count AS INT)",
    "negative": "CASE WHEN length(word) % 5 = 0 THEN 2009 ELSE 0 END",
    "positive": "CASE WHEN length(word) % 3 = 0 THEN 2009 ELSE 0 END",
    "uncertainty": "CASE WHEN doc_count % 2 = 0 THEN 2011 ELSE 0 END",
    "litigious": "CASE WHEN doc_count % 7 = 0 THEN 2011 ELSE 0 END",
    "constraining": "CASE WHEN (doc_count + length(word)) % 4 = 0 THEN 2012 ELSE 0 END",
    "superfluous": "0",
    "interesting": "0",
    "modal_number": "CAST(length(word) % 4 AS INT)",
    "irregular_verb": "0",
    "harvard_iv": "0",
    "syllables": "CAST(1 + length(word) % 6 AS INT)",
    "source": "'12of12inf'",
}

# ---- organisations, grants and patents ----------------------------------------

PARTICIPANTS = """
SELECT p_partkey AS gan, p_type AS type,
  CASE p_partkey % 10
    WHEN 0 THEN 'SUPPLIER#' || lpad(CAST(p_partkey % 130 AS STRING), 9, '0') || ' Ltd'
    WHEN 1 THEN 'supplier#' || lpad(CAST(p_partkey % 170 AS STRING), 9, '0') || ' GmbH & Co. KG'
    WHEN 2 THEN 'Customer#' || lpad(CAST(p_partkey AS STRING), 9, '0') || ', Inc.'
    WHEN 3 THEN 'CUSTOMER#' || lpad(CAST(p_partkey % 1600 AS STRING), 9, '0')
    WHEN 4 THEN 'Ltd'
    WHEN 5 THEN 'Customer#%'
    WHEN 6 THEN p_name || ' UNIVERZita'
    WHEN 7 THEN p_name
    WHEN 8 THEN NULL
    ELSE 'Supplier#0000000' || CAST(p_partkey % 7 AS STRING)
  END AS name
FROM part
"""

# Leader entries as text; the reader splits them at the bar.
PROJECTS = """
SELECT p_partkey AS gan,
  CASE p_partkey % 6
    WHEN 0 THEN p_brand || '| Supplier#' || lpad(CAST(p_partkey % 120 AS STRING), 9, '0') || ' Ltd '
    WHEN 1 THEN p_brand || '|customer#' || lpad(CAST(p_partkey % 1700 AS STRING), 9, '0') || '|' || p_type
    WHEN 2 THEN p_brand
    WHEN 3 THEN ''
    WHEN 4 THEN p_brand || '|' || p_name
    ELSE p_brand || '|   '
  END AS leaders
FROM part
"""

# Small tables on purpose: the owners are the two name tables, the links the
# large fact tables.


def _view_sql(spark: SparkSession, sf_dir: str, sql: str, source: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view_sql(spark, sf_dir, PARTICIPANTS, "part")


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _view_sql(spark, sf_dir, PROJECTS, "part")
    return rows.select(
        "gan",
        F.when(F.col("leaders") == "", F.array().cast("array<string>"))
        .otherwise(F.split("leaders", r"\|"))
        .alias("project_leader"),
    )


def grants(spark: SparkSession, sf_dir: str) -> Patents:
    """Suppliers own orders through line items."""
    return Patents(
        owners=table(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey AS id", "s_name AS organization"
        ),
        links=table(spark, sf_dir, "lineitem").selectExpr(
            "l_suppkey AS assignee_id", "l_orderkey AS patent_id"
        ),
        docs=table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderdate AS date"),
    )


def applications(spark: SparkSession, sf_dir: str) -> Patents:
    """Customers own orders directly."""
    orders = table(spark, sf_dir, "orders")
    return Patents(
        owners=table(spark, sf_dir, "customer").selectExpr(
            "c_custkey AS id", "c_name AS organization"
        ),
        links=orders.selectExpr("o_custkey AS assignee_id", "o_orderkey AS application_id"),
        docs=orders.selectExpr("o_orderkey AS id", "o_orderdate AS date_filed"),
        doc_id="application_id",
        date="date_filed",
    )


# ---- captured pages written from the orders ------------------------------------

# {x} is an SQL expression over the orders; the rest is HTML as captured.
PROJECT_HTML = """<html><body><article><div>
<div><div id="project-title"><div><div><h1 class="t"><span>Project &amp; partners {k}</span></h1></div></div></div>
<span class="project-status">{o_orderstatus}</span><span title="p" class="project-imi-programme">{o_orderpriority}</span>
<div id="project-tags"><p>{area}<a href="/k/products/{k}" class="project-keyword">Product {k % 11}</a>{tool}<a href="/products" class="other">No</a></p></div></div>
<div><div><div>intro picture</div>
<div><div id="project-facts-figures"><table><tbody><tr><td>Start</td><td><div><time datetime="x">{start}</time></div></td></tr>
<tr><td>End</td><td><div><time>{end}</time></div></td></tr>
<tr><td>Call</td><td><div>CALL-{o_custkey % 50}</div></td></tr><tr><td>Number</td><td class="n"><div>{gan}</div></td></tr></tbody></table>
<div class="field field--name-field-funding-imi item" content="{CAST(o_totalprice AS BIGINT)}">x</div>{inkind}
<div content="{other}" class="field--name-field-funding-other">z</div></div></div>
<div><div><p>Web: <a href="https://p{k}.example.org">www.p{k}.example.org</a></p>{twitter}</div></div></div>
<div><div><div><div><div>Intro of {k}<b>!</b></div></div></div></div></div></div>
<div id="project-contacts"><div><div class="field--item"><div class="project-contact"><strong>Project coordinator</strong>Coordinator {o_custkey}<br>Customer {o_custkey}</div></div>
<div class="field--item"><div class="project-contact"><strong>Project leader</strong>Leader {k}<br> Customer#{lpad(CAST(o_custkey AS STRING), 9, '0')} Ltd <br/><a href="x">mail</a></div></div>{manager}</div></div>
<div id="project-body"><div>{summary}</div></div>
<div id="collapse-project-1"><div><div><table><tbody><tr><td>Customer {o_custkey}</td><td>{amount}</td></tr><tr><td>Fund&nbsp;{k}</td><td>1 000</td></tr>{badrow}<tr><td>Total Cost</td><td>5 000</td></tr></tbody></table></div></div></div>
<div class="project-participants-category"><h5>Small companies (SMEs)</h5><ul><li>Acme {o_custkey}, Paris, France</li><li> Beta {k}, Austin , Texas, USA</li>{short}</ul></div>
<div class="project-participants-category"><h5>Universities, public bodies</h5><ul><li><a href="u">Uni {k % 13}</a>, Rome, Italy</li></ul><h5>Others</h5></div>
</div></article></body></html>"""

PROJECT_PARTS = {
    "k": "CAST(k AS STRING)",
    "area": "CASE WHEN k % 3 = 0 THEN '' WHEN k % 5 = 0 THEN '<a class=\"project-keyword\" href=\"/disease_areas/1\">Area ' || CAST(k % 7 AS STRING) || '</a><a class=\"project-keyword\" href=\"/disease_areas/2\">Area x</a>' ELSE '<a class=\"project-keyword\" href=\"/disease_areas/1\">Area ' || CAST(k % 7 AS STRING) || '</a>' END",
    "tool": "CASE WHEN k % 2 = 0 THEN '' ELSE '<a class=\"project-keyword\" href=\"/tools?x\">Tool ' || CAST(k % 17 AS STRING) || '</a>' END",
    "start": "CASE WHEN k % 89 = 0 THEN 'soon' ELSE start_text END",
    "end": "end_text",
    "gan": "CASE WHEN k % 97 = 0 THEN 'n/a' ELSE CAST(gan AS STRING) END",
    "inkind": "CASE WHEN k % 4 = 1 THEN '' ELSE '<div class=\"field--name-field-funding-efpi\" content=\"' || CAST(CAST(o_totalprice AS BIGINT) * 2 AS STRING) || '\">y</div>' END",
    "other": "CASE WHEN k % 83 = 0 THEN '1.5' ELSE CAST(k % 1000 AS STRING) END",
    "twitter": "CASE WHEN k % 6 = 1 THEN '' ELSE '<p><a href=\"t\">@p' || CAST(k AS STRING) || '</a></p>' END",
    "manager": "CASE WHEN k % 5 = 0 THEN '' ELSE '<div class=\"field--item\"><div class=\"project-contact\"><strong>Project Manager</strong>Manager ' || CAST(k AS STRING) || '</div></div>' END",
    "summary": "CASE WHEN k % 79 = 0 THEN 'text only' ELSE '<p>About <b>project</b>' || chr(10) || CAST(k AS STRING) || '</p><p>more</p>' END",
    "amount": "amount_text",
    "badrow": "CASE WHEN k % 10 = 3 THEN '<tr><td>Beta</td><td>n/a</td></tr><tr></tr>' ELSE '' END",
    "short": "CASE WHEN k % 7 = 0 THEN '<li>Gamma, Rome</li>' ELSE '' END",
}

CALL_HTML = """<html><body><article class="node"><div><div>{heading}</div></div>
<div class="content"><div><p>The topics of this call</p><ul><li>Topic <b>{k % 19}</b></li><li>Topic of customer {o_custkey}</li></ul>
<h3>Indicative budget</h3><ul class="b"><li>EUR {CAST(o_totalprice AS BIGINT)}</li></ul>
<p>The call was <b>launched</b> on {phrase}</p>{closing}</div></div></article></body></html>"""

CALL_PARTS = {
    "heading": "CASE WHEN k % 53 = 0 THEN '' ELSE '<h1><span>CALL-' || CAST(call_no AS STRING) || '</span></h1>' END",
    "phrase": "phrase_text",
    "closing": "CASE WHEN k % 71 = 0 THEN '' ELSE '<ul><li>Closed<br>in 2 stages<br/>' || CASE WHEN k % 9 = 0 THEN 'no proposals' WHEN k % 67 = 0 THEN '99999999999' ELSE CAST(k % 400 AS STRING) || ' proposals' END || '</li></ul>' END",
}

PROJECT_ADDRESS = "https://www.grants.example.org/projects-results/project-factsheets/p-"
CALL_ADDRESS = "https://www.grants.example.org/apply-funding/open-calls/c-"
IS_CALL = "k % 4 = 0"
# Orders whose projects and calls were loaded before.
KNOWN_PROJECT = "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"
KNOWN_CALL = "o_orderpriority = '5-LOW' AND o_orderstatus = 'O'"


def _filled(html: str, parts: dict[str, str]) -> str:
    """HTML with {expressions} as one SQL concatenation."""
    pieces = []
    while "{" in html:
        text, _, rest = html.partition("{")
        expression, _, html = rest.partition("}")
        pieces.append(_quoted(text))
        pieces.append(f"CAST({parts.get(expression, expression)} AS STRING)")
    pieces.append(_quoted(html))
    return f"concat({', '.join(pieces)})"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "\\n") + "'"


_LANDED: dict[tuple[str, str], str] = {}


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured pages as a landed table, written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _LANDED:
        try:
            return spark.read.parquet(_LANDED[key])
        except AnalysisException:
            pass  # the shared folder was cleaned up meanwhile
    _LANDED[key] = new_path(spark, "captured-pages")
    # Files small enough for all cores; the orders they are written from can be one file.
    written_pages(spark, sf_dir).write.option("maxRecordsPerFile", 2000).parquet(_LANDED[key])
    return spark.read.parquet(_LANDED[key])


def written_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order: a call page for every fourth, else a project page."""
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "k": F.col("o_orderkey"),
            "gan": F.expr("o_orderkey div 2"),
            "call_no": F.expr("o_orderkey div 8"),
            "start_text": F.date_format("o_orderdate", "d/M/yyyy"),
            "end_text": F.date_format(F.date_add("o_orderdate", 1000), "dd/MM/yyyy"),
            "phrase_text": F.date_format("o_orderdate", "d MMMM yyyy"),
            "amount_text": F.expr(
                "replace(format_number(CAST(o_totalprice AS BIGINT), 0), ',', ' ')"
            ),
        }
    )
    project_html = _filled(PROJECT_HTML, PROJECT_PARTS)
    call_html = _filled(CALL_HTML, CALL_PARTS)
    return orders.selectExpr(
        "k AS page_id",
        f"CASE WHEN {IS_CALL} THEN '{CALL_ADDRESS}' ELSE '{PROJECT_ADDRESS}' END || CAST(k AS STRING) AS url",
        f"CASE WHEN {IS_CALL} THEN {call_html} ELSE {project_html} END AS html",
    )


def known_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(KNOWN_PROJECT)
        .selectExpr("CAST(o_orderkey div 2 AS INT) AS gan")
        .distinct()
    )


def known_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(KNOWN_CALL)
        .selectExpr("'CALL-' || CAST(o_orderkey div 8 AS STRING) AS call_id")
        .distinct()
    )
