"""The queries: one per operator or job, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import inputs as given
from grantlens.functions import html as hx, names as nm, text as tx, urls
from grantlens.operators import load
from grantlens.operators.prefix import prefix_join
from grantlens.operators.score import char_stats, score_documents
from grantlens.plans import matching, page_load, pages as pg, scoring
from grantlens.session import new_path, staged, tune
from grantlens.sources import lexicon as lx, sinks, tables
from grantlens.sources.bucketed import bucketed_counts, write_patents
from grantlens.streaming import reports

Query = Callable[[SparkSession, str], DataFrame]

# ---- scoring ------------------------------------------------------------------


def finance_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.finance_profile(
        given.documents(spark, sf_dir), given.finance(spark), "doc_id"
    )


def inquirer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.inquirer_profile(
        given.documents(spark, sf_dir), given.inquirer(spark), "doc_id"
    )


def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile with a lexicon of every word of the texts."""
    words = staged(given.corpus_words(spark, sf_dir), "corpus-words")
    lexicon = lx.finance_lexicon(lx.type_finance(words))
    return scoring.finance_profile(given.documents(spark, sf_dir), lexicon, "doc_id")


def shuffled_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without broadcasting the lexicon, as for one too large to send."""
    words = staged(given.corpus_words(spark, sf_dir), "corpus-words")
    lexicon = lx.finance_lexicon(lx.type_finance(words))
    texts = scoring.stored_texts(given.documents(spark, sf_dir))
    scored = score_documents(texts, [lexicon], "doc_id", max_bytes=0)
    return scoring.finance_columns(scored, lexicon.name, "doc_id")


def char_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = char_stats(F.col("text"))
    return given.documents(spark, sf_dir).select(
        "doc_id", *[column.alias(name) for name, column in stats.items()]
    )


def trailing_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.stored_texts(given.documents(spark, sf_dir)).select(
        "doc_id", "text", F.length("text").alias("n_chars")
    )


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and distinct upper-cased tokens per document."""
    words = F.transform(tx.tokens(F.col("text")), lambda word: F.upper(word))
    return given.documents(spark, sf_dir).select(
        "doc_id",
        F.size(words).alias("n_tokens"),
        F.size(F.array_distinct(words)).alias("n_distinct"),
    )


def _labelled(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return given.table(spark, sf_dir, "labels").where(F.col(column) == 1).select("doc_id")


def pending_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = {
        "finance": _labelled(spark, sf_dir, "quality"),
        "inquirer": _labelled(spark, sf_dir, "toxic"),
    }
    open_docs = scoring.pending(
        given.table(spark, sf_dir, "documents", "doc_id", "text"), targets, "doc_id"
    )
    return open_docs.select(
        "doc_id", F.length("text").alias("n_chars"), "needs_finance", "needs_inquirer"
    )


def pending_by_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id is no key of parts or no key of orders in the line items, found by
    bitmaps of these keys, as for finished ids too many for a list."""
    keys = given.table(spark, sf_dir, "lineitem")
    targets = {
        "part": keys.select(F.col("l_partkey").alias("doc_id")),
        "order": keys.select(F.col("l_orderkey").alias("doc_id")),
    }
    docs = given.table(spark, sf_dir, "documents", "doc_id", "text")
    open_docs = scoring.pending(docs, targets, "doc_id", max_list_bytes=0)
    return open_docs.select(
        "doc_id", F.length("text").alias("n_chars"), "needs_part", "needs_order"
    )


def _incremental(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return scoring.score_pending(
        given.documents(spark, sf_dir),
        given.finance(spark),
        given.inquirer(spark),
        _labelled(spark, sf_dir, "quality"),
        _labelled(spark, sf_dir, "toxic"),
        "doc_id",
    )


def incremental_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir)["finance"]


def incremental_inquirer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir)["inquirer"]


def append_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that lack the labelled documents, then two more runs: the first adds
    those, the second nothing."""
    docs = given.documents(spark, sf_dir)
    finance, inquirer = given.finance(spark), given.inquirer(spark)
    finance_path, inquirer_path = new_path(spark, "analysis"), new_path(spark, "sentiment")
    start = scoring.score_pending(
        docs,
        finance,
        inquirer,
        _labelled(spark, sf_dir, "quality"),
        _labelled(spark, sf_dir, "toxic"),
        "doc_id",
    )
    sinks.append_table(sinks.stamped(start["finance"]), finance_path)
    sinks.append_table(sinks.stamped(start["inquirer"]), inquirer_path)
    for _ in range(2):
        scoring.append_pending(docs, finance, inquirer, finance_path, inquirer_path, "doc_id")
    left, right = spark.read.parquet(finance_path), spark.read.parquet(inquirer_path)
    return left.join(right, "doc_id", "full").select(
        "doc_id",
        left["word_count"].alias("finance_words"),
        right["word_count"].alias("inquirer_words"),
        "vocabulary",
    )


def file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given.table(spark, sf_dir, "documents", "doc_id", "text", "source")
    files = docs.select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text"
    )
    return scoring.file_report(files, given.finance(spark))


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written as files of many lines and read back as whole files.

    Files hold a bounded number of texts, so totals do not depend on the split.
    """
    folder = new_path(spark, "text-files")
    given.documents(spark, sf_dir).select("text").write.option(
        "maxRecordsPerFile", 1000
    ).text(folder)
    files = tables.read_text_files(spark, f"{folder}/*.txt")
    return files.agg(
        F.sum("n_chars").alias("n_chars"),
        F.sum(F.size(tx.tokens(F.col("text")))).alias("n_tokens"),
        F.sum(tx.digit_count(F.col("text"))).alias("n_digits"),
    )


# ---- lexicons -----------------------------------------------------------------


def file_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts land as files of fifty documents in two parts; three runs report each file once.

    The report is read back from its CSV files; files have names of their own, so it has none.
    """
    landed = staged(
        given.documents(spark, sf_dir)
        .groupBy(F.floor(F.col("doc_id") / 50).alias("file"))
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")))).alias("docs"))
        .select("file", F.array_join("docs.text", "\n").alias("text")),
        "file-texts",
    )
    folder, out, state = (new_path(spark, name) for name in ("files", "file-reports", "file-state"))
    lexicon = given.finance(spark)
    for part in (0, 1, None):
        if part is not None:
            rows = landed.where(F.col("file") % 2 == part).select("text")
            rows.write.mode("append").option("maxRecordsPerFile", 1).text(folder)
        reports.report_new_files(spark, folder, lexicon, out, state)
    sample = scoring.file_report(spark.createDataFrame([], "path string, text string"), lexicon)
    return reports.read_reports(spark, out, sample).drop("file_name")


def _lexicon_file(spark: SparkSession, sf_dir: str) -> str:
    """The words of the texts as a lexicon file in which every word comes twice."""
    words = staged(given.corpus_words(spark, sf_dir), "corpus-words")
    first = words.withColumns({"pass": F.lit(0), "negative": F.lit(1), "doc_count": F.lit(1)})
    lines = first.unionByName(words.withColumn("pass", F.lit(1)))
    path = new_path(spark, "lexicon")
    ordered = lines.orderBy("pass", "word").select(*lx.FINANCE_COLUMNS)
    ordered.write.option("header", True).option("quote", "").csv(path)
    return path


def lexicon_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lx.load_finance(spark, _lexicon_file(spark, sf_dir))


def lexicon_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lx.read_lines(spark, _lexicon_file(spark, sf_dir), tuple(lx.FINANCE_COLUMNS))
    return lx.total_documents(lines)


def lexicon_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header, categories, stop words and document count of a lexicon file."""
    found = lx.finance_metadata(spark, _lexicon_file(spark, sf_dir))
    return found.select(
        "header",
        F.array_join("categories", ",").alias("categories"),
        F.array_join("stop_words", ",").alias("stop_words"),
        "total_documents",
    )


def inquirer_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words as an inquirer lexicon file, some of its cells filled."""
    words = given.corpus_words(spark, sf_dir)
    cells = [
        F.when(F.col("doc_count") % step == 0, F.lit(name)).otherwise(F.lit("")).alias(name)
        for step, name in enumerate(lx.INQUIRER_CATEGORIES, start=2)
    ]
    path = new_path(spark, "inquirer")
    words.select("word", "source", *cells).write.option("header", True).option(
        "emptyValue", ""
    ).csv(path)
    return lx.load_inquirer(spark, path)


def lexicon_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lx.type_finance(given.corpus_words(spark, sf_dir))
    return lx.category_words(words, lx.FINANCE_CATEGORIES)


def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lx.type_finance(given.corpus_words(spark, sf_dir))
    return words.where("stop_word").select("word", "doc_count")


# ---- names and patents --------------------------------------------------------

EXCLUDED_TYPES = ("ECONOMY",)
PART_FORMS = ("widget", "bolt")
SUBSTITUTIONS = (("small", "tiny"), ("Red", "Crimson"), ("co", "company"))
LAST_STOP_WORDS = ("ring", "bolt")


def _participant_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.participant_members(
        given.participants(spark, sf_dir), excluded_types=EXCLUDED_TYPES
    )


def _leader_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.leader_members(given.projects(spark, sf_dir))


def participant_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.grouped_members(_participant_members(spark, sf_dir))


def leader_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.grouped_members(_leader_members(spark, sf_dir))


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws(" ", "p_brand", F.lit("& Co."), "p_name")
    return given.table(spark, sf_dir, "part").select(
        "p_partkey", nm.clean_name(name, SUBSTITUTIONS, LAST_STOP_WORDS).alias("clean")
    )


def strip_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.participants(spark, sf_dir).select(
        "gan",
        nm.strip_suffix(F.col("name")).alias("company"),
        nm.strip_suffix(F.col("name"), PART_FORMS).alias("part"),
    )


def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = given.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("organization"))
    others = given.table(spark, sf_dir, "customer").select(F.col("c_name").alias("organization"))
    names = given.participants(spark, sf_dir).where("name is not null")
    keys = names.select(F.rtrim(F.col("name"), F.lit("0123456789 LtdGmbHKIncCo.&,")).alias("key"))
    wanted = names.select(F.col("name").alias("key")).unionByName(keys)
    return prefix_join(wanted, owners.unionByName(others), "key", "organization")


def yearly_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.ordered_counts(matching.yearly_counts(given.grants(spark, sf_dir)))


def yearly_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.ordered_counts(matching.yearly_counts(given.applications(spark, sf_dir)))


def bucketed_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_patents(given.grants(spark, sf_dir), "grant_patents")
    return matching.ordered_counts(bucketed_counts(spark, written))


def bucketed_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_patents(given.applications(spark, sf_dir), "application_patents")
    return matching.ordered_counts(bucketed_counts(spark, written))


def participant_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_report(
        _participant_members(spark, sf_dir), given.grants(spark, sf_dir)
    )


def participant_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_report(
        _participant_members(spark, sf_dir), given.applications(spark, sf_dir)
    )


def leader_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_report(_leader_members(spark, sf_dir), given.grants(spark, sf_dir))


def leader_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_report(
        _leader_members(spark, sf_dir), given.applications(spark, sf_dir)
    )


def all_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.all_reports(
        {
            ("participants", "applications"): participant_applications(spark, sf_dir),
            ("participants", "grants"): participant_grants(spark, sf_dir),
            ("leaders", "applications"): leader_applications(spark, sf_dir),
            ("leaders", "grants"): leader_grants(spark, sf_dir),
        }
    )


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as CSV and as replaced table, read back and compared by source."""
    # Counted once for the three times that they are written.
    counts = staged(matching.yearly_counts(given.grants(spark, sf_dir)), "yearly-counts")
    csv_path, table_path = new_path(spark, "export"), new_path(spark, "table")
    sinks.export_csv(counts, csv_path)
    for _ in range(2):
        sinks.replace_table(counts, table_path)
    schema = "organization string, year int, count bigint"
    from_csv = spark.read.schema(schema).option("header", True).csv(csv_path)
    from_table = spark.read.schema(schema).parquet(table_path)
    return from_csv.select(F.lit("csv").alias("kind"), "*").unionByName(
        from_table.select(F.lit("table").alias("kind"), "*")
    )


# ---- pages --------------------------------------------------------------------


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    article = hx.before(hx.after(html, "<article>"), "</article>")
    return given.table(spark, sf_dir, "pages").select(
        "page_id",
        tx.strip_tags(tx.first_match(html, "(?s)<h1>(.*?)</h1>")).alias("title"),
        F.length(tx.strip_tags(article)).alias("n_chars"),
        F.size(hx.list_items(html)).alias("n_items"),
        tx.strip_tags(tx.first_match(article, "(?s)(<p>.*?</p>)")).alias("first_paragraph"),
        urls.host(F.col("url")).alias("host"),
        tx.url_part(F.col("url"), 2).alias("kind"),
    )


LINK_PATTERN = "/[A-Za-z]+$"
LINK_DOMAINS = ("example.com", "example.org")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.links(given.table(spark, sf_dir, "pages"), LINK_PATTERN, LINK_DOMAINS)


def page_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the pages and of what they link to, each in its normal form."""
    return pg.linked_addresses(given.table(spark, sf_dir, "pages"))


def page_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which loader takes a page, by its address."""
    pages = given.captured_pages(spark, sf_dir)
    return (
        pg.project_pages(pages)
        .select(F.lit("project").alias("kind"), "page_id")
        .unionByName(pg.call_pages(pages).select(F.lit("call").alias("kind"), "page_id"))
    )


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as text, for comparison."""
    arrays = [name for name, kind in df.dtypes if kind == "array<string>"]
    return df.withColumns({name: F.array_join(name, "|") for name in arrays})


def project_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = pg.extract_projects(pg.project_pages(given.captured_pages(spark, sf_dir)))
    return _flat(items.drop("fundings", "participants"))


def call_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(pg.extract_calls(pg.call_pages(given.captured_pages(spark, sf_dir))))


def funding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.funding_rows(pg.extract_projects(pg.project_pages(given.captured_pages(spark, sf_dir))))


def participant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = pg.extract_projects(pg.project_pages(given.captured_pages(spark, sf_dir)))
    return pg.participant_rows(items).drop("raw_text")


def _project_load(spark: SparkSession, sf_dir: str) -> page_load.ProjectLoad:
    return page_load.load_projects(
        given.captured_pages(spark, sf_dir), given.known_projects(spark, sf_dir)
    )


def project_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_project_load(spark, sf_dir).projects)


def project_load_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _project_load(spark, sf_dir)
    return loaded.fundings.select(
        F.lit("funding").alias("kind"), "gan", "name", F.col("funding").alias("amount")
    ).unionByName(
        loaded.participants.select(
            F.lit("participant").alias("kind"), "gan", "name", F.lit(None).cast("int").alias("amount")
        )
    )


def project_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _project_load(spark, sf_dir).rejects
    return rejects.groupBy("kind", "reason", "page_id").agg(F.count(F.lit(1)).alias("n"))


def project_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by table and batch, after the same pages were loaded under two names and once more under the first."""
    store = page_load.project_store(spark, new_path(spark, "project-store"))
    known = given.known_projects(spark, sf_dir)
    empty = {name: spark.createDataFrame([], schema) for name, schema in store.schemas.items()}
    store.publish("known", empty | {"projects": empty["projects"].unionByName(known, allowMissingColumns=True)})
    pages = given.captured_pages(spark, sf_dir)
    for batch in ("first", "second", "first"):
        page_load.publish_projects(store, pages, batch)
    counted = [
        store.read(name)
        .where("batch <> 'known'")
        .groupBy("batch")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("gan").alias("gans"))
        .select(F.lit(name).alias("table_name"), "batch", "n_rows", "gans")
        for name in ("projects", "fundings", "participants")
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _call_load(spark: SparkSession, sf_dir: str) -> page_load.CallLoad:
    return page_load.load_calls(given.captured_pages(spark, sf_dir), given.known_calls(spark, sf_dir))


def call_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_call_load(spark, sf_dir).calls)


def call_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _call_load(spark, sf_dir).rejects.select("page_id", "reason")


def load_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user who has no purchase of more than 100 yet."""
    events = given.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value"
    )
    known = events.where("event_type = 'purchase' and value > 100").select("user_id")
    return load.insert_if_absent(events, known, "user_id", ["event_id"])


def child_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with and without an order of at least 200,000."""
    children = given.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_linenumber", "l_quantity"
    )
    parents = given.table(spark, sf_dir, "orders").where("o_totalprice >= 200000")
    marked = load.mark_orphans(children, parents, "o_orderkey")
    return marked.withColumn("reason", F.coalesce("reason", F.lit("kept")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        finance_profile,
        inquirer_profile,
        corpus_profile,
        shuffled_profile,
        char_statistics,
        trailing_strip,
        word_counts,
        pending_documents,
        pending_by_bits,
        incremental_profile,
        incremental_inquirer,
        append_scores,
        file_report,
        file_report_stream,
        text_files,
        lexicon_load,
        lexicon_documents,
        lexicon_metadata,
        inquirer_load,
        lexicon_words,
        stop_words,
        participant_groups,
        leader_groups,
        clean_names,
        strip_suffix,
        prefix_match,
        yearly_grants,
        yearly_applications,
        bucketed_grants,
        bucketed_applications,
        participant_grants,
        participant_applications,
        leader_grants,
        leader_applications,
        all_reports,
        export_roundtrip,
        page_fields,
        page_links,
        page_addresses,
        page_dispatch,
        project_pages,
        call_pages,
        funding_rows,
        participant_rows,
        project_load,
        project_load_children,
        project_load_rejects,
        project_load_twice,
        call_load,
        call_load_rejects,
        load_if_absent,
        child_guard,
    )
}


def tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run
