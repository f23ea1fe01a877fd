"""Around the answer: allowed sources, context size, question language, guards, evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions.joins import top_per_group
from siltbed.operators.retrieval import running_text

# Sources that may be cited, context sizes, scripts, question words and motives.
ALLOWED_HOSTS = ("en.wikipedia.org", "github.com")
DOCUMENT_SCHEME = "projectdoc"
DOCUMENT_PATH = r"^{}/(?:[A-Za-z0-9_-]+/)*[A-Za-z0-9_-]+\.md$"
MAX_SOURCES, SOURCE_CHARS, CONTEXT_CHARS = 8, 2_400, 10_000
UKRAINIAN = "[іІїЇєЄґҐ]"
CYRILLIC = "[А-Яа-яЁё]"
ENGLISH = "what|why|when|where|who|how|show|find|compare|give|does|which|is|are"
REASON = r"\b(why|reason|motivation)\b|почему|зачем|причин|мотив"
EDIT = r"\b(edits?|editors?|revisions?)\b|правк|редакт"
ARTICLE = r"\b(articles?|wikipedia|pages?)\b|стать|википед"
RU_LETTERS = 10


def found(text: Column, pattern: str) -> Column:
    """Case-insensitive search in which letters of every script are letters."""
    return text.rlike(f"(?iuU){pattern}")


def allowed_source(
    url: Column, hosts: Sequence[str] = ALLOWED_HOSTS, folder: str = "docs"
) -> Column:
    """An https page of a listed host, or a plain path of the document folder."""
    part = lambda name: F.try_parse_url(url, F.lit(name))
    page = (F.lower(part("PROTOCOL")) == "https") & F.lower(part("HOST")).isin(*hosts)
    path = F.regexp_replace(F.try_url_decode(part("PATH")), "^/+", "")
    document = (
        (F.lower(part("PROTOCOL")) == DOCUMENT_SCHEME)
        & (F.coalesce(part("AUTHORITY"), F.lit("")) == "")
        & (F.coalesce(part("QUERY"), F.lit("")) == "")
        & (F.coalesce(part("REF"), F.lit("")) == "")
        & path.rlike(DOCUMENT_PATH.format(folder))
    )
    return F.coalesce(page, F.lit(False)) | F.coalesce(document, F.lit(False))


def allowed_sources(
    hits: DataFrame, hosts: Sequence[str] = ALLOWED_HOSTS, folder: str = "docs",
    column: str = "source_url",
) -> DataFrame:
    return hits.filter(allowed_source(F.col(column), hosts, folder))


def context_budget(
    hits: DataFrame, hosts: Sequence[str] = ALLOWED_HOSTS, folder: str = "docs",
    max_sources: int = MAX_SOURCES, source_chars: int = SOURCE_CHARS, total: int = CONTEXT_CHARS,
) -> DataFrame:
    """Sources of each question in rank order, cut to fit; ``source_id`` counts from 1.

    Only the first hits of a question are looked at, so its windows hold ``max_sources`` rows.
    The first source left without any text ends the list.
    """
    first = top_per_group(hits, ["question_id"], [F.asc("rank")], max_sources, "_hit")
    kept = allowed_sources(first, hosts, folder)
    size, before = running_text(["_hit"], source_chars, total)
    sized = kept.withColumn("_size", size)
    ended = F.min("_size").over(before.rowsBetween(Window.unboundedPreceding, 0)) == 0
    whole = sized.withColumn("_ended", ended).filter(~F.col("_ended"))
    order = Window.partitionBy("question_id").orderBy("_hit")
    return (
        whole.withColumn("text", F.substring(F.col("text"), F.lit(1), F.col("_size")))
        .withColumn("source_id", F.row_number().over(order))
        .drop("_hit", "_size", "_ended")
    )


def question_language(question: Column) -> Column:
    """Language to answer in, by script first and English question words second."""
    return (
        F.when(question.rlike(UKRAINIAN), "Ukrainian")
        .when(question.rlike(CYRILLIC), "Russian")
        .when(found(question, rf"\b({ENGLISH})\b"), "English")
        .otherwise("the language of the question")
    )


def motive_guard(question: Column, summary_only: Column) -> Column:
    """True for questions about why something was edited, which page summaries cannot answer."""
    about_pages = summary_only | found(question, ARTICLE)
    return found(question, REASON) & found(question, EDIT) & about_pages


def eval_pass(cases: DataFrame) -> DataFrame:
    """``passed`` per evaluation case.

    Columns: ``supported`` and ``answered`` (flags), ``expected``, ``any_of``, ``terms`` and
    ``found_sources`` (arrays), ``answer`` and ``answer_language``.
    """
    answer = F.coalesce("answer", F.lit(""))
    letters = F.size(F.regexp_extract_all(answer, F.lit(f"({CYRILLIC})"), F.lit(1)))
    script = (
        F.when(F.col("answer_language") == "ru", letters >= RU_LETTERS)
        .when(F.col("answer_language") == "en", letters == 0)
        .otherwise(True)
    )
    tests = (
        (F.col("supported") == F.col("answered"))
        & (F.size(F.array_except("expected", "found_sources")) == 0)
        & ((F.size("any_of") == 0) | F.arrays_overlap("any_of", "found_sources"))
        & F.forall("terms", lambda t: F.contains(F.lower(answer), F.lower(t)))
        & script
    )
    return cases.withColumn("passed", F.coalesce(tests, F.lit(False)))


def eval_totals(judged: DataFrame) -> DataFrame:
    return judged.agg(
        F.count_if("passed").alias("passed"),
        F.count("*").alias("cases"),
    )
