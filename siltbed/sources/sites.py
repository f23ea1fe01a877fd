"""The reference list: landed site-listing JSON -> project rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.plans import once

# The listing's own keys and the codes used where it gives none.
COUNT_KEY, SPECIALS_KEY = "count", "specials"
DEFAULT_CODE, SPECIAL_CODE = "unknown", "special"
SITE = "STRUCT<dbname: STRING, sitename: STRING, url: STRING, code: STRING>"
BATCH_RUN = "reference-batch"


def landed_files(
    spark: SparkSession, path: str, now: Column | None = None, whole: bool = True
) -> DataFrame:
    """Landed JSON as it is, with its origin: one document per file, or one per line."""
    now = F.current_timestamp() if now is None else now
    return spark.read.text(path, wholetext=whole).select(
        F.col("value").alias("listing_json"),
        F.col("_metadata.file_path").alias("source_file"),
        now.alias("ingestion_timestamp"),
        F.to_date(now).alias("load_date"),
    )


def land(raw: DataFrame, path: str) -> None:
    """Replace the landed copy at ``path``."""
    raw.write.mode("overwrite").parquet(path)


def flatten_sites(listings: DataFrame, column: str = "listing_json") -> DataFrame:
    """One row per site of every listing.

    A listing is an object of numbered language blocks plus one list of special sites. Each entry
    is turned into the same array of rows, so one explode serves both.
    """
    carried = [c for c in listings.columns if c != column]
    matrix = F.from_json(column, "sitematrix MAP<STRING, STRING>").getField("sitematrix")
    entries = once(listings, "_matrix", matrix).select(*carried, F.explode("_matrix"))
    block = F.from_json("value", f"code STRING, site ARRAY<{SITE}>")
    specials = F.from_json("value", f"ARRAY<{SITE}>")
    branch = F.struct(
        F.when(F.col("key") == SPECIALS_KEY, specials).alias("specials"),
        F.when(F.col("key") != SPECIALS_KEY, block).alias("block"),
    )
    parsed = once(entries.filter(F.col("key") != COUNT_KEY), "_p", branch)
    block_code = F.coalesce(F.col("_p.block.code"), F.lit(DEFAULT_CODE))

    def project(site: Column, code: Column) -> Column:
        return F.struct(
            site["dbname"].alias("wiki_code"),
            site["sitename"].alias("project_name"),
            code.alias("language_code"),
            site["url"].alias("site_url"),
        )

    rows = F.coalesce(
        F.transform("_p.specials", lambda s: project(s, F.coalesce(s["code"], F.lit(SPECIAL_CODE)))),
        F.transform("_p.block.site", lambda s: project(s, block_code)),
    )
    return parsed.select(*carried, F.inline(rows))


def batch_metadata(rows: DataFrame, run_id: str = BATCH_RUN, now: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    return rows.withColumns({"_ingest_timestamp": now, "_batch_run_id": F.lit(run_id)})
