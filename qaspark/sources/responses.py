"""Landed API responses: pages of questions, and the log of keyed responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark import schemas
from qaspark.fixed_values import CACHE_TTL_DAYS
from qaspark.functions import dates
from qaspark.operators.ranking import first_per_key


def read_pages(spark: SparkSession, path: str, with_body: bool = False) -> DataFrame:
    """Question rows of all landed JSON pages; unread fields are never parsed."""
    pages = spark.read.schema(schemas.api_page(with_body)).json(path)
    return pages.select(F.explode("items").alias("_q")).select("_q.*")


def read_questions(spark: SparkSession, path: str, with_body: bool = False) -> DataFrame:
    """Pages landed under ``language=<key>`` folders, with language, date and year."""
    pages = spark.read.schema(schemas.api_page(with_body)).json(path)
    rows = pages.select(F.explode("items").alias("_q"), "language").select("_q.*", "language")
    dated = rows.withColumn("creation_date", dates.to_timestamp(rows, "creation_date"))
    return dated.withColumn("year", F.year("creation_date"))


def read_requests(spark: SparkSession, path: str, with_body: bool = False) -> DataFrame:
    """Landed pages with the request each one answers; one row per page."""
    return spark.read.schema(schemas.request_page(with_body)).json(path)


def page_chains(pages: DataFrame, keys: list[str] = ["tag", "fromdate", "todate"]) -> DataFrame:
    """What has landed of each request: one row per chain of pages.

    ``pages`` distinct pages from 1 on, ``repeats`` further copies of them, ``last_page`` the smallest page that says that no more follow
    (null: none does), ``missing`` pages below the end of the chain that never landed, ``first_gap`` the smallest of them,
    ``beyond`` distinct pages after the last one, ``items`` of all copies, ``quota_left`` the least quota reported, and ``complete``: a last page and nothing
    missing before it. The end of a chain is its last page or, without one, its greatest page. A page without a
    number or below 1 belongs to no chain. A page without ``has_more`` counts as a last one.

    Two aggregations with partial sums, by page and by chain; no chain is ever sorted or held in one place.
    """
    numbered = pages.where(F.col("page") >= 1)
    page = F.col("page").cast("long")
    landed = numbered.groupBy(*keys, page.alias("page")).agg(
        F.count(F.lit(1)).alias("copies"),
        F.bool_or(~F.coalesce("has_more", F.lit(False))).alias("ends"),
        F.sum(F.coalesce(F.size("items"), F.lit(0)).cast("long")).alias("items"),
        F.min("quota_remaining").alias("quota"),
    )
    # Every page asks for the one after it and the chain for page 1: a gap begins where nobody answers.
    follower = F.struct((F.col("page") + 1).alias("at"), F.lit(False).alias("have"))
    itself = F.struct(F.col("page").alias("at"), F.lit(True).alias("have"))
    first = F.struct(F.lit(1).cast("long").alias("at"), F.lit(False).alias("have"))
    asked = landed.select(*keys, "page", "copies", "ends", "items", "quota", F.explode(F.array(itself, follower, first)).alias("_p"))
    own = F.col("_p.have")
    spots = asked.groupBy(*keys, F.col("_p.at").alias("at")).agg(
        F.bool_or(own).alias("have"),
        *[F.max(F.when(own, F.col(c))).alias(c) for c in ("copies", "ends", "items", "quota")],
    )
    chains = spots.groupBy(*keys).agg(
        F.count_if("have").alias("pages"),
        F.sum(F.when(F.col("have"), F.col("copies") - 1)).alias("repeats"),
        F.min(F.when(F.col("ends"), F.col("at"))).alias("last_page"),
        F.max(F.when(F.col("have"), F.col("at"))).alias("_top"),
        F.min(F.when(~F.col("have"), F.col("at"))).alias("_open"),
        F.sum("items").alias("items"),
        F.min("quota").alias("quota_left"),
    )
    # Pages beyond the end are known only once the end is: one more look at the distinct pages, joined by chain.
    ends = chains.select(*[F.col(k).alias(f"_{k}") for k in keys], "last_page").where(F.col("last_page") < F.col("_top"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    late = landed.select(*keys, "page").join(ends, same).where(F.col("page") > F.col("last_page"))
    late = late.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_late"))
    beyond = F.coalesce("_late", F.lit(0)).cast("long")
    end = F.coalesce("last_page", "_top")
    missing = end - (F.col("pages") - beyond)
    return chains.join(late, same, "left").select(
        *keys, "pages", "repeats", "last_page", missing.alias("missing"), F.when(F.col("_open") < end, F.col("_open")).alias("first_gap"),
        beyond.alias("beyond"), "items", "quota_left", (F.col("last_page").isNotNull() & (missing == 0)).alias("complete"),
    )


def request_key(params: dict[str, Column]) -> Column:
    """SHA-256 of the parameters as JSON, independent of the order they are given in."""
    ordered = F.struct(*[params[k].alias(k) for k in sorted(params)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def latest_within_ttl(
    log: DataFrame, now: Column, keys: list[str] = ["key"], created_at: str = "created_at", ttl_days: int = CACHE_TTL_DAYS,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The newest response of each key, unless it is older than ``ttl_days`` at ``now``.

    Responses that would be too old are filtered before the shuffle: where the newest one is
    too old, so are all others.
    """
    oldest = (now - F.make_dt_interval(F.lit(ttl_days))).cast(log.schema[created_at].dataType)
    fresh = log.where(F.col(created_at) >= oldest)
    return first_per_key(fresh, keys, [F.desc(created_at), *[F.desc(c) for c in (tie_break or [])]])
