"""The given ``events`` table read as posts.

Rule, the same in Spark and in SQL: ``error`` events are delete notices; ``click``
and ``purchase`` repost the post numbered ``k`` in ``props``; languages follow from
the user's and the reposted post's number, every eighth has no user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.functions.time import CREATED_AT_OUT

# Profile languages by number modulo 8; the last one has no user.
LANGUAGES = ("en", "ja", "es", "pt", "en-gb", "ko", "de", None)

POSTS_SQL = """
posts AS (
  SELECT event_id AS id, date_trunc('second', ts) AS ts, user_id, event_type, value,
         ['en','ja','es','pt','en-gb','ko','de',NULL][user_id % 8 + 1] AS lang,
         k AS rt_id,
         TIMESTAMP '2023-01-01' + to_hours(k) AS rt_ts,
         ['en','ja','es','pt','en-gb','ko','de',NULL][k % 8 + 1] AS rt_lang,
         CASE WHEN k % 8 <> 7 THEN 'user' || k END AS rt_screen_name,
         'post ' || k AS rt_text
  FROM (SELECT *, CASE WHEN event_type IN ('click', 'purchase')
                       THEN TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) END AS k
        FROM events WHERE event_type <> 'error')
)"""


def use_utc(spark: SparkSession) -> None:
    """The tables hold zoneless UTC times; read and show them as such."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read_events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")


def _language(number: Column) -> Column:
    languages = F.array(*[F.lit(code) for code in LANGUAGES])
    return F.element_at(languages, (number % len(LANGUAGES) + 1).cast("int"))


def _second(ts: Column) -> Column:
    return F.date_trunc("second", ts.cast("timestamp"))


def _reposted() -> Column:
    return F.when(
        F.col("event_type").isin("click", "purchase"),
        F.get_json_object("props", "$.k").try_cast("bigint"),
    )


def event_facts(events: DataFrame) -> DataFrame:
    """Post facts of the events, delete notices left out."""
    k = F.col("rt_id")
    return (
        events.filter("event_type <> 'error'")
        .select(
            F.col("event_id").alias("id"),
            _second(F.col("ts")).alias("ts"),
            _language(F.col("user_id")).alias("lang"),
            # inline() is a fence: predicates on rt_id and what derives from it would
            # otherwise each parse props anew.
            F.inline(F.array(F.struct(_reposted().alias("rt_id")))),
        )
        .select(
            "id",
            "ts",
            "lang",
            "rt_id",
            F.timestamp_seconds(F.unix_timestamp(F.lit("2023-01-01 00:00:00")) + k * 3600).alias("rt_ts"),
            _language(k).alias("rt_lang"),
            F.when(k % len(LANGUAGES) != 7, F.concat(F.lit("user"), k)).alias("rt_screen_name"),
            F.concat(F.lit("post "), k).alias("rt_text"),
        )
    )


def event_json(events: DataFrame) -> DataFrame:
    """The events as raw JSON posts and delete notices: ``value``."""
    k = _reposted()
    number = F.col("event_id")
    user = F.col("user_id")
    created_at = F.date_format(_second(F.col("ts")), CREATED_AT_OUT)
    author = F.when(
        k % len(LANGUAGES) != 7,
        F.struct(
            k.alias("id"),
            F.concat(F.lit("user"), k).alias("screen_name"),
            _language(k).alias("lang"),
        ),
    )
    original = F.when(
        k.isNotNull(),
        F.struct(
            k.alias("id"),
            F.date_format(
                F.timestamp_seconds(F.unix_timestamp(F.lit("2023-01-01 00:00:00")) + k * 3600),
                CREATED_AT_OUT,
            ).alias("created_at"),
            F.concat(F.lit("post "), k).alias("text"),
            author.alias("user"),
        ),
    )
    poster = F.when(
        _language(user).isNotNull(),
        F.struct(
            user.alias("id"),
            F.concat(F.lit("name "), user).alias("name"),
            F.concat(F.lit("user"), user).alias("screen_name"),
            (user % 2 == 0).alias("verified"),
            user.cast("int").alias("followers_count"),
            _language(user).alias("lang"),
        ),
    )
    entities = F.struct(
        F.array(F.struct(F.col("event_type").alias("text"))).alias("hashtags"),
        F.array(
            F.struct(F.concat(F.lit("http://example.com/"), user).alias("url")),
            F.struct(F.lit(None).cast("string").alias("url")),
        ).alias("urls"),
        F.array(F.struct(F.concat(F.lit("user"), user).alias("screen_name"))).alias("user_mentions"),
        F.when(
            F.col("value") > 50,
            F.array(
                F.struct(
                    number.alias("id"),
                    F.concat(F.lit("http://example.com/media/"), number).alias("media_url"),
                    F.lit("photo").alias("type"),
                )
            ),
        ).alias("media"),
    )
    post = F.to_json(
        F.struct(
            number.alias("id"),
            created_at.alias("created_at"),
            F.concat(F.lit('He said "'), F.col("event_type"), F.lit('", twice')).alias("text"),
            F.when(F.col("event_type") == "view", number - 1).alias("in_reply_to_status_id"),
            F.when(F.col("event_type") == "view", user).alias("in_reply_to_user_id"),
            F.lit(1).alias("quote_count"),
            user.cast("int").alias("retweet_count"),
            poster.alias("user"),
            entities.alias("entities"),
            original.alias("retweeted_status"),
        )
    )
    notice = F.to_json(
        F.struct(F.struct(F.struct(number.alias("id")).alias("status")).alias("delete"))
    )
    return events.select(
        F.when(F.col("event_type") == "error", notice).otherwise(post).alias("value")
    )
