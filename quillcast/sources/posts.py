"""Raw JSON posts to typed posts (nested model) or post facts (flat, for metrics).

Two entries lead here: files of JSON lines, batch or stream, through Spark's JSON
source, and a text column of any frame (a queue's value column, say) through
``from_json``. Both parse every line once, drop delete notices and keep lines
with absent or ill-typed fields under their defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.functions.time import created_at_ts

_USER = (
    "user struct<id:bigint,name:string,screen_name:string,verified:boolean,"
    "followers_count:int,friends_count:int,favourites_count:int,statuses_count:int,"
    "created_at:string,lang:string>"
)
_ENTITIES = (
    "entities struct<hashtags:array<struct<text:string>>,urls:array<struct<url:string>>,"
    "user_mentions:array<struct<screen_name:string>>,"
    "media:array<struct<id:bigint,media_url:string,type:string>>>"
)
_POST = (
    "id bigint, created_at string, text string, in_reply_to_status_id bigint, "
    "in_reply_to_user_id bigint, quote_count int, reply_count int, retweet_count int, "
    f"favorite_count int, lang string, {_USER}, {_ENTITIES}"
)
_LEAN_POST = "id bigint, created_at string, text string, user struct<screen_name:string,lang:string>"


def _raw_schema(post: str) -> str:
    # A variant keeps an explicit JSON null apart from an absent key, which is what
    # marks {"delete": null} as a delete notice.
    return f"`delete` variant, {post}, retweeted_status struct<{post}>, _malformed string"


RAW_POST = _raw_schema(_POST)
RAW_LEAN_POST = _raw_schema(_LEAN_POST)
_CORRUPT = {"columnNameOfCorruptRecord": "_malformed"}


def _kept(raw: DataFrame) -> DataFrame:
    # _malformed also marks valid objects with an ill-typed field; those stay. The
    # second look at the text happens for marked lines only.
    return raw.filter(F.expr("`delete` is null") & ~_is_malformed())


def _is_malformed() -> Column:
    return F.col("_malformed").isNotNull() & F.json_object_keys("_malformed").isNull()


def _user(raw: Column) -> Column:
    def text(name: str) -> Column:
        return F.coalesce(raw[name], F.lit(""))

    def number(name: str) -> Column:
        return F.coalesce(raw[name], F.lit(0))

    return F.when(
        raw.isNotNull(),
        F.struct(
            number("id").cast("bigint").alias("id"),
            text("name").alias("name"),
            text("screen_name").alias("screen_name"),
            F.coalesce(raw["verified"], F.lit(False)).alias("verified"),
            number("followers_count").alias("followers_count"),
            number("friends_count").alias("friends_count"),
            number("favourites_count").alias("favourites_count"),
            number("statuses_count").alias("statuses_count"),
            text("created_at").alias("member_since"),
            text("lang").alias("lang"),
        ),
    )


def _list(items: Column, element: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.transform(items, element), F.array())


def _media(item: Column) -> Column:
    return F.struct(
        F.coalesce(item["id"], F.lit(0)).cast("bigint").alias("id"),
        F.coalesce(item["media_url"], F.lit("")).alias("media_url"),
        F.coalesce(item["type"], F.lit("")).alias("type"),
    )


def _post_fields(field: Callable[[str], Column]) -> list[Column]:
    entities = field("entities")
    with_url = F.filter(entities["urls"], lambda u: u["url"].isNotNull())
    created_at = F.coalesce(field("created_at"), F.lit(""))
    return [
        F.coalesce(field("id"), F.lit(0)).cast("bigint").alias("id"),
        created_at.alias("created_at"),
        created_at_ts(created_at).alias("ts"),
        F.coalesce(field("text"), F.lit("")).alias("text"),
        _user(field("user")).alias("user"),
        F.coalesce(field("in_reply_to_status_id"), F.lit(0)).cast("bigint").alias("reply_to_post_id"),
        F.coalesce(field("in_reply_to_user_id"), F.lit(0)).cast("bigint").alias("reply_to_user_id"),
        *[
            F.coalesce(field(name), F.lit(0)).cast("int").alias(name)
            for name in ("quote_count", "reply_count", "retweet_count", "favorite_count")
        ],
        F.coalesce(field("lang"), F.lit("")).alias("lang"),
        _list(entities["hashtags"], lambda h: h["text"]).alias("hashtags"),
        _list(with_url, lambda u: u["url"]).alias("urls"),
        _list(entities["user_mentions"], lambda m: m["screen_name"]).alias("user_mentions"),
        _list(entities["media"], _media).alias("media"),
    ]


def _as_posts(raw: DataFrame) -> DataFrame:
    original = F.col("retweeted_status")
    return _kept(raw).select(
        *_post_fields(F.col),
        F.when(original.isNotNull(), F.struct(*_post_fields(lambda name: original[name]))).alias(
            "retweet"
        ),
    )


def _fact_fields() -> list[Column]:
    original = F.col("retweeted_status")

    def of_original(value: Column) -> Column:
        return F.when(original.isNotNull(), value)

    def of_author(name: str) -> Column:
        author = original["user"]
        return F.when(author.isNotNull(), F.coalesce(author[name], F.lit("")))

    user = F.col("user")
    return [
        F.coalesce("id", F.lit(0)).cast("bigint").alias("id"),
        created_at_ts(F.coalesce("created_at", F.lit(""))).alias("ts"),
        F.when(user.isNotNull(), F.coalesce(user["lang"], F.lit(""))).alias("lang"),
        of_original(F.coalesce(original["id"], F.lit(0))).cast("bigint").alias("rt_id"),
        of_original(created_at_ts(F.coalesce(original["created_at"], F.lit("")))).alias("rt_ts"),
        of_author("lang").alias("rt_lang"),
        of_author("screen_name").alias("rt_screen_name"),
        of_original(F.coalesce(original["text"], F.lit(""))).alias("rt_text"),
    ]


def _as_facts(raw: DataFrame) -> DataFrame:
    return _kept(raw).select(*_fact_fields())


def _json_files(reader, schema: str, path: str) -> DataFrame:
    return reader.schema(schema).options(**_CORRUPT).json(path)


def _json_column(frame: DataFrame, value: str, schema: str) -> DataFrame:
    # inline() is a fence: without it the filters below would be pushed under the
    # projection and parse the text once more per predicate.
    parsed = F.from_json(F.col(value), schema, _CORRUPT)
    return frame.filter(F.trim(value) != "").select(F.inline(F.array(parsed)))


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Full posts from a folder of JSON lines."""
    return _as_posts(_json_files(spark.read, RAW_POST, path))


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Post facts from a folder of JSON lines; only the fields metrics need are parsed."""
    return _as_facts(_json_files(spark.read, RAW_LEAN_POST, path))


def stream_posts(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Full posts from a folder that keeps receiving files of JSON lines."""
    return _as_posts(_json_files(_stream_reader(spark, max_files_per_trigger), RAW_POST, path))


#: Name of the metrics that :func:`stream_facts` reports in a query's progress.
PARSED = "parsed"


def stream_facts(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Post facts from a folder that keeps receiving files of JSON lines.

    The same pass counts ``lines``, ``notices`` and ``malformed`` lines per micro-batch as
    observed metrics.
    """
    return _as_facts(_observed(_json_files(_stream_reader(spark, max_files_per_trigger), RAW_LEAN_POST, path)))


def _observed(raw: DataFrame) -> DataFrame:
    return raw.observe(
        PARSED,
        F.count("*").alias("lines"),
        F.count_if(F.expr("`delete` is not null")).alias("notices"),
        F.count_if(_is_malformed()).alias("malformed"),
    )


# What a line turned out to be.
POST, NOTICE, MALFORMED = "post", "notice", "malformed"


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Every line of a folder that keeps receiving files: its ``kind``, post facts, and when its file ``arrived``."""
    raw = _observed(_json_files(_stream_reader(spark, max_files_per_trigger), RAW_LEAN_POST, path))
    kind = F.when(_is_malformed(), MALFORMED).when(F.expr("`delete` is not null"), NOTICE).otherwise(POST)
    return raw.select(*_fact_fields(), F.col("_metadata.file_modification_time").alias("arrived"), kind.alias("kind"))


def _stream_reader(spark: SparkSession, max_files_per_trigger: int | None):
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader


def parse_posts(frame: DataFrame, value: str = "value") -> DataFrame:
    """Full posts from a text column holding one JSON post per row."""
    return _as_posts(_json_column(frame, value, RAW_POST))


def parse_facts(frame: DataFrame, value: str = "value") -> DataFrame:
    """Post facts from a text column holding one JSON post per row."""
    return _as_facts(_json_column(frame, value, RAW_LEAN_POST))


def facts_of(posts: DataFrame) -> DataFrame:
    """Post facts of full posts."""
    return posts.select(
        "id",
        "ts",
        F.col("user.lang").alias("lang"),
        F.col("retweet.id").alias("rt_id"),
        F.col("retweet.ts").alias("rt_ts"),
        F.col("retweet.user.lang").alias("rt_lang"),
        F.col("retweet.user.screen_name").alias("rt_screen_name"),
        F.col("retweet.text").alias("rt_text"),
    )


def malformed_lines(frame: DataFrame, value: str = "value") -> DataFrame:
    """The lines the parser cannot read, for counting them apart."""
    return (
        _json_column(frame, value, RAW_LEAN_POST)
        .filter(_is_malformed())
        .select(F.col("_malformed").alias("value"))
    )


def is_delete_notice(value: Column) -> Column:
    """True for an object with a top-level ``delete`` key, whatever its value."""
    return F.coalesce(F.array_contains(F.json_object_keys(value), "delete"), F.lit(False))
