"""Every metric as a runnable query over the given tables, next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.functions.scalars import country_code, quoted_text, round_half_even
from quillcast.functions.time import minute_bucket
from quillcast.operators import comparison, counts, geo, ranking, series, shares
from quillcast.operators.counts import labelled
from quillcast.plans.events import POSTS_SQL, event_facts, event_json, read_events, stream_events
from quillcast.session import scratch_dir, set_modified, written
from quillcast.sinks import files
from quillcast.sources import dumps
from quillcast.sources import posts as post_source
from quillcast.sources.capitals import read_capitals
from quillcast.streaming import archive, batches, metrics, predictors, runner

Query = Callable[[SparkSession, str], DataFrame]

HOUR = "1 hour"
DAY = "1 day"
# Slices of the archive in the queries below: the tables hold a month.
_WEEK = "7 days"
# The comparisons take what lies before as the earlier batch run and the rest as live.
SPLIT = "2024-01-16"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _sql(body: str) -> str:
    return f"WITH {POSTS_SQL.strip()}{body}"


def _round_sql(value: str, places: int = 2) -> str:
    """Half-even rounding of a non-negative double's exact value, read off its decimal digits."""
    digits = f"format('{{:.80f}}', {value})"
    point = f"strpos({digits}, '.')"
    head = f"replace(left({digits}, {point} + {places}), '.', '')::BIGINT"
    tail = f"substr({digits}, {point} + {places} + 1)"
    tie = f"rpad('5', {80 - places}, '0')"
    return (
        f"(({head} + CASE WHEN {tail} > {tie} OR ({tail} = {tie} AND {head} % 2 = 1) "
        f"THEN 1 ELSE 0 END)::DOUBLE / {10**places})"
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_facts(read_events(spark, sf_dir))


# Counts -----------------------------------------------------------------------


def _win(size: str, alias: str = "window_start") -> str:
    return f"time_bucket(INTERVAL '{size}', ts) AS {alias}"


@query(
    "retweets_per_window",
    _sql(
        f" SELECT {_win('15 minutes')}, count(*) AS cnt FROM posts WHERE rt_id IS NOT NULL GROUP BY 1"
    ),
)
def retweets_per_window(spark, sf_dir):
    return labelled(counts.reposts_per_window(facts(spark, sf_dir)))


@query(
    "retweets_two_stage",
    _sql(f" SELECT {_win(HOUR)}, count(*) AS cnt FROM posts WHERE rt_id IS NOT NULL GROUP BY 1"),
)
def retweets_two_stage(spark, sf_dir):
    per_post = counts.reposts_per_post(facts(spark, sf_dir))
    return labelled(counts.totals_of_windows(per_post, HOUR))


@query(
    "retweets_per_post_window",
    _sql(
        f" SELECT {_win('15 minutes')}, rt_id, count(*) AS cnt FROM posts "
        "WHERE rt_id IS NOT NULL GROUP BY 1, 2"
    ),
)
def retweets_per_post_window(spark, sf_dir):
    return labelled(counts.reposts_per_post(facts(spark, sf_dir)))


@query(
    "retweets_per_lang",
    _sql(
        f" SELECT {_win(HOUR)}, rt_lang AS lang, count(*) AS cnt FROM posts "
        "WHERE rt_lang IS NOT NULL GROUP BY 1, 2"
    ),
)
def retweets_per_lang(spark, sf_dir):
    return labelled(counts.reposts_per_language(facts(spark, sf_dir), HOUR))


@query(
    "tweets_per_lang",
    _sql(
        f" SELECT {_win(HOUR)}, lang, count(*) AS cnt FROM posts "
        "WHERE lang IS NOT NULL GROUP BY 1, 2"
    ),
)
def tweets_per_lang(spark, sf_dir):
    return labelled(counts.posts_per_language(facts(spark, sf_dir), HOUR))


@query(
    "posts_per_minute_bucket",
    _sql(
        " SELECT date_trunc('hour', ts) + to_minutes(extract('minute' FROM ts) // 25 * 25) AS bucket25,"
        " date_trunc('minute', ts) AS bucket1, count(*) AS cnt FROM posts GROUP BY 1, 2"
    ),
)
def posts_per_minute_bucket(spark, sf_dir):
    ts = F.col("ts")
    return (
        facts(spark, sf_dir)
        .groupBy(minute_bucket(ts, 25).alias("bucket25"), minute_bucket(ts, 1).alias("bucket1"))
        .agg(F.count("*").alias("cnt"))
    )


# Ranking ----------------------------------------------------------------------

_TOP_SQL = """,
counted AS (
  SELECT {win}, rt_id, count(*) AS cnt, arg_min({name}, (ts, id)) AS screen_name,
         arg_min(rt_text, (ts, id)) AS text
  FROM posts WHERE {where} GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, rt_id) AS rn FROM counted)
SELECT window_start, rt_id, screen_name, {text}cnt FROM ranked WHERE rn <= 5 {having}"""


@query(
    "top_x_retweets",
    _sql(
        _TOP_SQL.format(
            win=_win(DAY),
            name="rt_screen_name",
            text="text, ",
            where="rt_id IS NOT NULL",
            having="AND screen_name IS NOT NULL",
        )
    ),
)
def top_x_retweets(spark, sf_dir):
    return labelled(ranking.top_posts(facts(spark, sf_dir), DAY))


@query(
    "top_x_replay",
    _sql(
        _TOP_SQL.format(
            win=_win("1 minute"),
            name="'''' || coalesce(rt_screen_name, '-') || ''''",
            text="",
            where="rt_id <> 0",
            having="",
        )
    ),
)
def top_x_replay(spark, sf_dir):
    """Top-X of the replayed raw dump: no texts there, and no author is required.

    This dump marks "no repost" by id 0, so post 0 itself cannot be told apart.
    """
    path = scratch_dir(spark, "dump-top")
    files.write_dump(facts(spark, sf_dir), "top", path)
    replayed = dumps.dump_facts(dumps.read_dump(spark, "top", path), "top")
    ranked = ranking.top_posts(
        replayed.withColumn("rt_text", F.lit(None).cast("string")), "1 minute", require_author=False
    )
    return labelled(ranked.drop("text"))


# Geo, percentages, shares -----------------------------------------------------

# Country codes given to the first nations of the table; others get a made-up one.
_NATION_CODES = ("us", "jp", "es", "pt", "gb", "de")
_CAPITALS_SQL = """capitals(code, lat, lon) AS (
  SELECT coalesce(['us', 'jp', 'es', 'pt', 'gb', 'de'][n_nationkey + 1], 'n' || n_nationkey),
         (n_nationkey * 3.25 - 40)::DOUBLE, (90 - n_nationkey * 7.5)::DOUBLE FROM nation)"""


def capitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capitals file for the nations table, written and read like a real one."""
    path = scratch_dir(spark, "capitals")
    key = F.col("n_nationkey")
    codes = F.array(*[F.lit(code) for code in _NATION_CODES])
    code = F.coalesce(F.get(codes, key.cast("int")), F.concat(F.lit("n"), key))
    line = F.concat_ws(
        ",", "n_name", F.lit("Capital, C."), key * 3.25 - 40, 90 - key * 7.5, F.upper(code), F.lit("Somewhere")
    )
    spark.read.parquet(f"{sf_dir}/nation.parquet").select(line).write.text(path)
    return read_capitals(spark, path)


def _code_sql(lang: str) -> str:
    part = f"trim({lang})"
    return (
        f"lower(CASE WHEN {part} LIKE '%-%' THEN split_part({part}, '-', 2) "
        f"WHEN {part} = 'en' THEN 'us' WHEN {part} = 'ja' THEN 'jp' WHEN {part} = 'el' THEN 'gr' "
        f"WHEN {part} = 'da' THEN 'dk' WHEN {part} = 'uk' THEN 'ua' WHEN {part} = 'fa' THEN 'ir' "
        f"WHEN {part} = 'hi' THEN 'in' ELSE {part} END)"
    )


def _geo_sql(lang: str, window: str = HOUR) -> str:
    return _sql(
        f""", {_CAPITALS_SQL},
counted AS (SELECT {_win(window)}, {lang} AS lang, count(*) AS cnt FROM posts
            WHERE rt_id IS NOT NULL AND {lang} IS NOT NULL GROUP BY 1, 2)
SELECT window_start, lang, cnt, coalesce(lat, 0.0::DOUBLE) AS lat, coalesce(lon, 0.0::DOUBLE) AS lon
FROM counted LEFT JOIN capitals ON code = {_code_sql('lang')}"""
    )


@query("retweets_per_country_geo", _geo_sql("rt_lang"))
def retweets_per_country_geo(spark, sf_dir):
    counted = counts.reposts_per_language(facts(spark, sf_dir), HOUR)
    return labelled(geo.with_capital(counted, capitals(spark, sf_dir)))


def _replayed(spark, sf_dir):
    path = scratch_dir(spark, "dump-lang")
    files.write_dump(facts(spark, sf_dir), "lang", path)
    return dumps.dump_facts(dumps.read_dump(spark, "lang", path), "lang")


@query("retweets_per_country_replay", _geo_sql("coalesce(lang, 'no-lang')"))
def retweets_per_country_replay(spark, sf_dir):
    """From the replayed dump: by the poster's language, posts without user included."""
    counted = counts.reposts_per_language(
        _replayed(spark, sf_dir), HOUR, "retweeter", keep_no_lang=True
    )
    return labelled(geo.with_capital(counted, capitals(spark, sf_dir)))


@query(
    "unknown_languages",
    _sql(
        f""", {_CAPITALS_SQL},
counted AS (SELECT coalesce(lang, 'no-lang') AS lang, count(*) AS cnt FROM posts
            WHERE rt_id IS NOT NULL GROUP BY 1)
SELECT lang, {_code_sql('lang')} AS code, cnt FROM counted
WHERE {_code_sql('lang')} NOT IN (SELECT code FROM capitals)"""
    ),
)
def unknown_languages(spark, sf_dir):
    counted = counts.reposts_per_language(
        facts(spark, sf_dir), HOUR, "retweeter", keep_no_lang=True
    )
    return geo.unknown_languages(counted, capitals(spark, sf_dir))


def _pct_sql(lang: str = "rt_lang", window: str = HOUR, where: str = "") -> str:
    return f""",
counted AS (SELECT {_win(window)}, {lang} AS lang, count(*) AS cnt FROM posts
            WHERE rt_id IS NOT NULL AND {lang} IS NOT NULL {where} GROUP BY 1, 2),
pct AS (SELECT window_start, lang, cnt,
          {_round_sql('p')} AS pct
        FROM (SELECT *, cnt::DOUBLE / CAST(sum(cnt) OVER (PARTITION BY window_start) AS BIGINT) * 100 AS p
              FROM counted))"""


_FROM_PCT = " SELECT window_start, lang, cnt, pct FROM pct"


@query("retweet_pct_per_lang", _sql(_pct_sql() + _FROM_PCT))
def retweet_pct_per_lang(spark, sf_dir):
    counted = counts.reposts_per_language(facts(spark, sf_dir), HOUR)
    return labelled(shares.percentage_of_window(counted))


@query(
    "retweet_pct_replay", _sql(_pct_sql("coalesce(lang, 'no-lang')", "15 minutes") + _FROM_PCT)
)
def retweet_pct_replay(spark, sf_dir):
    counted = counts.reposts_per_language(
        _replayed(spark, sf_dir), lang_of="retweeter", keep_no_lang=True
    )
    return labelled(shares.percentage_of_window(counted))


def _share_sql(
    lang: str = "lang", rt_lang: str = "lang", window: str = HOUR, where: str = ""
) -> str:
    return f""",
tw AS (SELECT {_win(window)}, {lang} AS lang, count(*) AS tw_total FROM posts
       WHERE {lang} IS NOT NULL {where} GROUP BY 1, 2),
rt AS (SELECT {_win(window)}, {rt_lang} AS lang, count(*) AS rt_total FROM posts
       WHERE rt_id IS NOT NULL AND {rt_lang} IS NOT NULL {where} GROUP BY 1, 2),
share AS (SELECT window_start, lang, rt_total, tw_total, rt_total::DOUBLE / tw_total AS share
          FROM tw JOIN rt USING (window_start, lang))"""


_FROM_SHARE = " SELECT window_start, lang, rt_total, tw_total, share FROM share"


@query("retweet_share_per_lang", _sql(_share_sql() + _FROM_SHARE))
def retweet_share_per_lang(spark, sf_dir):
    return labelled(shares.share_of_posts(facts(spark, sf_dir), HOUR))


@query(
    "retweet_share_replay",
    _sql(
        _share_sql("coalesce(lang, 'no-lang')", "coalesce(lang, 'no-lang')", "15 minutes")
        + _FROM_SHARE
    ),
)
def retweet_share_replay(spark, sf_dir):
    return labelled(shares.share_of_posts(_replayed(spark, sf_dir), keep_no_lang=True))


@query("retweet_share_author_lang", _sql(_share_sql(rt_lang="rt_lang") + _FROM_SHARE))
def retweet_share_author_lang(spark, sf_dir):
    return labelled(shares.share_of_posts(facts(spark, sf_dir), HOUR, "author"))


@query("retweet_share_count_join", _sql(_share_sql(rt_lang="rt_lang") + _FROM_SHARE))
def retweet_share_count_join(spark, sf_dir):
    frame = facts(spark, sf_dir)
    return labelled(
        shares.share_of_counts(
            counts.posts_per_language(frame, HOUR), counts.reposts_per_language(frame, HOUR)
        )
    )


def _max_share_sql(where: str = "") -> str:
    return _share_sql() + f""",
best AS (SELECT *, date_trunc('day', window_start) AS day,
           row_number() OVER (PARTITION BY lang, date_trunc('day', window_start)
                              ORDER BY share DESC, window_start) AS rn FROM share {where})
SELECT day::TIMESTAMP AS window_start, lang, rt_total, tw_total, share FROM best WHERE rn = 1"""


@query("max_share_per_lang_day", _sql(_max_share_sql()))
def max_share_per_lang_day(spark, sf_dir):
    return labelled(shares.max_share(shares.share_of_posts(facts(spark, sf_dir), HOUR), DAY))


# Predictors -------------------------------------------------------------------

_SERIES_SQL = f""",
s AS (SELECT *, row_number() OVER (ORDER BY window_start) AS rn,
             epoch_ms(window_start)::DOUBLE AS x FROM (
  SELECT {_win('{window}')}, count(*) AS cnt FROM posts WHERE rt_id IS NOT NULL GROUP BY 1) {{where}})"""
_PREDICTIONS_SQL = {
    "AVG": """coalesce(avg(cnt) OVER (ORDER BY window_start
  ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0.0)""",
    "SIMPLEREGRESSION": """CASE WHEN rn > 2 THEN
  x * sum(x * cnt) OVER (ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  / sum(x * x) OVER (ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE 0.0 END""",
    "REINFORCEMENT": """list_reduce(list_prepend(0.0::DOUBLE,
  coalesce(list(cnt::DOUBLE) OVER (ORDER BY window_start ROWS BETWEEN 600 PRECEDING AND 1 PRECEDING), [])),
  lambda v, c: v + 0.1 * (c - v))""",
}


def _series_sql(window: str, where: str = "") -> str:
    return _SERIES_SQL.format(window=window, where=where)


def _prediction_sql(kind: str) -> str:
    return (
        f"SELECT '{kind}' AS prediction_type, window_start, cnt, p AS prediction, "
        f"cnt - p AS deviation FROM (SELECT *, ({_PREDICTIONS_SQL[kind]})::FLOAT::DOUBLE AS p FROM s)"
    )


def _rounded(predictions: DataFrame) -> DataFrame:
    # Sums in another order differ in the last digits. Single precision drops those, and
    # unlike decimal places it has no ties that such decimal numbers could sit on.
    prediction = F.col("prediction").cast("float").cast("double")
    return predictions.withColumn("prediction", prediction).withColumn(
        "deviation", F.col("cnt") - F.col("prediction")
    )


def _predictions(spark, sf_dir, window="1 minute", types=series.TYPES):
    counted = labelled(counts.reposts_per_window(facts(spark, sf_dir), window))
    return series.predict(counted, window, types=types)


def _prediction_query(name: str, kind: str) -> None:
    @query(name, _sql(_series_sql("1 minute") + _prediction_sql(kind)))
    def run(spark, sf_dir):
        return _rounded(_predictions(spark, sf_dir, types=[kind]))


_prediction_query("predict_avg", series.AVERAGE)
_prediction_query("predict_regression", series.REGRESSION)
_prediction_query("predict_tracking", series.TRACKING)


# Comparisons ------------------------------------------------------------------


def _from_split(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz"))


def _before_split(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))


def _halves(spark, sf_dir):
    events = read_events(spark, sf_dir)
    return event_facts(_from_split(events)), event_facts(_before_split(events))


def _compare_sql(
    ctes: Callable[[str], str], table: str, values: dict[str, str], keys: tuple[str, ...], where: str = ""
) -> str:
    slot = "hour(window_start) * 60 + minute(window_start) // 15 * 15"
    key_list = "".join(f", {k}" for k in keys)
    picked = ", ".join(f"arg_max({c}, window_start) AS batch_{c}" for c in values)
    filled = ", ".join(f"coalesce(batch_{c}, {fill}) AS batch_{c}" for c, fill in values.items())
    on = "".join(f" AND l.{k} = b.{k}" for k in keys)
    live_columns = ", ".join(f"l.{c}" for c in ("window_start", *keys, *values))
    return _sql(
        ctes
        + f""",
b AS (SELECT {slot} AS slot{key_list}, {picked} FROM {table}
      WHERE window_start < TIMESTAMP '{SPLIT}' GROUP BY ALL),
l AS (SELECT *, {slot} AS slot FROM {table} WHERE window_start >= TIMESTAMP '{SPLIT}' {where})
SELECT {live_columns}, {filled} FROM l LEFT JOIN b ON l.slot = b.slot{on}"""
    )


def _total_sql(window: str) -> str:
    return f""",
total AS (SELECT {_win(window)}, count(*) AS cnt FROM posts WHERE rt_id IS NOT NULL GROUP BY 1)"""


@query(
    "compare_total_by_time_of_day",
    _compare_sql(_total_sql("15 minutes"), "total", {"cnt": "0"}, ()),
)
def compare_total_by_time_of_day(spark, sf_dir):
    live, batch = _halves(spark, sf_dir)
    return comparison.compare_totals(
        labelled(counts.reposts_per_window(live)), labelled(counts.reposts_per_window(batch))
    )


def _percentages(frame, window="15 minutes"):
    return labelled(shares.percentage_of_window(counts.reposts_per_language(frame, window)))


@query(
    "compare_pct_by_time_of_day",
    _compare_sql(_pct_sql(window="15 minutes"), "pct", {"pct": "0.0", "cnt": "0"}, ("lang",)),
)
def compare_pct_by_time_of_day(spark, sf_dir):
    live, batch = _halves(spark, sf_dir)
    return comparison.compare_percentages(_percentages(live), _percentages(batch))


_SHARE_FILL = {"rt_total": "0", "tw_total": "0", "share": "0.0"}


@query(
    "compare_share_by_time_of_day",
    _compare_sql(_share_sql(window="15 minutes"), "share", _SHARE_FILL, ("lang",)),
)
def compare_share_by_time_of_day(spark, sf_dir):
    live, batch = _halves(spark, sf_dir)
    return comparison.compare_shares(
        labelled(shares.share_of_posts(live)), labelled(shares.share_of_posts(batch))
    )


# Scalar functions -------------------------------------------------------------


@query(
    "lang_code_normalise",
    _sql(
        f" SELECT id, {_code_sql('lang')} AS code, {_code_sql('upper(lang)')} AS code_upper, "
        f"{_code_sql('rt_lang')} AS code_author FROM posts"
    ),
)
def lang_code_normalise(spark, sf_dir):
    lang = F.col("lang")
    return facts(spark, sf_dir).select(
        "id",
        country_code(F.concat(F.lit(" "), lang, F.lit(" "))).alias("code"),
        country_code(F.upper(lang)).alias("code_upper"),
        country_code(F.concat("rt_lang", F.lit("-"))).alias("code_author"),
    )


@query(
    "escape_text",
    """SELECT doc_id, '''' || replace(CASE WHEN regexp_matches(text, '[,"\\n\\r]')
  THEN '"' || replace(text, '"', '""') || '"' ELSE text END, '"', '\\"') || '''' AS escaped
FROM documents""",
)
def escape_text(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", quoted_text(F.col("text")).alias("escaped"))


@query(
    "round_to_places",
    f"SELECT event_id, {_round_sql('value / 3')} AS third, {_round_sql('value / 8', 3)} AS eighth "
    "FROM events",
)
def round_to_places(spark, sf_dir):
    value = F.col("value")
    return read_events(spark, sf_dir).select(
        "event_id",
        round_half_even(value / 3).alias("third"),
        round_half_even(value / 8, 3).alias("eighth"),
    )


# JSON posts -------------------------------------------------------------------


def json_posts_dir(spark, sf_dir) -> str:
    path = scratch_dir(spark, "json-posts")
    event_json(read_events(spark, sf_dir)).write.text(path)
    return path


_FACT_COLUMNS = "id, ts, lang, rt_id, rt_ts, rt_lang, rt_screen_name, rt_text"


@query("post_json_facts", _sql(f" SELECT {_FACT_COLUMNS} FROM posts"))
def post_json_facts(spark, sf_dir):
    return post_source.read_facts(spark, json_posts_dir(spark, sf_dir))


@query("post_json_column_facts", _sql(f" SELECT {_FACT_COLUMNS} FROM posts"))
def post_json_column_facts(spark, sf_dir):
    return post_source.parse_facts(event_json(read_events(spark, sf_dir)))


@query(
    "post_json_parse",
    _sql(
        """ SELECT id, strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at, ts,
  'He said "' || event_type || '", twice' AS text, '' AS lang,
  CASE WHEN event_type = 'view' THEN id - 1 ELSE 0 END AS reply_to_post_id,
  CASE WHEN event_type = 'view' THEN user_id ELSE 0 END AS reply_to_user_id,
  1::INTEGER AS quote_count, 0::INTEGER AS reply_count, user_id::INTEGER AS retweet_count,
  0::INTEGER AS favorite_count,
  CASE WHEN lang IS NOT NULL THEN user_id END AS user_id,
  CASE WHEN lang IS NOT NULL THEN 'name ' || user_id END AS user_name,
  CASE WHEN lang IS NOT NULL THEN 'user' || user_id END AS user_screen_name,
  CASE WHEN lang IS NOT NULL THEN user_id % 2 = 0 END AS user_verified,
  CASE WHEN lang IS NOT NULL THEN user_id END::INTEGER AS user_followers,
  CASE WHEN lang IS NOT NULL THEN 0 END::INTEGER AS user_friends,
  CASE WHEN lang IS NOT NULL THEN '' END AS user_member_since,
  lang AS user_lang,
  rt_id AS retweet_id, rt_ts AS retweet_ts, rt_text AS retweet_text,
  rt_screen_name AS retweet_screen_name, rt_lang AS retweet_lang
FROM posts"""
    ),
)
def post_json_parse(spark, sf_dir):
    return post_source.read_posts(spark, json_posts_dir(spark, sf_dir)).select(
        "id", "created_at", "ts", "text", "lang", "reply_to_post_id", "reply_to_user_id",
        "quote_count", "reply_count", "retweet_count", "favorite_count",
        F.col("user.id").alias("user_id"),
        F.col("user.name").alias("user_name"),
        F.col("user.screen_name").alias("user_screen_name"),
        F.col("user.verified").alias("user_verified"),
        F.col("user.followers_count").alias("user_followers"),
        F.col("user.friends_count").alias("user_friends"),
        F.col("user.member_since").alias("user_member_since"),
        F.col("user.lang").alias("user_lang"),
        F.col("retweet.id").alias("retweet_id"),
        F.col("retweet.ts").alias("retweet_ts"),
        F.col("retweet.text").alias("retweet_text"),
        F.col("retweet.user.screen_name").alias("retweet_screen_name"),
        F.col("retweet.user.lang").alias("retweet_lang"),
    )


@query(
    "post_media_entities",
    _sql(
        """ SELECT id, event_type AS hashtags, 'http://example.com/' || user_id AS urls,
  'user' || user_id AS user_mentions, CASE WHEN value > 50 THEN id END AS media_id,
  CASE WHEN value > 50 THEN 'http://example.com/media/' || id END AS media_url,
  CASE WHEN value > 50 THEN 'photo' END AS media_type FROM posts"""
    ),
)
def post_media_entities(spark, sf_dir):
    media = F.try_element_at("media", F.lit(1))
    return post_source.parse_posts(event_json(read_events(spark, sf_dir))).select(
        "id",
        *[F.array_join(c, "|").alias(c) for c in ("hashtags", "urls", "user_mentions")],
        media["id"].alias("media_id"),
        media["media_url"].alias("media_url"),
        media["type"].alias("media_type"),
    )


@query(
    "delete_notices",
    "SELECT event_type = 'error' AS is_delete, count(*) AS cnt FROM events GROUP BY 1",
)
def delete_notices(spark, sf_dir):
    raw = event_json(read_events(spark, sf_dir))
    return raw.groupBy(post_source.is_delete_notice(F.col("value")).alias("is_delete")).agg(
        F.count("*").alias("cnt")
    )


# Dumps, result files, documents -----------------------------------------------

_DUMP_SQL = {
    "total": "id, epoch_ms(ts) AS created_ms, coalesce(rt_id, -1) AS rt_id",
    "lang": "id, coalesce(lang, 'no-lang') AS lang, epoch_ms(ts) AS created_ms, "
    "coalesce(rt_id, -1) AS rt_id",
    "top": "id, epoch_ms(ts) AS created_ms, coalesce(rt_id, 0) AS rt_id, "
    "coalesce(epoch_ms(rt_ts), 0) AS rt_created_ms, "
    "'''' || coalesce(rt_screen_name, '-') || '''' AS rt_screen_name",
}


def _dump_query(kind: str) -> None:
    @query(f"raw_dump_{kind}", _sql(f" SELECT {_DUMP_SQL[kind]} FROM posts"))
    def run(spark, sf_dir):
        path = scratch_dir(spark, f"dump-{kind}")
        files.write_dump(facts(spark, sf_dir), kind, path)
        return dumps.read_dump(spark, kind, path)


for _kind in _DUMP_SQL:
    _dump_query(_kind)


_RESULTS: dict[str, Query] = {
    "total": retweets_per_window,
    "top": top_x_retweets,
    "geo": retweets_per_country_geo,
    "percentage": retweet_pct_per_lang,
    "share": retweet_share_per_lang,
}


def _result_query(kind: str) -> None:
    @query(f"result_file_{kind}", ORACLES[_RESULTS[kind].__name__])
    def run(spark, sf_dir):
        path = scratch_dir(spark, f"result-{kind}")
        files.write_results(_RESULTS[kind](spark, sf_dir), kind, path)
        return dumps.read_results(spark, kind, path)


for _kind in _RESULTS:
    _result_query(_kind)


@query(
    "result_file_prediction",
    _sql(
        _series_sql(HOUR)
        + f"SELECT window_start, cnt, prediction, deviation FROM ({_prediction_sql('AVG')})"
    ),
)
def result_file_prediction(spark, sf_dir):
    path = scratch_dir(spark, "result-prediction")
    average = series.only(_predictions(spark, sf_dir, HOUR, [series.AVERAGE]), series.AVERAGE)
    files.write_results(_rounded(average), "prediction", path)
    return dumps.read_results(spark, "prediction", path)


def _prediction_day(spark, sf_dir):
    return _rounded(_predictions(spark, sf_dir, DAY))


_ALL_PREDICTIONS_SQL = " UNION ALL ".join(_prediction_sql(kind) for kind in _PREDICTIONS_SQL)
_DOCUMENT_SQL = {
    "total": "epoch_ms(window_start) AS watermark, cnt",
    "top": "rt_id::VARCHAR AS \"tId\", screen_name AS screenname, text AS tweet, "
    "epoch_ms(window_start)::VARCHAR AS watermark, cnt::VARCHAR AS cnt",
    "geo": "lang AS langcode, lat AS location_lat, lon AS location_lon, "
    "epoch_ms(window_start) AS watermark, cnt",
    "percentage": "lang AS langcode, epoch_ms(window_start) AS watermark, pct AS percentage, cnt",
    "share": "lang AS langcode, epoch_ms(window_start) AS watermark, rt_total, tw_total, "
    "share AS percentage",
}


def _document_query(kind: str, result: Query, sql: str) -> None:
    @query(f"documents_{kind}", sql)
    def run(spark, sf_dir):
        path = scratch_dir(spark, f"documents-{kind}")
        files.write_documents(result(spark, sf_dir), kind, path, replace=True)
        return dumps.flatten_documents(spark.read.schema(files.DOCUMENTS[kind]).json(path))


for _kind, _result in _RESULTS.items():
    _document_query(
        _kind, _result, f"SELECT {_DOCUMENT_SQL[_kind]} FROM ({ORACLES[_result.__name__]})"
    )
_document_query(
    "prediction",
    _prediction_day,
    "SELECT prediction_type, epoch_ms(window_start) AS watermark, cnt, prediction, deviation FROM ("
    + _sql(_series_sql(DAY) + _ALL_PREDICTIONS_SQL)
    + ")",
)


@query(
    "flatten_index_dump",
    f"SELECT langcode || ',' || (location_lat * 4)::BIGINT || ',' || (location_lon * 4)::BIGINT || ',' || watermark || ',' "
    "|| cnt || CASE cnt % 3 WHEN 0 THEN '' WHEN 1 THEN ',' || langcode ELSE ',' || langcode || ',null' END AS line "
    f"FROM (SELECT {_DOCUMENT_SQL['geo']} FROM ({_geo_sql('rt_lang')}))",
)
def flatten_index_dump(spark, sf_dir):
    """Index dumps with a nested object and a list of none to two fields, as plain lines.

    Coordinates are numbers in quarters of a degree here: doubles print differently in SQL.
    """
    path, out = scratch_dir(spark, "index-dump"), scratch_dir(spark, "flattened")
    result = retweets_per_country_geo(spark, sf_dir)
    tags = F.slice(F.array("langcode", F.lit(None).cast("string")), 1, (F.col("cnt") % 3).cast("int"))
    docs = files.documents(result, "geo").select(
        "langcode", F.col("location").alias("where"), "watermark", "cnt", tags.alias("tags")
    )
    docs = docs.withColumns(
        {"where": F.struct(*[(F.col(f"where.{c}") * 4).cast("bigint").alias(c) for c in ("lat", "lon")]),
         "day": F.to_date(F.timestamp_millis("watermark"))}
    )
    files.write_index_dump(docs, path, "day")
    schema = "langcode string, where struct<lat bigint, lon bigint>, watermark bigint, cnt bigint, tags array<string>"
    files.write_flattened(dumps.read_index_dump(spark, path, schema), out)
    return spark.read.text(out).withColumnRenamed("value", "line")


# Streams ----------------------------------------------------------------------


def _stream(spark, sf_dir):
    return metrics.with_event_time(event_facts(stream_events(spark, sf_dir)))


def run_stream(
    spark: SparkSession, name: str, stream: DataFrame, finish=None, finish_batch=None
) -> DataFrame:
    """Run a stream over all present input and read back what it wrote."""
    path = scratch_dir(spark, name)
    started = runner.start(
        stream,
        f"{path}/checkpoint",
        {f"{path}/out": runner.parquet},
        finish,
        spark.sparkContext.defaultParallelism,
        finish_batch=finish_batch,
    )
    runner.finish_query(started)
    return spark.read.parquet(f"{path}/out").drop("batch_id")


def _closed(sql: str, size: str, *seen: str) -> str:
    """The rows of windows a stream has closed: their end is 5 s behind the last post it saw.

    Filters run ahead of the watermark, so a stream sees the posts that pass its
    filter; of two joined streams the slower one counts.
    """
    latest = ", ".join(f"max(ts) FILTER (WHERE {condition})" for condition in seen or ("true",))
    return _sql(
        f" SELECT * FROM ({sql}) WHERE window_start + INTERVAL '{size}' <= "
        f"(SELECT least({latest}) - INTERVAL '5 seconds' FROM posts)"
    )


_REPOST = "rt_id IS NOT NULL"
_HAS_AUTHOR = "rt_lang IS NOT NULL"
_HAS_USER = "lang IS NOT NULL"


@query(
    "stream_retweets_per_window", _closed(ORACLES["retweets_per_window"], "15 minutes", _REPOST)
)
def stream_retweets_per_window(spark, sf_dir):
    stream, finish = metrics.reposts_per_window(_stream(spark, sf_dir))
    return run_stream(spark, "stream-total", stream, finish)


@query("stream_retweets_two_stage", _closed(ORACLES["retweets_two_stage"], HOUR, _REPOST))
def stream_retweets_two_stage(spark, sf_dir):
    stream, finish = metrics.reposts_two_stage(_stream(spark, sf_dir))
    return run_stream(spark, "stream-two-stage", stream, finish)


@query("stream_top_x", _closed(ORACLES["top_x_retweets"], DAY, "true"))
def stream_top_x(spark, sf_dir):
    """The state holds numbers only; names and texts are looked up in the archive of facts."""
    path = scratch_dir(spark, "stream-top")
    lines = event_facts(stream_events(spark, sf_dir)).withColumns({"arrived": F.lit(None).cast("timestamp"), "kind": F.lit("post")})
    filing = archive.start_filing_lines(lines, f"{path}/facts", f"{path}/filed", DAY, metrics.DELAY, slice_length=_WEEK)
    runner.finish_query(filing)
    rows = archive.in_time(archive.stream_archive(spark, f"{path}/facts"), DAY, metrics.DELAY)
    stream, finish = metrics.top_posts(rows, DAY, look_up=lambda winners: archive.posts_at(spark, f"{path}/facts", winners, slice_length=_WEEK))
    return run_stream(spark, "stream-top", stream, finish)


@query("stream_country_geo", _closed(ORACLES["retweets_per_country_geo"], HOUR, _HAS_AUTHOR))
def stream_country_geo(spark, sf_dir):
    stream, finish = metrics.reposts_per_country(
        _stream(spark, sf_dir), capitals(spark, sf_dir), HOUR
    )
    return run_stream(spark, "stream-geo", stream, finish)


@query("stream_pct", _closed(ORACLES["retweet_pct_per_lang"], HOUR, _HAS_AUTHOR))
def stream_pct(spark, sf_dir):
    stream, finish = metrics.percentage_per_language(_stream(spark, sf_dir), HOUR)
    return run_stream(spark, "stream-pct", stream, finish)


@query("stream_share", _closed(ORACLES["retweet_share_per_lang"], HOUR, _HAS_USER))
def stream_share(spark, sf_dir):
    stream, finish = metrics.share_per_language(_stream(spark, sf_dir), HOUR)
    return run_stream(spark, "stream-share", stream, finish)


@query("stream_share_author_lang", _closed(ORACLES["retweet_share_author_lang"], HOUR))
def stream_share_author_lang(spark, sf_dir):
    stream, finish = metrics.share_per_language(_stream(spark, sf_dir), HOUR, "author")
    return run_stream(spark, "stream-share-author", stream, finish)


@query(
    "stream_share_window_join",
    _closed(ORACLES["retweet_share_author_lang"], HOUR, _HAS_USER, _HAS_AUTHOR),
)
def stream_share_window_join(spark, sf_dir):
    stream, finish = metrics.share_by_window_join(_stream(spark, sf_dir), HOUR)
    return run_stream(spark, "stream-share-join", stream, finish)


@query("stream_max_share", _closed(ORACLES["max_share_per_lang_day"], DAY, _HAS_USER))
def stream_max_share(spark, sf_dir):
    stream, finish = metrics.max_share_per_language(_stream(spark, sf_dir))
    return run_stream(spark, "stream-max-share", stream, finish)


@query(
    "stream_predictions",
    _closed(_sql(_series_sql("1 minute") + _ALL_PREDICTIONS_SQL), "1 minute", _REPOST),
)
def stream_predictions(spark, sf_dir):
    counted, label = metrics.reposts_per_window(_stream(spark, sf_dir), "1 minute")
    return _rounded(_streamed_predictions(spark, label(counted), "1 minute"))


def _streamed_predictions(spark, closed: DataFrame, window: str, key: str | None = None) -> DataFrame:
    path = scratch_dir(spark, "stream-series")
    started = runner.start_file_sink(
        closed, f"{path}/series", f"{path}/checkpoint", spark.sparkContext.defaultParallelism
    )
    runner.finish_query(started)
    return run_stream(
        spark,
        "stream-predictions",
        predictors.stream_series(spark, f"{path}/series", key),
        finish_batch=predictors.carrying(f"{path}/state", window, series_key=key),
    )


def _by_lang_sql() -> str:
    """One language after the other: the SQL of a series, each over its own counts."""
    parts = []
    for lang in ("en", "ja", "es", "pt", "en-gb", "ko", "de"):
        one = _sql(_series_sql(HOUR) + _prediction_sql("AVG")).replace(
            "rt_id IS NOT NULL", f"rt_lang = '{lang}'"
        )
        parts.append(f"SELECT '{lang}' AS lang, * FROM ({one})")
    return " UNION ALL ".join(parts)


@query("predict_avg_by_lang", _by_lang_sql())
def predict_avg_by_lang(spark, sf_dir):
    counted = labelled(counts.reposts_per_language(facts(spark, sf_dir), HOUR))
    return _rounded(series.predict(counted, HOUR, series_key="lang", types=[series.AVERAGE]))


@query("stream_predictions_by_lang", _closed(_by_lang_sql(), HOUR, _HAS_AUTHOR))
def stream_predictions_by_lang(spark, sf_dir):
    counted = labelled(counts.reposts_per_language(_stream(spark, sf_dir), HOUR))
    found = _streamed_predictions(spark, counted, HOUR, "lang")
    return _rounded(found.filter(F.col("prediction_type") == series.AVERAGE))


@query(
    "stream_malformed",
    "SELECT count(*) AS lines, count(*) FILTER (event_type = 'error') AS notices, "
    "count(*) FILTER (event_id % 7 = 0 AND event_type <> 'error') AS malformed FROM events",
)
def stream_malformed(spark, sf_dir):
    """Every seventh post is cut short; the parsing stream counts what it cannot read."""
    path = scratch_dir(spark, "cut-posts")
    events = read_events(spark, sf_dir)
    whole = event_json(events.filter("event_id % 7 <> 0 OR event_type = 'error'"))
    cut = event_json(events.filter("event_id % 7 = 0 AND event_type <> 'error'"))
    whole.union(cut.select(F.expr("left(value, length(value) - 2)").alias("value"))).write.text(path)
    query = runner.start_file_sink(
        post_source.stream_facts(spark, path), f"{path}-facts", f"{path}-checkpoint"
    )
    runner.finish_query(query)
    seen = runner.observed(query, post_source.PARSED)
    return spark.createDataFrame([seen], "lines bigint, notices bigint, malformed bigint")


def _live_and_batch(spark, sf_dir):
    live = metrics.with_event_time(event_facts(_from_split(stream_events(spark, sf_dir))))
    return live, event_facts(_before_split(read_events(spark, sf_dir)))


def _batch_result(spark, result: DataFrame, kind: str) -> DataFrame:
    """The time-of-day slots of the earlier batch run's result file, computed once."""
    path = scratch_dir(spark, f"earlier-{kind}")
    files.write_results(result, kind, path)
    return written(comparison.earlier_slots(dumps.read_results(spark, kind, path), kind), "slots")


@query(
    "stream_compare_total",
    _closed(ORACLES["compare_total_by_time_of_day"], "15 minutes", _REPOST),
)
def stream_compare_total(spark, sf_dir):
    live, batch = _live_and_batch(spark, sf_dir)
    earlier = _batch_result(spark, labelled(counts.reposts_per_window(batch)), "total")
    stream, label = metrics.reposts_per_window(live)
    return run_stream(
        spark, "stream-compare-total", stream,
        lambda closed: comparison.with_slots(label(closed), earlier, "total"),
    )


@query(
    "stream_compare_pct",
    _closed(ORACLES["compare_pct_by_time_of_day"], "15 minutes", _HAS_AUTHOR),
)
def stream_compare_pct(spark, sf_dir):
    live, batch = _live_and_batch(spark, sf_dir)
    earlier = _batch_result(spark, _percentages(batch), "percentage")
    stream, finish = metrics.percentage_per_language(live)
    return run_stream(
        spark, "stream-compare-pct", stream,
        lambda closed: comparison.with_slots(finish(closed), earlier, "percentage"),
    )


@query(
    "stream_compare_share",
    _closed(ORACLES["compare_share_by_time_of_day"], "15 minutes", _HAS_USER),
)
def stream_compare_share(spark, sf_dir):
    live, batch = _live_and_batch(spark, sf_dir)
    earlier = _batch_result(spark, labelled(shares.share_of_posts(batch)), "share")
    stream, label = metrics.share_per_language(live)
    return run_stream(
        spark, "stream-compare-share", stream,
        lambda closed: comparison.with_slots(label(closed), earlier, "share"),
    )


@query(
    "stream_json_dump",
    _sql(
        f" SELECT l.*, t.* EXCLUDE (id, created_ms, rt_id), t.rt_id AS top_rt_id FROM (SELECT {_DUMP_SQL['lang']} FROM posts) l "
        f"JOIN (SELECT {_DUMP_SQL['top']} FROM posts) t USING (id)"
    ),
)
def stream_json_dump(spark, sf_dir):
    """JSON lines in, two raw dumps out of one parse; both are read back."""
    path = scratch_dir(spark, "stream-dump")
    stream = post_source.stream_facts(spark, json_posts_dir(spark, sf_dir))
    outputs = {f"{path}/{kind}": files.dump_writer(kind) for kind in ("lang", "top")}
    runner.finish_query(runner.start(stream, f"{path}/checkpoint", outputs))
    lang, top = (dumps.read_dump(spark, kind, f"{path}/{kind}/batch_id=*") for kind in ("lang", "top"))
    return lang.join(top.withColumnRenamed("rt_id", "top_rt_id").drop("created_ms"), "id")


@query(
    "raw_dump_broken_lines",
    _sql(
        " SELECT count(*) FILTER (id % 11 <> 0) AS whole, count(*) FILTER (id % 11 = 0) AS broken, "
        "sum(id) FILTER (id % 11 <> 0)::BIGINT AS ids FROM posts"
    ),
)
def raw_dump_broken_lines(spark, sf_dir):
    """A dump in which every eleventh line ends too early: whole lines are read, the others counted."""
    path = scratch_dir(spark, "broken-dump")
    rows = files.dump_rows(facts(spark, sf_dir), "total").select("id", F.concat_ws(",", "id", "created_ms", "rt_id").alias("line"))
    cut = F.when(F.col("id") % 11 == 0, F.substring_index("line", ",", 2)).otherwise(F.col("line"))
    rows.select(cut.alias("value")).write.text(path)
    read = dumps.read_dump(spark, "total", path).agg(F.count("*").alias("whole"), F.sum("id").alias("ids"))
    return read.withColumn("broken", F.lit(dumps.broken_lines(spark, "total", path)).cast("bigint"))


# Streams that fall silent, arrive late, or go on for long ----------------------------

# Posts in the order they arrive in: one file per quarter of the table's time, every
# tenth post one file later than it was written.
_ARRIVALS = 4
_ARRIVAL_SQL = f"""
span AS (SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events),
arrivals AS (
  SELECT event_id AS id, least({_ARRIVALS - 1}, epoch_us(ts - first_ts) * {_ARRIVALS} // (epoch_us(last_ts - first_ts) + 1)
                               + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END) AS part
  FROM events, span),
seen AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
         FROM posts JOIN arrivals USING (id) GROUP BY part),
arrived AS (SELECT posts.*, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= seen - INTERVAL '5 seconds' AS late
            FROM posts JOIN arrivals USING (id) JOIN seen USING (part))"""


def _arrivals(spark, sf_dir) -> list[DataFrame]:
    """The events by the file they arrive in."""
    events = read_events(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    part = F.floor((micros - first) * _ARRIVALS / (last - first + 1)) + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    told = events.withColumn("part", F.least(part, F.lit(_ARRIVALS - 1)))
    return [told.filter(F.col("part") == number).drop("part") for number in range(_ARRIVALS)]


def _file_arrivals(spark, sf_dir, path: str, window: str) -> None:
    """File one arrival after the other; the filing query ends and starts anew each time."""
    for events in _arrivals(spark, sf_dir):
        event_json(events).write.mode("append").text(f"{path}/inbox")
        runner.finish_query(
            archive.start_filing(spark, f"{path}/inbox", f"{path}/facts", f"{path}/filed", window, metrics.DELAY, slice_length=_WEEK)
        )


@query(
    "stream_late_posts",
    f"WITH {POSTS_SQL.strip()}, {_ARRIVAL_SQL.strip()} "
    "SELECT (SELECT count(*) FROM events) AS lines, (SELECT count(*) FROM events WHERE event_type = 'error') AS notices, "
    "0::BIGINT AS malformed, count(*) AS posts, count(*) FILTER (late) AS late FROM arrived",
)
def stream_late_posts(spark, sf_dir):
    """What the archive's totals count over four runs of the filing query."""
    path = scratch_dir(spark, "late-posts")
    _file_arrivals(spark, sf_dir, path, HOUR)
    found = archive.totals(spark, f"{path}/facts")
    return spark.createDataFrame([[found[name] for name in archive.COUNTS]], ", ".join(f"{name} bigint" for name in archive.COUNTS))


@query(
    "stream_without_late_posts",
    f"WITH {POSTS_SQL.strip()}, {_ARRIVAL_SQL.strip()} "
    f"SELECT {_win(HOUR)}, rt_lang AS lang, count(*) AS cnt FROM arrived WHERE rt_lang IS NOT NULL AND NOT coalesce(late, false) GROUP BY 1, 2",
)
def stream_without_late_posts(spark, sf_dir):
    """Counts leave out exactly the posts that the totals count as late; the last window is closed by a tick."""
    path = scratch_dir(spark, "no-late-posts")
    _file_arrivals(spark, sf_dir, path, HOUR)
    latest = archive.totals(spark, f"{path}/facts")["latest"]
    archive.tick(spark, f"{path}/facts", latest + archive.length_of(spark, f"{HOUR} {metrics.DELAY}"))
    rows = archive.in_time(archive.stream_archive(spark, f"{path}/facts"), HOUR, metrics.DELAY)
    return run_stream(spark, "no-late-posts", counts.reposts_per_language(rows, HOUR), labelled)


def _until_silent(spark, sf_dir, name: str, window: str, metric) -> str:
    """Run filing and metric side by side until the idle clock has closed all windows; the folder of results.

    An hour of the stream passes per second of silence.
    """
    path = scratch_dir(spark, name)
    inbox, facts = json_posts_dir(spark, sf_dir), f"{path}/facts"
    trigger = {"processingTime": "200 milliseconds"}
    filing = archive.start_filing(spark, inbox, facts, f"{path}/filed", window, metrics.DELAY, slice_length=_WEEK, **trigger)
    filing.processAllAvailable()
    stream, finish = metric(archive.in_time(archive.stream_archive(spark, facts), window, metrics.DELAY))
    results = runner.start(
        stream, f"{path}/checkpoint", {f"{path}/out": runner.parquet}, finish, spark.sparkContext.defaultParallelism, **trigger
    )
    silent = archive.IdleClock(spark, facts, filing, f"{window} {metrics.DELAY}", idle=1.0, pace=3600.0)
    silent.start()
    try:
        while not silent.closed.wait(1) and archive.totals(spark, facts).get("latest") is not None:
            for running in (filing, results):
                if running.exception():
                    raise running.exception()
            if not silent.is_alive():
                raise RuntimeError("the idle clock has stopped")
        results.processAllAvailable()
    finally:
        silent.stop()
        filing.stop()
        results.stop()
    return f"{path}/out"


@query("stream_last_window", ORACLES["retweets_per_lang"])
def stream_last_window(spark, sf_dir):
    """A stream whose inbox falls silent shows its last window, too: all that a batch would."""
    out = _until_silent(spark, sf_dir, "last-window", HOUR, lambda rows: (counts.reposts_per_language(rows, HOUR), labelled))
    return spark.read.parquet(out).drop("batch_id")


@query("stream_last_share", ORACLES["retweet_share_per_lang"])
def stream_last_share(spark, sf_dir):
    """As above for shares, whose last window holds posts of both kinds."""
    out = _until_silent(spark, sf_dir, "last-share", HOUR, lambda rows: (shares.share_of_posts(rows, HOUR), labelled))
    return spark.read.parquet(out).drop("batch_id")


_ARRIVED = "TIMESTAMP '2024-02-01' + to_minutes(7 * (event_id % 5))"


@query(
    "stream_by_arrival",
    f"WITH {POSTS_SQL.strip()} SELECT time_bucket(INTERVAL '15 minutes', {_ARRIVED.replace('event_id', 'id')}) AS window_start, "
    "count(*) AS cnt FROM posts WHERE rt_id IS NOT NULL GROUP BY 1",
)
def stream_by_arrival(spark, sf_dir):
    """Windows by the time at which a post's file arrived, stored with the facts: the same whenever it runs."""
    path = scratch_dir(spark, "by-arrival")
    events = read_events(spark, sf_dir)
    for part in range(5):
        folder = f"{path}/inbox/part={part}"
        event_json(events.filter(F.col("event_id") % 5 == part)).write.text(folder)
        set_modified(spark, folder, 1_706_745_600_000 + 7 * 60_000 * part)
    facts = f"{path}/facts"
    filing = archive.start_filing(spark, f"{path}/inbox/part=*", facts, f"{path}/filed", "15 minutes", metrics.DELAY, "arrival")
    runner.finish_query(filing)
    archive.tick(spark, facts, archive.totals(spark, facts)["latest"] + archive.length_of(spark, f"15 minutes {metrics.DELAY}"))
    rows = archive.in_time(archive.stream_archive(spark, facts, "arrival"), "15 minutes", metrics.DELAY, "arrival")
    return run_stream(spark, "by-arrival", counts.reposts_per_window(rows), labelled)


@query("stream_merged_results", _closed(ORACLES["retweet_pct_per_lang"], HOUR, _HAS_AUTHOR))
def stream_merged_results(spark, sf_dir):
    """Result files of many micro-batches, merged by threes as they come, read back."""
    path = scratch_dir(spark, "merged")
    for number, events in enumerate(_days(spark, sf_dir, 10)):
        events.write.parquet(f"{path}/events/part={number:02d}")
    schema = read_events(spark, sf_dir).schema
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events/part=*")
    stream, finish = metrics.percentage_per_language(metrics.with_event_time(event_facts(arriving)), HOUR)
    started = runner.start(
        stream, f"{path}/checkpoint", {f"{path}/out": files.result_writer("percentage")}, finish,
        spark.sparkContext.defaultParallelism, files_per_batch=1, merge=3,
    )
    runner.finish_query(started)
    return dumps.read_results(spark, "percentage", batches.current(spark, f"{path}/out"))


def _days(spark, sf_dir, parts: int) -> list[DataFrame]:
    """The events in order of time, in files of equally long periods; one file each."""
    events = read_events(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    part = F.floor((micros - first) * parts / (last - first + 1))
    return [events.filter(part == number).coalesce(1) for number in range(parts)]


# Index dumps with documents of several kinds -----------------------------------------

# Keys come in another order or not at all by the event's number; texts hold what JSON is made of.
_ODD_TEXT_SQL = """'{"' || event_type || '}\\' || event_id || '[,'"""
_RAGGED_SQL = f"""
SELECT CASE event_id % 4
  WHEN 0 THEN event_type || ',' || event_id || ',null,' || {_ODD_TEXT_SQL}
  WHEN 1 THEN {_ODD_TEXT_SQL} || ',' || user_id || ',' || event_type || ',' || event_id
  WHEN 2 THEN event_id || ',true,' || event_type || ',x' || event_id
  ELSE event_id::VARCHAR END AS line
FROM events"""


def _ragged_documents() -> Column:
    number, kind = F.col("event_id"), F.col("event_type")
    odd = F.concat(F.lit('{"'), kind, F.lit("}\\"), number, F.lit("[,"))
    absent = F.lit(None).cast("string")
    shapes = [
        F.to_json(F.struct(kind.alias("z"), number.alias("a"), absent.alias("gone"), odd.alias("text")), {"ignoreNullFields": "false"}),
        F.to_json(F.struct(odd.alias("text"), F.struct(F.col("user_id").alias("y"), kind.alias("b")).alias("who"), number.alias("a"))),
        F.to_json(F.struct(number.alias("a"), F.lit(True).alias("seen"), F.array(kind, F.concat(F.lit("x"), number)).alias("tags"))),
        F.to_json(F.struct(F.struct(absent.alias("none")).alias("empty"), number.alias("a"))),
    ]
    picked = F.when(number % 4 == 0, shapes[0]).when(number % 4 == 1, shapes[1]).when(number % 4 == 2, shapes[2]).otherwise(shapes[3])
    return F.concat(F.lit('{"_source":'), picked, F.lit("}"))


def _ragged_dump(spark, sf_dir) -> str:
    """Index dumps of a few hundred documents a line, several lines a file."""
    path = scratch_dir(spark, "ragged-dump")
    documents = read_events(spark, sf_dir).select(F.floor(F.col("event_id") / 500).alias("block"), _ragged_documents().alias("document"))
    arrays = documents.groupBy("block").agg(F.array_join(F.collect_list("document"), ", ").alias("documents"))
    arrays.select(F.concat(F.lit("["), F.col("documents"), F.lit("]"))).write.text(path)
    return path


@query("flatten_ragged_dump", _RAGGED_SQL)
def flatten_ragged_dump(spark, sf_dir):
    """Documents with other keys and orders of keys in one dump, each flattened as it is."""
    return dumps.flattened_lines(dumps.array_elements(spark, _ragged_dump(spark, sf_dir)))


@query(
    "split_index_dump",
    f"SELECT event_id AS a, CASE WHEN event_id % 4 < 2 THEN {_ODD_TEXT_SQL} END AS text, "
    "CASE WHEN event_id % 4 = 1 THEN user_id END AS y FROM events",
)
def split_index_dump(spark, sf_dir):
    """The same dump as typed rows, its files read in splits of some kilobytes."""
    path, setting = _ragged_dump(spark, sf_dir), "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16k")
    try:
        documents = written(dumps.read_index_dump(spark, path, "a bigint, text string, who struct<y:bigint>"), "documents")
    finally:
        spark.conf.set(setting, before)
    return documents.select("a", "text", F.col("who.y").alias("y"))


# A sparse series: most seconds hold no repost, and the predictor forgets slowly.
@query(
    "predict_slow_tracking",
    _sql(
        _series_sql("1 second")
        + _prediction_sql("REINFORCEMENT").replace("0.1 *", "0.001 *").replace("600 PRECEDING", "UNBOUNDED PRECEDING")
    ),
)
def predict_slow_tracking(spark, sf_dir):
    counted = labelled(counts.reposts_per_window(facts(spark, sf_dir), "1 second"))
    return _rounded(series.predict(counted, "1 second", step=0.001, types=[series.TRACKING]))


# Several window sizes from one pass ---------------------------------------------------

_SIZES = ("1 minute", "15 minutes", HOUR)
_SIZES_SQL = _sql(
    " " + " UNION ALL ".join(
        f"SELECT '{size}' AS size, {_win(size)}, count(*) AS cnt FROM posts WHERE rt_id IS NOT NULL GROUP BY 1, 2" for size in _SIZES
    )
)


@query("retweets_window_sizes", _SIZES_SQL)
def retweets_window_sizes(spark, sf_dir):
    return counts.reposts_per_windows(facts(spark, sf_dir), _SIZES)


@query(
    "retweets_window_sizes_per_lang",
    _sql(
        " " + " UNION ALL ".join(
            f"SELECT '{size}' AS size, {_win(size)}, rt_lang AS lang, count(*) AS cnt FROM posts WHERE rt_lang IS NOT NULL GROUP BY 1, 2, 3"
            for size in ("20 minutes", HOUR, DAY)
        )
    ),
)
def retweets_window_sizes_per_lang(spark, sf_dir):
    panes = counts.reposts_per_language(facts(spark, sf_dir), "20 minutes")
    return counts.rolled_up(panes, ("20 minutes", HOUR, DAY), "lang")


@query("stream_window_sizes", _SIZES_SQL)
def stream_window_sizes(spark, sf_dir):
    """Panes from a stream, all closed by a tick; every size from the stored panes."""
    path = scratch_dir(spark, "window-sizes")
    lines = event_facts(stream_events(spark, sf_dir)).withColumns({"arrived": F.lit(None).cast("timestamp"), "kind": F.lit("post")})
    facts_ = f"{path}/facts"
    runner.finish_query(archive.start_filing_lines(lines, facts_, f"{path}/filed", _SIZES[0], metrics.DELAY, slice_length=_WEEK))
    archive.tick(spark, facts_, archive.totals(spark, facts_)["latest"] + archive.length_of(spark, f"{_SIZES[0]} {metrics.DELAY}"))
    rows = archive.in_time(archive.stream_archive(spark, facts_), _SIZES[0], metrics.DELAY)
    panes = run_stream(spark, "panes", counts.panes(counts.reposts(rows), _SIZES[0]))
    return counts.rolled_up(panes, _SIZES)
