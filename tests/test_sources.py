from __future__ import annotations

import json
import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from quillcast.operators.counts import reposts_per_language
from quillcast.sinks import files
from quillcast.sources import dumps, posts
from quillcast.sources.capitals import read_capitals, read_capitals_json

AT = "Mon Oct 29 14:45:07 +0000 2018"
FULL = {
    "id": 1, "created_at": AT, "text": "hi", "lang": "en", "in_reply_to_status_id": 5,
    "in_reply_to_user_id": 6, "quote_count": 1, "reply_count": 2, "retweet_count": 3, "favorite_count": 4,
    "user": {"id": 9, "name": "N", "screen_name": "n", "verified": True, "followers_count": 1,
             "friends_count": 2, "favourites_count": 3, "statuses_count": 4, "created_at": AT, "lang": "de"},
    "entities": {"hashtags": [{"text": "a"}, {"text": "b"}], "urls": [{"url": "u"}, {"expanded": "x"}],
                 "user_mentions": [{"screen_name": "m"}],
                 "media": [{"id": 7, "media_url": "p", "type": "photo"}, {}]},
    "retweeted_status": {"id": 2, "created_at": "Mon Oct 29 10:00:00 +0000 2018", "text": "orig",
                         "user": {"screen_name": "o", "lang": "ja"}},
}
LINES = [
    json.dumps(FULL),
    '{"delete": null, "id": 50}',
    '{"delete": {"status": {"id": 51}}}',
    '{"a": {"delete": 1}, "id": 52}',
    "{bad",
    '{"id": "no number", "text": "kept", "user": {"lang": "en"}}',
    "",
    '{"limit": {"track": 3}}',
    '{"id": 53, "user": null, "entities": {"hashtags": null}, "retweeted_status": null}',
    '{"id": 54, "user": {}, "retweeted_status": {"id": 3}}',
]


def lines_dir(lines) -> str:
    path = tempfile.mkdtemp(prefix="run-")
    with open(f"{path}/lines.json", "w") as out:
        out.write("\n".join(lines))
    return path


def both_ways(spark, from_file, from_column, lines=LINES):
    path = lines_dir(lines)
    rows = [r.asDict(recursive=True) for r in from_file(spark, path).orderBy("id", "text").collect()]
    column = [
        r.asDict(recursive=True)
        for r in from_column(spark.read.text(path)).orderBy("id", "text").collect()
    ]
    assert rows == column
    return rows


def test_full_posts(spark):
    rows = both_ways(spark, posts.read_posts, posts.parse_posts)
    assert [r["id"] for r in rows] == [0, 0, 1, 52, 53, 54]
    full = rows[2]
    assert full["ts"] == datetime(2018, 10, 29, 14, 45, 7)
    assert (full["text"], full["lang"]) == ("hi", "en")
    assert (full["reply_to_post_id"], full["reply_to_user_id"]) == (5, 6)
    assert [full[c] for c in ("quote_count", "reply_count", "retweet_count", "favorite_count")] == [1, 2, 3, 4]
    assert full["user"] == {
        "id": 9, "name": "N", "screen_name": "n", "verified": True, "followers_count": 1, "friends_count": 2,
        "favourites_count": 3, "statuses_count": 4, "member_since": AT, "lang": "de",
    }
    assert (full["hashtags"], full["urls"], full["user_mentions"]) == (["a", "b"], ["u"], ["m"])
    assert full["media"] == [
        {"id": 7, "media_url": "p", "type": "photo"}, {"id": 0, "media_url": "", "type": ""},
    ]
    assert full["retweet"]["id"] == 2 and full["retweet"]["user"]["lang"] == "ja"
    assert full["retweet"]["hashtags"] == [] and full["retweet"]["user"]["name"] == ""


def test_defaults_and_ill_typed_fields(spark):
    rows = both_ways(spark, posts.read_posts, posts.parse_posts)
    control, ill_typed = rows[0], rows[1]
    assert ill_typed["text"] == "kept" and ill_typed["user"]["lang"] == "en"
    assert control["user"] is None and control["retweet"] is None
    assert control["ts"] == datetime(1970, 1, 1) and control["hashtags"] == []
    assert rows[4]["user"] is None and rows[4]["retweet"] is None
    assert rows[5]["user"]["lang"] == "" and rows[5]["retweet"]["user"] is None


def test_facts_equal_facts_of_full_posts(spark):
    rows = both_ways(
        spark,
        lambda s, p: posts.read_facts(s, p).withColumn("text", F.lit("")),
        lambda frame: posts.facts_of(posts.parse_posts(frame)).withColumn("text", F.lit("")),
    )
    by_id = {r["id"]: r for r in rows}
    assert by_id[1]["rt_screen_name"] == "o" and by_id[1]["rt_text"] == "orig"
    assert by_id[1]["rt_ts"] == datetime(2018, 10, 29, 10)
    assert by_id[54]["lang"] == "" and by_id[54]["rt_id"] == 3 and by_id[54]["rt_lang"] is None


def test_column_is_parsed_once(spark):
    frame = posts.parse_facts(spark.read.text(lines_dir(LINES))).filter("rt_id is not null")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_scan_reads_needed_columns_only(spark):
    counted = reposts_per_language(posts.read_facts(spark, lines_dir(LINES)))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "text:string,user" not in plan.split("ReadSchema")[1].split("retweeted_status")[0]


def test_malformed_lines_are_counted_apart(spark):
    frame = spark.read.text(lines_dir(LINES))
    assert [r.value for r in posts.malformed_lines(frame).collect()] == ["{bad"]


def test_delete_notice_expression(spark):
    frame = spark.createDataFrame([(line,) for line in LINES], "value string")
    flags = [r[0] for r in frame.select(posts.is_delete_notice(F.col("value"))).collect()]
    assert flags == [False, True, True, False, False, False, False, False, False, False]


def test_dump_drops_broken_lines_whatever_is_read(spark):
    path = lines_dir(["1,2,-1", "x,2,3", "1,2", "1,2,3,4", "7,8,9", "7,y,9", "7,,9"])
    dump = dumps.read_dump(spark, "total", path)
    assert [tuple(r) for r in dump.orderBy("id").collect()] == [(1, 2, -1), (7, 8, 9)]
    assert dump.select("id").count() == 2 and dump.count() == 2


def test_empty_language_is_not_a_missing_user(spark):
    path = lines_dir(["1,,1540824307000,-1", "2,no-lang,1540824307000,-1"])
    facts = dumps.dump_facts(dumps.read_dump(spark, "lang", path), "lang")
    assert [r.lang for r in facts.orderBy("id").collect()] == ["", None]


def test_truncated_tail_of_language_dump(spark):
    path = lines_dir(["1,en,1540824307000,-1", "2,no-lang,1540824307000,5", "3,de,15408"])
    facts = dumps.dump_facts(dumps.read_dump(spark, "lang", path), "lang")
    rows = facts.orderBy("id").select("id", "lang", "rt_id").collect()
    assert [tuple(r) for r in rows] == [(1, "en", None), (2, None, 5)]


def test_top_dump_keeps_quotes(spark):
    path = lines_dir(["1,1540824307000,5,1540800000000,'o'", "2,1540824307000,0,0,'-'"])
    rows = dumps.dump_facts(dumps.read_dump(spark, "top", path), "top").orderBy("id").collect()
    assert [(r.rt_id, r.rt_screen_name) for r in rows] == [(5, "'o'"), (None, "'-'")]
    assert rows[0].rt_ts == datetime(2018, 10, 29, 8) and rows[1].rt_ts is None


def test_dumps_keep_commas_quotes_and_breaks(spark):
    lines = [
        (1, datetime(2018, 10, 29), 'a,b "c"', 5, datetime(2018, 10, 28), 'x,"y"\nz'),
        (2, datetime(2018, 10, 29), ",", 5, datetime(2018, 10, 28), ","),
        (3, datetime(2018, 10, 29), None, None, None, None),
    ]
    facts = spark.createDataFrame(lines, "id long, ts timestamp, lang string, rt_id long, rt_ts timestamp, rt_screen_name string")
    found = {}
    for kind in ("total", "lang", "top"):
        path = tempfile.mkdtemp(prefix="run-") + f"/{kind}"
        files.write_dump(facts, kind, path)
        found[kind] = dumps.dump_facts(dumps.read_dump(spark, kind, path), kind).orderBy("id").collect()
        assert dumps.broken_lines(spark, kind, path) == 0
    assert [r.rt_id for r in found["total"]] == [5, 5, None]
    assert [r.lang for r in found["lang"]] == ['a,b "c"', ",", None]
    assert [r.rt_id for r in found["top"]] == [5, 5, None]
    assert found["top"][1].rt_screen_name == "'\\\",\\\"'" and "\\n" in found["top"][0].rt_screen_name


def test_broken_lines_are_counted(spark):
    path = lines_dir(["1,en,1540824307000,-1", "3,de,15408", "x,de,1,1", "", "4,a,b,2,3"])
    assert dumps.broken_lines(spark, "lang", path) == 3
    assert [r.lang for r in dumps.read_dump(spark, "lang", path).orderBy("id").collect()] == ["en", "a,b"]


def test_flattened_lists(spark):
    path, out = lines_dir([json.dumps([{"_source": {"a": 1, "tags": ["x", None], "n": None, "e": []}}])]), tempfile.mkdtemp(prefix="run-") + "/flat"
    docs = dumps.read_index_dump(spark, path, "a bigint, tags array<string>, n array<string>, e array<bigint>")
    files.write_flattened(docs, out)
    assert [r.value for r in spark.read.text(out).collect()] == ["1,x,null,null"]


def test_capitals_from_lines(spark):
    path = lines_dir([
        "CountryName,CapitalName,CapitalLatitude,CapitalLongitude,CountryCode,ContinentName",
        "Nowhere,Town,1.0,2.0,NULL,Africa",
        "United States,Washington, D.C.,38.883333,-77.000000,US,America",
        "Germany,Bonn,50.0,7.0,DE,Europe",
        "Germany,Berlin,52.5,13.4, de ,Europe",
        "Broken,Line",
    ])
    rows = sorted(tuple(r) for r in read_capitals(spark, path).collect())
    assert rows == [("de", 52.5, 13.4), ("us", 38.883333, -77.0)]


def test_capitals_from_json(spark):
    path = lines_dir([json.dumps([
        {"CountryCode": "US", "CapitalLatitude": " 38.883333", "CapitalLongitude": "-77.0"},
        {"CountryCode": None, "CapitalLatitude": "1", "CapitalLongitude": "1"},
        {"CountryCode": "XX", "CapitalLatitude": "1"},
    ], indent=1)])
    assert [tuple(r) for r in read_capitals_json(spark, path).collect()] == [("us", 38.883333, -77.0)]


def test_index_dump_is_flattened_in_document_order(spark):
    hits = [{"_source": {"b": "x", "loc": {"lat": 1.5, "lon": 2.5}, "a": 3}}]
    path = lines_dir([json.dumps(hits, indent=2)])
    schema = "b string, loc struct<lat double, lon double>, a bigint"
    flat = dumps.flatten_documents(dumps.read_index_dump(spark, path, schema))
    assert flat.columns == ["b", "loc_lat", "loc_lon", "a"]
    assert tuple(flat.first()) == ("x", 1.5, 2.5, 3)
    assert dumps.read_index_dump(spark, path).first().loc.lat == 1.5


def test_documents_are_added_or_replaced(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/docs"
    result = spark.createDataFrame(
        [(datetime(2018, 10, 29), 5, "n", 'say "x", y', 3)],
        "window_start timestamp, rt_id bigint, screen_name string, text string, cnt bigint",
    )
    files.write_documents(result, "top", path)
    files.write_documents(result, "top", path)
    assert spark.read.json(path).count() == 2
    files.write_documents(result, "top", path, replace=True)
    document = spark.read.schema(files.DOCUMENTS["top"]).json(path).first()
    assert tuple(document) == ("5", "n", 'say "x", y', "1540771200000", "3")


def test_result_files_keep_awkward_texts(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/top"
    texts = [
        'a "b", c', "two\nlines", "back\\slash\\", "  lead and trail  ", "x\r\ny", "", None, "\\n \\\\n \\e", "\t", '"', "\n", "a\rb",
    ]
    rows = [(datetime(2018, 10, 29), i, text, text, 3) for i, text in enumerate(texts)]
    result = spark.createDataFrame(
        rows, "window_start timestamp, rt_id bigint, screen_name string, text string, cnt bigint"
    )
    files.write_results(result, "top", path)
    back = dumps.read_results(spark, "top", path).select(result.columns).orderBy("rt_id")
    assert [tuple(r) for r in back.collect()] == rows
