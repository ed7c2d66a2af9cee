from __future__ import annotations

import base64
import hashlib
import json
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, difference
from tokenizers import Tokenizer

from quillcast.llm import packing, queries, range_coder, token_files, tokens, tool_calls, warc
from quillcast.session import scratch_dir

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# Web archives


def expected_records(pages):
    payloads = [(page, (html or "").encode()) for page, _, html in pages]
    latest = {}
    for page, payload in payloads:
        if page is not None:
            latest[payload] = max(page, latest.get(payload, page))
    rows = []
    for page, payload in payloads:
        original = latest.get(payload) == page
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        rows.append((str(page), len(payload), digest, "response" if original else "revisit", None if original else latest[payload]))
    return sorted(rows, key=str)


def found_records(frame):
    return sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


def test_archives_round_trip(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    assert found_records(queries.QUERIES["op1_warc_index"](spark, sf_dir)) == expected_records(pages)


def test_archives_of_messy_rows(spark):
    same = "<p>same</p>\r\n\r\nWARC/1.1 ünï"
    pages = [(1, "http://A.example.org/x?q=1#f", same), (2, None, same), (9, "http://www.a.example.org:80/x?q=1", same), (9, "http://www.a.example.org:80/x?q=1", same),
             (3, "", None), (4, "://[bad", ""), (None, "http://b.example", same), (None, None, "only here"), (5, "x" * 3000, "y" * 300_000)]
    pages += [(100 + n, "http://hot.example/", f"page {n % 7}") for n in range(300)]
    frame = spark.createDataFrame([(i, u, h, 1, "f") for i, u, h in pages], "page_id long, url string, html string, page int, file string").repartition(4)
    assert found_records(warc.round_trip(spark, frame)) == expected_records(pages)
    empty = spark.createDataFrame([], frame.schema)
    assert warc.round_trip(spark, empty).collect() == []


def test_lookup_over_block_borders(spark):
    base = scratch_dir(spark, "warc-blocks")
    pages = spark.createDataFrame([(n // 3, f"http://h{n % 5}.example/{n % 2}", str(n)) for n in range(200)], "page_id long, url string, html string")
    captures = warc.write_archives(pages, base)
    shards = warc.write_index(captures, base, block=4)
    wanted = captures.select("url_key", "page").distinct()
    absent = spark.createDataFrame([("com,absent)/", 1), ("example,h1)/1", 10_000), ("", None)], "url_key string, page long")
    assert warc.lookup(wanted, shards, base).count() == 200
    assert warc.lookup(absent, shards, base).collect() == []


def test_url_keys():
    assert warc.url_key("https://www.Blog.example.com:443/a/b?x=1#top") == "com,example,blog)/a/b?x=1"
    assert warc.url_key("blog.example.com") == "com,example,blog)/"
    assert warc.url_key(None) == ")/"


def test_records_are_well_formed():
    warc_head, http, payload = warc.parse(warc.record(7, "http://x.example/", b"<p>\r\n\r\n</p>", 7, True))
    assert payload == b"<p>\r\n\r\n</p>" and int(http["content-length"]) == len(payload) and warc_head["warc-type"] == "response"


# Tokens, packing and token files


@pytest.mark.parametrize(("path", "glued"), [(BYTES, True), (WORDS, False)])
def test_encoder_equals_library(path, glued):
    ids = library(path)
    encoder = tokens.Encoder(path, glued)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from(list("aB  \n\t.,!'s1Ωß́é\xa0\x1c<|>#\0")), st.characters(exclude_categories=["Cs"])), max_size=40))
    def same(text):
        assert np.frombuffer(next(encoder.encode([text])), dtype="<u4").tolist() == ids(text)

    same()
    for text in ("it's 'tis  I'LL\t\tgo", "a <|endoftext|> b<|startoftext|>", "word.### word,*** " * 50):
        assert np.frombuffer(next(encoder.encode([text])), dtype="<u4").tolist() == ids(text)


@pytest.mark.parametrize(("path", "glued"), [(BYTES, True), (WORDS, False)])
def test_chunks_that_are_encoded_together(path, glued):
    """Separators within texts, line breaks next to white space, and letters that normalising takes apart."""
    rng = random.Random(8)
    parts = ["a", "B.", "x\ny", "don't", "\u0130stanbul", "\u0915\u093c", "\u0958", "99", "$%.", "\x01", "\u0120", "\u010a", "a\tb", "\n", "", "\r\n"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(3000)] + ["\r\x85 \n\u0130\u0130,$. \u0130\u0130%\u0301 ", "\n", "a\n", "\na b"]
    ids = library(path)
    found = [np.frombuffer(one, dtype="<u4").tolist() for one in tokens.Encoder(path, glued).encode(texts)]
    assert found == [ids(text) for text in texts]


def test_new_chunks_go_to_the_library_together(monkeypatch):
    encoder, calls = tokens.Encoder(BYTES, True), []
    plain = encoder._library
    monkeypatch.setattr(encoder, "_library", lambda texts: calls.append(len(texts)) or plain(texts))
    list(encoder.encode([" ".join(f"word{chr(97 + at % 26)}{chr(97 + at // 26)}" for at in range(600)) + "\nEnd"]))
    assert sum(calls) < 20


@pytest.mark.parametrize(("path", "glued"), [(BYTES, True), (WORDS, False)])
def test_words_go_to_the_library_without_separators(path, glued, monkeypatch):
    """A task's core does all of it: no threads of the library's own."""
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    ids = library(path)
    encoder, sent = tokens.Encoder(path, glued), []
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    plain = encoder._library
    monkeypatch.setattr(encoder, "_library", lambda texts: sent.extend(texts) or plain(texts))
    text = " ".join(f"word{chr(97 + at % 26)}{chr(97 + at // 26)}{'é' * (at % 2)}" for at in range(300)) + "."
    assert np.frombuffer(next(encoder.encode([text])), dtype="<u4").tolist() == ids(text)
    assert sum(map(len, sent)) <= len(text) + 5


@pytest.mark.parametrize(("path", "glued"), [(BYTES, True), (WORDS, False)])
def test_chunks_without_separators(path, glued):
    """Signs, contractions, other white space and letters that lower-casing or composing changes, one next to the other."""
    rng = random.Random(9)
    parts = ["a", "Ab", "'s", "it's", "<|endoftext|>", "</w>", "\u01c5x", "\u03a3\u03a3", "e\u0301", "\u2126", "\u0374", "\uac00", "\u00aa", "x\ty", "\xa0z", "\x1cq", "\u0120b", "_c-d", "7", "\u0660", "z.", "\U0001f600", "\u200b"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(2000)]
    ids = library(path)
    found = [np.frombuffer(one, dtype="<u4").tolist() for one in tokens.Encoder(path, glued).encode(texts)]
    assert found == [ids(text) for text in texts]


def check_packing(found, pairs):
    ids = library(BYTES)
    whole = Counter()
    by_place = defaultdict(list)
    for doc_id, text in pairs:
        all_ids = [*ids(text), 0]
        n = len(all_ids)
        first = n % 2048 or 2048
        for piece, start in enumerate([0, *range(first, n, 2048)]):
            length = first if piece == 0 else 2048
            whole[str(doc_id), piece, start, length, crc(all_ids[start : start + length])] += 1
    assert Counter((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == whole
    for r in found:
        by_place[r.sequence_id].append((r.offset, r.length))
    for some in by_place.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_place), sum(r.length for r in found)


def test_packing(spark, sf_dir, documents, messy, no_docs):
    sequences, n_tokens = check_packing(queries.QUERIES["op5_best_fit_packing"](spark, sf_dir).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    assert sequences <= -(-n_tokens // 2048) * 1.02 + 1
    check_packing(packing.packed(messy, BYTES).withColumnRenamed("id", "doc_id").collect(), [(r.doc_id, r.text) for r in messy.collect()])
    assert packing.packed(no_docs, BYTES).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_places_every_piece(histogram):
    patterns = packing.plan(histogram, 64)
    placed = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 64 and times > 0
        for length in pattern:
            placed[length] += times
    assert placed == Counter(histogram)
    # At most one sequence is not over half full.
    assert sum(times for _, times in patterns) <= 2 * sum(k * v for k, v in histogram.items()) / 64 + 1


def test_exact_combinations_fill_sequences():
    assert packing.plan({60: 3, 4: 1, 3: 1, 1: 1, 2: 2}, 64) == [((60, 4), 1), ((60, 3, 1), 1), ((60, 2, 2), 1)]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 60), st.integers(1, 9), st.sampled_from([2, 40, 65536]), st.integers(0, 2**32 - 1))
def test_range_coder_round_trip(places, blocks, below, seed):
    ids = np.random.default_rng(seed).integers(0, below, (places, blocks)).astype(np.uint16)
    assert (range_coder.decode(range_coder.encode(ids), places) == ids).all()


def test_range_coder_learns():
    ids = np.tile(np.arange(64, dtype=np.uint16) * 700, 32)[:, None]
    (code,) = range_coder.encode(ids)
    assert len(code) * 8 < 3 * len(ids)
    skewed = np.random.default_rng(1).geometric(0.02, (4096, 2)).astype(np.uint16)
    assert sum(map(len, range_coder.encode(skewed))) * 8 < 10 * skewed.size


def expected_files(pairs):
    ids, start, rows = library(WORDS), 0, []
    for doc_id, text in pairs:
        own = [*ids(text), 1]
        rows.append((doc_id, start, len(own), crc(own)))
        start += len(own)
    return rows


def test_token_files(spark, sf_dir, documents):
    pairs = sorted((r.doc_id, r.text) for r in documents.collect())
    found = queries.QUERIES["op10_token_files"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == expected_files(pairs)


def test_token_files_of_messy_rows(spark, messy, no_docs):
    found = sorted(token_files.round_trip(spark, messy, WORDS).collect(), key=lambda r: r.start)
    ids = library(WORDS)
    want = Counter((str(r.doc_id), len(ids(r.text)) + 1, crc([*ids(r.text), 1])) for r in messy.collect())
    assert Counter((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found[:-1])]).tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert order == sorted(order)
    assert token_files.round_trip(spark, no_docs, WORDS).collect() == []


def test_damage_is_noticed(tmp_path):
    system = pafs.LocalFileSystem()
    path = str(tmp_path / "one.ids")
    writer = token_files.Writer(system.open_output_stream(path))
    writer.add([1], np.arange(3000, dtype="<u4"))
    writer.close()
    parts = list(token_files.read(system, path))
    assert np.concatenate([ids for _, _, ids, _ in parts]).tolist() == list(range(3000))
    data = bytearray((tmp_path / "one.ids").read_bytes())
    data[40] ^= 0x55
    (tmp_path / "one.ids").write_bytes(data)
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read(system, path))
    (tmp_path / "one.ids").write_bytes(data[:-9])
    with pytest.raises(ValueError, match="not whole"):
        list(token_files.read(system, path))


# Tool calls


def test_conversations_link(spark, sf_dir):
    turns = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    calls = {f"{t['conv_id']}-{t['turn']}": t for t in turns if t["role"] != "assistant"}
    answers = {f"{t['conv_id']}-{t['turn'] - 1}": t for t in turns if t["role"] == "assistant"}
    asks = {key for key, t in calls.items() if t["role"] == "user"}

    def depth(key):
        t = calls[key]
        before = f"{t['conv_id']}-{t['turn'] - 2}"
        return 1 + depth(before) if key in asks and before in calls else 0

    want = {}
    for key in calls.keys() | answers.keys():
        call, answer = calls.get(key), answers.get(key)
        status = "orphan" if call is None else "unanswered" if answer is None else "linked"
        arguments = None if call is None else {"prompt" if key in asks else "instructions": call["text"], "turn": call["turn"]}
        record = json.dumps({"arguments": arguments, "id": key, "name": call and ("ask" if key in asks else "configure"), "result": answer and answer["text"]}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        want[key] = (status, None if call is None else depth(key), record)
    found = queries.QUERIES["op3_tool_call_linking"](spark, sf_dir).collect()
    assert {r.call_id: (r.status, r.depth, r.record) for r in found} == want
    assert len(found) == len(want)


SCHEMAS = {"f": {"type": "object", "properties": {"n": {"type": "integer", "minimum": 1}, "tags": {"type": "array", "items": {"type": "string"}}}, "required": ["n"], "additionalProperties": False}}


def test_calls_of_messy_rows(spark):
    chain = [(1, f"k{n}", n, "f", '{"n": 2}', f"k{n - 1}" if n else None) for n in range(70)]
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "f", '{"n": 1, "tags": ["x"]}', None), (1, "b", 2, "f", '{"tags": [1], "z": 0}', "a"), (1, "c", 3, "g", "{}", "b"), (1, "d", 4, "f", "{", "missing"),
            (2, "e", 1, "f", None, "f"), (2, "f", 2, "f", '{"n": 0}', "e"), (2, "g", 3, "f", '{"n": true}', "f"), (1, "a", 5, "f", '{"n": 9}', "c"), (None, None, None, None, None, None), *chain,
        ],
        "conv_id long, call_id string, turn long, name string, arguments string, after string",
    )
    results = spark.createDataFrame([("a", 2, "two"), ("a", 2, "also"), ("b", None, None), ("zz", 1, "lost"), (None, 1, "nobody"), ("e", 3, "x")], "call_id string, turn long, content string")
    found = {(r.call_id, r.status): r for r in tool_calls.link(calls, results, SCHEMAS).collect()}
    said = {key: (r.depth, r.valid, r.problems, r.copies) for key, r in found.items() if not re.match("k", str(key[0]))}
    assert said == {
        ("a", "linked"): (0, True, "", 4),
        ("b", "linked"): (1, False, "$.n: missing; $.tags[0]: not of type string; $.z: unknown", 2),
        ("c", "unanswered"): (2, False, "$: unknown tool", 1),
        ("d", "unanswered"): (0, False, "$: no JSON", 1),
        ("e", "cyclic"): (None, False, "$: not of type object", 2),
        ("f", "cyclic"): (None, False, "$.n: out of range", 1),
        ("g", "cyclic"): (None, False, "$.n: not of type integer", 1),
        ("zz", "orphan"): (None, None, None, 1),
        (None, "unanswered"): (None, False, "$: unknown tool", 1),
        (None, "orphan"): (None, None, None, 1),
    }
    assert [found[f"k{n}", "unanswered"].depth for n in range(70)] == list(range(70))
    assert json.loads(found["a", "linked"].record) == {"arguments": {"n": 1, "tags": ["x"]}, "id": "a", "name": "f", "result": "also"}
    none = tool_calls.link(calls.limit(0), results.limit(0), SCHEMAS)
    assert none.collect() == []


def test_turns_with_nulls(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None), (1, 1, "assistant", None), (None, 0, "user", "x"), (1, None, "user", "x"), (1, 2, None, "x"), (1, 2, "user", ""), (1, 2, "user", "")],
        "conv_id long, turn long, role string, text string",
    )
    calls, results = tool_calls.conversation_calls(turns)
    found = {r.call_id: (r.status, r.valid, r.copies) for r in tool_calls.link(calls, results, tool_calls.CHAT_SCHEMAS).collect()}
    assert found == {"1-0": ("linked", False, 2), "1-2": ("unanswered", False, 2)}


@pytest.mark.parametrize("name", ["op1_warc_index", "op3_tool_call_linking"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    found = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert len(found) and difference(found, connect(sf_dir).sql(queries.ORACLES[name]).df()) is None
