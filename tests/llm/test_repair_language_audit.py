from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from oracle import connect, difference

from quillcast.llm import conversation_repair, filter_audit, language_id, queries
from quillcast.llm.conversation_repair import END, GUESS, fix_up, repaired_turns, run_back, trace

SMALL = "/root/testdata/sf0.01"
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_filter_audit"])
def test_query_equals_sql(spark, sf_dir, name):
    for folder in (sf_dir, SMALL):
        ours = queries.QUERIES[name](spark, folder).toPandas()
        assert len(ours) > 0 and difference(ours, connect(folder).sql(queries.ORACLES[name]).df()) is None


# Conversation repair ----------------------------------------------------------


def faults(turns):
    seen, found = set(), []
    for role, text in turns:
        said = text.strip(" \t\n\x0b\f\r")
        if not said:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(turns, most_inserts=4):
    """All edits, one by one: least cost, then least audit."""
    wrong, best = faults(turns), (10**9, "~", None)

    def go(at, cost, audit, out, inserts):
        nonlocal best
        if cost > best[0]:
            return
        if at == len(turns) and re.fullmatch(r"(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in out)):
            best = min(best, (cost, audit, tuple(out)))
        if inserts < most_inserts:
            for role in ("user", "assistant"):
                go(at, cost + 3, audit + "I", [*out, (role, "")], inserts + 1)
        if at < len(turns):
            role, text = turns[at]
            go(at + 1, cost + 4, audit + "D", out, inserts)
            if wrong[at] not in ("blank", "duplicate"):
                more = cost + 3 * (wrong[at] == "truncated")
                go(at + 1, more, audit + "K", [*out, turns[at]], inserts)
                for new in ("user", "assistant"):
                    go(at + 1, more + 3, audit + "R", [*out, (new, text)], inserts)

    go(0, 0, "", [], 0)
    return best


def random_turns(rng, size):
    return [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]), rng.choice(["", "a.", "b!", "c?", "d", "e .", "f. \n", "g"]) + " " * rng.randrange(2)) for _ in range(size)]


def figures(turns):
    kinds = Counter(faults(turns))
    initials = [role[:1] for role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal


@pytest.mark.parametrize("bits", [1, 8])
def test_repairs_equal_brute_force(spark, monkeypatch, bits):
    """With chunks of two rows and of all rows."""
    monkeypatch.setattr(conversation_repair, "CHUNK_BITS", bits)
    rng = random.Random(bits)
    talks = {conv: random_turns(rng, rng.randrange(1, 6)) for conv in range(120)}
    rows = [(conv, turn, role, text) for conv, turns in talks.items() for turn, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found, turns = conversation_repair.repair(frame)
    told = {int(r.conv[1:]): r for r in found.collect()}
    digests = {int(r.conv[1:]): r.repaired_sha256 for r in conversation_repair.digests(turns).collect()}
    mended = {}
    for r in sorted(turns.collect(), key=lambda r: (r.key, r.place)):
        mended.setdefault(int(r.conv[1:]), []).append((r.role, r.text))
    for conv, given in talks.items():
        cost, audit, out = cheapest(given)
        assert (told[conv].cost, told[conv].audit, tuple(mended.get(conv, ()))) == (cost, audit, out), given
        assert (told[conv].blank, told[conv].duplicate, told[conv].truncated, told[conv].illegal) == figures(given)
        empty = hashlib.sha256(b"").hexdigest()
        assert digests.get(conv, empty) == hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()


def plain_repair(symbols):
    """Cost and audit without chunks."""
    costs, gain = run_back(symbols, END)
    return gain + costs[0], trace(symbols, END, 0, True)[0]


def test_long_conversations_by_chunks(spark, monkeypatch):
    """Alternating, stuck and random conversations of many chunks, one with a third of all rows."""
    monkeypatch.setattr(conversation_repair, "CHUNK_BITS", 3)
    rng = random.Random(4)
    talks = {
        0: [("user" if at % 2 == 0 else "assistant", f"text {at}.") for at in range(301)],
        1: [("assistant" if at % 2 == 0 else "user", f"text {at}.") for at in range(300)],
        2: [("system", f"text {at}") for at in range(200)],
        3: [(rng.choice(["user", "assistant", "system"]), f"text {at}" + rng.choice([".", "", "?"])) for at in range(900)],
        4: [("tool", "same.")] * 50 + [("user", "")] * 50,
    }
    rows = [(conv, turn, role, text) for conv, turns in talks.items() for turn, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    found, turns = conversation_repair.repair(frame)
    for r in found.collect():
        given = talks[int(r.conv[1:])]
        marks = [
            "x" if fault in ("blank", "duplicate") else (initial if initial in "sua" else "o").upper() if fault else (initial if initial in "sua" else "o")
            for fault, initial in zip(faults(given), (role[0] for role, _ in given), strict=True)
        ]
        assert (r.cost, r.audit) == plain_repair("".join(marks))
        assert (r.blank, r.duplicate, r.truncated, r.illegal) == figures(given) and r.gaps == 0
        assert r.cost == sum(COSTS[letter] for letter in r.audit) + 3 * sum(mark.isupper() and letter in "KR" for mark, letter in zip(marks, r.audit.replace("I", ""), strict=True))
    for r in turns.groupBy("conv").count().collect():
        assert r["count"] <= 1000


def test_fix_up_equals_a_new_run():
    rng = random.Random(9)
    for _ in range(300):
        symbols = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(12)))
        old, new = GUESS, tuple(rng.randrange(9) for _ in range(4))
        assert fix_up(symbols, old, *run_back(symbols, old), new) == run_back(symbols, new)


def test_turns_after_edits():
    audit, _ = trace("uU", END, 0, True)
    assert repaired_turns(audit, [("user", "a."), ("user", "b")], 0) == [("user", "a."), ("assistant", "b")]


def test_conversations_of_messy_rows(spark):
    schema = "conv_id long, turn long, role string, text string, conv string, key long, at long"
    rows = [
        (None, None, None, None), (None, None, "user", "x."), (None, 3, "user", "x."), (1, 0, "", "no role."), (1, 0, "user", "tie."), (1, 0, "user", "tie."),
        (2, 5, "user", "word " * 100_000 + "."), (2, 9, "assistant", "end."), (3, None, "assistant", " \t"), (-1, 2, "assistant", "alone!"),
    ]
    frame = spark.createDataFrame([(*row, "=1", 0, 0) for row in rows], schema)
    found, turns = conversation_repair.repair(frame)
    told = {r.conv: r for r in found.collect()}
    assert {conv: (r.gaps, r.blank, r.duplicate, r.truncated) for conv, r in told.items()} == {
        "": (0, 1, 1, 0), "=1": (0, 0, 1, 0), "=2": (3, 0, 0, 0), "=3": (0, 1, 0, 0), "=-1": (0, 0, 0, 0),
    }
    assert told["=2"].audit == "KK" and told["=3"].audit == "D" and told["=-1"].audit == "IK"
    assert {r.conv for r in turns.collect()} == {"", "=1", "=2", "=-1"}
    none = spark.createDataFrame([], schema)
    found, turns = conversation_repair.repair(conversation_repair.damaged(none))
    assert found.collect() == [] and turns.collect() == [] and conversation_repair.digests(turns).collect() == []


def test_damage_by_rule(spark):
    rows = [(conv, turn, "assistant", f"Say {turn}. Yes!") for conv in (None, 1, 2) for turn in (None, *range(30))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = Counter()
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else re.sub(r"[.!?]", "", text) if draw == 2 else text
            want[conv, turn, "user" if draw == 4 else role, text] += 2 if draw == 3 else 1
    assert Counter(map(tuple, conversation_repair.damaged(frame).collect())) == want


# Language identification ------------------------------------------------------


def test_held_out_languages(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = queries.QUERIES["op11_language_id"](spark, SMALL).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_held_out_rows_teach_nothing(spark, documents):
    """Other languages and ids of the held-out rows change no prediction."""
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    wrong = documents.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    first, second = ({r.id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()} for docs in (documents, wrong.repartition(3)))
    assert {key: lang for key, (lang, _) in first.items()} == {key: lang for key, (lang, _) in second.items()}
    # Single precision sums differ in their last digits by what is worked on together.
    assert all(score == pytest.approx(second[key][1], abs=1e-4) for key, (_, score) in first.items())


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = language_id.start_network(["a", "b", "c"], rng)
    rows, truth = rng.integers(0, 256, (6, 40), dtype=np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -net.log_chances(rows, net.tables())[np.arange(6), truth].mean()

    for parameter, gradient in zip(net.parameters(), language_id.gradients(net, rows, truth), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = parameter[at], 1e-3
        parameter[at] = kept + step
        above = loss()
        parameter[at] = kept - step
        below = loss()
        parameter[at] = kept
        assert abs((above - below) / (2 * step) - gradient[at]) < 1e-2 * max(1e-2, abs(gradient[at]))


def test_windows_miss_no_run_of_bytes():
    for size in (0, 1, 255, 256, 257, 508, 509, 5000):
        data = bytes(1 + at % 255 for at in range(size)).decode("latin-1").encode("ascii", "replace")
        cut = language_id.windows(data.decode())
        runs = {bytes(row[at : at + 5]) for row in cut for at in range(language_id.WINDOW - 4)}
        assert all(data[at : at + 5] in runs for at in range(size - 4))


def test_languages_of_messy_rows(spark, messy, no_docs):
    from pyspark.sql import functions as F

    labelled = messy.withColumn("lang", F.when(F.col("doc_id") < 6, "en").when(F.col("doc_id") == 7, "fr"))
    found = language_id.identify(labelled).collect()
    assert len(found) == messy.count()
    for text in (None, "", " \t\n "):
        assert language_id.predict([text], language_id.train(labelled)) == [("und", 1.0)]
    assert {r.lang_pred for r in found} <= {"en", "fr", "und"}
    assert {(r.lang_pred, r.score) for r in language_id.identify(messy).collect()} == {("und", 1.0)}
    assert language_id.identify(no_docs).collect() == []


# Filter audit -----------------------------------------------------------------


def plain_audit(docs, labels):
    first, said = {}, {"good": set(), "toxic": set()}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    for doc_id, quality, toxic in labels:
        said["good"] |= {doc_id} if quality == 1 and doc_id is not None else set()
        said["toxic"] |= {doc_id} if toxic == 1 and doc_id is not None else set()
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and doc_id > first[text],
        }
        rows.append((lang or "", {name for name, fail in fails.items() if fail}, doc_id in said["good"], doc_id in said["toxic"]))
    found, shapley = {}, Counter()
    for part in {row[0] for row in rows}:
        own = [row[1:] for row in rows if row[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                here = [row for row in left if name in row[0]]
                before = sum(name in row[0] for row in own) - len(here)
                left = [row for row in left if name not in row[0]]
                shapley[part, name] += len(here)
                found[part, "".join(order), step] = (len(left), len(here), before, sum(row[0] == {name} for row in own), sum(row[1] for row in here), sum(row[2] for row in here))
    return {key: (*value, shapley[key[0], key[1][key[2] - 1]]) for key, value in found.items()}


def audited(frame):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in frame.collect()}


def test_audit_of_messy_rows(spark, messy, no_docs):
    """Repeated rows and ids, nulls, very long texts, labels that repeat or contradict."""
    from pyspark.sql import functions as F

    docs = messy.withColumn("lang", F.when(F.col("doc_id") < 4, "en").when(F.col("doc_id") > 6, "")).withColumn("part", F.lit("x")).withColumn("row", F.lit(1))
    labels = [(1, 1, 0), (1, 0, 1), (3, 1, None), (None, 1, 1), (7, 0, 1), (99, 1, 1)]
    told = spark.createDataFrame([(*label, 5) for label in labels], "doc_id long, quality int, toxic int, good int")
    want = plain_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    assert audited(filter_audit.audit_documents(docs, told)) == want
    none = filter_audit.audit_documents(docs, told.limit(0))
    assert all(r.good_lost == 0 and r.toxic_lost == 0 for r in none.collect())
    assert filter_audit.audit_documents(no_docs, told).collect() == []


def test_audit_equals_brute_force(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    want = plain_audit([(r.doc_id, r.text, r.lang) for r in documents.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert audited(filter_audit.audit_documents(documents, labels)) == want
