from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

from quillcast.llm import common, decontamination, line_dedup, overlaps, quality_rules, queries


def line_classes(pairs, groups):
    lines = {}
    for doc_id, text in pairs:
        for at, line in enumerate((text or "").split("\n") if text is not None else ()):
            if re.search(r"[^\x20\x09-\x0D]", line):
                lines[doc_id, at] = line
    texts = sorted(set(lines.values()))
    sets = [line_dedup.shingles(text, 8) for text in texts]
    for a, left in enumerate(sets):
        for b, right in enumerate(sets[:a]):
            if line_dedup.jaccard(left, right) >= 0.8:
                groups.join(a, b)
    place = {text: at for at, text in enumerate(texts)}
    first = {}
    for key in sorted(lines, key=lambda key: (key[0] is not None, key[0] or 0, key[1])):
        first.setdefault(groups.root(place[lines[key]]), key)
    return {key: first[groups.root(place[line])] for key, line in lines.items()}


def test_line_classes_equal_brute_force(spark, sf_dir, documents, groups):
    want = line_classes([(r.doc_id, r.text) for r in documents.collect()], groups)
    found = queries.QUERIES["op8_fuzzy_line_dedup"](spark, sf_dir).collect()
    assert {(r.doc_id, r.line): (r.class_doc, r.class_line) for r in found} == want
    assert all(r.kept == ((r.doc_id, r.line) == (r.class_doc, r.class_line)) for r in found)


def test_a_star_hides_no_link(spark, groups):
    """Chains of lines whose ends are too far apart to link to one leader."""
    words = [f"token{n:03d}" for n in range(400)]
    texts = [" ".join(words[shift : shift + 60]) for shift in range(0, 60, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = line_classes(list(enumerate(texts)), groups)
    found = line_dedup.classes(docs).collect()
    assert {(r.doc, r.line): (r.class_doc, r.class_line) for r in found} == want


def some_lines(n):
    rng = random.Random(5)
    for alphabet in ("ab", "ab \xff\0", "ab\u0101\U0001f600", "abcdefgh "):
        for _ in range(n):
            line = "".join(rng.choices(alphabet, k=rng.randint(1, 40)))
            at = rng.randrange(len(line))
            yield line, line[:at] + rng.choice(alphabet) + line[at + rng.randint(0, 1) :]


def test_packed_shingles_are_the_sets_of_shingles():
    kinds = set()
    for a, b in some_lines(500):
        left, right = line_dedup.packed(a, 8), line_dedup.packed(b, 8)
        assert (left is None) == (len(a) < 8 or max(a) > "\xff")
        if left is not None and right is not None:
            assert len(left) == len(line_dedup.shingles(a, 8))
            similarity = line_dedup.jaccard(line_dedup.shingles(a, 8), line_dedup.shingles(b, 8))
            for bound in (0.5, 0.8, similarity):
                assert line_dedup.similar(left, right, bound) == (similarity >= bound)
            kinds.add(similarity >= 0.8)
    assert kinds == {True, False}


def test_shingle_hashes_are_the_same_in_every_line():
    for a, b in some_lines(300):
        for other in (b, b + "\u0101", a + "\U0001f600" + b):
            found, more = (set(line_dedup.hashed(line, 8).tolist()) for line in (a, other))
            sets = line_dedup.shingles(a, 8), line_dedup.shingles(other, 8)
            assert (len(found), len(more), len(found & more)) == (len(sets[0]), len(sets[1]), len(sets[0] & sets[1]))


def test_lines_beyond_one_byte_a_character(spark, groups):
    words = [f"t\u00e9ken{n:03d}" for n in range(400)]
    texts = [" ".join(words[shift : shift + 60]) + ("\u0142" * (shift // 2 % 3 == 0)) for shift in range(0, 60, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = line_dedup.classes(docs).collect()
    assert {(r.doc, r.line): (r.class_doc, r.class_line) for r in found} == line_classes(list(enumerate(texts)), groups)


def test_lines_of_messy_rows(spark, no_docs, groups):
    line = "a line that is said more than once in these documents"
    pairs = [(2, f"{line}\n\nother words here\n{line}!"), (1, f"{line}\nshort\nshort"), (None, "short"), (3, None), (4, ""), (4, " \n\t")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in pairs], "doc_id long, text string, doc string, line int")
    found = line_dedup.classes(docs).collect()
    assert {(r.doc, r.line): (r.class_doc, r.class_line) for r in found} == line_classes(pairs, groups)
    rest = line_dedup.deduplicated(docs)
    assert rest.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in rest.collect()) == sorted(
        [("2", "\nother words here"), ("1", line), ("None", "short"), ("3", "None"), ("4", ""), ("4", " \n\t")]
    )
    assert line_dedup.classes(no_docs).collect() == []
    assert line_dedup.deduplicated(no_docs).collect() == []


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {at + k for at in range(len(words) - 2) if windows[tuple(words[at : at + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_equal_brute_force(documents, messy):
    for docs in (documents, messy):
        want = Counter((str(r.doc_id), *plain_measures(r.text)) for r in docs.collect())
        found = Counter((str(r.id), *(r[name] for name in NAMES)) for r in quality_rules.measures(docs).collect())
        assert found == want


def test_votes_keep_good_documents(spark, sf_dir):
    judged = {r.doc_id: r for r in queries.QUERIES["op4_quality_votes"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    for r in judged.values():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    good = [judged[r.doc_id] for r in labels if r.quality == 1 and not judged[r.doc_id].base_failed]
    bad = [judged[r.doc_id] for r in labels if r.quality == 0]
    assert all(r.kept for r in good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_expectation_maximisation_equals_plain_rounds(spark):
    """The aggregated rounds against the same rounds over single documents."""
    rows = [(1, 1, 0)] * 60 + [(1, -1, 1)] * 3 + [(-1, -1, 0)] * 20 + [(-1, 0, -1)] * 9 + [(0, 0, 0)] * 4
    names = ["vote_a", "vote_b", "vote_c"]
    patterns = spark.createDataFrame([(*row, float(n)) for row, n in Counter(rows).items()], "vote_a int, vote_b int, vote_c int, n double")
    model = quality_rules.fit(patterns, names, rounds=8, tolerance=0)
    chance = [0.95 if -1 not in row else 0.1 for row in rows]
    for _ in range(8):
        good, n, s = sum(chance), len(rows), quality_rules.SMOOTHING
        prior = (good + s) / (n + 2 * s)
        table = [
            [{o: (sum(w for row, w in zip(rows, weights, strict=True) if row[j] == o) + s) / (sum(weights) + 3 * s) for o in (1, -1, 0)} for j in range(3)]
            for weights in (chance, [1 - p for p in chance])
        ]
        new = []
        for row in rows:
            odds = prior / (1 - prior)
            for j in range(3):
                odds *= table[0][j][row[j]] / table[1][j][row[j]]
            new.append(odds / (1 + odds))
        chance = new
    assert model.prior == pytest.approx(prior)
    assert set(model.accuracies()) == set(names)
    got = {tuple(r[:3]): r.p for r in patterns.select(*names, model.posterior().alias("p")).collect()}
    assert all(got[row] == pytest.approx(p) for row, p in zip(rows, chance, strict=True))


def test_rules_without_rows(no_docs):
    assert quality_rules.judge(no_docs).collect() == []


def test_rules_run_no_python(spark, sf_dir):
    for name in ("op4_quality_votes", "op9_benchmark_decontamination"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


def test_decontamination_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    name = "op9_benchmark_decontamination"
    found = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert found["contaminated"].any()
    assert difference(found, connect(sf_dir).sql(queries.ORACLES[name]).df()) is None


def test_decontamination_shuffles_no_documents_per_word(spark, sf_dir, monkeypatch):
    """Without broadcasts too, rows per word carry hashes only, and the rows are the same."""
    name, plans = "op9_benchmark_decontamination", {}
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    write = decontamination.written

    def spied(frame, label):
        plans[label] = frame._jdf.queryExecution().explainString(mode)
        return write(frame, label)

    want = Counter(queries.QUERIES[name](spark, sf_dir).collect())
    monkeypatch.setattr(decontamination, "written", spied)
    monkeypatch.setattr(common, "BROADCAST_KEYS", -1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert Counter(queries.QUERIES[name](spark, sf_dir).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for label in ("places", "placed", "hits"):
        moved = re.findall(r"\) (?:Exchange|Sort)\nInput \[\d+\]: \[(.*)\]", plans[label])
        assert moved and not any(re.search(r"(?<!window_)words#", columns) for columns in moved)


def plain_hits(text, items, size=10):
    def split(value):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in value or ""))

    words, covered, found = split(text), set(), set()
    for item, value in items:
        item_words = split(value)
        if item is None or not item_words:
            continue
        for at in range(max(1, len(item_words) - size + 1)):
            window = item_words[at : at + size]
            for place in range(len(words) - len(window) + 1):
                if words[place : place + len(window)] == window:
                    covered |= set(range(place, place + len(window)))
                    found.add(str(item))
    return len(words), len(covered), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_decontamination_of_messy_rows(spark, messy, no_docs):
    items = [(1, "quick brown fox"), (1, "quick brown fox"), (2, "One!"), (3, None), (4, ""), (None, "lazy dog"), (10, "over the lazy dog near the quiet river bank at dawn the quick brown"), (11, "ünïcödé ÄÖ"), (12, "a a a a")]
    benchmark = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc int, words int")
    want = Counter((str(r.doc_id), *plain_hits(r.text, items)) for r in messy.collect())
    found = decontamination.decontaminate(messy, benchmark).collect()
    assert Counter((str(r.id), r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in found) == want
    assert all(r.contaminated == (r.n_hit > 0) for r in found)
    kept = decontamination.clean(messy, benchmark)
    assert kept.columns == messy.columns
    assert Counter((str(r.doc_id), r.text) for r in kept.collect()) == Counter(
        (str(r.doc_id), r.text) for r in messy.collect() if not plain_hits(r.text, items)[1]
    )
    assert decontamination.decontaminate(no_docs, benchmark).collect() == []
    assert decontamination.clean(no_docs, benchmark).collect() == []
    clean = decontamination.decontaminate(messy, benchmark.where(F.lit(False)))
    assert clean.count() == messy.count() and not clean.where("contaminated").head(1)


def test_a_crowd_hides_no_line(spark, groups):
    """Hundreds of lines on one template, just under the similarity, with some pairs just over it."""
    rng = random.Random(11)
    said = lambda size: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size))
    template = said(300)
    tails = [said(52) for _ in range(500)]
    texts = [template + tail for tail in tails] + [template + tail[:26] + said(26) for tail in tails[:100]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = line_classes(list(enumerate(texts)), groups)
    assert sum(key != first for key, first in want.items()) >= 95
    assert {(r.doc, r.line): (r.class_doc, r.class_line) for r in line_dedup.classes(docs).collect()} == want


def test_few_lines_take_few_tasks(spark, groups):
    """A chain of lines, linked late: a table of some rows is not worked on by as many tasks as a shuffle has partitions."""
    words = [f"token{n:03d}" for n in range(400)]
    texts = [" ".join(words[shift : shift + 60]) for shift in range(0, 60, 2)]
    want = line_classes(list(enumerate(texts)), groups)
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    conf = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        context.setJobGroup("few-tasks", "lines of a chain")
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {(r.doc, r.line): (r.class_doc, r.class_line) for r in line_dedup.classes(docs).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found == want
    stages = {stage for job in tracker.getJobIdsForGroup("few-tasks") for stage in tracker.getJobInfo(job).stageIds}
    tasks = sum(info.numCompletedTasks for stage in stages if (info := tracker.getStageInfo(stage)))
    assert 0 < tasks < 1000, tasks


def test_rows_that_share_an_id_lose_only_their_own_lines(spark):
    """Each distinct line of rows under one id, a null one too, stays exactly once."""
    for shared in (None, 7):
        texts = ["p\nq", "r\np", "s\nt", "p\nu", "s\nv", "same line\nw", "same line\nx"]
        docs = spark.createDataFrame([(shared, text) for text in texts] + [(9, "q\ny")], "doc_id long, text string")
        kept = [line for r in line_dedup.deduplicated(docs).collect() for line in r.text.split("\n") if line]
        assert sorted(kept) == sorted({line for text in [*texts, "y"] for line in text.split("\n")})


def test_a_text_of_many_lines_loses_many(spark):
    docs = spark.createDataFrame([(1, "the same line here\n\n" * 30_000 + "and the last one"), (2, "a line of its own\n"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    assert found == {1: "the same line here\n" + "\n" * 30_000 + "and the last one", 2: "a line of its own\n", 3: None}


# Members of buckets, many in one row


def by_part(batches):
    rows = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda row: row["part"])
    return [pa.RecordBatch.from_pylist(rows[at : at + 3], schema=pa.schema([("part", pa.int32()), ("members", pa.binary())])) for at in range(0, len(rows), 3)]


@pytest.mark.parametrize("small", [False, True])
def test_every_member_of_a_bucket_is_linked(monkeypatch, groups, small):
    if small:
        monkeypatch.setattr(common, "GATHERED", 2_000)
        monkeypatch.setattr(common, "HELD", 1_000)
        monkeypatch.setattr(line_dedup, "BLOCK", 4)
    chance = random.Random(5)
    near = ["".join(chance.choices("abcdefgh ", k=300)) for _ in range(6)]
    lines = near + [line[:at] + "#" + line[at + 1 :] for line in near for at in range(5, 295, 9)] + ["".join(chance.choices("xyz", k=60)) for _ in range(300)]
    keys = [int.from_bytes(hashlib.md5(line.encode()).digest()[:8], "little", signed=True) for line in lines]
    given = [pa.RecordBatch.from_pydict({"key": keys[at : at + 100], "text": lines[at : at + 100]}) for at in range(0, len(lines), 100)] * 2
    rows = list(line_dedup._bucketed(8, 4)(iter(given)))
    assert sum(batch.num_rows for batch in rows) <= (14 * 2 * len(lines) if small else 16)
    for batch in line_dedup._candidates(iter(by_part(rows))):
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            assert a < b
            groups.join(a, b)
    hashes = line_dedup.band_hashes(lines, 8)
    for band in range(line_dedup.BANDS):
        for value in set(hashes[:, band].tolist()):
            assert len({groups.root(keys[at]) for at in np.flatnonzero(hashes[:, band] == value)}) == 1
    assert len({groups.root(key) for key in keys}) > 200


@pytest.mark.parametrize("crowd", [2, 2_000])
def test_search_by_parts_finds_all_similar(monkeypatch, crowd):
    monkeypatch.setattr(overlaps, "CROWD", crowd)
    monkeypatch.setattr(common, "GATHERED", 20_000)
    monkeypatch.setattr(common, "HELD", 10_000)
    chance = random.Random(6)
    near = ["".join(chance.choices("abcdefgh ", k=chance.randrange(60, 200))) for _ in range(15)]
    texts = near + [text[:at] + "#" + text[at + 1 :] for text in near for at in (0, 1, 20, 40, len(text) - 1)]
    nodes = [hashlib.md5(text.encode()).digest() for text in texts]
    roots = [chance.choice(nodes) if at % 3 else node for at, node in enumerate(nodes)]
    given = pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()), "root": pa.array(roots, pa.binary()), "text": texts})
    weights = np.full(overlaps.BUCKETS, 2, dtype=np.int32)
    rows = by_part(overlaps._prefixes(lambda text: line_dedup.hashed(text, 8), 0.8, weights, 4)(iter([given])))
    found, crowds = set(), {}
    for batch in overlaps._searched(0.8)(iter(rows)):
        for row in batch.to_pylist():
            if row["key"] is None:
                assert row["lo"] < row["hi"]
                found.add((row["lo"], row["hi"]))
            else:
                crowds.setdefault(row["key"], []).append(row)
    # The join's share of the work.
    assert bool(crowds) == (crowd == 2)
    found |= {(a["node"], b["node"]) for some in crowds.values() for a in some for b in some if a["node"] < b["node"] and a["root"] != b["root"]}
    root, sets = dict(zip(nodes, roots, strict=True)), {node: line_dedup.shingles(text, 8) for node, text in zip(nodes, texts, strict=True)}
    similar = {(a, b) for a in nodes for b in nodes if a < b and root[a] != root[b] and line_dedup.jaccard(sets[a], sets[b]) >= 0.8}
    assert len(similar) > 20 and similar <= found
    assert all(root[a] != root[b] for a, b in found)


def test_search_of_a_crowded_shingle(spark):
    schema = "node binary, root binary, text string"
    for many in (20, 2_100):
        rows = [(hashlib.md5(str(at).encode()).digest(), hashlib.md5(str(max(0, at - many + 4)).encode()).digest(), "a b c d e") for at in range(many)]
        found = overlaps.close(spark.createDataFrame(rows, schema), lambda text: set(text.split()), 0.8).collect()
        # The last three are of other roots.
        want = {tuple(sorted((a[0], b[0]))) for a in rows for b in rows[-3:] if a[1] != b[1]}
        assert len(found) == len(want) and {(bytes(r.lo), bytes(r.hi)) for r in found} == want


def test_search_passes_by_long_texts_that_are_not_alike(spark):
    chance = random.Random(8)
    words = [f"w{at}" for at in range(20_000)]
    texts = [chance.sample(words, chance.randrange(900, 1_100)) for _ in range(60)]
    # One word in ten is another: similar to 0.8 and more.
    texts.append([f"x{at}" if at % 10 == 0 else word for at, word in enumerate(texts[0])])
    rows = [(digest := hashlib.md5(str(at).encode()).digest(), digest, " ".join(text)) for at, text in enumerate(texts)]
    found = overlaps.close(spark.createDataFrame(rows, "node binary, root binary, text string"), lambda text: set(text.split()), 0.8).collect()
    assert {(bytes(r.lo), bytes(r.hi)) for r in found} == {tuple(sorted((rows[0][0], rows[-1][0])))}
