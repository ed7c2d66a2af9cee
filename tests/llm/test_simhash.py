from __future__ import annotations

import random
import zlib

import pytest
import xxhash

from quillcast.llm import overlaps, queries, simhash
from quillcast.llm.components import components


def plain_fingerprint(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[at : at + shingle]), 42) for at in range(max(1, len(words) - shingle + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def expected(pairs, groups):
    fps = [plain_fingerprint(text) for _, text in pairs]
    distinct = sorted(set(fps))
    for place, a in enumerate(distinct):
        for b in distinct[:place]:
            if (a ^ b).bit_count() <= 4:
                groups.join(a, b)
    least = {}
    for (doc_id, _), fp in zip(pairs, fps, strict=True):
        root = groups.root(fp)
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted((str(doc_id), f"{fp:016x}", least.get(groups.root(fp))) for (doc_id, _), fp in zip(pairs, fps, strict=True))


def test_query_equals_brute_force(spark, sf_dir, documents, groups):
    pairs = [(row.doc_id, row.text) for row in documents.collect()]
    found = queries.QUERIES["op2_simhash_near_dedup"](spark, sf_dir).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found) == expected(pairs, groups)


def test_messy_rows(messy, groups):
    pairs = [(row.doc_id, row.text) for row in messy.collect()]
    found = simhash.near_duplicates(messy).collect()
    assert sorted((str(r.id), r.fingerprint, r.component_id) for r in found) == expected(pairs, groups)


def test_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.one_of_each(no_docs).collect() == []


def signed(value):
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize("stars", [0, 4])
def test_links_connect_crowds(spark, groups, monkeypatch, stars):
    """A crowd around one value is split into several groups and stays connected."""
    monkeypatch.setattr(simhash, "GROUP_VARIANTS", 60_000)
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << bit for bit in rng.sample(range(64), rng.randrange(9))) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)} | {0, 2**64 - 1}
    frame = spark.createDataFrame([(signed(fp),) for fp in fps], "fp long")
    edges = simhash.links(frame, stars=stars).collect()
    assert all(((e.lo ^ e.hi) & (2**64 - 1)).bit_count() <= 4 for e in edges)
    for e in edges:
        groups.join(signed(e.lo), signed(e.hi))
    got = {fp: groups.root(signed(fp)) for fp in fps}
    truth = type(groups)()
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                truth.join(signed(a), signed(b))
    assert got == {fp: truth.root(signed(fp)) for fp in fps}


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError, match="even"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), radius=3)


def test_components_of_paths_stars_and_circles(spark, groups):
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3), (5, None)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "lo long, hi long")).collect()}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            groups.join(a, b)
    assert found == {node: groups.root(node) for node in groups.parent}
    assert components(spark.createDataFrame([], "lo long, hi long")).collect() == []


@pytest.mark.parametrize("rows", [7, 1000])
def test_components_of_a_known_number_of_edges(spark, groups, monkeypatch, rows):
    """In one task or in many: long paths, stars, circles and repeated edges; binary nodes."""
    monkeypatch.setattr("quillcast.llm.components.KEYS", rows)
    edges = [(n * 37 % 211, (n + 1) * 37 % 211) for n in range(150)] + [(300, n) for n in range(301, 340)] + [(400, 401), (401, 402), (402, 400), (7, 7), (None, 3), (37, 0)]
    edges = [tuple(None if end is None else end.to_bytes(2) for end in edge) for edge in edges]
    table = spark.createDataFrame(edges, "lo binary, hi binary").repartition(5)
    found = {bytes(r.node): bytes(r.root) for r in components(table, len(edges)).collect()}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            groups.join(a, b)
    assert found == {node: groups.root(node) for node in groups.parent}


def test_one_of_each_keeps_least_id_of_similar_texts(spark, documents, messy, groups):
    for docs in (documents, messy):
        pairs = [(row.doc_id, row.text) for row in docs.collect()]
        sets = [simhash.word_shingles(text, 5) for _, text in pairs]
        own = type(groups)()
        for a, left in enumerate(sets):
            for b, right in enumerate(sets[:a]):
                common = len(left & right)
                if common >= 0.8 * (len(left) + len(right) - common):
                    own.join(a, b)
        least = {}
        for place, (doc_id, _) in enumerate(pairs):
            root = own.root(place)
            key = (doc_id is None, doc_id or 0)
            least[root] = min(key, least.get(root, key))
        found = simhash.one_of_each(docs)
        assert found.columns == docs.columns
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect()) == sorted(least.values())


def test_a_crowd_hides_no_text(spark, groups, monkeypatch):
    """Texts on one template, just under the similarity, with some pairs just over it.

    All fingerprints are the same, as in a crowd so dense that every text has the same head.
    """
    monkeypatch.setattr(simhash, "_tables", lambda text, size, seed: [1])
    rng = random.Random(5)
    said = lambda size: [f"w{rng.randrange(10**6)}" for _ in range(size)]
    template = said(120)
    tails = [said(18) for _ in range(60)]
    texts = [" ".join(template + tail) for tail in tails] + [" ".join(template + tail[:9] + said(9)) for tail in tails[:20]]
    sets = [simhash.word_shingles(text, 5) for text in texts]
    for a, left in enumerate(sets):
        for b, right in enumerate(sets[:a]):
            if len(left & right) >= 0.8 * len(left | right):
                groups.join(a, b)
    want = sorted({groups.root(at) for at in range(len(texts))})
    assert len(want) == 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == want


def test_a_chance_collision_contests_no_group(spark):
    """An unlike text that only shares a head's variant leaves the head's group alone."""
    roots = spark.createDataFrame([(b"a", b"a"), (b"b", b"a"), (b"c", b"a")], "node binary, root binary")
    schema = "lo binary, hi binary, far boolean, crowded boolean, within boolean"
    nodes = lambda *failed: {bytes(r.node) for r in overlaps.contested(spark.createDataFrame(list(failed), schema), roots).collect()}
    assert nodes((b"b", b"x", True, False, False)) == set()
    assert nodes((b"b", b"x", True, False, False), (b"b", b"y", True, True, False)) == set()
    assert nodes((b"b", b"x", False, False, False)) == {b"a", b"b", b"c", b"x"}
    assert nodes((b"b", b"x", True, True, False), (b"b", b"y", True, True, False)) == {b"x", b"y"}
    assert nodes((b"b", b"x", True, False, True), (b"a", b"y", True, False, False)) == {b"a", b"b", b"c", b"x", b"y"}
    assert nodes((b"x", b"y", False, False, False)) == set()


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_no_bucket_hides_a_text(spark, groups, monkeypatch, bits):
    """Few fingerprints, all next to zero, for many unlike, distantly alike and similar texts."""
    monkeypatch.setattr(simhash, "_tables", lambda text, size, seed: [1 << zlib.crc32(text.encode()) % bits])
    rng = random.Random(bits)
    said = lambda size: [f"w{rng.randrange(10**6)}" for _ in range(size)]
    texts = []
    for _ in range(40):
        base = said(100)
        texts += [" ".join(base[: 100 - less] + said(less) + [str(rng.randrange(99))]) for less in rng.sample([1, 3, 6, 9, 12, 30, 50], 3)]
    sets = [simhash.word_shingles(text, 5) for text in texts]
    for a, left in enumerate(sets):
        for b, right in enumerate(sets[:a]):
            if len(left & right) >= 0.8 * len(left | right):
                groups.join(a, b)
    want = sorted({groups.root(at) for at in range(len(texts))})
    assert 40 < len(want) < 115
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == want
