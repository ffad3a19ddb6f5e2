import random
import re

import numpy as np
import pytest
import xxhash

from lexmill.llm import simhash
from lexmill.llm.components import connected_components, joined_components

SCHEMA = "doc_id long, text string, fp string, id int, code int, label string"


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def near_rows(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Été", "ß", "A"]
    base = [r.choices(words, k=r.randint(1, 120)) for _ in range(n // 4)]
    rows = []
    for i in range(n):
        text = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 8])):
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((i, r.choice([" ", "\n", "  "]).join(text)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "\t "), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two"), (n + 6, "a b c " * 40_000), (n + 6, "a b c " * 40_000)]


def test_fingerprints():
    for _, text in near_rows(40, 1)[:-2]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint("A b C\x1cd e") == plain_fingerprint("A b C\x1cd e")


@pytest.mark.parametrize("seed", range(3))
def test_groups_against_all_pairs(spark, seed):
    rows = near_rows(160, seed)
    df = spark.createDataFrame([(i, t, "f", 1, 2, "l") for i, t in rows], SCHEMA)
    got = simhash.near_duplicates(df).collect()
    fps = {i: plain_fingerprint(t) for i, t in rows}
    label = plain_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert sorted(tuple(r) for r in got) == sorted((i, f"{fps[i]:016x}", label[i]) for i, _ in rows)


def partition_of(pairs, codes):
    index = {c: i for i, c in enumerate(codes)}
    a = np.array([index[x] for x, _ in pairs], np.int64)
    b = np.array([index[y] for _, y in pairs], np.int64)
    return simhash.merge(np.arange(len(codes)), a, b)


@pytest.mark.parametrize("max_group", [256, 2048])
def test_crowded_bands_lose_no_link(spark, max_group):
    """Thousands of codes around few centres: every band is crowded and has to be cut again."""
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 3, dtype=np.uint64)
    codes = centre[rng.integers(0, 3, 5000)]
    for _ in range(5):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, 5000).astype(np.uint64))
    codes = np.unique(codes)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    sizes = simhash.band_groups(df, 3, max_group).groupBy("key").count().agg({"count": "max"}).first()[0]
    assert sizes <= max_group
    got = [(np.int64(r["a"]).astype(np.uint64), np.int64(r["b"]).astype(np.uint64)) for r in simhash.links(df, 3, max_group).collect()]
    all_a, all_b = [], []
    for i in range(0, len(codes), 500):
        x, y = np.nonzero(np.bitwise_count(codes[i : i + 500, None] ^ codes[None, :]) <= 3)
        all_a.append(x + i)
        all_b.append(y)
    want = simhash.merge(np.arange(len(codes)), np.concatenate(all_a), np.concatenate(all_b))
    assert np.array_equal(partition_of(got, codes.tolist()), want)


@pytest.mark.parametrize("rows", ["1", "3", "1000"])
def test_groups_that_go_on_over_batches(spark, rows):
    """With few rows a batch, most batches have rows of one group only."""
    rng = np.random.default_rng(6)
    codes = np.unique(np.concatenate([c ^ (np.uint64(1) << np.arange(20, dtype=np.uint64)) for c in rng.integers(0, 2**63, 5, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, rows)
    try:
        got = [(np.int64(r["a"]).astype(np.uint64), np.int64(r["b"]).astype(np.uint64)) for r in simhash.links(df).collect()]
    finally:
        spark.conf.set(conf, before)
    x, y = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3)
    assert np.array_equal(partition_of(got, codes.tolist()), simhash.merge(np.arange(len(codes)), x, y))


def test_links_of_no_rows():
    none = np.zeros(0, np.int64)
    a, b = simhash.group_links(none, none.view(np.uint64), 3)
    assert len(a) == len(b) == 0


def test_index_prunes_and_finds(spark):
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 2**40, 3000, dtype=np.uint64))
    order = np.argsort(simhash.gray_rank(codes))
    codes = codes[order]
    levels = simhash.build_index(np.zeros(len(codes), np.int64), codes)
    assert len(levels) > 3 and len(levels[-1]["pattern"]) == 1
    a, b = simhash.close_pairs(levels, np.arange(len(codes)), np.zeros(len(codes), np.int64), 6)
    x, y = np.nonzero(np.tril(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 6, -1))
    assert sorted(zip(a, b, strict=True)) == sorted(zip(x, y, strict=True))


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(400)] + [(1000, 2000 + i) for i in range(300)] + [(5000 + r.randrange(200), 5000 + r.randrange(200)) for _ in range(90)]
    r.shuffle(edges)
    df = spark.createDataFrame(edges + edges[:9], "a long, b long")
    got = {r["v"]: r["label"] for r in connected_components(df).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    assert got == {n: x for n, x in label.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_rows_that_stay(spark):
    rows = near_rows(80, 5) + [(None, "lonely text without id"), (None, "lonely text without id")]
    df = spark.createDataFrame([(i, t, "f", 1, 2, "l") for i, t in rows], SCHEMA)
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    kept = simhash.deduplicate(df)
    assert kept.schema == df.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, _ in rows if i is not None and groups[i] == i)
    assert ids.count(None) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).count() == 0 and simhash.deduplicate(df).count() == 0


def test_components_joined_by_further_edges(spark):
    """Old components and vertices that are new, in any order; only edges between components count."""
    first = [(5, 6), (6, 7), (20, 21), (30, 31), (31, 32)]
    more = [(7, 5), (21, 32), (40, 41), (41, 2), (32, 50)]
    labels = connected_components(spark.createDataFrame(first, "a long, b long"))
    got = {r["v"]: r["label"] for r in joined_components(labels, spark.createDataFrame(more, "a long, b long")).collect()}
    assert got == {5: 5, 6: 5, 7: 5, 20: 20, 21: 20, 30: 20, 31: 20, 32: 20, 50: 20, 40: 2, 41: 2, 2: 2}
