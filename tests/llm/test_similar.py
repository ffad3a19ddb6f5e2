import random

import pytest

import corpus_pipeline
from lexmill.llm import similar, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sets_of(rows):
    out = {}
    for i, text in rows:
        words = text.lower().split()
        width = min(5, len(words))
        out[i] = {tuple(words[a : a + width]) for a in range(len(words) - width + 1)}
    return out


def near(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def plain_heads(sets):
    label = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and near(sets[i], sets[j])]
    while True:
        before = dict(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            return label


def near_rows(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, line = [], r.choices(vocabulary, k=30)
    for base in range(25):
        words = r.choices(vocabulary, k=r.randint(3, 150))
        for _ in range(r.randint(1, 4) if base else 90):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += [" ".join([*line, *r.choices(vocabulary, k=r.randint(2, 12))]) for _ in range(90)]
    r.shuffle(rows)
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(
    ("seed", "long_list", "hot", "block"), [(0, 64, 64, 8192), (1, 5, 64, 8192), (2, 1000, 64, 8192), (4, 5, 64, 7), (5, 8, 4, 16)]
)
def test_all_similar_pairs_are_linked(spark, seed, long_list, hot, block):
    rows = near_rows(seed)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r["component_id"] for r in similar.similar_documents(df, long_list=long_list, hot=hot, block=block).collect()}
    assert got == plain_heads(sets_of(rows))


@pytest.mark.parametrize("batch", ["1", "4"])
def test_groups_that_go_on_over_batches(spark, batch):
    """The stage of the pipeline keeps smaller batches than its own; lists and bands then reach over many of them."""
    rows = near_rows(3)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, batch)
    try:
        kept = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect())
    finally:
        spark.conf.set(conf, before)
    assert kept == sorted(set(plain_heads(sets_of(rows)).values()))


def chain_rows(count):
    """Texts that all share runs, of which only neighbours are similar: no centre is near all of them."""
    words = [f"w{i}" for i in range(60 + 2 * count)]
    return [(i + 1, " ".join([*words[2 * i : 2 * i + 60], "every", "one", "ends", "like", "this"])) for i in range(count)]


@pytest.mark.parametrize("block", [3, 8192])
def test_pairs_far_from_the_centres_of_a_long_list(spark, block):
    rows = chain_rows(150)
    rows = [rows[(i * 37) % 150] for i in range(150)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r["component_id"] for r in similar.similar_documents(df, long_list=4, hot=4, block=block).collect()}
    assert got == plain_heads(sets_of(rows)) == dict.fromkeys(got, 1)


def test_dealt_members_hold_every_possible_pair(spark):
    """Each pair of a list that can be similar with different labels meets in exactly one pair of blocks."""
    r = random.Random(7)
    rows = [(1, i, n := r.randint(1, 40), r.randint(0, n - 1) // 3, r.randint(0, 3)) for i in range(200)]
    members = spark.createDataFrame(rows, "run long, code long, n int, at int, label long")
    got = sorted(map(tuple, similar.other_pairs(members, (4, 5), block=11).collect()))
    wanted = [
        (a[1], b[1])
        for a in rows
        for b in rows
        if a[1] < b[1] and a[4] != b[4] and 9 * min(a[2] - a[3], b[2] - b[3]) >= 4 * (a[2] + b[2])
    ]
    assert got == sorted(wanted)


def test_a_long_list_without_possible_pairs_is_dropped(spark):
    """30 common words and 5 of their own: the common runs come too late to be the first shared ones."""
    rows = [(run, code, 31, 5, code) for run in (1, 2) for code in range(5000)]
    members = spark.createDataFrame(rows, "run long, code long, n int, at int, label long")
    assert similar.dealt_members(members, (4, 5), 64).isEmpty()


def test_pipeline_stage_keeps_no_near_copy(spark, tmp_path):
    """Copies that differ in more than three bits of a fingerprint of three-word runs go too."""
    rows = near_rows(3)
    sets, fps = sets_of(rows), {i: simhash.fingerprint(t) for i, t in rows}
    assert any(near(sets[i], sets[j]) and (fps[i] ^ fps[j]).bit_count() > 3 for i in sets for j in sets if i < j)
    df = spark.createDataFrame([*[(i, t, "en", "s", 1) for i, t in rows], (None, rows[0][1], "en", "s", 1)], SCHEMA)
    kept = corpus_pipeline.near_dedup(spark, df, str(tmp_path))
    assert kept.schema == df.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(plain_heads(sets).values())) and ids.count(None) == 1


def test_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert similar.similar_documents(df).count() == 0 and similar.deduplicate(df).count() == 0


def test_members_meet_with_their_sketches(spark):
    """A long list of sets that only share its run puts out no pair, but keeps the similar ones."""
    r = random.Random(3)
    texts = [" ".join(r.choices([f"w{i}" for i in range(5000)], k=40)) for _ in range(200)]
    texts += [t + " end" for t in texts[:5]]
    found = [similar.runs(t) for t in texts]
    rows = [(1, i, len(f), 0, i, similar.sketch(f)) for i, f in enumerate(found)]
    members = spark.createDataFrame(rows, "run long, code long, n int, at int, label long, sketch binary")
    assert similar.other_pairs(members.drop("sketch"), (4, 5)).count() > 10_000
    assert sorted(map(tuple, similar.other_pairs(members, (4, 5)).collect())) == [(i, 200 + i) for i in range(5)]


def test_index_pairs_are_those_of_the_fingerprints(spark):
    """The SimHash index finds every pair within its limit, by way of others, and sets with equal fingerprints."""
    found = [similar.runs(t) for _, t in near_rows(6)]
    codes = {similar.code_of(f): simhash.fingerprint_of(f) for f in found}
    assert all(simhash.fingerprint_of(similar.runs(t)) == simhash.fingerprint(t, 5) for t in ("a b c d e f g", "x y", ""))
    df = spark.createDataFrame([(c, fp - (1 << 64) * (fp >> 63)) for c, fp in codes.items()], "code long, fp long")
    got = dict.fromkeys(map(tuple, similar.index_pairs(df, 3).collect()))
    label = {c: c for c in codes}
    wanted = dict(label)
    for labels, links in ((label, got), (wanted, [(a, b) for a in codes for b in codes if a < b and (codes[a] ^ codes[b]).bit_count() <= 3])):
        for _ in codes:
            for a, b in links:
                labels[a] = labels[b] = min(labels[a], labels[b])
    assert got and label == wanted


def test_a_group_of_near_copies_is_joined_without_all_its_pairs(spark, monkeypatch):
    """Twice the group gives about twice the pairs that are checked, not four times, and the same component."""
    pairs_in = []
    plain = similar.checked
    monkeypatch.setattr(similar, "checked", lambda pairs, *rest: pairs_in.append(pairs.count()) or plain(pairs, *rest))

    def pairs_of(size):
        r = random.Random(size)
        base = r.choices([f"w{i}" for i in range(3000)], k=200)
        rows = []
        for i in range(size):
            copy = list(base)
            for place in r.sample(range(200), r.randint(2, 4)):
                copy[place] = f"own{i}x{place}"
            rows.append((i, " ".join(copy)))
        pairs_in.clear()
        df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
        got = {r["doc_id"]: r["component_id"] for r in similar.similar_documents(df, long_list=8, hot=8).collect()}
        assert got == plain_heads(sets_of(rows))
        return sum(pairs_in)

    assert pairs_of(400) < 3 * pairs_of(200)
