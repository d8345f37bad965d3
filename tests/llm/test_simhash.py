import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from refsync.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []


def plain_print(text, k=4):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, k)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, max_bits=4):
    """Component of every row of (id, fingerprint): the smallest id reachable."""
    values = sorted({p for _, p in prints})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[find(p)] = min(doc_id, least.get(find(p), doc_id))
    return sorted(((i, f"{p:016x}", least.get(find(p))) for i, p in prints), key=repr)


def check(df, **options):
    prints = [(r.doc_id, plain_print(r.text)) for r in df.collect()]
    found = simhash.near_duplicates(df, **options).collect()
    assert sorted(map(tuple, found), key=repr) == plain_components(prints)


def test_awkward_documents(spark, awkward):
    check(awkward)


def test_real_documents(spark, sample):
    check(sample)


def test_empty_table(spark, nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.one_of_each(nothing).collect() == []


def groups(seed, count=40, size=30):
    """Fingerprints in clusters, chains among them, and unrelated ones."""
    draw = random.Random(seed)
    out = set()
    for _ in range(count):
        value = draw.getrandbits(64)
        for _ in range(draw.randint(1, size)):
            out.add(value)
            near = value
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                near ^= 1 << bit
            if draw.random() < 0.5:
                value = near
            out.add(near)
    return sorted(out)


def linked(spark, values, bucket):
    nodes = spark.createDataFrame(
        [(int(np.uint64(v).astype(np.int64)),) for v in values], "node long"
    )
    pairs = simhash.links(nodes, ["node"], 4, bucket=bucket)
    found = simhash.components(pairs).collect()
    root = {r.node % (1 << 64): r.root % (1 << 64) for r in found}
    classes = defaultdict(set)
    for v in values:
        classes[root.get(v, v)].add(v)
    return sorted(map(sorted, classes.values()))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 8])
def test_links_and_components_against_all_pairs(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 500)
    values = groups(5)
    expected = defaultdict(set)
    for (_, text, least), v in zip(
        sorted(plain_components([(v, v) for v in values])), sorted(values, key=lambda v: repr((v, f"{v:016x}")))
    ):
        expected[least].add(int(text, 16))
    assert linked(spark, values, bucket) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("short, square, tile", [(16, 512, 1024), (2, 3, 7), (2, 512, 1024)])
def test_runs_of_every_length(monkeypatch, short, square, tile):
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    monkeypatch.setattr(simhash, "SQUARE_RUN", square)
    monkeypatch.setattr(simhash, "TILE", tile)
    values = np.array(groups(7, 12, 12), np.uint64)
    keys = np.sort(np.random.default_rng(1).integers(0, 4, len(values)))
    a, b = simhash.close_pairs(keys, values, 4)
    assert (keys[a] == keys[b]).all()
    roots = simhash.merged(np.arange(len(values)), a, b)
    x, y = np.nonzero(
        (np.bitwise_count(values[:, None] ^ values) <= 4) & (keys[:, None] == keys)
    )
    assert (roots == simhash.merged(np.arange(len(values)), x, y)).all()


@pytest.mark.parametrize("short, square", [(16, 512), (2, 512), (2, 3)])
def test_all_pairs_of_different_labels(monkeypatch, short, square):
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    monkeypatch.setattr(simhash, "SQUARE_RUN", square)
    monkeypatch.setattr(simhash, "TILE", 7)
    values = np.array(groups(9, 12, 12), np.uint64)
    draw = np.random.default_rng(2)
    keys, labels = np.sort(draw.integers(0, 4, len(values))), draw.integers(0, 5, len(values))
    a, b = simhash.close_pairs(keys, values, 4, labels, pairs="all")
    near = (np.bitwise_count(values[:, None] ^ values) <= 4) & (keys[:, None] == keys)
    near &= labels[:, None] != labels
    assert set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())) == set(
        zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1))))
    )


@pytest.mark.parametrize("short, square", [(16, 512), (2, 512), (2, 3)])
def test_few_pairs_connect_what_labels_leave_apart(monkeypatch, short, square):
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    monkeypatch.setattr(simhash, "SQUARE_RUN", square)
    monkeypatch.setattr(simhash, "TILE", 7)
    values = np.array(groups(9, 12, 12), np.uint64)
    keys = np.zeros(len(values), np.int64)
    near = np.bitwise_count(values[:, None] ^ values) <= 4
    x, y = np.nonzero(near)
    tight = np.bitwise_count(values[x] ^ values[y]) <= 2
    labels = simhash.merged(np.arange(len(values)), x[tight], y[tight])
    a, b = simhash.close_pairs(keys, values, 4, labels)
    assert (labels[a] != labels[b]).all()
    assert (
        simhash.merged(labels, np.concatenate([a, b]), np.concatenate([b, a]))
        == simhash.merged(np.arange(len(values)), x, y)
    ).all()


@pytest.mark.parametrize("short, square", [(16, 512), (2, 512), (2, 3)])
@pytest.mark.parametrize("pairs", ["hubs", "few"])
def test_every_row_near_another_label_is_touched(monkeypatch, short, square, pairs):
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    monkeypatch.setattr(simhash, "SQUARE_RUN", square)
    monkeypatch.setattr(simhash, "TILE", 7)
    values = np.array(groups(9, 12, 12), np.uint64)
    draw = np.random.default_rng(2)
    keys, labels = np.sort(draw.integers(0, 4, len(values))), draw.integers(0, 5, len(values))
    touched = np.zeros(len(values), bool)
    simhash.close_pairs(keys, values, 4, labels, pairs, touched=touched)
    near = (np.bitwise_count(values[:, None] ^ values) <= 4) & (keys[:, None] == keys)
    near &= labels[:, None] != labels
    assert (touched == near.any(axis=1)).all()


def brute_components(texts, words=5, similarity=0.8):
    """The smallest key of every text's component by all pairs of shingle sets."""
    sets = {k: frozenset(simhash.shingle_hashes(t, words).tolist()) for k, t in texts.items()}
    least = {k: k for k in sets}

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {k: root(k) for k in sets}


def family(draw, size, length, edits, start):
    """Copies of a text, each with other words in a few places: near it, less near each other."""
    base = [f"b{start}x{i}" for i in range(length)]
    for number in range(size):
        text = list(base)
        for place in draw.sample(range(length), draw.randrange(*edits)):
            text[place] = f"e{start}x{number}x{place}"
        yield start + number, " ".join(text)


@pytest.mark.parametrize("rows, size", [(4096, 32 << 20), (20, 32 << 20), (4096, 20_000)])
def test_clusters_find_every_link(spark, monkeypatch, rows, size):
    """Groups whose members are connected only here and there equal all pairs of shingles."""
    monkeypatch.setattr(simhash, "CLUSTER_ROWS", rows)
    monkeypatch.setattr(simhash, "CLUSTER_BYTES", size)
    draw = random.Random(rows + size)
    texts = dict(family(draw, 60, 120, (1, 5), 1000))
    texts |= dict(family(draw, 40, 300, (2, 9), 2000))
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    expected = brute_components(texts)
    found = sorted(r.doc_id for r in simhash.one_of_each(docs, max_bits=18).collect())
    assert 2 < len(set(expected.values())) < 90
    assert found == sorted(set(expected.values()))


def test_a_cluster_returns_fewer_links_than_it_has_texts():
    draw = random.Random(8)
    texts = list(family(draw, 300, 200, (1, 4), 0))
    hashed = [simhash.shingle_hashes(t, 5) for _, t in texts]
    rows = [
        (0, i, simhash._signed([simhash.majority(h)])[0].as_py(), np.unique(h).tobytes())
        for i, h in enumerate(hashed)
    ]
    assert 200 < simhash._linked(rows, 64, 0.8).num_rows < 300
    assert simhash._linked(rows, 64, 1.01).num_rows == 0
    same = [(0, 7, *row[2:]) for row in rows]
    assert simhash._linked(same, 64, 0.8).num_rows == 0


@pytest.mark.parametrize("short, square, tile", [(16, 512, 1024), (2, 512, 7), (2, 3, 7)])
@pytest.mark.parametrize("pairs", ["all", "few"])
def test_wide_distances_are_compared_without_a_pass_per_pivot(
    monkeypatch, short, square, tile, pairs
):
    """Pivots let most pairs within ten bits pass, at many times the cost of comparing them."""

    def never(*_):
        raise AssertionError("a pass over all pairs for one pivot")

    monkeypatch.setattr(simhash, "_within", never)
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    monkeypatch.setattr(simhash, "SQUARE_RUN", square)
    monkeypatch.setattr(simhash, "TILE", tile)
    values = np.array(groups(9, 12, 12), np.uint64)
    draw = np.random.default_rng(3)
    keys, labels = np.sort(draw.integers(0, 4, len(values))), draw.integers(0, 5, len(values))
    touched = np.zeros(len(values), bool)
    a, b = simhash.close_pairs(keys, values, 10, labels, pairs, touched=touched)
    near = (np.bitwise_count(values[:, None] ^ values) <= 10) & (keys[:, None] == keys)
    near &= labels[:, None] != labels
    assert near.any() and (touched == near.any(axis=1)).all()
    found = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist()))
    every = set(zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1)))))
    if pairs == "all":
        assert found == every
    else:
        # Together with the labels they connect what all pairs connect.
        least = np.unique(labels, return_index=True)[1][np.unique(labels, return_inverse=True)[1]]
        rows, (x, y) = np.arange(len(values)), zip(*every)
        joined = [
            simhash.merged(rows, np.append(rows, p), np.append(least, q))
            for p, q in ((a, b), (np.array(x), np.array(y)))
        ]
        assert (joined[0] == joined[1]).all()


@pytest.mark.parametrize("chunk", [1, 10, 100_000])
def test_hot_buckets_are_counted_over_tasks_and_batches(spark, monkeypatch, chunk):
    """Tasks send the number of rows of a bucket, not the rows; a cut bucket links all the same."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    draw = random.Random(6)
    base = draw.getrandbits(63)
    nodes = [(base ^ (1 << draw.randrange(20)),) for _ in range(60)]
    nodes = spark.createDataFrame(sorted(set(nodes)), "node long").repartition(3)
    for bucket in (5, 1000):
        ends = simhash.links(nodes, ["node"], 4, bucket=bucket).collect()
        linked_ = plain_groups({n.node for n in nodes.collect()}, ends)
        assert len(linked_) == 1


def plain_groups(names, ends):
    """The groups that links make, by plain union."""
    group = {name: {name} for name in names}
    for a, b in ends:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for name in group[b]:
                group[name] = group[a]
    return {frozenset(g) for g in group.values()}


def test_a_group_of_copies_has_few_pairs():
    draw = random.Random(4)
    base = draw.getrandbits(64)
    values = sorted({base ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(400)})
    a, b = simhash.close_pairs(np.zeros(len(values), np.int64), np.array(values, np.uint64), 4)
    assert len(a) <= 2 * len(values)
    assert len(set(simhash.merged(np.arange(len(values)), a, b))) == 1


def test_one_of_each(spark):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    rows, number = [], 0
    families = []
    for _ in range(12):
        base = [draw.choice(words) for _ in range(300)]
        family = []
        for copy in range(4):
            text = list(base)
            if copy:
                text[draw.randrange(300)] = "changed"
            family.append(number)
            rows.append((number, " ".join(text)))
            number += 1
        families.append(family)
        half = base[:150] + [draw.choice(words) for _ in range(150)]
        rows.append((number, " ".join(half)))
        families.append([number])
        number += 1
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    assert kept == sorted(min(f) for f in families)


def long_pairs(shared):
    """Documents 2 i and 2 i + 1 share ``shared[i]`` of 2,000 words, thus four shingles fewer."""
    for i, same in enumerate(shared):
        start = [f"s{i}x{j}" for j in range(same)]
        for side in "ab":
            text = start + [f"{side}{i}x{j}" for j in range(2000 - same)]
            yield 2 * i + (side == "b"), " ".join(text)


def test_long_texts_are_verified_by_all_shingles(spark):
    # 1,996 shingles each: 1,775 shared are a similarity of 0.8006, and 1,773 one of 0.7990.
    shared = [1779, 1777] * 30 + [1960, 1200]
    docs = spark.createDataFrame(list(long_pairs(shared)), "doc_id long, text string")
    texts = docs.select(simhash.F.col("doc_id").alias("identity"), simhash.F.col("text").alias("body"))
    prints = simhash.fingerprints(docs, {"identity": simhash.F.col("doc_id")}, 5, sketched=True)
    nodes = prints.select("node", simhash.F.struct("identity").alias("first"), "sketch").persist()
    node = {r.first.identity: r.node for r in nodes.select("node", "first").collect()}
    pairs = [(node[2 * i], node[2 * i + 1]) for i in range(len(shared))]
    found = simhash.similar_pairs(
        spark.createDataFrame(pairs, "a long, b long"), nodes, 0.8, texts, 5
    ).collect()
    assert sorted(map(tuple, found)) == sorted(p for p, n in zip(pairs, shared) if n >= 1779)


def test_long_texts_below_the_similarity_all_stay(spark):
    docs = spark.createDataFrame(list(long_pairs([1765] * 60)), "doc_id long, text string")
    assert simhash.one_of_each(docs).count() == 120


def test_one_of_each_of_awkward_documents(spark, awkward):
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    # 1 stands for the foxes, 3 for the wordless, and 10 for the other foxes, of which two have no id.
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        [1, 3, 5, 6, 7, 9, 10], key=repr
    )


def test_sketches_estimate_the_similarity():
    draw = np.random.default_rng(0)
    a = draw.integers(0, 2**63, 3000).astype(np.uint64)
    b = np.concatenate([a[:2700], draw.integers(0, 2**63, 300).astype(np.uint64)])
    estimate = simhash.alike(simhash.sketch(a), simhash.sketch(b))
    assert abs(estimate - 2700 / 3300) < 0.06
    few = a[:100]
    assert simhash.alike(simhash.sketch(few), simhash.sketch(few[:80])) == 0.8
    assert simhash.alike(simhash.sketch(a[:0]), simhash.sketch(a[:0])) == 1.0
    assert simhash.alike(simhash.sketch(a[:0]), simhash.sketch(few)) == 0.0
