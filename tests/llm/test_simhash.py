import numpy as np
import xxhash
from helpers import collected, frame, random_texts

from shelfcast.llm import simhash as S


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = low.encode().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius=4):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def cluster(n, seed):
    """Values close to a few centres, many of them in chains."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 3, dtype=np.uint64)
    out = [int(centres[i % 3]) for i in range(n)]
    for i in range(n):
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            out[i] ^= 1 << int(b)
    return list(dict.fromkeys(out))


def test_bk_forest_finds_all_within_the_radius():
    values = np.array(cluster(400, 1) + cluster(300, 2), np.uint64)
    tree = np.sort(np.random.default_rng(0).integers(0, 5, len(values)))
    forest = S.Forest(tree, values)
    for radius in (0, 2, 4):
        got = set()
        for q, node in forest.near(values, tree, radius):
            got.update(zip(q.tolist(), node.tolist()))
        far = np.bitwise_count(values[:, None] ^ values)
        want = {(a, b) for a, b in zip(*np.nonzero(far <= radius)) if tree[a] == tree[b]}
        assert got == want


def test_links_connect_exactly_also_across_parts(spark):
    values = cluster(500, 3)
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    want = classes(values)
    for shard in (16, 4096):
        roots = {r.node: r.root for r in S.components(S.links(fps, shard=shard)).collect()}
        signed = [int(np.uint64(v).view(np.int64)) for v in values]
        got = [roots.get(v, v) for v in signed]
        pairs = set(zip(want, got))
        assert len(pairs) == len(set(want)) == len(set(got))


def test_near_duplicates_match_brute_force(spark):
    texts = random_texts(40, seed=5) + ["same words here now and then", "Same Words here now and then", "x", "X", "  x "]
    got = collected(S.near_duplicates(frame(spark, texts)))
    fps = [fingerprint(t) for t in texts]
    assert [np.int64(got[i].fp).view(np.uint64) for i in range(len(texts))] == fps
    assert [got[i].component_id for i in range(len(texts))] == classes(fps)


def test_representatives_keep_one_row_of_each_group(spark):
    schema = "doc_id long, text string, th string"
    docs = spark.createDataFrame([(2, "a b c d e", "p"), (1, "a b c d e", "q"), (1, "a b c d e", "q"), (None, "a b c d e", "r"), (None, "alone in here", "s"), (7, None, "t"), (8, "", "u")], schema)
    out = S.representatives(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, r.th) for r in out.collect()) == [(-1, "s"), (1, "q"), (7, "t")]
    assert S.representatives(docs.limit(0)).count() == 0


def test_large_components_and_frequent_fingerprints(spark, monkeypatch):
    # a chain of single-bit steps: one component of 60 fingerprints, none near most others
    chain = [0]
    for b in range(59):
        chain.append(chain[-1] ^ (1 << b))
    signed = [int(np.uint64(v).view(np.int64)) for v in chain]
    distinct = spark.createDataFrame([(v, 500 - i if i != 30 else None) for i, v in enumerate(signed)] + [(int(np.uint64((1 << 64) - 1).view(np.int64)), None)], "fp long, least long")
    got = {r.f: (r.root, r.component_id) for r in S.component_ids(distinct, S.components(S.links(distinct.select("fp")))).collect()}
    assert len(got) == 61 and {got[v][1] for v in signed} == {500 - 59} and len({got[v][0] for v in signed}) == 1
    assert got[-1] == (-1, None)
    # the same rows with and without broadcast results of frequent fingerprints
    texts = ["copy of the very same words"] * 50 + [None] * 30 + random_texts(20, seed=8)
    rows = []
    for hot in (10_000, 3, 0):
        monkeypatch.setattr(S, "HOT", hot)
        rows.append(sorted((r.doc_id, r.fp, r.component_id) for r in S.near_duplicates(frame(spark, texts)).collect()))
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == len(texts)
    assert [c for _, _, c in rows[0]] == classes([fingerprint(t) for t in texts])


def test_very_long_texts(spark):
    long = " ".join(f"w{i % 9973}" for i in range(300_000))
    glued = "x" * 2_000_000
    texts = [long, long.upper(), glued, glued + " y", "short"]
    got = collected(S.near_duplicates(frame(spark, texts)))
    fps = [fingerprint(t) for t in texts]
    assert [np.int64(got[i].fp).view(np.uint64) for i in range(5)] == fps
    assert [got[i].component_id for i in range(5)] == classes(fps)
