"""SimHash near-dedup against brute force."""

import random
import re

import numpy as np
import xxhash

from quire.llm import simhash as S

DOCS = "doc_id long, text string"


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(fps):
    """fingerprint -> smallest fingerprint of its class, by all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


TEXTS = ["", "one", "One TWO", "a b c", "a b c d a b c d", "É é x\x0by z\tq", "w " * 5000, "Tie tie TIE tie",
         "the quick brown fox jumps over the lazy dog again and again", " \n\t "]


def test_fingerprints_match_the_definition():
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choices(["ab", "cd", "É", "f."], k=rng.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert S.simhash(t) == slow_fingerprint(t), t
    assert S.simhash(None) == 0


def test_spark_hashes_shingles_alike(spark):
    from pyspark.sql import functions as F
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got & (2 ** 64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42) == S.simhash("a b c")


def near(rng, fp, bits):
    for b in rng.sample(range(64), bits):
        fp ^= 1 << b
    return int(np.uint64(fp & (2 ** 64 - 1)).view(np.int64)) if fp >= 0 else fp


def signed(x):
    return int(np.array([x & (2 ** 64 - 1)], dtype=np.uint64).view(np.int64)[0])


def planted(rng, centres, copies):
    out = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        out.append(signed(c))
        for _ in range(copies):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
            out.append(signed(x))
    return out


def class_sets(pairs):
    out = {}
    for fp, root in pairs:
        out.setdefault(root, set()).add(fp)
    return sorted(map(sorted, out.values()))


def test_classes_equal_all_pairs(spark):
    fps = planted(random.Random(1), 30, 6) + [0, -1, 1, 7, 15]
    df = spark.createDataFrame([(f,) for f in sorted(set(fps))], "fp long")
    got = [(r.fp, r.root) for r in S.classes(df).collect()]
    want = slow_classes(fps)
    assert class_sets(got) == class_sets(want.items())


def test_large_buckets_are_tiled_without_loss(spark):
    """One dense cluster: tiles of 8 rows force the grid; links stay complete and few."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {signed(centre)}
    while len(fps) < 400:  # all share the upper half
        x = centre
        for b in rng.sample(range(32), rng.randint(1, 8)):
            x ^= 1 << b
        fps.add(signed(x))
    df = spark.createDataFrame([(f,) for f in sorted(fps)], "fp long")
    for rows in (8, 4096):
        edges = [(r.a, r.b) for r in S.link_edges(df, tile_rows=rows).collect()]
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            root[find(a)] = find(b)
        got = [(f, find(f)) for f in fps]
        assert class_sets(got) == class_sets(slow_classes(fps).items())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "a long, b long")
    got = dict((r.node, r.root) for r in S.components(edges).collect())
    assert all(got[i] == 0 for i in range(61)) and got[101] == got[100] == 100


def test_edge_rows(spark):
    rows = [(5, None), (3, ""), (9, "same text of some words here"), (2, "same text of some words here"),
            (2, "same text of some words here"), (None, "something else entirely, really"), (7, "x " * 100_000)]
    got = S.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component) for r in got if r.doc_id) == [
        (False, 2, 2), (False, 2, 2), (False, 3, 3), (False, 5, 3), (False, 7, 7), (False, 9, 2)]
    assert [r.component for r in got if r.doc_id is None] == [None]
    empty = spark.createDataFrame([], DOCS)
    assert S.near_duplicates(empty).collect() == [] and S.keep_one(empty).collect() == []


def test_keep_one_keeps_columns_and_one_row(spark):
    rows = [(2, "same text of some words here", 1.0, "a"), (2, "same text of some words here", 1.0, "a"),
            (9, "same text of some words here", 2.0, None), (None, None, None, None), (4, "", 0.0, "b"),
            (None, "quite another text that stands alone", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp double, root string")
    got = S.keep_one(df)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, [
        df.collect()[0], df.collect()[4], df.collect()[5]]))
