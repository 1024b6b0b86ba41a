"""The manifest against a plain Merkle tree, and its paths for every height of block and layer."""

import hashlib
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from scrubline.llm import merkle
from scrubline.llm.registry import queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def digest(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def climb(nodes):
    """The root of nodes, and for each of them its path: (place, siblings), level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for k, a in enumerate(at):
            run = runs[a // 8]
            paths[k].append((a % 8, run[: a % 8] + run[a % 8 + 1 :]))
            at[k] = a // 8
        nodes = [h(*r) for r in runs]
    return nodes[0], paths


def folded(node, path):
    for place, others in path:
        node = h(*others[:place], node, *others[place:])
    return node


def wanted(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"""
    key = lambda r: (r[0] is not None, r[0] or 0, digest(r))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=key) for g in langs}
    roots = {g: climb([digest(r) for r in groups[g]]) for g in langs}
    root, upper = climb([roots[g][0] for g in langs])
    out = []
    for g, more in zip(langs, upper, strict=True):
        for r, path in zip(groups[g], roots[g][1], strict=True):
            whole = path + more
            other = digest(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                other = digest((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            f = folded(other, whole)
            out.append((r[0], digest(r), roots[g][0], root, h(*[x for _, others in whole for x in others]), f, f == root))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    real = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    return real + [(None, None, None, None, None), (None, "a", None, 1, "x"), (5, None, None, None, ""), (9001, "Ünï", "zz", -3, "long " * 50000), (-7, "s", "", 0, "ÄB Z"),
                   (9002, "s", "one", 1, "ABC")] + [real[0]] * 70 + [(9100, "s", "tie", 1, "b"), (9100, "s", "tie", 1, "a"), (9100, "s", "tie", 1, "b")]


def test_query(spark, rows, tmp_path):
    clash = [(*r, "x", 1, 2) for r in rows]
    spark.createDataFrame(clash, SCHEMA + ", leaf string, place int, g int").repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries()["op12_dataset_manifest"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(wanted(rows), key=repr)
    assert {r[-1] for r in got} == {True, False} and len({r[3] for r in got}) == 1


@pytest.mark.parametrize("height,layer", [(1, 1), (2, 1), (3, 2)])
def test_blocks_of_other_heights(spark, rows, height, layer):
    """Small blocks: several levels above them, and subtrees that follow each other in a block."""
    many = rows + [(20_000 + i, "s", "big", i, f"Text {i}") for i in range(1200)]
    df = spark.createDataFrame(many, SCHEMA).repartition(5)
    df = df.withColumn("digest", merkle.leaf([F.col(c) for c in df.columns]))
    got = merkle.authenticated(df, "digest", "lang", ["doc_id"], ["doc_id", "lang"], height, layer)
    got = got.withColumn("proof", F.sha2(merkle.joined(F.col("path")), 256)).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in got if r.doc_id is not None) == sorted(x[:5] for x in wanted(many) if x[0] is not None)
    assert all(r.folded == r.root for r in got) and len(got) == len(many)


def test_traversal_of_every_size():
    for n, layer in itertools.product([1, 2, 8, 9, 63, 64, 65, 130, 512, 513, 700], (1, 2, 3)):
        leaves = [h(str(i)) for i in range(n)]
        height = merkle.height_of(n)
        root, paths = climb(leaves)
        walk = merkle.Traversal([x.encode() for x in leaves], height, layer)
        assert merkle.block_root([x.encode() for x in leaves], height).decode() == root
        held = 0
        for path in paths:
            assert [(p, s.decode()) for p, s in walk.step()] == [(p, "".join(s)) for p, s in path]
            held = max(held, sum(len(level) for t in (*walk.existing, *walk.desired) for level in t.nodes))
        # two subtrees a layer, whatever n is
        assert held <= sum(2 * sum(8 ** (t - level) for level in range(b, t)) for b, t in walk.layers)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries()["op12_dataset_manifest"](spark, str(tmp_path)).count() == 0
