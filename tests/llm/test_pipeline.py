"""The pipeline's stages against brute force, each on what its predecessor kept."""

import collections
import random

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm.test_operators import _components, _cut

from scrubline.llm import packing, simhash
from scrubline.llm.base import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score int, copies string"


@pytest.fixture(scope="module")
def steps(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("score"), F.lit("c").alias("copies"))
    rows = [tuple(r) for r in real.collect()]
    rows += [(9001, None, "en", "src0", 0, 1, "c"), (9002, "12 34", None, None, 5, 1, "c"), (9003, "only a few words", None, None, 16, None, None)]
    docs = spark.createDataFrame(rows + rows[:2], DOCS)
    out = [docs.collect()]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        made = stage(spark, docs, "")
        assert k == 4 or made.columns == docs.columns
        docs = stored(made, f"test{k}")
        out.append(docs.collect())
    return out


def test_language_stage_keeps_clean_documents(steps):
    assert collections.Counter(r.doc_id for r in steps[0] if r.doc_id not in (9001, 9002)) == collections.Counter(r.doc_id for r in steps[1])


def test_one_of_each_group_stays(steps):
    docs = steps[1]
    shingles = [_shingles(r.text) for r in docs]
    label = _components(shingles, lambda a, b: len(a) * 0.8 <= len(b) and len(b) * 0.8 <= len(a) and len(a & b) >= 0.8 * len(a | b))
    least = {}
    for r, c in zip(docs, label, strict=True):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in steps[2]) == sorted(least.values())


def test_repeats_are_cut(steps):
    want = {r.doc_id: c[2] for r, c in zip(steps[2], _cut([r.text for r in steps[2]]), strict=True)}
    assert {r.doc_id: r.text for r in steps[3]} == want
    assert all(r.n_chars == len(r.text) for r in steps[3])


def test_mix_and_packing(steps):
    before, after = {r.doc_id: r for r in steps[3]}, collections.Counter(r.doc_id for r in steps[4])
    assert set(after) <= set(before) and max(after.values()) <= 2
    assert all(r == before[r.doc_id] for r in steps[4])
    t = packing.WordTokenizer(packing.vocabulary_path())
    tokens = collections.Counter()
    for r in steps[4]:
        tokens[r.doc_id] += len(t.ids([r.text.encode()])[0]) // 4 + 1
    got = collections.Counter()
    for r in steps[5]:
        got[r.doc_id] += r.length
    assert got == tokens


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def _shingles(text):
    w = text.lower().encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def _similarity(a, b):
    a, b = _shingles(a), _shingles(b)
    return len(a & b) / len(a | b)


def test_near_copies_go(spark):
    r, texts = random.Random(3), []
    for n in [200] * 40 + [1000] * 10 + [30] * 10 + [3, 4, 5]:
        words = [f"w{r.randint(0, 5000)}" for _ in range(n)]
        texts.append(" ".join(words))
        for changed in (1, 2, 4, 8):
            other = words[:]
            for at in r.sample(range(n), min(n, changed * max(1, n // 200))):
                other[at] = "other"
            texts.append(" ".join(other))
    label = _components(texts, lambda a, b: _similarity(a, b) >= 0.8)
    want = {label.index(c) for c in label}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "c") for i, t in enumerate(texts)], DOCS)
    assert {x.doc_id for x in pipeline.drop_near_duplicates(spark, docs, "").collect()} == want
    found, linked = simhash.similar_texts(docs, block=2)
    linked = {x.id: x.component for x in linked.collect()}
    group = {x.doc_id: linked.get(x.key, x.key) for x in found.collect()}
    assert len(set(group.values())) == len(want) and all((group[i] == group[label.index(c)]) for i, c in enumerate(label))


def test_survivors_by_id_and_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    texts = [(1, a), (7, a), (7, b), (7, b), (7, c), (None, c), (None, "none of these"), (None, "none of these")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "c") for i, t in texts], DOCS)
    kept = pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert collections.Counter((r.doc_id, r.text) for r in kept) == collections.Counter([(1, a), (7, b), (7, c), (None, "none of these")])


def test_large_family_has_few_edges(spark, monkeypatch):
    """Members of a large family meet in many buckets; what is connected from these is about one edge a member."""
    import random

    from scrubline.llm import simhash

    r, seen = random.Random(3), []
    words = [f"w{k}" for k in range(120)]
    texts = [" ".join(w if r.random() > 0.01 else f"x{r.randint(0, 10**6)}" for w in words) for _ in range(400)]
    real = simhash.components

    def counted(edges, *rest):
        seen.append(edges.distinct().count())
        return real(edges, *rest)

    monkeypatch.setattr(simhash, "components", counted)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    _, linked = simhash.similar_texts(docs)
    assert linked.select("component").distinct().count() == 1
    n = linked.count()
    assert n > 200 and all(e < 1.5 * n for e in seen), (n, seen)
