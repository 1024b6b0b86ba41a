"""The operators against brute-force versions, on small tables with awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scrubline.llm import chat, embeddings, langid, licenses, media, mixing, packing, simhash, substrings, urls
from scrubline.llm.base import components
from scrubline.llm.license_rules import rules

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Real documents, and: null, empty, blank, short, long, repeated and null-id rows."""
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    words = " ".join(f"w{i}" for i in range(70))
    more = [(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, " \t\n", "en", "src0", 3), (9004, "one", "en", None, 3),
            (9005, "a " * 90, "en", "src1", 180), (9006, words, "en", "src1", 1), (9007, "x " + words[:200] + " y", None, "src1", 1),
            (9008, "12 34", "en", "z", 5), (9009, "cc-by CC BY, all  rights\nreserved; Licensed under the Apache License, Version 2.0", "en", "z", 1),
            (9010, "İ ﬁ don't 3.14 <|endoftext|> é\x1c b\u00a0c", "fr", "z", 1), (9011, "long " * 20000, "en", "z", 1)]
    return base + more + base[:2] + [more[5]]


@pytest.fixture(scope="module")
def table(spark, docs):
    return spark.createDataFrame(docs, DOCS).repartition(3).cache()


def rows(df, *names):
    return collections.Counter(tuple(r[n] for n in names) for r in df.collect())


# --- 1

def _license_scan(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    joined, found = " " + " ".join(words) + " ", []
    for order, (priority, label, _, pattern, base) in enumerate(rules()):
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", joined):
            first = joined[: m.start()].count(" ") - 1
            found.append((first, first + m[0].count(" ") + 1, priority, order, label, base))

    def inside(d, o):
        same = o[:2] == d[:2]
        return o is not d and not o[5] and o[0] <= d[0] and o[1] >= d[1] and (o[2] > d[2] or (o[2] == d[2] and (not same or o[3] < d[3])))

    return len(words), sorted((d[4], d[0], d[1] - 1) for d in found if d[5] or not any(inside(d, o) for o in found))


def test_licenses(table, docs):
    assert len(rules()) > 200
    got = licenses.scan(table.withColumn("detections", F.lit(1)))
    got = collections.Counter((r.doc_id, r.n_words, tuple(sorted((d.label, d.first_word, d.last_word) for d in r.detections))) for r in got.collect())
    want = collections.Counter()
    for d in docs:
        n, found = _license_scan(d[1])
        want[(d[0], n, tuple(found))] += 1
    assert got == want
    assert licenses.scan(table.limit(0)).count() == 0


def _example(tree, r):
    """A random text that a parsed pattern matches."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            lo, hi = r.choice([a if str(k) == "RANGE" else (a, a) for k, a in arg])
            out += chr(r.randint(lo, hi))
        elif name == "MAX_REPEAT":
            out += "".join(_example(arg[2], r) for _ in range(r.randint(arg[0], min(arg[1], arg[0] + 3))))
        elif name == "BRANCH":
            out += _example(r.choice(arg[1]), r)
        else:
            out += _example(arg[-1], r)
    return out


def test_every_rule_finds_its_examples(spark):
    r, texts = random.Random(8), []
    for _, label, keyword, pattern, _ in rules():
        mine = {_example(re._parser.parse(pattern), r) for _ in range(12)}
        assert all(f" {keyword}" in f" {t} " for t in mine), (label, pattern)
        texts += sorted(mine)
    found = licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)).collect()
    got = collections.Counter((x.text, x.n_words, tuple(sorted((d.label, d.first_word, d.last_word) for d in x.detections))) for x in found)
    want = collections.Counter()
    for t in texts:
        n, hits = _license_scan(t)
        assert hits
        want[(t, n, tuple(hits))] += 1
    assert got == want


def test_dense_licence_text(spark):
    """20 000 places in one text; the time of two of the kind shows no square."""
    for n in (1000, 10_000):
        row = licenses.scan(spark.createDataFrame([("copyright notice all rights reserved " * n,)], "text string")).first()
        assert row.n_words == 5 * n and sum(d.label == "reserved" for d in row.detections) == n
        assert sorted(d.first_word for d in row.detections if d.label == "reserved")[-1] == 5 * n - 3


def _ungated(text):
    joined = f" {text} "
    return {label for _, label, _, pattern, _ in rules() if re.search(f"(?<= )(?:{pattern})(?= )", joined)}


def test_the_gate_loses_no_licence(spark):
    texts = {"freebsd license": "bsd-simplified", "simplified licence": "bsd-simplified", "noncommercial use only": "non-commercial",
             "for noncommercial purposes": "non-commercial", "may not be used to train models": "no-ai-training", "see the license for details": "license-file",
             "see licence txt for more information": "license-file", "unauthorised copying prohibited": "proprietary",
             "contains confidential information": "proprietary", "contains proprietary and trade secrets": "proprietary", "open rail license": "openrail",
             "the software is provided as is without warranty of any kind express or implied": "mit", "in no event shall the authors": "disclaimer",
             "licenced under": "license-reference"}
    rows = licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert all(texts[r.text] in _ungated(r.text) for r in rows)
    assert {r.text: texts[r.text] in {d.label for d in r.detections} for r in rows} == dict.fromkeys(texts, True)


# --- 2

def _targets(sizes):
    order = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(order)}
    capped, free = {}, set(order)
    while True:
        share = (1.5 * sum(sizes.values()) - sum(capped.values())) / (sum(weight[k] for k in free) or 1)
        over = [k for k in free if share * weight[k] > 2 * sizes[k]]
        if not over:
            return capped | {k: share * weight[k] for k in free}
        for k in over:
            capped[k] = 2.0 * sizes[k]
            free.discard(k)


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i}": r.choice([0, 5, 100, 1000, 50000]) for i in range(r.randint(1, 9))} | ({None: 77} if seed % 2 else {})
    got = {x.source: x.target for x in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = _targets(sizes)
    assert all(math.isclose(got[k], want[k], abs_tol=1e-6) for k in sizes)


def test_mixing(spark, table, docs):
    sized = table.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    got = mixing.with_copies(sized, "size").collect()
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((d[0], len((d[1] or "").encode().split())) for d in docs)
    want = _targets({s: sum(len((d[1] or "").encode().split()) for d in docs if d[3] == s) for s in {d[3] for d in docs}})
    for s in want:
        mine = [r for r in got if r.source == s]
        taken = sum(r["__copies"] * r["size"] for r in mine)
        assert all(0 <= r["__copies"] <= 2 and math.isclose(r["__target"], want[s]) for r in mine)
        assert abs(taken - want[s]) <= 2 * max(r["size"] for r in mine) + 1
        rate = want[s] / max(1, sum(r["size"] for r in mine))  # each document's expected copies; a step crosses floor or ceiling of it
        assert all(math.floor(rate) <= r["__copies"] <= math.ceil(rate) for r in mine if mine[0]["__source_size"])
    clash = table.withColumns({"target": F.lit(1), "copies": F.lit(2), "s": F.lit(3)})
    mixed = mixing.mix(clash)
    assert mixed.columns == clash.columns
    assert rows(mixed, "doc_id", "text") == rows(mixing.mix(clash), "doc_id", "text")
    assert mixing.mix(table.limit(0)).count() == 0


# --- 3

def test_tokenizer_is_that_of_whole_texts(docs):
    t = packing.WordTokenizer(packing.vocabulary_path(), most_words=2000)
    texts = [d[1] or "" for d in docs]
    want = [e.ids for e in t.tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for i in range(0, len(texts), 40) for x in t.ids([y.encode() for y in texts[i : i + 40]])]
    assert got == want


def test_packing(spark, table, docs):
    with_ids = packing.pieces(table, with_ids=True).cache()
    placed = packing.place(with_ids.drop("ids"), group=64)
    got = placed.collect()
    t = packing.WordTokenizer(packing.vocabulary_path())
    want = collections.Counter()
    for d in docs:
        ids = t.ids([(d[1] or "").encode()])[0] + bytes(4)
        for k, at in enumerate(range(0, len(ids), 8192)):
            part = ids[at : at + 8192]
            want[(d[0], k, at // 4, len(part) // 4, zlib.crc32(part))] += 1
    assert collections.Counter(tuple(r)[:0] + (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.1 * sum(r.length for r in got) / 2048 + 6
    sequences = packing.assemble(placed, with_ids).collect()
    assert sum(len(r.ids) for r in sequences) == sum(r.length for r in got) and all(len(r.ids) <= 2048 for r in sequences)
    null = packing.place(packing.pieces(spark.createDataFrame([(None, "a"), (None, "b")], "doc_id long, text string"))).collect()
    assert [r.doc_id for r in null] == [None, None]
    assert packing.place(packing.pieces(table.limit(0))).count() == 0


def _lengths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return np.array([r.length for r in packing.pieces(docs).select("length").collect()])


def test_steps_empty_bins(spark):
    r = np.random.default_rng(1)
    exchanges = 0
    cases = [(_lengths(spark), 1.01), *((r.integers(500, 1100, 100), 1.2) for _ in range(20)), *((np.exp(r.normal(5, 1.5, 800)).astype(int).clip(1, 2048), 1.02) for _ in range(5))]
    for lengths, most in cases:
        bins = packing.Bins(lengths.tolist(), 2048)
        before, squares = len(bins.items), sum((2048 - x) ** 2 for x in bins.room)
        bins.improve()
        after = sum(1 for x in bins.items if x)
        assert sorted(i for x in bins.items for i in x) == list(range(len(lengths))) and all(sum(lengths[i] for i in x) <= 2048 for x in bins.items)
        assert after == before - bins.emptied and sum((2048 - x) ** 2 for x in bins.room) > squares and bins.emptied > 0
        assert after <= most * -(-lengths.sum() // 2048) + 1
        exchanges += bins.exchanges
    assert exchanges > 0


def test_repeated_pieces_are_dealt_apart(spark):
    same = spark.createDataFrame([(1, 0, 0, 700, 5)] * 3000, "doc_id long, piece int, start long, length long, ids_crc32 long").withColumn("offset", F.lit("x"))
    placed = packing.place(same, group=100).collect()
    assert len(placed) == 3000 and len({x.sequence_id >> 20 for x in placed}) > 20
    assert max(collections.Counter(x.sequence_id >> 20 for x in placed).values()) < 250


# --- 4

def test_embeddings(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(60, 16))
    vectors = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors += [(100 + i, (base[i % 5] + r.normal(size=16) * 0.1).tolist()) for i in range(700)]  # large groups: blocks
    vectors += [(900, None), (901, [0.0] * 16), (902, []), (903, [float("nan")] * 16), (904, [float("inf")] * 16), (905, [1.0, None] * 8), (906, [1.0]),
                (907, (base[0] * 3).tolist()), (908, base[0].tolist()), (908, base[1].tolist()), (None, base[0].tolist())]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<float>, label int")
    got = collections.defaultdict(list)
    for x in embeddings.near_duplicates(df).collect():
        got[x.vec_id].append(x)
    ok = [(i, np.float32(v).astype(float)) for i, v in vectors if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    m = np.array([v / np.linalg.norm(v) for _, v in ok])
    near = m @ m.T >= 0.9
    np.fill_diagonal(near, False)
    want, seen = collections.Counter(), 0
    for k, (i, _) in enumerate(ok):
        want[i] += int(near[k].sum())
    seen = sum(x.n_links for i in want for x in got[i])
    assert sum(want.values()) * 0.98 <= seen <= sum(want.values())
    for i in (900, 901, 902, 903, 904, 905, 906):
        assert [(x.n_links, x.component_id, x.kept) for x in got[i]] == [(0, i, True)]
    assert got[None][0].n_links == 0
    assert got[907][0].component_id == 0 and {x.component_id for x in got[100]} == {0}
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    assert embeddings.near_duplicates(df.where("vec_id = 901")).count() == 1


def test_vectors_of_other_types_and_lengths(spark):
    given = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, [1.0, 0.0]), (4, [1.0, 0.1]), (5, [0.0, 1.0]), (6, [5.0]), (7, [-5.0]), (8, [1.0] * 8), (9, [1.0] * 8)]
    want = {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (1, 8), 9: (1, 8)}
    for kind in ("array<double>", "array<float>", "array<decimal(9,2)>"):
        df = spark.createDataFrame(given, "vec_id long, embedding array<double>").select("vec_id", F.col("embedding").cast(kind), F.lit(1).alias("links"))
        assert {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()} == want


def test_traversal_is_that_of_all_sums():
    r = np.random.default_rng(8)
    a, b = r.random((20, 7)), r.random((20, 5))
    for n in (1, 2, 6, 34, 35, 90):
        cells, bound = embeddings.traverse(a, b, n)
        for i in range(20):
            sums = (a[i][:, None] + b[i]).ravel()
            assert cells[i].tolist() == np.argsort(sums, kind="stable")[:n].tolist()
            assert (sums < bound[i]).sum() == min(n, 35)


@pytest.mark.parametrize("clustered", [False, True])
@pytest.mark.parametrize("n", [1_000_000, 36_000_000])
def test_recall_of_vectors_the_index_has_not_seen(n, clustered):
    """An index of a sample for a table of n, asked about fresh vectors and links between the threshold and 1."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(500, 64))
    fresh = lambda m: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(r.normal(size=(m, 64)) + (2 * centres[r.integers(500, size=m)] if clustered else 0))
    grid = embeddings.fit(fresh(20_000), n)
    found = {}
    for high in (1.0, 0.92):
        base = fresh(3000)
        other = embeddings.turned(base, 0.9, high, r)
        found[high] = (np.minimum(embeddings._ranks(grid, base, other), embeddings._ranks(grid, other, base)) < grid.visits).mean()
    print("n", n, "clustered", clustered, "codes", len(grid.left), "visits", grid.visits, "recall", found)
    assert found[1.0] >= 0.95 and found[0.92] >= 0.9


def test_links_of_more_vectors_than_the_sample(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SAMPLE", 2_000)
    monkeypatch.setattr(embeddings, "BLOCK", 300)  # groups are split, too
    r = np.random.default_rng(6)
    base = r.normal(size=(6000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = embeddings.turned(base[:3000], 0.9, 1, r)
    family = embeddings.turned(np.repeat(base[:1], 400, 0), 0.97, 1, r)  # a large one
    m = np.concatenate([base, other, family]).astype(np.float32).astype(float)
    df = spark.createDataFrame(list(enumerate(m.tolist())), "vec_id long, embedding array<float>")
    got = {x.vec_id: x for x in embeddings.near_duplicates(df).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    n = sum(x.n_links for x in got.values())
    print("links", n, "of", near.sum())
    assert 0.97 * near.sum() <= n <= near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in got)


def test_rows_of_one_id_are_vectors_of_their_own(spark):
    given = [(1, [1.0, 0.01, 0.0, 0.0]), (1, [1.0, 0.0, 0.0, 0.01]), (2, [0.0, 0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.01, 0.0]),
             (4, [0.0, 0.0, 0.0, -1.0]), (0, [0.0, 0.0, 1.0, 0.001]), (None, [0.0, 0.0, 0.0, -1.0])]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    got = collections.Counter(map(tuple, embeddings.near_duplicates(df).collect()))
    assert got == collections.Counter({(1, 1, 1, True): 2, (2, 1, 0, False): 1, (2, 2, 2, True): 1, (3, 2, 2, False): 2, (4, 0, 4, True): 1, (0, 1, 0, True): 1, (None, 0, None, True): 1})


# --- 5

def test_context_trees_are_exact():
    r = random.Random(1)
    words = [b"the", b"and", b"der", b"die", "été".encode(), b"que"]
    train = {x: [b" ".join(r.choice(words[a:b]) for _ in range(40)) for _ in range(5)] for x, a, b in (("x", 0, 4), ("y", 2, 6))}
    grams = {}
    for x, texts in train.items():
        c = collections.Counter(int.from_bytes((langid.PAD + t)[i - 3 : i + 1], "big") for t in texts for i in range(3, len(t) + 3))
        grams[x] = np.array(list(c), np.int64), np.array(list(c.values()), np.int64)
    texts = [b"the and", b"", b"q", b"zz \xff die der the", b"que qux qzz the", b""]
    got = langid.code_lengths(langid.tabulate(grams), texts)
    for t, row in zip(texts, got, strict=True):
        for x, bits in zip("xy", row, strict=True):
            assert math.isclose(bits, _bits(train[x], t), rel_tol=1e-4, abs_tol=1e-3)


def _bits(train, text):
    counts = collections.defaultdict(collections.Counter)
    for t in train:
        x = langid.PAD + t
        for i in range(3, len(x)):
            for k in range(4):
                counts[x[i - k : i]][x[i]] += 1
    total, x = 0.0, langid.PAD + text
    for i in range(3, len(x)):
        out, p = set(), 1.0
        for k in range(3, -1, -1):
            live = {s: n for s, n in counts[x[i - k : i] if k else b""].items() if s not in out}
            n, d = sum(live.values()), len(live)
            if x[i] in live:
                p *= live[x[i]] / (n + d)
                break
            if n:
                p *= d / (n + d)
                out |= set(live)
        else:
            p /= 256 - len(out)
        total -= math.log2(p)
    return total


def test_many_languages_and_scripts(spark):
    """60 languages, 20 each of words in Latin, Cyrillic and Devanagari letters; none is refused and the model stays small."""
    r = random.Random(6)
    scripts = ["abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x905, 0x93A)))]
    words = {f"l{i:02}": ["".join(r.choices(scripts[i % 3], k=r.randint(2, 8))) for _ in range(300)] for i in range(60)}
    given = [(k, " ".join(r.choices(w, k=60)), x) for x, w in words.items() for k in range(12)]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(df.where("doc_id < 8"))
    assert len(model.languages) == 60
    size = sum(a.nbytes for trees in model.trees for t in trees for a in vars(t).values())
    assert size < 40 << 20
    got = langid.predict(df.where("doc_id >= 8"), model).collect()
    assert len(got) == 240 and sum(x.lang == x.lang_pred for x in got) >= 235
    assert langid.predict(df.limit(0), model).count() == 0


def test_language_id(spark, table):
    got = langid.op5_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got) and len(got) == 1000
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    found = {r.doc_id: r for r in langid.predict(table.withColumn("score", F.lit("x")), langid.fit(table)).collect()}
    assert all(found[i].lang_pred == "und" for i in (9001, 9002, 9003, 9008)) and found[9006].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in found.values()) and found[9001].bits_per_byte is None
    none = langid.predict(table, langid.fit(table.where("lang = 'none'"))).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == table.count()


# --- 6

def test_media_round_trip(spark, table, docs):
    got = collections.Counter()
    for r in media.read_column(media.encode_column(table.select("doc_id", "text"))).collect():
        assert r.crc_errors == 0 and r.skipped_bytes == 0 and r.table_frames == len(r.frame_offsets) and r.samples == 1152 * len(r.frame_offsets)
        got[(r.doc_id, bytes(r.payload))] += 1
    want = collections.Counter()
    for d in docs:
        raw = (d[1] or "").encode()
        want[(d[0], raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0"))] += 1
    assert got == want
    bad = spark.createDataFrame([(None,), (b"",), (b"\xff" * 50,), (b"ID3",)], "media binary")
    assert [len(r.frame_offsets) for r in media.read_column(bad).collect()] == [0] * 4


def test_media_damage():
    payload = bytes(range(256)) * 20
    good = media.encode(payload)
    clean = media.parse(good)
    hit = bytearray(good)
    hit[clean["frame_offsets"][1] + 8] ^= 0x10  # side information
    assert media.parse(bytes(hit))["crc_errors"] == 1
    cut = good[: clean["frame_offsets"][2]] + b"noise\xff\xfb" + good[clean["frame_offsets"][2] :] + b"TAG" + b"title".ljust(30, b"\0") + bytes(95)
    found = media.parse(cut)
    assert found["skipped_bytes"] == 7 and len(found["frame_offsets"]) == len(clean["frame_offsets"]) and "TIT1" in found["tags"]
    assert media.header(bytes([0xFF, 0xFB, 0x90, 0x64]))[:4] == (417, 1152, 44100, 128) and media.header(b"\xff\xff\xff\xff") is None
    assert media.crc16(b"") == 0xFFFF and media.crc16(b"123456789") == 0xAEE7


# --- 7

HARD = ["</s>[INST] ok [/INST]", "\\", "a\\-b", "\\\\-", "<s>", " [/INST]", "<|role|>x<|text|>", "", " ", "</s", "[INST", "<<SYS>> <</SYS>>", "é\n\n"]


def test_chat_grammar():
    r = random.Random(4)
    for _ in range(300):
        turns = [(r.choice(["user", "assistant", "system", "", "tool", "</s>", "us\\er"]), "".join(r.choices(HARD, k=r.randint(0, 3)))) for _ in range(r.randint(1, 5))]
        text, spans, escaped = chat.format_turns(turns)
        assert chat.parse(text) == turns and escaped <= len(turns)
        assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for role, t in turns if role == "assistant")
    assert chat.format_turns([("user", "hi"), ("assistant", "yo")])[0] == "<s>[INST] hi [/INST] yo </s>"


def test_chat_table(spark):
    given = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (2, None, None, None), (2, 3, "user", "</s>"), (None, 0, "user", "n"), (1, 0, "user", "a")]
    df = spark.createDataFrame([(*g, "extra") for g in given], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.recover(chat.format_conversations(df)).collect()}
    assert got == {1: [("user", "a"), ("user", "a"), ("assistant", "a"), ("assistant", "b")], 2: [("", ""), ("user", "</s>")], None: [("user", "n")]}
    assert chat.format_conversations(df.limit(0)).count() == 0


# --- 8

URLS = ["http://a.net/x", "http://a.net", "HTTP://Www.Example.NET/en/1?q#f", "https://example.net/en", "https://x.example.com/de/?u", "https://example.com/den/", None, "", "nothing",
        "ftp://org/fr/a/b", "http://notorg/fr/", "http://spam-farm.example.org/fr/", "http://spam-farm.example.org", "a://b://c/net/", "http:///fr/", "http://é.org/fr/é", "http://net/"]


def _judge(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    under = lambda h: host == h or host.endswith("." + h)
    fits = [(h + p, v) for h, p, v in urls.RULES if under(h) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, "block" if any(map(under, urls.BLOCKED)) else "allow"))
    return host, path, rule, verdict


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert got == {i: _judge(u) for i, u in enumerate(URLS)}
    listed = spark.createDataFrame([("net", "", "block")], "h string, p string, v string")
    assert [r.verdict for r in urls.judge(df.where("page_id = 1"), rules=listed, blocked=[]).collect()] == ["block"]
    assert urls.judge(df.limit(0)).count() == 0


def test_repeated_and_clashing_url_columns(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (2, None)], "page_id long, path string")
    got = collections.Counter(tuple(r) for r in urls.judge(df.withColumn("HOST", F.lit(1)), url_col="path").collect())
    assert got == {(1, "a.net", "/x", "net/", "block"): 2, (2, "", "", None, "allow"): 1}


def test_a_million_rules(spark):
    rules = spark.range(1_000_000).select(F.concat(F.lit("h"), "id", F.lit(".example")).alias("h"), F.concat(F.lit("/p"), F.col("id") % 7).alias("p"),
                                          F.when(F.col("id") % 2 == 0, "block").otherwise("allow").alias("v"))
    asked = spark.range(0, 1_000_000, 4999).select("id", F.concat(F.lit("http://www.h"), "id", F.lit(".example/p"), F.col("id") % 7, F.lit("/q")).alias("url"))
    got = urls.judge(asked, rules=rules, blocked=[]).collect()
    assert len(got) == 201 and all(r.rule == f"h{r.id}.example/p{r.id % 7}" and r.verdict == ("allow" if r.id % 2 else "block") for r in got)


def test_digest_collisions(tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "digest", lambda k: len(k) % 3)
    path = str(tmp_path / "i")
    entries = [(urls.key(f"h{i}", "/p"), f"v{i}") for i in range(40)] + [(urls.key("abc", ""), "x")]
    urls.write_index(path, sorted((urls.digest(k), k, v) for k, v in entries))
    index = urls.Index(path)
    assert index.find([k for k, _ in entries] + [b"h99\0/p", b"zz\0"]) == [v for _, v in entries] + [None, None] and index.path_lengths == [0, 2]
    urls.write_index(path, [])
    assert urls.Index(path).find([entries[0][0]]) == [None]


# --- 9

def _cut(texts, window=35):
    split = [(t or "").encode().split() for t in texts]
    n = collections.Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if n[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def test_substrings(table, docs):
    got = rows(substrings.remove_repeats(table.withColumn("places", F.lit(1))), "doc_id", "__words", "__removed", "text")
    assert got == collections.Counter((d[0], *c) for d, c in zip(docs, _cut([d[1] for d in docs]), strict=True))
    assert substrings.remove_repeats(table.limit(0)).count() == 0


def test_short_windows(spark):
    r = random.Random(7)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 30))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert substrings.levels(35) == [9, 18, 35] and substrings.levels(8, 2) == [2, 4, 8] and substrings.levels(2, 2) == [2]
    for window, shortest in ((2, 2), (5, 2), (8, 2), (8, 9)):
        got = rows(substrings.remove_repeats(df, window=window, shortest=shortest), "doc_id", "__words", "__removed", "text")
        assert got == collections.Counter((i, *c) for i, c in enumerate(_cut(texts, window)))


def test_levels_let_go(spark):
    """What is repeated at one length alone is extended; where nothing is, the search ends."""
    base = [f"w{i}" for i in range(40)]
    other = lambda x, n: [f"{x}{i}" for i in range(n)]
    texts = {1: base + other("a", 60), 2: other("b", 50) + base, 3: other("c", 50) + base[:12] + other("d", 50), 4: other("e", 90)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    laid = df.withColumn("__row", F.col("doc_id"))
    x, reached, _ = substrings.candidates(laid, "text")
    assert [n for n, _ in reached] == [9, 18] and {r.doc_id for r in x.collect()} == {1, 2}
    x, reached, _ = substrings.candidates(laid.where("doc_id > 2"), "text")
    assert [n for n, _ in reached] == [9] and x.count() == 0
    assert substrings.remove_repeats(df.where("doc_id > 2")).where("__removed > 0").count() == 0


# --- 10

def _fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def _components(keys, linked):
    parent = list(range(len(keys)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(keys))]


def test_simhash(table, docs):
    got = collections.defaultdict(set)
    for r in simhash.near_duplicates(table).collect():
        got[r.doc_id].add((r.fp & (1 << 64) - 1, r.component_id))
    known = [(d[0], _fingerprint(d[1])) for d in docs]
    unique = sorted({f for _, f in known})
    label = dict(zip(unique, _components(unique, lambda a, b: (a ^ b).bit_count() <= 3), strict=True))
    least = {}
    for i, f in known:
        least[label[f]] = min(least.get(label[f], i), i)
    assert got == {i: {(f, least[label[f]])} for i, f in known}
    assert simhash.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("plan", [[(list(range(16 * i, 16 * i + 16)), 0) for i in range(4)], [(list(range(0, 64, 2)), 1), (list(range(1, 64, 2)), 1)],
                                  [(list(range(20)), 1), (list(range(20, 42)), 0), (list(range(42, 64)), 0)]])
def test_pigeonhole_loses_nothing(spark, plan):
    r = random.Random(5)
    seeds = [r.getrandbits(64) for _ in range(20)]
    fps = sorted({s ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for s in seeds for _ in range(30)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    found = components(simhash.verified(simhash.buckets(df, plan), 3, block=40))
    got = {x.id: x.component for x in found.collect()}
    want = _components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, c in enumerate(want):
        least[c] = min(least.get(c, i), i)
    assert all(got.get(i, i) == least[c] for i, c in enumerate(want))


def test_thresholds_cover_the_radius():
    sample = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 500)
    for n in (1000, 10**7, 10**10):
        assert sum(t + 1 for _, t in simhash.plan(sample, n)) == 4
    assert sum(t + 1 for _, t in simhash.plan(sample[:1], 1)) == 4


# --- columns that clash with what the operators add

def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "one two three", "x")], "doc_id long, text string, MEDIA string").withColumns({c: F.lit("x") for c in (
        "payload", "__words", "__removed", "fp", "component_id", "rep", "key", "t", "h", "pos", "ids", "piece", "n_words", "__has_letter")})
    read = media.read_column(media.encode_column(df)).first()
    assert bytes(read.payload).rstrip(b"\0") == b"one two three" and read.fp == "x" and media.read_column(media.encode_column(df.limit(0))).count() == 0
    cut = substrings.remove_repeats(df).first()
    assert (cut["__words"], cut["__removed"], cut.pos, cut.text) == (3, 0, "x", "one two three")
    assert [tuple(r)[0::2] for r in simhash.near_duplicates(df).collect()] == [(1, 1)]
    found, linked = simhash.similar_texts(df.union(df))
    assert found.count() == 2 and linked.count() == 0
    own = {c: F.lit("x") for c in ("__size", "__step", "__part", "__place", "__copies", "__c0", "source")}
    mixed = mixing.mix(df.withColumns(own))
    assert mixed.columns == [*df.columns, *own] and {(r["__size"], r["__copies"], r.text) for r in mixed.collect()} == {("x", "x", "one two three")}
    with pytest.raises(ValueError, match="__step"):
        mixing.with_copies(df.withColumns(own | {"size": F.lit(1)}), "size")
    assert packing.pieces(df).first().length == 4 and licenses.scan(df).first().n_words == 3
    assert langid.predict(df, langid.fit(df.withColumn("lang", F.lit("en")))).first().lang_pred == "en"


# --- components

def test_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, r.randint(101, 300)) for _ in range(150)] + [(r.randint(400, 500), r.randint(400, 500)) for _ in range(60)] + [(7, 7)]
    nodes = sorted({x for e in edges for x in e})
    links = {frozenset(e) for e in edges}
    want = dict(zip(nodes, _components(nodes, lambda a, b: frozenset((a, b)) in links), strict=True))
    least = {}
    for x, c in want.items():
        least[c] = min(least.get(c, x), x)
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: least[c] for x, c in want.items()}


def test_hash_of_equal_texts_is_equal(spark):
    same = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id long, text string")
    assert len({hashlib.sha256(bytes(r.media)).hexdigest() for r in media.encode_column(same).collect()}) == 1


def test_repeated_texts_crowd_out_no_language(spark):
    """A text counts once, whatever ids and however many copies it has."""
    french, english = "le chat est sur la table et il dort ", "the cat is on the table and it sleeps "
    rows = [(7, french * 3, "fr")] * 2000 + [(11, french * 3, "fr")] * 500 + [(i, english + str(i), "en") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for most in (20, 500):
        model = langid.fit(df, max_docs=most)
        assert model.languages == ["en", "fr"]
    got = langid.predict(spark.createDataFrame([(1, "il est la"), (2, "it is the")], "doc_id long, text string"), model).collect()
    assert [r.lang_pred for r in got] == ["fr", "en"]


def test_one_row_of_many_copies_is_cut(spark):
    """A row that is repeated a hundred thousand times lies in all buckets, and nothing stays behind."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = spark.range(100_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text"), F.lit("x").alias("__known"), F.lit(1).alias("__row"))
    rows = rows.union(spark.createDataFrame([(6, "only " + text[:60], "y", 2), (None, text, "z", 3), (None, None, None, None)], "doc_id long, text string, __known string, __row int"))
    before = {t.name for t in spark.catalog.listTables()}
    cut = substrings.remove_repeats(rows.repartition(8))
    got = collections.Counter((r.doc_id, r["__words"], r["__removed"], r["__known"]) for r in cut.select("doc_id", "__words", "__removed", "__known").collect())
    assert got == {(5, 40, 40, "x"): 100_000, (6, len(("only " + text[:60]).split()), 0, "y"): 1, (None, 40, 40, "z"): 1, (None, 0, 0, None): 1}
    assert {t.name for t in spark.catalog.listTables()} == before and cut.columns[:4] == ["doc_id", "text", "__known", "__row"]


def test_marks_and_digits_are_looked_up():
    """Runs of marks and single digits are parts of their own, as letter runs are; the ids are those of the whole text."""
    t = packing.WordTokenizer(packing.vocabulary_path(), most_words=50)
    assert t._parts(b"heat*** Re%%%,12x &") == ["heat", "***", "re", "%%%,", "1", "2", "x", "&"]
    rng = np.random.default_rng(5)
    signs = list("abTZ's''<|>.,!$%^`{}~-09 \t\n\x0b\x1c\x00\x7féßÀÿ×ªµ½\xa0\x85İΣ漢é​") + ["<|endoftext|>", "'ll", "heat***", " "]
    texts = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(3000)]
    for text, got in zip(texts, t.ids([x.encode() for x in texts]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
