"""The registered queries themselves, on tables of awkward rows, against brute force or their SQL."""

import collections
import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest
from tests.llm.test_operators import DOCS, URLS, _bits, _components, _cut, _fingerprint, _license_scan, _targets

from scrubline.llm import media, packing
from scrubline.llm.license_rules import CONFIDENCE, rules
from scrubline.llm.registry import oracle_sql, queries

Q = queries()


@pytest.fixture(scope="module")
def texts(spark):
    real = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(60).collect()]
    words = " ".join(f"w{i}" for i in range(70))
    return real + [
        (9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, " \t\n", "en", "src0", 3), (9004, "one", "en", None, 3), (9005, "a " * 90, "en", "src1", 180),
        (9006, words, "en", "src1", 1), (9007, "x " + words[:200] + " y", None, "src1", 1), (9008, "12 34", "en", "z", 5),
        (9009, "cc-by CC BY, all  rights\nreserved; Licensed under the Apache License, Version 2.0", "en", "z", 1),
        (9010, "İ ﬁ don't 3.14 <|endoftext|> é\x1c b c General Public License", "fr", "z", 1), (9011, "long " * 3000, "en", "z", 1)]


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    """Tables with extra columns whose names clash with those of the results."""
    out = str(tmp_path_factory.mktemp("tables"))
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{out}/{name}.parquet")
    write([(*t, 1, "x", 2) for t in texts], DOCS + ", score int, labels string, fp int", "documents")
    r = np.random.default_rng(2)
    base = r.normal(size=(30, 8))
    vectors = [(i, v.tolist(), 0, i % 3) for i, v in enumerate(base)] + [(100 + i, (base[i % 4] + r.normal(size=8) * 0.05).tolist(), 1, i % 2) for i in range(40)]
    write([*vectors, (900, None, 0, 1), (901, [0.0] * 8, 0, 1), (902, [float("nan")] * 8, 0, 1), (903, (base[0] * 2).tolist(), 0, None)], "vec_id long, embedding array<float>, kept int, label int", "embeddings")
    write([(i, u, "h", 1) for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, html string, verdict int", "pages")
    write([(1, 0, "user", "a", 1), (1, 1, "assistant", "b </s>", 1), (2, 0, "system", None, 1), (2, 1, "assistant", "", 1), (3, 0, "tool", "\\-[INST]", 1)],
          "conv_id long, turn long, role string, text string, formatted int", "conversations")
    return out


def collected(spark, folder, name):
    return Q[name](spark, folder).collect()


def test_those_with_sql(spark, folder):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    for name, sql in oracle_sql().items():
        df, rows = Q[name](spark, folder), duck.execute(sql)
        names = [d[0] for d in rows.description]
        assert collections.Counter(tuple(r[n] for n in names) for r in df.collect()) == collections.Counter(rows.fetchall()), name


def test_op1(spark, folder, texts):
    confidence = {(label, base): CONFIDENCE[p] for p, label, _, _, base in reversed(rules())}
    want = collections.Counter()
    for d in texts:
        n, found = _license_scan(d[1])
        phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
        import re

        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in d[1] or ""))
        base = [(label, i) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        starts = [i for _, i in base]
        want[(d[0], n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for x, _ in base})), ",".join(sorted({x for x, *_ in found})))] += 1
    got = collected(spark, folder, "op1_license_scan")
    assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in got) == want
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got) and confidence


def test_op2_takes_what_is_asked(spark, folder, texts):
    got = collected(spark, folder, "op2_mix_sources")
    sizes = {d[0]: len((d[1] or "").encode().split()) for d in texts}
    source = {d[0]: d[3] for d in texts}
    want = _targets({s: sum(sizes[i] for i in sizes if source[i] == s) for s in set(source.values())})
    assert {r.doc_id: r.size for r in got} == sizes and all(math.isclose(r.target, want[source[r.doc_id]]) and r.taken <= 2 * r.size for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, collected(spark, folder, "op2_mix_sources")))


def test_op3(spark, folder, texts):
    got, t = collected(spark, folder, "op3_pack_documents"), packing.WordTokenizer(packing.vocabulary_path())
    want = set()
    for d in texts:
        ids = np.array([*t.tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want |= {(d[0], k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in x) <= 2048 and [o for o, _ in sorted(x)] == [0, *np.cumsum([n for _, n in sorted(x)])[:-1]] for x in bins.values())


def test_op4(spark, folder):
    got = {r.vec_id: r for r in collected(spark, folder, "op4_embedding_duplicates")}
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ok = sorted((r.vec_id, np.array(r.embedding)) for r in rows if r.embedding and np.isfinite(r.embedding).all() and any(r.embedding))
    m = np.array([v / np.linalg.norm(v) for _, v in ok])
    near = (m @ m.T >= 0.9) & ~np.eye(len(m), dtype=bool)
    label = _components(list(range(len(ok))), lambda a, b: near[a, b])
    least = {c: min(ok[i][0] for i, x in enumerate(label) if x == c) for c in label}
    want = {i: (int(near[k].sum()), least[label[k]], least[label[k]] == i) for k, (i, _) in enumerate(ok)} | {i: (0, i, True) for i in (900, 901, 902)}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == want


def test_op5(spark, folder, texts):
    got = {r.doc_id: r for r in collected(spark, folder, "op5_language_id")}
    assert len(got) == len(texts) and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in got.items())
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {9001, 9002, 9003, 9008}
    assert {r.lang_pred for r in got.values()} <= {d[2] for d in texts} | {"und"}
    # against the code lengths of plain trees over the same training texts, each once
    train = collections.defaultdict(set)
    for i, text, lang, *_ in texts:
        if text is not None and lang is not None and not got[i].held_out:
            train[lang].add(text.encode())
    short = [d for d in texts if d[1] and len(d[1]) < 120 and got[d[0]].lang_pred != "und"]
    for i, text, *_ in short:
        bits = {lang: _bits(sorted(x), text.encode()) for lang, x in train.items()}
        best = min(sorted(bits), key=lambda x: bits[x])
        assert got[i].lang_pred == best and math.isclose(got[i].score, 1 / sum(2 ** min(0, bits[best] - b) for b in bits.values()), rel_tol=1e-6)
    assert len(short) >= 3


def test_op6(spark, folder, texts):
    want = set()
    for i, text, *_ in texts:
        raw = (text or "").encode()
        whole = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        stream = media.encode(whole)
        want.add((i, len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-64:]), len(stream), hashlib.sha256(stream).hexdigest()))
    got = collected(spark, folder, "op6_media_columns")
    assert {(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) for r in got} == want
    assert len(got) == len(want) and all(f"{r.payload_bytes and -(-r.payload_bytes // 937)} frames" in r.feature for r in got)


def test_op9(spark, folder, texts):
    want = {d[0]: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, (n, gone, kept) in zip(texts, _cut([d[1] for d in texts]), strict=True)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in collected(spark, folder, "op9_substring_dedup")} == want


def test_op10(spark, folder, texts):
    fps = [_fingerprint(d[1]) for d in texts]
    label = _components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {c: min(d[0] for d, x in zip(texts, label, strict=True) if x == c) for c in label}
    want = {d[0]: (f"{f:016x}", least[c]) for d, f, c in zip(texts, fps, label, strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in collected(spark, folder, "op10_simhash_duplicates")} == want


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("embeddings", "vec_id long, embedding array<float>, label int"), ("pages", "page_id long, url string, html string"),
                         ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, q in Q.items():
        assert q(spark, str(tmp_path)).count() == (1 if name.startswith("op7") else 0), name
