"""Token files: the grammar against ids from the tokeniser, decoding of any stretch, awkward rows."""

import zlib

import numpy as np
import pytest

from scrubline.llm import grammar, packing
from scrubline.llm.registry import queries


def test_pairs_are_replaced_until_none_is_frequent():
    r = np.random.default_rng(3)
    for least, n in ((2, 300), (3, 2000), (2, 1), (2, 0), (4, 5000)):
        s = r.integers(0, 6, n) ** 2 % 5 + 10
        s[n // 3 : n // 2] = 12  # one symbol in a row
        last = r.random(n) < 0.02
        last[-1:] = True
        short, places, left, right = grammar.replace_pairs(s, last, 100, least)
        assert grammar.expand(short, left, right, 100).tolist() == s.tolist()
        lengths = grammar.expansion_lengths(left, right, 100)
        assert [len(grammar.expand(np.array([100 + k]), left, right, 100)) for k in range(len(left))] == lengths.tolist()
        assert grammar.expand_all(short, lengths, left, right, 100).tolist() == s.tolist()
        ends = {int(p) for p in np.append(places[1:], n)}
        assert set((np.flatnonzero(last) + 1).tolist()) <= ends  # no rule reaches over an end
        # counted without overlaps, no pair is left that occurs often
        pairs = {}
        inner = [(a, b) for a, b, p in zip(short[:-1].tolist(), short[1:].tolist(), places[1:].tolist(), strict=True) if not last[p - 1]]
        for p in inner:
            pairs[p] = pairs.get(p, 0) + 1
        assert all(c < least or p[0] == p[1] for p, c in pairs.items())


def _want(texts):
    t = packing.WordTokenizer(packing.vocabulary_path()).tokenizer
    out, at = [], 0
    for doc, text in sorted(texts, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.fixture(scope="module")
def texts(spark):
    real = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect()]
    return real + [(-5, None), (9002, ""), (9003, " \t\n"), (9004, "one"), (9005, "a " * 9000), (9010, "İ ﬁ don't 3.14 <|endoftext|> é\x1c b c \x00\x01 ​"),
                   (9011, "long " * 30000), (9012, "x" * 50000), (9013, real[0][1]), (9014, "日本語 テキスト")]


def test_query(spark, texts, tmp_path):
    rows = [(d, t, "clash", 1, 2) for d, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, ids string, start int, part int").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op11_token_files"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(_want(texts))


def test_null_and_repeated_ids(spark, texts):
    rows = [(None, "b c"), (None, "b c"), (3, "x y"), (3, "x y"), (3, "x y"), (2, None)]
    path = grammar.new_path(spark, "tokens")
    grammar.write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, most=4)
    got = grammar.with_starts(grammar.read_shards(spark, path, with_ids=True)).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == _want(rows)
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == 1 for r in got)
    assert len({(r.part, r.shard) for r in got}) > 2  # small shards, still in order


def test_any_stretch_is_decoded_by_itself(spark, texts):
    path = grammar.new_path(spark, "tokens")
    grammar.write_shards(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), path)
    files = [r.content for r in spark.read.format("binaryFile").load(path).collect()]
    r, stored, n = np.random.default_rng(1), 0, 0
    for content in files:
        for s in grammar.shards_of(content):
            whole = s.all_ids()
            for k in range(len(s.doc_ids)):
                ids = whole[s.starts[k] : s.starts[k + 1]]
                assert s.ids(k).tolist() == ids.tolist()
                for _ in range(3):
                    a, b = sorted(r.integers(0, len(ids) + 1, 2).tolist())
                    assert s.ids(k, a, b).tolist() == ids[a:b].tolist()
            n += s.n_ids
            stored += len(s.symbols)
    assert stored < 0.75 * n and sum(map(len, files)) < 2.5 * n  # of four bytes an id
    with pytest.raises(ValueError, match="no shard"):
        list(grammar.shards_of(b"x" * 40))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries()["op11_token_files"](spark, str(tmp_path)).count() == 0
