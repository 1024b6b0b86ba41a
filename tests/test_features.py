"""Dictionaries, term lists, the tagger, files, whole jobs and resumable inspection."""

import gzip
import json
import pickle
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from scrubline import queries as core
from scrubline.functions.hashing import permuted
from scrubline.functions.spans import FINDINGS, find_spans
from scrubline.operators import addresses, dictionary, names, patterns, tagger, terms
from scrubline.operators.ner import GazetteerBackend
from scrubline.operators.skew import split_join
from scrubline.plans.config import Job, register_action
from scrubline.plans.deidentify import deidentify, inspect
from scrubline.plans.run import read_result, run
from scrubline.sources import files, readers, writers
from scrubline.streaming.inspection import inspect_table


def job(*specs, **more):
    return Job.of({"textFields": "note", "textIdFields": "id", "spec": list(specs)} | more)


GENERAL = {"itemName": "g", "action": "general"}


# --- e-mail in linear time

def test_email_by_run_is_the_pattern(spark):
    r = random.Random(4)
    parts = [*"ab1_@@@..-(),;<>́", " ", "\n", "é", "ß", "x.org", "a@b.c", "@", "ab", " ", "日", "٣", "\t", "@.", ".@", "a@.b", "\U0001f600"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 16))) for _ in range(6000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    slow = find_spans(F.col("t"), patterns.EMAIL, "general-email", "E", "deid-general")
    got = rows.select("t", slow.alias("slow"), patterns.find(F.col("t"), patterns.EMAIL, "general-email", "E", "deid-general").alias("fast")).collect()
    for x in got:
        assert x.slow == x.fast, (x.t, x.slow, x.fast)
    assert sum(len(x.slow) for x in got) > 500


def test_a_megabyte_without_a_blank(spark):
    long = "aB9/" * 260_000
    texts = [long + "@", "@" + long, long + "@" + long, "." * 500_000 + "@" * 500_000, "a@b.c" + "@." * 400_000, long + "a@b.org"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    rows.select(patterns.general(F.lit("warm a@b.org")).alias("f")).collect()
    began = time.time()
    got = [x.f for x in rows.select(patterns.find(F.col("t"), patterns.EMAIL, "e", "E", "x").alias("f")).collect()]
    assert time.time() - began < 5 and [len(f) for f in got] == [0, 0, 0, 0, 1, 1]


# --- files

ODD = ["a/b", "a_b", "a b", None, "null", "..", ".", "_x", ".x", "", "a%2Fb", "%null", "é/ü", "x" * 400, "x" * 401, "a+b", "A b"]


def test_names_differ_and_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ODD)], "id string, note string")
    got = rows.select("id", files.file_name(F.col("id")).alias("name")).withColumn("back", files.id_of(F.col("name"))).collect()
    assert len({r.name for r in got}) == len(ODD) and all("/" not in r.name and r.name[0] not in "._" and len(r.name) < 220 for r in got)
    assert all(r.back == r.id for r in got if r.id is None or len(r.id) < 300)
    writers.write_individual(deidentify(rows, job(GENERAL)), str(tmp_path))
    assert sorted(r.note for r in readers.read_text_folder(spark, str(tmp_path / "individual")).collect()) == sorted(f"text {k}" for k in range(len(ODD)))
    assert not list((tmp_path / "individual").glob("_staged*"))


def test_repeated_ids(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), (None, "4"), (None, "5")], "id string, note string")
    result = deidentify(rows, job(GENERAL))
    with pytest.raises(ValueError, match="more than one row"):
        writers.write_individual(result, str(tmp_path / "x"))
    assert not (tmp_path / "x").exists()
    writers.write_individual(result, str(tmp_path / "y"), repeats="number")
    assert sorted(p.read_text() for p in (tmp_path / "y/individual").iterdir()) == list("12345")


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    fail = F.when(F.col("id") == 57, F.raise_error(F.lit("broken"))).otherwise(F.lit("x"))
    rows = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("name"), fail.cast("string").alias("value"))
    with pytest.raises(Exception, match="broken"):
        files.write_each(rows, str(tmp_path / "out"))
    assert not list((tmp_path / "out").iterdir())


def test_the_driver_holds_no_names_of_files(spark, tmp_path):
    """Neither what tasks tell the commit nor the reading of a folder grows with its files."""
    n = 3 * files.EACH // 2
    batch = pa.RecordBatch.from_pydict({"name": [f"n{i}" for i in range(n)], "value": ["x"] * n})
    (tmp_path / "out").mkdir()
    writer = files.EachFile({"path": f"file://{tmp_path}/out", "suffix": ".txt"}).writer(spark.range(1).selectExpr("'' AS name", "'' AS value").schema, False)
    told = [writer.write(iter([batch])), writer.write(iter([])), None]
    assert len(pickle.dumps(told)) < 1000
    writer.commit(told)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(f"n{i}.txt" for i in range(n))
    back = readers.read_text_folder(spark, str(tmp_path / "out"))
    assert "FileScan" not in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == n and back.rdd.getNumPartitions() > 1


def test_a_folder_of_texts(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / ".hidden").mkdir()
    for name, content in {"a%2Fb+c": b"x\r\ny\rz\n", "a/e": b"", "a/b/n.gz": gzip.compress("é".encode()), "a/plain.gz": b"no", "_x": b"-", ".y": b"-", ".hidden/z": b"-", "_k=1": b"k"}.items():
        (tmp_path / name).write_bytes(content)
    got = {r.id: r.note for r in readers.read_text_folder(spark, str(tmp_path)).collect()}
    assert got == {"a%2Fb+c": "x\ny\nz", "e": "", "n.gz": "é", "plain.gz": "no", "_k=1": "k"}
    assert [tuple(r) for r in readers.read_text_folder(spark, str(tmp_path / "a%2Fb+c")).collect()] == [("a%2Fb+c", "x\ny\nz")]


def test_annotations_of_a_crowded_note(spark):
    n = 3000
    found = F.transform(F.sequence(F.lit(0), F.lit(2 * n - 1)), lambda i: F.struct(F.lit("w").alias("word"), (i % n).cast("int").alias("start"), (i % n + 1).cast("int").alias("end"),
                        F.concat(F.lit("t"), F.floor(i / n)).alias("type"), F.lit("x").alias("replacement"), F.lit("y").alias("found_by")))
    rows = spark.range(1).select(F.lit("a").alias("id"), F.lit("z" * n).alias("note"), found.cast(FINDINGS).alias("FINDING_note"))
    began = time.time()
    label = writers.annotations(rows).first().label
    assert [(x.start, x.label) for x in label] == [(i, "t1") for i in range(n)] and time.time() - began < 20


# --- whole jobs

def test_one_search_for_all_outputs(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("long")
    def counted(t):
        seen.add(len(t))
        return t.str.len()

    register_action("find_zz", lambda df, spec, text, earlier: F.when(counted(text) > 0, find_spans(text, r"\bzz\w+", spec.item, "[Z]", "own-detector")))
    rows = spark.createDataFrame([(str(i), f"zz{i} mail a{i}@b.org" if i % 4 else None) for i in range(40)], "id string, note string")
    j = job({"itemName": "zed", "action": "find_zz"}, GENERAL, annotatorOutputEnabled=True)
    counts = run(rows, j, str(tmp_path), files=True)
    assert seen.value <= 40  # no row is searched twice, though counts had to be completed from the lines
    assert counts.types == {"zed": 30, "general-email": 30} and counts.detectors == {"own-detector": 30, "deid-general": 30} and counts.complete
    assert counts.counters == {"total_stage1": 0, "total_stage2": 60, "zero_change": 10} and counts.stages == {1: (40, 0, 0, 0), 2: (40, 60, 0, 2)}
    assert len(list((tmp_path / "individual").iterdir())) == 40 and len(list((tmp_path / "annotator").iterdir())) == 40
    assert json.loads((tmp_path / "annotator/5.json").read_text())["label"] == [[0, 3, "zed"], [9, 17, "EMAIL/URL"]]
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/statsPhiType").collect()) == ["general-email:30", "zed:30"]


def test_lines_are_packed(spark, tmp_path):
    """A packed run has the rows and counts of a plain one on a fraction of the disk; the query packs its lines."""
    notes = spark.range(0, 2000, 1, 2).selectExpr("cast(id as string) AS id", "concat('mail a', id, '@b.org or 650-555-', lpad(id, 4, '0')) AS note")
    j = job(GENERAL)
    both = [run(notes, j, str(tmp_path / kind), compression=codec) for kind, codec in (("plain", None), ("packed", "gzip"))]
    rows = [sorted(map(str, read_result(spark, str(tmp_path / kind), j).collect())) for kind in ("plain", "packed")]
    assert both[0] == both[1] and rows[0] == rows[1] and len(rows[0]) == 2000
    size = {kind: sum(p.stat().st_size for p in (tmp_path / kind / "DeidNote").glob("part-*")) for kind in ("plain", "packed")}
    assert size["packed"] < size["plain"] / 4
    query = core.queries()["one_pass_outputs"](spark, "/root/testdata/sf0.001")
    written = [f for f in query.inputFiles() if "/DeidNote/" in f]
    assert written and all(f.endswith(".gz") for f in written)


def test_two_fields_and_no_rows(spark, tmp_path):
    two = job(GENERAL, textFields="note, more")
    rows = spark.createDataFrame([("1", "a@b.org", "c@d.org 10.1.2.3"), ("2", None, "x")], "id string, note string, more string")
    counts = run(rows, two, str(tmp_path / "a"))
    assert counts.types == {"general-email": 2, "general-ip": 1} and counts.stages[2] == (4, 3, 0, 2) and counts.counters["zero_change"] == 2
    empty = run(rows.limit(0), two, str(tmp_path / "b"))
    assert empty.types == {} and empty.stages[2] == (0, 0, 0, 0)


# --- dictionaries and surrogates

def test_permutations(spark):
    for n in (1, 2, 3, 48, 240, 400):
        got = spark.range(n).select(permuted(F.col("id"), n, F.lit("a")).alias("a"), permuted(F.col("id"), n, F.lit("b")).alias("b")).collect()
        assert sorted(r.a for r in got) == list(range(n)) == sorted(r.b for r in got)
        if n > 3:
            assert [r.a for r in got] != [r.b for r in got]


def test_names_of_a_person_stay_apart(spark):
    full = ",".join(["Hartwood", "Bridget"] + [f"nm{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(10)])
    text = full.replace(",", " met ")
    df = spark.createDataFrame([(text, full, p) for p in "xyz"] + [(text + " again", full, "x")], "t string, f string, p string")
    found = df.select("p", names.known_names(F.col("t"), [(F.col("f"), "L,F,L")], F.col("p"), "s", distinct=True).alias("f")).collect()
    for r in found:
        new = {x.word.lower(): x.replacement for x in r.f}
        assert len(set(new.values())) == len(new) == 122 and not {v.lower() for v in new.values()} & set(new)
    first, *_, last = found
    assert {x.word: x.replacement for x in first.f} == {x.word: x.replacement for x in last.f} and found[0].f != found[1].f


def test_dictionary_table(spark):
    import collections

    r = random.Random(2)
    words = sorted({"".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(4)).capitalize() for _ in range(150_000)})[:100_000]
    entries = spark.createDataFrame([("L", w, 1000 if k % 100 == 0 else 1) for k, w in enumerate(words)] + [("F", w, 1) for w in words[::50]], "sex string, name string, weight long")
    table = dictionary.name_table(entries)
    asked = spark.createDataFrame([(p, w, s) for p in range(400) for w, s in (("Smith", "L"), ("Bob", "F"), (None, "L"), ("X", "M"))], "person int, word string, sex string")
    got = dictionary.look_up(asked, table, "s").collect()
    assert len(got) == 1600 and all((x.surrogate is None) == (x.word is None or x.sex == "M") for x in got)
    known = dict.fromkeys(words)
    assert all(x.surrogate in known and x.surrogate[0] != x.word[0] for x in got if x.surrogate)
    common = {w for k, w in enumerate(words) if k % 100 == 0}
    share = sum(x.surrogate in common for x in got if x.sex == "L" and x.word) / 400
    assert 0.85 < share < 0.97  # a hundredth of the names with ten elevenths of the weight
    assert max(collections.Counter((x.person, x.word, x.sex) for x in got).values()) == 1
    with pytest.raises(dictionary.DictionaryError, match="more than once"):
        dictionary.name_table(spark.createDataFrame([("L", "Ab", 1), ("L", "aB", 1)], "sex string, name string, weight long"))
    with pytest.raises(dictionary.DictionaryError, match="weight"):
        dictionary.name_table(spark.createDataFrame([("L", "Ab", 0)], "sex string, name string, weight long"))


def test_dictionary_in_a_job(spark):
    entries = spark.createDataFrame([(s, f"{a}{b}{c}", 1) for s in "LF" for a in "BCD" for b in "ae" for c in ("x", "y", "z")], "sex string, name string, weight long")
    known = spark.createDataFrame([("p1", "Foo,Ann", "F"), ("p2", "Bar,Eve", "F")], "person_id string, pat_name string, sex string")
    known = dictionary.surrogates_of(known, [("pat_name", "L,F")], dictionary.name_table(entries, 2), "s")
    rows = spark.createDataFrame([("1", "p1", "Ann FOO came"), ("2", "p1", "Foo"), ("3", "p2", "Eve Bar")], "id string, person_id string, note string")
    j = job({"itemName": "n", "action": "surrogate_name", "actionParamMap": {"format": "L,F", "surrogates": "surrogates"}, "fields": "pat_name"})
    got = {r.id: r for r in deidentify(readers.with_known(rows, known), j).collect()}
    new = {f.word.lower(): f.replacement for r in got.values() for f in r.FINDING_note}
    assert set(new) == {"ann", "foo", "eve", "bar"} and all(len(v) == 3 and v[0] in "BCD" for v in new.values()) and new["bar"][0] != "B"
    assert got["2"].TEXT_DEID_note == new["foo"]


# --- addresses

ADDRESSES = {
    "Boston, MA 02110": {"city": "Boston", "state": "MA", "zip": "02110"}, "Boston": {"city": "Boston"}, "02110": {"zip": "02110"}, "New York, New York": {"city": "New York", "state": "New York"},
    "12 N. Main St., Foo Bay, CA 94301-1234": {"number": "12", "compass": "N", "street": "Main", "kind": "St", "city": "Foo Bay", "state": "CA", "zip": "94301-1234"},
    "568 Tramway, Palo Alto CA": {"number": "568", "street": "Tramway", "city": "Palo Alto", "state": "CA"}, "Elm Street": {"street": "Elm", "kind": "Street"},
    "1600 Pennsylvania Avenue Apt 4B, Troy": {"number": "1600", "street": "Pennsylvania", "kind": "Avenue", "unit": "Apt 4B", "city": "Troy"},
    "P.O. Box 77, Salem, Ohio 44460": {"box": "P.O. Box 77", "city": "Salem", "state": "Ohio", "zip": "44460"}, "MA 02110": {"state": "MA", "zip": "02110"}, "": {}, "???": {},
}


def test_address_parts(spark):
    rows = spark.createDataFrame([(a,) for a in ADDRESSES], "a string")
    got = rows.select("a", addresses.parts_of(F.col("a")).alias("own"), addresses.surrogate_like(F.col("a"), F.lit("p"), "s").alias("new"))
    for r in got.withColumn("parts", addresses.parts_of(F.col("new"))).collect():
        assert {k: v for k, v in r.own.asDict().items() if v} == ADDRESSES[r.a], r
        if ADDRESSES[r.a]:
            assert {k for k, v in r.parts.asDict().items() if v} == set(ADDRESSES[r.a]), r


def test_known_addresses_without_compass_or_type(spark):
    known = addresses.Known(F.lit("12 N Main St"), None, F.lit("Foo Bay"), F.lit("94301"), F.lit("CA"))
    rows = spark.createDataFrame([("at 12 Main, Foo Bay",), ("at 12 north main street, Foo Bay CA",), ("at 12 Maine Rd",)], "t string")
    got = [[f.word for f in r.f] for r in rows.select(addresses.known(F.col("t"), known, F.lit("p"), "s").alias("f")).collect()]
    assert got[0][0] == "12 Main, Foo Bay" and got[1][0] == "12 north main street, Foo Bay CA" and got[2] == []


# --- the tagger

def _texts(r, n, held):
    """Notes with persons and places in many settings, and capitals that are neither; held: of which names."""
    part = lambda k: "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(k)).capitalize()
    own = [part(r.randint(2, 4)) for _ in range(400)]
    name = lambda: r.choice(own) + ("x" if held else "n")
    out = []
    for i in range(n):
        p, q, c = name() + (" " + name() if r.random() < 0.6 else ""), name(), name() + r.choice(["ton", " Bay", "ville"])
        pieces = r.choice([
            ["Patient ", (p, "PERSON"), " was seen by Dr. ", (q, "PERSON"), " in ", (c, "LOCATION"), " on Monday."], ["Mrs. ", (q, "PERSON"), " lives near ", (c, "LOCATION"), " and takes Aspirin."],
            ["On Friday ", (p, "PERSON"), " called the Clinic."], ["Moved from ", (c, "LOCATION"), " to ", (q + "ton", "LOCATION"), " with wife ", (p, "PERSON"), "."],
            ["Chest X Ray and Blood Test were normal, Follow Up in May."], ["Refer to ", (p, "PERSON"), ", Cardiology Department."], ["Asthma since March, Alice Hospital informed."],
            ["Spoke with ", (p, "PERSON"), " and ", (q, "PERSON"), " at ", (c, "LOCATION"), " General."]])
        text, spans = "", []
        for x in pieces:
            if isinstance(x, tuple):
                spans.append((len(text), len(text) + len(x[0]), x[1]))
            text += x if isinstance(x, str) else x[0]
        out.append((str(i), text, spans))
    return out


def _f1(found, want):
    hit = sum(len(set(f) & set(w)) for f, w in zip(found, want, strict=True))
    return 2 * hit / (sum(map(len, found)) + sum(map(len, want)))


def test_tagger_knows_names_it_has_not_seen(spark):
    r = random.Random(9)
    train, test = _texts(r, 1200, False), _texts(r, 300, True)
    schema = "id string, text string, spans array<struct<start:int,end:int,label:string>>"
    marked = spark.createDataFrame([*train, ("n", None, []), ("m", "", None)], schema)
    weights = tagger.learn(marked)
    again = tagger.learn(marked.repartition(7), rounds=tagger.ROUNDS)
    assert (weights.features == again.features).all() and (weights.moves == again.moves).all()
    backend = tagger.TaggerBackend(spark, weights)
    rows = spark.createDataFrame(test, schema)

    def spans(b):
        got = {x.id: x for x in rows.select("id", b.persons(F.col("text")).alias("p"), b.places(F.col("text")).alias("l")).collect()}
        return [[(f.start, f.end, f.type.removeprefix("ner-")) for f in [*got[i].p, *got[i].l]] for i, *_ in test]

    want = [s for *_, s in test]
    learned, listed = _f1(spans(backend), want), _f1(spans(GazetteerBackend()), want)
    print("F1", learned, "list", listed)
    assert learned > 0.93 and learned > listed + 0.3
    j = job({"itemName": "n", "action": "surrogate_name"}, {"itemName": "a", "action": "surrogate_address"}, nerEnabled=True)
    one = spark.createDataFrame([("1", "Patient Zorax was seen by Dr. Vumix in Kelatonville on Monday."), ("2", None)], "id string, note string")
    got = {x.id: x for x in deidentify(one, j, ner=backend).collect()}
    assert "Zorax" not in got["1"].TEXT_DEID_note and "Vumix" not in got["1"].TEXT_DEID_note and got["1"].TEXT_DEID_note.endswith("on Monday.")


def test_a_tagger_learns_from_all_texts(spark, monkeypatch):
    """Every marked text of the query is learned from, in parts of bounded size."""
    kept = []
    monkeypatch.setattr(tagger, "_kept", lambda rows, f=tagger._kept: kept.append(f(rows)) or kept[-1])
    monkeypatch.setattr(tagger, "EACH", 500)
    sf = "/root/testdata/sf0.01"
    core.queries()["tagged_names"](spark, sf)
    sizes = [r.n for r in kept[0].select(F.size("texts").alias("n")).collect()]
    assert sum(sizes) == spark.read.parquet(f"{sf}/orders.parquet").where("o_custkey % 2 = 0").count() > 4000
    assert len(sizes) > tagger.PARTS and max(sizes) < 2 * 500


def test_many_texts_at_once_are_as_one_by_one():
    r = random.Random(4)
    marked = [tagger.gold(t, spans) for _, t, spans in [*_texts(r, 300, False), ("a", "", []), ("b", ".", []), ("c", "É_ß İx O’Neil-x. Dr. J. Boston ALL ’9", [])]]
    for words, _ in marked[-40:]:
        low = ["<s>", "<s>", *(w.lower() for w in words), "</s>", "</s>"]
        shape = ["<s>", "<s>", *map(tagger._shape, words), "</s>", "</s>"]
        named = [[
            "b", "w=" + low[i], "s=" + shape[i], "e=" + low[i][-3:], "a=" + low[i][:2], "p=" + low[i - 1], "n=" + low[i + 1], "pp=" + low[i - 2], "ps=" + shape[i - 1] + shape[i],
            "ns=" + shape[i] + shape[i + 1], "pn=" + low[i - 1] + "|" + shape[i] + "|" + low[i + 1], "ppp=" + low[i - 2] + "|" + low[i - 1] + "|" + shape[i],
            f"f={low[i] in tagger._FIRST}{low[i - 1] in tagger._FIRST}{shape[i][0]}", f"l={low[i] in tagger._PLACES}{shape[i][0]}"] for i in range(2, len(words) + 2)]
        assert tagger.features([words]).tolist() == [[zlib.crc32(f.encode()) % tagger.SIZE for f in x] for x in named]
    k = len(tagger.TAGS)
    zero = tagger.Weights(np.zeros((tagger.SIZE, k)), np.zeros((k + 1, k)))
    one = tagger.Weights(zero.features.copy(), zero.moves.copy())
    for words, tags in marked:  # the same pass, a text at a time
        if words:
            at = tagger.features([words])
            guess = tagger.best_path(one.features[at].sum(1), one.moves + tagger.allowed())
            for t, (g, bad) in enumerate(zip(tags, guess, strict=True)):
                np.add.at(one.features, (at[t], g), 1)
                np.add.at(one.features, (at[t], bad), -1)
                before = (tags[t - 1], guess[t - 1]) if t else (k, k)
                one.moves[before[0], g] += 1
                one.moves[before[1], bad] -= 1
    end, _ = tagger._round(marked, zero)
    changed = np.concatenate([one.features.ravel(), one.moves.ravel()])
    assert {i: d for i, d in end.items() if d} == {int(i): changed[i] for i in np.flatnonzero(changed)}
    texts = [t for _, t, _ in _texts(r, 50, True)] + ["", "?", ""]
    assert one.spans(texts) == [one.spans([t])[0] for t in texts] and any(one.spans(texts))
    cut = [[w for *_, w in tagger.tokens(t)] for t in texts if t]
    emitted = [one.features[tagger.features([c])].sum(1) for c in cut]
    tags = tagger.best_paths(np.concatenate(emitted), np.array([len(c) for c in cut]), one.moves + tagger.allowed())
    assert tags.tolist() == [t for e in emitted for t in tagger.best_path(e, one.moves + tagger.allowed())]


def test_best_path_is_the_best():
    import itertools

    import numpy as np

    r = np.random.default_rng(1)
    for n in (1, 2, 4):
        e, m = r.normal(size=(n, 5)), r.normal(size=(6, 5)) + tagger.allowed()
        score = lambda p: e[range(n), p].sum() + m[-1, p[0]] + sum(m[a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert tuple(tagger.best_path(e, m)) == max(itertools.product(range(5), repeat=n), key=lambda p: score(list(p)))


# --- lists of terms, skew

def test_a_million_terms(spark):
    listed = spark.range(1_000_000).select(F.concat(F.lit("qx"), "id", F.when(F.col("id") % 3 == 0, F.lit(" two  Words")).otherwise(F.lit(""))).alias("term"))
    listed = listed.union(spark.createDataFrame([("the",), ("Foo-bar",), (None,), (" ,; ",), ("the",)], "term string"))
    texts = ["QX3, two words and qx4 qx6 the end", "the the the", None, "", "foo-bar foo bar", "qx3 two", "the the the"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, note string")
    got = {r.id: [(f.word, f.start) for f in r.listed] for r in terms.with_terms(rows, listed, "note").collect()}
    assert got == {0: [("QX3, two words", 0), ("qx4", 19), ("the", 27)], 1: [("the", 0), ("the", 4), ("the", 8)], 2: [], 3: [], 4: [("foo-bar", 0)], 5: [], 6: [("the", 0), ("the", 4), ("the", 8)]}
    assert [r.listed for r in terms.with_terms(rows, listed.limit(0), "note").collect()] == [[]] * 7


def test_heavy_keys_are_dealt_out(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 5000).alias("k"))
        right = spark.range(4000).select(F.col("id").alias("r"), (F.col("id") * 10).alias("v"))
        out = split_join(left, right, [("k", "r")])
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert out.count() == 40_000 and max(r["count"] for r in sizes) < 15_000  # one key has 20 000
        plain = left.join(right, left.k == right.r, "left").select("id", "k", "v")
        assert out.select("id", "k", "v").exceptAll(plain).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


# --- inspection

def test_inspection_goes_on(spark, tmp_path):
    rows = spark.range(60).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("mail x"), "id", F.lit("@b.org")).alias("note"))
    rows.repartition(6).write.parquet(f"{tmp_path}/in")
    j = job(GENERAL)
    calls = []

    def stop(number):
        calls.append(number)
        if len(calls) in (2, 4):
            raise RuntimeError("stopped")

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            inspect_table(spark, f"{tmp_path}/in", "id string, note string", j, f"{tmp_path}/out", f"{tmp_path}/cp", 1, stop)
    inspect_table(spark, f"{tmp_path}/in", "id string, note string", j, f"{tmp_path}/out", f"{tmp_path}/cp", 1)
    clean = inspect(rows, j)
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert got.count() == 60 and got.exceptAll(clean).count() == 0
    done = inspect_table(spark, f"{tmp_path}/in", "id string, note string", j, f"{tmp_path}/out", f"{tmp_path}/cp", 1)
    assert done.rows == 0


# --- lists of a job

def test_countries_and_ignored_words(spark, tmp_path):
    assert len(addresses.country_names()) > 240 and {"Bolivia", "Fiji", "Canada", "Czechia"} <= set(addresses.country_names())
    (tmp_path / "words.txt").write_text("Foo\n\nbar\n")
    spec = {"itemName": "n", "action": "replace_with", "actionParam": "[N]", "fields": "name"}
    rows = spark.createDataFrame([("1", "foo bar baz the", "Foo bar,baz the")], "id string, note string, name string")
    assert deidentify(rows, job(spec, ignoreWordsFile=str(tmp_path / "words.txt"))).first().TEXT_DEID_note == "foo bar [N] [N]"
    assert deidentify(rows, job(spec, ignoreWords="baz")).first().TEXT_DEID_note == "[N] [N] baz [N]"
    assert deidentify(rows, job(spec)).first().TEXT_DEID_note == "[N] [N] [N] the"


def test_known_values_of_a_stream(spark, tmp_path):
    spark.createDataFrame([("1", "p", "Ann Lee came"), ("2", None, "none")], "id string, person_id string, note string").write.parquet(f"{tmp_path}/in")
    known = spark.createDataFrame([("p", "Lee")], "person_id string, pat_name string")
    rows = readers.with_known(spark.readStream.schema("id string, person_id string, note string").parquet(f"{tmp_path}/in"), known)
    j = job({"itemName": "n", "action": "replace_with", "actionParam": "[N]", "fields": "pat_name"})
    q = deidentify(rows, j).writeStream.format("memory").queryName("known_stream").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.id: r.TEXT_DEID_note for r in spark.table("known_stream").collect()} == {"1": "Ann [N] came", "2": "none"}
