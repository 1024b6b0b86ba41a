"""Jobs end to end, configuration, files and streams."""

import json
import re

import pytest
from pyspark.sql import functions as F

from scrubline.functions.spans import find_spans
from scrubline.operators import analytics, external
from scrubline.plans.config import ConfigError, Job, load_jobs, register_action
from scrubline.plans.deidentify import deidentify, inspect
from scrubline.sources import readers, writers
from scrubline.streaming.stream import deidentify_stream, type_counts


def job(*specs, **more):
    return Job.of({"textFields": "note", "textIdFields": "id", "spec": list(specs)} | more)


DATE = {"itemName": "phi_date", "action": "jitter_date_from_field", "actionParam": "[DATE_TESTING]", "fields": "jitter"}


def test_date_jitter_notes(spark):
    cases = [("on June 4, 2019", 1, "on 06/05/2019"), ("on June 4, 2019", 2, "on 06/06/2019"), ("on June 4, 2019", -3, "on 06/01/2019"),
             ("on June 4, 2019", 0, "on [DATE_TESTING]"), ("on Jun 4, 1980", None, "on [DATE_TESTING]"), ("06/04/1980", 1, "06/05/1980"),
             ("Jun 04,1980", 2, "06/06/1980"), ("June 4,     1980", 3, "06/07/1980"), ("June 04 1980", 4, "06/08/1980"), ("10/18/2018 2:02 PM", 1, "10/19/2018")]
    rows = spark.createDataFrame([(str(i), t, j) for i, (t, j, _) in enumerate(cases)], "id string, note string, jitter int")
    got = {r.id: r.TEXT_DEID_note for r in deidentify(rows, job(DATE), reference_year=2024).collect()}
    assert [got[str(i)] for i in range(len(cases))] == [x for *_, x in cases]


def test_tokens_strict_then_minimum(spark):
    specs = ({"itemName": "a", "action": "replace_strictly_with", "actionParam": "[A]", "fields": "phi_a"},
             {"itemName": "w", "action": "replace_minimumlengthword_with", "actionParam": "[W] 3", "fields": "phi_w, gone"})
    rows = spark.createDataFrame([("1", "id SHC 555-66 for Ann Lee, an", "555-66", "Ann an")], "id string, note string, phi_a string, phi_w string")
    assert deidentify(rows, job(*specs)).first().TEXT_DEID_note == "id SHC [A]-[A] for [W] Lee, an"


def test_all_actions_and_invariants(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"), F.col("text").alias("note"))
    j = job({"itemName": "g", "action": "general"}, {"itemName": "n", "action": "general_number"}, {"itemName": "m", "action": "remove_mrn"},
            {"itemName": "d", "action": "jitter_date_randomly", "actionParam": "salt [D]"}, {"itemName": "p", "action": "surrogate_name"},
            {"itemName": "l", "action": "surrogate_address"}, {"itemName": "k", "action": "keep"}, nerEnabled=True, dateJitterSeedField="id")
    for r in deidentify(rows, j).collect():
        assert r.FINDING_CNT_note == len(r.FINDING_note)
        assert all(r.note[f.start : f.end] == f.word for f in r.FINDING_note)
        if not r.FINDING_note:
            assert r.TEXT_DEID_note == r.note
        assert "@" not in r.TEXT_DEID_note or "@" in r.note


def test_one_regex_pass_for_each_pattern(spark):
    rows = spark.createDataFrame([("1", "x")], "id string, note string")
    plan = inspect(rows, job({"itemName": "m", "action": "remove_mrn"}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 7 and "regexp_extract_all" not in plan


def test_empty_missing_and_clean(spark):
    rows = spark.createDataFrame([("1", None), ("2", ""), ("3", "a�b")], "id string, note string")
    got = {r.id: r for r in deidentify(rows, job({"itemName": "h", "action": "replace_har"}, DATE)).collect()}
    assert got["1"].FINDING_CNT_note == 0 and got["1"].TEXT_DEID_note is None and got["2"].FINDING_note is None
    assert got["3"].TEXT_DEID_note == "a\nb"
    assert deidentify(rows.limit(0), job(DATE)).count() == 0


def test_config(tmp_path):
    path = tmp_path / "jobs.yaml"
    path.write_text("name: x\ndeidJobs:\n- jobName: j\n  textFields: 'a, b'\n  textIdFields: id\n  dateJitterRange: 30\n  spec:\n"
                    "  - itemName: m\n    action: remove_mrn\n    actionParam: '[mrn]'\n  - itemName: t\n    action: replace_with\n    actionParam: '[T]'\n    fields: pat_id, wrist\n")
    (j,) = load_jobs(path)
    assert j.text_fields == ("a", "b") and j.specs[1].fields == ("pat_id", "wrist")
    assert load_jobs(path, compat=True)[0].specs[1].fields == ("pat_id", " wrist")
    assert j.with_overrides(text_fields="c", id_fields="k").text_fields == ("c",)
    for bad in ({"itemName": "x", "action": "jitter_date"}, {"itemName": "x", "action": "replace_with"}, {"action": "keep"}):
        with pytest.raises(ConfigError):
            Job.of({"spec": [bad]})
    with pytest.raises(ConfigError):
        load_jobs("nowhere.yaml")
    (tmp_path / "bad.yaml").write_text("a: [x] 3\n")
    with pytest.raises(ConfigError):
        load_jobs(tmp_path / "bad.yaml")


def test_files(spark, tmp_path):
    notes = tmp_path / "notes"
    (notes / "sub").mkdir(parents=True)
    (notes / "n 1.txt").write_bytes(b"mail a@b.org\r\nend\n")
    (notes / "sub" / "n2.txt").write_text("plain")
    df = readers.read_text_folder(spark, str(notes))
    assert {(r.id, r.note) for r in df.collect()} == {("n 1.txt", "mail a@b.org\nend"), ("n2.txt", "plain")}
    (tmp_path / "p.csv").write_text("note_id,person_id\nn2.txt,7\nn2.txt,8\n")
    (tmp_path / "k.csv").write_text('person_id,pat_name,note\n7,"LAST,FIRST",\n')
    joined = readers.with_known(readers.with_person(df, readers.read_csv(spark, str(tmp_path / "p.csv"))), readers.read_csv(spark, str(tmp_path / "k.csv")))
    assert {(r.id, r.person_id, r.pat_name, r.note) for r in joined.collect()} == {("n 1.txt", None, None, "mail a@b.org\nend"), ("n2.txt", "7", "LAST,FIRST", "")}
    result = deidentify(df, job({"itemName": "g", "action": "general"}))
    writers.write_jsonl(result, str(tmp_path / "out"))
    back = {json.loads(r.value)["id"]: json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/DeidNote")).collect()}
    assert back["n 1.txt"]["TEXT_DEID_note"] == "mail [general-email]\nend" and json.loads(back["n 1.txt"]["FINDING_note"])[0]["word"] == "a@b.org"
    writers.write_individual(result, str(tmp_path / "out"))
    assert (tmp_path / "out/individual/n%201.txt").read_text() == "mail [general-email]\nend" and (tmp_path / "out/individual/n2.txt").read_text() == "plain"
    lines = {r.id: json.loads(r.value) for r in writers.annotation_json(writers.annotations(result)).collect()}
    assert lines["n 1.txt"] == {"text": "mail a@b.org\nend", "label": [[5, 12, "EMAIL/URL"]], "id": "n 1.txt"} and lines["n2.txt"]["label"] == []
    writers.write_annotations(result, f"file://{tmp_path}/out")
    assert json.loads((tmp_path / "out/annotator/n%201.txt.json").read_text())["label"] == [[5, 12, "EMAIL/URL"]] and len(list((tmp_path / "out/annotator").iterdir())) == 2
    odd = deidentify(df, job({"itemName": 'a "b" \\c', "action": "remove_mrn"}, {"itemName": "g", "action": "general"})).where("id = 'n2.txt'")
    odd = odd.withColumn("FINDING_note", F.expr("array(named_struct('word','p','start',0,'end',1,'type','a \"b\" \\\\c','replacement','x','found_by','y'))"))
    assert json.loads(writers.annotation_json(writers.annotations(odd)).first().value)["label"] == [[0, 1, 'a "b" \\c']]
    writers.write_stats(analytics.by_type(result), str(tmp_path / "out"), "types")
    assert [r.value for r in spark.read.text(str(tmp_path / "out/types")).collect()] == ["general-email:1"]
    (tmp_path / "words.txt").write_text("b\na\nb\n\n")
    assert sorted(r.word for r in readers.word_list(spark, str(tmp_path / "words.txt")).collect()) == ["a", "b"]
    (tmp_path / "kv.txt").write_text("Ohio,OH\nA, B,C\n")
    assert {(r.key, r.value) for r in readers.key_values(spark, str(tmp_path / "kv.txt"), True).collect()} == {("OH", "Ohio"), ("B", "A")}


def test_external(spark):
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError
        return x

    assert external.retried(flaky, 5, sleep=lambda s: None) == 5 and len(calls) == 3
    rows = spark.createDataFrame([("1", "é X9 b"), ("2", None)], "id string, note string")
    service = lambda texts: [[(i, i + 2, "CODE") for i in [t.find("X9")] if i >= 0] for t in texts]
    got = {r.id: r for r in deidentify(rows, job({"itemName": "k", "action": "keep"}, googleDlpEnabled=True), external=external.detector(service)).collect()}
    assert got["1"].TEXT_DEID_note == "é [CODE] b" and got["1"].FINDING_note[0].found_by == "google-dlp"


def test_external_dates_and_specs(spark):
    import datetime

    service = lambda texts: [[(m.start(), m.end(), "DATE", datetime.date(2019, 6, 4)) for m in re.finditer("June 4", t)] + [(0, 2, "CITY_NAME")] for t in texts]
    j = job({"itemName": "k", "action": "keep"}, googleDlpEnabled=True, googleDlpInfoTypes=[
        {"itemName": "phi_date", "infoTypes": "DATE", "actionParam": "[D]", "fields": "jitter"}, {"itemName": "place", "infoTypes": ["city_name"]}])
    assert j.external_types == ("DATE", "CITY_NAME") and j.external_date_field == "jitter"
    rows = spark.createDataFrame([("1", "at June 4 x", 3), ("2", "at June 4 x", 0), ("3", "at June 4 x", None)], "id string, note string, jitter int")
    got = {r.id: r for r in deidentify(rows, j, external=external.for_job(service, j)).collect()}
    assert {i: r.TEXT_DEID_note for i, r in got.items()} == {"1": "[city name] 06/07/2019 x", "2": "[city name] [D] x", "3": "[city name] [D] x"}
    assert {f.type for f in got["1"].FINDING_note} == {"phi_date", "place"}


def test_own_actions(spark):
    register_action("shout", lambda df, spec, text, earlier: find_spans(text, r"\b[A-Z]{2,}\b", spec.item, spec.params[0], "mine"))
    rows = spark.createDataFrame([("1", "say ABC now")], "id string, note string")
    assert deidentify(rows, job({"itemName": "loud", "action": "shout", "actionParam": "[S]"})).first().TEXT_DEID_note == "say [S] now"
    with pytest.raises(ConfigError):
        register_action("general", None)


def test_external_inspects_long_texts_whole(spark):
    filler = "ab " * 200_000
    text = "é X9 " + filler + "X9 " + filler + "X9"
    service = lambda texts: [[(m.start(), m.end(), "CODE") for m in re.finditer("X9", t)] for t in texts if len(t) <= external.MAX_BYTES]
    found = spark.createDataFrame([(text,)], "t string").select(external.detector(service)(F.col("t")).alias("f")).first().f
    assert [(f.start, f.end, f.word) for f in found] == [(m.start(), m.end(), "X9") for m in re.finditer("X9", text)]
    for t in ("x" * 95, "ab cd " * 16, "one"):
        cut = external.pieces(t, 20, 6)
        assert all(len(p) <= 20 and t[at : at + len(p)] == p for at, p in cut) and {i for at, p in cut for i in range(at, at + len(p))} == set(range(len(t)))


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    rows = spark.createDataFrame([("1", "a@b.org", "2024-01-01 00:10:00"), ("2", "none", "2024-01-01 00:20:00")], "id string, note string, at string")
    rows.withColumn("at", F.to_timestamp("at")).write.parquet(str(source))
    stream = spark.readStream.schema("id string, note string, at timestamp").parquet(str(source))
    j = job({"itemName": "g", "action": "general"})
    q = deidentify_stream(stream, j, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert sorted(json.loads(r.value)["TEXT_DEID_note"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["[general-email]", "none"]
    counts = type_counts(stream, j, "note", "at").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination(120)
    assert [(r["type"], r["count"]) for r in spark.table("counts").collect()] == [("general-email", 1)]
