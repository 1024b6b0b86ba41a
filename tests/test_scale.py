"""What shows in larger tables only, on small ones with such rows."""

import re

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scrubline import resources as R
from scrubline.functions.spans import MARK, joined
from scrubline.operators import addresses, dates, names, patterns, tagger, terms, tokens
from scrubline.plans.config import Job
from scrubline.plans.deidentify import with_findings
from scrubline.sources.readers import dealt
from scrubline.streaming.inspection import inspect_table

SF = "/root/testdata/sf0.001"


def copied(spark, tmp_path, **sql):
    """Tables of sf0.001, some of them changed by SQL."""
    for table in ("orders", "customer"):
        spark.read.parquet(f"{SF}/{table}.parquet").createOrReplaceTempView(table)
    for table, select in sql.items():
        spark.sql(select).write.parquet(f"{tmp_path}/{table}.parquet")
    return str(tmp_path)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def oracle(name, columns, **tables):
    con = duckdb.connect()
    for table, path in tables.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    return sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall())


def test_overlapping_findings_of_documents(spark, tmp_path):
    """An address, a phone number in its end and a long number in the phone's (documents 35283 and 26426 of check_s)."""
    texts = ["ou 71.129.171.132 4815819516090933 q", "+1 (853) 555-7168 x 38.253.197.126 4880761348116108", "user@mail.org or 650-555-1234", "none", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = entry.queries()["deid_documents_full"](spark, str(tmp_path))
    assert rows_of(df.fillna("none")) == sorted(tuple("none" if x is None else x for x in r) for r in oracle("deid_documents_full", df.columns, documents=tmp_path))


def test_named_files_of_long_keys(spark, tmp_path):
    """Keys of six digits are no findings of the job."""
    sf = copied(spark, tmp_path, customer="SELECT c_custkey + 99990 AS c_custkey FROM customer WHERE c_custkey < 40 AND (c_custkey + 99990) % 9 <> 3")
    df = entry.queries()["sink_names"](spark, sf)
    assert rows_of(df) == oracle("sink_names", df.columns, customer=sf)


def test_surrogates_once_a_person(spark):
    """Taken once a person and joined, findings are those of each note by itself."""
    rows = [(i, p, f"{'ZuA' if p % 2 else 'Xa-Zed'} met EDGAR and Kim{p}, not zuab", "ZUA,Edgar Quill" if p % 2 else "Zed,Nora Xa", f"Kim{p} Thorn") for i, p in enumerate([1, 2, 1, 3, 3])]
    df = spark.createDataFrame([*rows, (9, 4, "Kim", None, "")], "id int, person int, note string, full string, kin string")
    fields, person = [(F.col("full"), "L,F"), (F.col("kin"), "F,L")], F.col("person")
    whole = df.select("id", names.known_names(F.col("note"), fields, person, "s", distinct=True).alias("f"))
    persons = df.select("person", "full", "kin").distinct().withColumn("known", names.known_of_person(fields, person, "s"))
    joined = df.join(persons.select("person", "known"), "person").select("id", names.placed(F.col("note"), F.col("known")).alias("f"))
    got = rows_of(joined)
    assert got == rows_of(whole) and sum(len(f) for _, f in got) == 14


def test_a_batch_of_one_file_is_dealt_out(spark, tmp_path):
    """A batch of one row group is searched by as many tasks as there are cores."""
    spark.range(4000).selectExpr("id", "'mail a@b.org ' || id AS note").coalesce(1).write.parquet(f"{tmp_path}/in")
    job = Job.of({"textFields": "note", "textIdFields": "id", "spec": [{"itemName": "contact", "action": "general", "actionParamMap": {"general-email": "[E]"}, "actionParam": "include-types-in-map-only"}]})
    done = inspect_table(spark, f"{tmp_path}/in", "id long, note string", job, f"{tmp_path}/out", f"{tmp_path}/ck", files_a_batch=1)
    found = spark.read.parquet(f"{tmp_path}/out/batch=0")
    assert done.batches == 1 and found.count() == 4000 and len(found.inputFiles()) == spark.sparkContext.defaultParallelism


def test_a_join_is_dealt_out_by_rows(spark):
    rows = spark.range(1000).coalesce(1)
    assert dealt(rows, each=100).rdd.getNumPartitions() == 12 and dealt(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert min(dealt(rows, each=100).rdd.glom().map(len).collect()) > 50


def test_an_address_is_matched_once(spark):
    """The grammar stands in the plan once, and its parts are those of each group by itself."""
    texts = ["12 N Elm St, Apt 4, Salem, Ohio 44460-1234", "PO Box 77, Troy, NY", "Boston, MA 02110\n", "Boston, MA 02110 ", "9 Old Mill Road, New York", "", " ", None,
             f"{MARK}Boston", f"Troy{MARK}, NY", MARK, "no address; at all", "7b West Quarry Ln.", "12 Foo Bar, Troy"]
    df = spark.createDataFrame([(t,) for t in texts], "a string").repartition(1)
    got = df.select("a", addresses.parts_of(F.col("a")).alias("p"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("regexp_(?:replace|extract)", plan)) == 1

    def alone(groups):
        return F.coalesce(*[F.when((x := F.regexp_extract("a", addresses._GRAMMAR, g)) != "", x) for g in groups], F.lit(None).cast("string"))

    each = df.select("a", F.struct(*[alone(g).alias(n) for n, g in addresses._GROUPS.items()]).alias("p"))
    assert got.collect() == each.collect()
    assert got.where("p.city = 'Boston' AND p.zip = '02110'").count() == 2


def test_terms_are_cut_without_spans(spark):
    """A list may be longer than the notes: no spans are made of its terms, and no words go through the joins."""
    given = ["Zox-Ab", "  nil ΟΔΟΣ,\nTAB ", "İx y", "", "--", None, "O'Neil’s Ward-3", "zox-ab"]
    listed = terms.term_keys(spark.createDataFrame([(t,) for t in given], "term string"))
    assert rows_of(listed) == sorted([("zox-ab", 1), ("nil οδος tab", 3), ("İx".lower() + " y", 2), ("o'neil’s ward-3", 2)])
    assert "aggregate(" not in listed._jdf.queryExecution().optimizedPlan().toString().replace("Aggregate [", "")
    notes = spark.createDataFrame([(1, "a ZOX-AB, nil\nΟΔΟΣ tab"), (2, None), (3, "")], "id int, note string")
    got = terms.with_terms(notes, spark.createDataFrame([(t,) for t in given], "term string"), "note")
    assert [[(f.word, f.start, f.end) for f in r.listed] for r in got.orderBy("id").collect()] == [[("ZOX-AB", 2, 8), ("nil\nΟΔΟΣ tab", 10, 22)], [], []]


def test_a_tagger_reads_its_sample_once(spark):
    """The rounds learn from rows that are kept, not from the query behind them."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def asked(text):
        seen.add(1)
        return text

    marked = spark.createDataFrame([(i, f"met Dr. Zed{i} here", [(4, 11 + len(str(i)), "PERSON")]) for i in range(40)],
                                   "id int, text string, spans array<struct<start int, end int, label string>>")
    tagger.learn(marked.withColumn("text", asked("text")), rounds=3)
    assert seen.value <= 3 * 40  # to count them, to keep them and to tell nulls then; no more in any round


def test_kept_findings_are_those_of_the_detectors(spark):
    """What a job computes in projections of their own is what the detectors give in one expression."""
    texts = ["Seen 05/11/1998 and 5-Mar-2001, March 5, 2001 14:02", "a@b.org 650-555-1234 c@d.org", f"{MARK}05/11/1998{MARK} x@y.org MRN: 00123456{MARK}", "", None,
             "chart 12345678, 123-45-6789 a 91 year old, HAR : 77, 10.1.2.3", "Zed met zed and AB-1, 11/1998", "4-jan-2019 4-NOT 12/2019 20190405 201904051200", "on 06/04/80 x"]
    rows = [(i, t, "Zed,Qu" if i % 2 else "AB-1", i % 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, t string, name string, jitter int")
    contact, record = {"general-phone": "[P]", "general-email": "[E]", "000000": "[D]"}, [
        {"itemName": "m", "action": "remove_mrn"}, {"itemName": "a", "action": "remove_age"}, {"itemName": "h", "action": "replace_har"}]
    job = Job.of({"textFields": "t", "textIdFields": "id", "spec": [
        {"itemName": "c", "action": "general", "actionParamMap": contact}, *record,
        {"itemName": "n", "action": "replace_with", "actionParam": "[N]", "fields": "name"},
        {"itemName": "d", "action": "jitter_date_from_field", "actionParam": "[D]", "fields": "jitter"}]})
    got = with_findings(df, job, "t", "f", reference_year=2024)
    t = F.col("t")
    before = joined(patterns.general(t, contact), patterns.mrn(t, "m"), patterns.age(t, "a"), patterns.har(t, "h"),
                    tokens.tokens(t, tokens.token_set([F.col("name")], R.IGNORED_WORDS), "n", "[N]"))
    plain = df.withColumn("b", before).withColumn("f", F.concat("b", dates.dates(t, F.col("jitter"), None, "d", "[D]", F.col("b"), 2024)))
    plain = plain.select("id", F.when(F.length("t") > 0, F.col("f")).alias("f"))
    assert {r.id: r.f for r in got.select("id", "f").collect()} == {r.id: r.f for r in plain.collect()}
    assert set(got.columns) == {*df.columns, "f"}


def test_patterns_are_searched_outside_of_lambdas(spark):
    """A lambda is interpreted: no step of the jobs on notes searches a text in one."""
    for name in ("annotator_labels", "deid_notes"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        searches = [column for column in re.split(r" AS \w+#\d+", plan) if f"{MARK}$0{MARK}" in column]
        assert searches and not [column for column in searches if "lambdafunction" in column]
