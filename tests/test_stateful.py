"""Streams that keep their tables as state: several micro-batches, a restart, and batches that are run again."""

import shutil

from pyspark.sql import functions as F

from ledgerwatch.functions import schemas
from ledgerwatch.operators import registry as G
from ledgerwatch.streaming import incremental as I
from ledgerwatch.streaming import stateful as Y

FEED = "id string, name string, registrationDate date, objectives string, _ord int"


def test_registrants_are_added_once(spark, tmp_path):
    feed, out, ck = (str(tmp_path / x) for x in ("feed", "out", "ck"))
    put = lambda *rows: spark.createDataFrame([(*r[:2], None, *r[2:]) for r in rows], FEED).coalesce(1).write.mode("append").parquet(feed)
    stored = spark.createDataFrame([("9", "Stored", None, "name", "before")], I.STORE)

    def run():
        stream = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(feed)
        return sorted((r.id, r.name, r.match) for r in Y.appended(Y.ingest_registrants(stream, ["vape", "cigar"], "t", stored), out, ck).collect())

    put(("1", "Vape again", None, 5), ("1", "Vape House", None, 1), ("2", "Other", "sells CIGARS", 2), ("3", "None", None, 3), (None, "vape", None, 4), ("9", "vape", None, 6))
    first = run()
    assert first == [("1", "Vape House", "name"), ("2", "Other", "objectives")]
    put(("1", "Vape three", None, 1), ("4", "x", "vape", 2))
    put(("3", "None", "cigars now", 1))
    put(("4", "y", "vape", 0))
    assert run() == sorted([*first, ("4", "x", "objectives"), ("3", "None", "objectives")])
    assert run() == run()
    assert sorted((r.id, r.detected_at) for r in Y.state_table(spark, ck, "registrants").collect()) == [("1", "t"), ("2", "t"), ("3", "t"), ("4", "t"), ("9", "before")]


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    """The last micro-batch's commit is lost, as after a crash; the restart runs it from the state before it."""
    feed, out, ck = (str(tmp_path / x) for x in ("feed", "out", "ck"))
    run = lambda: sorted((r.id, r.name) for r in Y.appended(Y.ingest_registrants(spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(feed), ["vape"], "t"), out, ck).collect())
    for k in range(3):
        spark.createDataFrame([(str(k), "vape", None, None, 1), ("0", f"vape {k}", None, None, 2)], FEED).coalesce(1).write.mode("append").parquet(feed)
    want = run()
    last = max((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for crc in (tmp_path / "ck" / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    assert run() == want and len(want) == 3


def people(*names):
    return [(n, "X", None) for n in names]


def test_accreditations_stream(spark, tmp_path):
    landed, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    kinds = f"register_id string, persons {Y.PERSONS}, reported {Y.PERSONS}"
    begun = spark.createDataFrame([("a", people("Old"), people("Seen")), ("e", [], None), ("s", None, people("Seen"))], kinds)

    def night(*rows):
        spark.createDataFrame(rows, Y.SNAPSHOT).coalesce(1).write.mode("append").parquet(landed)
        stream = Y.watch_accreditations(spark.readStream.schema(Y.SNAPSHOT).parquet(landed), begun)
        return sorted((r.register_id, r.surname, r.at) for r in Y.appended(stream, out, ck).collect())

    one = night(("a", 1, True, people("Old", "New", "New", "Seen")), ("e", 1, True, people("First")), ("n", 1, True, people("Base")), ("f", 1, False, people("Bad")), ("s", 1, True, None), (None, 1, True, people("x")))
    assert one == [("a", "New", 1), ("e", "First", 1)]
    # a failed fetch keeps the baseline, so those who were in it aren't new; who goes and comes back was reported; two snapshots of a night
    two = night(("a", 2, False, people()), ("a", 3, True, people("Old", "New")), ("n", 2, True, people("Base", "Late")), ("f", 2, True, people("F")), ("s", 2, True, people("Seen", "S")), ("e", 4, True, people("First", "Third")), ("e", 3, True, people("Second")))
    assert two == sorted([*one, ("n", "Late", 2), ("s", "S", 2), ("e", "Second", 3), ("e", "Third", 4)])
    assert night(("a", 4, True, people("Old", "New", "Seen"))) == two
    assert {r.register_id: len(r.persons) for r in Y.state_table(spark, ck, "baseline").collect()} == {"a": 3, "e": 2, "n": 2, "f": 1, "s": 2}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(str(k % 7), f"p{k % 11}", "x", None if k % 5 == 0 else f"2024-01-{k % 28 + 1:02d}", k) for k in range(300)]
    df = spark.createDataFrame(rows, "register_id string, surname string, first_name string, d string, k int").withColumn("start_date", F.col("d").cast("date")).drop("d")
    previous, current, seen = df.filter("k < 150"), df.filter("k % 3 <> 0"), df.filter("surname = 'p3'")
    base = spark.createDataFrame([(str(k),) for k in range(5)], "register_id string")
    fetched = spark.createDataFrame([(str(k), k != 2) for k in range(7)], "register_id string, ok boolean")
    want = {tuple(r) for r in I.detect_accreditations(previous, current, seen, base, fetched).select("register_id", "surname", "first_name", "start_date").collect()}
    person = F.struct("surname", "first_name", "start_date")
    listed = lambda d, name: d.groupBy("register_id").agg(F.collect_set(person).alias(name))
    begun = base.join(listed(previous, "persons"), "register_id", "left").select("register_id", F.coalesce("persons", F.array().cast(Y.PERSONS)).alias("persons")).join(listed(seen, "reported"), "register_id", "full")
    fetched.join(listed(current, "persons"), "register_id", "left").selectExpr("register_id", "1L AS at", "ok", "persons").write.parquet(str(tmp_path / "in"))
    stream = Y.watch_accreditations(spark.readStream.schema(Y.SNAPSHOT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), begun)
    assert want == {tuple(r)[:4] for r in Y.appended(stream, str(tmp_path / "out"), str(tmp_path / "ck")).collect()}


LIVE = "k string, people int, detail_error string, meetings int, meetings_error string, other int"
GROUPS = {"detail": ["people"], "meetings": ["meetings"]}


def test_live_rows_by_groups(spark, tmp_path):
    current = spark.createDataFrame([("a", 1, None, 5, None, 7), ("z", 9, None, None, None, None)], LIVE)
    landed, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    kinds = LIVE.replace(", other int", ", n int")

    def run(rows):
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(landed)
        Y.appended(Y.upsert_live(spark.readStream.schema(kinds).parquet(landed), current, "k", GROUPS, order="n"), out, ck)
        return sorted(map(tuple, Y.state_table(spark, ck, "live").collect()))

    first = run([("a", None, "down", None, "down", 1), ("b", 2, None, 3, None, 1), (None, 1, None, 1, None, 1)])
    update = spark.createDataFrame([("a", None, "down", None, "down"), ("b", 2, None, 3, None)], LIVE.replace(", other int", ""))
    assert first == sorted(map(tuple, G.merge_live(current, update, "k", GROUPS).collect())) == [("a", 1, "down", None, "down", 7), ("b", 2, None, 3, None, None), ("z", 9, None, None, None, None)]
    assert run([("a", 4, None, 6, None, 2), ("a", 3, None, 5, None, 1), ("b", 8, "down", 9, None, 1)]) == [("a", 4, None, 6, None, 7), ("b", 2, "down", 9, None, None), ("z", 9, None, None, None, None)]
    changed = spark.read.parquet(out)
    assert changed.count() == 4 and changed.filter("k = 'z'").count() == 0  # only keys that are named are read and written


def test_a_writer_of_one_group(spark, tmp_path):
    current = spark.createDataFrame([("a", 1, None, 5, None, 7)], LIVE)
    spark.createDataFrame([("a", 6, None)], "k string, meetings int, meetings_error string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, meetings int, meetings_error string").parquet(str(tmp_path / "in"))
    got = Y.appended(Y.upsert_live(stream, current, "k", GROUPS), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert [tuple(r) for r in got.collect()] == [("a", 1, None, 6, None, 7)]
    shutil.rmtree(tmp_path / "out")


def test_registrant_schema(spark):
    assert set(spark.createDataFrame([], FEED).columns) >= set(spark.createDataFrame([], schemas.REGISTRANT).columns)
