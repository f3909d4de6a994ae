"""Merges, expectations, files, versioned tables and streams."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.operators import link, merge, quality
from gazetta.session import shared_dir, work_path
from gazetta.sources import files, tables
from gazetta.streaming import keyed


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "VERIFY_REQUIRED", 20), (3, None, 30)], "id int, name string, n int"
    )


@pytest.fixture
def updates(spark):
    return spark.createDataFrame(
        [(1, None, 11, 1), (2, "b", 21, 1), (2, "bb", 22, 2), (4, "d", None, 1)], "id int, name string, n int, seq int"
    )


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_upsert(target, updates):
    out = merge.upsert(target, updates, ["id"], ["seq"])
    want = {(1, None, 11), (2, "bb", 22), (3, None, 30), (4, "d", None)}
    assert as_set(out) == want
    assert as_set(merge.upsert(out, updates, ["id"], ["seq"])) == want  # again: no change


def test_upsert_keeps_columns_not_given(target, updates):
    out = merge.upsert(target, updates.select("id", "n", "seq"), ["id"], ["seq"])
    assert as_set(out) == {(1, "a", 11), (2, "VERIFY_REQUIRED", 22), (3, None, 30), (4, None, None)}


def test_insert_only(target, updates):
    new = merge.insert_only(target, updates, ["id"], ["seq"])
    assert as_set(new) == {(4, "d", None, 1)}
    grown = target.unionByName(new.drop("seq"))
    assert merge.insert_only(grown, updates, ["id"], ["seq"]).isEmpty()  # twice is once
    assert tuple(merge.insert_report(target, updates, ["id"]).first()) == (1, 3)


def test_patch_non_null(target, updates):
    out = merge.patch_non_null(target, updates, ["id"], ["seq"])
    assert as_set(out) == {(1, "a", 11), (2, "bb", 22), (3, None, 30)}


def test_fill_gaps(spark, target):
    upd = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "n/a", 5)], "id int, name string, n int")
    stamp = ("at", F.lit("2024-01-01").cast("date"))
    base = target.withColumn("at", F.lit(None).cast("date"))
    out = {r["id"]: r for r in merge.fill_gaps(base, upd, ["id"], always=["n"], stamp=stamp).collect()}
    assert [out[i]["name"] for i in (1, 2, 3)] == ["a", "y", None]
    assert [out[i]["n"] for i in (1, 2, 3)] == [1, 20, 5]
    assert all(out[i]["at"] == dt.date(2024, 1, 1) for i in (1, 2, 3))
    same = merge.fill_gaps(base, base.select("id", "name"), ["id"], stamp=stamp)
    assert {r["at"] for r in same.collect()} == {None}
    kept = merge.fill_gaps(base, spark.createDataFrame([(3, "z")], "id int, name string"), ["id"], null_is_gap=False)
    assert kept.filter("id = 3").first()["name"] is None


def test_natural_key_upsert(spark):
    tgt = spark.createDataFrame([("S-007", "https://a.com", "old", "x")], "sid string, url string, note string, other string")
    upd = spark.createDataFrame(
        [("A.com/", None, 1), ("b.com", "new", 3), ("https://www.B.com", "later", 4), ("c.com", "c", 2), ("", "no", 5)],
        "url string, note string, seen long",
    )
    from gazetta.functions.urls import norm_url

    out = as_set(merge.natural_key_upsert(tgt, upd, "sid", "url", norm_url, "seen", "S-%03d"))
    assert out == {
        ("S-007", "https://a.com", "old", "x"), ("S-008", "https://c.com", "c", None), ("S-009", "https://b.com", "new", None),
    }


def test_stamps_and_change_sets(target):
    now, then = F.lit("new"), F.lit("old")
    before = target.withColumn("at", then)
    after = before.withColumn("n", F.when(F.col("id") == 1, 99).otherwise(F.col("n"))).drop("at")
    out = {r["id"]: r["at"] for r in merge.stamp_changes(before, after, ["id"], "at", now).collect()}
    assert out == {1: "new", 2: "old", 3: "old"}
    changes = merge.change_set(target, after.filter("id < 3"), ["id"]).orderBy("id").collect()
    assert [(r["id"], r["action"]) for r in changes] == [(1, "update"), (3, "delete")]
    assert changes[0]["before"]["n"] == 10 and changes[0]["after"]["n"] == 99


def test_defaults_and_periods(spark):
    df = spark.createDataFrame([(1, None)], "id int, kind string")
    out = merge.with_defaults(df, {"kind": "other", "tags": F.array().cast("array<string>")}).first()
    assert (out["kind"], out["tags"]) == ("other", [])
    ts = spark.createDataFrame([("2024-01-31 13:30:00",), ("2024-01-31 12:30:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    got = [r["p"] for r in ts.select(merge.period_key("t").alias("p")).collect()]
    assert got == [dt.date(2024, 2, 1), dt.date(2024, 1, 1)]  # the month turns at 13:00 UTC


def test_keys_and_cascade(spark):
    parents = spark.createDataFrame([(1,)], "k int")
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert as_set(merge.cascade_delete(parents, {"c": child}, ["k"])["c"]) == {(1, "a")}
    assert as_set(link.orphans(child, parents, ["k"])) == {(2, "b"), (None, "c")}
    both = link.orphans(child, parents, ["k"]).unionByName(link.members(child, parents, ["k"]))
    assert as_set(both) == as_set(child)


def test_fan_out_with_salts(spark):
    members = spark.range(1000).select("id", (F.when(F.col("id") < 900, 1).otherwise(2)).alias("g"))
    results = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "g int, r string")
    for salts in (1, 16):
        out = link.fan_out(members, results, ["g"], salts)
        assert out.count() == 1000 and out.filter("r = 'one'").count() == 900


def test_array_owner(spark):
    own = spark.createDataFrame([("c2", ["d1", "d2"]), ("c1", ["d1"]), ("c3", [])], "cid string, ids array<string>")
    assert as_set(link.array_owner(own, "ids", "cid", [], "d")) == {("d1", "c1"), ("d2", "c2")}


def test_overlay(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, p string, q string")
    top = spark.createDataFrame([(1, 1, "A", ""), (1, 2, "nan", "Q"), (3, 1, "z", "z")], "id int, seq int, p string, q string")
    out = link.overlay(base, top, "id", "seq", lambda c: ~va.is_blank(c))
    assert as_set(out) == {(1, "A", "Q"), (2, "b", "y")}


def test_asof_is_strict_and_per_key(spark):
    left = spark.createDataFrame([(1, "a", "2024-01-02"), (2, "a", "2024-01-03"), (3, "b", "2024-01-03"), (4, None, "2024-01-09")], "i int, k string, t string")
    right = spark.createDataFrame([("a", "2024-01-02", "x"), ("a", "2023-12-30", "w"), ("c", "2024-01-01", "y"), (None, "2024-01-01", "n")], "k string, u string, v string")
    left, right = left.withColumn("t", F.to_timestamp("t")), right.withColumn("u", F.to_timestamp("u"))
    for block in (3_600_000_000, 86_400_000_000 * 400):
        out = {r["i"]: r["v"] for r in link.asof(left, right, ["k"], "t", "u", ["v"], block).collect()}
        assert out == {1: "w", 2: "x", 3: None, 4: "n"}


def test_expectations(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, None, None), (3, "bad", 0), (1, "x", 11)], "id int, e string, n int")
    rules = {"enum": quality.one_of("e", ("x",)), "range": quality.in_range("n", 1, 10), "set": quality.not_null("e")}
    assert as_set(quality.violations(df, ["id"], rules)) == {(2, "set"), (3, "enum"), (3, "range"), (1, "range")}
    assert as_set(quality.duplicate_keys(df, ["id"])) == {(1, 2)}


# -- files ------------------------------------------------------------------


def test_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name,extra\n1,"a, ""b""",x\n2,,y\n3,c,z,surplus\n', encoding="utf-8")
    df = files.read_csv_strings(spark, str(path))
    assert as_set(df) == {("1", 'a, "b"', "x"), ("2", "", "y")}
    shaped = files.conform(df, ["name", "id", "status"])
    assert shaped.columns == ["name", "id", "status"] and shaped.first()["status"] == "VERIFY_REQUIRED"
    files.write_csv(df, ["id", "name"], str(tmp_path / "out"))
    files.write_csv(df, ["id", "name"], str(tmp_path / "out"))
    assert files.read_csv_strings(spark, str(tmp_path / "out")).count() == 4
    assert files.header_or_default([" a", "b "], ["x", "y"]) == ["a", "b"]
    assert files.header_or_default(["a"], ["x", "y"]) == ["x", "y"]


def test_json_sources(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("council_name", T.StringType()), T.StructField("website", T.StringType())])
    (tmp_path / "seed.json").write_text(json.dumps([{"council_name": "A", "website": "w"}, {"council_name": " "}]))
    seed = files.read_json_array(spark, str(tmp_path / "seed.json"), schema)
    assert files.with_seed(seed.limit(0), seed, ["council_name", "website"]).count() == 1
    out = str(tmp_path / "log")
    df = spark.createDataFrame([("é", None, bytearray(b"z"))], "t string, n int, b binary")
    files.append_jsonl(df, out)
    files.append_jsonl(df, out)
    back = spark.read.text(out).collect()
    assert len(back) == 2 and json.loads(back[0]["value"]) == {"t": "é", "n": None, "b": "z"}
    files.write_json(df.select("t"), str(tmp_path / "once"))
    with pytest.raises(AnalysisException):
        files.write_json(df.select("t"), str(tmp_path / "once"))


def test_key_lists(spark, tmp_path):
    (tmp_path / "keys.txt").write_text("# known\n\nhttp://www.A.com/x/\nb.com\nhttp://a.com/x\n")
    got = [r["url_key"] for r in files.read_keys(spark, str(tmp_path / "keys.txt")).collect()]
    assert got == ["http://a.com/x", "https://b.com"]
    files.write_keys(spark.createDataFrame([(k,) for k in got], "u string"), "u", str(tmp_path / "out"))
    assert files.read_keys(spark, str(tmp_path / "out")).count() == 2


def test_scan_reaches_the_reader(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 5).alias("g"), F.lit("x").alias("wide")).write.parquet(str(tmp_path / "t"))
    df = files.scan(spark, str(tmp_path / "t"), ["id"], F.col("g") == 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 20 and "EqualTo(g,2)" in plan and "wide" not in plan


def test_outcome_log(spark, tmp_path):
    df = spark.createDataFrame([(1, "LOW"), (2, "ERROR")], "id int, outcome string")
    files.write_outcomes(df, "outcome", str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log" / "outcome=LOW")).count() == 1


def test_versioned_table(spark):
    root = work_path(spark, "table")
    assert tables.current(spark, root) == (0, None, None)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, root)
    assert tables.write_table(spark.range(3), root, "b1") == 1
    first = tables.read_table(spark, root)
    assert tables.write_table(first.filter("id > 0"), root) == 2
    assert tables.read_table(spark, root).count() == 2 and first.count() == 3
    assert [r["batch"] for r in tables.versions(spark, root).orderBy("version").collect()] == ["b1", None]


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(shared_dir(spark))


# -- streams ----------------------------------------------------------------


def feed(spark, folder, name, data):
    df = spark.createDataFrame(data, "k string, day timestamp, seq long, v string")
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def source(spark, folder):
    schema = "k string, day timestamp, seq long, v string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


D = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "in")
    feed(spark, path, "f1", [("a", D[0], 1, "x"), ("a", D[0], 2, "y"), ("b", D[0], 3, "z")])
    feed(spark, path, "f2", [("a", D[0], 4, "again"), ("a", D[1], 5, "p"), ("c", D[2], 6, "q")])
    return path


def test_stream_insert_only(spark, folder, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # the second run starts from the checkpoint and adds nothing
        keyed.stream_insert_only(source(spark, folder).select("k", "day"), ["k"], "day", "30 days", out, state).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).collect()]
    assert len(got) == 4 and set(got) == {("a", D[0]), ("b", D[0]), ("a", D[1]), ("c", D[2])}


def test_stream_insert_only_table_and_resume(spark, folder, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: keyed.stream_insert_only_table(source(spark, folder), ["k"], "day", ["seq"], out, state).awaitTermination()
    run()
    feed(spark, folder, "f3", [("b", D[0], 9, "late copy"), ("b", D[1], 10, "new")])
    run()
    got = {(r["k"], r["day"]): r["seq"] for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == 5
    assert got == {("a", D[0]): 1, ("b", D[0]): 3, ("a", D[1]): 5, ("c", D[2]): 6, ("b", D[1]): 10}


def test_stream_upsert_equals_batch_and_replay_is_a_no_op(spark, folder, tmp_path):
    root, state = str(tmp_path / "table"), str(tmp_path / "state")
    stream = source(spark, folder).select("k", "v", "seq")
    keyed.stream_upsert(stream, ["k"], "seq", root, state).awaitTermination()
    want = {("a", "p"), ("b", "z"), ("c", "q")}
    assert as_set(keyed.read_upserted(spark, root, ["k"])) == want
    assert keyed.compact(spark, root, ["k"]) == 1
    assert as_set(keyed.read_upserted(spark, root, ["k"])) == want == as_set(tables.read_table(spark, root))
    keyed.stream_upsert(stream, ["k"], "seq", root, state).awaitTermination()  # nothing new
    feed(spark, folder, "f3", [("b", D[2], 7, "late"), ("d", D[2], 8, "new")])
    keyed.stream_upsert(stream, ["k"], "seq", root, state).awaitTermination()
    # a replay of a compacted batch changes nothing
    spark.createDataFrame([("a", "replayed")], "k string, v string").write.mode("overwrite").parquet(f"{root}/log/batch=0")
    want = {("a", "p"), ("b", "late"), ("c", "q"), ("d", "new")}
    assert as_set(keyed.read_upserted(spark, root, ["k"])) == want
    assert keyed.compact(spark, root, ["k"]) == 2
    assert as_set(tables.read_table(spark, root)) == want


def test_process_pending(spark, tmp_path):
    done = str(tmp_path / "done")
    calls = []

    def step(df):
        calls.append(df.count())
        return df.select("id", (F.col("id") * 2).alias("d"))

    keyed.process_pending(spark.range(5), done, ["id"], step)
    out = keyed.process_pending(spark.range(8), done, ["id"], step)
    assert calls == [5, 3] and out.count() == 8


def test_json_arrays_are_dealt_to_files_by_row_count(spark, tmp_path):
    from pyspark.sql import types as T

    rows = spark.range(1000).select("id", F.lit("same").alias("name"))
    files.write_json_arrays(rows, str(tmp_path / "a"), rows=50)
    found = [json.loads(p.read_text()) for p in (tmp_path / "a").rglob("part-*.txt")]
    assert len(found) == 20 and max(map(len, found)) < 100
    assert sorted(r["id"] for part in found for r in part) == list(range(1000))
    assert files.read_json_array(spark, str(tmp_path / "a"), T.StructType.fromDDL("id bigint, name string")).count() == 1000
    files.write_json_arrays(rows.limit(0), str(tmp_path / "none"))


def test_csv_only_files_with_an_open_quote_are_read_whole(spark, tmp_path):
    folder = tmp_path / "some files"
    folder.mkdir()
    (folder / "a.csv").write_text('id,name,size\n1,"one\ntwo",x\n2,"say ""hi"",\nagain",y\n')
    (folder / "b.csv").write_text('id,name,size\n3,pipe 5" wide,z\n4,"a ""quoted"" word",5"\n5,"a,""",""\n6,short\n7,too,many,fields\n')
    (folder / "c.csv").write_text('id,name,size\n8,plain,""""\n')
    found = files.files_with_open_quotes(spark, str(folder))
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.csv"]
    df = files.read_csv_strings(spark, str(folder))
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "one\ntwo", "x"), ("2", 'say "hi",\nagain', "y"), ("3", 'pipe 5" wide', "z"), ("4", 'a "quoted" word', '5"'), ("5", 'a,"', ""), ("6", "short", ""),
        ("8", "plain", '"'),
    ]
    assert df.count() == 7
    # each file is read by one of the two scans
    assert sorted(r["f"].rsplit("/", 1)[1] for r in df.select(F.input_file_name().alias("f")).distinct().collect()) == ["a.csv", "b.csv", "c.csv"]
    assert files.files_with_open_quotes(spark, str(folder), ";") == []


def test_csv_line_feed_in_a_quoted_field_is_one_row(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,address\n1,"1 High St\nTown, ""B"""\n2,plain\n3\n')
    got = {tuple(r) for r in files.read_csv_strings(spark, str(path)).collect()}
    assert got == {("1", '1 High St\nTown, "B"'), ("2", "plain"), ("3", "")}


def test_an_older_event_in_a_later_batch_loses(spark, tmp_path):
    folder, root, state = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state")
    schema = "k string, v string, ts long"

    def batch(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        keyed.stream_upsert(stream, ["k"], "ts", root, state).awaitTermination()
        return as_set(keyed.read_upserted(spark, root, ["k"]))

    assert batch("a", [("1", "ten", 10), ("2", "two", 2), (None, "nobody", 5)]) == {("1", "ten"), ("2", "two"), (None, "nobody")}
    assert batch("b", [("1", "five", 5), ("2", "three", 3), (None, "older", 4)]) == {("1", "ten"), ("2", "three"), (None, "nobody")}
    keyed.compact(spark, root, ["k"])
    # against the compacted table as well, and equal orders go to the later batch
    assert batch("c", [("1", "nine", 9), ("2", "again", 3), ("3", "new", 1)]) == {("1", "ten"), ("2", "again"), ("3", "new"), (None, "nobody")}
    keyed.compact(spark, root, ["k"])
    assert batch("d", [("1", "eleven", 11), ("3", "old", 0)]) == {("1", "eleven"), ("2", "again"), ("3", "new"), (None, "nobody")}
    assert as_set(tables.read_table(spark, root)) == {("1", "ten"), ("2", "again"), ("3", "new"), (None, "nobody")}
