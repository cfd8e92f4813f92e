"""The landed files' writer: any number of tasks, repeats, nulls, names."""

from pyspark.sql import functions as F

from feedlake.plans import emulate
from feedlake.sources.landing import scan_landing, scan_names


def test_files_land_from_many_tasks_whatever_the_input_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(emulate, "scratch_path", lambda s, n: f"{tmp_path}/{n}")
    docs = spark.range(500).coalesce(1).select(F.concat(F.lit("ä "), (F.col("id") % 7).cast("string"), F.repeat(F.lit("x"), 4000)).alias("value"))
    seen, land = [], emulate._land
    monkeypatch.setattr(emulate, "_land", lambda files, path: seen.append(land(files, path)) or seen[-1])
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    path = emulate.landed_files(spark, "many", docs.unionByName(spark.createDataFrame([(None,)], "value string")))
    assert seen == [501]
    assert sorted(r.doc for r in scan_landing(spark, path, glob="*.txt").collect()) == sorted([r.value + "\n" for r in docs.collect()] + ["\n"])
    tracker, widths = spark.sparkContext.statusTracker(), []
    for job in set(tracker.getJobIdsForGroup(None)) - set(before):
        widths += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s)]
    assert max(widths) > 2  # two input partitions


def test_no_documents_land_as_an_empty_directory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(emulate, "scratch_path", lambda s, n: f"{tmp_path}/{n}")
    path = emulate.landed_files(spark, "none", spark.createDataFrame([], "value string"))
    assert scan_landing(spark, path, glob="*.txt").count() == 0


def test_named_files_share_few_folders_and_keep_repeated_names(spark, tmp_path):
    rows = [("a b~1.json", f"landing/{i}", f"t{i}") for i in range(300)] + [("ö%20+.json", "landing/x", "u")]
    docs = spark.createDataFrame(rows, "file_name string, file_path string, doc string")
    path = str(tmp_path / "named")
    emulate.named_files(docs.limit(100), path)
    emulate.named_files(docs, path)  # the first ones again: replaced
    names = scan_names(spark, path, "*.txt", recursive=True, name_pattern=emulate.NAME_IN_PATH)
    assert sorted(r.file_name for r in names.collect()) == sorted(r[0] for r in rows)
    assert len([p for p in (tmp_path / "named").iterdir() if p.is_dir()]) <= emulate.LANDED_BUCKETS
    assert not list((tmp_path / "named").rglob(".[0-9a-f]*"))  # no draft left


def test_names_in_the_folders_of_sparks_writer(spark):  # stores that Arrow doesn't know
    path = spark.createDataFrame([("s3a://b/file_name=a_1.json/part-0.txt",)], "p string")
    assert path.select(F.regexp_extract("p", emulate.NAME_IN_PATH, 1)).first()[0] == "a_1.json"
    assert emulate._file_system("viewfs://store/a") is None
