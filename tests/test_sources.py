import pytest
from pyspark.sql import functions as F

from basketry.sources import files, tables
from tests.conftest import rows, ts


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_products(spark, tmp_path):
    path = write(tmp_path / "p.csv", "\n".join([
        '3982^ Mouse 5" ^1057,439^B009^http://a ^Office|Mouse^mouse|good',
        "11^Card^1^B1^http://b^Storage^",
        "12^NoTags^1^B1^http://b^Storage",
        "x^Bad^1^B1^http://b^Storage^t",
        "13^Short^1",
    ]))
    got = rows(files.read_products(spark, path), "product_id", "name", "image_url", "categories", "tags")
    assert got == [
        (11, "Card", "http://b", "Storage", ""),
        (12, "NoTags", "http://b", "Storage", ""),
        (3982, 'Mouse 5"', "http://a", "Office|Mouse", "mouse|good"),
    ]
    assert sorted(r["raw_id"] for r in files.read_product_rejects(spark, path).collect()) == ["13", "x"]


def test_ratings_file_and_rejects(spark, tmp_path):
    path = write(tmp_path / "r.csv", "1,2,4.5,1578830898\n1,2\n,2,3,4\n7,8,x,9\n")
    got = rows(files.read_ratings(spark, path))
    assert got == [(1, 2, 4.5, ts("2020-01-12 12:08:18"))]
    rejects = files.parse_rating(files.read_lines(spark, path), sep=",")[1]
    assert rows(rejects) == [(",2,3,4",), ("1,2",), ("7,8,x,9",)]


def test_login_and_behavior_lines(spark):
    login, bad = files.parse_login(spark.createDataFrame(
        [("5|1.2.3.4|fail|1582192845138",), ("a|b|c|d",)], "value string"))
    assert rows(login, "user_id", "ip", "event_type", F.unix_millis("ts")) == [
        (5, "1.2.3.4", "fail", 1582192845138)]
    assert bad.count() == 1
    seen, bad = files.parse_behavior(spark.createDataFrame(
        [(" 260008, 286745,2685357 ,pv,1582607823569",), ("1,2,3,pv",)], "value string"))
    assert rows(seen, "user_id", "product_id", "category", "event_type", F.unix_millis("ts")) == [
        (260008, 286745, "2685357", "pv", 1582607823569)]
    assert rows(bad) == [("1,2,3,pv",)]


def test_ratings_from_log(spark):
    lines = spark.createDataFrame([
        ("x : PRODUCT_RATING_PREFIX:96354|183679|5.0|1578830898",),
        ("x : PRODUCT_RATING_PREFIX:96354|14103|4.0|1578831024",),
        ("x : PRODUCT_RATING_PREFIX:96354|oops",), ("other",),
    ], "value string")
    good, bad = files.ratings_from_log(lines)
    assert rows(good, "user_id", "product_id", "score", F.unix_seconds("ts")) == [
        (96354, 14103, 4.0, 1578831024), (96354, 183679, 5.0, 1578830898)]
    assert rows(bad) == [("96354|oops",)]


def test_snapshot_is_sorted_and_checked(spark, tmp_path):
    base = str(tmp_path)
    frame = spark.range(100).select(
        (99 - F.col("id")).alias("product_id"), F.lit(1).cast("long").alias("count"))
    tables.write_snapshot(frame, "rate_more", base, ["product_id"])
    tables.write_snapshot(frame, "rate_more", base, ["product_id"])
    back = tables.read_table(spark, "rate_more", base)
    assert back.count() == 100
    tables.append_rows(frame, "rate_more", base)
    assert tables.read_table(spark, "rate_more", base).count() == 200
    tables.write_snapshot(frame.withColumnRenamed("count", "n"), "average_score", base)
    with pytest.raises(ValueError, match="avg"):
        tables.read_table(spark, "average_score", base)


def test_batches_replace_by_key_and_survive_a_retry(spark, tmp_path):
    base = str(tmp_path)

    def batch(*pairs):
        return spark.createDataFrame(list(pairs), "user_id long, v string")

    tables.write_batch(batch((1, "a"), (2, "b")), "t", base, 0)
    tables.write_batch(batch((1, "half")), "t", base, 1)
    tables.write_batch(batch((1, "c"), (3, "d")), "t", base, 1)
    want = [(1, "c"), (2, "b"), (3, "d")]
    assert rows(tables.read_replaced(spark, "t", base, "user_id"), "user_id", "v") == want
    tables.compact_batches(spark, "t", base, "user_id")
    assert rows(tables.read_replaced(spark, "t", base, "user_id"), "user_id", "v") == want
    assert spark.read.parquet(base + "/t_snapshot").count() == 3


def _batches(spark, base, *numbers):
    for n in numbers:
        frame = spark.createDataFrame([(k, f"{n}") for k in (0, n)], "user_id long, v string")
        tables.write_batch(frame, "t", base, n)


def _now(spark, base):
    return rows(tables.read_replaced(spark, "t", base, "user_id"), "user_id", "v")


def test_batches_between_and_after_compactions(spark, tmp_path):
    base = str(tmp_path)
    present = lambda: sorted(p.name for p in (tmp_path / "t").glob("batch_id=*"))
    _batches(spark, base, 1, 2)
    want = [(0, "2"), (1, "1"), (2, "2")]
    assert _now(spark, base) == want
    before = tables.read_replaced(spark, "t", base, "user_id")
    tables.compact_batches(spark, "t", base, "user_id")
    assert _now(spark, base) == want and rows(before, "user_id", "v") == want
    _batches(spark, base, 3)
    want = [(0, "3"), *want[1:], (3, "3")]
    assert _now(spark, base) == want
    tables.compact_batches(spark, "t", base, "user_id")
    assert present() == ["batch_id=3"] and _now(spark, base) == want
    tables.compact_batches(spark, "t", base, "user_id")  # nothing new
    assert _now(spark, base) == want
    # A batch that is tried again after it was folded does not come back.
    _batches(spark, base, 2)
    assert _now(spark, base) == want


def test_compaction_that_dies_half_way(spark, tmp_path):
    base = str(tmp_path)
    _batches(spark, base, 1, 2)
    tables.compact_batches(spark, "t", base, "user_id")
    _batches(spark, base, 3)
    want = _now(spark, base)
    half = spark.createDataFrame([(0, "half")], "user_id long, v string")
    half.write.parquet(f"{base}/t_snapshot/upto=3")
    (tmp_path / "t_snapshot" / "upto=3" / "_SUCCESS").unlink()
    assert _now(spark, base) == want
    tables.compact_batches(spark, "t", base, "user_id")
    assert _now(spark, base) == want
    assert (tmp_path / "t_snapshot" / "upto=3" / "_SUCCESS").exists()


def _pairs(spark, n=400):
    return spark.range(n).selectExpr("id AS product_id", "id * 7 % 100 AS other_id", "0.5D AS score")


def test_look_ups_read_only_their_buckets(spark, tmp_path):
    base = str(tmp_path)
    tables.write_buckets(_pairs(spark), "sims", base, "product_id", ["product_id", "other_id"])
    keys = spark.createDataFrame([(3,), (4,)], "k long")
    found = tables.read_buckets(spark, "sims", base, keys)
    assert rows(found.where("product_id IN (3, 4)")) == rows(_pairs(spark).where("product_id IN (3, 4)"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan
    read = found.select(F.input_file_name()).distinct().count()
    assert 0 < read <= 2 < len(spark.read.parquet(f"{base}/sims").inputFiles())
    assert rows(tables.read_buckets(spark, "sims", base)) == rows(_pairs(spark))
    assert tables.read_buckets(spark, "sims", base, keys.limit(0)).count() == 0


def test_changes_leave_other_buckets_alone(spark, tmp_path):
    base = str(tmp_path)
    tables.write_buckets(_pairs(spark), "sims", base, "product_id")
    names = lambda: {p.relative_to(tmp_path) for p in (tmp_path / "sims").rglob("*.parquet")}
    before = names()

    def merge(old, new):
        return old.join(new, "product_id", "left_anti").unionByName(new)

    changes = spark.createDataFrame([(3, 1, 0.9), (9999, 2, 0.1)], "product_id long, other_id long, score double")
    tables.change_buckets(changes, merge, "sims", base, "product_id")
    touched = {str(p.parent) for p in before - names()}
    assert len(touched) <= 2 and len(before & names()) >= len(before) - 2
    want = rows(_pairs(spark).where("product_id <> 3").unionByName(changes))
    assert rows(tables.read_buckets(spark, "sims", base)) == want
    # A table without buckets gets them.
    tables.write_snapshot(_pairs(spark), "flat", base)
    tables.change_buckets(changes, merge, "flat", base, "product_id")
    assert rows(tables.read_buckets(spark, "flat", base)) == want
    tables.append_buckets(changes, "flat", base, "product_id")
    assert tables.read_buckets(spark, "flat", base).count() == len(want) + 2
