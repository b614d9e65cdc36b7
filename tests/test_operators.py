import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratecraft import schemas
from ratecraft.operators import relational as rel
from ratecraft.operators import splits
from ratecraft.plans import discount
from ratecraft.session import new_path
from ratecraft.sources import readers, writers

DAY = datetime.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), rng.randrange(30), float(rng.randrange(1, 6)),
             DAY + datetime.timedelta(days=rng.randrange(9))) for _ in range(400)]
    rows += rows[:7]  # copies
    return spark.createDataFrame(rows, "user_id long, business_id long, rating double, date timestamp_ntz")


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_hash_split_is_disjoint_and_whole(ratings):
    train, test = splits.hash_split(ratings)
    assert bag(train) + bag(test) == bag(ratings)
    pairs = lambda d: {(r.user_id, r.business_id) for r in d.collect()}
    assert not pairs(train) & pairs(test)
    again = splits.hash_split(ratings.repartition(5))[1]
    assert bag(again) == bag(test)


def test_shares_at_their_limits(spark):
    pairs = spark.range(20_000).selectExpr("id % 977 AS user_id", "id AS business_id", "1.0D AS rating")
    for share, low, high in ((0.0, 0, 0), (1e-4, 0, 15), (0.001, 5, 45), (0.8, 15_700, 16_300), (1.0, 20_000, 20_000)):
        train, test = splits.hash_split(pairs, share)
        n = splits.hash_sample(pairs, share).count()
        assert low <= n <= high and train.count() == n and test.count() == 20_000 - n


def test_leave_latest_out_keeps_copies(ratings):
    train, test = splits.leave_latest_out(ratings)
    assert bag(train) + bag(test) == bag(ratings)
    latest = {r.user_id: r["max(date)"] for r in ratings.groupBy("user_id").agg(F.max("date")).collect()}
    rows = test.collect()
    assert len(rows) == len(latest) and all(r.date == latest[r.user_id] for r in rows)


def test_folds_cover_all_rows(ratings):
    numbered = splits.folds(ratings, 3)
    assert {r.fold for r in numbered.select("fold").distinct().collect()} == {0, 1, 2}
    assert bag(numbered.drop("fold")) == bag(ratings)


def test_cohorts(ratings):
    train, test = splits.hash_split(ratings)
    tagged = splits.cohorts(train, test).collect()
    counts = Counter(r.business_id for r in train.collect())
    low = [counts[r.business_id] for r in tagged if r.cohort == "test_least_items"]
    high = [counts[r.business_id] for r in tagged if r.cohort == "test_most_items"]
    assert low and high and max(low) < min(high)
    recent = [r for r in tagged if r.cohort == "test_mostrecent"]
    assert len({r.user_id for r in recent}) == test.select("user_id").distinct().count()


def test_active_users(ratings):
    counts = Counter(r.user_id for r in ratings.collect())
    kept = rel.active_users(ratings, 21).collect()
    assert {r.user_id for r in kept} == {u for u, n in counts.items() if n >= 21}
    assert len(kept) == sum(n for n in counts.values() if n >= 21)


def test_histogram_like_the_plotting_default(spark):
    values = [0.0, 0.1, 0.95, 1.0, 1.0, None]
    rows = rel.histogram(spark.createDataFrame([(v,) for v in values], "x double"), "x", 10).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 3]
    assert rows[0].low == 0 and rows[-1].high == pytest.approx(1.0)
    flat = rel.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in flat] == [0, 0, 2, 0] and flat[0].low == 1.5 and flat[-1].high == 2.5


def test_wide_table_renames_and_multiplies(spark):
    ratings = spark.createDataFrame([(1, 7, 4.0, DAY)], "user_id long, business_id long, rating double, date timestamp_ntz")
    business = spark.createDataFrame([(7, "shop", 3)], "business_id long, name string, review_count long")
    users = spark.createDataFrame([(1, "ann", 9)], "user_id long, name string, review_count long")
    tips = spark.createDataFrame([(7, 1, "t1", DAY), (7, 1, "t2", DAY)],
                                 "business_id long, user_id long, text string, date timestamp_ntz")
    rows = rel.wide_table(ratings, business, users, tips).collect()
    assert {(r.name_x, r.name_y, r.review_count_x, r.review_count_y, r.text) for r in rows} == {
        ("shop", "ann", 3, 9, "t1"), ("shop", "ann", 3, 9, "t2")}


def test_discount_by_hand(spark):
    ratings = spark.createDataFrame(
        [(1, 7, 4.0, DAY), (1, 8, 2.0, DAY + datetime.timedelta(days=60)), (2, 9, 5.0, DAY)],
        "user_id long, business_id long, rating double, date timestamp_ntz")
    business = spark.createDataFrame([(7, 0.0, 0.0), (8, 2.0, 0.0)], "business_id long, latitude double, longitude double")
    rows = {r.business_id: r for r in discount.discounted_detail(ratings, business).collect()}
    import math
    dist, age = math.exp(1 / 2) / math.e, math.exp(1 / (1 + math.log(3))) / math.e
    assert rows[7].date_dist_rating == pytest.approx(4 * dist * age)
    assert rows[8].date_rating == pytest.approx(2.0) and rows[8].dist_rating == pytest.approx(2 * dist)
    assert rows[9].distance is None and rows[9].dist_rating is None and rows[9].date_rating == 5.0


def test_coordinates_transpose(ratings):
    user, item = rel.coordinates(ratings), rel.coordinates(ratings, "item")
    assert bag(user.select("row", "col", "value")) == bag(item.select("col", "row", "value"))
    with pytest.raises(ValueError):
        rel.coordinates(ratings, "both")


def test_column_profile(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert {tuple(r) for r in rel.column_profile(frame).collect()} == {("a", "bigint", 2), ("b", "string", 1)}


def test_cast_dirty_values(spark):
    frame = spark.createDataFrame([("1",), ("x",)], "a string")
    assert [r.a for r in rel.cast_columns(frame, {"a": "int"}, strict=False).collect()] == [1, None]


def test_csv_round_trip_with_quotes(spark):
    rows = [(1, 'say "hi", then\\ go', 2.5), (2, "", 1.0)]
    frame = spark.createDataFrame(rows, "id long, text string, x double")
    path = writers.write_csv(frame, new_path(spark, "quotes.csv"))
    assert bag(readers.read_csv(spark, path, frame.schema)) == Counter([rows[0], (2, None, 1.0)])


def test_json_review_schema(spark):
    lines = ['{"user_id":"u","business_id":"b","stars":4.0,"text":"ok\\nfine","date":"2019-05-06 07:08:09","useful":3}',
             '{"user_id":"v","business_id":"b","stars":2,"text":null,"date":"2019-05-06 00:00:00"}']
    path = new_path(spark, "review.json")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = readers.read_reviews(spark, path).collect()
    assert tuple(rows[0]) == ("u", "b", 4.0, "ok\nfine", datetime.datetime(2019, 5, 6, 7, 8, 9))
    assert readers.read_reviews(spark, path, text=False).columns == ["user_id", "business_id", "rating", "date"]
    assert len(schemas.user().fields) == 21 and len(schemas.business().fields) == 11


def test_materialize_loads_or_computes(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3 + len(calls))
    folder = new_path(spark, "cache")
    assert writers.materialize(spark, "t", build, folder=folder).count() == 4
    assert writers.materialize(spark, "t", build, folder=folder).count() == 4 and len(calls) == 1
    assert writers.materialize(spark, "t", build, use_cache=False, folder=folder).count() == 5


def test_scan_reads_only_needed_columns(spark, ratings):
    path = new_path(spark, "pruned")
    ratings.write.parquet(path)
    plan = rel.relevant(spark.read.parquet(path), 3).select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,rating:double>" in plan and "GreaterThanOrEqual(rating,3.0)" in plan


def test_dates_without_time_and_broken_lines(spark):
    path = new_path(spark, "lines")
    lines = ['{"user_id":"a","business_id":"b","stars":4.0,"text":"x","date":"2016-03-09"}',
             '{"user_id":"a","business_id":"c","stars":4.0,"text":"x","date":"2016-03-09 10:11:12"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    dates = sorted(r.date for r in readers.read_reviews(spark, path).collect())
    assert dates == [datetime.datetime(2016, 3, 9), datetime.datetime(2016, 3, 9, 10, 11, 12)]
    broken = new_path(spark, "broken")
    spark.createDataFrame([(lines[0],), ('{"user_id":"a", "bus',)], "value string").write.text(broken)
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_reviews(spark, broken).collect()


def test_local_rows_has_no_cap(spark):
    assert readers.local_rows(spark, [(i,) for i in range(10_001)], "x int").count() == 10_001


def test_csv_keeps_line_breaks_and_quotes(spark, tmp_path):
    rows = [(1, 2, 3.0, 'line one\nline "two", and\r\nthree', None), (4, 5, 1.0, "plain", None), (6, 7, 2.0, None, None), (8, 9, 2.0, "  spaced \\ ", None)]
    schema = schemas.review_csv()
    path = writers.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "t.csv"), file_rows=1)
    found = readers.read_csv(spark, path, schema).collect()
    assert {tuple(r) for r in found} == set(rows)


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_broken_lines_are_set_apart(spark, tmp_path, kind):
    lines = {"json": ['{"user_id":"a","business_id":"b","stars":3.5,"date":"2020-01-01"}', '{"user_id":"a","busin', "", '{"user_id":"c","business_id":"d","stars":"many"}',
                      '{"user_id":"e","business_id":"f","stars":1.0}'],
             "csv": ["user_id,business_id,stars,date", "a,b,3.5,2020-01-01", "c,d,many,2020-01-01", "e,f,1.0,"]}[kind]
    source, sink = str(tmp_path / "in"), str(tmp_path / "rejects")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(source)
    read = readers.read_quarantined(spark, source, schemas.review(text=False), kind, sink)
    assert sorted((r.user_id, r.stars) for r in read.rows.collect()) == [("a", 3.5), ("e", 1.0)] and read.n_rows == 2
    want = {"json": [("does not fit", lines[3]), ("unreadable", lines[1])], "csv": [("does not fit", lines[2])]}[kind]
    assert sorted((r.reason, r.line) for r in read.rejects.collect()) == want and read.n_rejects == len(want)
    assert spark.read.parquet(sink).count() == len(want) and all("/in/" in r.path for r in read.rejects.collect())
    with pytest.raises(Exception):
        (readers.read_reviews(spark, source, text=False) if kind == "json" else readers.read_csv(spark, source, schemas.review(text=False))).collect()
