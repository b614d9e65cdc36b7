"""Texts are joined last and written compressed: what the wide rows and the tips move and leave on disk."""

from pathlib import Path

from ratecraft import schemas
from ratecraft.operators import relational as rel
from ratecraft.sources import readers, writers


def test_texts_come_by_key(spark):
    rows = [(1, 1, 7, 2), (1, 2, None, None), (2, 1, 9, 1), (None, 2, None, None), (3, 3, 8, 0)]
    table = spark.createDataFrame(rows, "user_id long, business_id long, doc_id long, compliment_count int")
    texts = spark.createDataFrame([(7, "a"), (7, "b"), (8, None), (None, "never")], "doc_id long, text string")
    out = rel.with_texts(table, texts, "doc_id", ["compliment_count"])
    assert out.columns == ["user_id", "business_id", "text", "compliment_count"]
    want = [(1, 1, "a", 2), (1, 1, "b", 2), (1, 2, None, None), (2, 1, None, None), (None, 2, None, None), (3, 3, None, 0)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_rows_without_a_key_are_spread(spark):
    table = spark.range(1000).selectExpr("id AS user_id", "id AS business_id", "CAST(NULL AS LONG) AS doc_id")
    texts = spark.createDataFrame([(7, "a")], "doc_id long, text string").hint("shuffle_hash")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = rel.with_texts(table, texts, "doc_id").rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 1000 and sum(s > 100 for s in sizes) > 1


def test_compressed_tips_and_tables_read_back(spark, tmp_path):
    rows = [(str(i), str(i % 3), f'line\n"{i % 5}" ' * 200, None, i) for i in range(60)]
    tips = spark.createDataFrame(rows, schemas.tip()).coalesce(1)
    plain, packed = (writers.write_json(tips, str(tmp_path / c), c) for c in ("none", "gzip"))
    size = lambda path: sum(f.stat().st_size for f in Path(path).glob("part-*"))
    assert size(packed) * 5 < size(plain)
    assert sorted(map(str, readers.read_tips(spark, packed).collect())) == sorted(map(str, tips.collect()))
    table = tips.select("user_id", "text", "compliment_count")
    path = writers.write_csv(table, str(tmp_path / "csv"), compression="gzip")
    assert sorted(map(str, readers.read_csv(spark, path, table.schema).collect())) == sorted(map(str, table.collect()))
