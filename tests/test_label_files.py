from landfall.plans.catalog import write_label_block
from landfall.sources.labels import read_labels


def test_a_large_block_is_many_small_files(spark, tmp_path):
    lines = spark.range(3000).selectExpr("concat('   ', id, ' =  ''LAND ', id, '; ''', if(id % 5 = 0, ' ;', '')) as line")
    root = str(tmp_path / "labels")
    write_label_block(lines, "landl", " ;", root, per_file=100)
    write_label_block(lines.limit(0), "$nonel", "\n;", root, per_file=100)
    files = [p.stat().st_size for p in (tmp_path / "labels").glob("part-*")]
    assert len(files) >= 30 and max(files) < 10_000
    found = read_labels(spark, root, max_bytes=10_000).collect()
    assert sorted(map(tuple, found)) == sorted(("landl", str(i), f"LAND {i}; ") for i in range(3000))
