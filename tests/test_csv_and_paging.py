from shelflens.operators.paging import page_coverage
from shelflens.sources.sinks import write_csv
from shelflens.sources.tables import NAME_MAP_SCHEMA, read_name_map


def test_csv_keeps_names(spark, tmp_path):
    names = [" lead", "trail ", "two\nlines", '5" pack, big', "", None, "a,b", "back\\slash", '"quoted"']
    rows = spark.createDataFrame([(i, n, "x") for i, n in enumerate(names)], NAME_MAP_SCHEMA)
    write_csv(rows, str(tmp_path / "map"))
    assert sorted(map(tuple, read_name_map(spark, str(tmp_path / "map")).collect())) == sorted(map(tuple, rows.collect()))


def test_csv_reads_doubled_quotes(spark, tmp_path):
    (tmp_path / "m.csv").write_text('no,a,b\n1,"5"" pack, big",y\n')
    assert [tuple(r) for r in read_name_map(spark, str(tmp_path / "m.csv")).collect()] == [(1, '5" pack, big', "y")]


def test_empty_search_misses_no_pages(spark):
    declared = spark.createDataFrame([("a", 0, 0, 1), ("b", 2, 5, 1)], "k string, total_pages int, total_results int, first_page int")
    landed = spark.createDataFrame([("b", 1), ("b", 9), ("b", 9), ("a", 1)], "k string, page int")
    got = {r.k: (r.missing_pages, r.landed_pages, r.landed_rows, r.undeclared_pages) for r in page_coverage(declared, landed, ["k"]).collect()}
    assert got == {"a": (0, 0, 0, 1), "b": (1, 1, 1, 1)}
