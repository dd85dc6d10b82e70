"""CSV landing: values kept as they are, broken lines apart, files loaded once."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.bronze import broken_lines, scan_bronze, store_bronze
from ledgerlake.schemas import CUSTOMER_COLUMNS
from ledgerlake.session import scratch_dir
from ledgerlake.sources.landing import BROKEN, broken_only, scan_csv, whole_lines, write_csv
from ledgerlake.sources.ledger import Landing
from ledgerlake.sources.store import PathStore

AWKWARD = ["a\nb", "", None, 'q"uote', "back\\slash", "end\\", '"', "a,b", "cr\rx", "crlf\r\nx", " pad ",
           '\\"', "\n", '""', "#c", "\\N", "é 漢 😀", "null", "'"]


def test_values_survive_landing(spark):
    rows = [(str(i), x, y) for i, x in enumerate(AWKWARD) for y in (None, "", "z")]
    path = f"{scratch_dir(spark, 'awkward')}/x.csv"
    breaks = write_csv(spark.createDataFrame(rows, "id string, a string, b string").repartition(3), path)
    assert breaks == sum(any(c in (x or "") for c in "\n\r") for _, x, _ in rows) > 0
    assert write_csv(spark.createDataFrame([("a", None), ("b", '"')], "a string, b string"), f"{path}.plain") == 0
    back = scan_csv(spark, path, ["id", "a"])
    assert back.columns == ["id", "a", "b", BROKEN]
    assert broken_only(back).count() == 0
    assert sorted(map(tuple, whole_lines(back).collect()), key=str) == sorted(rows, key=str)


def _file(spark, text):
    folder = scratch_dir(spark, "lines")
    with open(f"{folder}/t.csv", "w", newline="") as f:
        f.write(text)
    return folder


def test_lines_of_other_length_are_broken(spark):
    path = _file(spark, 'a,b\n1,2\nshort\n4,5,6\n"x\ny",z\n,\n"",""\n')
    got = scan_csv(spark, path)
    assert {tuple(r) for r in whole_lines(got).collect()} == {("1", "2"), ("x\ny", "z"), (None, None), ("", "")}
    assert {r[0] for r in broken_only(got).select(BROKEN).collect()} == {"short", "4,5,6"}
    with pytest.raises(ValueError, match="missing columns"):
        scan_csv(spark, path, ["a", "c"])


def test_files_of_one_folder_must_agree(spark):
    folder = _file(spark, "a,b\n1,2\n")
    with open(f"{folder}/u.csv", "w") as f:
        f.write("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        scan_csv(spark, folder).collect()


def test_plain_files_can_be_split_inside(spark):
    path = _file(spark, "a,b\r\n" + "".join(f"{i},{i}\r\n" for i in range(5000)))
    got = whole_lines(scan_csv(spark, path, multi_line=False))
    assert got.agg(F.sum(F.col("a").cast("int")), F.sum(F.col("b").cast("int"))).first() == (12497500, 12497500)


def test_bronze_and_broken_lines_in_one_write(spark):
    head, good = ",".join(CUSTOMER_COLUMNS), ",".join("x" * len(CUSTOMER_COLUMNS))
    root = _file(spark, f"{head}\n{good}\n1,2\n{good},more\n{good}\n")
    store = PathStore(spark, scratch_dir(spark, "bronze-broken"))
    counts = store_bronze(store, scan_bronze(spark, root, "customers", file_name="t.csv"), "customers")
    assert counts["whole_rows"] == store.read("bronze_customers").count() == 2
    assert counts["broken_rows"] == 2
    assert {tuple(r) for r in broken_lines(store, ["customers"]).collect()} == {
        ("customers", "t.csv", "1,2"), ("customers", "t.csv", f"{good},more")}
    # no broken line: the table is there and empty
    whole = _file(spark, f"{head}\n{good}\n")
    store = PathStore(spark, scratch_dir(spark, "bronze-whole"))
    store_bronze(store, scan_bronze(spark, whole, "customers", file_name="t.csv"), "customers")
    assert broken_lines(store, ["customers"]).count() == 0


def test_each_file_is_loaded_once(spark):
    root = scratch_dir(spark, "ledger")
    landing, folder = Landing(spark, root), f"{root}/in put"
    rows = spark.createDataFrame([(str(i), f"v{i}") for i in range(20)], "k string, v string")
    write_csv(rows.filter("k < 5").coalesce(1), folder, "append")
    assert landing.load("t", folder, ["k", "v"]) == {"files": 1, "rows": rows.filter("k < 5").count(), "broken": 0}
    assert landing.load("t", folder, ["k", "v"]) == {"files": 0, "rows": 0, "broken": 0}
    n = landing.read_loaded("t", ["k", "v"]).count()
    write_csv(rows.filter("k >= 5").coalesce(1), folder, "append")
    assert landing.load("t", folder, ["k", "v"])["files"] == 1
    assert landing.read_loaded("t", ["k", "v"]).count() == 20 > n
    # rows of a load that never reached the ledger are not seen
    landing.read_loaded("t", ["k", "v"]).withColumn(BROKEN, F.lit(None).cast("string")).write.parquet(
        f"{root}/bronze_t/load_id=dead")
    assert landing.read_loaded("t", ["k", "v"]).count() == 20
    # another dataset knows nothing of them; nothing loaded reads as empty
    assert Landing(spark, root).read_loaded("u", ["k", "v"]).count() == 0
    with open(f"{folder}/broken.csv", "w") as f:
        f.write("k,v\n1\n2,3\n")
    assert landing.load("t", folder, ["k", "v"]) == {"files": 1, "rows": 1, "broken": 1}
    assert [r["raw_line"] for r in landing.read_loaded("t", ["k", "v"], broken=True).collect()] == ["1"]
