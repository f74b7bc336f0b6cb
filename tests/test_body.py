from prosestat.functions.body import body_lines, body_text
from prosestat.operators.body import body_of_lines, cut_body, explode_lines
from prosestat.sources.books import scan_book_lines, scan_books, scan_inventory

from conftest import END, OTHER_END, OTHER_START, START

CASES = [
    ("normal", f"x\n{START}\na\nb\n{END}\ny", ["a", "b"], ["a", "b"]),
    ("no start", "a\nb", [], []),
    ("no end", f"{START}\na\nb", ["a", "b"], ["a", "b"]),
    ("end first", f"{END}\n{START}\na\n{END}", ["a"], ["a"]),
    ("other spelling", f"{OTHER_START}\na\n{OTHER_END}\nb", [], ["a"]),
    ("nothing between", f"{START}\n{END}\nx", [], []),
    ("start is the last line", f"x\n{START}", [], []),
    ("both on one line", f"{START}{END}\na\n{END}", ["a"], ["a"]),
    ("blank lines stay", f"{START}\n\na\n\n{END}", ["", "a", ""], ["", "a", ""]),
    ("carriage returns", f"{START}\r\na\r\nb\rc\r\n{END}\r\n", ["a\r", "b\rc\r"], ["a\r", "b\rc\r"]),
    ("end within a line", f"{START}\na\nz {END}\nb", ["a"], ["a"]),
]


def test_body_lines(evaluate):
    names, raws = [c[0] for c in CASES], [c[1] for c in CASES]
    for i, mode in ((2, "strict"), (3, "lenient")):
        got = evaluate(raws, lambda c: body_lines(c, mode))
        assert dict(zip(names, got)) == {c[0]: c[i] for c in CASES}, mode
    assert evaluate(raws, lambda c: body_text(c, "none")) == raws


def test_missing_text(evaluate):
    assert evaluate([None, ""], lambda c: body_text(c, "strict")) == ["", ""]
    assert evaluate([None, ""], lambda c: body_lines(c, "none")) == [[], []]


def test_lines_are_numbered(spark):
    books = spark.createDataFrame([("b", f"{START}\nx\n\ny\n{END}")], "book_id string, text string")
    assert [tuple(r) for r in explode_lines(books, "strict").orderBy("line_no").collect()] == [
        ("b", 0, "x"), ("b", 1, ""), ("b", 2, "y")]


def test_files_whole_and_in_splits(spark, tmp_path):
    for i, (_, raw, _, _) in enumerate(CASES):
        (tmp_path / f"{i}.txt").write_bytes(raw.encode())
    long_body = "\n".join(f"line {i}" for i in range(3000))
    (tmp_path / "99.txt").write_text(f"top\n{START}\n{long_body}\n{END}\ntail")
    (tmp_path / "my book.txt").write_bytes(f"{START}\nb\xff\n".encode("latin-1"))
    (tmp_path / "notes.md").write_text("no book")
    path = str(tmp_path)

    books = scan_books(spark, path)
    assert books.count() == len(CASES) + 2
    assert {r.book_id for r in books.collect()} >= {"0", "99", "my_book"}
    kept = books.where("book_id = 'my_book'").first().text
    assert kept.endswith("b\ufffd\n")

    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = scan_book_lines(spark, path)
        assert split.rdd.getNumPartitions() > 4
        for mode in ("strict", "lenient", "none"):
            whole = explode_lines(books, mode).groupBy("book_id", "line").count()
            parts = body_of_lines(split, mode).groupBy("book_id", "text").count()
            assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_inventory_does_not_read_contents(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x" * 2047)
    (tmp_path / "b.csv").write_text("x")
    found = scan_inventory(spark, str(tmp_path))
    assert [(r.filename, r.size_kb) for r in found.collect()] == [("a.txt", 1)]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_cut_body_keeps_columns(spark):
    books = spark.createDataFrame([("b", 1, f"{START}\nx\n{END}")], "book_id string, n int, text string")
    assert cut_body(books, "strict").first().asDict() == {"book_id": "b", "n": 1, "text": "x\n"}
