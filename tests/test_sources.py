import pytest

from prosestat.session import shared_folder
from prosestat.sources import components, sinks
from prosestat.sources.lexicon import scan_lexicon
from prosestat.sources.metadata import parse_metadata, scan_metadata, scan_metadata_lines

CSV = ('book_id,title,author,is_bestseller,filename\r\n1,Plain Title,"Last, First",1,1.txt\r\n'
       '2,"Title, with ""comma""",Solo,0,\r\n3,Flag missing,Solo,,3.txt\r\n4,Too,few\r\n\r\n')


def test_lexicon(spark, tmp_path):
    path = tmp_path / "lexicon.tsv"
    path.write_text("good\t3\nbad\t-3\nodd\n\nmeh\t0\nwell done\t2\ngood\t4\nx\ty\nthree\t1\tmore\nplus\t+1\n")
    got = {r.term: r.score for r in scan_lexicon(spark, str(path)).collect()}
    assert got == {"good": 4, "bad": -3, "meh": 0, "well done": 2, "plus": 1}


def test_metadata_by_position(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(CSV.encode())
    got = sorted(tuple(r) for r in scan_metadata_lines(spark, str(tmp_path)).collect())
    assert got == [("1", "Plain Title", "Last, First", "1"), ("2", 'Title, with "comma"', "Solo", "0"),
                   ("3", "Flag missing", "Solo", "")]


def test_metadata_by_name_and_limit(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(CSV.encode())
    rows = scan_metadata(spark, str(tmp_path / "m.csv")).orderBy("book_id").collect()
    assert [r.filename for r in rows][:3] == ["1.txt", "2.txt", "3.txt"]
    assert [r.book_id for r in scan_metadata(spark, str(tmp_path / "m.csv"), 2).collect()] == ["1", "2"]
    (tmp_path / "n.csv").write_text("title,book_id\nT,7\n")
    assert scan_metadata(spark, str(tmp_path / "n.csv")).first().filename == "7.txt"


LINES = [
    ("wordfreq", "barn\t64", ("barn", "64")), ("wordfreq", "oats\tseven", None),
    ("wordfreq", "badline", None), ("wordfreq", "the\t5.0", None), ("wordfreq", "  ", None),
    ("wordfreq", " barn \t 7 ", ("barn", "7")),
    ("sentiment", "avg_score\t0.71", ("avg_score", "0.71")), ("sentiment", "score\tbad", None),
    ("syntactic", "5107\tavg_sentence_length\t12.6", ("avg_sentence_length", "12.6")),
    ("syntactic", "avg_sentence_length\t12.6", ("avg_sentence_length", "12.6")),
    ("syntactic", "avg_sentence_length\tbad", None), ("syntactic", "a\tb\tc\t1", None),
    ("unknown", "barn\t1", None)]


def test_component_lines(spark):
    df = spark.createDataFrame([(str(i), component, line) for i, (component, line, _) in enumerate(LINES)],
                               "book_id string, component string, line string")
    got = {int(r.book_id): (r.metric, r.value) for r in components.facts_from_lines(df).collect()}
    assert [got.get(i) for i in range(len(LINES))] == [expected for _, _, expected in LINES]


def test_metadata_lines_become_facts(spark):
    df = spark.createDataFrame([("x", "metadata", line) for line in CSV.split("\r\n")],
                               "book_id string, component string, line string")
    got = sorted((r.book_id, r.metric, r.value) for r in components.facts_from_lines(df).collect())
    assert got == [("1", "author", "Last, First"), ("1", "is_bestseller", "1"), ("1", "title", "Plain Title"),
                   ("2", "author", "Solo"), ("2", "is_bestseller", "0"), ("2", "title", 'Title, with "comma"'),
                   ("3", "author", "Solo"), ("3", "title", "Flag missing")]


def test_tags_come_from_the_path(spark, tmp_path):
    folder = tmp_path / "word-freq" / "5107"
    folder.mkdir(parents=True)
    (folder / "part-00000").write_text("barn\t2\n")
    row = components.facts_from_lines(components.scan_lines(spark, str(folder))).first()
    assert tuple(row) == ("5107", "wordfreq", "barn", "2")
    row = components.facts_from_lines(components.scan_lines(spark, str(folder), "61", "sentiment")).first()
    assert tuple(row) == ("61", "sentiment", "barn", "2")


def test_writes_replace_and_merge(spark, tmp_path):
    counts = spark.createDataFrame([("1", "a", 3), ("2", "b", 1)], "book_id string, word string, n bigint")
    path = str(tmp_path / "out")
    for _ in range(2):
        sinks.write_word_counts(counts, path)
        assert spark.read.parquet(path).count() == 2
    sinks.write_word_counts(counts, path, "tsv", parts=1)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1\ta\t3", "2\tb\t1"]
    sinks.write_word_counts(counts, path, "tsv", per_book=True)
    assert (tmp_path / "out" / "book_id=1").is_dir()
    facts = components.facts_from_lines(components.scan_lines(spark, path + "/book_id=1", "1", "wordfreq"))
    assert tuple(facts.first()) == ("1", "wordfreq", "a", "3")


def test_metadata_field_over_two_lines_and_ids_like_the_header(spark, tmp_path):
    path = tmp_path / "meta.csv"
    path.write_bytes(b'book_id,title,author,is_bestseller,filename\r\n7,"Upper\nLower, again",Someone,1,seven.txt\r\n8,Plain,Other,0,\r\n')
    got = [tuple(r) for r in scan_metadata(spark, str(path)).orderBy("book_id").collect()]
    assert got == [("7", "Upper\nLower, again", "Someone", "1", "seven.txt"), ("8", "Plain", "Other", "0", "8.txt")]
    assert scan_metadata(spark, str(path), 1).first().book_id == "7"
    lines = spark.createDataFrame([("BOOK_ID,t,a,f",), ("my_book_id_7,A,X,1",)], "value string")
    assert [r.book_id for r in parse_metadata(lines).collect()] == ["my_book_id_7"]


def test_ranged_counts_are_counted_once(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            ran.add(len(frame))
            yield frame
    counts = spark.range(500).selectExpr("id % 50 as book_id", "concat('w', id) as word", "id as n").mapInPandas(counted, "book_id long, word string, n long")
    path = str(tmp_path / "out")
    sinks.write_word_counts(counts, path)
    assert ran.value == 500 and spark.read.parquet(path).count() == 500
    assert [p.name for p in tmp_path.iterdir()] == ["out"]  # what was staged is gone


def test_the_shared_folder_of_a_cluster_must_be_named():
    class Session:
        def __init__(self, master, **settings):
            self.conf = {"spark.sql.warehouse.dir": "file:/driver/only", **settings}
            self.sparkContext = type("Context", (), {"master": master, "getConf": lambda _: settings})()
    given = {"spark.checkpoint.dir": "hdfs://x/shared"}
    assert shared_folder(Session("yarn", **given)) == "hdfs://x/shared"
    assert shared_folder(Session("local[4]")) == "file:/driver/only/written"
    assert shared_folder(Session("yarn", **{"spark.sql.warehouse.dir": "hdfs://x/w"})) == "hdfs://x/w/written"
    with pytest.raises(ValueError):
        shared_folder(Session("yarn"))


def test_csv_records_over_splits_equal_a_plain_reader(spark, tmp_path):
    import csv
    import random
    rng = random.Random(3)
    pieces = ["plain", 'say ""hi""', "a, b", "line\nbreak", "\n\n", "x" * 90, "", " é "]
    for name, n in (("a.csv", 300), ("b.csv", 1), ("c.csv", 40)):
        rows = [f'{i},"{"".join(rng.choice(pieces) for _ in range(rng.randrange(6)))}",A{i},{i % 2},"{i}.txt"' for i in range(n)]
        (tmp_path / name).write_bytes("\r\n".join(["", "book_id,title,author,is_bestseller,filename", *rows, "", ""]).encode())
    want = []
    for name in ("a.csv", "b.csv", "c.csv"):
        with open(tmp_path / name, newline="") as f:
            want += [[x.replace("\r\n", "\n") for x in r] for r in csv.reader(f) if r][1:]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b" if size != before else "4m")
            df = scan_metadata(spark, str(tmp_path))
            got = [[r.book_id, r.title or "", r.author, r.is_bestseller, r.filename] for r in df.collect()]
            assert sorted(got) == sorted(want)
            assert [r.book_id for r in scan_metadata(spark, str(tmp_path), 305).collect()][:305] == [r[0] for r in want[:305]]
        tasks = spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions()
        assert tasks > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert scan_metadata(spark, str(tmp_path / "b.csv")).count() == 1
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("\n")
    assert scan_metadata(spark, str(tmp_path / "empty")).collect() == []


def test_metadata_lines_end_at_line_feeds_only(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(b"1,A\rB,X,1\n2,C,Y,0\r\n")
    assert sorted(r.title for r in scan_metadata_lines(spark, str(tmp_path)).collect()) == ["A\rB", "C"]
