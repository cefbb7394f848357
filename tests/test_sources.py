import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from msgrisk.functions.labels import coerce_label
from msgrisk.sources.csv import files_by_layout, read_csv
from msgrisk.sources.messages import load_email, load_sms, matching_column


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("body, expected", [
    ('spam,"multi\nline ""q"" x"', [("spam", 'multi\nline "q" x')]),
    ("ham", [("ham", None)]),
    ("spam,a,b", []),
    ("spam,a,", []),
    ("spam,a,,", []),
    ('spam,"a,b,c"', [("spam", "a,b,c")]),
    ('spam,"a,b",c', []),
    ("", []),
])
def test_lines(spark, tmp_path, body, expected):
    path = tmp_path / "m.csv"
    path.write_text(f"v1,v2\nham,ok\n{body}\n", encoding="utf-8")
    assert rows(read_csv(spark, str(path))) == sorted([("ham", "ok"), *expected], key=str)


def test_encoding_is_chosen_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"v1,v2\nham,caf\xe9\n")
    (tmp_path / "b.csv").write_bytes("v1,v2\nham,lừa\n".encode())
    (tmp_path / "c.csv").write_bytes(b"\xef\xbb\xbf" + "v1,v2\nham,đảo\n".encode())
    groups = {k[0]: len(v) for k, v in files_by_layout(spark, str(tmp_path)).items()}
    assert groups == {"UTF-8": 2, "ISO-8859-1": 1}
    assert rows(read_csv(spark, str(tmp_path))) == [("ham", "café"), ("ham", "lừa"), ("ham", "đảo")]


def test_loaders(spark, tmp_path):
    (tmp_path / "s.csv").write_text("V1,V2,x\nham,hello,1\nspam,NA,2\n,later,3\n")
    (tmp_path / "e.csv").write_text("Email Type,Email Text\n1,offer\n0,\n")
    sms = load_sms(spark, str(tmp_path / "s.csv")).select("text", "label", "source")
    assert rows(sms) == [("hello", "ham", "sms"), ("later", None, "sms")]
    email = load_email(spark, str(tmp_path / "e.csv")).select("text", "label", "source")
    assert rows(email) == [("offer", "1", "email")]


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "s.csv").write_text("label,text\n" + "".join(f"ham,t{i:03}\n" for i in range(50)))
    loaded = load_sms(spark, str(tmp_path / "s.csv")).orderBy("msg_id").collect()
    assert [r.text for r in loaded] == [f"t{i:03}" for i in range(50)]


def test_matching_column(spark):
    assert matching_column(spark.createDataFrame([], "Text int, V2 int"), ("v2", "text")) == "V2"
    with pytest.raises(KeyError, match="v2 is among a"):
        matching_column(spark.createDataFrame([], "a int"), ("v2",))


@pytest.mark.parametrize("body, spans", [
    ("ham,one\n", False),
    ("ham,one\r\nspam,two\r\n", False),
    ('"ham","a, ""b"""\nham,5" x\n', False),
    ('ham,"open\nclosed"\n', True),
    ('ham,"a" b\n', True),
    ("ham,one\rspam,two\n", True),
    ("ham,one\n \nspam,two\n", True),
    ("ham,one\n\nspam,two\n", False),
])
def test_files_whose_records_span_lines(spark, tmp_path, body, spans):
    path = tmp_path / "m.csv"
    end = "\r\n" if "\r\n" in body else "\n"
    path.write_bytes(f"\ufeffv1,v2{end}{body}".encode())
    [layout] = files_by_layout(spark, str(path))
    assert layout == ("UTF-8", "v1,v2", spans)
    assert rows(read_csv(spark, str(path))) == rows(read_csv(spark, str(path), multi_line=True))


def test_line_ends_may_differ_within_a_file(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(b"v1,v2\nham,one\r\nspam,two\n")
    assert rows(read_csv(spark, str(tmp_path))) == [("ham", "one"), ("spam", "two")]


def test_large_files_are_split(spark, tmp_path):
    """A file of one-line records is read by several tasks; one with a newline in a cell by one task; the rows are the same."""
    (tmp_path / "a.csv").write_text("label,text\n" + "".join(f'ham,"text {k}, ""x"""\n' for k in range(40_000)))
    (tmp_path / "b.csv").write_text("label,text\n" + "".join(f'spam,"text\n{k}"\n' for k in range(40_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        tasks = {
            name: read_csv(spark, str(tmp_path / f"{name}.csv")).rdd.getNumPartitions() for name in "ab"
        }
        got = read_csv(spark, str(tmp_path))
        counts = {r.label: (r["count"], r.texts) for r in got.groupBy("label").agg(
            F.count("*").alias("count"), F.count_distinct("text").alias("texts")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks["a"] > 3 and tasks["b"] == 1
    assert counts == {"ham": (40_000, 40_000), "spam": (40_000, 40_000)}


def test_files_of_different_headings(spark, tmp_path):
    (tmp_path / "a.csv").write_text("label,text\nham,one\n")
    (tmp_path / "b.csv").write_text("text,label\ntwo,spam\n")
    got = {(r.label, r.text) for r in read_csv(spark, str(tmp_path)).collect()}
    assert got == {("ham", "one"), ("spam", "two")}


def test_bare_quotes_do_not_hide_separators(spark, tmp_path):
    (tmp_path / "a.csv").write_text('v1,v2\nham,5" x,6" y\nham,ok\n"a,b","c ""d"", e"\n')
    assert sorted(r.v1 for r in read_csv(spark, str(tmp_path)).collect()) == ["a,b", "ham"]


@pytest.mark.parametrize("raw, y", [
    ("spam", 1), (" FRAUD ", 1), ("Scam", 1), ("phishing", 1), ("Lừa đảo", 1), ("1", 1), ("ham", 0), ("legit", 0),
    ("Safe", 0), ("hợp lệ", 0), ("0", 0), ("1.0", 1), ("2", 2), ("Safe Email", None), (None, None), ("nan", None),
])
def test_labels(spark, raw, y):
    df = spark.createDataFrame([(raw,)], "label string")
    assert df.select(coerce_label(F.col("label"), strict=False)).first()[0] == y
    if y is None:
        with pytest.raises(PySparkException):
            df.select(coerce_label(F.col("label"))).collect()
    else:
        assert df.select(coerce_label(F.col("label"))).first()[0] == y
