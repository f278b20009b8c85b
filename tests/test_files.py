from msgtriage.schema import MESSAGES_SCHEMA
from msgtriage.session import scratch_path
from msgtriage.sources import files


def test_csv_texts_come_back_as_they_were(spark):
    texts = [
        None, "", " ", "  lead", "trail \n", "\n", "a\r\nb", "a,b;c", 'say "x"', '"', '""', "back\\slash", '\\"', "\\N", "null", "é😀", "tab\t", "#c", "'",
    ]
    rows = [(i, t, t, None if i % 3 else "g") for i, t in enumerate(texts)]
    path = scratch_path(spark, "csv-texts")
    files.write_csv(spark.createDataFrame(rows, MESSAGES_SCHEMA), path)
    back = sorted(tuple(r) for r in files.read_messages(spark, path).collect())
    assert back == sorted(rows)


def test_plain_csv_blank_is_null(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,message,original,genre\n1,hello,,news\n2,"two\nlines",x,\n')
    got = sorted(tuple(r) for r in files.read_messages(spark, str(tmp_path / "m.csv")).collect())
    assert got == [(1, "hello", None, "news"), (2, "two\nlines", "x", None)]


def test_word_vectors_longer_than_a_fixed_length(spark):
    path = scratch_path(spark, "wv")
    rows = [("a", [0.5, -1.0, 2.25]), ("b", [1.0, 0.0, 3.0])]
    files.write_word_vectors(spark.createDataFrame(rows, "word string, vector array<double>"), path)
    assert sorted(map(tuple, files.read_word_vectors(spark, path, 3).collect())) == rows
