import random

import pytest

from msgtriage.schema import MESSAGES_SCHEMA
from msgtriage.session import scratch_path
from msgtriage.sources import csv_blocks, files


@pytest.fixture
def blocks_of(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield size
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_line_ends():
    cases = [
        ("a,b", False, False), ('a,"b', False, True), ('"a ""x"" b",c', False, False), ('x",y', True, False), ('x"",y', True, True),
        ('5" pipe,b', False, False), ('"', False, True), ('"', True, False), ('""', True, True), ('""', False, False), ('a,"","', False, True), ('x","y', True, True),
    ]
    for line, inside, want in cases:
        assert csv_blocks.ends_inside(line.encode(), inside) is want, line


@pytest.mark.parametrize("size", [7, 40, 400, 1 << 20])
def test_equal_to_the_one_task_reader(spark, blocks_of, size):
    rng = random.Random(size)
    texts = [None, "", "\n", "a\r\nb", 'say "x"', '"', '""\n"', ",", '","', "\n,\n", "é😀\nñ", "long " * 30 + '\n"end"', "back\\slash", "tab\t", '\n\n"\n\n']
    rows = [(i, rng.choice(texts), rng.choice(texts), rng.choice([None, "news"])) for i in range(60)]
    path = scratch_path(spark, "csv-blocks-test")
    files.write_csv(spark.createDataFrame(rows, MESSAGES_SCHEMA).coalesce(2), path)
    want = sorted(map(repr, map(tuple, files.read_csv(spark, path, MESSAGES_SCHEMA).collect())))
    assert want == sorted(map(repr, rows))
    blocks_of(size)
    assert sorted(map(repr, map(tuple, files.read_csv_blocks(spark, path, MESSAGES_SCHEMA).collect()))) == want


@pytest.mark.parametrize("size", [5, 30, 1 << 20])
def test_files_by_hand(spark, blocks_of, size, tmp_path):
    """Windows line ends, empty lines, a header over two lines, quotes inside a plain field, a wrong number, one field over many blocks."""
    (tmp_path / "a.csv").write_bytes(b'id,message,original,genre\r\n1,"two\r\nlines",x,\r\n\r\n2,5" pipe,y,news\r\n')
    (tmp_path / "b.csv").write_bytes(b'\nid,message,"orig\ninal",genre\n3,"' + b"line of it\n" * 40 + b'",z,\nfour,a,b,c\n5,"",,end')
    (tmp_path / "c.csv").write_bytes(b"")
    (tmp_path / "d.csv").write_bytes(b"id,message,original,genre\n")
    blocks_of(size)
    got = sorted((tuple(r) for r in files.read_csv_blocks(spark, str(tmp_path), MESSAGES_SCHEMA).collect()), key=lambda r: (r[0] is None, r[0]))
    assert got == [
        (1, "two\r\nlines", "x", None), (2, '5" pipe', "y", "news"), (3, "line of it\n" * 40, "z", None), (5, "", None, "end"), (None, "a", "b", "c"),
    ]


def test_many_tasks_read_one_file(spark, blocks_of, tmp_path):
    body = "".join(f'{i},"text {i}\nmore",o,g\n' for i in range(2000))
    (tmp_path / "m.csv").write_text("id,message,original,genre\n" + body)
    blocks_of(4096)
    got = files.read_csv_blocks(spark, str(tmp_path / "m.csv"), MESSAGES_SCHEMA)
    assert got.rdd.getNumPartitions() > 8
    assert sorted((r.id, r.message) for r in got.collect()) == [(i, f"text {i}\nmore") for i in range(2000)]
