import base64
import os
import subprocess
import sys
from pathlib import Path

import pytest

from lumenframe.sources import files, reshape

ROOT = Path(__file__).resolve().parents[1]


def test_csv_encoding_nulls_and_columns(spark, tmp_path):
    p = tmp_path / "latin.csv"
    p.write_bytes("id,name,c7\n1,Citroën,?\n2,\"a, \"\"b\"\"\",3\n".encode("iso-8859-1"))
    df = files.read_csv(spark, str(p), "id int, name string, c7 int", ["id", "name", "c7"], "ISO-8859-1", "?")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "Citroën", None), (2, 'a, "b"', 3)]
    files.write_csv(df, str(tmp_path / "out"))
    again = files.read_csv(spark, str(tmp_path / "out"), "id int, name string, c7 int")
    assert again.exceptAll(df).isEmpty() and again.count() == 2


def test_labelled_text_and_binary(spark, tmp_path):
    for label in ("pos", "neg"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "1.txt").write_text(f"{label} line\nsecond")
    rows = files.read_labelled_text_dir(spark, str(tmp_path), {"pos": 1, "neg": 0}).collect()
    assert sorted((r["label"], r["text"]) for r in rows) == [(0, "neg line\nsecond"), (1, "pos line\nsecond")]
    raw = files.read_binary_dir(spark, str(tmp_path), r"([^/]+)/[^/]+$").collect()
    assert sorted((r["label"], r["size"]) for r in raw) == [("neg", 15), ("pos", 15)]


def test_edge_list_with_cr_ends(spark, tmp_path):
    (tmp_path / "net.txt").write_bytes(b"0,1,10.5\r0,2,3\r1,2,4.25")
    got = files.read_edge_list(spark, str(tmp_path / "net.txt"), "int")
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 10.5), (0, 2, 3.0), (1, 2, 4.25)]


def test_wordlist(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the  \nand\nthe\n\n")
    assert sorted(r["word"] for r in files.load_wordlist(spark, str(tmp_path / "stop.txt"), ["wa"]).collect()) == ["and", "the", "wa"]


def test_parquet_limit(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p"), limit=7).count() == 7


def test_matrix_json_and_code(spark):
    m = spark.createDataFrame([(0, [0.0, 2.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0])], "id int, row array<double>")
    assert [tuple(r) for r in reshape.matrix_to_edges(m, "id", "row").collect()] == [(0, 1, 2.0)]
    j = spark.createDataFrame([('{"items":[{"full_name":"a/b","stargazers_count":5},{"full_name":"c"}]}',), ("broken",)], "body string")
    got = reshape.flatten_json_items(j, "body", {"full_name": "string", "stargazers_count": "int"})
    assert sorted((r[0], r[1]) for r in got.collect()) == [("a/b", 5), ("c", None)]
    c = spark.createDataFrame([("x/A.java", base64.b64encode(b"class A {}").decode()), ("x/b.py", "eA==")], "path string, content string")
    assert [tuple(r) for r in reshape.decode_code_files(c, "path", "content", "java").collect()] == [("x/A.java", "A.java", "class A {}")]


def test_every_file_of_a_folder_is_read(spark, tmp_path):
    for folder, name in (("pos", "1.txt"), ("pos", "2"), ("neg", "3.TXT")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(f"text {name}")
    rows = files.read_labelled_text_dir(spark, str(tmp_path), {"pos": 1, "neg": 0}).collect()
    assert sorted((r.label, r.text) for r in rows) == [(0, "text 3.TXT"), (1, "text 1.txt"), (1, "text 2")]
    assert files.read_labelled_text_dir(spark, str(tmp_path), glob="*.txt").count() == 1


def test_csv_keeps_line_breaks_and_refuses_bad_lines(spark, tmp_path):
    rows = [(1, 'a\nb, "c"'), (2, "x")]
    files.write_csv(spark.createDataFrame(rows, "id long, t string"), str(tmp_path / "a"))
    back = files.read_csv(spark, str(tmp_path / "a"), "id long, t string", multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "a"), "id long, t string").collect()


def test_package_reaches_workers_from_another_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()
q = e.queries()['nearest']
sys.path.remove({str(ROOT)!r})
print('rows', len(q(s, '/root/testdata/sf0.001').collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]
