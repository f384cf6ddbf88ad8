import json

from lexforge.sources import jsonl
from lexforge.streaming import chunks


def test_jsonl(spark, tmp_path):
    lines = [json.dumps({"id": 7, "link": "http://a/b-c.htm", "passage": "Điều 1. A"}), "", "{bad", "[1]", "3", json.dumps({"id": 0, "passage": "x", "extra": {"k": 1}}), json.dumps({"id": "n", "passage": None}), json.dumps({"passage": 5})]
    (tmp_path / "a.jsonl").write_text("\n".join(lines), encoding="utf-8")
    rows = jsonl.read_corpus(spark, str(tmp_path / "a.jsonl"), fill_name=True).orderBy("line_no").collect()
    assert [r.status for r in rows] == ["ok", "blank", "bad_json", "not_an_object", "not_an_object", "ok", "empty_text", "empty_text"]
    assert (rows[0].id, rows[0].name, rows[0].passage) == ("7", "b c", "Điều 1. A") and rows[5].id == "line6"
    assert json.loads(rows[5].meta)["id"] in ("0", 0)


def test_many_lines_are_numbered_in_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(f"l{i}" for i in range(1, 2001)))
    assert jsonl.count_lines(spark, str(tmp_path / "a.txt")) == 2000
    assert jsonl.read_lines(spark, str(tmp_path / "a.txt")).where("line <> concat('l', line_no)").count() == 0


def test_ids_sinks_and_text(spark, tmp_path):
    (tmp_path / "report.json").write_text(json.dumps({"slow_documents": [{"id": "a"}, {"id": "b"}]}))
    (tmp_path / "ids.txt").write_text("a\n\n b \n")
    for ids in (jsonl.read_ids(spark, ids="a, b,"), jsonl.read_ids(spark, str(tmp_path / "report.json")), jsonl.read_ids(spark, str(tmp_path / "ids.txt"))):
        assert sorted(r.id for r in ids.collect()) == ["a", "b"]
    df = spark.createDataFrame([("a", None), ("c", "x")], "id string, v string")
    assert [r.id for r in jsonl.keep_ids(df, ids).collect()] == ["a"]
    jsonl.write_jsonl(df.coalesce(1), str(tmp_path / "out"))
    assert '"v":null' in next((tmp_path / "out").glob("part-*")).read_text()
    jsonl.write_jsonl(df, str(tmp_path / "split"), "id")
    assert (tmp_path / "split" / "id=a").exists()
    jsonl.write_report(df.limit(1), str(tmp_path / "rep"))
    (tmp_path / "doc.txt").write_text("hai\ndòng", encoding="utf-8")
    assert jsonl.read_plain_text(spark, str(tmp_path / "doc.txt")).first().passage == "hai\ndòng"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"id": str(i), "link": "", "name": "", "passage": "Một câu giống nhau. " * 80} for i in range(3)]
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    pieces = chunks.first_contents(chunks.stream_pieces(chunks.read_documents(spark, str(tmp_path / "in")), max_chars=300))
    query = pieces.writeStream.format("memory").queryName("pieces_test").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = spark.table("pieces_test")
    assert got.count() == got.select("content").distinct().count() > 0
