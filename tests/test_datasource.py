"""Registered data sources: ranges of any size, pushed filters, odd files."""

import random

import pytest

from grafloom.sources import datasource


@pytest.mark.parametrize("delimiter", [b"\n", b"\n\n", b"$$$$"])
def test_records_are_read_once_wherever_ranges_end(tmp_path, monkeypatch, delimiter):
    r = random.Random(1)
    for n in range(40):
        texts = ["".join(r.choice("ab$\nü") for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 6))]
        data = delimiter.join(t.encode() for t in texts)
        (tmp_path / "f").write_bytes(data)
        want = [x for x in data.decode().split(delimiter.decode())]
        for size in (1, 2, 3, 5, 1000):
            monkeypatch.setattr(datasource, "STEP", r.choice([1, 2, 7, 100]))
            found = [x for a in range(0, len(data), size) for x in datasource.records(str(tmp_path / "f"), a, min(a + size, len(data)), delimiter)]
            assert [x for x in found if x] == [x for x in want if x], (n, size, data)


def test_pushed_filters_make_fewer_rows(spark, tmp_path):
    datasource.register(spark)
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"part {i}.sdf").write_text("".join(f"mol\n> <id>\nm{i}{k}\n\n> <kind>\n{'rare' if k == 5 else 'common'}\n\n> <note>\none\n two\n\n$$$$\n" for k in range(20)))
    (tmp_path / "in" / "_SUCCESS").write_text("no record")
    rows = spark.read.format("sdf").option("tags", "id,kind,note,none").option("pieceBytes", 64).option("pushFilters", "true").load(str(tmp_path / "in"))
    load = lambda: spark.read.format("sdf").option("tags", "id,kind,note,none").option("pieceBytes", 64).option("pushFilters", "true").load(str(tmp_path / "in"))
    assert rows.count() == 60 and load().where("id = 'm01'").first()["note"] == "one two" and load().where("none is null").count() == 60
    rare = load().where("kind = 'rare' and id in ('m05', 'm15', 'x')")
    assert sorted(r["id"] for r in rare.collect()) == ["m05", "m15"]
    # what the reader yields, before Spark filters anything
    source = datasource.SdfSource({"path": str(tmp_path / "in"), "tags": "id,kind", "pushFilters": "true"})
    reader = source.reader(None)
    left = list(reader.pushFilters([datasource.ds.EqualTo(("kind",), "rare"), datasource.ds.GreaterThan(("id",), "m1")]))
    assert len(left) == 1 and sorted(x for p in reader.partitions() for x in reader.read(p)) == [("m05", "rare"), ("m15", "rare"), ("m25", "rare")]
    assert "PushedFilters" in rare._jdf.queryExecution().executedPlan().toString() or rare.count() == 2
    assert len(datasource.files(str(tmp_path / "in" / "part 1*"))) == 1


def test_one_frame_filtered_in_two_ways(spark, tmp_path):
    datasource.register(spark)
    (tmp_path / "m.sdf").write_text("".join(f"> <id>\nm{k}\n\n> <kind>\n{k % 3}\n\n$$$$\n" for k in range(30)))
    rows = spark.read.format("sdf").option("tags", "id,kind").load(str(tmp_path / "m.sdf"))
    both = rows.where("kind = '0'").unionByName(rows.where("kind = '1'"))
    assert {r["kind"]: r["n"] for r in both.groupBy("kind").agg({"id": "count"}).withColumnRenamed("count(id)", "n").collect()} == {"0": 10, "1": 10}


def test_obo_terms(spark, tmp_path):
    datasource.register(spark)
    (tmp_path / "d.obo").write_text("format-version: 1.2\n\n[Term]\nid: A:1\nname: one\nis_a: A:0 ! zero\nis_a: A:9\n\n[Term]\nid: A:2\nname: two\nis_obsolete: true\n\n[Typedef]\nid: part_of\n\n[Term]\nid: A:3")
    assert sorted(tuple(r) for r in spark.read.format("obo").load(str(tmp_path / "d.obo")).collect()) == [("A:1", "one", ["A:0", "A:9"]), ("A:3", "", [])]
