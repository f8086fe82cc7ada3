"""Members of zip archives as rows: whole, by column, malformed, missing."""

from __future__ import annotations

import zipfile

import pytest

from almanac.sources import archives


def write(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_archives_of_a_folder(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    long = "\n".join(f"k{k}\tv{k}\tw" for k in range(200_000))
    write(tmp_path / "a.zip", {"DATA.tsv": f'id\tvalue\trest\n1\t"quoted\tx\n2\t\ty\nshort\n3\tc\td\te\n4\té \tz\n', "OTHER.tsv": "id\n9\n"})
    write(tmp_path / "deep" / "b.zip", {"in/data.TSV": f"value\tid\trest\n{long}\n"})
    write(tmp_path / "c.zip", {"NONE.tsv": "id\n5\n"})
    write(tmp_path / "d.zip", {"DATA.tsv": ""})
    write(tmp_path / "e.zip", {"DATA.tsv": "id\trest\n6\tr\n"})
    (tmp_path / "f.txt").write_text("no archive")
    got = archives.archived(spark, str(tmp_path), "data.tsv", ["value", "id"])
    assert got.rdd.getNumPartitions() == 5 and got.columns == ["value", "id"]
    rows = [(r.id, r.value) for r in got.collect()]
    assert sorted(r for r in rows if r[0][0] != "v") == [("1", '"quoted'), ("2", None), ("4", "é "), ("6", None)]
    assert {r for r in rows if r[0][0] == "v"} == {(f"v{k}", f"k{k}") for k in range(200_000)}
    assert archives.archived(spark, f"file://{tmp_path}/a.zip", "OTHER.tsv", ["id"]).collect() == [("9",)]
    with pytest.raises(Exception, match="Expected 3 columns"):
        archives.archived(spark, str(tmp_path), "DATA.tsv", ["id"], "FAILFAST").collect()
    with pytest.raises(Exception, match="mode"):
        archives.archived(spark, str(tmp_path), "DATA.tsv", ["id"], "OTHER").collect()


def test_written_archives_are_read_back(spark, tmp_path):
    a = spark.createDataFrame([(str(k), f"x\t{k}", None) for k in range(100)], "k string, v string, w string")
    b = spark.createDataFrame([(str(k % 7), str(k)) for k in range(50)], "k string, n string")
    n = archives.archive({"A.tsv": a, "B.tsv": b}, "k", 4, str(tmp_path / "z"))
    assert n == len(list((tmp_path / "z").iterdir())) == 4
    assert sorted((r.k, r.v, r.w) for r in archives.archived(spark, str(tmp_path / "z"), "A.tsv", ["k", "v", "w"]).collect()) == sorted((str(k), f"x {k}", None) for k in range(100))
    assert sorted((r.k, r.n) for r in archives.archived(spark, str(tmp_path / "z"), "B.tsv", ["k", "n"]).collect()) == sorted((str(k % 7), str(k)) for k in range(50))


def test_archives_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "LINES", 500)
    a = spark.range(9_000).selectExpr("cast(id AS string) AS k", "cast(id * 3 AS string) AS v")
    b = spark.range(1_000).selectExpr("cast(id AS string) AS k", "'x' AS w")
    where = tmp_path / "z"
    assert archives.archive({"A.tsv": a, "B.tsv": b}, "k", 4, str(where)) == len(list(where.iterdir())) == 20
    found = archives.archived(spark, str(where), "A.tsv", ["k", "v"])
    sizes = [len(part) for part in found.rdd.glom().collect()]
    assert len(sizes) == 20 and sum(sizes) == 9_000 and max(sizes) < 2 * 450
    assert {(r.k, r.v) for r in found.collect()} == {(str(k), str(3 * k)) for k in range(9_000)}
    assert {(r.k, r.w) for r in archives.archived(spark, str(where), "B.tsv", ["k", "w"]).collect()} == {(str(k), "x") for k in range(1_000)}
