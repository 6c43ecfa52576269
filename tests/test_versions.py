"""Versioned tables: merges that touch little, and commits of which one wins."""

import threading

import pytest
from pyspark.sql import functions as F

from evgraph.operators.upsert import patch, upsert
from evgraph.sources.versions import Conflict, VersionedTable

ROW = "uid string, name string, amount double, part int"


def base(spark, n=400):
    return spark.range(n).selectExpr("concat('n', id) AS uid", "'old' AS name", "CAST(id AS DOUBLE) AS amount", "1 AS part")


def updates(spark, ids, name="new", seq=1):
    return spark.createDataFrame([(f"n{i}", name, -1.0, 2, seq) for i in ids], ROW + ", seq long")


def files(table, version=None):
    return {f.split("/data/")[1] for f in table.read(version).inputFiles()}


def merge(rows, new):
    return upsert(rows, new, ["uid"])


def test_untouched_files_keep_their_names(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.versions() == [] and t.replace(base(spark), ["uid"], buckets=16) == 0
    before = files(t)
    assert t.merge(updates(spark, [3, 3, 1000], seq=5).unionByName(updates(spark, [3], "last", 9)), merge) == 1
    got = {r["uid"]: (r["name"], r["amount"]) for r in t.read().collect()}
    assert len(got) == 401 and got["n3"] == ("last", -1.0) and got["n1000"] == ("new", -1.0) and got["n4"] == ("old", 4.0)
    after = files(t)
    assert len(before) == 16 and len(before & after) >= 14 and 1 <= len(after - before) <= 2
    assert {r["name"] for r in t.read(0).collect()} == {"old"} and files(t, 0) == before and t.versions() == [0, 1]
    assert t.merge(updates(spark, []), merge) == 1 and t.versions() == [0, 1]


def test_patch_and_replace(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace(base(spark, 50), ["uid"], buckets=4)
    sparse = spark.createDataFrame([("n7", None, 5.5, ["name"]), ("n8", "x", 5.5, ["amount"]), ("m", "born", 1.0, ["name", "amount"])], "uid string, name string, amount double, present array<string>")
    t.merge(sparse, lambda rows, new: patch(rows, new, ["uid"]))
    got = {r["uid"]: (r["name"], r["amount"]) for r in t.read().collect()}
    assert len(got) == 51 and got["n7"] == (None, 7.0) and got["n8"] == ("old", 5.5) and got["m"] == ("born", 1.0)
    gone = lambda rows, new: rows.join(new.select("uid"), "uid", "left_anti")
    assert t.merge(spark.createDataFrame([(f"n{i}",) for i in range(50)] + [("m",)], "uid string"), gone) == 2 and t.read().count() == 0
    assert t.replace(base(spark, 3), ["uid"], buckets=2) == 3 and t.read().count() == 3 and t.read(1).count() == 51
    t.replace(base(spark, 3).limit(0), ["uid"])
    assert t.read().columns == ["uid", "name", "amount", "part"] and t.read().count() == 0


def test_what_is_refused(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError):
        t.read()
    with pytest.raises(ValueError, match="_bucket"):
        t.replace(base(spark).withColumn("_bucket", F.lit(1)), ["uid"])
    t.replace(base(spark, 40), ["uid"], buckets=8)
    with pytest.raises(LookupError):
        t.read(7)
    with pytest.raises(ValueError, match="no update has"):
        t.merge(updates(spark, [1]), lambda rows, new: base(spark, 40))
    with pytest.raises(Conflict):
        t.replace(base(spark), ["uid"], after=-1)
    assert t.versions() == [0] and t.read().count() == 40


def test_of_two_writers_one_wins(spark, tmp_path):
    """Both start from the same version and meet before they commit."""
    root = str(tmp_path / "t")
    VersionedTable(spark, root).replace(base(spark), ["uid"], buckets=8)
    meet, done = threading.Barrier(2), {}

    def write(name):
        def together(rows, new):
            meet.wait(60)
            return merge(rows, new)

        try:
            done[name] = VersionedTable(spark, root).merge(updates(spark, range(10), name), together)
        except Conflict as e:
            done[name] = e

    writers = [threading.Thread(target=write, args=(n,)) for n in ("one", "two")]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    won = [n for n, x in done.items() if x == 1]
    assert len(won) == 1 and sum(isinstance(x, Conflict) for x in done.values()) == 1
    t = VersionedTable(spark, root)
    names = {r["name"] for r in t.read().where("amount = -1").collect()}
    assert t.versions() == [0, 1] and names == set(won) and t.read().count() == 400
    loser = ({"one", "two"} - names).pop()
    assert t.merge(updates(spark, range(10), loser), merge, after=1) == 2 and {r["name"] for r in t.read().where("amount = -1").collect()} == {loser}
