"""Views over joins against recomputing them, after changes on both sides and lost refreshes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltlake.operators import dml, maintenance, views
from siltlake.operators import changelog as log
from siltlake.operators.views import MaintainedJoin

AT = [dt.datetime(2024, 1, d) for d in range(1, 20)]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def sides(spark, tmp_path):
    left, right = str(tmp_path / "sales"), str(tmp_path / "goods")
    sales = spark.range(300).selectExpr(
        "id", "if(id % 3 = 0, 1, id % 11) AS item", "if(id % 17 = 0, NULL, id % 13) AS buyer", "if(id % 19 = 0, NULL, id / 100) AS amount")
    goods = spark.range(10).selectExpr("id AS item", "if(id = 4, NULL, cast(id % 3 as string)) AS kind")
    dml.create_or_replace(sales, left, ["id"], at=AT[0])
    dml.create_or_replace(goods, right, ["item"], at=AT[0])
    return left, right


def view_of(spark, sides, tmp_path):
    return MaintainedJoin(
        spark, *sides, str(tmp_path / "view"), {"item": "item"}, {"kind": F.col("r.kind")}, {"amount": F.col("l.amount")},
        {"buyers": F.col("l.buyer"), "items": F.col("r.item")})


def recomputed(spark, sides):
    l, r = (log.read_version(spark, b) for b in sides)
    joined = l.join(r, "item")
    return joined.groupBy("kind").agg(
        F.count("*"), F.sum(F.col("amount").cast("decimal(38,18)")), F.countDistinct("buyer"), F.countDistinct("item"))


def test_refresh_equals_recompute(spark, sides, tmp_path):
    view, (left, right) = view_of(spark, sides, tmp_path), sides
    new = spark.createDataFrame([(1000, 2, 99, 1.5), (1001, 7, 99, 2.5), (5, 2, 1, 0.5)], "id long, item long, buyer long, amount double")
    goods = spark.createDataFrame([(2, "x"), (3, None), (50, "1")], "item long, kind string")
    steps = [
        lambda: None,
        lambda: dml.update(spark, left, "id < 40", {"item": (F.col("item") + 1) % 10, "amount": F.col("amount") * 2}),
        lambda: (dml.update(spark, right, "item in (1, 5)", {"kind": F.lit("2")}), dml.delete(spark, left, "buyer = 3")),
        lambda: dml.delete(spark, right, "kind = '0'"),
        lambda: (dml.append(new, left), dml.merge(
            spark, right, goods, ["item"], matched_update={"kind": F.col("s.kind")}, insert={"kind": F.col("s.kind")})),
        lambda: maintenance.rewrite(spark, left),
        lambda: dml.delete(spark, left, "true"),
    ]
    for step in steps:
        step()
        assert got(view.refresh()) == got(recomputed(spark, sides))
        assert got(view.refresh()) == got(view.read())


def test_a_refresh_joins_changed_rows_only(spark, sides, tmp_path):
    view = view_of(spark, sides, tmp_path)
    view.refresh()
    dml.update(spark, sides[0], "id = 7", {"amount": F.lit(5.0)})
    view._deltas = {}
    assert got(view._delta((1, 1), (2, 1)).select("_sign")) == [(-1,), (1,)]
    assert view._delta((1, 1), (2, 1)) is view._delta((1, 1), (2, 1))


def test_expired_versions_are_read_anew(spark, sides, tmp_path):
    view = view_of(spark, sides, tmp_path)
    view.refresh()
    dml.update(spark, sides[0], "id < 9", {"buyer": F.lit(500)}, at=AT[1])
    dml.delete(spark, sides[0], "id = 3", at=AT[2])
    maintenance.expire(spark, sides[0], AT[2])
    assert got(view.refresh()) == got(recomputed(spark, sides))
    maintenance.expire(spark, view._refs("buyers"), dt.datetime(2100, 1, 1))
    dml.delete(spark, sides[0], "id = 4", at=AT[3])
    assert got(view.refresh()) == got(recomputed(spark, sides))


@pytest.mark.parametrize("lost", ["_added", "_values_moved"])
def test_a_lost_refresh_adds_nothing_twice(spark, sides, tmp_path, monkeypatch, lost):
    view = view_of(spark, sides, tmp_path)
    view.refresh()
    dml.update(spark, sides[0], "id < 50", {"buyer": F.col("id")}, at=AT[1])
    with monkeypatch.context() as m:  # value counts are merged, the rest is not written
        m.setattr(MaintainedJoin, lost, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            view.refresh()
    dml.delete(spark, sides[0], "id % 4 = 1", at=AT[2])
    dml.update(spark, sides[1], "item = 1", {"kind": F.lit("9")}, at=AT[2])
    assert got(view_of(spark, sides, tmp_path).refresh()) == got(recomputed(spark, sides))


def test_renamed_columns(spark, sides, tmp_path):
    view = view_of(spark, sides, tmp_path)
    view.refresh()
    dml.rename_column(spark, sides[0], "buyer", "who", at=AT[1])
    dml.update(spark, sides[0], "id = 10", {"who": F.lit(77)}, at=AT[2])
    view.distinct = {"buyers": F.col("l.who"), "items": F.col("r.item")}
    joined = log.read_version(spark, sides[0]).join(log.read_version(spark, sides[1]), "item")
    want = joined.groupBy("kind").agg(F.count("*"), F.countDistinct("who"))
    assert got(view.refresh().select("kind", "n", "buyers")) == got(want)


def one_distinct(spark, sides, tmp_path):
    return MaintainedJoin(
        spark, *sides, str(tmp_path / "view"), {"item": "item"}, {"kind": F.col("r.kind")}, {"amount": F.col("l.amount")},
        {"buyers": F.col("l.buyer")})


@pytest.mark.parametrize("few", [0, 5, 1000])
def test_refresh_over_hidden_rows(spark, sides, tmp_path, monkeypatch, few):
    monkeypatch.setattr(views, "FEW", few)
    view, (left, right) = one_distinct(spark, sides, tmp_path), sides
    steps = [
        lambda: None,
        lambda: (dml.delete(spark, left, "buyer % 3 = 1"), dml.update(spark, right, "item in (1, 2)", {"kind": F.lit("z")})),
        lambda: dml.delete(spark, right, "item in (1, 6)"),
        lambda: (dml.update(spark, left, "id < 90", {"item": F.col("item") + 1}), dml.update(spark, left, "id < 30", {"amount": F.lit(2.0)})),
        lambda: (dml.rename_column(spark, left, "item", "what"), dml.rename_column(spark, left, "what", "item"), dml.update(
            spark, right, "item = 7", {"kind": F.lit(None).cast("string")}), dml.delete(spark, left, "id % 7 = 2")),
    ]
    for step in steps:
        step()
        assert got(view.refresh()) == got(recomputed(spark, sides).drop("count(DISTINCT item)"))


def test_a_first_build_joins_once_and_a_merge_tells_what_moved(spark, sides, tmp_path, monkeypatch):
    view, joins, join = one_distinct(spark, sides, tmp_path), [], MaintainedJoin._join
    monkeypatch.setattr(MaintainedJoin, "_join", lambda self, *a: joins.append(1) or join(self, *a))
    monkeypatch.setattr(views, "changes", lambda *a: 1 / 0)
    assert got(view.refresh()) == got(recomputed(spark, sides).drop("count(DISTINCT item)")) and len(joins) == 1
    dml.delete(spark, sides[0], "buyer in (2, 5)")
    assert got(view.refresh()) == got(recomputed(spark, sides).drop("count(DISTINCT item)")) and len(joins) == 2


def test_rows_that_join_no_change_are_left_before_hidden_ones_are_looked_up(spark, sides, tmp_path):
    view = one_distinct(spark, sides, tmp_path)
    dml.delete(spark, sides[0], "buyer = 3")
    wanted = spark.createDataFrame([(4, "x")], "item long, kind string")
    rows = log.read_version(spark, sides[0])
    assert got(view._side(sides[0], 2, wanted, {"item": "item"})) == got(rows.where("item = 4"))
    assert got(view._side(sides[0], 2)) == got(rows)


def test_a_merge_refuses_a_source_that_repeats_a_key(spark, sides):
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "item long, kind string")
    with pytest.raises(Exception, match="source repeats a value"):
        dml.merge(spark, sides[1], twice, ["item"], matched_update={"kind": F.col("s.kind")})
    assert len(log.load(spark, sides[1])) == 1
