"""The command line: settings per dataset, rejects, batches, the run log."""

import argparse

import pytest

from strata import __main__ as cli
from strata.session import scratch_path
from strata.sources.catalog import TableStore
from strata.sources.run_log import RunLog


@pytest.fixture
def run(spark, monkeypatch):
    store = TableStore.scratch(spark)
    monkeypatch.setattr(cli, "apply_scale", lambda *_: None)  # the test session's settings stay
    monkeypatch.setattr(cli, "_active_or_default", lambda: spark)

    def call(layer, *args):
        cli.main([layer, "--database", store.database, *args])
    return store, call


def landing(spark, text):
    path = scratch_path(spark, "t-cli")
    spark.createDataFrame([(text.rstrip("\n"),)], "t string").write.text(path)
    return path


def test_settings_of_one_dataset():
    args = argparse.Namespace(
        dataset=["a=/x", "b=/y"], description="d", sep=";", row_cap=-1, infer_types=False, multi_line=False,
        set=["b.sep=,", "b.infer_types=true", "a.row_cap=7"], column=["n=bigint", "b:T (=x)=double"])
    a, b = cli._specs(args)
    assert (a.sep, a.row_cap, a.infer_types, a.columns) == (";", 7, False, (("n", "bigint"),))
    assert (b.sep, b.row_cap, b.infer_types) == (",", -1, True)
    assert b.columns == (("n", "bigint"), ("T (=x)", "double"))
    with pytest.raises(SystemExit):
        cli._specs(argparse.Namespace(**{**vars(args), "set": ["c.sep=,"]}))


def test_all_layers_with_rejects_and_log(spark, run, capsys):
    store, call = run
    head = "region;horodate;profil;total_energie_soutiree_wh;nb_points_soutirage\n"
    one = landing(spark, head + "n;2020-01-01;p;10.5;9\ns;2021-01-01;p;3;7\nn;2020-01-01;p;oops;9\n")
    call("all", "--dataset", f"e={one}", "--rejects", "--run-id", "r1", "--file-mb", "1",
         "--column", "total_energie_soutiree_wh=double", "--column", "nb_points_soutirage=bigint")
    assert "3 records read, 2 kept, 1 rejected" in capsys.readouterr().out
    assert store.read("gold_region_year_e").count() == 2
    assert {r.layer for r in RunLog(store).read().collect()} == {"bronze-e", "silver-e", "gold-e"}
    call("log")
    assert "gold_region_year_e" in capsys.readouterr().out


def test_batches(spark, run, capsys):
    store, call = run
    head = "region,horodate,total_energie_soutiree_wh,nb_points_soutirage\n"
    days = [head + "n,2020-01-01,10.5,9\ns,2020-01-02,3.5,7\n", head + "n,2020-01-01,10.5,9\nn,2021-01-02,4.5,8\n"]
    for i, text in enumerate(days):
        call("batch", "--dataset", f"e={landing(spark, text)}", "--set", "e.sep=,", "--infer-types",
             "--batch", f"day{i}")
    assert "years [2021]" in capsys.readouterr().out
    assert sorted((r.region, r.annee, r.energy_total) for r in store.read("gold_region_year_e").collect()) == [
        ("n", 2020, 10.5), ("n", 2021, 4.5), ("s", 2020, 3.5)]
    assert RunLog(store).read().count() == 2
