"""The commands, and their exit status."""

import pytest
from test_loads import ORDERS_HEADER, PAYMENTS_HEADER, base_files, write  # noqa: F401

from tallyhouse.jobs import main, parser
from tallyhouse.sources.warehouse import Warehouse


def test_commands(spark, tmp_path, base_files, capsys):  # noqa: F811
    root = str(tmp_path / "wh")
    assert main(["bootstrap", root, base_files], spark) == 0
    orders = write(tmp_path / "orders_daily.csv", ORDERS_HEADER, "O3,C1,2024-01-03 00:00:00,2")
    payments = write(tmp_path / "payments_daily.csv", PAYMENTS_HEADER, "Y3,O3,paid,3")
    assert main(["load-daily", root, orders, payments], spark) == 0
    assert main(["run", root, "--as-of", "2024-01-04", "--max-errors", "0"], spark) == 1
    assert "quality gate" in capsys.readouterr().out
    assert main(["run", root, "--as-of", "2024-01-04"], spark) == 0
    assert Warehouse(spark, root).fact().count() == 2
    assert main(["checks", root], spark) == 1  # a third of the payments is quarantined
    assert "FAIL  payments_quarantine_rate" in capsys.readouterr().out


def test_window_from_the_environment(monkeypatch):
    monkeypatch.setenv("WINDOW_DAYS", "30")
    assert parser().parse_args(["run", "wh"]).window_days == 30
    assert parser().parse_args(["run", "wh", "--window-days", "3"]).window_days == 3
    monkeypatch.delenv("WINDOW_DAYS")
    assert parser().parse_args(["run", "wh"]).window_days == 7
    with pytest.raises(SystemExit):
        parser().parse_args(["unknown"])
