import datetime

import pytest

from claimloom.__main__ import arguments


def test_inbox_and_root_are_required(capsys):
    with pytest.raises(SystemExit):
        arguments(["--root", "w"])
    assert "--inbox" in capsys.readouterr().err


def test_ingestion_date_defaults_to_environment_then_today(monkeypatch):
    argv = ["--inbox", "i", "--root", "w"]
    monkeypatch.setenv("INGESTION_DATE", "2024-02-01")
    assert arguments(argv).ingestion_date == datetime.date(2024, 2, 1)
    assert arguments([*argv, "--ingestion_date", "2024-03-01"]).ingestion_date == datetime.date(2024, 3, 1)
    monkeypatch.delenv("INGESTION_DATE")
    assert arguments(argv).ingestion_date == datetime.date.today()
    with pytest.raises(SystemExit):
        arguments([*argv, "--ingestion_date", "soon"])
