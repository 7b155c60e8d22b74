"""The command line lists queries and prints oracles without a Spark job."""

from casebook.__main__ import main


def test_list_and_sql(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "bt_16" in out and "ff_12_intended" in out
    assert main(["sql", "bt_16"]) == 0
    assert "percentage_share_by_product" in capsys.readouterr().out
    assert main(["run", "no_such_query"]) == 2
