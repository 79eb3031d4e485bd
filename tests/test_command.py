from __future__ import annotations

from funnelmart.__main__ import main


def test_refresh_and_report_from_csv(spark, tmp_path, capsys):
    (tmp_path / "leads.csv").write_text(
        "id,status_name,user_id,created_at,updated_at\n"
        "1,EOI,5.0,2024-01-01 10:00:00,\n"
        "1,Congrats... It's a sale!,5.0,2024-01-01 10:00:00,2024-03-01 00:00:00\n"
        "2,Low budget,5.0,2024-02-29 00:00:00,\n"
    )
    (tmp_path / "sales.csv").write_text("id,lead_id,actual_value\n1,1,1500000\n2,77,10\n")
    root = str(tmp_path / "wh")
    main(["refresh", root, "--format", "csv", "--leads", str(tmp_path / "leads.csv"),
          "--sales", str(tmp_path / "sales.csv"), "--fill-missing"])
    out = capsys.readouterr().out
    assert "|raw_leads |3          |3          |0             |0       |1       |" in out
    main(["report", root, "kpi_agent_performance"])
    assert "5,2,1,0,50.00\n" in capsys.readouterr().out
    main(["report", root, "audit_sales_lead_coverage"])
    assert "2,1,1,50.00\n" in capsys.readouterr().out
