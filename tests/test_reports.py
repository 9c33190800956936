"""The report's text, through the driver and through tasks."""

from sheafmill.plans import reports
from sheafmill.plans.roles import role

TABLES = ("repositories", "endpoints", "harvest_runs", "harvest_events", "records")


def test_report_without_the_driver(spark, tmp_path):
    tables = {n: role(spark, "/root/testdata/sf0.001", n) for n in TABLES}
    text = reports.render(tables, "now", "db")
    n = reports.errors(tables["harvest_events"], tables["harvest_runs"], tables["endpoints"]).count()
    assert f"### Errors ({n})" in text and text.count("```") == 2 * n > 0 and "### Duplicates (0)" not in text
    reports.write_report(tables, f"{tmp_path}/report.md", "now", "db")
    assert (tmp_path / "report.md").read_text() == text


def test_report_of_nothing(spark, tmp_path):
    tables = {n: role(spark, "/root/testdata/sf0.001", n) for n in TABLES}
    tables |= {"harvest_events": tables["harvest_events"].limit(0), "records": tables["records"].limit(0)}
    text = reports.render(tables, "now", "db")
    assert "✓ _No errors detected._" in text and "✓ _No duplicates detected._" in text
    reports.write_report(tables, f"{tmp_path}/report.md", "now", "db")
    assert (tmp_path / "report.md").read_text() == text
