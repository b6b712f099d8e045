"""The command line drives the same functions end to end."""

from conftest import SF_SMALL
from vatio import cli
from vatio.session import scratch_path
from vatio.sources import landing, testdata


def test_cli_steps(spark, capsys):
    root = scratch_path(spark, "t-cli")
    raw = testdata.raw_tables(spark, SF_SMALL)
    for table, source, entity in [("generacion_real", "cen", "generacion-real_v3_findByDate"),
                                  ("centrales_info", "cen", "centrales_v4_findByDate"),
                                  ("era5_solar", "era5", "era5_grid_solar"),
                                  ("era5_wind", "era5", "era5_grid_wind")]:
        landing.write_landing(getattr(raw, table), root, source, entity, "2026-06-01", "2026-06-01 00:00:00")
        cli.main(["load", "--landing", root, "--table", table, "--date", "2026-06-01", "--raw", f"{root}/raw"])
    cli.main(["count", "--raw", f"{root}/raw", "--date", "2024-09-08"])
    cli.main(["files", "--landing", root, "--source", "cen", "--date", "2026-06-01"])
    cli.main(["run", "--raw", f"{root}/raw", "--out", f"{root}/models"])
    cli.main(["test", "--models", f"{root}/models"])
    cli.main(["metrics", "--models", f"{root}/models", "--metric", "generacion_sistema_total", "--grain", "month"])
    cli.main(["metrics", "--models", f"{root}/models", "--metric", "generacion", "--by", "central__region"])
    out = capsys.readouterr().out
    assert "generacion_real:" in out and "total_rows" in out and "metric_time" in out and "pass" in out
    assert "central__region" in out
