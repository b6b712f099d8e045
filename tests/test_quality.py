"""Each data-quality test kind passes on clean data and fails on a broken row."""

from vatio.operators.quality import Check, run_checks


def results(spark, tables, checks):
    return {r.test_id: (r.failures, r.status) for r in run_checks(tables, checks).collect()}


def test_kinds(spark):
    plants = spark.createDataFrame([(1, "normal", -33.0, -70.0), (2, "otro", 10.0, -70.0), (2, "normal", None, None),
                                    (None, "normal", -30.0, -70.0)], "id long, state string, lat double, lon double")
    gen = spark.createDataFrame([(1, 0.5), (3, 1.2), (None, None)], "id long, f double")
    tables = {"plants": plants, "gen": gen}
    checks = [
        Check(1, "plants", "not_null", "id"),
        Check(2, "plants", "unique", "id"),
        Check(3, "plants", "accepted_values", "state", {"values": ["normal", "en_revision"]}),
        Check(4, "gen", "relationships", "id", {"to": "plants", "field": "id"}),
        Check(5, "gen", "accepted_range", "f", {"min": 0, "max": 1}),
        Check(6, "plants", "unique_combination", None, {"columns": ["id", "state"]}),
        Check(7, "plants", "bbox", "lat, lon", {"lat": "lat", "lon": "lon", "lat_min": -65.0, "lat_max": -15.0,
                                                 "lon_min": -120.0, "lon_max": -60.0}, severity="warn"),
        Check(8, "gen", "not_null", "f", severity="warn"),
    ]
    got = results(spark, tables, checks)
    assert got == {1: (1, "fail"), 2: (1, "fail"), 3: (1, "fail"), 4: (1, "fail"), 5: (1, "fail"),
                   6: (0, "pass"), 7: (1, "warn"), 8: (1, "warn")}


def test_error_threshold(spark):
    def run(n):
        df = spark.range(n + 5).selectExpr("CASE WHEN id < %d THEN NULL ELSE id END AS e" % n)
        return results(spark, {"p": df}, [Check(1, "p", "not_null", "e", severity="warn", error_if=">100")])[1]
    assert run(100) == (100, "warn")
    assert run(101) == (101, "fail")
    assert results(spark, {"p": spark.range(3)}, [Check(1, "p", "not_null", "id", severity="warn", error_if=">100")])[1] \
        == (0, "pass")


def test_declared_suite_runs(models):
    from vatio.plans.tests_declared import CHECKS
    names = {c.model for c in CHECKS}
    out = run_checks({n: getattr(models, n) for n in names}, CHECKS)
    rows = out.collect()
    assert len(rows) == 82 and {r.status for r in rows} <= {"pass", "warn", "fail"}
    by_id = {r.test_id: r for r in rows}
    assert by_id[67].status == "fail"      # registry keeps two versions of some plants
    assert by_id[76].failures == 0         # deduplicated hourly keys
