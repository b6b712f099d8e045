"""The daily plans against sums kept by hand over the collected hourly rows."""

from collections import defaultdict


def _hours(models):
    return [r for r in models.generation_enriched.collect() if r["state_central"] == "normal"]


def _known(values):
    return [v for v in values if v is not None]


def test_system_summary_by_hand(models):
    days = defaultdict(list)
    for r in _hours(models):
        days[r["fecha"]].append(r)
    got = {r["fecha"]: r for r in models.system_summary.collect()}
    assert got.keys() == days.keys() and got
    for day, rows in days.items():
        of = lambda keep: sum(_known(r["generacion_real_mw"] for r in rows if keep(r)))  # noqa: E731, B023
        out = got[day]
        assert out["generacion_total_mwh"] == of(lambda r: True)
        assert out["generacion_renovable_mwh"] == of(lambda r: r["clasificacion_fuente"] == "Renovable")
        running = {r["id_central"] for r in rows if (r["generacion_real_mw"] or 0) > 0}
        assert out["num_centrales_activas"] == len(running)
        by_hour, rating, energy = defaultdict(float), {}, defaultdict(float)
        for r in rows:
            by_hour[r["hora"]] += r["generacion_real_mw"] or 0
            energy[r["tipo_tecnologia"]] += r["generacion_real_mw"] or 0
            if r["potencia_maxima_mw"] is not None:
                rating[r["id_central"]] = max(rating.get(r["id_central"], 0), r["potencia_maxima_mw"])
        assert (out["demanda_maxima_mw"], out["demanda_minima_mw"]) == (max(by_hour.values()), min(by_hour.values()))
        assert out["capacidad_instalada_total_mw"] == sum(rating.values())
        best = max(energy.values())
        assert out["top_tecnologia"] == min((t for t, e in energy.items() if e == best), key=lambda t: t or "")


def test_daily_by_technology_by_hand(models):
    rows = [r for r in _hours(models) if r["tipo_tecnologia"] is not None]
    energy, hours, active, rating = defaultdict(float), defaultdict(int), defaultdict(set), defaultdict(dict)
    for r in rows:
        wide, key = (r["fecha"], r["tipo_tecnologia"]), (r["fecha"], r["tipo_tecnologia"], r["clasificacion_fuente"])
        mw, rated = r["generacion_real_mw"] or 0, rating[wide]
        energy[key] += mw
        hours[key] += mw > 0
        if mw > 0:
            active[key].add(r["id_central"])
        if r["potencia_maxima_mw"] is not None:
            rated[r["id_central"]] = max(rated.get(r["id_central"], 0), r["potencia_maxima_mw"])
    got = {(r["fecha"], r["tipo_tecnologia"], r["clasificacion_fuente"]): r for r in models.daily_by_technology.collect()}
    assert got.keys() == energy.keys() and got
    for key, out in got.items():
        want = (energy[key], hours[key], len(active[key]), sum(rating[key[:2]].values()) or None)
        assert (out["generacion_total_mwh"], out["horas_con_generacion"], out["num_centrales_activas"],
                out["capacidad_instalada_mw"]) == want
