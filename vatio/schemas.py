"""Raw table contracts and landing shapes.

Zone-less local datetimes (DATETIME) and UTC instants (TIMESTAMP) are both
``timestamp_ntz``; instants hold UTC wall-clock time. Landing JSON carries
instants as ISO-8601 text with an offset, so the landing schemas read them as
zoned ``timestamp`` and the loader normalises them (see sources/landing.py).
"""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, LongType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)

L, D, S, NTZ = LongType(), DoubleType(), StringType(), TimestampNTZType()


def _struct(cols, instant=NTZ) -> StructType:
    fields = []
    for name, typ in cols:
        fields.append(StructField(name, instant if typ == "instant" else typ, True))
    return StructType(fields)


GENERATION_COLUMNS = [
    ("id_opreal", L), ("llave_opreal", S), ("id_central", L), ("central", S),
    ("gen_real_mw", D), ("fecha_hora", NTZ), ("hora", L), ("potencia_maxima", S),
    ("id_propietario", L), ("propietario", S), ("id_coordinado", L),
    ("coordinado", S), ("tipo_tecnologia", S), ("subtipo_tecnologia", S),
    ("factor_ernc", D), ("alcance", S), ("valor_ernc", D), ("_extracted_at", "instant"),
]

PLANT_COLUMNS = [
    ("central", S), ("propietario", S), ("tipo_central", S), ("id_central", L),
    ("instalacion", S), ("coordinado", S), ("centro_control", S), ("estado", S),
    ("cant_und_gen", L), ("punto_conexion", S), ("pot_max_bruta", S),
    ("cons_propio", S), ("capac_max", S), ("pot_min_tecnica", S),
    ("fecha_ent_oper", S), ("tipo_conv_energia", S), ("conv_ernc", S),
    ("combus_termo", S), ("tipo_tecnologia", S), ("region", S), ("provincia", S),
    ("comuna", S), ("zona_huso", S), ("coordenada_este", S),
    ("coordenada_norte", S), ("_extracted_at", "instant"),
]

ERA5_SOLAR_COLUMNS = [
    ("valid_time", "instant"), ("latitude", D), ("longitude", D), ("t2m", D),
    ("ssrd", D), ("tcc", D), ("fdir", D), ("_extracted_at", "instant"),
]

ERA5_WIND_COLUMNS = [
    ("valid_time", "instant"), ("latitude", D), ("longitude", D), ("u100", D),
    ("v100", D), ("u10", D), ("v10", D), ("sp", D), ("t2m", D), ("i10fg", D),
    ("_extracted_at", "instant"),
]

# Raw warehouse contracts (what the models read).
GENERATION = _struct(GENERATION_COLUMNS)
PLANTS = _struct(PLANT_COLUMNS)
ERA5_SOLAR = _struct(ERA5_SOLAR_COLUMNS)
ERA5_WIND = _struct(ERA5_WIND_COLUMNS)

# Landing JSONL shapes: instants arrive as zoned ISO-8601 text.
LANDING = {
    "generacion_real": _struct(GENERATION_COLUMNS, TimestampType()),
    "centrales_info": _struct(PLANT_COLUMNS, TimestampType()),
    "era5_solar": _struct(ERA5_SOLAR_COLUMNS, TimestampType()),
    "era5_wind": _struct(ERA5_WIND_COLUMNS, TimestampType()),
}

RAW = {"generacion_real": GENERATION, "centrales_info": PLANTS,
       "era5_solar": ERA5_SOLAR, "era5_wind": ERA5_WIND}

# Columns of the ERA5 delivery per variable preset (CSV without the stamp).
ERA5_PRESET_COLUMNS = {
    "solar": [c for c, _ in ERA5_SOLAR_COLUMNS if c != "_extracted_at"],
    "wind": [c for c, _ in ERA5_WIND_COLUMNS if c != "_extracted_at"],
}
