"""Fixed values and schemas of the imagery, land-cover and fire tables."""

from __future__ import annotations

from pyspark.sql import types as T

SENSORS = ["LT05", "LE07", "LC08", "LC09"]  # also the order of readings of one moment
OPTICAL = ["blue", "green", "red", "nir", "swir1", "swir2"]
TM_BANDS = ["SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B7"]
OLI_BANDS = ["SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B6", "SR_B7"]

# Scaling of digital numbers, and linear transform of TM and ETM+ reflectance to that of OLI, by optical band.
SCALE, OFFSET = 0.0000275, -0.2
SLOPES = [0.8474, 0.8483, 0.9047, 0.8462, 0.8937, 0.9071]
INTERCEPTS = [0.0003, 0.0088, 0.0061, 0.0412, 0.0254, 0.0172]

# Fixed value: quality bits that mask a pixel (1 dilated cloud, 3 cloud, 4 shadow, 5 snow, 7 water).
QA_BITS = [1, 3, 4, 5, 7]
QA_MASK = sum(1 << bit for bit in QA_BITS)

# Tasselled-cap weights by optical band.
BRIGHTNESS = [0.3029, 0.2786, 0.4733, 0.5599, 0.5080, 0.1872]
GREENNESS = [-0.2941, -0.2430, -0.5424, 0.7276, 0.0713, -0.1608]
WETNESS = [0.1511, 0.1973, 0.3283, 0.3407, -0.7117, -0.4559]

# End members of the spectral unmixing, by optical band.
ENDMEMBERS = {
    "gv": [0.0500, 0.0900, 0.0400, 0.6100, 0.3000, 0.1000],
    "npv": [0.1400, 0.1700, 0.2200, 0.3000, 0.5500, 0.3500],
    "soil": [0.1500, 0.2000, 0.2500, 0.3500, 0.5000, 0.3500],
    "shade": [0.0000, 0.0000, 0.0000, 0.0000, 0.0000, 0.0000],
}

# Land-cover codes with their names, and their classes in two schemes.
# Scheme A: 0 not burnable, 1 forest, 2 shrub, 3 grass. Scheme B: 1 woody, 2 not woody, 3 not burnable, 4 shrub.
LEGEND = [
    (3, "closed forest", 1, 1),
    (66, "shrubland", 2, 4),
    (6, "flooded woody vegetation", 1, 1),
    (12, "grassland", 3, 2),
    (11, "wetland", 3, 2),
    (75, "peat bog", 3, 2),
    (63, "steppe", 3, 2),
    (21, "mosaic of uses", 3, 2),
    (9, "forest plantation", 1, 1),
    (29, "high Andean rock", 0, 3),
    (25, "desert and bare ground", 0, 3),
    (24, "urban area", 0, 3),
    (33, "river, lake and ocean", 0, 3),
    (34, "glacier, snow and ice", 0, 3),
    (27, "not observed", 0, 3),
]
SCHEME_A = {code: a for code, _, a, _ in LEGEND}
SCHEME_B = {code: b for code, _, _, b in LEGEND}

# The catalogue of training fires.
CATALOGUE = """
fire_01|2015_50|cholila|2015-02-14|2015-03-10|2015-12-01|2015-12-01
fire_02|2022_2125136700_r|steffen_martin|2021-11-30|2022-02-01|2022-12-01|2022-12-01
fire_03|2015_47|turbio_15|2015-02-06|2015-03-02|2015-11-30|2015-11-30
fire_04|2014_1|norquinco_14|2014-01-10|2014-01-18|2014-11-30|2014-10-30
fire_05|2022_TromenEste|tromen_22|2021-12-15|2021-12-31|2022-10-15|2022-10-15
fire_06|2021_2146405150_W|comarca_21|2021-01-25|2021-02-07|2021-11-30|2021-10-30
fire_07|2015_53|alerces_15|2015-03-18|2015-03-26|2015-12-31|2015-12-31
fire_08|2024_2143416051|alerces_24|2024-01-22|2024-02-07|2024-12-31|2024-10-31
fire_09|2008_5|lolog_08|2008-02-27|2008-04-05|2008-12-31|2008-10-31
fire_10|2012_57-2012_58|patriada_12|2011-12-31|2012-01-07|2012-12-31|2012-10-31
fire_11|2021_2146405150_E|comarca_estepa_21|2021-01-31|2021-03-15|2021-12-01|2021-12-01
fire_12||la_negra_01|2001-02-16|2001-02-23|2001-05-31|2001-03-31
fire_13||coquelen_03|2003-02-13|2003-02-22|2003-05-31|2003-05-31
fire_14||montenegro_24|2024-02-16|2024-03-03|2024-04-30|2024-04-30
fire_15||lonco_vaca_16|2015-12-17|2016-01-02|2016-03-21|2016-02-28
fire_16||naupa_huen_02|2001-12-25|2002-01-18|2002-03-31|2002-03-31
fire_17||achico_16|2016-02-02|2016-02-09|2016-04-30|2016-04-14
fire_18||sanico_16|2016-02-02|2016-02-09|2016-04-21|2016-04-21
fire_19||piedra_pintada_16|2015-12-31|2016-01-17|2016-05-31|2016-04-21
fire_20||trevelin_19|2019-02-17|2019-02-18|2019-05-24|2019-05-24
fire_21||gualjaina_17|2017-01-27|2017-02-20|2017-03-30|2017-03-30
fire_22||costa_del_lepa_04|2004-02-01|2004-02-17|2004-03-30|2004-03-30
fire_23||quetrequile_16|2016-02-02|2016-02-10|2016-06-30|2016-03-30
fire_24||jacobacci_18|2018-01-30|2018-02-07|2018-06-30|2018-03-30
fire_25||necolman_05|2005-01-17|2005-01-18|2005-06-30|2005-03-30
fire_26|2002_19|foyel_02|2002-02-12|2002-02-17|2002-12-30|2002-03-30
fire_27|2000_31j|foyel_00|1999-10-18|1999-10-22|2000-10-30|2000-03-30
fire_28|2021_1229|guacho_21|2021-02-25|2021-03-05|2021-12-30|2021-04-30
fire_29|2015_16|nahuel_huapi_15|2015-01-04|2015-01-08|2015-12-30|2015-06-30
fire_30|2018_44|corcovado_18|2017-11-29|2017-12-02|2018-12-30|2018-04-30
"""
FIRE_COLUMNS = ["fire_id", "polygon_id", "description", "pre_upr", "post_lwr", "post_upr_long", "post_upr_short"]


def catalogue_rows() -> list[tuple]:
    return [tuple(f or None for f in line.split("|")) for line in CATALOGUE.split()]


def raw_schema(bands: list[str]) -> T.StructType:
    """One row per pixel and scene, with digital numbers."""
    return T.StructType(
        [T.StructField("pixel_id", T.LongType()), T.StructField("scene_id", T.StringType()), T.StructField("sensor", T.StringType()), T.StructField("ts", T.TimestampType())]
        + [T.StructField(b, T.IntegerType()) for b in [*bands, "QA_PIXEL"]]
    )


# One row per scene: its properties stand next to the pixels' values by scene_id.
SCENE = T.StructType(
    [T.StructField("scene_id", T.StringType()), T.StructField("sensor", T.StringType()), T.StructField("time_start", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")]
)
