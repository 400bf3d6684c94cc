"""Relational ETL of school registers and railway timetables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.temporal import clock, weekdays
from ..operators.keys import dense_ids, first_by_key, first_seen_ids, numbered
from ..operators.stats import joined_distinct

# Names of the counties by their code.
COUNTIES = {
    "AB": "Alba", "AR": "Arad", "AG": "Argeș", "BC": "Bacău", "BH": "Bihor", "BN": "Bistrița-Năsăud", "BT": "Botoșani", "BV": "Brașov", "BR": "Brăila", "B": "București", "BZ": "Buzău",
    "CS": "Caraș-Severin", "CL": "Călărași", "CJ": "Cluj", "CT": "Constanța", "CV": "Covasna", "DB": "Dâmbovița", "DJ": "Dolj", "GL": "Galați", "GR": "Giurgiu", "GJ": "Gorj", "HR": "Harghita",
    "HD": "Hunedoara", "IL": "Ialomița", "IS": "Iași", "IF": "Ilfov", "MM": "Maramureș", "MH": "Mehedinți", "MS": "Mureș", "NT": "Neamț", "OT": "Olt", "PH": "Prahova", "SM": "Satu Mare",
    "SJ": "Sălaj", "SB": "Sibiu", "SV": "Suceava", "TR": "Teleorman", "TM": "Timiș", "TL": "Tulcea", "VS": "Vaslui", "VL": "Vâlcea", "VN": "Vrancea",
}

# Counties by parts of station names (upper case), in the order they are tried.
COUNTY_RULES = [
    ("Timiș", ["TIMIŞOARA", "RONAT", "SÂNANDREI", "CALACEA", "ORŢIŞOARA"]),
    ("Arad", ["ARAD", "VINGA", "ŞAG", "Valea Viilor", "GLOGOVĂŢ", "GHIOROC", "PAULIS", "RADNA", "MILOVA", "BÂRZAVA", "BATA", "VĂRĂDIA", "SĂVĂRŞIN"]),
    ("Hunedoara", ["ILTEU", "ZAM", "SURDUC", "ILIA", "MINTIA", "DEVA", "SIMERIA", "ORĂŞTIE", "AUREL VLAICU", "ŞIBOT"]),
    ("Alba", ["BLANDIANA", "VINŢU", "ALBA IULIA", "BĂRĂBANŢ", "SÂNTIMBRU", "COŞLARIU", "TEIUŞ", "AIUD", "UNIREA", "RĂZBOIENI"]),
    ("Cluj", ["CLUJ", "BACIU", "APAHIDA", "JUCU", "DEZMIR", "COJOCNA", "BONŢIDA", "GHERLA", "DEJ", "ICLOD", "RĂSCRUCI", "AGHIREŞ", "GÂRBĂU", "MERA", "NĂDĂŞEL", "BOJU", "CÂMPIA TURZII", "TURDA", "HUEDIN", "GĂLĂŞENI"]),
    ("Sălaj", ["JIBOU", "VAR H.", "SURDUC SĂLAJ", "CIOCMANI", "BĂBUŢENI", "CUCIULAT", "LETCA", "JEBUC", "STANA"]),
    ("Bistrița-Năsăud", ["BISTRIŢA", "BECLEAN", "SĂRĂŢEL", "RETEAG", "CICEU", "COLDĂU", "ŞINTEREAG", "MĂGHERUŞ", "BÂRGĂU", "PRUNDU"]),
    ("Prahova", ["PLOIEŞTI", "BRAZI", "MIZIL", "INOTEŞTI", "CRICOV", "VALEA CĂLUGĂREASCĂ", "CRIVINA", "SCROVIŞTEA", "BUDA", "FLOREŞTI", "CÂMPINA", "COMARNIC", "SINAIA", "BUŞTENI", "AZUGA"]),
    ("Brașov", ["BRAŞOV", "PREDEAL", "TIMIŞU DE SUS", "DÂRSTE"]),
    ("Vrancea", ["FOCŞANI", "MĂRĂŞEŞTI", "ADJUD", "GUGEŞTI", "COTEŞTI", "SIHLEA", "PUFEŞTI", "PUTNA SEACĂ", "PĂDURENI"]),
    ("Buzău", ["BUZĂU", "RÂMNICU SĂRAT", "ULMENI", "BOBOC", "ZOITA", "SAHATENI"]),
    ("Bihor", ["ORADEA", "ALEŞD", "BRATCA", "TILEAGD", "VADU CRIŞULUI"]),
]


def _text(c: str):
    return T.strip(F.coalesce(F.col(f"`{c}`"), F.lit("")))


def county_table(network: DataFrame, code: str = "Judet PJ") -> DataFrame:
    """(county_id, county_code, county_name): codes in order; a code without a known name is its own."""
    names = F.create_map(*[F.lit(x) for kv in COUNTIES.items() for x in kv])
    ids = dense_ids(network, _text(code), "county_code", "county_id")
    return ids.select("county_id", "county_code", F.coalesce(F.try_element_at(names, F.col("county_code")), F.col("county_code")).alias("county_name"))


def school_tables(network: DataFrame, enrolment: DataFrame, order: str) -> dict[str, DataFrame]:
    """counties, localities and schools of a network sheet (one row for each unit) and an enrolment sheet (rows for each school and level).

    Localities keep their first spelling; of equal unit codes the first row stays; students and levels count for units of their own
    legal status only: a school with rows but without one number has 0 students, one without rows null.
    """
    counties = county_table(network)
    placed = network.withColumn("county_code", _text("Judet PJ")).join(F.broadcast(counties.select("county_code", "county_id")), "county_code", "left")
    place = placed.where((_text("Localitate unitate") != "") & F.col("county_id").isNotNull())
    place = place.select(order, _text("Localitate unitate").alias("locality_name"), _text("Mediu loc. unitate").alias("residency_area"), "county_id")
    localities = first_seen_ids(place, [F.upper("locality_name"), F.col("county_id")], order, ["locality_name", "residency_area", "county_id"], "locality_id")
    localities = localities.select("locality_id", "locality_name", "residency_area", F.col("county_id"), F.col("__k0").alias("place_key"))
    sums = enrolment.select(T.padded(_text("Cod unitate PJ")).alias("code"), F.col("`Elevi exist anterior-asoc`").try_cast("int").alias("students"), F.nullif(_text("Nivel"), F.lit("")).alias("level")).where(_text("Cod unitate PJ") != "")
    sums = sums.groupBy("code").agg(F.coalesce(F.sum("students"), F.lit(0)).alias("students"), joined_distinct(F.col("level")).alias("levels"))
    units = first_by_key(placed.where(_text("Cod SIIIR unitate") != ""), T.padded(_text("Cod SIIIR unitate")), order)
    own = _text("Statut unitate") == "PJ"
    name = F.when(own, _text("Denumire PJ")).otherwise(F.coalesce(F.nullif(_text("Denumire lunga unitate"), F.lit("")), _text("Denumire PJ")))
    units = units.select(
        order, T.padded(_text("Cod SIIIR unitate")).alias("siiir_code"), name.alias("school_name"), F.nullif(_text("Denumire scurta unitate"), F.lit("")).alias("short_name"),
        F.nullif(_text("Forma proprietate"), F.lit("")).alias("ownership_type"), _text("Statut unitate").alias("unit_type"), F.upper(_text("Localitate unitate")).alias("place_key"), "county_id",
        F.when(own, T.padded(_text("Cod SIIIR PJ"))).alias("code"),
    )
    joined = units.join(localities.select("locality_id", "place_key", "county_id"), ["place_key", "county_id"], "left").join(sums, "code", "left")
    schools = numbered(joined, [order], "school_id").select("school_id", "school_name", "short_name", "siiir_code", "locality_id", "ownership_type", "unit_type", F.col("levels").alias("education_level"), F.col("students").alias("number_of_students"))
    return {"counties": counties, "localities": localities.drop("place_key"), "schools": schools}


def rail_frames(xml: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train elements of a timetable XML -> (trains, stops) as rail_tables() takes them; a train without a calendar of its own runs daily."""
    rows = xml.withColumn("train_order", F.monotonically_increasing_id())
    mask = F.coalesce(F.col("RestrictiiTren.CalendarTren._Zile"), F.col("CalendarTren._Zile"), F.lit("16767"))
    trains = rows.select("train_order", F.col("_Numar").alias("number"), F.col("_Operator").alias("operator"), F.col("_CategorieTren").alias("category"), mask.alias("mask"))
    at = rows.select("train_order", F.posexplode("Trase.Trasa.ElementTrasa").alias("place", "x"))
    stops = at.select(
        "train_order", "place", F.col("x._CodStaDest").alias("code"), F.col("x._DenStaDestinatie").alias("station"), F.col("x._OraS").alias("seconds_in"), F.col("x._OraP").alias("seconds_out"),
        F.col("x._Rci").alias("kind"), F.col("x.CalendarTren._Zile").alias("mask"),
    )
    return trains, stops


def rail_tables(trains: DataFrame, stops: DataFrame, county_rules: list[tuple[str, list[str]]] = COUNTY_RULES, other: str = "Alte Județe") -> dict[str, DataFrame]:
    """stations, trains and timetables of trains(train_order, number, operator, category, mask) and stops(train_order, place, code, station,
    seconds_in, seconds_out, kind, mask): trains without a number and stops without a station's name are left out; a stop's own mask goes
    before its train's."""
    known = numbered(trains.where(F.coalesce("number", F.lit("")) != ""), ["train_order"], "train_id")
    at = stops.where(_text("station") != "").withColumn("code", F.coalesce("code", F.lit(""))).join(known.select("train_order", "train_id", F.col("mask").alias("train_mask")), "train_order")
    at = at.withColumn("spot", F.struct("train_order", "place")).withColumn("station_key", F.upper(_text("station")))
    stations = first_seen_ids(at, [F.col("code"), F.col("station_key")], "spot", ["code", "station"], "station_id")
    stations = stations.select("station_id", F.col("code").try_cast("int").alias("station_number"), _text("station").alias("station_name"), T.first_match(_text("station"), county_rules, other).alias("county"), F.col("__k0").alias("code"), F.col("__k1").alias("station_key"))
    timed = at.join(stations.select("station_id", "code", "station_key"), ["code", "station_key"])
    rows = numbered(timed, ["train_order", "place"], "timetable_id").select(
        "timetable_id", "train_id", "station_id", clock(F.col("seconds_in")).alias("arrival_time"), clock(F.col("seconds_out")).alias("departure_time"), F.col("kind").alias("service_category"), weekdays(F.coalesce("mask", "train_mask")).alias("day_type")
    )
    return {"stations": stations.drop("code", "station_key"), "trains": known.select("train_id", F.col("number").alias("train_number"), F.col("operator").alias("operator_name"), "category"), "timetables": rows}
