"""Vehicle columns: VIN pattern, listing domain, body type, catalog wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Leading host labels, of which one is stripped.
LEADING_LABELS = ("www", "promos", "en", "fr", "vehicles", "landing", "m", "offres", "promotions")

# Listing body type (lower case) -> catalog body type.
BODY_TYPES = {
    "suv": "SUV",
    "utility": "SUV",
    "crossover": "SUV",
    "sedan": "Sedan",
    "micro car": "Sedan",
    "pickup": "Pickup",
    "truck": "Pickup",
    "chassis": "Pickup",
    "hatchback": "Hatchback",
    "wagon": "Wagon",
    "van": "Wagon",
    "mini-van": "Wagon",
    "minivan": "Wagon",
    "cargo van": "Wagon",
    "mini mpv": "Wagon",
    "convertible": "Convertible",
    "coupe": "Coupe",
}

# Used when the body type is not in the table above.
VEHICLE_TYPES = {"van": "Wagon", "truck": "Pickup", "car": "Sedan", "suv": "SUV"}

# Fixed value: bed length inside a style ("5.5 ft.").
BED_LENGTH = " [0-9]*.[0-9]* ft. "


def vin_pattern(vin: Column, strict: bool = False) -> Column:
    """Characters 1-8 and 10-11 of a 17-character VIN; otherwise NULL, or an error if strict."""
    other = F.raise_error(F.concat(F.lit("Invalid VIN "), vin)) if strict else F.lit(None)
    pattern = F.concat(F.substring(vin, 1, 8), F.substring(vin, 10, 2))
    return F.when(F.length(vin) == 17, pattern).otherwise(other.cast("string"))


def clean_source_domain(url: Column) -> Column:
    """Lower-case host without one leading service label; '' becomes NULL."""
    host = F.lower(F.when(url != "", url))
    return F.regexp_replace(host, rf"^({'|'.join(LEADING_LABELS)})\.", "")


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def normalize_body_type(body_type: Column, vehicle_type: Column) -> Column:
    by_vehicle = _lookup(VEHICLE_TYPES, F.lower(F.coalesce(vehicle_type, F.lit(""))))
    by_body = _lookup(BODY_TYPES, F.lower(body_type))
    return F.when(body_type.isNotNull(), F.coalesce(by_body, by_vehicle, body_type))


def title_words(c: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    cased = F.transform(runs, lambda r: F.concat(F.upper(r.substr(1, 1)), F.lower(F.substring(r, 2, 2147483647))))
    return F.array_join(cased, "")


def drop_words(text: Column, words_of: Column) -> Column:
    """``text`` without the words that occur in ``words_of``; both split at blanks."""
    stop = F.split(words_of, r"\s+")
    kept = F.filter(F.split(text, " "), lambda w: (w == "") | ~F.array_contains(stop, w))
    return F.regexp_replace(F.array_join(kept, " "), r"^\s+|\s+$", "")


def normalize_catalog(df: DataFrame, make="make", model="model", trim="trim", style="style", body_type="body_type") -> DataFrame:
    """Apply the catalog wording rules; later rules see the result of earlier ones."""
    mk, md, tr, st, bt = (F.col(x) for x in (make, model, trim, style, body_type))
    renamed_trim = (mk == "Toyota") & (md == "RAV4") & (tr == "Adventure")
    return (
        df.withColumn(model, F.when(md.contains("MAZDA"), title_words(md)).otherwise(md))
        .withColumns(
            {
                style: F.when(renamed_trim, F.replace(st, F.lit("Adventure"), F.lit("Trail"))).otherwise(st),
                trim: F.when(renamed_trim, F.lit("Trail")).otherwise(tr),
                body_type: F.when((mk == "Hyundai") & (md == "Veracruz"), "SUV")
                .when(bt == "Chassis", "Pickup")
                .when(bt == "Mini-Van", "Wagon")
                .otherwise(bt),
            }
        )
        .withColumns(
            {
                style: F.regexp_replace(F.replace(st, F.lit("4X4"), F.lit("4x4")), BED_LENGTH, " "),
                model: F.when(mk == "Ram", F.replace(md, F.lit("Ram Pickup "), F.lit(""))).otherwise(md),
            }
        )
        .withColumn(style, drop_words(st, tr))
        .withColumn(trim, drop_words(tr, md))
    )
