"""Geo enrichment of users from staged provider answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.functions.scalars import location_key
from forgelake.operators.changes import insert_missing, union_all

# Answer shapes of the three providers.
OSM = (
    "array<struct<lon:string,lat:string,importance:double,"
    "address:struct<city:string,country:string,state:string,country_code:string>>>"
)
BING = (
    "struct<resourceSets:array<struct<estimatedTotal:int,resources:array<struct<confidence:string,"
    "point:struct<coordinates:array<double>>,"
    "address:struct<locality:string,countryRegion:string,adminDistrict:string>>>>>>"
)
GMAPS = (
    "struct<results:array<struct<address_components:array<struct<long_name:string,short_name:string,types:array<string>>>,"
    "geometry:struct<location:struct<lat:double,lng:double>>>>>"
)
CACHE_COLUMNS = ["key", "long", "lat", "city", "country", "state", "country_code", "status"]


def cache_row(found: Column, **values: Column) -> list[Column]:
    """The cache columns; everything is null and the status `failed` when nothing was found."""
    picked = [F.when(found, values[c]).alias(c) for c in CACHE_COLUMNS if c not in ("key", "status")]
    return [F.col("key"), *picked, F.when(found, "ok").otherwise("failed").alias("status")]


def parse_osm(responses: DataFrame) -> DataFrame:
    """List of places: the most important one counts, the first of equals."""
    places = F.from_json("body", OSM)
    ranked = F.transform(places, lambda p, i: F.struct(p["importance"].alias("importance"), (-i).alias("turn"), p.alias("p")))
    # Only importance and position decide; the place itself is looked up by position.
    order = F.array_max(F.transform(ranked, lambda r: F.struct(r["importance"].alias("importance"), r["turn"].alias("turn"))))
    best = F.get(places, -order["turn"])
    rows = responses.select("key", best.alias("b"))
    b = F.col("b")
    return rows.select(*cache_row(
        b.isNotNull(), long=b["lon"].try_cast("double"), lat=b["lat"].try_cast("double"), city=b["address"]["city"],
        country=b["address"]["country"], state=b["address"]["state"], country_code=b["address"]["country_code"],
    ))


def parse_bing(responses: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Resource sets: the first resource of high confidence counts; the code comes from the country name."""
    top = F.get(F.from_json("body", BING)["resourceSets"], F.lit(0))
    best = F.get(F.filter(top["resources"], lambda r: r["confidence"] == "High"), F.lit(0))
    rows = responses.select("key", F.when(top["estimatedTotal"] >= 1, best).alias("b")).withColumn(
        "country_name", F.col("b.address.countryRegion")
    )
    codes = last_codes(country_codes).withColumnRenamed("name", "country_name")
    b = F.col("b")
    return rows.join(codes, "country_name", "left").select(*cache_row(
        b.isNotNull(), long=F.get(b["point"]["coordinates"], F.lit(1)), lat=F.get(b["point"]["coordinates"], F.lit(0)),
        city=b["address"]["locality"], country=F.col("country_name"), state=b["address"]["adminDistrict"], country_code=F.col("code"),
    ))


def parse_gmaps(responses: DataFrame) -> DataFrame:
    """Result list: the first result counts; its parts are found by their type."""
    best = F.get(F.from_json("body", GMAPS)["results"], F.lit(0))
    rows = responses.select("key", best.alias("b"))
    b = F.col("b")

    def part(test) -> Column:
        return F.get(F.filter(b["address_components"], lambda c: test(c["types"])), F.lit(0))

    country = part(lambda types: F.array_contains(types, "country"))
    region = part(lambda types: F.exists(types, lambda t: t.contains("administrative_area")))
    return rows.select(*cache_row(
        b.isNotNull() & b["geometry"].isNotNull() & b["address_components"].isNotNull(),
        long=b["geometry"]["location"]["lng"], lat=b["geometry"]["location"]["lat"],
        city=part(lambda types: F.array_contains(types, "locality"))["long_name"], country=country["long_name"],
        state=region["long_name"], country_code=F.lower(country["short_name"]),
    ))


def last_codes(country_codes: DataFrame) -> DataFrame:
    """Country names (name, code, line) to codes; a name listed twice has the code of its last line."""
    return country_codes.groupBy("name").agg(F.max_by("code", "line").alias("code"))


def parse_responses(responses: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Cache rows of staged answers (provider, location, body)."""
    keyed = responses.withColumn("key", location_key(F.col("location")))
    return union_all([
        parse_osm(keyed.filter("provider = 'osm'")),
        parse_bing(keyed.filter("provider = 'bing'"), country_codes),
        parse_gmaps(keyed.filter("provider = 'gmaps'")),
    ])


def next_geo_cache(cache: DataFrame, responses: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Add answers for keys the cache lacks; failures are cached too."""
    return insert_missing(cache, parse_responses(responses, country_codes), ["key"], ["status"])


def with_location_keys(users: DataFrame) -> DataFrame:
    """Users with the cache key of their location, null for a blank one."""
    return users.withColumn("location_key", F.when(F.col("location") != "", location_key(F.col("location"))))


def enrich_users(users: DataFrame, cache: DataFrame) -> DataFrame:
    """Set the geo columns of users from the cache; unknown and failed locations give nulls."""
    geo = ["long", "lat", "country_code", "state", "city"]
    side = cache.select(F.col("key").alias("location_key"), *[F.col(f"`{c}`").alias(f"geo_{c}") for c in geo])
    types = {"long": "decimal(11,8)", "lat": "decimal(10,8)"}
    joined = with_location_keys(users).join(side, "location_key", "left")
    kept = [F.col(f"`{c}`") for c in users.columns if c not in geo]
    return joined.select(*kept, *[
        (F.col(f"geo_{c}").cast(types[c]) if c in types else F.col(f"geo_{c}")).alias(c) for c in geo
    ])
