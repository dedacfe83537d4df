"""Every operator as a runnable query over the given tables: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certiscope import vocab
from certiscope.functions import columns as C
from certiscope.operators import (
    cleaning, decisions, dedup, features, joins, metrics, models, ordering, profiling, resampling, sampling,
)
from certiscope.plans.prepare import prepared_fixture as prepared
from certiscope.session import stored, work_dir
from certiscope.sources import geojson, register, split_csv
from certiscope.sources.fixture import KEYS, TIES, certificates, table
from certiscope.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LABEL = "RETROFIT_POTENTIAL"
SCORES = {"A": "SCORE_A", "B": "SCORE_B"}
CITY = "NATION_3"
CITIES = ["NATION_3", "NATION_7", "NATION_12"]
DIMENSIONS = {"PROPERTY_TYPE": "Property type", "TENURE": "Tenure"}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, places: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    doubles = [c for c, t in df.dtypes if t == "double" and c not in skip]
    return df.withColumns({c: F.round(c, places) for c in doubles}) if doubles else df


def scored(spark: SparkSession, sf_dir: str, keep: list[str] = ()) -> DataFrame:
    """Prepared test rows with two stand-in scores and their classes."""
    rows = prepared(spark, sf_dir, ["SCORE_A", "SCORE_B", *keep]).where("split = 'test'")
    return rows.withColumns({"PRED_A": metrics.classify("SCORE_A"), "PRED_B": metrics.classify("SCORE_B")})


def long_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per test row and model, for measures that go over the rows once."""
    return metrics.long_scores(scored(spark, sf_dir), LABEL, SCORES)


def stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for measures that go over the rows more than once."""
    return metrics.long_scores(stored(scored(spark, sf_dir).select(LABEL, *SCORES.values())), LABEL, SCORES)


def with_savings(spark: SparkSession, sf_dir: str, keep: list[str] = ()) -> DataFrame:
    both = ["HEATING_COST_CURRENT", "HEATING_COST_POTENTIAL", "CO2_EMISSIONS_CURRENT", "CO2_EMISSIONS_POTENTIAL"]
    rows = cleaning.savings(scored(spark, sf_dir, [*both, *keep]))
    return stored(rows.select("UPRN", "CURRENT_ENERGY_RATING", LABEL, "SCORE_A", "COST_SAVING", "CO2_SAVING"))


def city_members(spark: SparkSession, sf_dir: str, cities: list[str]) -> DataFrame:
    """Last test-year certificate of every property in each city."""
    raw = certificates(spark, sf_dir, [*KEYS, "FILE_YEAR", "LOCAL_AUTHORITY", "POSTCODE"])
    listed = raw.where(F.col("LOCAL_AUTHORITY").isin(cities) & (F.col("FILE_YEAR") >= 2000))
    order = ["FILE_YEAR", "LODGEMENT_DATE", *TIES]
    last = dedup.best_per_key(cleaning.normalised_ids(listed), ["LOCAL_AUTHORITY", "UPRN"], order)
    return last.select("LOCAL_AUTHORITY", "UPRN", "POSTCODE")


def scored_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(scored(spark, sf_dir).select("UPRN", LABEL, "PRED_A"))


def district_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres for three quarters of the districts, so that some have none."""
    return table(spark, sf_dir, "nation").where("n_nationkey % 4 <> 0").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("district"),
        (51 + F.col("n_nationkey") / 100).alias("lat"),
        (-2 - F.col("n_nationkey") / 100).alias("lon"),
    )


# --- scans and sources --------------------------------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    columns = [*KEYS, "CURRENT_ENERGY_RATING", "WALLS_ENERGY_EFF", "WALLS_DESCRIPTION", "TOTAL_FLOOR_AREA"]
    path = work_dir(spark, "csv_scan")
    register.write_result(certificates(spark, sf_dir, columns), path)
    return register.read_csv(spark, path)


@query
def csv_split_scan(spark, sf_dir):
    """Descriptions with line breaks inside quotes, read by as many tasks as the file has byte ranges."""
    columns = [*KEYS, "CURRENT_ENERGY_RATING", "WALLS_ENERGY_EFF", "WALLS_DESCRIPTION", "TOTAL_FLOOR_AREA"]
    path = work_dir(spark, "csv_split_scan")
    broken = certificates(spark, sf_dir, columns).withColumn(
        "WALLS_DESCRIPTION", F.regexp_replace("WALLS_DESCRIPTION", ", ", ",\n"))
    register.write_result(broken, path)
    return split_csv.read_split_csv(spark, path)


@query
def yearly_scan(spark, sf_dir):
    columns = [*vocab.REQUIRED_COLUMNS, "FILE_YEAR", "TENURE", "TOTAL_FLOOR_AREA"]
    path = work_dir(spark, "yearly")
    raw = certificates(spark, sf_dir, columns).withColumnRenamed("FILE_YEAR", "certificates")
    lower = raw.toDF(*[c.lower() for c in raw.columns])
    register.write_years(lower, path, "certificates")
    # The last year has no file: it is reported and left out.
    everything = register.read_years(spark, [f"{path}/certificates={y}" for y in range(1995, 2003)])
    return everything.groupBy("FILE_YEAR").agg(
        F.count(F.lit(1)).alias("n"), F.min("LODGEMENT_DATE").alias("first_date"),
        F.max("LODGEMENT_DATE").alias("last_date"), F.count("TOTAL_FLOOR_AREA").alias("with_area"),
    )


@query
def pruned_scan(spark, sf_dir):
    path = work_dir(spark, "pruned")
    raw = certificates(spark, sf_dir, ["UPRN", "LODGEMENT_DATE", "POSTCODE", "LOCAL_AUTHORITY", *TIES])
    register.write_result(raw.toDF(*[c.lower() for c in raw.columns]), path)
    return register.read_csv(spark, path).select("uprn", "postcode", "local_authority")


@query
def pushdown_range_scan(spark, sf_dir):
    rows = cleaning.in_year(table(spark, sf_dir, "lineitem"), 1997, "l_shipdate")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("lodged"))


@query
def normalise_header(spark, sf_dir):
    upper = cleaning.upper_names(table(spark, sf_dir, "customer"))
    return upper.withColumnRenamed("C_CUSTKEY", "UPRN").drop("C_ACCTBAL")


@query
def required_columns_report(spark, sf_dir):
    full = certificates(spark, sf_dir, [*vocab.REQUIRED_COLUMNS, "TENURE"])
    sources = {"full": full, "no rating": full.drop("CURRENT_ENERGY_RATING"), "orders": table(spark, sf_dir, "orders")}
    return register.required_columns_report(sources)


@query
def prepared_round_trip(spark, sf_dir):
    path = work_dir(spark, "prepared")
    register.write_prepared(prepared(spark, sf_dir), path)
    back = register.read_prepared(spark, path, ["UPRN", "LODGEMENT_DATE", "split", "FILE_YEAR", LABEL])
    return back.where("split = 'test' and FILE_YEAR = 2001").drop("split")


def boundaries(spark, sf_dir):
    """One boundary document per customer, in turn as each of the three geometry kinds."""
    square = "format_string('[[[%d,%d],[%d,%d],[%d,%d],[%d,%d]],[[0,0],[1,1],[0,1],[0,0]]]', x, y, x + 2, y, x + 2, y + 1, x, y)"
    shape = "format_string('{{\"type\":\"{0}\",\"coordinates\":%s}}', {1})"
    polygon = shape.format("Polygon", square)
    multi = shape.format("MultiPolygon", f"concat('[', {square}, ',', {square}, ']')")
    both = "concat('{\"type\":\"GeometryCollection\",\"geometries\":[', " + f"{polygon}, ',', {multi}, ']}}')"
    kind = F.expr(f"case c_custkey % 3 when 0 then {polygon} when 1 then {multi} else {both} end")
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "cast(c_custkey % 180 as int) as x", "c_nationkey as y"
    )
    return rows.select(
        F.format_string('{"type":"FeatureCollection","features":[{"properties":{"name":"%s"},"geometry":%s}]}', "c_name", kind).alias("text")
    )


@query
def geojson_rings(spark, sf_dir):
    found = geojson.rings(geojson.parse_collections(boundaries(spark, sf_dir), "text"))
    return geojson.vertices(found)


@query
def ring_anchor(spark, sf_dir):
    found = geojson.rings(geojson.parse_collections(boundaries(spark, sf_dir), "text"))
    return rounded(geojson.ring_anchors(found))


@query
def ring_box(spark, sf_dir):
    found = geojson.rings(geojson.parse_collections(boundaries(spark, sf_dir), "text"))
    return rounded(geojson.padded_box(found))


# --- filters and derived columns ----------------------------------------------------------------


@query
def drop_null_keys(spark, sf_dir):
    rows = certificates(spark, sf_dir, [*KEYS, "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS"])
    return rows.dropna(subset=["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS"])


@query
def standardise_text(spark, sf_dir):
    wanted = [*KEYS, "CURRENT_ENERGY_RATING", "POTENTIAL_ENERGY_RATING", "PROPERTY_TYPE"]
    return cleaning.standardise_text(certificates(spark, sf_dir, wanted))


@query
def valid_domain_filter(spark, sf_dir):
    wanted = [*KEYS, "CURRENT_ENERGY_RATING", "POTENTIAL_ENERGY_RATING", "PROPERTY_TYPE"]
    return cleaning.valid_domains(certificates(spark, sf_dir, wanted))


@query
def coerce_numeric(spark, sf_dir):
    area = F.col("TOTAL_FLOOR_AREA").cast("string")
    text = (
        F.when(area.isNull(), "n/a").when(F.col("TIE1") == 2, F.concat(F.lit(" "), area, F.lit(" ")))
        .when(F.col("TIE1") == 3, F.concat(area, F.lit("m2"))).when(F.col("TIE1") == 4, F.concat(area, F.lit(".5e1")))
        .otherwise(area)
    )
    rows = certificates(spark, sf_dir, [*KEYS, "TOTAL_FLOOR_AREA"]).withColumn("TOTAL_FLOOR_AREA", text)
    return cleaning.numbers(rows, ["TOTAL_FLOOR_AREA"])


@query
def coerce_date(spark, sf_dir):
    text = (
        F.when(F.col("TIE1") == 7, "unknown").when(F.col("TIE1") == 6, F.concat("LODGEMENT_DATE", F.lit("?")))
        .otherwise(F.col("LODGEMENT_DATE"))
    )
    rows = certificates(spark, sf_dir, KEYS)
    return rows.withColumn("lodged", C.iso_date(text)).withColumn("lodged_year", F.year("lodged"))


@query
def range_filter(spark, sf_dir):
    wanted = [*KEYS, "CURRENT_ENERGY_EFFICIENCY", "POTENTIAL_ENERGY_EFFICIENCY"]
    return cleaning.valid_scores(certificates(spark, sf_dir, wanted))


@query
def nonnegative_filter(spark, sf_dir):
    wanted = [*KEYS, *_present_numbers()]
    return cleaning.non_negative(certificates(spark, sf_dir, wanted))


@query
def valid_records(spark, sf_dir):
    wanted = [*KEYS, "CURRENT_ENERGY_RATING", "POTENTIAL_ENERGY_RATING", "PROPERTY_TYPE",
              "POTENTIAL_ENERGY_EFFICIENCY", *_present_numbers()]
    return cleaning.valid_records(certificates(spark, sf_dir, wanted))


@query
def normalise_id(spark, sf_dir):
    raw = (
        F.when(F.col("TIE1") == 1, F.concat("UPRN", F.lit(".0"))).when(F.col("TIE1") == 2, F.concat(F.lit(" "), F.col("UPRN")))
        .when(F.col("TIE1") == 3, "nan").otherwise(F.col("UPRN"))
    )
    rows = certificates(spark, sf_dir, KEYS).withColumn("UPRN", raw)
    return cleaning.normalised_ids(rows)


@query
def savings_filter(spark, sf_dir):
    wanted = ["HEATING_COST_CURRENT", "HEATING_COST_POTENTIAL", "CO2_EMISSIONS_CURRENT", "CO2_EMISSIONS_POTENTIAL"]
    return cleaning.savings(certificates(spark, sf_dir, [*KEYS, *wanted])).select(*KEYS, "COST_SAVING", "CO2_SAVING")


@query
def percentile_cap(spark, sf_dir):
    return profiling.cap_at_percentile(certificates(spark, sf_dir, [*KEYS, "TOTAL_FLOOR_AREA"]), "TOTAL_FLOOR_AREA")


@query
def engineer_target(spark, sf_dir):
    wanted = [*KEYS, "CURRENT_ENERGY_RATING", "CURRENT_ENERGY_EFFICIENCY", "POTENTIAL_ENERGY_EFFICIENCY"]
    return cleaning.label_potential(certificates(spark, sf_dir, wanted)).select(*KEYS, "EFFICIENCY_GAP", LABEL)


@query
def encode_age_band(spark, sf_dir):
    rows = certificates(spark, sf_dir, [*KEYS, "CONSTRUCTION_AGE_BAND"])
    return features.add_age_year(rows).select(*KEYS, "AGE_BAND_YEAR")


@query
def age_to_band(spark, sf_dir):
    rows = certificates(spark, sf_dir, [*KEYS, "CONSTRUCTION_AGE_BAND"])
    return rows.withColumn("band", C.age_band("CONSTRUCTION_AGE_BAND")).select(*KEYS, "band")


@query
def extract_wall_type(spark, sf_dir):
    rows = certificates(spark, sf_dir, [*KEYS, "WALLS_DESCRIPTION"])
    return cleaning.add_wall_type(rows).select(*KEYS, "WALL_TYPE")


@query
def outward_code(spark, sf_dir):
    rows = certificates(spark, sf_dir, [*KEYS, "POSTCODE"])
    return rows.select(*KEYS, C.outward_code("POSTCODE").alias("outward"))


@query
def classify_threshold(spark, sf_dir):
    rows = certificates(spark, sf_dir, [*KEYS, "SCORE_A"])
    return rows.select(*KEYS, metrics.classify("SCORE_A").alias("flagged"))


@query
def cv_text_parse(spark, sf_dir):
    """Mean and deviation per tenure written as one text, and read back from it."""
    by = certificates(spark, sf_dir, ["TENURE", "TOTAL_FLOOR_AREA"]).groupBy("TENURE")
    text = by.agg(
        F.format_string("%.4f +/- %.4f", F.avg("TOTAL_FLOOR_AREA"), F.stddev_pop("TOTAL_FLOOR_AREA")).alias("text")
    )
    return C.split_mean_sd(text, "text").drop("text")


def _present_numbers() -> list[str]:
    return ["CURRENT_ENERGY_EFFICIENCY", "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "CO2_EMISSIONS_CURRENT",
            "HEATING_COST_CURRENT"]


# --- joins and sets -----------------------------------------------------------------------------


@query
def enrich_left_join(spark, sf_dir):
    meta = prepared(spark, sf_dir, ["TENURE"]).where("split = 'test'").select("UPRN", "TENURE")
    full = prepared(spark, sf_dir, ["HEATING_COST_CURRENT", "CO2_EMISSIONS_CURRENT"])
    extra = ["CURRENT_ENERGY_RATING", "HEATING_COST_CURRENT", "CO2_EMISSIONS_CURRENT", LABEL, "FILE_YEAR"]
    return joins.enrich(meta, full, "UPRN", extra)


@query
def attach_scores(spark, sf_dir):
    rows = prepared(spark, sf_dir).where("split = 'test'").select("UPRN", LABEL, *TIES)
    scores = certificates(spark, sf_dir, [*KEYS, "SCORE_A"]).groupBy("UPRN", *TIES).agg(F.min("SCORE_A").alias("SCORE_A"))
    return joins.attach_scores(rows, scores, ["UPRN", *TIES])


@query
def city_slice(spark, sf_dir):
    members = city_members(spark, sf_dir, [CITY]).select("UPRN", "POSTCODE")
    test = prepared(spark, sf_dir).where("split = 'test'").select("UPRN", LABEL)
    inside = joins.keep_known(test, members, "UPRN")
    return inside.join(members, "UPRN", "left")


@query
def semi_split(spark, sf_dir):
    test = prepared(spark, sf_dir).where("split = 'test'").select("UPRN", LABEL)
    return joins.keep_known(test, city_members(spark, sf_dir, [CITY]), "UPRN")


@query
def anti_split(spark, sf_dir):
    test = prepared(spark, sf_dir).where("split = 'test'").select("UPRN", LABEL)
    return joins.keep_unknown(test, city_members(spark, sf_dir, [CITY]), "UPRN")


@query
def city_flag(spark, sf_dir):
    test = prepared(spark, sf_dir).where("split = 'test'").select("UPRN", LABEL)
    flagged = joins.flag_known(test, city_members(spark, sf_dir, [CITY]), "UPRN", "in_city")
    return flagged.groupBy("in_city").agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("positives"))


@query
def missing_dimension_report(spark, sf_dir):
    raw = certificates(spark, sf_dir, ["POSTCODE"]).select(C.outward_code("POSTCODE").alias("district"))
    return joins.missing_in_dimension(raw, district_centres(spark, sf_dir), "district")


@query
def union_years(spark, sf_dir):
    raw = certificates(spark, sf_dir, ["UPRN", "FILE_YEAR", "TENURE", "TOTAL_FLOOR_AREA"])
    early = raw.where("FILE_YEAR < 1998").drop("TENURE")
    late = raw.where("FILE_YEAR >= 1998")
    both = joins.stack([early, late])
    return both.groupBy("FILE_YEAR").agg(
        F.count(F.lit(1)).alias("n"), F.count("TENURE").alias("with_tenure"), F.sum("TOTAL_FLOOR_AREA").alias("area")
    )


# --- de-duplication -----------------------------------------------------------------------------


@query
def latest_per_key(spark, sf_dir):
    keep = ["TENURE", "TOTAL_FLOOR_AREA", "HEATING_COST_CURRENT"]
    rows = prepared(spark, sf_dir, keep)
    return rows.select("UPRN", "LODGEMENT_DATE", "CURRENT_ENERGY_RATING", *keep, *TIES, LABEL, "split")


@query
def latest_per_key_simple(spark, sf_dir):
    raw = certificates(spark, sf_dir, [*KEYS, "TRANSACTION_TYPE", "TOTAL_FLOOR_AREA"])
    return dedup.latest_per_key(raw, ties=TIES)


@query
def latest_per_key_late(spark, sf_dir):
    """The simple form over a stored table: winners on narrow rows, wide rows fetched by place."""
    raw = stored(certificates(spark, sf_dir, [*KEYS, "TRANSACTION_TYPE", "TOTAL_FLOOR_AREA"]), "certificates")
    return dedup.latest_per_key_late(raw, ties=TIES)


@query
def last_per_key(spark, sf_dir):
    raw = certificates(spark, sf_dir, [*KEYS, "FILE_YEAR", "TRANSACTION_TYPE"])
    return dedup.last_per_key(raw, "UPRN", ["FILE_YEAR", "LODGEMENT_DATE", *TIES])


@query
def dedup_key(spark, sf_dir):
    raw = certificates(spark, sf_dir, [*KEYS, "TRANSACTION_TYPE"])
    return dedup.first_per_key(raw, "UPRN", ["LODGEMENT_DATE", *TIES])


# --- sampling and splitting ---------------------------------------------------------------------


@query
def uniform_sample_n(spark, sf_dir):
    return sampling.uniform_sample(certificates(spark, sf_dir, [*KEYS, "TRANSACTION_TYPE"]), 1000, KEYS)


@query
def stratified_sample_quota(spark, sf_dir):
    rows = stored(prepared(spark, sf_dir).select("UPRN", LABEL, "split"))
    return sampling.stratified_sample_quota(rows, 2000, LABEL, ["UPRN"])


@query
def stratified_sample_frac(spark, sf_dir):
    rows = stored(prepared(spark, sf_dir).select("UPRN", LABEL, "split"))
    return sampling.stratified_sample_fraction(rows, 2000, LABEL, ["UPRN"])


@query
def per_year_sample(spark, sf_dir):
    rows = certificates(spark, sf_dir, [*KEYS, "FILE_YEAR"])
    return sampling.equal_sample(rows, 3500, "FILE_YEAR", 7, KEYS)


@query
def temporal_split(spark, sf_dir):
    rows = sampling.temporal_split(certificates(spark, sf_dir, ["UPRN", "FILE_YEAR"]), "FILE_YEAR", 2000)
    return rows.groupBy("split", "FILE_YEAR").agg(F.count(F.lit(1)).alias("n"))


@query
def stratified_folds(spark, sf_dir):
    rows = stored(prepared(spark, sf_dir).select("UPRN", LABEL))
    return sampling.stratified_folds(rows, 5, LABEL, ["UPRN"])


@query
def half_split(spark, sf_dir):
    rows = stored(prepared(spark, sf_dir).where("PROPERTY_TYPE = 'Flat'").select("UPRN"))
    return sampling.half_split(rows, ["UPRN"])


@query
def outcome_examples(spark, sf_dir):
    rows = scored(spark, sf_dir)
    picked = sampling.outcome_examples(rows, LABEL, "PRED_A", ["UPRN"], "UPRN")
    yes_no = {c: F.when(F.col(s) == 1, "Yes").otherwise("No") for c, s in (("predicted", "PRED_A"), ("actual", LABEL))}
    return picked.withColumns(yes_no).select("UPRN", "PROPERTY_TYPE", "outcome", "SCORE_A", "predicted", "actual")


# --- profiling ----------------------------------------------------------------------------------


@query
def class_balance(spark, sf_dir):
    return rounded(profiling.class_balance(prepared(spark, sf_dir), LABEL, ["split"]))


_PROFILED = ["UPRN", "LODGEMENT_DATE", "MAINS_GAS_FLAG", "WALLS_DESCRIPTION", "CONSTRUCTION_AGE_BAND",
             "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "WALLS_ENERGY_EFF", "TENURE"]


@query
def missing_profile(spark, sf_dir):
    return rounded(profiling.missing_profile(certificates(spark, sf_dir, _PROFILED)))


@query
def summary_stats(spark, sf_dir):
    keep = ["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "MAINS_GAS_FLAG"]
    rows = prepared(spark, sf_dir, keep).select("UPRN", *keep, LABEL)
    return rounded(profiling.table_summary(rows, LABEL))


@query
def negative_audit(spark, sf_dir):
    return profiling.negative_audit(certificates(spark, sf_dir, _present_numbers()))


@query
def negative_rows(spark, sf_dir):
    return rounded(profiling.negative_rows(certificates(spark, sf_dir, _present_numbers())))


@query
def class_histogram(spark, sf_dir):
    rows = stored(prepared(spark, sf_dir, ["HEATING_COST_CURRENT"]).select("HEATING_COST_CURRENT", LABEL))
    capped = profiling.cap_at_percentile(rows, "HEATING_COST_CURRENT")
    return rounded(profiling.class_histogram(capped, "HEATING_COST_CURRENT", LABEL), 8)


@query
def correlation_matrix(spark, sf_dir):
    numbers = ["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT"]
    rows = prepared(spark, sf_dir, numbers)
    wanted = [c for c in vocab.CORRELATION_COLUMNS if c in rows.columns]
    return rounded(profiling.correlation_matrix(rows, wanted, vocab.CORRELATION_LABELS))


@query
def crosstab_pct(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    return rounded(
        profiling.crosstab_percent(rows, "PROPERTY_TYPE", "CURRENT_ENERGY_RATING", vocab.RATINGS_BEST_FIRST)
    )


@query
def rate_by_band(spark, sf_dir):
    rows = prepared(spark, sf_dir, ["CONSTRUCTION_AGE_BAND"]).withColumn("band", C.age_band("CONSTRUCTION_AGE_BAND"))
    return rounded(profiling.rate_by_band(rows, "band", LABEL, vocab.AGE_BAND_ORDER))


@query
def category_counts(spark, sf_dir):
    wanted = ["PROPERTY_TYPE", "CURRENT_ENERGY_RATING", "FILE_YEAR", "MAINS_GAS_FLAG"]
    return profiling.category_counts(certificates(spark, sf_dir, wanted), wanted)


@query
def schema_profile(spark, sf_dir):
    return profiling.schema_profile(certificates(spark, sf_dir, _PROFILED))


@query
def impute_values(spark, sf_dir):
    numbers = ["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "HEATING_COST_CURRENT"]
    texts = ["MAINS_GAS_FLAG", "WALLS_ENERGY_EFF", "TENURE"]
    raw = stored(certificates(spark, sf_dir, [*numbers, *texts]), "impute")  # four passes, the joins once
    middle = ordering.exact_quantiles(raw, numbers, [0.25, 0.5])
    common = features.modes(raw, texts)
    rows = [(c, q[0], q[1], None) for c, q in middle.items()] + [(c, None, None, m) for c, m in common.items()]
    return spark.createDataFrame(rows, "column string, lower_quartile double, median double, mode string")


# --- features -----------------------------------------------------------------------------------

_INPUTS = ["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT",
           "WALLS_ENERGY_EFF", "BUILT_FORM", "TENURE", "MAINS_GAS_FLAG", "TRANSACTION_TYPE", "WALLS_DESCRIPTION"]


def model_rows(spark, sf_dir, keep: list[str] = ()) -> DataFrame:
    """Prepared rows with the wall class, stored because fitting goes over them several times."""
    return stored(cleaning.add_wall_type(prepared(spark, sf_dir, [*_INPUTS, *keep])))


def _fitted(spark, sf_dir, part: Callable[[DataFrame], features.FeatureEncoder]) -> tuple[DataFrame, features.FeatureEncoder]:
    rows = model_rows(spark, sf_dir)
    return rows, features.fit_features(rows.where("split = 'train'"), part(rows))


@query
def scale_numeric(spark, sf_dir):
    rows, enc = _fitted(
        spark, sf_dir, lambda df: features.FeatureEncoder(cleaning.present(df, vocab.NUMERIC_INPUTS), {}, [])
    )
    return rounded(enc.wide(rows, ["UPRN"]))


@query
def ordinal_encode(spark, sf_dir):
    ordered = {"CURRENT_ENERGY_RATING": vocab.RATINGS_WORST_FIRST, "WALLS_ENERGY_EFF": vocab.COMPONENT_LEVELS}
    rows, enc = _fitted(spark, sf_dir, lambda df: features.FeatureEncoder([], ordered, []))
    return enc.wide(rows, ["UPRN"])


@query
def one_hot_drop_first(spark, sf_dir):
    nominal = ["PROPERTY_TYPE", "MAINS_GAS_FLAG", "WALL_TYPE"]
    rows, enc = _fitted(spark, sf_dir, lambda df: features.FeatureEncoder([], {}, nominal))
    return enc.wide(rows, ["UPRN"]).toDF("UPRN", *[n.replace(" ", "_") for n in enc.names])


@query
def feature_names(spark, sf_dir):
    """Every feature with its place and its mean over the whole table."""
    rows, enc = _fitted(spark, sf_dir, features.default_inputs)
    means = {f"{i:02d}": F.avg(e) for i, e in enumerate(enc.feature_columns().values())}
    one = rows.agg(*[m.alias(k) for k, m in means.items()])
    listed = [F.struct(F.lit(i).alias("place"), F.lit(n).alias("feature"), F.col(f"`{i:02d}`").alias("mean"))
              for i, n in enumerate(enc.names)]
    return rounded(one.select(F.explode(F.array(*listed)).alias("r")).select("r.*"))


@query
def build_feature_matrix(spark, sf_dir):
    rows = features.add_age_year(model_rows(spark, sf_dir, ["CONSTRUCTION_AGE_BAND"]))
    matrix = features.simple_matrix(rows, keep=["UPRN"])
    return matrix.toDF(*[c.replace(" ", "_") for c in matrix.columns])


@query
def matrix_null_check(spark, sf_dir):
    rows, enc = _fitted(spark, sf_dir, features.default_inputs)
    matrix = enc.wide(rows, ["UPRN"])
    plain = matrix.toDF("UPRN", *[f"f{i}" for i in range(len(enc.names))])
    return features.missing_cells(plain, plain.columns[1:])


@query
def class_weights(spark, sf_dir):
    return rounded(features.class_weights(prepared(spark, sf_dir).where("split = 'train'"), LABEL))


# --- metrics ------------------------------------------------------------------------------------


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion(long_scored(spark, sf_dir), "label", metrics.classify("score"), ["model"])


@query
def classification_report(spark, sf_dir):
    rows = long_scored(spark, sf_dir)
    return rounded(metrics.classification_report(rows, "label", metrics.classify("score"), ["model"]))


@query
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(stored_scores(spark, sf_dir), "label", "score", ["model"]), 8)


@query
def average_precision(spark, sf_dir):
    return rounded(metrics.average_precision(stored_scores(spark, sf_dir), "label", "score", ["model"]), 8)


@query
def roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(stored_scores(spark, sf_dir), "label", "score", ["model"]), 8)


@query
def pr_curve(spark, sf_dir):
    return rounded(metrics.pr_curve(stored_scores(spark, sf_dir), "label", "score", ["model"]), 8)


def comparison(spark, sf_dir) -> DataFrame:
    return metrics.score_summary(stored_scores(spark, sf_dir), "label", "score", ["model"])


@query
def evaluate_model(spark, sf_dir):
    return rounded(comparison(spark, sf_dir).select("model", "f1_weighted", "roc_auc"))


@query
def model_comparison(spark, sf_dir):
    columns = ["accuracy", "precision", "recall", "f1_macro", "roc_auc", "average_precision"]
    return rounded(comparison(spark, sf_dir).select("model", *columns))


@query
def metric_winners(spark, sf_dir):
    table_ = rounded(comparison(spark, sf_dir), 4)
    wanted = ["accuracy", "precision", "recall", "f1_macro", "roc_auc", "average_precision"]
    return metrics.best_rows(table_, "model", wanted, ["positive_rate"])


@query
def baseline_delta(spark, sf_dir):
    wanted = ["roc_auc", "f1_macro", "average_precision"]
    return rounded(decisions.metric_delta(comparison(spark, sf_dir), "model", "B", "A", wanted))


@query
def calibration_curve(spark, sf_dir):
    return rounded(metrics.calibration_curve(long_scored(spark, sf_dir), "label", "score", ["model"]))


_PAIRS = {"A vs B": ("PRED_A", "PRED_B"), "A vs rating": ("PRED_A", "PRED_RATING"), "B vs rating": ("PRED_B", "PRED_RATING")}


def _with_rating_rule(spark, sf_dir) -> DataFrame:
    return scored(spark, sf_dir).withColumn("PRED_RATING", C.low_rated("CURRENT_ENERGY_RATING").cast("int"))


@query
def mcnemar(spark, sf_dir):
    return rounded(metrics.mcnemar(_with_rating_rule(spark, sf_dir), LABEL, _PAIRS))


@query
def mcnemar_p_values(spark, sf_dir):
    return metrics.mcnemar(_with_rating_rule(spark, sf_dir), LABEL, _PAIRS, p_values=True)


@query
def top_features(spark, sf_dir):
    """Features by the size of their correlation with the label."""
    numbers = ["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT"]
    rows = prepared(spark, sf_dir, numbers)
    pairs = profiling.correlation_matrix(rows, ["CURRENT_ENERGY_EFFICIENCY", *numbers, LABEL])
    with_label = rounded(pairs.where(F.col("row") == LABEL).select(F.col("col").alias("feature"), "r"))
    return metrics.top_by_size(with_label, "feature", "r", 3)


# --- decisions ----------------------------------------------------------------------------------


@query
def topk_budget(spark, sf_dir):
    rows = decisions.eligible(with_savings(spark, sf_dir))
    return decisions.top_budget(rows, "SCORE_A", 0.10, ["UPRN"]).select("UPRN", "SCORE_A", LABEL)


@query
def impact_ranked(spark, sf_dir):
    return decisions.impact_ranked(with_savings(spark, sf_dir), "SCORE_A", ["UPRN"])


@query
def impact_random(spark, sf_dir):
    return decisions.impact_random(with_savings(spark, sf_dir))


@query
def impact_uplift(spark, sf_dir):
    rows = with_savings(spark, sf_dir)
    ranked = decisions.impact_ranked(rows, "SCORE_A", ["UPRN"])
    return rounded(decisions.impact_uplift(ranked, decisions.impact_random(rows)), 4)


@query
def fairness_by_group(spark, sf_dir):
    rows = scored(spark, sf_dir, ["TENURE"])
    return rounded(decisions.group_fairness(rows, LABEL, "PRED_A", DIMENSIONS))


@query
def recall_spread(spark, sf_dir):
    groups = decisions.group_fairness(scored(spark, sf_dir, ["TENURE"]), LABEL, "PRED_A", DIMENSIONS)
    return rounded(decisions.recall_spread(groups))


@query
def threshold_sweep(spark, sf_dir):
    rows = scored(spark, sf_dir).where("PROPERTY_TYPE = 'Flat'")
    return rounded(decisions.threshold_sweep(rows, LABEL, "SCORE_A", vocab.SWEEP_HUNDREDTHS))


@query
def group_threshold(spark, sf_dir):
    rows = stored(scored(spark, sf_dir).select("UPRN", "PROPERTY_TYPE", LABEL, "SCORE_A"))
    return rounded(decisions.group_threshold(rows, "PROPERTY_TYPE", "Flat", "House", LABEL, "SCORE_A", ["UPRN"]))


@query
def group_threshold_temporal(spark, sf_dir):
    rows = stored(scored(spark, sf_dir).select("PROPERTY_TYPE", LABEL, "SCORE_A", "FILE_YEAR"))
    out = decisions.group_threshold_by_year(
        rows, "PROPERTY_TYPE", "Flat", "House", LABEL, "SCORE_A", "FILE_YEAR", 2000, 2001
    )
    return rounded(out)


@query
def city_evaluation(spark, sf_dir):
    return rounded(
        decisions.city_table(scored_cities(spark, sf_dir), city_members(spark, sf_dir, [CITY]), "UPRN", "LOCAL_AUTHORITY",
                             LABEL, "PRED_A")
    )


@query
def city_table(spark, sf_dir):
    return rounded(
        decisions.city_table(scored_cities(spark, sf_dir), city_members(spark, sf_dir, CITIES), "UPRN", "LOCAL_AUTHORITY",
                             LABEL, "PRED_A")
    )


@query
def proportion_ztest(spark, sf_dir):
    found = decisions.city_table(scored_cities(spark, sf_dir), city_members(spark, sf_dir, CITIES), "UPRN",
                                 "LOCAL_AUTHORITY", LABEL, "PRED_A", p_values=True)
    return found.select("LOCAL_AUTHORITY", "positive_rate", "rest_positive_rate", "z", "p_value")


@query
def district_summary(spark, sf_dir):
    rows = scored(spark, sf_dir, ["POSTCODE"])
    return rounded(decisions.district_summary(rows, "POSTCODE", district_centres(spark, sf_dir), LABEL, "PRED_A"))


@query
def district_extremes(spark, sf_dir):
    rows = scored(spark, sf_dir, ["POSTCODE"])
    found = decisions.district_summary(rows, "POSTCODE", district_centres(spark, sf_dir), LABEL, "PRED_A")
    return rounded(decisions.district_extremes(rounded(found)))


# --- resampling, walk-forward, choice of settings -----------------------------------------------

_REPLICATES = 20


def _two_scores(spark, sf_dir) -> DataFrame:
    return stored(scored(spark, sf_dir).select(LABEL, *SCORES.values()))


@query
def bootstrap_auc(spark, sf_dir):
    return rounded(resampling.bootstrap_auc(_two_scores(spark, sf_dir), LABEL, SCORES))


@query
def bootstrap_gap(spark, sf_dir):
    drawn = resampling.bootstrap_replicates(_two_scores(spark, sf_dir), LABEL, SCORES, _REPLICATES)
    return rounded(resampling.paired_gap(drawn, "A", "B"))


@query
def walk_forward_folds(spark, sf_dir):
    """Size and positive rate of both sides of every fold."""
    rows = stored(prepared(spark, sf_dir).select("UPRN", LABEL, "FILE_YEAR"))
    parts = []
    for train_years, test_year in models.walk_forward_years(range(1995, 2002)):
        sides = {"train": (train_years, 2000), "test": ([test_year], 500)}
        for side, (years, total) in sides.items():
            picked = sampling.equal_sample(rows.where(F.col("FILE_YEAR").isin(years)), total, "FILE_YEAR", len(years), ["UPRN"])
            parts.append(picked.agg(F.count(F.lit(1)).alias("n"), F.avg(LABEL).alias("positive_rate")).select(
                F.lit(test_year).alias("test_year"), F.lit(side).alias("side"), "n", "positive_rate"))
    return rounded(joins.stack(parts))


@query
def walk_forward_summary(spark, sf_dir):
    """Yearly measures of one score, then their range and the means of early and late years."""
    rows = stored(prepared(spark, sf_dir, ["SCORE_A"]).where("FILE_YEAR >= 1997").select("FILE_YEAR", LABEL, "SCORE_A"))
    yearly = metrics.score_summary(rows, LABEL, "SCORE_A", ["FILE_YEAR"])
    early, late = [1997, 1998, 1999], [2000, 2001]
    return rounded(decisions.walk_forward_summary(yearly, "FILE_YEAR", "roc_auc", "f1_macro", early, late))


@query
def most_chosen_setting(spark, sf_dir):
    """Best threshold by F1 in each of five folds, and the one chosen most often."""
    rows = stored(prepared(spark, sf_dir, ["SCORE_A"]).select("UPRN", LABEL, "SCORE_A"))
    folded = sampling.stratified_folds(rows, 5, LABEL, ["UPRN"])
    sweep = decisions.threshold_sweep(folded, LABEL, "SCORE_A", [30, 40, 50, 60, 70], ["fold"])
    best = F.max_by("hundredths", F.struct(F.round("f1", 6), -F.col("hundredths"))).alias("hundredths")
    return models.most_chosen(sweep.groupBy("fold").agg(best), "fold", "hundredths")


# --- models (settings are smaller than the defaults of the operators) ---------------------------


def model_table(spark, sf_dir) -> tuple[DataFrame, features.FeatureEncoder]:
    """Rows with label and feature vector; the encoder is fitted on the training years."""
    rows = model_rows(spark, sf_dir, ["LOCAL_AUTHORITY"])
    enc = features.fit_features(rows.where("split = 'train'"))
    kept = ["UPRN", "split", "FILE_YEAR", "LOCAL_AUTHORITY", F.col(LABEL).alias("label"), "features"]
    return stored(enc.transform(rows).select(*kept)), enc


def _sides(table_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weighted training rows and test rows."""
    train = models.balanced(table_.where("split = 'train'"))
    return train, table_.where("split = 'test'").withColumn(models.WEIGHT, F.lit(1.0))


def _test_measures(scores: DataFrame, name: str) -> DataFrame:
    summary = metrics.score_summary(stored(scores.select("label", "s")), "label", "s")
    wanted = ["n", "accuracy", "precision", "recall", "f1_macro", "roc_auc", "average_precision"]
    return summary.select(F.lit(name).alias("model"), *wanted)


@query
def logistic_fit(spark, sf_dir):
    train, test = _sides(model_table(spark, sf_dir)[0])
    model = models.logistic(train.count(), C=1.0, max_iter=100).fit(train)
    return _test_measures(models.score(model, test, "s"), "logistic")


@query
def naive_fit(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    enc = features.fit_features(rows.where("split = 'train'"), models.naive_inputs(vocab.RATINGS_WORST_FIRST))
    train, test = _sides(enc.transform(rows).withColumnRenamed(LABEL, "label"))
    model = models.logistic(train.count(), C=1.0, max_iter=100).fit(train)
    return _test_measures(models.score(model, test, "s"), "naive")


@query
def forest_fit(spark, sf_dir):
    train, test = _sides(model_table(spark, sf_dir)[0])
    model = models.forest(max_features="0.3", trees=20, depth=8).fit(train)
    return _test_measures(models.score(model, test, "s"), "forest")


@query
def boosting_fit(spark, sf_dir):
    table_, _ = model_table(spark, sf_dir)
    train = models.boosted_weights(table_.where("split = 'train'"))
    model = models.boosting(max_depth=4, rate=0.1, rounds=10).fit(train)
    return _test_measures(models.score(model, _sides(table_)[1], "s"), "boosting")


@query
def calibrated_svm_fit(spark, sf_dir):
    table_, _ = model_table(spark, sf_dir)
    model = models.fit_calibrated_svm(table_.where("split = 'train'"), ["UPRN"], C=1.0, folds=3, max_iter=30)
    return _test_measures(model.transform(table_.where("split = 'test'"), "s"), "svm")


@query
def nested_search(spark, sf_dir):
    table_, _ = model_table(spark, sf_dir)
    train = table_.where("split = 'train'").select("UPRN", "label", "features")

    def build(rows, C):
        return models.logistic(rows, C, max_iter=30)

    folds, _ = models.nested_cv(train, build, {"C": [0.01, 1]}, ["UPRN"], outer=3, inner=2)
    return models.fold_summary(folds)


@query
def walk_forward_fit(spark, sf_dir):
    rows = model_rows(spark, sf_dir).withColumnRenamed(LABEL, "label")

    def sample(part, n_years):
        return sampling.equal_sample(part, 2000 if n_years > 1 else 500, "FILE_YEAR", n_years, ["UPRN"])

    folds = models.walk_forward_years(range(1995, 2002))[-2:]
    return models.walk_forward(rows, folds, "FILE_YEAR", lambda: models.forest(max_features="0.3", trees=10, depth=6),
                               features.fit_features, sample)


@query
def city_scoring(spark, sf_dir):
    """A fitted model applied to the test rows of one city."""
    train, test = _sides(model_table(spark, sf_dir)[0])
    model = models.logistic(train.count(), C=1.0, max_iter=100).fit(train)
    city = test.where(F.col("LOCAL_AUTHORITY") == CITY)
    return models.score(model, city, "score", ["UPRN", "label"]).withColumn("flagged", metrics.classify("score"))


@query
def built_in_importance(spark, sf_dir):
    table_, enc = model_table(spark, sf_dir)
    model = models.forest(max_features="0.3", trees=10, depth=6).fit(_sides(table_)[0])
    return metrics.top_by_size(models.importances(spark, model, enc.names), "feature", "importance", 20)


@query
def permutation_importance(spark, sf_dir):
    table_, enc = model_table(spark, sf_dir)
    train, test = _sides(table_)
    model = models.logistic(train.count(), C=1.0).fit(train)
    found = models.permutation_importance(model, test, enc.names, ["UPRN"])
    return metrics.top_by_size(found, "feature", "importance", 20)


# --- incremental load ---------------------------------------------------------------------------


@query
def incremental_load(spark, sf_dir):
    """Yearly files arrive one by one; the result equals the preparation of all of them together."""
    columns = [*vocab.REQUIRED_COLUMNS, "FILE_YEAR", *TIES, "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS",
               "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT"]
    raw = certificates(spark, sf_dir, columns)
    path, out, checkpoint = (work_dir(spark, n) for n in ("arriving", "loaded", "progress"))
    raw.write.parquet(path)
    stream = incremental.watch_files(spark, path, raw.schema, files_per_batch=3)
    incremental.start_load(stream, out, checkpoint, "FILE_YEAR", TIES).awaitTermination()
    now = incremental.current(spark, out, "FILE_YEAR", TIES)
    return now.select("UPRN", "LODGEMENT_DATE", "CURRENT_ENERGY_RATING", "PROPERTY_TYPE", *TIES)
