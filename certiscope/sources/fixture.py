"""The certificate register as a view over the given star-schema tables.

The tables hold no certificates; the mapping below gives every column of the register a counterpart
with the same kind of content, including untidy text, invalid and missing values. Only the tables
that the asked columns need are joined (every foreign key has its row, so a join adds no filter).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from certiscope import vocab

KEYS = ["UPRN", "LODGEMENT_DATE", "TIE1", "TIE2", "TIE3"]
TIES = ["TIE1", "TIE2", "TIE3"]
FIRST_TEST_YEAR = 2000

_CUR = "(2 * p_size + l_linenumber - 3)"
_QTY = "cast(floor(l_quantity) as int)"
_POT = f"least(100, {_CUR} + {_QTY})"
_HEAT = "cast(floor(c_acctbal) as int)"
_CO2 = "cast(l_partkey % 97 as int)"


_LIMITS = {92: "A", 81: "B", 69: "C", 55: "D", 39: "E", 21: "F", 0: "G"}
_HIGHEST = 110
_LETTERS = "".join(next(r for limit, r in _LIMITS.items() if s >= limit) for s in range(_HIGHEST + 1))


def _band(score: str) -> str:
    """Rating letter of a score, looked up by position: the score is computed once."""
    return f"substring('{_LETTERS}', 1 + {score}, 1)"


def _score(raw: str) -> str:
    return f"greatest(1, least(999, {raw})) / 1000D"


_AGE = " ".join(
    f"when {i} then '{vocab.AGE_PREFIX}{name}'" for i, name in enumerate(vocab.AGE_BAND_ORDER)
)

# column -> (expression, tables it needs besides lineitem)
COLUMNS: dict[str, tuple[str, str]] = {
    "UPRN": ("cast(l_orderkey as string)", ""),
    "LODGEMENT_DATE": ("cast(cast(l_shipdate as date) as string)", ""),
    "FILE_YEAR": ("year(l_shipdate)", ""),
    "CURRENT_ENERGY_EFFICIENCY": (_CUR, "part"),
    "POTENTIAL_ENERGY_EFFICIENCY": (_POT, "part"),
    "CURRENT_ENERGY_RATING": (
        f"case when l_suppkey % 50 = 7 then 'Z' else concat(if(l_linenumber = 2, ' ', ''), "
        f"translate({_band(_CUR)}, if(l_linenumber = 3, 'G', ''), 'g')) end", "part"),
    "POTENTIAL_ENERGY_RATING": (_band(_POT), "part"),
    "PROPERTY_TYPE": (
        "case p_type when 'MEDIUM' then 'House' when 'ECONOMY' then 'Flat' when 'SMALL' then 'Maisonette' "
        "when 'STANDARD' then 'Bungalow' when 'PROMO' then 'Park home' else 'Other' end", "part"),
    "BUILT_FORM": ("o_orderpriority", "orders"),
    "TENURE": ("c_mktsegment", "customer"),
    "TRANSACTION_TYPE": ("l_returnflag", ""),
    "MAINS_GAS_FLAG": ("case when l_suppkey % 9 <> 0 then l_linestatus end", ""),
    "WALLS_DESCRIPTION": (
        "case when l_suppkey % 11 <> 0 then replace(replace(p_name, 'ring', 'Cavity wall'), 'red', 'Solid') end", "part"),
    "CONSTRUCTION_AGE_BAND": (
        f"case cast(l_partkey % 16 as int) {_AGE} when 12 then '1750' when 13 then '2021.0' when 14 then 'NO DATA!' end", ""),
    "TOTAL_FLOOR_AREA": ("case when l_suppkey % 10 <> 3 then cast(floor(l_extendedprice / 1000) as int) end", ""),
    "NUMBER_HABITABLE_ROOMS": ("case when l_suppkey % 7 <> 0 then cast(1 + l_partkey % 8 as int) end", ""),
    "HEATING_COST_CURRENT": (_HEAT, "customer"),
    "HEATING_COST_POTENTIAL": (f"{_HEAT} - {_QTY} * l_linenumber + 20", "customer"),
    "CO2_EMISSIONS_CURRENT": (_CO2, ""),
    "CO2_EMISSIONS_POTENTIAL": (f"{_CO2} - cast(l_suppkey % 13 as int) + 1", ""),
    "WALLS_ENERGY_EFF": (
        "case l_linenumber when 1 then 'N/A' when 2 then 'Very Poor' when 3 then 'Poor' when 4 then 'Average' "
        "when 5 then 'Good' when 6 then 'Very Good' end", ""),
    "REGION": ("r_name", "region"),
    "LOCAL_AUTHORITY": ("n_name", "nation"),
    "POSTCODE": ("concat('N', n_nationkey, ' ', l_suppkey % 10, 'AB')", "nation"),
    "SCORE_A": (
        _score(f"820 - 9 * {_CUR} + 6 * {_QTY} + (37 * l_partkey + 101 * l_suppkey + 17 * l_linenumber) % 300 "
               "- case when p_type = 'ECONOMY' then 250 else 0 end"), "part"),
    "SCORE_B": (
        _score(f"760 - 8 * {_CUR} + 5 * {_QTY} + (53 * l_partkey + 29 * l_suppkey + 71 * l_linenumber) % 400"), "part"),
    "TIE1": ("l_linenumber", ""),
    "TIE2": ("l_partkey", ""),
    "TIE3": ("l_suppkey", ""),
}

# table -> (join condition, table that has to come first)
_JOINS = {
    "part": ("l_partkey = p_partkey", ""),
    "orders": ("l_orderkey = o_orderkey", ""),
    "customer": ("o_custkey = c_custkey", "orders"),
    "nation": ("c_nationkey = n_nationkey", "customer"),
    "region": ("n_regionkey = r_regionkey", "nation"),
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the footer once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def certificates(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Raw certificates, one per line item. Catalyst picks the join strategy from the table sizes."""
    wanted = columns or list(COLUMNS)
    needed: set[str] = set()
    for c in wanted:
        step = COLUMNS[c][1]
        while step:
            needed.add(step)
            step = _JOINS[step][1]
    df = table(spark, sf_dir, "lineitem")
    for name, (condition, _) in _JOINS.items():
        if name in needed:
            df = df.join(table(spark, sf_dir, name), F.expr(condition))
    return df.select(*[F.expr(COLUMNS[c][0]).alias(c) for c in wanted])
