"""The expected answer of every query as DuckDB SQL over the same tables.

Written against the raw tables with plain windows and aggregates, independently of how the Spark side
gets there.
"""

from __future__ import annotations

from certiscope import vocab
from certiscope.operators.decisions import MIN_DISTRICT, MIN_GROUP, MIN_POSITIVES
from certiscope.operators.resampling import PRIME, replicate_constants


def _band(s: str) -> str:
    return (
        f"CASE WHEN {s} >= 92 THEN 'A' WHEN {s} >= 81 THEN 'B' WHEN {s} >= 69 THEN 'C' WHEN {s} >= 55 THEN 'D' "
        f"WHEN {s} >= 39 THEN 'E' WHEN {s} >= 21 THEN 'F' ELSE 'G' END"
    )


_AGES = " ".join(f"WHEN {i} THEN 'England and Wales: {n}'" for i, n in enumerate(vocab.AGE_BAND_ORDER))

CERT = f"""base AS (
  SELECT *, 2 * p_size + l_linenumber - 3 AS cur, CAST(floor(l_quantity) AS INTEGER) AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), sized AS (SELECT *, least(100, cur + qty) AS pot FROM base),
cert AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS UPRN, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS LODGEMENT_DATE,
    CAST(year(l_shipdate) AS INTEGER) AS FILE_YEAR, cur AS CURRENT_ENERGY_EFFICIENCY, pot AS POTENTIAL_ENERGY_EFFICIENCY,
    CASE WHEN l_suppkey % 50 = 7 THEN 'Z' WHEN l_linenumber = 2 THEN ' ' || {_band('cur')}
      WHEN l_linenumber = 3 AND {_band('cur')} = 'G' THEN 'g' ELSE {_band('cur')} END AS CURRENT_ENERGY_RATING,
    {_band('pot')} AS POTENTIAL_ENERGY_RATING,
    CASE p_type WHEN 'MEDIUM' THEN 'House' WHEN 'ECONOMY' THEN 'Flat' WHEN 'SMALL' THEN 'Maisonette'
      WHEN 'STANDARD' THEN 'Bungalow' WHEN 'PROMO' THEN 'Park home' ELSE 'Other' END AS PROPERTY_TYPE,
    o_orderpriority AS BUILT_FORM, c_mktsegment AS TENURE, l_returnflag AS TRANSACTION_TYPE,
    CASE WHEN l_suppkey % 9 <> 0 THEN l_linestatus END AS MAINS_GAS_FLAG,
    CASE WHEN l_suppkey % 11 <> 0 THEN replace(replace(p_name, 'ring', 'Cavity wall'), 'red', 'Solid') END AS WALLS_DESCRIPTION,
    CASE l_partkey % 16 {_AGES} WHEN 12 THEN '1750' WHEN 13 THEN '2021.0' WHEN 14 THEN 'NO DATA!' END AS CONSTRUCTION_AGE_BAND,
    CASE WHEN l_suppkey % 10 <> 3 THEN CAST(floor(l_extendedprice / 1000) AS INTEGER) END AS TOTAL_FLOOR_AREA,
    CASE WHEN l_suppkey % 7 <> 0 THEN CAST(1 + l_partkey % 8 AS INTEGER) END AS NUMBER_HABITABLE_ROOMS,
    CAST(floor(c_acctbal) AS INTEGER) AS HEATING_COST_CURRENT,
    CAST(floor(c_acctbal) AS INTEGER) - qty * l_linenumber + 20 AS HEATING_COST_POTENTIAL,
    CAST(l_partkey % 97 AS INTEGER) AS CO2_EMISSIONS_CURRENT,
    CAST(l_partkey % 97 AS INTEGER) - CAST(l_suppkey % 13 AS INTEGER) + 1 AS CO2_EMISSIONS_POTENTIAL,
    CASE l_linenumber WHEN 1 THEN 'N/A' WHEN 2 THEN 'Very Poor' WHEN 3 THEN 'Poor' WHEN 4 THEN 'Average'
      WHEN 5 THEN 'Good' WHEN 6 THEN 'Very Good' END AS WALLS_ENERGY_EFF,
    r_name AS REGION, n_name AS LOCAL_AUTHORITY, 'N' || n_nationkey || ' ' || (l_suppkey % 10) || 'AB' AS POSTCODE,
    CAST(greatest(1, least(999, 820 - 9 * cur + 6 * qty + (37 * l_partkey + 101 * l_suppkey + 17 * l_linenumber) % 300
      - CASE WHEN p_type = 'ECONOMY' THEN 250 ELSE 0 END)) AS DOUBLE) / 1000 AS SCORE_A,
    CAST(greatest(1, least(999, 760 - 8 * cur + 5 * qty + (53 * l_partkey + 29 * l_suppkey + 71 * l_linenumber) % 400)) AS DOUBLE) / 1000 AS SCORE_B,
    l_linenumber AS TIE1, l_partkey AS TIE2, l_suppkey AS TIE3
  FROM sized)"""

_WALL = "CASE WHEN contains(lower(WALLS_DESCRIPTION), 'solid') THEN 'solid' WHEN contains(lower(WALLS_DESCRIPTION), 'cavity') THEN 'cavity' ELSE 'other' END"
_BANDS = "(VALUES " + ", ".join(f"({i + 1}, '{n}', {lo}, {hi}, {mid})" for i, (n, lo, hi, mid) in enumerate(vocab.AGE_BANDS)) + ") b(place, name, lo, hi, mid)"
_MID = "CASE CONSTRUCTION_AGE_BAND " + " ".join(f"WHEN 'England and Wales: {n}' THEN {mid}" for n, _, _, mid in vocab.AGE_BANDS) + " END"

PREP = CERT + f""",
clean AS (
  SELECT * REPLACE (upper(trim(CURRENT_ENERGY_RATING)) AS CURRENT_ENERGY_RATING, trim(PROPERTY_TYPE) AS PROPERTY_TYPE,
    CAST(CURRENT_ENERGY_EFFICIENCY AS DOUBLE) AS CURRENT_ENERGY_EFFICIENCY, CAST(POTENTIAL_ENERGY_EFFICIENCY AS DOUBLE) AS POTENTIAL_ENERGY_EFFICIENCY,
    CAST(TOTAL_FLOOR_AREA AS DOUBLE) AS TOTAL_FLOOR_AREA, CAST(NUMBER_HABITABLE_ROOMS AS DOUBLE) AS NUMBER_HABITABLE_ROOMS,
    CAST(HEATING_COST_CURRENT AS DOUBLE) AS HEATING_COST_CURRENT, CAST(HEATING_COST_POTENTIAL AS DOUBLE) AS HEATING_COST_POTENTIAL,
    CAST(CO2_EMISSIONS_CURRENT AS DOUBLE) AS CO2_EMISSIONS_CURRENT, CAST(CO2_EMISSIONS_POTENTIAL AS DOUBLE) AS CO2_EMISSIONS_POTENTIAL)
  FROM cert
  WHERE upper(trim(CURRENT_ENERGY_RATING)) IN ('A','B','C','D','E','F','G') AND POTENTIAL_ENERGY_RATING IN ('A','B','C','D','E','F','G')
    AND trim(PROPERTY_TYPE) IN ('House','Flat','Maisonette','Bungalow','Park home')
    AND CURRENT_ENERGY_EFFICIENCY BETWEEN 1 AND 100 AND POTENTIAL_ENERGY_EFFICIENCY BETWEEN 1 AND 100
    AND coalesce(TOTAL_FLOOR_AREA, 0) >= 0 AND coalesce(NUMBER_HABITABLE_ROOMS, 0) >= 0
    AND coalesce(HEATING_COST_CURRENT, 0) >= 0 AND coalesce(CO2_EMISSIONS_CURRENT, 0) >= 0),
latest AS (
  SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY FILE_YEAR DESC, CAST(LODGEMENT_DATE AS DATE) DESC, TIE1 DESC, TIE2 DESC, TIE3 DESC) = 1),
prep AS (
  SELECT *, POTENTIAL_ENERGY_EFFICIENCY - CURRENT_ENERGY_EFFICIENCY AS EFFICIENCY_GAP,
    CASE WHEN CURRENT_ENERGY_RATING IN ('D','E','F','G') AND POTENTIAL_ENERGY_EFFICIENCY - CURRENT_ENERGY_EFFICIENCY >= 20 THEN 1 ELSE 0 END AS RETROFIT_POTENTIAL,
    CASE WHEN FILE_YEAR >= 2000 THEN 'test' ELSE 'train' END AS split, {_WALL} AS WALL_TYPE
  FROM latest)"""

TEST = PREP + """,
test AS (SELECT *, CAST(SCORE_A >= 0.5 AS INTEGER) AS PRED_A, CAST(SCORE_B >= 0.5 AS INTEGER) AS PRED_B FROM prep WHERE split = 'test')"""

LONG = TEST + """,
long AS (SELECT 'A' AS model, RETROFIT_POTENTIAL AS label, SCORE_A AS score FROM test
         UNION ALL SELECT 'B', RETROFIT_POTENTIAL, SCORE_B FROM test)"""

SAVE = TEST + """,
save AS (SELECT *, HEATING_COST_CURRENT - HEATING_COST_POTENTIAL AS COST_SAVING, CO2_EMISSIONS_CURRENT - CO2_EMISSIONS_POTENTIAL AS CO2_SAVING
         FROM test WHERE HEATING_COST_CURRENT - HEATING_COST_POTENTIAL >= 0 AND CO2_EMISSIONS_CURRENT - CO2_EMISSIONS_POTENTIAL >= 0),
dg AS (SELECT * FROM save WHERE CURRENT_ENERGY_RATING IN ('D','E','F','G')),
budget AS (SELECT CAST(floor(0.1 * count(*)) AS BIGINT) AS k FROM dg)"""

K = "UPRN, LODGEMENT_DATE, TIE1, TIE2, TIE3"


def _members(cities: list[str]) -> str:
    names = ", ".join(f"'{c}'" for c in cities)
    return f""", members AS (
  SELECT LOCAL_AUTHORITY, UPRN, POSTCODE FROM cert WHERE LOCAL_AUTHORITY IN ({names}) AND FILE_YEAR >= 2000
  QUALIFY row_number() OVER (PARTITION BY LOCAL_AUTHORITY, UPRN ORDER BY FILE_YEAR DESC, LODGEMENT_DATE DESC, TIE1 DESC, TIE2 DESC, TIE3 DESC) = 1)"""


def _hash(keys: str, seed: int = 42) -> str:
    """32-bit hash of the key columns, joined by |."""
    joined = " || '|' || ".join(f"CAST({k.strip()} AS VARCHAR)" for k in keys.split(","))
    return f"CAST('0x' || substr(md5('{seed}:' || {joined}), 1, 8) AS BIGINT)"


def _div(a: str, b: str, empty: str = "0.0") -> str:
    return f"CASE WHEN {b} <> 0 THEN ({a}) / CAST({b} AS DOUBLE) ELSE {empty} END"


_COUNTS = """CAST(count(*) FILTER (label = 1 AND pred = 1) AS BIGINT) AS tp, CAST(count(*) FILTER (label = 0 AND pred = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (label = 1 AND pred = 0) AS BIGINT) AS fn, CAST(count(*) FILTER (label = 0 AND pred = 0) AS BIGINT) AS tn"""
_PREC, _REC = _div("tp", "(tp + fp)"), _div("tp", "(tp + fn)")
_F1, _F0 = _div("2.0 * tp", "(2 * tp + fp + fn)"), _div("2.0 * tn", "(2 * tn + fp + fn)")
_F1M = f"(({_F1}) + ({_F0})) / 2"
_F1W = f"(({_F1}) * (tp + fn) + ({_F0}) * (tn + fp)) / (tp + fp + fn + tn)"
_ACC = _div("tp + tn", "(tp + fp + fn + tn)")

CELLS = LONG + """,
cells AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM long GROUP BY model, score),
cum AS (SELECT *, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg, sum(pos) OVER (PARTITION BY model) AS apos, sum(neg) OVER (PARTITION BY model) AS aneg,
          lead(pos) OVER w AS npos, lead(neg) OVER w AS nneg, row_number() OVER w AS rn
        FROM cells WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
curve AS (SELECT model, sum(neg * (cpos - pos + pos / 2.0)) / (CAST(max(apos) AS DOUBLE) * max(aneg)) AS roc_auc,
            sum(pos * CAST(cpos AS DOUBLE) / (cpos + cneg)) / max(apos) AS average_precision FROM cum GROUP BY model),
counts AS (SELECT model, """ + _COUNTS + """ FROM (SELECT *, CAST(score >= 0.5 AS INTEGER) AS pred FROM long) GROUP BY model)"""

COMPARE = CELLS + f""",
cmp AS (SELECT model, {_ACC} AS accuracy, {_PREC} AS "precision", {_REC} AS recall, {_F1M} AS f1_macro, {_F1W} AS f1_weighted,
        roc_auc, average_precision, (tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE) AS positive_rate FROM counts JOIN curve USING (model))"""


def _rounded(columns: str, places: int = 6) -> str:
    return ", ".join(f'round({c.strip()}, {places}) AS {c.strip()}' for c in columns.split(","))


_SQUARE = "(VALUES (0, 0, 0), (1, 2, 0), (2, 2, 1), (3, 0, 0)) s(place, dx, dy)"
RINGS = f"""WITH rings AS (
  SELECT c_custkey, c_name AS name, CAST(c_custkey % 180 AS INTEGER) AS x, c_nationkey AS y, CAST(r AS INTEGER) AS ring
  FROM customer, range(3) t(r) WHERE r < CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END),
vert AS (SELECT name, ring, place, CAST(x + dx AS DOUBLE) AS lon, CAST(y + dy AS DOUBLE) AS lat FROM rings, {_SQUARE})"""

_INPUT_NUMBERS = ["CURRENT_ENERGY_EFFICIENCY", "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT"]
_NUM = ", ".join(_INPUT_NUMBERS)
_NEG = " OR ".join(f"coalesce({c} < 0, false)" for c in _INPUT_NUMBERS)
_PROFILED = ["UPRN", "LODGEMENT_DATE", "MAINS_GAS_FLAG", "WALLS_DESCRIPTION", "CONSTRUCTION_AGE_BAND",
             "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "WALLS_ENERGY_EFF", "TENURE"]


def _ord(c: str, order: list[str]) -> str:
    return f"CAST(CASE {c} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(order)) + " ELSE -1 END AS DOUBLE)"


_CORR = {c: vocab.CORRELATION_LABELS[c] for c in
         ["CURRENT_ENERGY_EFFICIENCY", "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT", "RETROFIT_POTENTIAL"]}
_CORR_ORDER = [c for c in vocab.CORRELATION_COLUMNS if c in _CORR]
_CORR_ROWS = " UNION ALL ".join(
    f"SELECT '{_CORR[b]}' AS \"row\", '{_CORR[a]}' AS col, round(corr({b}, {a}), 6) AS r FROM prep"
    for i, a in enumerate(_CORR_ORDER) for b in _CORR_ORDER[i + 1:]
)

_FILL = """train AS (SELECT * FROM prep WHERE split = 'train'),
med AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _INPUT_NUMBERS) + """ FROM train),
mom AS (SELECT """ + ", ".join(
    f"avg(coalesce({c}, m_{c})) AS a_{c}, stddev_pop(coalesce({c}, m_{c})) AS s_{c}" for c in _INPUT_NUMBERS
) + """ FROM train, med)"""
_SCALED = {c: f"(coalesce({c}, m_{c}) - a_{c}) / s_{c}" for c in _INPUT_NUMBERS}


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


_TYPES = ["Bungalow", "Flat", "House", "Maisonette", "Park home"]

# Tenure and build values appear as they are in the tables.
_CITY = """SELECT LOCAL_AUTHORITY, tp + fp + fn + tn AS n, round(rate, 6) AS positive_rate, round(acc, 6) AS accuracy,
  round(greatest(rate, 1 - rate), 6) AS majority_accuracy, round(prec, 6) AS "precision", round(rec, 6) AS recall, round(f1, 6) AS f1,
  n_all - (tp + fp + fn + tn) AS n_rest, round(rest, 6) AS rest_positive_rate, round((rate - rest) * 100, 6) AS rate_gap_points,
  round(acc - greatest(rate, 1 - rate), 6) AS accuracy_gain,
  round((rate - rest) / sqrt(pooled * (1 - pooled) * (1.0 / n1 + 1.0 / (n_all - n1))), 6) AS z FROM scored"""


def _city(cities: list[str]) -> str:
    return (
        f"WITH {TEST}{_members(cities)}, per AS (SELECT LOCAL_AUTHORITY, {_COUNTS} FROM (SELECT m.LOCAL_AUTHORITY, RETROFIT_POTENTIAL AS label, PRED_A AS pred "
        f"FROM test JOIN members m USING (UPRN)) GROUP BY LOCAL_AUTHORITY), "
        "whole AS (SELECT count(*) AS n_all, CAST(sum(RETROFIT_POTENTIAL) AS BIGINT) AS x_all FROM test), "
        f"scored AS (SELECT *, tp + fp + fn + tn AS n1, (tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE) AS rate, {_ACC} AS acc, {_PREC} AS prec, {_REC} AS rec, {_F1} AS f1, "
        "(x_all - tp - fn) / CAST(n_all - (tp + fp + fn + tn) AS DOUBLE) AS rest, x_all / CAST(n_all AS DOUBLE) AS pooled FROM per, whole) " + _CITY
    )


_FAIR = f"""WITH {TEST}, g AS (
  SELECT 'Property type' AS dimension, PROPERTY_TYPE AS "group", RETROFIT_POTENTIAL AS label, PRED_A AS pred FROM test
  UNION ALL SELECT 'Tenure', TENURE, RETROFIT_POTENTIAL, PRED_A FROM test),
c AS (SELECT dimension, "group", {_COUNTS} FROM g WHERE "group" IS NOT NULL GROUP BY ALL),
fair AS (SELECT dimension, "group", tp + fp + fn + tn AS n, tp + fn AS positives, round((tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS positive_rate,
  round({_REC}, 6) AS recall, round({_PREC}, 6) AS "precision" FROM c WHERE tp + fp + fn + tn >= {MIN_GROUP} AND tp + fn >= {MIN_POSITIVES})"""


def _tuned(tune: str, hold: str, extra: str = "", source: str = "part") -> str:
    """Chosen threshold on the tuning rows and scores on the held rows of ``source``."""
    grid = f"range({min(vocab.TUNING_HUNDREDTHS)}, {max(vocab.TUNING_HUNDREDTHS) + 1}) t(h)"
    return f"""target AS (SELECT {_REC} AS target FROM (SELECT {_COUNTS} FROM (SELECT RETROFIT_POTENTIAL AS label, PRED_A AS pred FROM test WHERE PROPERTY_TYPE = 'House'))),
sweep AS (SELECT h, {_REC} AS recall FROM (SELECT h, {_COUNTS} FROM (SELECT h, RETROFIT_POTENTIAL AS label, CAST(SCORE_A >= h / 100.0::DOUBLE AS INTEGER) AS pred FROM {source}, {grid} WHERE {tune}) GROUP BY h)),
chosen AS (SELECT coalesce(max(h), 50) / 100.0::DOUBLE AS t FROM sweep, target WHERE recall >= target),
cc AS (SELECT k, {_COUNTS} FROM (SELECT 'before' AS k, RETROFIT_POTENTIAL AS label, CAST(SCORE_A >= 0.5::DOUBLE AS INTEGER) AS pred FROM {source} WHERE {hold}
   UNION ALL SELECT 'after', RETROFIT_POTENTIAL, CAST(SCORE_A >= t AS INTEGER) FROM {source}, chosen WHERE {hold}) GROUP BY k),
ms AS (SELECT k, {_REC} AS r, {_PREC} AS p, {_F1} AS f, tp + fp + fn + tn AS n FROM cc)
SELECT round(max(target), 6) AS reference_recall, round(max(t), 6) AS chosen_threshold,
  round(max(r) FILTER (k = 'before'), 6) AS recall_before, round(max(r) FILTER (k = 'after'), 6) AS recall_after,
  round(max(p) FILTER (k = 'before'), 6) AS precision_before, round(max(p) FILTER (k = 'after'), 6) AS precision_after,
  round(max(f) FILTER (k = 'before'), 6) AS f1_before, round(max(f) FILTER (k = 'after'), 6) AS f1_after, max(n) AS n_holdout{extra}
FROM ms, target, chosen"""


_DISTRICTS = f"""WITH {TEST}, centres AS (SELECT 'N' || n_nationkey AS district, 51 + n_nationkey / 100.0::DOUBLE AS lat, -2 - n_nationkey / 100.0::DOUBLE AS lon FROM nation WHERE n_nationkey % 4 <> 0),
dist AS (SELECT district, round(lat, 6) AS lat, round(lon, 6) AS lon, n, round(p, 6) AS predicted_positive_rate, round(a, 6) AS actual_positive_rate FROM
  (SELECT split_part(POSTCODE, ' ', 1) AS district, count(*) AS n, avg(PRED_A) AS p, avg(RETROFIT_POTENTIAL) AS a FROM test GROUP BY 1 HAVING count(*) >= {MIN_DISTRICT}) JOIN centres USING (district))"""

_IMPACT = "CAST({n} AS BIGINT) AS surveyed, CAST(floor({h}) AS BIGINT) AS true_positives, CAST(floor({c}) AS BIGINT) AS annual_cost_saving, round({e}, 1) AS annual_co2_saving"
_RANKED = "SELECT 'ranked' AS strategy, " + _IMPACT.format(n="count(*)", h="sum(RETROFIT_POTENTIAL)", c="sum(COST_SAVING)", e="sum(CO2_SAVING)") + \
    " FROM (SELECT * FROM dg, budget QUALIFY row_number() OVER (ORDER BY SCORE_A DESC, UPRN) <= k)"
_RANDOM = "SELECT 'rating band only' AS strategy, " + _IMPACT.format(n="max(k)", h="max(k) * avg(RETROFIT_POTENTIAL)", c="max(k) * avg(COST_SAVING)", e="max(k) * avg(CO2_SAVING)") + " FROM dg, budget"


def _ranked_sample(select: str, source: str, keys: str, quota: str, strata: str = "") -> str:
    part = f"PARTITION BY {strata} " if strata else ""
    return f"SELECT {select} FROM {source} QUALIFY row_number() OVER ({part}ORDER BY {_hash(keys)}, {keys}) <= {quota}"


_N = "(SELECT count(*) FROM prep)"
_NPOS = "(SELECT sum(RETROFIT_POTENTIAL) FROM prep)"
_QUOTA_POS = f"CAST(floor(2000 * ({_NPOS} / CAST({_N} AS DOUBLE))) AS BIGINT)"


def _histogram() -> str:
    x = "CAST(HEATING_COST_CURRENT AS DOUBLE)"
    return f"""WITH {PREP}, cap AS (SELECT quantile_cont({x}, 0.99) AS q FROM prep),
v AS (SELECT RETROFIT_POTENTIAL, {x} AS x FROM prep, cap WHERE {x} <= q),
e AS (SELECT RETROFIT_POTENTIAL, count(*) AS n, min(x) AS lo, (max(x) - min(x)) / 40 AS w FROM v GROUP BY 1),
g AS (SELECT *, least(floor((x - lo) / w), 39) AS g FROM v JOIN e USING (RETROFIT_POTENTIAL)),
b AS (SELECT *, CAST(CASE WHEN x < lo + g * w THEN g - 1 WHEN g < 39 AND x >= lo + (g + 1) * w THEN g + 1 ELSE g END AS INTEGER) AS bin FROM g)
SELECT RETROFIT_POTENTIAL, bin, round(max(lo) + bin * max(w), 8) AS left_edge, count(*) AS count, round(count(*) / (max(n) * max(w)), 8) AS density FROM b GROUP BY 1, 2"""


def _bootstrap(replicates: int = 20) -> str:
    """ROC-AUC of every model and replicate, with the same Poisson weights per cell of equal scores."""
    constants = ", ".join(f"({b}, {a}, {c})" for b, (a, c) in enumerate(replicate_constants(replicates, 42)))
    return f"""{TEST},
cell AS (SELECT RETROFIT_POTENTIAL AS label, SCORE_A AS a, SCORE_B AS b, count(*) AS c, {_hash('RETROFIT_POTENTIAL, SCORE_A, SCORE_B')} AS h FROM test GROUP BY 1, 2, 3),
rep(r, mul, add) AS (VALUES {constants}),
pmf AS (SELECT c, k, exp(k * ln(c) - c - lgamma(k + 1)) AS p FROM (SELECT DISTINCT c FROM cell), range(0, 5000) t(k) WHERE k <= c + 10 * sqrt(c) + 20),
lim AS (SELECT c, floor(sum(p) OVER (PARTITION BY c ORDER BY k) * {PRIME}) AS l FROM pmf),
drawn AS (SELECT label, a, b, c, h, r, (h % {PRIME} * mul + add) % {PRIME} AS u FROM cell, rep),
weight AS (SELECT label, a, b, r, count(l) AS w FROM drawn d LEFT JOIN lim ON lim.c = d.c AND lim.l <= d.u GROUP BY label, a, b, r),
joint AS (SELECT 'A' AS model, r, a AS score, label, w FROM weight UNION ALL SELECT 'B', r, b, label, w FROM weight),
sc AS (SELECT model, r, score, sum(w * label) AS pos, sum(w * (1 - label)) AS neg FROM joint GROUP BY 1, 2, 3),
run AS (SELECT *, sum(pos) OVER (PARTITION BY model, r ORDER BY score DESC) AS cp FROM sc),
draws AS (SELECT model, r, sum(neg * (cp - pos + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc FROM run GROUP BY 1, 2)"""


_FOLDS = [(list(range(1995, y)), y) for y in range(1997, 2002)]


def _fold_rows() -> str:
    parts = []
    for years, test_year in _FOLDS:
        for side, wanted, total in (("train", years, 2000), ("test", [test_year], 500)):
            listed = ", ".join(map(str, wanted))
            parts.append(
                f"SELECT {test_year} AS test_year, '{side}' AS side, count(*) AS n, round(avg(RETROFIT_POTENTIAL), 6) AS positive_rate "
                f"FROM ranked WHERE FILE_YEAR IN ({listed}) AND rn <= {total // len(wanted)}"
            )
    return " UNION ALL ".join(parts)


_LEVELS = {
    "PROPERTY_TYPE": _TYPES,
    "BUILT_FORM": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "TENURE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "WALL_TYPE": ["cavity", "other", "solid"],
}


def _simple_matrix() -> str:
    numbers = ["CURRENT_ENERGY_EFFICIENCY", "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS"]
    filled = [f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM prep)) AS {c}" for c in numbers]
    age = f"CAST(coalesce({_MID}, (SELECT quantile_cont(CAST({_MID} AS DOUBLE), 0.5) FROM prep)) AS DOUBLE) AS AGE_BAND_YEAR"
    dummies = [
        f"CAST({c} = '{v}' AS INTEGER) AS \"{c}_{v.replace(' ', '_')}\"" for c, levels in _LEVELS.items() for v in levels[1:]
    ]
    return f"WITH {PREP} SELECT UPRN, {', '.join([*filled, age, *dummies])}, RETROFIT_POTENTIAL FROM prep"


SQL: dict[str, str] = {
    "build_feature_matrix": _simple_matrix(),
    "csv_scan": f"WITH {CERT} SELECT UPRN, LODGEMENT_DATE, CAST(TIE1 AS VARCHAR) AS TIE1, CAST(TIE2 AS VARCHAR) AS TIE2, CAST(TIE3 AS VARCHAR) AS TIE3, CURRENT_ENERGY_RATING, nullif(WALLS_ENERGY_EFF, 'N/A') AS WALLS_ENERGY_EFF, WALLS_DESCRIPTION, CAST(TOTAL_FLOOR_AREA AS VARCHAR) AS TOTAL_FLOOR_AREA FROM cert",
    "csv_split_scan": f"WITH {CERT} SELECT UPRN, LODGEMENT_DATE, CAST(TIE1 AS VARCHAR) AS TIE1, CAST(TIE2 AS VARCHAR) AS TIE2, CAST(TIE3 AS VARCHAR) AS TIE3, CURRENT_ENERGY_RATING, nullif(WALLS_ENERGY_EFF, 'N/A') AS WALLS_ENERGY_EFF, replace(WALLS_DESCRIPTION, ', ', ',' || chr(10)) AS WALLS_DESCRIPTION, CAST(TOTAL_FLOOR_AREA AS VARCHAR) AS TOTAL_FLOOR_AREA FROM cert",
    "yearly_scan": f"WITH {CERT} SELECT FILE_YEAR, count(*) AS n, min(LODGEMENT_DATE) AS first_date, max(LODGEMENT_DATE) AS last_date, count(TOTAL_FLOOR_AREA) AS with_area FROM cert GROUP BY 1",
    "pruned_scan": f"WITH {CERT} SELECT UPRN AS uprn, POSTCODE AS postcode, LOCAL_AUTHORITY AS local_authority FROM cert",
    "pushdown_range_scan": "SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS lodged FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01'",
    "normalise_header": "SELECT c_custkey AS UPRN, c_name AS C_NAME, c_nationkey AS C_NATIONKEY, c_mktsegment AS C_MKTSEGMENT FROM customer",
    "required_columns_report": "SELECT 'full' AS source, count(*) AS n_rows, CAST(0 AS BIGINT) AS missing_columns, true AS used FROM lineitem UNION ALL SELECT 'no rating', count(*), 1, false FROM lineitem UNION ALL SELECT 'orders', count(*), 7, false FROM orders",
    "prepared_round_trip": f"WITH {PREP} SELECT UPRN, LODGEMENT_DATE, FILE_YEAR, RETROFIT_POTENTIAL FROM prep WHERE split = 'test' AND FILE_YEAR = 2001",
    "geojson_rings": RINGS + " SELECT name, ring, place, lon, lat FROM vert",
    "ring_anchor": RINGS + " SELECT name, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat, count(*) AS n_vertices FROM vert WHERE ring = 0 GROUP BY name",
    "ring_box": RINGS + " SELECT round(min(lon) - 0.04 * (max(lon) - min(lon)), 6) AS x_min, round(max(lon) + 0.04 * (max(lon) - min(lon)), 6) AS x_max, round(min(lat) - 0.04 * (max(lat) - min(lat)), 6) AS y_min, round(max(lat) + 0.04 * (max(lat) - min(lat)), 6) AS y_max FROM vert",
    "drop_null_keys": f"WITH {CERT} SELECT {K}, TOTAL_FLOOR_AREA, NUMBER_HABITABLE_ROOMS FROM cert WHERE TOTAL_FLOOR_AREA IS NOT NULL AND NUMBER_HABITABLE_ROOMS IS NOT NULL",
    "standardise_text": f"WITH {CERT} SELECT {K}, upper(trim(CURRENT_ENERGY_RATING)) AS CURRENT_ENERGY_RATING, POTENTIAL_ENERGY_RATING, PROPERTY_TYPE FROM cert",
    "valid_domain_filter": f"WITH {CERT} SELECT {K}, CURRENT_ENERGY_RATING, POTENTIAL_ENERGY_RATING, PROPERTY_TYPE FROM cert WHERE CURRENT_ENERGY_RATING IN ('A','B','C','D','E','F','G') AND PROPERTY_TYPE <> 'Other'",
    "coerce_numeric": f"WITH {CERT} SELECT {K}, TRY_CAST(CASE WHEN TOTAL_FLOOR_AREA IS NULL THEN 'n/a' WHEN TIE1 = 2 THEN TOTAL_FLOOR_AREA::VARCHAR WHEN TIE1 = 3 THEN TOTAL_FLOOR_AREA || 'm2' WHEN TIE1 = 4 THEN TOTAL_FLOOR_AREA || '.5e1' ELSE TOTAL_FLOOR_AREA::VARCHAR END AS DOUBLE) AS TOTAL_FLOOR_AREA FROM cert",
    "coerce_date": f"WITH {CERT}, d AS (SELECT *, TRY_CAST(CASE WHEN TIE1 = 7 THEN 'unknown' WHEN TIE1 = 6 THEN LODGEMENT_DATE || '?' ELSE LODGEMENT_DATE END AS DATE) AS lodged FROM cert) SELECT {K}, lodged, CAST(year(lodged) AS INTEGER) AS lodged_year FROM d",
    "range_filter": f"WITH {CERT} SELECT {K}, CURRENT_ENERGY_EFFICIENCY, POTENTIAL_ENERGY_EFFICIENCY FROM cert WHERE CURRENT_ENERGY_EFFICIENCY BETWEEN 1 AND 100 AND POTENTIAL_ENERGY_EFFICIENCY BETWEEN 1 AND 100",
    "nonnegative_filter": f"WITH {CERT} SELECT {K}, {_NUM} FROM cert WHERE NOT ({_NEG})",
    "valid_records": f"WITH {CERT} SELECT {K}, CURRENT_ENERGY_RATING, POTENTIAL_ENERGY_RATING, PROPERTY_TYPE, POTENTIAL_ENERGY_EFFICIENCY, {_NUM} FROM cert WHERE NOT ({_NEG}) AND CURRENT_ENERGY_RATING IN ('A','B','C','D','E','F','G') AND PROPERTY_TYPE <> 'Other' AND CURRENT_ENERGY_EFFICIENCY BETWEEN 1 AND 100 AND POTENTIAL_ENERGY_EFFICIENCY BETWEEN 1 AND 100",
    "normalise_id": f"WITH {CERT}, r AS (SELECT * REPLACE (CASE TIE1 WHEN 1 THEN UPRN || '.0' WHEN 2 THEN ' ' || UPRN WHEN 3 THEN 'nan' ELSE UPRN END AS UPRN) FROM cert) SELECT trim(split_part(UPRN, '.', 1)) AS UPRN, LODGEMENT_DATE, TIE1, TIE2, TIE3 FROM r WHERE UPRN <> 'nan'",
    "savings_filter": f"WITH {CERT} SELECT {K}, HEATING_COST_CURRENT - HEATING_COST_POTENTIAL AS COST_SAVING, CO2_EMISSIONS_CURRENT - CO2_EMISSIONS_POTENTIAL AS CO2_SAVING FROM cert WHERE HEATING_COST_CURRENT >= HEATING_COST_POTENTIAL AND CO2_EMISSIONS_CURRENT >= CO2_EMISSIONS_POTENTIAL",
    "percentile_cap": f"WITH {CERT} SELECT {K}, TOTAL_FLOOR_AREA FROM cert WHERE TOTAL_FLOOR_AREA <= (SELECT quantile_cont(CAST(TOTAL_FLOOR_AREA AS DOUBLE), 0.99) FROM cert)",
    "engineer_target": f"WITH {CERT} SELECT {K}, POTENTIAL_ENERGY_EFFICIENCY - CURRENT_ENERGY_EFFICIENCY AS EFFICIENCY_GAP, CASE WHEN CURRENT_ENERGY_RATING IN ('D','E','F','G') AND POTENTIAL_ENERGY_EFFICIENCY - CURRENT_ENERGY_EFFICIENCY >= 20 THEN 1 ELSE 0 END AS RETROFIT_POTENTIAL FROM cert",
    "encode_age_band": f"WITH {CERT} SELECT {K}, CAST(coalesce({_MID}, (SELECT quantile_cont(CAST({_MID} AS DOUBLE), 0.5) FROM cert)) AS DOUBLE) AS AGE_BAND_YEAR FROM cert",
    "age_to_band": f"WITH {CERT}, t AS (SELECT *, trim(replace(CONSTRUCTION_AGE_BAND, 'England and Wales:', '')) AS s FROM cert), y AS (SELECT *, TRY_CAST(regexp_extract(s, '^(\\d{{4}})(\\.0)?$', 1) AS INTEGER) AS yr FROM t) SELECT {K}, b.name AS band FROM y LEFT JOIN {_BANDS} ON s = b.name OR yr BETWEEN b.lo AND b.hi",
    "extract_wall_type": f"WITH {CERT} SELECT {K}, {_WALL} AS WALL_TYPE FROM cert",
    "outward_code": f"WITH {CERT} SELECT {K}, split_part(POSTCODE, ' ', 1) AS outward FROM cert",
    "classify_threshold": f"WITH {CERT} SELECT {K}, CAST(SCORE_A >= 0.5 AS INTEGER) AS flagged FROM cert",
    "cv_text_parse": f"WITH {CERT} SELECT TENURE, CAST(printf('%.4f', avg(TOTAL_FLOOR_AREA)) AS DOUBLE) AS mean, CAST(printf('%.4f', stddev_pop(TOTAL_FLOOR_AREA)) AS DOUBLE) AS sd FROM cert GROUP BY TENURE",
    "enrich_left_join": f"WITH {PREP} SELECT UPRN, TENURE, CURRENT_ENERGY_RATING, HEATING_COST_CURRENT, CO2_EMISSIONS_CURRENT, RETROFIT_POTENTIAL, FILE_YEAR FROM prep WHERE split = 'test'",
    "attach_scores": f"WITH {PREP} SELECT UPRN, RETROFIT_POTENTIAL, TIE1, TIE2, TIE3, SCORE_A FROM (SELECT UPRN, RETROFIT_POTENTIAL, TIE1, TIE2, TIE3 FROM prep WHERE split = 'test') JOIN (SELECT UPRN, TIE1, TIE2, TIE3, min(SCORE_A) AS SCORE_A FROM cert GROUP BY ALL) USING (UPRN, TIE1, TIE2, TIE3)",
    "city_slice": f"WITH {TEST}{_members(['NATION_3'])} SELECT UPRN, RETROFIT_POTENTIAL, m.POSTCODE FROM test JOIN members m USING (UPRN)",
    "semi_split": f"WITH {TEST}{_members(['NATION_3'])} SELECT UPRN, RETROFIT_POTENTIAL FROM test WHERE UPRN IN (SELECT UPRN FROM members)",
    "anti_split": f"WITH {TEST}{_members(['NATION_3'])} SELECT UPRN, RETROFIT_POTENTIAL FROM test WHERE UPRN NOT IN (SELECT UPRN FROM members)",
    "city_flag": f"WITH {TEST}{_members(['NATION_3'])} SELECT UPRN IN (SELECT UPRN FROM members) AS in_city, count(*) AS n, CAST(sum(RETROFIT_POTENTIAL) AS BIGINT) AS positives FROM test GROUP BY 1",
    "missing_dimension_report": f"WITH {CERT} SELECT DISTINCT split_part(POSTCODE, ' ', 1) AS district FROM cert EXCEPT SELECT 'N' || n_nationkey FROM nation WHERE n_nationkey % 4 <> 0",
    "union_years": f"WITH {CERT} SELECT FILE_YEAR, count(*) AS n, count(CASE WHEN FILE_YEAR >= 1998 THEN TENURE END) AS with_tenure, CAST(sum(TOTAL_FLOOR_AREA) AS BIGINT) AS area FROM cert GROUP BY 1",
    "latest_per_key": f"WITH {PREP} SELECT UPRN, LODGEMENT_DATE, CURRENT_ENERGY_RATING, TENURE, TOTAL_FLOOR_AREA, HEATING_COST_CURRENT, TIE1, TIE2, TIE3, RETROFIT_POTENTIAL, split FROM prep",
    "latest_per_key_simple": f"WITH {CERT} SELECT {K}, TRANSACTION_TYPE, TOTAL_FLOOR_AREA FROM cert QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY LODGEMENT_DATE DESC, TIE1 DESC, TIE2 DESC, TIE3 DESC) = 1",
    "latest_per_key_late": f"WITH {CERT} SELECT {K}, TRANSACTION_TYPE, TOTAL_FLOOR_AREA FROM cert QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY LODGEMENT_DATE DESC, TIE1 DESC, TIE2 DESC, TIE3 DESC) = 1",
    "last_per_key": f"WITH {CERT} SELECT {K}, FILE_YEAR, TRANSACTION_TYPE FROM cert QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY FILE_YEAR DESC, LODGEMENT_DATE DESC, TIE1 DESC, TIE2 DESC, TIE3 DESC) = 1",
    "dedup_key": f"WITH {CERT} SELECT {K}, TRANSACTION_TYPE FROM cert QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY LODGEMENT_DATE, TIE1, TIE2, TIE3) = 1",
    "uniform_sample_n": f"WITH {CERT} " + _ranked_sample(f"{K}, TRANSACTION_TYPE", "cert", K, "1000"),
    "stratified_sample_quota": f"WITH {PREP} SELECT UPRN, RETROFIT_POTENTIAL, split FROM prep QUALIFY {_N} <= 2000 OR row_number() OVER (PARTITION BY RETROFIT_POTENTIAL ORDER BY {_hash('UPRN')}, UPRN) <= CASE WHEN RETROFIT_POTENTIAL = 1 THEN {_QUOTA_POS} ELSE 2000 - {_QUOTA_POS} END",
    "stratified_sample_frac": f"WITH {PREP} SELECT UPRN, RETROFIT_POTENTIAL, split FROM prep QUALIFY {_N} <= 2000 OR row_number() OVER (PARTITION BY RETROFIT_POTENTIAL ORDER BY {_hash('UPRN')}, UPRN) <= round_even(count(*) OVER (PARTITION BY RETROFIT_POTENTIAL) * (2000 / CAST({_N} AS DOUBLE)), 0)",
    "per_year_sample": f"WITH {CERT} " + _ranked_sample(f"{K}, FILE_YEAR", "cert", K, "500", "FILE_YEAR"),
    "temporal_split": "SELECT CASE WHEN y >= 2000 THEN 'test' ELSE 'train' END AS split, y AS FILE_YEAR, count(*) AS n FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem) GROUP BY ALL",
    "stratified_folds": f"WITH {PREP}, r AS (SELECT UPRN, RETROFIT_POTENTIAL, row_number() OVER (PARTITION BY RETROFIT_POTENTIAL ORDER BY {_hash('UPRN')}, UPRN) AS rn, count(*) OVER (PARTITION BY RETROFIT_POTENTIAL) AS n FROM prep) SELECT UPRN, RETROFIT_POTENTIAL, CAST((rn - 1) * 5 // n AS INTEGER) AS fold FROM r",
    "half_split": f"WITH {PREP}, f AS (SELECT UPRN FROM prep WHERE PROPERTY_TYPE = 'Flat') SELECT UPRN, CASE WHEN row_number() OVER (ORDER BY {_hash('UPRN')}, UPRN) <= count(*) OVER () // 2 THEN 'tune' ELSE 'hold' END AS half FROM f",
    "outcome_examples": f"WITH {TEST}, o AS (SELECT *, CASE WHEN RETROFIT_POTENTIAL <> PRED_A THEN 'error' WHEN PRED_A = 1 THEN 'correct_positive' ELSE 'correct_negative' END AS outcome FROM test) SELECT UPRN, PROPERTY_TYPE, outcome, SCORE_A, CASE PRED_A WHEN 1 THEN 'Yes' ELSE 'No' END AS predicted, CASE RETROFIT_POTENTIAL WHEN 1 THEN 'Yes' ELSE 'No' END AS actual FROM o QUALIFY row_number() OVER (PARTITION BY outcome ORDER BY {_hash('UPRN')}, UPRN) <= CASE outcome WHEN 'error' THEN 2 ELSE 3 END",
    "class_balance": f"WITH {PREP} SELECT split, RETROFIT_POTENTIAL, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share FROM prep GROUP BY 1, 2",
    "missing_profile": f"WITH {CERT}, m AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", avg(CAST({c} IS NULL AS INTEGER)) AS r FROM cert" for c in _PROFILED) + ") SELECT \"column\", round(r, 6) AS missing_rate, r > 0.05 AS over_alarm FROM m WHERE r > 0",
    "summary_stats": f"WITH {PREP}, s AS (SELECT RETROFIT_POTENTIAL AS y, TOTAL_FLOOR_AREA IS NULL OR NUMBER_HABITABLE_ROOMS IS NULL OR MAINS_GAS_FLAG IS NULL AS miss FROM prep) SELECT count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS positives, round(avg(y), 6) AS positive_rate, CAST(5 AS BIGINT) AS n_columns, count(*) FILTER (miss) AS rows_with_missing, round(avg(CAST(miss AS INTEGER)), 6) AS missing_share FROM s",
    "negative_audit": f"WITH {CERT}, a AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < 0) AS negatives, CAST(min({c}) AS DOUBLE) AS minimum FROM cert" for c in _INPUT_NUMBERS) + ") SELECT * FROM a WHERE negatives > 0",
    "negative_rows": f"WITH {CERT} SELECT count(*) FILTER ({_NEG}) AS rows_with_negative, round(avg(CAST(({_NEG}) AS INTEGER)), 6) AS share FROM cert",
    "class_histogram": _histogram(),
    "correlation_matrix": f"WITH {PREP} {_CORR_ROWS}",
    "crosstab_pct": f"WITH {PREP} SELECT PROPERTY_TYPE, " + ", ".join(f"round(100.0 * count(*) FILTER (CURRENT_ENERGY_RATING = '{r}') / count(*), 6) AS pct_{r}" for r in vocab.RATINGS_BEST_FIRST) + " FROM prep GROUP BY 1",
    "rate_by_band": f"WITH {PREP}, t AS (SELECT RETROFIT_POTENTIAL, trim(replace(CONSTRUCTION_AGE_BAND, 'England and Wales:', '')) AS s FROM prep), y AS (SELECT *, TRY_CAST(regexp_extract(s, '^(\\d{{4}})(\\.0)?$', 1) AS INTEGER) AS yr FROM t) SELECT b.name AS band, CAST(any_value(b.place) AS INTEGER) AS place, count(*) AS n, round(avg(RETROFIT_POTENTIAL), 6) AS rate, round((SELECT avg(RETROFIT_POTENTIAL) FROM prep), 6) AS overall_rate FROM y JOIN {_BANDS} ON s = b.name OR yr BETWEEN b.lo AND b.hi GROUP BY b.name",
    "category_counts": f"WITH {CERT}, c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM cert" for c in ["PROPERTY_TYPE", "CURRENT_ENERGY_RATING", "FILE_YEAR", "MAINS_GAS_FLAG"]) + ") SELECT \"column\", value, count(*) AS n FROM c WHERE value IS NOT NULL GROUP BY 1, 2",
    "schema_profile": f"WITH {CERT} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS filled, '{'int' if c in ('TOTAL_FLOOR_AREA', 'NUMBER_HABITABLE_ROOMS') else 'string'}' AS \"type\" FROM cert" for c in _PROFILED),
    "impute_values": f"WITH {CERT} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS lower_quartile, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, CAST(NULL AS VARCHAR) AS \"mode\" FROM cert" for c in ["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "HEATING_COST_CURRENT"]) + " UNION ALL " + " UNION ALL ".join(f"SELECT '{c}', NULL, NULL, (SELECT {c} FROM cert WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in ["MAINS_GAS_FLAG", "WALLS_ENERGY_EFF", "TENURE"]),
    "scale_numeric": f"WITH {PREP}, {_FILL} SELECT UPRN, " + ", ".join(f"round({e}, 6) AS {c}" for c, e in _SCALED.items()) + " FROM prep, med, mom",
    "ordinal_encode": f"WITH {PREP}, train AS (SELECT * FROM prep WHERE split = 'train') SELECT UPRN, " + ", ".join(_ord(f"coalesce({c}, {_mode(c)})", o) + f" AS {c}" for c, o in (("CURRENT_ENERGY_RATING", vocab.RATINGS_WORST_FIRST), ("WALLS_ENERGY_EFF", vocab.COMPONENT_LEVELS))) + " FROM prep",
    "one_hot_drop_first": f"WITH {PREP}, train AS (SELECT * FROM prep WHERE split = 'train'), f AS (SELECT UPRN, PROPERTY_TYPE, coalesce(MAINS_GAS_FLAG, {_mode('MAINS_GAS_FLAG')}) AS gas, WALL_TYPE FROM prep) SELECT UPRN, " + ", ".join(f"CAST(PROPERTY_TYPE = '{t}' AS DOUBLE) AS PROPERTY_TYPE_{t.replace(' ', '_')}" for t in _TYPES[1:]) + ", CAST(gas = 'O' AS DOUBLE) AS MAINS_GAS_FLAG_O, " + ", ".join(f"CAST(WALL_TYPE = '{t}' AS DOUBLE) AS WALL_TYPE_{t}" for t in ("other", "solid")) + " FROM f",
    "matrix_null_check": f"WITH {PREP}, train AS (SELECT * FROM prep WHERE split = 'train'), k AS (" + " UNION ALL ".join(f"SELECT count(DISTINCT {c}) - 1 AS c FROM train" for c in vocab.NOMINAL_INPUTS) + ") SELECT (SELECT count(*) FROM prep) AS n_rows, CAST(7 + sum(c) AS BIGINT) AS n_columns, CAST(0 AS BIGINT) AS missing_cells FROM k",
    "class_weights": f"WITH {PREP}, c AS (SELECT RETROFIT_POTENTIAL, count(*) AS n FROM prep WHERE split = 'train' GROUP BY 1) SELECT RETROFIT_POTENTIAL, n, round((SELECT sum(n) FROM c) / (2.0 * n), 6) AS balanced_weight, round((SELECT n FROM c WHERE RETROFIT_POTENTIAL = 0) / CAST((SELECT n FROM c WHERE RETROFIT_POTENTIAL = 1) AS DOUBLE), 6) AS pos_weight FROM c",
    "confusion_matrix": f"WITH {CELLS} SELECT model, tn, fp, fn, tp FROM counts",
    "classification_report": f"""WITH {CELLS}, m AS (SELECT *, {_div('tn', '(tn + fn)')} AS p0, {_div('tn', '(tn + fp)')} AS r0, {_F0} AS f0, {_PREC} AS p1, {_REC} AS r1, {_F1} AS f1, {_ACC} AS acc, tn + fp AS n0, tp + fn AS n1 FROM counts)
SELECT model, 'low' AS class, round(p0, 6) AS "precision", round(r0, 6) AS recall, round(f0, 6) AS f1, n0 AS support FROM m
UNION ALL SELECT model, 'high', round(p1, 6), round(r1, 6), round(f1, 6), n1 FROM m
UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n0 + n1 FROM m
UNION ALL SELECT model, 'weighted avg', round((p0 * n0 + p1 * n1) / (n0 + n1), 6), round((r0 * n0 + r1 * n1) / (n0 + n1), 6), round((f0 * n0 + f1 * n1) / (n0 + n1), 6), n0 + n1 FROM m
UNION ALL SELECT model, 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n0 + n1 FROM m""",
    "roc_auc": f"WITH {CELLS} SELECT model, tp + fn AS positives, tn + fp AS negatives, round(roc_auc, 8) AS roc_auc FROM counts JOIN curve USING (model)",
    "average_precision": f"WITH {CELLS} SELECT model, round(average_precision, 8) AS average_precision FROM curve",
    "roc_curve": f"WITH {CELLS} SELECT model, round(score, 8) AS threshold, round(cneg / CAST(aneg AS DOUBLE), 8) AS fpr, round(cpos / CAST(apos AS DOUBLE), 8) AS tpr FROM cum WHERE rn = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM cells",
    "pr_curve": f"WITH {CELLS} SELECT model, round(apos / CAST(apos + aneg AS DOUBLE), 8) AS no_skill, round(score, 8) AS threshold, round(cpos / CAST(cpos + cneg AS DOUBLE), 8) AS \"precision\", round(cpos / CAST(apos AS DOUBLE), 8) AS recall FROM cum UNION ALL SELECT DISTINCT model, round(apos / CAST(apos + aneg AS DOUBLE), 8), NULL, 1.0, 0.0 FROM cum",
    "evaluate_model": f"WITH {COMPARE} SELECT model, round(f1_weighted, 6) AS f1_weighted, round(roc_auc, 6) AS roc_auc FROM cmp",
    "model_comparison": f"WITH {COMPARE} SELECT model, {_rounded('accuracy, precision, recall, f1_macro, roc_auc, average_precision')} FROM cmp",
    "metric_winners": f"WITH {COMPARE} " + " UNION ALL ".join(f"(SELECT '{m}' AS metric, model AS winner, round({m}, 4) AS value FROM cmp ORDER BY round({m}, 4) {d}, model LIMIT 1)" for m, d in [("accuracy", "DESC"), ("precision", "DESC"), ("recall", "DESC"), ("f1_macro", "DESC"), ("roc_auc", "DESC"), ("average_precision", "DESC"), ("positive_rate", "ASC")]),
    "baseline_delta": f"WITH {COMPARE} SELECT 'B' AS base, 'A' AS best, " + ", ".join(f"round(a.{m} - b.{m}, 6) AS {m}_delta" for m in ("roc_auc", "f1_macro", "average_precision")) + " FROM cmp a, cmp b WHERE a.model = 'A' AND b.model = 'B'",
    "calibration_curve": f"WITH {LONG} SELECT model, bin, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS positive_share FROM (SELECT *, " + " + ".join(f"CAST(score > {i / 10}::DOUBLE AS INTEGER)" for i in range(1, 10)) + " AS bin FROM long) GROUP BY model, bin",
    "mcnemar": f"WITH {TEST}, r AS (SELECT RETROFIT_POTENTIAL AS y, PRED_A, PRED_B, CAST(CURRENT_ENERGY_RATING IN ('D','E','F','G') AS INTEGER) AS PRED_RATING FROM test), c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS pair, count(*) FILTER ({a} <> y AND {b} = y) AS only_b_right, count(*) FILTER ({a} = y AND {b} <> y) AS only_a_right FROM r" for n, a, b in [("A vs B", "PRED_A", "PRED_B"), ("A vs rating", "PRED_A", "PRED_RATING"), ("B vs rating", "PRED_B", "PRED_RATING")]) + "), s AS (SELECT *, CASE WHEN only_a_right + only_b_right > 0 THEN power(abs(only_b_right - only_a_right) - 1, 2) / CAST(only_a_right + only_b_right AS DOUBLE) END AS statistic FROM c) SELECT pair, only_b_right, only_a_right, round(statistic, 6) AS statistic, statistic > 3.841458820694124 AS significant FROM s",
    "top_features": f"WITH {PREP}, c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr(RETROFIT_POTENTIAL, {c}), 6) AS r FROM prep" for c in _INPUT_NUMBERS) + ") SELECT feature, r FROM c ORDER BY abs(r) DESC, feature LIMIT 3",
    "topk_budget": f"WITH {SAVE} SELECT UPRN, SCORE_A, RETROFIT_POTENTIAL FROM dg, budget QUALIFY row_number() OVER (ORDER BY SCORE_A DESC, UPRN) <= k",
    "impact_ranked": f"WITH {SAVE} {_RANKED}",
    "impact_random": f"WITH {SAVE} {_RANDOM}",
    "impact_uplift": f"WITH {SAVE}, a AS ({_RANKED}), b AS ({_RANDOM}) SELECT x.*, round(a.annual_cost_saving / CAST(greatest(b.annual_cost_saving, 1) AS DOUBLE), 4) AS uplift FROM (SELECT * FROM a UNION ALL SELECT * FROM b) x, a, b",
    "fairness_by_group": _FAIR + " SELECT * FROM fair",
    "recall_spread": _FAIR + " SELECT max(round(recall, 3)) AS highest, min(round(recall, 3)) AS lowest, round(max(round(recall, 3)) - min(round(recall, 3)), 6) AS spread FROM fair",
    "threshold_sweep": f"WITH {TEST}, s AS (SELECT CAST(h AS INTEGER) AS hundredths, {_COUNTS} FROM (SELECT h, RETROFIT_POTENTIAL AS label, CAST(SCORE_A >= h / 100.0::DOUBLE AS INTEGER) AS pred FROM test, (VALUES " + ", ".join(f"({h})" for h in vocab.SWEEP_HUNDREDTHS) + f") t(h) WHERE PROPERTY_TYPE = 'Flat') GROUP BY h) SELECT hundredths, round(hundredths / 100.0::DOUBLE, 6) AS threshold, round({_REC}, 6) AS recall, round({_PREC}, 6) AS \"precision\", round({_F1}, 6) AS f1, tp + fp AS flagged FROM s",
    "group_threshold": f"WITH {TEST}, part AS (SELECT *, row_number() OVER (ORDER BY {_hash('UPRN')}, UPRN) <= count(*) OVER () // 2 AS tune FROM test WHERE PROPERTY_TYPE = 'Flat'), " + _tuned("tune", "NOT tune"),
    "group_threshold_temporal": f"SELECT * FROM (WITH {TEST}, flats AS (SELECT * FROM test WHERE PROPERTY_TYPE = 'Flat'), " + _tuned("FILE_YEAR = 2000", "FILE_YEAR = 2001", ", (SELECT count(*) FROM flats WHERE FILE_YEAR = 2000) AS n_tune", "flats")
    + f") WHERE (SELECT min(n) FROM (WITH {TEST} SELECT count(*) FILTER (FILE_YEAR = y) AS n FROM test, (VALUES (2000), (2001)) v(y) WHERE PROPERTY_TYPE = 'Flat' GROUP BY y)) >= {MIN_GROUP}",
    "city_evaluation": _city(["NATION_3"]),
    "city_table": _city(["NATION_3", "NATION_7", "NATION_12"]),
    "district_summary": _DISTRICTS + " SELECT * FROM dist",
    "district_extremes": _DISTRICTS + " SELECT (SELECT district FROM dist ORDER BY predicted_positive_rate, district LIMIT 1) AS lowest_district, min(predicted_positive_rate) AS lowest_rate, (SELECT district FROM dist ORDER BY predicted_positive_rate DESC, district LIMIT 1) AS highest_district, max(predicted_positive_rate) AS highest_rate FROM dist",
    "bootstrap_auc": f"WITH {_bootstrap(2000)}, obs AS (SELECT model, sum(neg * (cp - pos + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc FROM (SELECT model, pos, neg, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS cp FROM (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM (SELECT 'A' AS model, SCORE_A AS score, RETROFIT_POTENTIAL AS label FROM test UNION ALL SELECT 'B', SCORE_B, RETROFIT_POTENTIAL FROM test) GROUP BY 1, 2)) GROUP BY 1) SELECT model, round(any_value(roc_auc), 6) AS roc_auc, round(quantile_cont(auc, 0.025), 6) AS ci_low, round(quantile_cont(auc, 0.975), 6) AS ci_high, count(*) AS n_resamples FROM draws JOIN obs USING (model) GROUP BY model",
    "bootstrap_gap": f"WITH {_bootstrap()}, g AS (SELECT r, max(auc) FILTER (model = 'A') - max(auc) FILTER (model = 'B') AS gap FROM draws GROUP BY r) SELECT 'A' AS top_model, 'B' AS second_model, round(avg(gap), 6) AS gap, round(quantile_cont(gap, 0.025), 6) AS gap_ci_low, round(quantile_cont(gap, 0.975), 6) AS gap_ci_high, round(avg(CAST(gap > 0 AS INTEGER)), 6) AS share_ahead, count(*) AS n_resamples FROM g",
    "walk_forward_folds": f"WITH {PREP}, ranked AS (SELECT *, row_number() OVER (PARTITION BY FILE_YEAR ORDER BY {_hash('UPRN')}, UPRN) AS rn FROM prep) " + _fold_rows(),
    "walk_forward_summary": f"""WITH {PREP}, cells AS (SELECT FILE_YEAR AS y, SCORE_A AS score, sum(RETROFIT_POTENTIAL) AS pos, sum(1 - RETROFIT_POTENTIAL) AS neg FROM prep WHERE FILE_YEAR >= 1997 GROUP BY 1, 2),
run AS (SELECT *, sum(pos) OVER (PARTITION BY y ORDER BY score DESC) AS cp FROM cells),
per AS (SELECT y, sum(neg * (cp - pos + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc, sum(pos) FILTER (score >= 0.5) AS tp, sum(neg) FILTER (score >= 0.5) AS fp, sum(pos) FILTER (score < 0.5) AS fn, sum(neg) FILTER (score < 0.5) AS tn FROM run GROUP BY y),
m AS (SELECT y, auc, {_F1M} AS f1 FROM per)
SELECT round(min(auc), 6) AS auc_min, round(max(auc), 6) AS auc_max, round(avg(f1) FILTER (y <= 1999), 6) AS f1_early, round(avg(f1) FILTER (y >= 2000), 6) AS f1_late FROM m""",
    "most_chosen_setting": f"""WITH {PREP}, r AS (SELECT RETROFIT_POTENTIAL AS label, SCORE_A AS score, (row_number() OVER (PARTITION BY RETROFIT_POTENTIAL ORDER BY {_hash('UPRN')}, UPRN) - 1) * 5 // count(*) OVER (PARTITION BY RETROFIT_POTENTIAL) AS fold FROM prep),
s AS (SELECT fold, h, {_COUNTS} FROM (SELECT fold, h, label, CAST(score >= h / 100.0::DOUBLE AS INTEGER) AS pred FROM r, (VALUES (30), (40), (50), (60), (70)) t(h)) GROUP BY 1, 2),
best AS (SELECT fold, h FROM s QUALIFY row_number() OVER (PARTITION BY fold ORDER BY round({_F1}, 6) DESC, h) = 1)
SELECT CAST(h AS INTEGER) AS hundredths, count(*) AS n_folds FROM best GROUP BY h ORDER BY count(*) DESC, min(fold) LIMIT 1""",
    "incremental_load": f"WITH {PREP} SELECT UPRN, LODGEMENT_DATE, CURRENT_ENERGY_RATING, PROPERTY_TYPE, TIE1, TIE2, TIE3 FROM prep",
}
